"""Plain SimHash and plain components."""

import xxhash


def plain_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, budget=3):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for x in values:
        for y in values:
            if x < y and (x ^ y).bit_count() <= budget:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {v: find(v) for v in values}
