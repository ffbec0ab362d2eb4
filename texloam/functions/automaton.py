"""Many strings looked for in one pass over a text, for use inside tasks."""

from __future__ import annotations

from array import array
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa

# Up to this many strings, testing them one by one is as quick.
FEW = 24


class Matcher:
    """Keywords by their forms; of the forms of a keyword that a text contains, the first counts."""

    def __init__(self, keywords: Sequence[tuple[str, Sequence[str]]]):
        owners: dict[str, list[tuple[int, int]]] = {}
        for number, (_, forms) in enumerate(keywords):
            for rank, form in enumerate(forms):
                owners.setdefault(form, []).append((number, rank))
        self.owners = list(owners.values())
        self.automaton = ahocorasick.Automaton()
        for place, form in enumerate(owners):
            self.automaton.add_word(form, place)
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int]]:
        """Of every keyword found, its number and that of its form, in the order of the keywords."""
        best: dict[int, int] = {}
        if self.owners:
            for place in {place for _, place in self.automaton.iter(text)}:
                for number, rank in self.owners[place]:
                    if rank < best.get(number, rank + 1):
                        best[number] = rank
        return sorted(best.items())

    def find_all(self, texts: pa.Array) -> pa.Array:
        """The same for a column, as lists of structs; a null text contains nothing.

        Matches are numbers in flat buffers and texts are read one by one, so a
        batch takes little more than its own bytes.
        """
        ends, keywords, forms = array("i", [0]), array("i"), array("i")
        for text in texts:
            low = text.as_py()
            for number, rank in self.find(low) if low else ():
                keywords.append(number)
                forms.append(rank)
            ends.append(len(keywords))
        numbers = (pa.Array.from_buffers(pa.int32(), len(a), [None, pa.py_buffer(a)]) for a in (keywords, forms, ends))
        keywords, forms, ends = numbers
        pairs = pa.StructArray.from_arrays([keywords, forms], ["keyword", "form"])
        return pa.ListArray.from_arrays(ends, pairs)


_held: dict[int, Matcher] = {}


def matcher(number: int, keywords) -> Matcher:
    """The automaton of a broadcast keyword list, built once in a worker; a worker holds one."""
    if number not in _held:
        _held.clear()
        _held[number] = Matcher(keywords.value)
    return _held[number]


def contains_any(strings: Sequence[str]):
    """A test whether a text in lower case contains one of the strings."""
    if len(strings) <= FEW:
        def test(text: str) -> bool:
            low = text.lower()
            return any(s in low for s in strings)
    else:
        found = Matcher([(s, [s]) for s in strings]).automaton

        def test(text: str) -> bool:
            return next(found.iter(text.lower()), None) is not None
    return test
