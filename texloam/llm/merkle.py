"""Merkle manifest of a dataset: leaves, one tree per group, proofs, and a check of them.

Each level is one table of nodes with their place.  Lag and lead columns of fixed
offsets over the nodes in order give a node its neighbours; the node's slot in its
run and the run's length mask those that belong to other runs.  What is left are
the siblings, and the rows of first children hash their parents, the next level.

A window never holds a whole tree: its partition is the run, the nodes below one
parent.  Places come from a range partitioning of the leaves, whose counts are
summed up first, so a group with a third of all rows is ranked by as many tasks as
its rows need.

Proofs are put together from the top down: a node's path is its own siblings and
its parent's path, so each level is joined once with the next smaller one.  The
join's key is the window's, so only the smaller side moves again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from texloam.llm.common import ascii_lower, durable, table

#: Children of a node.
FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts in UTF-8, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its byte count before it, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def group_key(group: Column) -> Column:
    """A text that is never null and sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0 within ``key``) and ``n`` (rows of the key), in the order of ``order``.

    ``order`` must tell all rows apart.  Rows are partitioned by ranges of key
    and order, and written; each range counts its rows, and what stands before a
    range in its key is the sum of a few counts.
    """
    ranges = durable(rows.repartitionByRange("key", *order).withColumn("part", F.spark_partition_id()))
    counts = ranges.groupBy("key", "part").agg(F.count("*").alias("rows"))
    of_key = Window.partitionBy("key")
    upto = F.sum("rows").over(of_key.orderBy("part"))
    counts = counts.select(
        "key", "part", (upto - F.col("rows")).alias("before"), F.sum("rows").over(of_key).alias("n")
    )
    nth = F.row_number().over(Window.partitionBy("key", "part").orderBy(*order)) - 1
    ranked = ranges.withColumn("nth", nth).join(counts, ["key", "part"])
    kept = [c for c in rows.columns]
    return ranked.select(*kept, (F.col("before") + F.col("nth")).alias("place"), "n")


def _neighbours(of: str, condition: str, steps: range) -> str:
    """The hashes at the given steps that belong to the run, one after the other."""
    window = "OVER (PARTITION BY key, up ORDER BY place)"
    parts = (f"if({condition.format(i)}, {of}(hash, {i}) {window}, '')" for i in steps)
    return f"concat({', '.join(parts)})"


_BEFORE = _neighbours("lag", "slot >= {}", range(FANOUT - 1, 0, -1))
_AFTER = _neighbours("lead", "slot + {} < length", range(1, FANOUT))


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (key, place, n, hash) with ``up``, the parent's place, and the run's hashes on both sides, joined."""
    runs = nodes.selectExpr("*", f"place % {FANOUT} AS slot", f"place div {FANOUT} AS up")
    runs = runs.selectExpr("*", f"least({FANOUT}, n - place + slot) AS length")
    return runs.selectExpr(*nodes.columns, "up", f"{_BEFORE} AS before", f"{_AFTER} AS after")


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: first children hash their run."""
    first = with_siblings(nodes).filter(F.pmod("place", F.lit(FANOUT)) == 0)
    return first.select(
        "key",
        F.col("up").alias("place"),
        F.ceil(F.col("n") / FANOUT).alias("n"),
        digest(F.col("hash"), F.col("after")).alias("hash"),
    )


@dataclass(frozen=True)
class Tree:
    """Levels of nodes (key, place, n, hash) from the leaves up, and the top node of every key (key, hash)."""

    levels: list[DataFrame]
    tops: DataFrame


def tree(leaves: DataFrame) -> Tree:
    """Trees over leaves (key, place, n, hash and others), one for each key.

    A key leaves the levels once one node remains.  The driver reads one number,
    the largest count, and knows from it how many levels there are.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, tops = [leaves], None
    while most > 1:
        most = -(-most // FANOUT)
        nodes = levels[-1].select("key", "place", "n", "hash")
        levels.append(durable(parents(nodes.filter("n > 1"))))
    for level in levels:
        alone = level.filter("n = 1").select("key", "hash")
        tops = alone if tops is None else tops.unionByName(alone)
    return Tree(levels, tops)


def paths(trees: Tree, above: DataFrame) -> DataFrame:
    """Every leaf with ``path``, its siblings level by level, nearest first, and the columns of ``above``.

    ``above`` (key, path and others) is what follows a key's top node.
    """
    handed = [c for c in above.columns if c not in ("key", "path")]
    found = None
    for number, level in reversed(list(enumerate(trees.levels))):
        own = level.columns if number == 0 else ["key", "place"]
        whole = level.filter("n = 1").join(above, "key").select(*own, "path", *handed)
        if found is not None:
            below = with_siblings(level.filter("n > 1"))
            rest = found.select("key", F.col("place").alias("up"), F.col("path").alias("rest"), *handed)
            path = F.concat(F.array(F.struct("before", "after")), "rest").alias("path")
            whole = whole.unionByName(below.join(rest, ["key", "up"]).select(*own, path, *handed))
        found = whole
    return found


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, start, lambda node, step: digest(step["before"], node, step["after"]))


def siblings(path: Column) -> Column:
    """All siblings of a path, one after the other."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    changed: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, path, altered.

    A leaf is the digest of ``fields``; the leaves of each group, by ascending
    id, form a tree of ``FANOUT``, and the group's subroots, null first, one
    more.  ``altered`` is the leaf with the columns of ``changed`` in place of
    the stored ones, for checking copies against the manifest: fold it with
    ``folded`` along ``path`` and compare with ``root``.

    Null ids come first.  Rows with one id are ordered by their leaf; rows that
    repeat all fields have leaves of their own, equal to each other.  A null
    group is a group; so is the empty text.  Long texts are hashed whole.  Other
    columns are not looked at.  An empty table gives no rows.
    """
    changed = changed or {}
    leaf = digest(*(field(F.col(c)) for c in fields))
    altered = digest(*(field(changed.get(c, F.col(c))) for c in fields)) if changed else leaf
    rows = docs.select(
        group_key(F.col(group_col)).alias("key"), F.col(id_col).alias("id"), leaf.alias("hash"), altered.alias("altered")
    )
    rows = durable(rows.withColumn("row", F.monotonically_increasing_id()))
    leaves = durable(placed(rows, ["id", "hash", "row"]))
    groups = tree(leaves)
    # The subroots are the leaves of one more tree, whose only key is empty.
    tops = durable(groups.tops.select(F.lit("").alias("key"), F.col("key").alias("group"), "hash"))
    upper = tree(durable(placed(tops, ["group"])))
    end = upper.tops.select("key", F.array().cast(_PATH).alias("path"), F.col("hash").alias("root"))
    above = paths(upper, end).select(F.col("group").alias("key"), "path", F.col("hash").alias("subroot"), "root")
    found = paths(groups, durable(above))
    return found.select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot", "root", "path", "altered")


def query(spark, sf):
    """Proofs of all documents, checked with the texts of a third of them in lower case."""
    docs = table(spark, sf, "documents")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    lower = F.when(crc % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    found = manifest(docs, changed={"text": lower})
    again = folded(F.col("altered"), F.col("path"))
    found = found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        again.alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(levels: int = 9) -> str:
    """The same in plain SQL, for up to ``FANOUT`` to the power of ``levels`` rows of a group."""
    def number(name):
        return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(number(c) for c in FIELDS[:-1]) + f" || {number(text)})"

    def run(of, by):
        return f"""string_agg(hash, '' ORDER BY place) OVER (PARTITION BY {by}, place // {FANOUT}
                   ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""" if of == "before" else (
               f"""string_agg(hash, '' ORDER BY place) OVER (PARTITION BY {by}, place // {FANOUT}
                   ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""")

    def climb(name, by, source, depth):
        out = [f"{name}0 AS (SELECT {by}, place, n, hash FROM {source})"]
        for i in range(1, depth + 1):
            out.append(
                f"{name}{i} AS (SELECT {by}, place // {FANOUT} AS place, (max(n) + {FANOUT - 1}) // {FANOUT} AS n, "
                f"sha256(string_agg(hash, '' ORDER BY place)) AS hash FROM {name}{i - 1} WHERE n > 1 "
                f"GROUP BY {by}, place // {FANOUT})"
            )
        for i in range(depth + 1):
            out.append(
                f"{name}{i}s AS (SELECT {by}, place, coalesce({run('before', by)}, '') AS a, "
                f"coalesce({run('after', by)}, '') AS b FROM {name}{i} WHERE n > 1)"
            )
        tops = " UNION ALL ".join(f"SELECT {by}, hash FROM {name}{i} WHERE n = 1" for i in range(depth + 1))
        return [*out, f"{name}tops AS ({tops})"]

    def follow(first, name, by, place, depth):
        """Fold and list the siblings, one CTE a level."""
        out, last = [], first
        for i in range(depth):
            # Equal to the node itself where its tree ended below this level.
            out.append(
                f"{name}{i}f AS (SELECT f.* REPLACE (proof || coalesce(a || b, '') AS proof, "
                f"CASE WHEN a IS NULL THEN node ELSE sha256(a || node || b) END AS node) "
                f"FROM {last} f LEFT JOIN {name}{i}s s ON f.{by} = s.{by} AND f.{place} // {FANOUT**i} = s.place)"
            )
            last = f"{name}{i}f"
        return out, last

    bits = "list_reduce(list_concat([xor(c, b)], [0,0,0,0,0,0,0,0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = (
        "xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], "
        f"list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda c, b: {bits}))"
    )
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"leaves AS (SELECT doc_id, coalesce('+' || lang, '') AS k, {leaf('text')} AS hash, "
        f"CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS altered FROM documents)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, hash, altered) - 1 AS place, "
        "count(*) OVER (PARTITION BY k) AS n FROM leaves)",
        *climb("g", "k", "ranked", levels),
        "roots AS (SELECT 0 AS one, k, hash, row_number() OVER (ORDER BY k) - 1 AS up, row_number() OVER (ORDER BY k) - 1 AS place, "
        "count(*) OVER () AS n FROM gtops)",
        *climb("r", "one", "roots", levels),
        "start AS (SELECT doc_id, r.k, ranked.place, r.up, r.one, ranked.hash AS leaf, r.hash AS subroot, altered AS node, '' AS proof "
        "FROM ranked JOIN roots r ON ranked.k = r.k)",
    ]
    low, last = follow("start", "g", "k", "place", levels)
    high, last = follow(last, "r", "one", "up", levels)
    return (
        "WITH " + ",\n".join([*parts, *low, *high]) + "\nSELECT doc_id, leaf, subroot, t.hash AS root, "
        f"sha256(proof) AS proof_sha256, node AS folded_root, node = t.hash AS verified FROM {last} f CROSS JOIN rtops t"
    )


SQL = _sql()
