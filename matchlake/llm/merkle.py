"""Merkle dataset manifest, verified by a recursive climb.

Leaves.  A row's leaf is the SHA-256 of doc_id, source, lang, n_chars and
text, each ``-`` if null and else its length in UTF-8 bytes, ``:`` and itself.
Leaves of a source ascend by doc_id; every ``FANOUT`` consecutive nodes become
the hash of their digests (hex text) until one is left, the subroot; subroots
in the order of their sources give the root in the same way.

Building.  Positions come from the distributed index, so a source that holds
a third of all rows is one level of a few more groups, never one task.  Every
level groups at most ``FANOUT`` rows a key and is written down as node rows:
the digests of the node's run, and the link to its parent (``up_*``, ``slot``).

Climb.  A recursive query starts with every leaf's hash (the tampered one
where there is one) and ascends over the parent links: each round joins the
run, folds the hash into the run's, and appends a row that names the siblings
of the next level (the run and the own place in it).  It ends where a node has
no parent.  The digests of the siblings are put into the rows where the node
rows lie, and a leaf's rows (one a level: bounded by the height) are put
together in the same partition, so siblings are never shuffled.

All leaves pass through the same upper nodes, so node rows are stored once
for each ``BLOCK`` of leaves under them (one block for the lower levels) and
the climb joins on node and block: no key holds more than ``BLOCK`` leaves,
and the copies add 1/4096 of the rows to a level.

Defined results: null fields count as ``-``; an empty text is ``0:``; rows
without doc_id come first in their source and are not tampered with; equal
doc_ids are ordered by their leaf (repeated rows are siblings with equal
digests); a null source is a source of its own, before all others; a lone leaf
is its subroot, a lone subroot the root, and the proof of one leaf alone is
the hash of nothing; an empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import BLOCK, indexed_groups, stored

FANOUT = 16
TAMPER = 5

_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """The leaf of a documents row (hex), with ``text`` in place of its own."""
    return F.sha2(F.concat(*[_field(F.col(c) if c != "text" or text is None else text) for c in _FIELDS]), 256)


def _chosen(every: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(every)) == 0, F.lit(False))


def leaves(docs: DataFrame, every: int = TAMPER) -> DataFrame:
    """doc_id, source, leaf, start: the hash that the climb starts with, that
    of the tampered row where ``every`` divides the unsigned crc32 of the id."""
    tampered = leaf_digest(F.translate("text", _UPPER, _LOWER))
    return docs.select("doc_id", "source", leaf_digest().alias("leaf"),
                       F.when(_chosen(every), tampered).otherwise(leaf_digest()).alias("start"))


def _above(n: Column, fanout: int) -> Column:
    return F.floor((n + fanout - 1) / fanout).cast("bigint")


def _levels(nodes: DataFrame, height: int, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels above ``nodes`` (tree, first, pos, n, digest, g0, g1): the
    written level tables (with ``kids``), and the last node of each tree."""
    levels, tops, here = [], nodes.filter("n = 1").select("tree", "digest", "g0", "g1"), nodes
    for lvl in range(1, height + 1):
        runs = (here.filter("n > 1").groupBy("tree", "first", _above(F.col("pos") + 1, fanout).alias("pos"), _above(F.col("n"), fanout).alias("n"))
                .agg(F.sort_array(F.collect_list(F.struct(F.pmod("pos", F.lit(fanout)).alias("slot"), "digest"))).alias("run"),
                     F.min("g0").alias("g0"), F.max("g1").alias("g1"))
                .withColumn("kids", F.col("run.digest")))
        digest = F.unhex(F.sha2(F.array_join(F.transform("kids", lambda k: F.lower(F.hex(k))), ""), 256))
        here = stored(runs.select("tree", "first", (F.col("pos") - 1).alias("pos"), "n", "kids", "g0", "g1", digest.alias("digest")), f"merkle-{lvl}")
        levels.append(here)
        tops = tops.unionByName(here.filter("n = 1").select("tree", "digest", "g0", "g1"))
    return levels, tops


def _height(n: int, fanout: int) -> int:
    height = 0
    while n > 1:
        n, height = -(-n // fanout), height + 1
    return height


# The tree of the subroots.
_TOP = -1


def _node_id(at: Column, lvl: int) -> Column:
    """The node of level ``lvl`` whose first leaf is number ``at``; levels over the subroots count from -1 down."""
    return (at * 64 + lvl).cast("bigint")


def _top_id(pos: Column, lvl: int) -> Column:
    return (-1 - (pos * 64 + lvl)).cast("bigint")


def _link(tree: Column, first: Column, pos: Column, n: Column, lvl: int, n_trees: int, fanout: int) -> list[Column]:
    """up, slot: the parent of a node at (lvl, pos) among ``n`` of its tree, and its place there; null for the root."""
    parent = F.floor(pos / fanout)
    inside = F.when(n > 1, _node_id(first + parent * fanout ** (lvl + 1), lvl + 1))
    slot = F.when(n > 1, F.pmod(pos, F.lit(fanout)))
    if n_trees > 1:
        inside = inside.otherwise(_top_id(F.floor(tree / fanout), 1))
        slot = slot.otherwise(F.pmod(tree, F.lit(fanout)))
    return [inside.alias("up"), slot.cast("int").alias("slot")]


def build(docs: DataFrame, every: int = TAMPER, fanout: int = FANOUT, block: int = BLOCK) -> tuple[DataFrame, DataFrame, str | None]:
    """(leaf rows, node rows, root), rows linked to their parents and written down."""
    rows, sources = indexed_groups(leaves(docs, every), "source", [F.col("doc_id").asc_nulls_first(), F.col("leaf")], block)
    largest = sources.agg(F.max("group_n").alias("n"), F.count(F.lit(1)).alias("trees")).first()
    n_trees, tree, first, n = largest["trees"], F.col("group_no"), F.col("first_g"), F.col("group_n")
    bottom = stored(rows.select("doc_id", "g", tree.alias("tree"), first.alias("first"), n.alias("n"), F.unhex("leaf").alias("leaf"),
                                F.unhex("start").alias("start"), *_link(tree, first, F.col("g") - first, n, 0, n_trees, fanout)), "merkle-leaves")
    base = bottom.select("tree", "first", (F.col("g") - F.col("first")).alias("pos"), "n", F.col("leaf").alias("digest"),
                         F.col("g").alias("g0"), F.col("g").alias("g1"))
    levels, subroots = _levels(base, _height(largest["n"] or 0, fanout), fanout)
    top = subroots.select(F.lit(_TOP).cast("bigint").alias("tree"), F.lit(0).cast("bigint").alias("first"), F.col("tree").alias("pos"),
                          F.lit(n_trees).cast("bigint").alias("n"), "digest", "g0", "g1")
    over, roots = _levels(top, _height(n_trees, fanout), fanout)
    root = roots.first() if n_trees else None
    at = lambda c: F.floor(F.col(c) / block).cast("bigint")
    blocks = F.explode(F.sequence(at("g0"), at("g1"))).alias("block")
    nodes = docs.sparkSession.createDataFrame([], "id bigint, kids array<binary>, mark binary, up bigint, slot int, block bigint")
    for lvl, level in enumerate(levels, 1):
        nodes = nodes.unionByName(level.select(
            _node_id(F.col("first") + F.col("pos") * fanout ** lvl, lvl).alias("id"), "kids", F.when(F.col("n") == 1, F.col("digest")).alias("mark"),
            *_link(F.col("tree"), F.col("first"), F.col("pos"), F.col("n"), lvl, n_trees, fanout), blocks))
    for lvl, level in enumerate(over, 1):
        up = F.when(F.col("n") > 1, _top_id(F.floor(F.col("pos") / fanout), lvl + 1))
        nodes = nodes.unionByName(level.select(
            _top_id(F.col("pos"), lvl).alias("id"), "kids", F.lit(None).cast("binary").alias("mark"), up.alias("up"),
            F.pmod("pos", F.lit(fanout)).cast("int").alias("slot"), blocks))
    return bottom, stored(nodes, "merkle-nodes"), root and root["digest"].hex()


_CLIMB = """
WITH RECURSIVE climb(g, doc_id, step, folded, mark, up, slot) AS (
  SELECT g, doc_id, 0, start, leaf, up, slot FROM {bottom}
  UNION ALL
  SELECT c.g, c.doc_id, c.step + 1,
         unhex(sha2(array_join(transform(n.kids, (k, i) -> lower(hex(IF(i = c.slot, c.folded, k)))), ''), 256)), n.mark, n.up, n.slot
  FROM climb c JOIN {nodes} n ON CAST(floor(c.g / {block}) AS BIGINT) = n.block AND c.up = n.id)
SELECT CAST(floor(g / {block}) AS BIGINT) AS block, * FROM climb"""

# Spark's limit of rows in a recursive query is a fixed number; the proof's join and grouping share the blocks' partitioning.
_SETTINGS = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextlib.contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def manifest(docs: DataFrame, every: int = TAMPER, fanout: int = FANOUT, block: int = BLOCK) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; digests as hex."""
    spark = docs.sparkSession
    bottom, nodes, root = build(docs, every, fanout, block)
    steps, last = F.col("steps"), F.element_at("steps", -1)
    text = lambda c: F.lower(F.hex(c))
    with _settings(spark):
        climbed = spark.sql(_CLIMB, bottom=bottom, nodes=nodes, block=block).repartition("block").alias("c")
        runs = nodes.select("block", "id", "kids").repartition("block").alias("n")
        on = (F.col("c.block") == F.col("n.block")) & (F.col("c.up") == F.col("n.id"))
        siblings = F.array_join(F.transform(F.filter("n.kids", lambda k, i: i != F.col("c.slot")), text), "")
        rows = climbed.join(runs, on, "left").select("c.block", "c.g", "c.doc_id", F.struct(
            "c.step", F.unhex(F.coalesce(siblings, F.lit(""))).alias("siblings"), "c.folded", "c.mark").alias("x"))
        leaf_rows = rows.groupBy("block", "g", "doc_id").agg(F.sort_array(F.collect_list("x")).alias("steps"))
        marks = F.filter(F.transform(steps, lambda x: x["mark"]), lambda m: m.isNotNull())
        return stored(leaf_rows.select(
            "doc_id", text(steps[0]["mark"]).alias("leaf"), text(F.element_at(marks, -1)).alias("subroot"), F.lit(root).alias("root"),
            F.sha2(F.array_join(F.transform(steps, lambda s: text(s["siblings"])), ""), 256).alias("proof_sha256"),
            text(last["folded"]).alias("folded_root"), (text(last["folded"]) == F.lit(root)).alias("verified")), "merkle-manifest")
