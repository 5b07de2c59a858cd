"""Conversation prefix trie by truncation peeling.

Conversations.  Turns ascend by ``turn`` (null first; equal turns by role, then
by the MD5 of the turn); a null role or text is empty.  Conversation c is
rebuilt from the first h turns of conversation c - c % 100 (SQL's remainder)
and its own turns after its first h, h = crc32 of c's decimal text, modulo 6.

Prefix keys.  Every rebuilt turn gives a 128-bit hash of its place, role and
text; the key of a prefix is the sum of its turns' hashes (four 32-bit lanes),
so it comes from running sums over blocks of turns, and stripping the last
turn is a subtraction.  Places of turns come from the distributed index: no
conversation, however long, is collected or sorted in one task.

Peeling.  The rows that are peeled are surviving nodes (one row each, with
their totals) and conversations that end.  From the greatest depth down, a
band of depths at a time: conversations that end in the band join the
survivors, their last turns are stripped and the rows regroup by the prefix
that is left, which finds the band's nodes and their totals at once; the
nodes of the band's least depth survive into the next.  Bands are cut so that
each holds about 1/``BANDS`` of all prefixes, one depth at least: there are
few rounds however deep a conversation is, and the work is linear.

Inside a band a node's smallest member represents it.  The nodes represented
by one conversation form an unbroken piece of its path (members only leave on
the way down), so their token savings and leaves are summed along the piece
and added to every prefix by the same regrouping.

All groupings are sums and minima (combined before the shuffle), so a first
turn shared by a third of all conversations is no hot group.  The ids that end
at a node are hashed as a stream over sorted chunks of ids, not collected.

Defined results: rows without conv_id belong to no conversation; repeated
rows are further turns; a rebuilt conversation without turns ends at the root;
an empty table has no nodes; code points are counted; other columns are
ignored.  Keys of different prefixes are equal with probability 2^-128 a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import indexed_groups, stored

HEADS = 6
STRIDE = 100
BANDS = 6
BLOCK = 1024
# Children of one node that are joined to it under one key.
MANY = 1000
# Ids in one hashed chunk.
CHUNK = 4096

_KEY = ["k1", "k2", "depth"]
_LANES = [f"lane{i}" for i in range(4)]


def shared_turns(conv_id: Column) -> Column:
    """h: how many turns of the base conversation c is rebuilt from."""
    return F.pmod(F.crc32(conv_id.cast("string")), F.lit(HEADS)).cast("bigint")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest (MD5 of role and text), size (code points)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).cast("bigint").alias("size"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rebuilt turns: conv_id, depth from 1, digest, size; conversations: conv_id, ends)."""
    rows, convs = indexed_groups(turns(conversations), "conv_id", [F.col("turn").asc_nulls_first(), "role", "digest"])
    own = stored(rows.select("conv_id", (F.col("g") - F.col("first_g")).alias("at"), "group_n", "digest", "size"), "turns")
    # at most HEADS - 1 turns of every base conversation
    heads = (own.filter((F.col("at") < HEADS - 1) & (F.col("conv_id") % STRIDE == 0)).groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("at", "digest", "size"))).alias("head")))
    each = convs.select("conv_id", "group_n", shared_turns(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % STRIDE).alias("base"))
    borrowed = each.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int")))
    lists = stored(borrowed.select("conv_id", "h", "head", (F.size("head") + F.greatest(F.col("group_n") - F.col("h"), F.lit(0))).alias("ends"),
                                   F.size("head").cast("bigint").alias("taken")), "rebuilt")
    # the number of borrowed turns goes to blocks of a conversation's turns, as in indexed_groups
    at = lambda c: F.floor(c / F.lit(BLOCK)).cast("bigint")
    rest = own.filter(F.col("at") >= shared_turns(F.col("conv_id"))).withColumn("block", at(F.col("at")))
    copies = lists.join(each.select("conv_id", "group_n"), "conv_id").select(
        "conv_id", "h", "taken", F.explode(F.sequence(F.lit(0).cast("bigint"), at(F.col("group_n")))).alias("block"))
    later = rest.join(copies, ["conv_id", "block"]).select(
        "conv_id", (F.col("taken") + F.col("at") - F.col("h") + 1).alias("depth"), "digest", "size")
    first = lists.select("conv_id", F.explode("head").alias("x")).select("conv_id", (F.col("x.at") + 1).alias("depth"), "x.digest", "x.size")
    return first.unionByName(later), lists.select("conv_id", F.col("ends").cast("bigint").alias("ends"))


def prefixes(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2 (key of the first ``depth`` turns), p1, p2 (of the
    parent), size (of the last turn), ends; with depth 0 for every conversation."""
    mark = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")))
    lanes = [F.conv(F.substring(mark, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(c) for i, c in enumerate(_LANES)]
    rows = stored(placed.select("conv_id", "depth", "size", *lanes, F.floor(F.col("depth") / BLOCK).cast("bigint").alias("block")), "placed-turns")
    sums = rows.groupBy("conv_id", "block").agg(*[F.sum(c).alias(f"b_{c}") for c in _LANES])
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # only conversations longer than a block have sums before one
    offsets = sums.select("conv_id", "block", *[F.sum(f"b_{c}").over(before).alias(f"b_{c}") for c in _LANES]).filter(f"b_{_LANES[0]} is not null")
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = rows.withColumns({f"s_{c}": F.sum(c).over(inside) for c in _LANES}).join(offsets, ["conv_id", "block"], "left")
    total = {c: F.col(f"s_{c}") + F.coalesce(F.col(f"b_{c}"), F.lit(0)) for c in _LANES}
    def packed(hi, lo):
        return F.shiftleft(hi.bitwiseAND(F.lit((1 << 32) - 1)), 32).bitwiseOR(lo.bitwiseAND(F.lit((1 << 32) - 1)))
    keyed = run.select("conv_id", "depth", packed(total["lane0"], total["lane1"]).alias("k1"), packed(total["lane2"], total["lane3"]).alias("k2"),
                       packed(total["lane0"] - F.col("lane0"), total["lane1"] - F.col("lane1")).alias("p1"),
                       packed(total["lane2"] - F.col("lane2"), total["lane3"] - F.col("lane3")).alias("p2"), "size")
    zero = F.lit(0).cast("bigint")
    roots = convs.select("conv_id", *[zero.alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "size")])
    return stored(keyed.unionByName(roots), "prefixes")


def bands(convs: DataFrame, number: int = BANDS) -> list[tuple[int, int]]:
    """[(least depth, depth after the greatest)], deepest first, of about equal
    numbers of prefixes.  Only one row for each different length reaches the
    driver: at most the square root of twice the number of turns."""
    by_length = sorted(((r["ends"], r["n"]) for r in convs.groupBy("ends").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()), reverse=True)
    total = sum((e + 1) * n for e, n in by_length)
    share = max(1, -(-total // number))
    cuts, alive, held, hi = [], 0, 0, None
    for i, (ends, n) in enumerate(by_length):
        alive += n
        hi = ends + 1 if hi is None else hi
        low = by_length[i + 1][0] + 1 if i + 1 < len(by_length) else 0
        at = ends + 1                       # depths low .. at - 1 hold ``alive`` prefixes each
        while at > low:
            room = max(1, (share - held) // alive)
            step = min(at - low, room)
            at, held = at - step, held + step * alive
            if held + alive > share:
                cuts.append((at, hi))
                hi, held = at, 0
    if held:
        cuts.append((0, hi))
    return cuts


def _peel(paths: DataFrame, convs: DataFrame, survivors: DataFrame | None, lo: int, hi: int) -> DataFrame:
    """The nodes of depths lo .. hi - 1, from the surviving nodes of depth hi
    and the conversations that end in the band."""
    zero = F.lit(0).cast("bigint")
    ended = convs.filter(F.col("ends").between(lo, hi - 1)).select(
        "conv_id", "ends", F.lit(1).cast("bigint").alias("n_convs"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
    rows = ended if survivors is None else ended.unionByName(
        survivors.select("conv_id", F.lit(hi).cast("bigint").alias("ends"), "n_convs", "n_leaves", "saved_tokens"))
    # every row with its last turns stripped: one row for each prefix in the band
    band = paths.filter(F.col("depth").between(lo, hi - 1))
    stripped = stored(band.join(rows, "conv_id"), "stripped")
    found = stripped.groupBy(*_KEY).agg(F.sum("n_convs").alias("n"), F.min("conv_id").alias("rep"), F.max(F.col("ends") > F.col("depth")).alias("inner"))
    owned = stripped.alias("s").join(found.select("rep", F.col("depth").alias("at"), "n", "inner").alias("f"),
                                     (F.col("s.conv_id") == F.col("f.rep")) & (F.col("s.depth") == F.col("f.at")), "left")
    down = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    below = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("f.rep").isNotNull()
    rows = owned.select("s.*", own.alias("own"), F.when(own, (F.col("f.n") - 1) * F.col("s.size")).otherwise(0).alias("save"),
                        (own & ~F.coalesce(F.col("f.inner"), F.lit(True))).cast("bigint").alias("leaf"))
    # the next node down the path is represented by the row's conversation: a child that no other row counts
    child = F.coalesce(F.lag("own").over(down), F.col("ends") == F.lit(hi))
    rows = rows.select("*", F.sum("save").over(below).alias("saves"), F.sum("leaf").over(below).alias("leaves"), child.cast("bigint").alias("child"))
    return rows.groupBy(*_KEY).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("child").alias("n_children"), F.sum(F.col("n_leaves") + F.col("leaves")).alias("n_leaves"),
        F.sum(F.col("saved_tokens") + F.col("saves")).alias("saved_tokens"))


# ------------------------------------------------------------- ids of a node

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (k1, k2, depth, conv_id) -> one row for up to CHUNK ids of a node: key, first id, ids joined by commas."""
    here, ids, out = None, [], []

    def close():
        if ids:
            out.append((*here, ids[0], ",".join(map(str, ids))))
            ids.clear()

    names = [*_KEY, "first", "ids"]
    for batch in batches:
        for *key, conv in zip(*[batch[c].to_pylist() for c in (*_KEY, "conv_id")]):
            if key != here or len(ids) == CHUNK:
                close()
                here = key
            ids.append(conv)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks -> the SHA-256 of each node's ids, fed chunk by chunk."""
    here, state, out, names = None, None, [], [*_KEY, "ends_sha256"]
    for batch in batches:
        for *key, ids in zip(*[batch[c].to_pylist() for c in (*_KEY, "ids")]):
            if key == here:
                state.update(b"," + ids.encode())
                continue
            if here is not None:
                out.append((*here, state.hexdigest()))
            here, state = key, hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
            out = []
    if here is not None:
        out.append((*here, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)


def ends_digests(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """k1, k2, depth, ends_sha256 of the nodes at which conversations end."""
    key = "k1 bigint, k2 bigint, depth bigint, "
    last = paths.join(convs.select("conv_id", F.col("ends").alias("depth")), ["conv_id", "depth"]).select(*_KEY, "conv_id")
    sorted_ids = last.repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id")
    chunks = stored(sorted_ids.mapInArrow(_chunks, key + "first bigint, ids string"), "ended-ids")
    return chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_digests, key + "ends_sha256 string")


# -------------------------------------------------------------------- operator

def prefix_trie(conversations: DataFrame, number: int = BANDS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    placed, convs = rebuilt(conversations)
    paths = prefixes(placed, convs)
    survivors, peeled = None, []
    for lo, hi in bands(convs, number):
        nodes = stored(_peel(paths, convs, survivors, lo, hi), "trie-nodes")
        peeled.append(nodes)
        survivors = nodes.filter(F.col("depth") == lo)
    schema = "k1 bigint, k2 bigint, depth bigint, p1 bigint, p2 bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
    nodes = conversations.sparkSession.createDataFrame([], schema)
    for part in peeled:
        nodes = nodes.unionByName(part)
    # parents with many children are few and joined first, by size; no key of the other join has more rows than MANY
    ids = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("of"), "n_children")
    wide = stored(ids.filter(F.col("n_children") > MANY).drop("n_children"), "wide-nodes")
    on = ["p1", "p2", "depth"]
    marked = nodes.join(wide, on, "left")
    rest = marked.filter("of is null").drop("of").join(ids.filter(F.col("n_children") <= MANY).drop("n_children"), on, "left")
    linked = marked.filter("of is not null").unionByName(rest)
    return linked.join(ends_digests(paths, convs), _KEY, "left").select(
        "conv_id", "depth", F.col("of").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
