"""N-gram Jaccard join by rare-first prefix filtering.

Sets.  A text's set holds its distinct word shingles (64-bit hashes).  Texts
with equal sets are one class from the start; only classes are joined, and
links are pairs of classes with ``100 * |A & B| >= percent * |A | B|``.

Order.  Shingles are ordered by rarity: how many documents hold a shingle of
the same hash bucket, counted over all documents into ``2^RARITY_BITS``
buckets (an upper estimate: exact for what is frequent), then by hash.  Any
one order gives the same result, only the number of candidates depends on it.

Filters.  Two linked sets share a shingle within the rarest ``n - ceil(t n) +
1`` of each; for the smaller set ``n - ceil(2 t n / (1 + t)) + 1`` do.  Only
those prefixes are rows: sets are joined on prefix shingles, subject to the
length bound and, at each common shingle, the bound by positions: what is
shared is at most the earlier shingles in common (bounded by bitmaps of them),
this one, and the shorter rest.  The shingle must lie in the smaller set's
shorter prefix.  A pair's rows are put together once, at its first common
shingle, and the suffix filter bounds what the sets share behind their
prefixes: with ``CELLS`` counts of hashes, never more than the sum of the
smaller counts.  What is left is verified once, on whole sets.

Linking without all pairs.  Every class is first verified with one other: of
the heads of its buckets, the one met in most of them (a star).  The head of a
bucket is the member in whose order the shingle comes first, so of the edited
copies of a page it is the least edited one.
Where those links lead is followed for two steps; buckets that still hold
members of different parts are open.  Open buckets of ``SMALL`` members make all
pairs between their components; members of larger ones are verified with one
member of another component each, and what is open then makes all pairs, too.
Pairs verified before are left out.
So copies of a page, changed in a word each, cost a few verifications each,
and no link between components is lost.  Members of large buckets meet in a
grid of ``TILE`` by ``TILE``.

Bounds.  The rarity table has ``2^RARITY_BITS`` bytes, the bitmap of wanted
classes ``2^hashing.MOST_BITS`` bits at most; both are broadcast and their sizes are
parameters (a fuller table costs time, never a link).  Nothing else is
broadcast but by Spark's own choice by size; no set, pair or component reaches
the driver.

Defined results: fewer words than a shingle count as one shingle; null and
empty texts (and those of white space) have no shingle, are linked with
nothing and are components of their own; repeated rows get a row each;
documents without an id link like others and sort last (their component is
null only if no member has an id, and for a text without shingles); other
columns are ignored.  Words of any length are hashed in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import BLOCK, join_counted, map_batches, stored, text_bytes
from matchlake.llm.components import components
from matchlake.llm.hashing import bitmap, mixed, within, word_factors, word_hashes

SHINGLE = 5
PERCENT = 80
RARITY_BITS = 23
CELLS = 64
TILE = 1024
# Members of a bucket that is small enough to make its pairs at once.
SMALL = 16
# Documents that a shingle may be in (by the rarity table) to be grouped without combining before the shuffle.
MANY = 1 << 14

_SCALE = 16         # steps of rarity for a doubling
_SPAN = 16          # bits of a bucket number inside one row of counts
_U = np.uint64


# --------------------------------------------------------------------- shingles

def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text's words."""
    if not len(words):
        return words
    size = min(size, len(words))
    factors = word_factors()
    n = len(words) - size + 1
    total = np.full(n, size * 0xC2B2AE3D27D4EB4F % (1 << 64), _U)
    for j in range(size):
        total += words[j:j + n] * factors[j]
    out = np.sort(mixed(total))
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    for words in word_hashes(texts):
        yield shingle_set(words, size)


def _texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return batch.column(column).to_pylist()


# ---------------------------------------------------------------------- rarity

def rarity(docs: DataFrame, size: int = SHINGLE, bits: int = RARITY_BITS) -> np.ndarray:
    """One byte for each hash bucket: its number of (document, shingle) pairs
    over all documents, on a scale of sixteenths of a doubling."""
    span = 1 << min(_SPAN, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, any_text = np.zeros(1 << bits, np.uint8), False
        for batch in batches:
            for shingles in shingle_sets(_texts(batch), size):
                buckets = shingles >> _U(64 - bits)      # sorted, so equal ones stand together
                if not len(buckets):
                    continue
                any_text = True
                first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
                n = np.diff(np.append(first, len(buckets)))
                at = buckets[first].astype(np.int64)
                # a task's count ends at 255; the sum over tasks goes on
                counts[at] = np.minimum(counts[at] + n, 255).astype(np.uint8)
        if any_text:
            rows = counts.reshape(-1, span)
            for at in range(0, len(rows), 16):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, min(at + 16, len(rows)))), pa.array([r.tobytes() for r in rows[at:at + 16]], pa.binary())],
                                                 ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch["part"].to_pylist(), batch["counts"].to_pylist()):
                total = sums.setdefault(part, np.zeros(span, np.int64))
                total += np.frombuffer(counts, np.uint8)
        if sums:
            scale = [np.minimum(_SCALE * np.log2(1.0 + s), 255).astype(np.uint8).tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(scale, pa.binary())], ["part", "counts"])

    schema = "part bigint, counts binary"
    parts = text_bytes(docs).select("text").mapInArrow(count, schema).repartition("part").mapInArrow(add, schema)
    out = np.zeros((1 << bits) // span * span, np.uint8).reshape(-1, span)
    rows = parts.toArrow()                               # bounded: 2^bits bytes
    for part, counts in zip(rows["part"].to_pylist(), rows["counts"].to_pylist()):
        out[part] = np.frombuffer(counts, np.uint8)
    return out.reshape(-1)


# ------------------------------------------------------------- sizes and bounds

def _ceil(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("bigint")


def prefix_size(n: int, percent: int) -> int:
    """How many of the rarest shingles a set of ``n`` is found by."""
    return n - -(-n * percent // 100) + 1


def overlap(na: Column, nb: Column, percent: int) -> Column:
    """The least number of common shingles of two linked sets."""
    return _ceil((na + nb) * percent, 100 + percent)


def _short_prefix(n: Column, percent: int) -> Column:
    return n - _ceil(n * (2 * percent), 100 + percent) + 1


# Longs of a bitmap of the shingles that come before a shingle in a set's order.
_BEFORE = [f"before{i}" for i in range(4)]


def _earlier(rows: DataFrame) -> DataFrame:
    """Rows (cid, at, token) of whole prefixes with a bitmap of each row's earlier shingles."""
    bit = F.pmod(F.xxhash64("token"), F.lit(64 * len(_BEFORE)))
    upto = Window.partitionBy("cid").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)      # one prefix
    own = {c: F.when(F.floor(bit / 64) == i, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(64)).cast("int"))).otherwise(0).cast("bigint")
           for i, c in enumerate(_BEFORE)}
    return rows.withColumns(own).withColumns({c: F.coalesce(F.bit_or(c).over(upto), F.lit(0).cast("bigint")) for c in _BEFORE})


def _may_link(percent: int, bitmaps: bool) -> Column:
    """Length and positional bounds of rows (n1, at1), (n2, at2) that share a
    shingle at places at1 and at2 (from 0), whether or not it is their first;
    and the shingle must stand in the smaller set's short prefix.

    With ``bitmaps``: earlier shingles in common set one bit in both; where a
    set's shingles share bits, as many more may be hidden."""
    n1, n2, at1, at2 = (F.col(c) for c in ("n1", "n2", "at1", "at2"))
    lengths = F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent
    earlier = F.least(at1, at2)
    if bitmaps:
        bits = lambda of: sum((F.bit_count(of(c)) for c in _BEFORE), F.lit(0))
        one, two = lambda c: F.col(f"l_{c}"), lambda c: F.col(f"r_{c}")
        earlier = F.least(earlier, bits(lambda c: one(c).bitwiseAND(two(c))) + F.least(at1 - bits(one), at2 - bits(two)))
    most = earlier + 1 + F.least(n1 - at1 - 1, n2 - at2 - 1)
    short = F.when(n1 < n2, at1 < _short_prefix(n1, percent)).when(n2 < n1, at2 < _short_prefix(n2, percent)).otherwise(
        F.least(at1, at2) < _short_prefix(n1, percent))
    return lengths & short & (most >= overlap(n1, n2, percent))


# --------------------------------------------------------------------- classes

def _sums(s: np.ndarray) -> tuple[int, int]:
    """Two sums over a set that name it, as signed numbers."""
    both = np.array([mixed(s).sum(dtype=_U), mixed(s ^ _U(0x165667B19E3779F9)).sum(dtype=_U)], _U).view(np.int64)
    return int(both[0]), int(both[1])


def _cells(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles & _U(CELLS - 1)).astype(np.int64), minlength=CELLS)


def document_sets(docs: DataFrame, table: np.ndarray, size: int, percent: int) -> DataFrame:
    """doc_id, n, s1, s2 (sums of the set), prefix (rarest shingles in order),
    n_rare (how many of them are in fewer than MANY documents, by the rarity
    table), suffix (counts of the other hashes by cell), for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    bits = int(table.size).bit_length() - 1

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rarity_of, rows = shared.value, []
        for s in shingle_sets(_texts(batch), size):
            n = len(s)
            ranks = rarity_of[(s >> _U(64 - bits)).astype(np.int64)]
            by_rank = np.argsort(ranks, kind="stable")
            order, cut = s[by_rank], prefix_size(n, percent) if n else 0
            n_rare = int(np.searchsorted(ranks[by_rank[:cut]], _SCALE * np.log2(MANY)))
            rows.append((n, *_sums(s), n_rare, order[:cut].view(np.int64), _cells(order[cut:]).astype(np.int32)))
        names = ["n", "s1", "s2", "n_rare", "prefix", "suffix"]
        types = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", *names])

    return map_batches(text_bytes(docs), run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, n_rare bigint, prefix array<bigint>, suffix array<int>")


_SET = ["s1", "s2", "n"]


def set_classes(sets: DataFrame) -> DataFrame:
    """One row for each different set, written down: cid, n, doc_id (the least), copies, n_rare, prefix, suffix."""
    classes = sets.filter("n > 0").groupBy(*_SET).agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n_rare", "prefix", "suffix")])
    return stored(classes.withColumn("cid", F.monotonically_increasing_id()), "set-classes")


# ---------------------------------------------------------------- verification

def whole_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """cid, shingles (the whole set as bytes) of the classes in ``wanted(cid)``.

    The sets are made again from the texts; a bitmap over the wanted classes'
    first sums lets a task drop the others before anything is shuffled."""
    named = stored(classes.select("cid", *_SET).join(wanted, "cid"), "wanted-classes")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(named, "s1"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted_bits, seen = shared.value, set()
        for batch in batches:
            rows = []
            for s in shingle_sets(_texts(batch), size):
                if not len(s):
                    continue
                sums = _sums(s)
                if within(wanted_bits, np.array(sums[:1])).all() and sums not in seen:
                    seen.add(sums)
                    rows.append((*sums, len(s), s.tobytes()))
            for at in range(0, len(rows), 512):
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[at:at + 512]], pa.binary() if i == 3 else pa.int64()) for i in range(4)], [*_SET, "shingles"])

    found = text_bytes(docs).select("text").mapInArrow(run, "s1 bigint, s2 bigint, n bigint, shingles binary")
    once = found.groupBy(*_SET).agg(F.first("shingles").alias("shingles"))
    return stored(once.join(named, _SET).select("cid", "shingles"), "shingle-sets")


def verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Of written-down ``pairs(a, b)``, those whose whole sets link."""
    # a class in many pairs meets them in tiles, so that no key holds more than BLOCK pairs
    many = stored(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("pairs")).filter(F.col("pairs") > BLOCK)
                  .select("b", _ceil(F.col("pairs"), BLOCK).alias("tiles")), "many-pairs")
    tile = F.coalesce(F.pmod(F.xxhash64("a"), F.col("tiles")), F.lit(0)).cast("bigint")
    tiled = pairs.join(many, "b", "left").select("a", "b", tile.alias("tile"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("right")).join(many, "b", "left").select(
        "b", "right", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("tiles", F.lit(1)) - 1)).alias("tile"))
    both = tiled.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("left")), "a").join(right, ["b", "tile"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for left, right_ in zip(batch["left"], batch["right"]):
            x, y = (np.frombuffer(v.as_py(), _U) for v in (left, right_))
            together = np.sort(np.concatenate([x, y]))
            common = int(np.count_nonzero(together[1:] == together[:-1]))
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(map_batches(both.select("a", "b", "left", "right"), run, "a bigint, b bigint"), "verified-pairs")


# --------------------------------------------------------------------- linking

def _suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n1, n2) whose prefixes' common shingles and cell counts allow a link.

    Common shingles are those within both prefixes (all of them up to the end
    of the prefix that ends first) and those behind it: within the suffix of
    one and the whole of the other."""
    side = lambda s: classes.select(F.col("cid").alias(s), F.col("prefix").alias(f"prefix_{s}"), F.col("suffix").alias(f"suffix_{s}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for n1, n2, *sets in zip(*[batch[c].to_pylist() for c in ("n1", "n2")], *[batch[c] for c in ("prefix_a", "prefix_b", "suffix_a", "suffix_b")]):
            p1, p2, c1, c2 = (x.values.to_numpy() for x in sets)
            common = len(np.intersect1d(p1, p2, assume_unique=True))
            w1, w2 = c1 + _cells(p1.view(_U)), c2 + _cells(p2.view(_U))
            behind = max(np.minimum(c1, w2).sum(), np.minimum(w1, c2).sum())
            keep.append(common + behind >= -(-(n1 + n2) * percent // (100 + percent)))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(rows.select("a", "b", "n1", "n2", "prefix_a", "prefix_b", "suffix_a", "suffix_b"), run, "a bigint, b bigint")


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, n1, n2) from rows (a, b, n1, n2, at1, at2), one for each common
    prefix shingle: a pair is put together once, at its first common shingle."""
    n1, n2 = F.col("n1"), F.col("n2")
    once = rows.groupBy("a", "b", "n1", "n2").agg(F.min("at1").alias("first1"), F.min("at2").alias("first2"))
    most = F.lit(1) + F.least(n1 - F.col("first1") - 1, n2 - F.col("first2") - 1)
    return once.filter(most >= overlap(n1, n2, percent)).select("a", "b", "n1", "n2")


def shared_prefixes(classes: DataFrame) -> DataFrame:
    """token, cid, n, at, head (the member in whose order the shingle comes
    first: it has fewest rarer ones), members: prefix shingles that several
    classes hold.  Shingles that cannot be hot (the rarity table
    bounds their documents) are shuffled once, for the grouping and the join;
    the others are combined before the shuffle, and joined in two parts."""
    rows = classes.select("cid", "n", "n_rare", F.posexplode("prefix").alias("at", "token"))
    heads = [F.min(F.struct("at", "cid"))["cid"].alias("head"), F.count(F.lit(1)).alias("members")]
    rare = rows.filter("at < n_rare").drop("n_rare").repartition("token")
    together = rare.join(rare.groupBy("token").agg(*heads).filter("members > 1"), "token")
    hot = rows.filter("at >= n_rare").drop("n_rare")
    groups = stored(hot.groupBy("token").agg(*heads).filter("members > 1"), "hot-tokens")
    apart = join_counted(hot, groups.withColumn("size", F.col("members")), ["token"], "size")
    return stored(together.unionByName(apart), "shared-prefixes")


def _stars(met: DataFrame, classes: DataFrame, before: DataFrame | None, percent: int) -> DataFrame:
    """Of rows (a, b), one for each shingle that class a shares with a partner b:
    the partner met most often of those not tried ``before``, if the filters allow a link."""
    votes = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    if before is not None:
        votes = votes.join(before, ["a", "b"], "left_anti")
    best = votes.groupBy("a").agg(F.max(F.struct("common", (-F.col("b")).alias("b"))).alias("x")).select("a", (-F.col("x.b")).alias("b"))
    size = lambda c, n: classes.select(F.col("cid").alias(c), F.col("n").alias(n))
    fits = F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent
    pairs = best.join(size("a", "n1"), "a").join(size("b", "n2"), "b").filter(fits).select("a", "b", "n1", "n2")
    return stored(_suffix_filter(pairs, classes, percent), "star-pairs")


def _star_parts(links: DataFrame) -> DataFrame:
    """(node, component) from star links, in which every a has one b: two steps
    along the links.  Equal names are connected; long chains may have several."""
    up = links.select(F.col("a").alias("node"), F.col("b").alias("up"))
    back = up.select(F.col("node").alias("up"), F.col("up").alias("again"))
    # of two that name each other, the smaller is a centre
    first = stored(up.join(back, "up", "left").filter(F.coalesce(~((F.col("again") == F.col("node")) & (F.col("node") < F.col("up"))), F.lit(True)))
                   .select("node", "up"), "star-steps")
    second = first.select(F.col("node").alias("up"), F.col("up").alias("top"))
    named = first.join(second, "up", "left").select("node", F.coalesce("top", "up").alias("component"))
    roots = first.select(F.col("up").alias("node")).distinct().join(first, "node", "left_anti")
    return stored(named.unionByName(roots.select("node", F.col("node").alias("component"))), "star-parts")


def _open(rows: DataFrame, part: DataFrame) -> DataFrame:
    """``rows`` of the buckets that hold members of different parts (node,
    component), with ``part`` (the component), ``lo`` (at, part, cid: the member
    in whose order the shingle comes first) and ``hi`` (part, cid: the last
    part's last member)."""
    named = rows.join(part, rows["cid"] == part["node"], "left").select(*[rows[c] for c in _SHARED], F.coalesce("component", "cid").alias("part"))
    ends = named.groupBy("token").agg(F.min(F.struct("at", "part", "cid")).alias("lo"), F.max(F.struct("part", "cid")).alias("hi"),
                                      F.min("part").alias("least"), F.count(F.lit(1)).alias("size"))
    apart = stored(ends.filter("least < hi.part").drop("least"), "open-tokens")
    return stored(join_counted(named, apart, ["token"], "size"), "open-prefixes")


_SHARED = ["token", "cid", "n", "at", "members"]


def _pairs_between(rows: DataFrame, classes: DataFrame, tried: DataFrame, percent: int, bitmaps: bool) -> DataFrame:
    """Every pair between parts of a bucket that passes the filters and was not
    tried.  ``bitmaps`` are worth their making in large buckets only; they save
    rows, not pairs."""
    if bitmaps:
        # the whole prefixes of the classes in the rows
        prefixes = classes.join(rows.select("cid").distinct(), "cid").select("cid", F.posexplode("prefix").alias("at", "token"))
        rows = rows.join(_earlier(prefixes), ["cid", "at", "token"])
    before = _BEFORE if bitmaps else []
    tiles = _ceil(F.col("members"), TILE)
    mine, all_ = F.pmod(F.xxhash64("cid"), tiles), F.sequence(F.lit(0).cast("bigint"), tiles - 1)
    left = rows.select("token", F.col("cid").alias("a"), F.col("n").alias("n1"), F.col("at").alias("at1"), F.col("part").alias("pa"),
                       *[F.col(c).alias(f"l_{c}") for c in before], mine.alias("i"), F.explode(all_).alias("j"))
    right = rows.select("token", F.col("cid").alias("b"), F.col("n").alias("n2"), F.col("at").alias("at2"), F.col("part").alias("pb"),
                        *[F.col(c).alias(f"r_{c}") for c in before], F.explode(all_).alias("i"), mine.alias("j"))
    # the class of the smaller part is b, as a star's centre is
    cross = left.join(right, ["token", "i", "j"]).filter("pa > pb").filter(_may_link(percent, bitmaps))
    both_ways = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    fresh = _candidates(cross, percent).join(both_ways, ["a", "b"], "left_anti")
    return stored(_suffix_filter(fresh, classes, percent), "open-pairs")


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid")))


def class_links(docs: DataFrame, classes: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(a, b) classes that link, connecting all that links connect."""
    shared = shared_prefixes(classes)
    first = _stars(shared.filter("cid != head").select(F.col("cid").alias("a"), F.col("head").alias("b")), classes, None, percent)
    links = verified(whole_sets(docs, classes, _members(first).distinct(), size), first, percent)

    open_ = _open(shared, _star_parts(links))
    small, large = open_.filter(F.col("members") <= SMALL), open_.filter(F.col("members") > SMALL)
    pairs = _pairs_between(small, classes, first, percent, bitmaps=False)
    # a member of a large bucket meets a member of another part, if the bucket's first or last one is of another
    other = F.when(F.col("part") != F.col("lo.part"), F.col("lo.cid")).when(F.col("part") != F.col("hi.part"), F.col("hi.cid"))
    again = _stars(large.select(F.col("cid").alias("a"), other.alias("b")).filter("b is not null"), classes, first, percent)
    sets = whole_sets(docs, classes, _members(pairs).unionByName(large.select("cid")).distinct(), size)
    second = stored(pairs.unionByName(again).distinct(), "second-pairs")
    links = links.unionByName(verified(sets, second, percent))

    still = _open(large.select(*_SHARED), stored(components(links), "link-components"))
    rest = _pairs_between(still, classes, first.unionByName(second), percent, bitmaps=True)
    return links.unionByName(verified(sets, rest, percent))


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bits: int = RARITY_BITS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    sets = stored(document_sets(docs, rarity(docs, size, bits), size, percent), "document-sets")
    classes = set_classes(sets)
    part = stored(components(class_links(docs, classes, size, percent)), "jaccard-components")
    members = part.join(classes.select(F.col("cid").alias("node"), "doc_id"), "node")
    least = members.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
    linked = join_counted(part, least, ["component"], "size").select(F.col("node").alias("cid"), "component_id", F.lit(True).alias("linked"))
    named = classes.select("cid", *_SET, "doc_id", "copies").join(linked, "cid", "left").select(
        *_SET, "copies", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    out = join_counted(sets.select("doc_id", *_SET), named, _SET, "copies", how="left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
