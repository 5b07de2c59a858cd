"""Substring dedup with prefix-partitioned suffix trees.

A window is 50 consecutive words.  A word goes if a window over it also starts
in a document with a smaller id.  Only suffixes that start a window matter,
and only their first 50 words, read as three symbols: fingerprints of the
words [0, 16), [16, 32) and [32, 50).

1. *Which suffixes can repeat.*  Of each window the smallest hash of its
   20-word runs is its anchor; equal windows have equal anchors.  Neighbouring
   windows with one anchor form a stretch (16 windows on average).  Anchors
   that occur in two documents (a map-side combined minimum and maximum of the
   ids) fill a Bloom filter of fixed size; a false positive only costs work.
2. *Equal stretches.*  Stretches whose anchor passes are compared as a whole,
   by the fingerprint of all their words: of equal ones only the smallest
   document's goes on, the others are removed at once - first within a task's
   portion, then by a grouped minimum over all.  A passage that a third of all
   documents share thus sends one row per portion.
3. *Suffixes.*  What goes on and shares its anchor with a different stretch
   (the edges of a passage, mostly) is marked in a second Bloom filter, and
   one more pass emits those stretches' suffixes.
4. *Prefix partition.*  Suffixes are counted by their first symbol; a prefix
   of more than ``GROUP`` suffixes is extended by the second, then the third
   symbol, so that groups fit in memory and spread over tasks.
5. *Subtrees.*  Each task walks its groups' suffixes in lexicographic order -
   the leaves of the subtree from left to right.  The number of symbols that
   neighbours share is the depth of the node above both; a node at full depth
   (50 words) is a repeat, and every leaf under it beyond its smallest
   document is removed.  The walk keeps one leaf, however large the node.
6. Removed stretches are gathered per document and the kept words are hashed.

Fingerprints are 64-bit polynomials of 64-bit word hashes; a suffix is equal
when its three symbols are, a stretch when its anchor, length, fingerprint and
a second hash, of its bytes, are.  A row is named by its id and a hash of its text.

Defined results: a null text has no words; a null doc_id is larger than any
other (and equal to itself); rows that repeat an id do not remove one
another's windows; texts below 50 words stay whole.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import map_batches, stored, text_bytes

WINDOW = 50
RUN = 20                 # words of an anchor run
CUTS = (0, 16, 32)       # where the symbols of a window start
GROUP = 200_000          # suffixes of a prefix before it is extended
PORTION = 1 << 20        # suffixes that a task settles at a time
FILTER_BITS = 27         # Bloom filter of 2^27 bits = 16 MB, whatever the input
PROBES = 3
NO_ID = (1 << 63) - 1
# What two equal stretches have in common.
STRETCH = ["form", "proof", "anchor", "n"]

_BASE = 0x9E3779B97F4A7C15 | 1


# ---------------------------------------------------------------- fingerprints

@functools.cache
def _power_table(n: int, inverse: bool) -> np.ndarray:
    p = np.full(n, pow(_BASE, -1, 1 << 64) if inverse else _BASE, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    return _power_table(1 << max(14, n.bit_length()), inverse)[:n]


def _stir(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 7)
        return h


def prefix_sums(words: list[bytes], memo: Words) -> np.ndarray:
    """Polynomial sums of the word hashes: entry i covers the first i words."""
    n = len(words)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    out = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(h * _powers(n), out=out[1:])
    return out


def runs(sums: np.ndarray, size: int, starts: slice | np.ndarray, shift: int = 0) -> np.ndarray:
    """Fingerprints of the ``size`` words that start ``shift`` behind each start."""
    at = np.arange(len(sums))[starts] + shift
    with np.errstate(over="ignore"):
        return _stir((sums[at + size] - sums[at]) * _powers(len(sums), True)[at])


def anchors(sums: np.ndarray) -> np.ndarray:
    """For each window, the smallest fingerprint of its runs."""
    n = len(sums) - 1
    low = runs(sums, RUN, slice(0, n - RUN + 1))
    # sliding minimum over WINDOW - RUN + 1 = 31 runs, by doubling
    span, width = WINDOW - RUN + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:len(low) - (span - width)], low[span - width:])


def stretches(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, first windows and numbers of windows of a text's stretches."""
    each = anchors(sums)
    start = np.flatnonzero(np.concatenate([[True], each[1:] != each[:-1]]))
    return each[start], start, np.diff(np.append(start, len(each)))


def _texts(batches, memo: Words):
    """(key, row, prefix sums, words) of every text that has a window."""
    for batch in batches:
        for key, row, text in zip(batch["key"].to_pylist(), batch["row"].to_pylist(), batch["text"]):
            words = text.as_py().split()
            if len(words) >= WINDOW:
                yield key, row, prefix_sums(words, memo), words


# --------------------------------------------------------------------- filters

def _probes(hashes: np.ndarray) -> list[np.ndarray]:
    """Bit places of unsigned 64-bit hashes in a filter."""
    mask = np.uint64((1 << FILTER_BITS) - 1)
    with np.errstate(over="ignore"):
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return [(hashes + np.uint64(i) * step) & mask for i in range(PROBES)]


def bloom_filter(hashes: DataFrame) -> np.ndarray:
    """The Bloom filter of column ``h`` as 64-bit words: at most 2^21 of them reach the driver."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        places = np.unique(np.concatenate(_probes(batch["h"].to_numpy(zero_copy_only=False).view(np.uint64))))
        return pa.RecordBatch.from_arrays(
            [pa.array((places >> np.uint64(6)).astype(np.int32)),
             pa.array((np.uint64(1) << (places & np.uint64(63))).view(np.int64))], ["word", "bits"])

    words = map_batches(hashes, run, "word int, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def passes(hashes: np.ndarray, filter_words: np.ndarray) -> np.ndarray:
    ok = np.ones(len(hashes), bool)
    for place in _probes(hashes):
        ok &= (filter_words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return ok


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """h: the anchors that occur in two documents."""
    def run(batches):
        memo, parts, held = Words(), [], 0
        for key, _, sums, _ in _texts(batches, memo):
            a = np.unique(stretches(sums)[0])
            parts.append((a, np.full(len(a), key, np.int64)))
            held += len(a)
            if held >= PORTION:
                yield _columns(parts, ["h", "key"])
                parts, held = [], 0
        if parts:
            yield _columns(parts, ["h", "key"])

    return (rows.mapInArrow(run, "h bigint, key bigint").groupBy("h")
            .agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo < hi").select("h"))


def _columns(parts: list, names: list[str]) -> pa.RecordBatch:
    cols = [np.concatenate(c) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in cols], names)


# ------------------------------------------------------------- equal stretches

def _fold(row: int | np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hash of a stretch's place (its row and first window)."""
    with np.errstate(over="ignore"):
        return _stir(np.asarray(row, np.int64).view(np.uint64) + start.astype(np.uint64) * np.uint64(_BASE))


def open_stretches(rows: DataFrame, filter_words: np.ndarray) -> DataFrame:
    """anchor, form and proof (two hashes of the whole stretch: of its words'
    hashes, and of its bytes), key, row, start, n, place, settled: the
    stretches whose anchor passes; ``settled`` ones have an equal stretch
    in a smaller document of the same portion."""
    shared = rows.sparkSession.sparkContext.broadcast(filter_words)
    names = ["anchor", "form", "key", "row", "start", "n", "place", "proof"]

    def settle(parts: list) -> pa.RecordBatch:
        cols = [np.concatenate(c) for c in zip(*parts)]
        same = [cols[names.index(c)] for c in STRETCH]
        order = np.lexsort((cols[2], *same))
        cols, same, key = [c[order] for c in cols], [c[order] for c in same], cols[2][order]
        fresh = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in same], axis=0)])
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
        batch = _columns([cols], names)
        return batch.append_column("settled", pa.array(key > key[head]))

    def run(batches):
        memo, parts, held = Words(), [], 0
        for key, row, sums, said in _texts(batches, memo):
            anchor, start, n = stretches(sums)
            here = passes(anchor, shared.value)
            if not here.any():
                continue
            anchor, start, n = anchor[here], start[here], n[here]
            with np.errstate(over="ignore"):
                words = (sums[start + n + WINDOW - 1] - sums[start]) * _powers(len(sums), True)[start]
                form = _stir(_stir(words) + anchor * np.uint64(_BASE) + n.astype(np.uint64))
            parts.append((anchor, form, np.full(len(n), key, np.int64), np.full(len(n), row, np.int64),
                          start.astype(np.int32), n.astype(np.int32), _fold(row, start),
                          np.array([xxhash.xxh3_64_intdigest(b" ".join(said[a:a + m + WINDOW - 1]), 3) for a, m in zip(start.tolist(), n.tolist())], np.uint64)))
            held += len(n)
            if held >= PORTION:
                yield settle(parts)
                parts, held = [], 0
        if parts:
            yield settle(parts)

    return rows.mapInArrow(run, "anchor bigint, form bigint, key bigint, row bigint, start int, n int, place bigint, "
                                "proof bigint, settled boolean")


def compare_stretches(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(removed: key, row, start, n; places of those that go on to their suffixes)."""
    open_ = found.filter(~F.col("settled"))
    forms = open_.groupBy(*STRETCH).agg(F.min("key").alias("least"))
    compared = open_.join(forms, STRETCH)
    removed = found.filter("settled").select("key", "row", "start", "n").unionByName(
        compared.filter("key > least").select("key", "row", "start", "n"))
    whole = F.struct("form", "proof", "n")
    mixed = open_.groupBy("anchor").agg(F.min(whole).alias("lo"), F.max(whole).alias("hi")).filter("lo < hi").select("anchor")
    go_on = compared.filter("key = least").join(mixed, "anchor", "left_semi").select(F.col("place").alias("h"))
    return removed, go_on


# -------------------------------------------------------------------- suffixes

_SUFFIX = "s1 bigint, s2 bigint, s3 bigint, key bigint, row bigint, start int, settled boolean"


def _settle(cols: list[np.ndarray]) -> pa.RecordBatch:
    """Of equal windows in a portion, those beyond the smallest document are
    settled (removed); the smallest document's stay open."""
    order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
    s1, s2, s3, key, row, start = (c[order] for c in cols)
    same = np.zeros(len(s1), bool)
    same[1:] = (s1[1:] == s1[:-1]) & (s2[1:] == s2[:-1]) & (s3[1:] == s3[:-1])
    head = np.maximum.accumulate(np.where(~same, np.arange(len(s1)), 0))
    return pa.RecordBatch.from_arrays(
        [pa.array(s.view(np.int64)) for s in (s1, s2, s3)]
        + [pa.array(key), pa.array(row), pa.array(start), pa.array(key > key[head])],
        ["s1", "s2", "s3", "key", "row", "start", "settled"])


def suffixes(rows: DataFrame, filter_words: np.ndarray) -> DataFrame:
    """The suffixes of the stretches whose place passes, with their symbols."""
    shared = rows.sparkSession.sparkContext.broadcast(filter_words)
    ends = (*CUTS[1:], WINDOW)

    def run(batches):
        memo, parts, held = Words(), [], 0
        for key, row, sums, _ in _texts(batches, memo):
            _, start, n = stretches(sums)
            here = passes(_fold(row, start), shared.value)
            if not here.any():
                continue
            start, n = start[here], n[here]
            at = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            parts.append([*(runs(sums, e - c, at, c) for c, e in zip(CUTS, ends)),
                          np.full(len(at), key, np.int64), np.full(len(at), row, np.int64), at.astype(np.int32)])
            held += len(at)
            if held >= PORTION:
                yield _settle([np.concatenate(c) for c in zip(*parts)])
                parts, held = [], 0
        if parts:
            yield _settle([np.concatenate(c) for c in zip(*parts)])

    return rows.mapInArrow(run, _SUFFIX)


# ------------------------------------------------------------ prefix partition

def prefix_groups(open_: DataFrame, group: int = GROUP) -> DataFrame:
    """``open_`` with ``prefix``: a hash of as many symbols as it takes for a
    group of at most ``group`` suffixes (the full window if it must be)."""
    def heavy(symbols: list[str], name: str) -> DataFrame:
        # at most (all suffixes / group) prefixes, written down so that Spark knows their size when it joins them
        return stored(open_.groupBy(*symbols).count().filter(F.col("count") > group).select(*symbols, F.lit(True).alias(name)),
                      "heavy-prefixes")

    first, second = heavy(["s1"], "more1"), heavy(["s1", "s2"], "more2")
    return (open_.join(first, "s1", "left").join(second, ["s1", "s2"], "left")
            .withColumn("prefix", F.when(F.col("more2"), F.xxhash64("s1", "s2", "s3"))
                        .when(F.col("more1"), F.xxhash64("s1", "s2")).otherwise(F.col("s1"))).drop("more1", "more2"))


def deep_nodes(grouped: DataFrame) -> DataFrame:
    """Walk each group's leaves in order; (key, row, start) of those that are removed."""
    def run(batches):
        last = None      # symbols of the leaf before, and the smallest document of its full-depth node
        for batch in batches:
            cols = [batch[c].to_numpy(zero_copy_only=False) for c in ("s1", "s2", "s3", "key")]
            s1, s2, s3, key = cols
            n = len(s1)
            # depth (in symbols) of the node above each leaf and the one before it
            depth = np.zeros(n, np.int64)
            for d, s in enumerate((s1, s2, s3)):
                depth[1:] += (depth[1:] == d) & (s[1:] == s[:-1])
            joined = last is not None and (s1[0], s2[0], s3[0]) == last[0]
            depth[0] = 3 if joined else 0
            first = np.maximum.accumulate(np.where(depth < 3, np.arange(n), -1))
            least = np.where(first >= 0, key[np.maximum(first, 0)], last[1] if joined else 0)
            gone = key > least
            last = ((s1[-1], s2[-1], s3[-1]), least[-1])
            if gone.any():
                yield batch.select(["key", "row", "start"]).filter(pa.array(gone))

    return (grouped.repartition("prefix").sortWithinPartitions("prefix", "s1", "s2", "s3", "key")
            .select("s1", "s2", "s3", "key", "row", "start").mapInArrow(run, "key bigint, row bigint, start int"))


# -------------------------------------------------------------------- operator

def _keep(words: list[bytes], removed: list[dict] | None) -> tuple[int, list[bytes]]:
    """Number of removed words, and the kept ones."""
    if not removed:
        return 0, words
    edge = np.zeros(len(words) + 1, np.int64)
    start = np.array([r["start"] for r in removed])
    np.add.at(edge, start, 1)
    np.add.at(edge, start + np.array([r["n"] for r in removed]) + WINDOW - 1, -1)
    kept = np.cumsum(edge[:-1]) == 0
    return int(len(words) - kept.sum()), [words[i] for i in np.flatnonzero(kept)]


def substring_dedup(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (its words joined
    by one space, as bytes), removed (array of first window and number of windows)."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    rows = text_bytes(docs, key.alias("key"), F.xxhash64("doc_id", "text").alias("row"))
    keyed = rows.select("key", "row", "text")
    repeated = stored(repeated_anchors(keyed), "repeated-anchors")
    found = stored(open_stretches(keyed, bloom_filter(repeated)), "stretches")
    removed, go_on = compare_stretches(found)
    deep = stored(suffixes(keyed, bloom_filter(go_on)), "suffixes")
    one = F.lit(1).alias("n")
    gone = removed.unionByName(deep.filter("settled").select("key", "row", "start", one)).unionByName(
        deep_nodes(prefix_groups(deep.filter(~F.col("settled")).drop("settled"), group)).select("key", "row", "start", one))
    spans = gone.groupBy("key", "row").agg(F.collect_set(F.struct("start", "n")).alias("removed"))      # within one document

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(batch["text"], batch["removed"].to_pylist()):
            words = text.as_py().split()
            n, left = _keep(words, spans)
            n_words.append(len(words))
            n_removed.append(n)
            kept.append(b" ".join(left))
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()),
             batch["removed"]], ["doc_id", "n_words", "n_removed", "kept", "removed"])

    return map_batches(rows.select("doc_id", "key", "row", "text").join(spans, ["key", "row"], "left").select("doc_id", "text", "removed"), run,
                       "doc_id bigint, n_words bigint, n_removed bigint, kept binary, removed array<struct<start:int,n:int>>")


def kept_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
