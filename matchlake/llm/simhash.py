"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprints: 64 bits, one for each bit set in over half of the XXH64 hashes
(seed 42) of the text's word shingles.  Two fingerprints link at ``MAX_BITS``
or fewer differing bits; documents are grouped by reachability over links.

Search.  The binary Golay code (23, 12, 7) is perfect: every 23-bit word is
within 3 bits of exactly one of 4096 codewords.  The *keys* of a word are the
codeword indices of the word and of its 23 one-bit neighbours (one index, or
six); two words that differ in two bits or fewer share a key, for the word
between them decodes into both sets.  A fingerprint is cut into A (23 bits),
B (23) and C (18 = two halves C1, C2).  With at most 3 errors (a, b, c):

* a, b <= 2 and C1 or C2 clean: keys (golay A, golay B, C1) and (golay A, golay B, C2);
* c >= 2, so a + b <= 1: keys (A, golay B) and (golay A, B);
* a = 3 or b = 3, so the rest is clean: keys (B, C) and (A, C).

Those cover every pattern, no key is shorter than 33 bits, and every shared
key is verified by its Hamming distance.

Linking without all pairs.  Of each bucket only its smallest fingerprint is
compared with every other (a star); components of those links are found
first, and a bucket is searched again only between members of different
components.  Copies (equal fingerprints) are one node from the start.

Defined results: a null or empty text has fingerprint 0; fewer words than a
shingle hash as one sequence; repeated rows get a row each; documents without
an id link like others and sort last (their component is null only if no
member has an id).  Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import map_batches, release, stored, text_bytes
from matchlake.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42

_BYTE_BITS = 64


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text (unsigned)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        parts = [joined]
    else:
        ends = list(itertools.accumulate(len(w) + 1 for w in words))   # of word i, with its space
        starts = [0, *ends[:-1]]
        parts = [joined[s:e - 1] for s, e in zip(starts, ends[shingle - 1:])]
    ones, step = np.zeros(_BYTE_BITS, np.int64), 1 << 14
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(parts), step):   # bounded memory for long texts
        h = np.array([digest(p, SEED) for p in parts[at:at + step]], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(parts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, digest (xxhash64 of the text), fp (the fingerprint as a signed bigint)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t.as_py(), shingle) for t in batch["text"]], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["digest"], pa.array(fps.view(np.int64))],
                                          ["doc_id", "digest", "fp"])
    return map_batches(text_bytes(docs, F.xxhash64("text").alias("digest")), run,
                       "doc_id bigint, digest bigint, fp bigint")


# ------------------------------------------------------------------ Golay code

# The generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1 (fixed value).
_GENERATOR = 0xAE3


@functools.cache
def golay_index() -> np.ndarray:
    """For each 23-bit word, the index of the one codeword within 3 bits."""
    codewords = np.zeros(4096, np.int64)
    for bit in range(12):
        codewords[1 << bit:2 << bit] = codewords[:1 << bit] ^ (_GENERATOR << bit)
    table = np.zeros(1 << 23, np.uint16)
    index = np.arange(4096, dtype=np.uint16)
    for errors in range(4):
        for places in itertools.combinations(range(23), errors):
            table[codewords ^ sum(1 << p for p in places)] = index
    return table


def golay_keys(words: np.ndarray) -> np.ndarray:
    """(n, 6) codeword indices of each word and its one-bit neighbours: one
    index repeated, or six different ones."""
    flips = np.concatenate([[0], 1 << np.arange(23)])
    near = np.sort(golay_index()[words[:, None] ^ flips[None, :]].astype(np.int64), axis=1)
    fresh = np.concatenate([np.ones((len(words), 1), bool), near[:, 1:] != near[:, :-1]], axis=1)
    place = np.cumsum(fresh, axis=1) - 1
    keys = np.repeat(near[:, :1], 6, axis=1)
    rows = np.broadcast_to(np.arange(len(words))[:, None], place.shape)
    keys[rows[fresh], place[fresh]] = near[fresh]
    return keys


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``fps``, key) for every bucket of every fingerprint (uint64)."""
    a = (fps >> np.uint64(41)).astype(np.int64)
    b = ((fps >> np.uint64(18)) & np.uint64((1 << 23) - 1)).astype(np.int64)
    c = (fps & np.uint64((1 << 18) - 1)).astype(np.int64)
    ga, gb = golay_keys(a), golay_keys(b)
    n = len(fps)
    pair = ((ga[:, :, None] << 12) | gb[:, None, :]).reshape(n, 36)
    kinds = [(pair << 9) | (c >> 9)[:, None], (pair << 9) | (c & 511)[:, None],
             (a[:, None] << 12) | gb, (ga << 23) | b[:, None],
             ((b << 18) | c)[:, None], ((a << 18) | c)[:, None]]
    keys = np.concatenate([k | (kind << 56) for kind, k in enumerate(kinds)], axis=1)
    place = np.broadcast_to(np.arange(n)[:, None], keys.shape)
    keys = np.sort(keys, axis=1)
    fresh = np.concatenate([np.ones((n, 1), bool), keys[:, 1:] != keys[:, :-1]], axis=1)
    return place[fresh], keys[fresh]


def buckets(distinct: DataFrame) -> DataFrame:
    """fp -> (key, fp) for every key of the fingerprint."""
    def run(batches):
        for batch in batches:
            fps = batch["fp"].to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 4096):
                part = fps[at:at + 4096]
                place, keys = bucket_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[place])], ["key", "fp"])
    return distinct.select("fp").mapInArrow(run, "key bigint, fp bigint")


# --------------------------------------------------------------------- linking

def _near(x: str, y: str, max_bits: int):
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= max_bits


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) fingerprints within ``max_bits`` that connect what is connected."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the bucket keys cover at most {MAX_BITS} bits")
    rows = buckets(distinct)
    heads = rows.groupBy("key").agg(F.min("fp").alias("head"), F.max("fp").alias("last")).filter("head < last")
    # merge joins: Spark sizes the rows of keys by the fingerprints that they are made of, some 60 times too low, and
    # would broadcast them (and their groups) from a driver that cannot hold them
    shared = stored(rows.hint("merge").join(heads, "key").select("key", "fp", "head"), "shared-buckets")
    star = stored(shared.filter((F.col("fp") != F.col("head")) & _near("fp", "head", max_bits))
                  .select(F.col("fp").alias("a"), F.col("head").alias("b")).distinct(), "star-links")
    part = stored(components(star), "star-components")
    # buckets whose members are still apart
    named = shared.join(part, shared["fp"] == part["node"], "left").select(
        "key", "fp", F.coalesce("component", "fp").alias("part"))
    apart = named.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("key")
    open_ = stored(named.join(apart, "key"), "open-buckets")
    release(shared, part)
    left = open_.select("key", F.col("fp").alias("a"), F.col("part").alias("pa"))
    right = open_.select("key", F.col("fp").alias("b"), F.col("part").alias("pb"))
    cross = left.hint("merge").join(right, (left["key"] == right["key"]) & (F.col("pa") < F.col("pb")) & _near("a", "b", max_bits)) \
        .select("a", "b")
    return star.select("a", "b").unionByName(cross)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, digest, component (a fingerprint of the group), fingerprint
    (hex), component_id, kept (true for rows with the component's id)."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    comps = components(links(nodes, max_bits))
    linked = nodes.join(comps, nodes["fp"] == comps["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    least = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stored(linked.join(least, "component").select("fp", "component", "component_id"), "named-fingerprints")
    return fps.join(named, "fp").select(
        "doc_id", "digest", "component", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group; all columns stay.  Of rows
    that repeat the kept id (or have none), the one with the smallest text
    digest stays, and of equal rows one."""
    rows = near_duplicates(docs, shingle, max_bits).filter("kept")
    keep = stored(rows.groupBy("component", F.col("component_id").alias("_keep_id"))
                  .agg(F.min("digest").alias("_keep_digest"), F.count(F.lit(1)).alias("_n")).drop("component"), "kept-documents")
    digest = F.xxhash64(docs["text"])
    same = docs["doc_id"].cast("bigint").eqNullSafe(keep["_keep_id"]) & (digest == keep["_keep_digest"])
    if keep.filter("_n > 1").isEmpty():
        return docs.join(keep, same, "left_semi")
    once = docs.join(keep.filter("_n = 1"), same, "left_semi")
    again = docs.join(keep.filter("_n > 1"), same, "left_semi")
    return once.unionByName(again.withColumn("_d", F.xxhash64("text")).dropDuplicates(["doc_id", "_d"]).drop("_d"))
