"""Benchmark decontamination by a prefix-filtered set join with positions.

A window is ``size`` consecutive words of an item (an item of fewer words, but
not none, is one window).  Containment must be exact, so of a window's words
ordered by rarity the necessary prefix is the single rarest one: a document
that holds the window holds that word.

1. Tasks cut the items into windows; the different windows are one table, the
   (window, item) pairs another, which is joined at the end only.
2. Rarity: one pass over the corpus counts the windows' words; a window's
   rarest word and its place are its prefix.
3. The second pass gives a row for every occurrence of a prefix word, with the
   ``size`` - 1 words before and behind it, where the occurrence stands in a
   run of window words that is long enough for a window.  The rows are joined
   with the windows on the prefix word, the length and positional bounds drop
   those that start before the document or end behind it, and the words decide.
4. Spans are united per document, and the items of its windows listed.

In both passes a bitmap of word hashes (``hashing.MOST_BITS`` bits at most)
tells which words matter before a row is made; it only saves rows.  Prefix
words with many occurrences or many windows are dealt out in tiles, so that no
join key holds more than ``BLOCK`` occurrences and ``max_windows`` windows.
Both passes are made once, however large the benchmark; nothing of it passes
through the driver but the bitmaps.

Defined results: null texts have no words; an empty benchmark hits nothing; a
null item_id hits words but is not listed; repeated documents get a row each;
repeated items count once.  Words of any length and texts of any length are
whole.  Only doc_id and text (item_id and text) are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import BLOCK, map_batches, stored, text_bytes
from matchlake.llm.hashing import bitmap, within, word_hashes

WINDOW = 13
# Windows that one prefix word meets under one join key.
MAX_WINDOWS = 256

# ASCII: A-Z to lower case, everything but letters and digits to a space;
# all bytes of non-ASCII characters stay, so they are word characters.
_FOLD = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
              for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z."""
    return text.translate(_FOLD).split()


# ------------------------------------------------------------------- benchmark

def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, win): the windows of every item, as lists of words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(text)
                last = max(1, len(words) - size + 1) if words else 0
                for at in range(0, last, 4096):
                    wins = [words[i:i + size] for i in range(at, min(at + 4096, last))]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(wins), pa.string()), pa.array(wins, pa.list_(pa.binary()))], ["item_id", "win"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return items.mapInArrow(cut, "item_id string, win array<binary>")


def _hashed(words: DataFrame) -> DataFrame:
    """(word) -> (word, hash), as the passes over the texts hash it."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = [int(h[0]) for h in word_hashes(batch["word"].to_pylist())]
        return pa.RecordBatch.from_arrays([batch["word"], pa.array(np.array(hashes, np.uint64).view(np.int64))], ["word", "hash"])
    return map_batches(words, run, "word binary, hash bigint")


def word_counts(texts: DataFrame, vocabulary: DataFrame, bits: np.ndarray) -> DataFrame:
    """(word, hash, n): how often each word of the vocabulary stands in the corpus."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def totals():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["hash", "n"])

        for batch in batches:
            for words in word_hashes([t.translate(_FOLD) for t in batch["text"].to_pylist()]):
                some = words[within(shared.value, words)]
                held.append(some)
                size += len(some)
                if size > 1 << 21:
                    yield totals()
                    held, size = [], 0
        if size:
            yield totals()

    sums = texts.select("text").mapInArrow(count, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    return vocabulary.join(sums, "hash", "left").select("word", "hash", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


# ------------------------------------------------------------------- documents

_FOUND = "row bigint, doc_id bigint, digest bigint, n_words bigint, word binary, at int, low int, around array<binary>"


def _found(texts: DataFrame, vocabulary: np.ndarray, prefixes: np.ndarray, shortest: int, size: int) -> DataFrame:
    """A row for every document (n_words) and one for every occurrence of a
    prefix word (word, at, and the words around it from ``low`` on), written down."""
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, prefixes))
    types = [*[pa.int64()] * 4, pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.binary())]
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def rows(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def places(hashes: np.ndarray) -> np.ndarray:
        """Prefix words inside runs of window words that are long enough for a window."""
        known, first = shared.value
        edges = np.flatnonzero(np.diff(within(known, hashes).astype(np.int8), prepend=0, append=0))
        starts, ends = edges[0::2], edges[1::2]
        enough = ends - starts >= shortest
        at = np.concatenate([np.arange(s, e) for s, e in zip(starts[enough], ends[enough])]) if enough.any() else np.zeros(0, np.int64)
        return at[within(first, hashes[at])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_, lengths = batch["text"].to_pylist(), []
            for text, row, hashes in zip(texts_, batch["row"].to_pylist(), word_hashes([t.translate(_FOLD) for t in texts_])):
                lengths.append(len(hashes))
                at = places(hashes).tolist()
                words = words_of(text) if at else []
                for k in range(0, len(at), 1024):
                    part = at[k:k + 1024]
                    none = [None] * len(part)
                    yield rows([[row] * len(part), none, none, none, [words[i] for i in part], part, [max(0, i - size + 1) for i in part],
                                [words[max(0, i - size + 1):i + size] for i in part]])
            none = [None] * batch.num_rows
            yield rows([batch["row"], batch["doc_id"], batch["digest"], lengths, none, none, none, none])

    return stored(texts.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "digest", "text").mapInArrow(run, _FOUND), "prefix-occurrences")


def occurrences(texts: DataFrame, windows: DataFrame, size: int = WINDOW, max_windows: int = MAX_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """(documents: row, doc_id, digest, n_words; hits: row, wid, from, to) for
    windows (wid, win).  Texts have doc_id, digest and text (bytes)."""
    words = windows.select("wid", F.posexplode("win").alias("place", "word"))
    vocabulary = stored(_hashed(words.select("word").distinct()), "window-words")
    known = bitmap(vocabulary, "hash")
    counts = stored(word_counts(texts, vocabulary, known), "window-word-counts")
    # the rarest word of each window and its place: the prefix
    rarest = words.join(counts, "word").groupBy("wid").agg(F.min(F.struct("n", "word", "place", "hash")).alias("x"))
    prefix = stored(windows.join(rarest.select("wid", F.col("x.word").alias("word"), F.col("x.place").alias("place"), F.col("x.hash").alias("hash"),
                                               F.col("x.n").alias("n")), "wid"), "window-prefixes")
    shortest = prefix.agg(F.min(F.size("win"))).first()[0] or 1
    found = _found(texts, known, bitmap(prefix.select("hash").distinct(), "hash"), shortest, size)
    here = found.filter("word is not null").select("row", "word", "at", "low", "around")

    # tiles of the words that stand in many windows (``across``) or many texts (``down``)
    across = F.ceil(F.count(F.lit(1)) / F.lit(max_windows)).cast("int").alias("across")
    tiles = stored(prefix.groupBy("word").agg(across, F.ceil(F.max("n") / F.lit(BLOCK)).cast("int").alias("down"))
                   .filter("across > 1 or down > 1"), "hot-prefixes")
    one = lambda c: F.coalesce(c, F.lit(1))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.greatest(one(c), F.lit(1)) - 1))
    wide, tall = one("across"), F.greatest(one("down"), F.lit(1))
    left = here.join(tiles, "word", "left").select("word", "row", "at", "low", "around", F.pmod(F.xxhash64("row", "at"), tall).cast("int").alias("i"), every("across").alias("j"))
    right = prefix.join(tiles, "word", "left").select("word", "wid", "win", "place", every("down").alias("i"), F.pmod(F.xxhash64("wid"), wide).cast("int").alias("j"))
    start = F.col("at") - F.col("place")
    n = F.size("win")
    inside = (start >= F.col("low")) & (start + n <= F.col("low") + F.size("around"))
    same = F.slice("around", F.greatest(start - F.col("low"), F.lit(0)) + 1, n) == F.col("win")
    hits = left.join(right, ["word", "i", "j"]).filter(inside & same).select("row", "wid", start.alias("from"), (start + n).alias("to"))
    return found.filter("n_words is not null").select("row", "doc_id", "digest", "n_words"), stored(hits, "window-hits")


def _merged(starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    out_s, out_e = [], []
    for s, e in sorted(zip(starts, ends)):
        if out_e and s <= out_e[-1]:
            out_e[-1] = max(out_e[-1], e)
        else:
            out_s.append(s)
            out_e.append(e)
    return out_s, out_e


def hit_spans(hits: DataFrame) -> DataFrame:
    """row, starts, ends, n_hit: a document's hit words as spans that do not touch."""
    def merge(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [_merged([x["from"] for x in s], [x["to"] for x in s]) for s in batch["spans"].to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch["row"], pa.array([s for s, _ in spans], pa.list_(pa.int32())), pa.array([e for _, e in spans], pa.list_(pa.int32())),
             pa.array([sum(e) - sum(s) for s, e in spans], pa.int64())], ["row", "starts", "ends", "n_hit"])

    # as many spans as the document has words, at most
    spans = hits.groupBy("row").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    return map_batches(spans, merge, "row bigint, starts array<int>, ends array<int>, n_hit bigint")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, digest
    (xxhash64 of the text), starts, ends (merged spans of hit words), items."""
    texts = text_bytes(docs, F.xxhash64("text").alias("digest"))
    pairs = stored(item_windows(benchmark, size), "item-windows")
    windows = stored(pairs.select("win").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    rows, hits = occurrences(texts, windows, size, max_windows)
    owners = stored(windows.join(pairs.filter("item_id is not null"), "win").select("wid", "item_id").distinct(), "window-items")
    listed = (hits.select("row", "wid").distinct().join(owners, "wid").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    spans = lambda c: F.coalesce(c, F.array().cast("array<int>")).alias(c)
    items = F.coalesce("items", F.array().cast("array<string>"))
    out = rows.join(hit_spans(hits), "row", "left").join(listed, "row", "left")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
                      F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
                      ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"), "digest", spans("starts"), spans("ends"), items.alias("items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents; all columns stay.  The
    contaminated (doc_id, text digest) pairs are removed by an anti join."""
    bad = stored(contamination(docs, benchmark, size).filter("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("digest").alias("_bad_digest")).distinct(), "contaminated")
    # xxhash64 skips nulls, so a null text has a digest too; it has no words and is never contaminated
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"])
                     & (F.xxhash64(docs["text"]) == bad["_bad_digest"]), "left_anti")
