"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Sizes are words.  Every document gets a fixed 36-bit hash of its id and text.
A source whose target is ``q * size + r`` takes each document ``q`` times and,
once more, the documents whose hash lies under the source's threshold, chosen
so that those sum to about ``r``.  The threshold is found without sorting any
document: words are summed by (source, 4096 hash buckets), a prefix sum over
the buckets names the boundary bucket, and only that bucket's documents are
summed again by the next 12 hash bits, and again by the last 12.

Defined results: null text has size 0; a null source is a source of its own,
ordered last; a null doc_id hashes as an empty id; rows that repeat an id and
a text share a hash and are taken together; of the boundary hash, the side
nearer to the target is chosen; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.llm.common import SPACES, stored
from matchlake.operators.index import with_row_index

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
_BITS = 12
_LEVELS = 3
_BUCKETS = 1 << _BITS


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source key, size in words, 36-bit hash (``hash``)."""
    return sized_columns(docs).select("doc_id", F.col("_mix_key").alias("skey"), F.col("_mix_size").alias("size"),
                                      F.col("_mix_hash").alias("hash"))


def source_key() -> F.Column:
    """A key that is never null and sorts as sources do: by code point, null last."""
    return F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """skey, source_size, target: one row per source.

    Shares are capped at ``max_repeats`` times the source; the excess of the
    capped ones is shared again by weight until no source is above.  Each
    round is one aggregate over the sources; only two sums reach the driver."""
    sizes = rows.groupBy("skey").agg(F.sum("size").alias("source_size"))
    ranked = with_row_index(sizes, ["skey"], "rank", offset=0)      # however many sources there are
    cycle = F.array(*[F.lit(w) for w in weights])
    per = stored(ranked.select("skey", "source_size", F.element_at(
        cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight")), "sources")
    cap = F.col("source_size") * max_repeats
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level = None
    capped = F.lit(False)
    while True:
        s = per.agg(F.sum(F.when(capped, cap)).alias("fixed"), F.sum(F.when(~capped, F.col("weight"))).alias("open"),
                    F.count(F.when(capped, 1)).alias("n")).first()
        if s["open"] is None:
            break
        new = float(total - (s["fixed"] or 0)) / float(s["open"])
        if new == level:
            break
        level = new
        capped = F.lit(level) * F.col("weight") > cap
    target = F.when(capped, cap.cast("double")).otherwise(F.lit(level) * F.col("weight")) \
        if level is not None else cap.cast("double")
    return per.select("skey", "source_size", target.alias("target"))


def _bucket(level: int) -> F.Column:
    """The 12 hash bits of ``level`` (0: the highest)."""
    return F.shiftright("hash", _BITS * (_LEVELS - 1 - level)).bitwiseAND(F.lit(_BUCKETS - 1))


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """skey, source_size, target, repeats (q), threshold: hashes below it are taken once more."""
    q = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    # ``path``: the hash bits fixed so far; ``left``: words still to take within them.
    at = targets.select("skey", "source_size", "target", q.cast("bigint").alias("repeats"),
                        (F.col("target") - q * F.col("source_size")).alias("left"), F.lit(0).cast("bigint").alias("path"))
    for level in range(_LEVELS):
        prefix = F.shiftright("hash", _BITS * (_LEVELS - level))
        inside = rows.join(at.select("skey", "path"), "skey").filter(prefix == F.col("path")) if level else rows
        hist = inside.groupBy("skey", _bucket(level).alias("bucket")).agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # at most 4096 rows for each source
        cum = hist.select("skey", "bucket", "words", F.sum("words").over(upto).alias("cum"))
        over = (cum.join(at.select("skey", "left"), "skey").filter(F.col("cum") > F.col("left"))
                .groupBy("skey").agg(F.min(F.struct("bucket", "words", "cum")).alias("edge")))
        last = level == _LEVELS - 1
        before = F.col("edge.cum") - F.col("edge.words")
        nearer = (F.col("edge.cum") - F.col("left")) < (F.col("left") - before)
        # no bucket goes over: everything inside is taken
        bucket = F.coalesce(F.col("edge.bucket") + (F.when(nearer, 1).otherwise(0) if last else F.lit(0)),
                            F.lit(_BUCKETS if last else _BUCKETS - 1))
        left = F.when(F.col("edge").isNotNull(), F.col("left") - before).otherwise(F.lit(float("inf")))
        at = stored(at.join(over, "skey", "left").select(
            "skey", "source_size", "target", "repeats", left.alias("left"),
            (F.col("path") * _BUCKETS + bucket).cast("bigint").alias("path")), f"thresholds-{level}")
    return at.select("skey", "source_size", "target", "repeats", F.col("path").alias("threshold"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    rows = stored(sized(docs), "sized")
    limits = thresholds(rows, source_targets(rows, weights, max_repeats))
    times = F.col("repeats") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0)
    times = F.least(times, F.lit(max_repeats))
    return rows.join(limits, "skey").select(
        "doc_id", "size", F.col("source_size").cast("bigint").alias("source_size"), "target",
        (times * F.col("size")).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The documents the mix takes, with all their columns and ``mix_size``,
    ``mix_repeats``, ``mix_taken``; documents taken no time are left out."""
    rows = stored(sized(docs), "sized")
    limits = thresholds(rows, source_targets(rows, weights, max_repeats))
    here = sized_columns(docs)
    limits = limits.select(F.col("skey").alias("_mix_key"), F.col("repeats").alias("_mix_q"),
                           F.col("threshold").alias("_mix_threshold"))
    times = F.least(F.col("_mix_q") + F.when(F.col("_mix_hash") < F.col("_mix_threshold"), 1).otherwise(0),
                    F.lit(max_repeats)).cast("int")
    return (here.join(limits, "_mix_key").withColumn("mix_repeats", times).filter("mix_repeats > 0")
            .select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_mix_size").alias("mix_size"), "mix_repeats",
                    (F.col("mix_repeats") * F.col("_mix_size")).alias("mix_taken")))


def sized_columns(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of :func:`sized` beside its own."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    return docs.withColumns({
        "_mix_key": source_key(), "_mix_size": F.regexp_count(text, F.lit(f"[^{SPACES}]+")).cast("bigint"),
        "_mix_hash": F.conv(F.substring(digest, 1, 9), 16, 10).cast("bigint")})
