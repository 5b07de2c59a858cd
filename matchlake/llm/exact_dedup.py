"""Exact dedup with a heavy-hitter split (DataFrame functions only).

1. One pass over the texts makes a narrow table (doc_id, digest, code points,
   row number), written to the shared folder; texts are never shuffled.
2. ``freqItems`` - the Misra-Gries / Karp-Shenker-Papadimitriou summary that
   Spark keeps per partition and merges - names every digest that may hold
   more than ``1 / counters`` of the rows.
3. The candidates' exact counts and winners come from a map-side combined
   aggregate; those that really are frequent (at most ``counters`` by
   construction) are broadcast and their rows resolved without a shuffle.
4. All other digests use an ordinary shuffle, in which no digest holds more
   than ``1 / counters`` of the rows.

Defined results: a null text is the empty text; an empty table gives no rows;
a null doc_id sorts after every other id; of rows that repeat a doc_id *and*
a text, exactly one is kept.  Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import stored

# Misra-Gries counters: digests above 1/512 of all rows are treated as frequent.
COUNTERS = 512

# [\x20\x09-\x0D], each deleted by translate().
_DELETED = " \t\n\x0b\x0c\r"


def _winner() -> F.Column:
    """The row that stays: most code points, then smallest id, then one of the repeated rows."""
    return F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"),
                          F.col("doc_id").alias("id"), F.col("row").alias("row"))).alias("win")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (hex sha-256 of the normalised text), n_points, row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.sha2(F.translate(text, _DELETED, ""), 256).alias("digest"),
                       F.length(text).alias("n_points"), F.monotonically_increasing_id().alias("row"))


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(digests(docs), "digests")
    total = rows.count()
    candidates = rows.stat.freqItems(["digest"], 1.0 / counters).first()[0] or []
    sized = F.count(F.lit(1)).alias("size")
    # isin() of a bounded list: the summary keeps at most ``counters`` digests per merge.
    maybe = F.col("digest").isin(list(candidates))
    heavy = (rows.filter(maybe).groupBy("digest").agg(sized, _winner())
             .filter(F.col("size") * counters > F.lit(total)))
    frequent = stored(heavy, "frequent-digests")

    marked = rows.join(F.broadcast(frequent), "digest", "left")
    hot = marked.filter(F.col("size").isNotNull())
    # digests that are not frequent: grouped and joined back by an ordinary shuffle
    rest = marked.filter(F.col("size").isNull()).drop("size", "win")
    cold = rest.join(rest.groupBy("digest").agg(sized, _winner()), "digest")
    return hot.unionByName(cold).select(
        "doc_id", F.col("win.id").alias("keep_id"), F.col("size").cast("bigint").alias("group_size"),
        (F.col("row") == F.col("win.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``docs`` without the rows that are copies of a kept one; all columns stay.

    The kept (doc_id, digest) pairs are joined back to the rows.  Only where a
    pair itself repeats (the same id and text form twice) are rows compared as
    a whole, so that one of them stays."""
    flags = exact_dedup(docs, counters)
    kept = stored(flags.filter("kept").select(F.col("doc_id").alias("_kid"), F.col("text_sha256").alias("_kd")), "kept")
    pairs = flags.groupBy(F.col("doc_id").alias("_rid"), F.col("text_sha256").alias("_rd")) \
        .agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_rid", "_rd")
    repeated = stored(pairs, "repeated-rows")
    digest = F.sha2(F.translate(F.coalesce(F.col("text"), F.lit("")), _DELETED, ""), 256)
    there = docs.withColumn("_digest", digest)
    out = there.join(kept, there["doc_id"].eqNullSafe(kept["_kid"]) & (there["_digest"] == kept["_kd"]), "left_semi")
    if repeated.isEmpty():
        return out.drop("_digest")
    again = out["doc_id"].eqNullSafe(repeated["_rid"]) & (out["_digest"] == repeated["_rd"])
    once = out.join(repeated, again, "left_anti").drop("_digest")
    # the longest form of the repeated id stays, as in exact_dedup
    longest = (out.join(repeated, again, "left_semi").withColumn("_len", F.length(F.coalesce(F.col("text"), F.lit("")))))
    keys = longest.groupBy(F.col("doc_id").alias("_rid"), F.col("_digest").alias("_rd")).agg(F.max("_len").alias("_max"))
    best = longest.join(keys, longest["doc_id"].eqNullSafe(keys["_rid"]) & (longest["_digest"] == keys["_rd"])
                        & (longest["_len"] == keys["_max"]), "left_semi")
    return once.unionByName(best.dropDuplicates(["doc_id", "_digest"]).drop("_digest", "_len"))
