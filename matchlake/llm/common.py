"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.index import with_row_index
from matchlake.session import scratch_dir

# The characters [\x20\x09-\x0D], as a Java/DuckDB character class body.
SPACES = " \\t-\\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read by Spark (the folder may be any store Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage, fixes every value, and survives a lost executor."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more: all that was
    derived from them has been written down itself."""
    for table_ in tables:
        context = table_.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table_._scratch_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(df: DataFrame, *cols: str) -> DataFrame:
    """doc_id (+ ``cols``) and the text as UTF-8 bytes; a null text is empty.
    ``bytes.split()`` then splits on exactly [\\x20\\x09-\\x0D] and
    ``bytes.lower()`` touches exactly A-Z."""
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), *cols, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def fold_of(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (a null id is in no fold: null)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")),
                  F.lit(folds))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch (None: no rows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def kept_documents(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id occurs in ``keep.doc_id`` (null matches
    null); columns and their order stay."""
    ids = keep.select(F.col("doc_id").alias("_keep_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_keep_id"]), "left_semi")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int) -> DataFrame:
    """doc_id, text (bytes), label of about ``bound`` labelled training rows at
    most, chosen by a hash of the id.  ``train`` is a condition on doc_id;
    rows without an id or a label are left out; of repeated labels the largest
    counts.  The chosen ids (two numbers each, ``bound`` of them) are broadcast."""
    rows = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).filter(train)
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    total = rows.count()
    share = int(min(1.0, bound / max(total, 1)) * (1 << 20))
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1 << 20)) < share)
    return text_bytes(docs).join(F.broadcast(chosen), "doc_id")


# Rows of one group that a task meets under one key; larger groups get one key for each block of so many rows.
BLOCK = 4096


def indexed_groups(rows: DataFrame, group: str, order: list, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Positions in groups of any size, without sorting a group in one task.

    Returns ``rows`` with ``g`` (place of the row in the order of the group,
    null first, then ``order``, from 0, over the whole table), ``group_no``
    (place of the group), ``first_g`` and ``group_n``; and the groups
    themselves.  The index is the distributed one; each group's numbers are
    joined back once for every block of ``block`` rows, so that no join key
    holds more rows than that."""
    numbered = with_row_index(rows, [F.col(group).asc_nulls_first(), *order], "g", 0)
    sizes = numbered.groupBy(group).agg(F.count(F.lit(1)).alias("group_n"), F.min("g").alias("first_g"))
    groups = stored(with_row_index(sizes, ["first_g"], "group_no", 0), "groups")
    at = lambda c: F.floor(c / F.lit(block)).cast("bigint")
    copies = groups.withColumn("_block", F.explode(F.sequence(at(F.col("first_g")), at(F.col("first_g") + F.col("group_n") - 1))))
    left, right = numbered.withColumn("_block", at(F.col("g"))).alias("l"), copies.alias("r")
    joined = left.join(right, (F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}"))) & (F.col("l._block") == F.col("r._block")))
    return joined.select("l.g", *[F.col(f"l.`{c}`") for c in rows.columns], "r.group_no", "r.first_g", "r.group_n"), groups


def join_counted(rows: DataFrame, table: DataFrame, on: list[str], count: str, many: int = BLOCK, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (one row a key) on ``on``, where ``count``
    says how many of ``rows`` have the key.  Keys with more than ``many`` are
    at most 1/``many`` of the rows; they are written down and joined first, by
    their size, so that the shuffled join has no key with more rows than that.
    ``how`` is inner or left; ``count`` is dropped."""
    added = [c for c in table.columns if c not in on and c != count]
    wide = stored(table.filter(F.col(count) > many).select(*on, *added, F.lit(True).alias("_wide")), "wide-keys")
    marked = rows.join(wide, on, "left")
    rest = marked.filter(F.col("_wide").isNull()).drop("_wide", *added)
    others = rest.join(table.filter(F.col(count) <= many).select(*on, *added), on, how)
    return marked.filter(F.col("_wide").isNotNull()).drop("_wide").unionByName(others)
