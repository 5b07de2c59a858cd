"""The corpus pipeline stage by stage against plain versions, and the registered SQL."""

import re
import tempfile

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from matchlake.llm.common import fold_of
from matchlake.llm.oracle import ORACLE
from matchlake.llm.quality import quality_scores

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "conversations")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_registered():
    queries, sql = E.queries(), E.oracle_sql()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in queries) == 1
    assert "pipeline" in queries and set(ORACLE) <= set(sql) and set(sql) <= set(queries)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash_near_dedup", "decontamination",
                                                           "mixing"]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name == "quality":
            want = {r["doc_id"] for r in quality_scores(docs, labels).collect() if r["predicted"] == 1}
        elif name == "exact_dedup":
            want = {r[1] for r in brute.exact_dedup(before)}
        elif name == "simhash_near_dedup":
            want = set(brute.components([(i, brute.fingerprint(t)) for i, t in before]).values())
        elif name == "decontamination":
            want = {r[0] for r in brute.contamination(before, items) if not r[-1]}
        else:
            want = None
        out = stage(spark, docs, SF)
        path = tempfile.mkdtemp() + "/out"
        out.write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns[:len(columns)] == columns
        got = [r["doc_id"] for r in after.collect()]
        assert len(got) == len(set(got)) and set(got) <= {i for i, _ in before}
        if want is not None:
            assert after.columns == columns and set(got) == want, name
            assert rows(after) == rows(docs.filter(F.col("doc_id").isin(list(want))))      # rows pass unchanged
        else:
            sizes = {i: len(brute.words(t)) for i, t in before}
            assert all(r["mix_size"] == sizes[r["doc_id"]] and 1 <= r["mix_repeats"] <= 3
                       and r["mix_taken"] == r["mix_size"] * r["mix_repeats"] for r in after.collect())
        docs = after
    assert rows(corpus_pipeline.run(spark, SF)) == rows(docs)


def test_stages_on_awkward_rows(spark):
    """Nulls, empty and repeated rows, an empty table, clashing extra columns."""
    from test_operators import frame
    for docs in (frame(spark), frame(spark).filter("false")):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES:
            path = tempfile.mkdtemp() + "/out"
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            assert docs.columns[:len(columns)] == columns


def test_folds(spark):
    import zlib
    got = dict(spark.range(50).select("id", fold_of("id", 5)).collect())
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(50)}


def _plain(v):
    return f"{v:.9g}" if isinstance(v, float) else "∅" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, rel = E.queries()[name](spark, SF), con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    assert sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect()) == \
        sorted(tuple(_plain(r[i]) for i in at) for r in rel.fetchall())


def test_nothing_reads_text_prefixes():
    """The operators hold no limits on rows or text (a guard against slips)."""
    import pathlib
    for path in pathlib.Path(corpus_pipeline.__file__).with_name("matchlake").joinpath("llm").glob("*.py"):
        code = path.read_text()
        assert not re.search(r"\.sample\(|localCheckpoint|crossJoin", code), path
