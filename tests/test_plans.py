"""Physical-plan checks: pushdown, pruning, no Python in the hot path,
one shuffle of the delivery side for all role joins."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from matchlake.operators import facts, people
from matchlake.plans.standins import Standins


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_projection_reach_the_scan(spark):
    from matchlake.sources.tables import read_parquet
    li = read_parquet(spark, f"{SF_SMALL}/lineitem.parquet")
    q = li.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_quantity")
    p = plan_text(q)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in p


def test_role_joins_share_one_partitioning(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        st = Standins(spark, SF_SMALL)
        d = st.deliveries().withColumn("delivery_id", F.monotonically_increasing_id())
        names = people.resolve_people(st.registry(), st.people_raw(), st.profiles_raw())
        flagged = facts.flagged_deliveries(d, names)[0]
        p = plan_text(flagged)
        # one exchange for the delivery side and one for the name table; the
        # four role joins add none
        exchanges = [ln for ln in p.split("\n")
                     if "Exchange hashpartitioning(" in ln and "_salt" in ln and "ReusedExchange" not in ln]
        assert len(exchanges) == 2, exchanges
        assert "ReusedExchange" in p
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_extraction_parses_each_text_once(spark):
    from matchlake.operators.extract import extract_match_info, parse_documents
    docs = spark.createDataFrame([("1", '{"info": {"city": "A"}}')], "match_id string, value string")
    p = plan_text(extract_match_info(parse_documents(docs)))
    # acceptance is a generator over one projection: no filter that would
    # repeat the JSON parses inside its predicate
    assert "Filter" not in p and "Generate inline" in p


def test_row_index_keeps_rows_distributed(spark):
    from matchlake.operators.index import with_row_index
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    p = plan_text(with_row_index(li, ["l_orderkey", "l_linenumber"], "rid"))
    # rows are read back from the written, range-partitioned table and joined
    # to broadcast offsets; the only single-partition exchange carries the
    # per-partition counts (one row per partition) into the prefix-sum window
    assert p.count("Exchange SinglePartition") == 1
    assert "BroadcastHashJoin" in p and "Window" in p


def _exchanges(plan):
    return [ln for ln in plan.split("\n") if "Exchange " in ln and "ReusedExchange" not in ln and "Broadcast" not in ln]


def test_match_join_shuffles_matches_once(spark):
    """P23 inside the fact build: match_info is shuffled once, on the joins' own
    key; of the names a narrower copy (two columns) is."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        st = Standins(spark, SF_SMALL)
        d = st.deliveries().withColumn("delivery_id", F.monotonically_increasing_id())
        names = people.resolve_people(st.registry(), st.people_raw(), st.profiles_raw())
        lg = st.leagues()
        p = plan_text(facts.build_fact_table(d, st.match_info(), names, lg))
        salted = [ln for ln in _exchanges(p) if "hashpartitioning(" in ln and "_salt" in ln]
        assert len(salted) == 4, salted          # deliveries, names, match_info, names for the player of the match
        assert not [ln for ln in _exchanges(p) if "hashpartitioning(player_of_match" in ln]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbering_documents_moves_nothing(spark, tmpdir_fresh, monkeypatch):
    """With broadcast joins off, none of a batch's tables shuffles or sorts
    documents or balls on the way from bronze: every job that a batch run writes
    from bronze is planned without an exchange, but the broadcast of one row a range."""
    from matchlake.operators import ingest
    from matchlake.plans.catalogue import stored_documents
    plans = {}
    real = ingest.write_batch

    def write(df, store, name, batch_id):
        plans[name] = plan_text(df)
        real(df, store, name, batch_id)
    monkeypatch.setattr(ingest, "write_batch", write)
    docs = stored_documents(spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ingest.run_batch(spark, docs, ingest.Paths(tmpdir_fresh))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("match_info", "registry", "quarantine"):
        assert "Exchange" not in plans[name] and "Join" not in plans[name] and "Scan parquet" in plans[name], name
    p = plans["deliveries"]
    assert "SortMergeJoin" not in p and "rangepartitioning" not in p and "BroadcastHashJoin" in p
    # what is exchanged are the sums of ranges, below the broadcast
    balls = p[:p.index("BroadcastExchange")]
    assert "Generate posexplode" in balls and "Exchange" not in balls and "Sort " not in balls
    # bronze itself moves documents once, by range
    assert sum("Exchange hashpartitioning(doc_range" in ln for ln in _exchanges(plans["bronze"])) == 1


def test_batch_publishing_finds_hot_matches_without_the_balls(spark):
    from matchlake.operators.skew import hot_keys
    balls = spark.range(30).select((F.col("id") % 4).cast("string").alias("match_id"))
    sizes = balls.groupBy("match_id").agg(F.count(F.lit(1)).alias("n_balls"))
    one, two = (sorted(map(tuple, df.collect())) for df in (hot_keys(balls, ["match_id"], 7), hot_keys(sizes, ["match_id"], 7, "n_balls")))
    assert one == two == [("0", 2), ("1", 2)]


def test_documents_are_built_with_one_narrow_shuffle(spark):
    """Lines and orders are exchanged once, as numbers, and neither joined nor grouped again."""
    from matchlake.plans.match_documents import build
    from matchlake.plans.standins import Standins
    p = plan_text(build(Standins(spark, SF_SMALL)))
    assert len(_exchanges(p)) == 1 and "Join" not in p
    below = p[p.index("Exchange hashpartitioning"):]
    assert "Customer#" not in below and "Aggregate" not in below


def test_deliveries_parse_each_document_once(spark):
    """No filter inferred from the generators repeats the JSON parses below the projections."""
    from matchlake.operators.extract import extract_deliveries, parse_documents
    docs = spark.createDataFrame([("1", "{}")], "match_id string, value string")
    p = plan_text(extract_deliveries(parse_documents(docs), with_positions=False))
    assert not [ln for ln in p.split("\n") if ln.lstrip(" +-*():0123456789").startswith("Filter") and "from_json" in ln]
