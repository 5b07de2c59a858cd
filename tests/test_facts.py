"""Fact-table scenarios (FIXTURES.md §4) on small typed frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchlake.operators import facts, index, people, reports, star
from matchlake.operators.index import surrogate_keys, with_row_index
from matchlake.plans import standins
from matchlake.schemas import DELIVERIES, LEAGUES, MATCH_INFO, PEOPLE_RAW, PROFILES_RAW, REGISTRY


def deliveries_rows():
    base = dict(match_id="m1", innings="1st innings", batting_team="Royal Challengers Bengaluru",
                bowling_team="Royal Challengers Bengaluru Women", declared=0, delivery=0.1, batter="Alpha Unique",
                bowler="Bravo", non_striker="Charlie", batter_runs=4, extra_runs=0, total_runs=4,
                wicket_type=None, player_out=None)
    rows = [base,
            dict(base, delivery=0.2, batter="Delta", batter_runs=6, total_runs=6, wicket_type="bowled",
                 player_out="Delta"),
            dict(base, match_id="m2", delivery=0.1, batting_team="Z", batter="Echo", batter_runs=None,
                 total_runs=None),
            dict(base, match_id="m3", delivery=1.3)]  # m3 has no match info
    return [tuple(r[f.name] for f in DELIVERIES.fields) for r in rows]


@pytest.fixture(scope="module")
def inputs(spark):
    d = spark.createDataFrame(deliveries_rows(), DELIVERIES)
    mi = spark.createDataFrame([
        ("m1", "Leeds", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2), "ODM", "male", "U1", "U2", "runs", 5.0,
         "Royal Challengers Bengaluru", "Alpha Unique", "Royal Challengers Bengaluru", "Other", "bat",
         "Other", "Ground"),
        ("m2", None, dt.datetime(2020, 2, 1), dt.datetime(2020, 2, 1), "ODM", "female", None, None, None, 0.0,
         None, "Echo", "X", "Y", None, None, None),
    ], MATCH_INFO)
    reg = spark.createDataFrame([
        ("m1", "Alpha", "p1"), ("m1", "Bravo", "p2"), ("m1", "Charlie", "p3"), ("m1", "Delta", "p4"),
        ("m2", "Echo", "p5"), ("m2", "Bravo", "p2")], REGISTRY)
    ppl = spark.createDataFrame([
        ("p1", 11, "Alpha Register", "Alpha Unique"),   # unique name differs from in-file name
        ("p2", 12, "Bravo Register", "Bravo"),          # has a profile
        ("p3", None, "Charlie Register", "Charlie"),    # no profile key
        ("p4", 14, "Delta Register", "Delta"),          # two profiles share key 14
        ("p5", 15, "Echo Register", "Echo Other"),      # unique name differs: stays unresolved
    ], PEOPLE_RAW)
    prof = spark.createDataFrame([(12, "Bravo Profile", "R", "fast"), (14, "Delta A", "L", None),
                                  (14, "Delta B", "L", None)], PROFILES_RAW)
    lg = spark.createDataFrame([("Royal Challengers Bangalore", "IPL International"),
                                ("X", "Domestic")], LEAGUES)
    names = people.resolve_people(reg, ppl, prof)
    return d, mi, names, lg


def test_person_names_precedence(inputs):
    _, _, names, _ = inputs
    got = {(r["match_id"], r["person_unique_name"]): r["person_name"] for r in names.collect()}
    assert got[("m1", "Bravo")] == "Bravo Profile"        # profile wins
    assert got[("m1", "Charlie")] == "Charlie Register"   # null key: register name
    assert got[("m1", "Alpha Unique")] == "Alpha Register"
    assert sorted(r["person_name"] for r in names.collect() if r["person_unique_name"] == "Delta") == [
        "Delta A", "Delta B"]                             # duplicate profiles fan out and survive distinct


def test_fact_table(spark, inputs):
    d, mi, names, lg = inputs
    fact = facts.build_fact_table(d, mi, names, lg)
    rows = fact.collect()
    assert {r["match_id"] for r in rows} == {"m1", "m2"}          # m3 dropped by the inner join
    assert fact.columns[:3] == ["delivery_id", "match_id", "innings_id"] and fact.columns[-1] == "league"
    assert not any(c.startswith("missing_") for c in fact.columns)
    m1 = [r for r in rows if r["match_id"] == "m1"]
    first = [r for r in m1 if r["delivery"] == 0.1][0]
    assert first["batter"] == "Alpha Register" and first["batter_id"] == "p1"
    assert first["bowler"] == "Bravo Profile" and first["four"] == 1 and first["six"] == 0
    assert first["player_out"] is None and first["player_out_id"] is None
    # whole-value replacement in every string column, not substrings
    assert first["batting_team"] == "Royal Challengers Bangalore"
    assert first["bowling_team"] == "Royal Challengers Bengaluru Women"
    assert first["match_type"] == "ODI" and first["league"] == "IPL International"
    assert first["match_start_date"] == dt.date(2020, 1, 1)
    assert first["player_of_match"] == "Alpha Unique"           # raw name kept (SURVEY Q2)
    # Delta's two profile names fan the wicket ball out: both as batter and as player out
    wicket = [r for r in m1 if r["delivery"] == 0.2]
    assert len(wicket) == 4 and {r["batter"] for r in wicket} == {"Delta A", "Delta B"}
    assert all(r["wickets"] == 1 and r["six"] == 1 for r in wicket)
    m2 = [r for r in rows if r["match_id"] == "m2"][0]
    assert m2["batter"] == "Echo" and m2["batter_id"] is None and m2["six"] == 0 and m2["four"] == 0
    assert m2["match_type"] == "ODM" and m2["league"] is None  # no league: unchanged
    ids = sorted({r["delivery_id"] for r in rows})
    assert ids == [1, 2, 3]                                     # m3's id (4) went with its row


def test_resolve_player_of_match_option(inputs):
    d, mi, names, lg = inputs
    fact = facts.build_fact_table(d, mi, names, lg, resolve_player_of_match=True)
    assert {r["player_of_match"] for r in fact.filter("match_id = 'm1'").collect()} == {"Alpha Register"}


def test_missing_flags_and_report(spark, inputs):
    d, _, names, _ = inputs
    flagged = facts.delivery_projection(facts.add_ball_features(
        facts.resolve_roles(facts.add_innings_id(facts.add_delivery_id(d)), names)))
    r = reports.missing_name_report(flagged).collect()[0]
    # the wicket ball fans out 2 x 2 (Delta's two profile names as batter and
    # as player out): 3 single rows + 4
    assert r["rows"] == 7 and r["missing_player_out"] == 3
    # m2's Echo and m3's Alpha Unique are unresolved batters
    assert r["missing_batter"] == 2


def test_row_index_matches_row_number(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    keys = li.columns
    got = with_row_index(li, keys, "rid")
    from pyspark.sql import Window
    ref = li.withColumn("rid", F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in keys]))
                        .cast("bigint"))
    assert got.count() == li.count()
    assert sorted(r["rid"] for r in got.collect()) == list(range(1, li.count() + 1))
    assert got.exceptAll(ref.select(got.columns)).isEmpty()


def test_surrogate_keys(spark):
    df = spark.range(50).select((F.col("id") * 7 % 50).alias("v")).repartition(6)
    assert sorted((r["v"], r["sk"]) for r in surrogate_keys(df, ["v"], "sk").collect()) == [(v, v + 1) for v in range(50)]


def test_running_offsets(spark):
    from matchlake.operators.index import running_offsets
    df = spark.createDataFrame([(f"{i:03d}", i % 4) for i in range(60)], "k string, n bigint").repartition(7)
    got = {r["k"]: r["at"] for r in running_offsets(df, ["k"], "n", "at", first=10).collect()}
    want, at = {}, 10
    for i in range(60):
        want[f"{i:03d}"] = at
        at += i % 4
    assert got == want


def test_star_schema(spark, inputs):
    d, mi, names, lg = inputs
    fact = facts.build_fact_table(d, mi, names, lg)
    hashed = star.with_hash_keys(fact)
    assert "batter_id" not in hashed.columns and "player_out_hash" in hashed.columns
    dims = star.dimensions(hashed)
    po = dims["player_out"].collect()
    assert any(r["player_out"] is None for r in po)     # nulls form one dimension member
    joined = star.star_join(hashed, dims)
    # One id seen with two names gives two dimension rows with one hash, so the
    # 4 fanned-out wicket rows join 2 x 2 dimension rows each.
    assert fact.count() == 6 and joined.count() == 2 + 4 * 4
    assert joined.filter(F.col("player_out_sk").isNull()).isEmpty()
    assert not any(c.endswith("_hash") for c in joined.columns)


def test_dimension_table_keys_follow_the_hash(spark, inputs):
    d, mi, names, lg = inputs
    hashed = star.with_hash_keys(facts.build_fact_table(d, mi, names, lg))
    rows = star.dimension_table(hashed).collect()
    for dim in star.HASH_SOURCES:
        members = sorted((r["member_hash"], r["member"] or "", r["sk"]) for r in rows if r["dimension"] == dim)
        assert [m[2] for m in members] == list(range(1, len(members) + 1))


def _rows(df):
    return sorted((tuple("" if v is None else str(v) for v in r) for r in df.collect()))


def test_salted_hot_matches_give_the_same_fact(inputs):
    d, mi, names, lg = inputs
    plain = facts.build_fact_table(d, mi, names, lg)
    salted = facts.build_fact_table(d, mi, names, lg, rows_per_task=1)   # every match is "hot"
    assert _rows(plain) == _rows(salted)


def test_resolved_player_of_match_with_hot_matches(inputs):
    d, mi, names, lg = inputs
    plain = facts.build_fact_table(d, mi, names, lg, resolve_player_of_match=True)
    salted = facts.build_fact_table(d, mi, names, lg, resolve_player_of_match=True, rows_per_task=1)
    assert _rows(plain) == _rows(salted)


def test_star_join_moves_no_facts_for_small_dimensions(spark, inputs, monkeypatch):
    """Dimensions are broadcast by their counted rows, whatever Spark guesses; larger ones give the same rows."""
    d, mi, names, lg = inputs
    hashed = star.with_hash_keys(facts.build_fact_table(d, mi, names, lg)).localCheckpoint()
    dims = star.dimensions(hashed)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = star.star_join(hashed, dims)
        plan = small._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == len(dims) and "SortMergeJoin" not in plan
        monkeypatch.setattr(star, "small", lambda keys: False)
        large = star.star_join(hashed, dims)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_leagues_move_no_facts(spark, inputs):
    """The league list is broadcast by its counted rows, whatever Spark guesses; a larger one gives the same rows
    (F9, F11, F12, F14)."""
    d, _, _, lg = inputs
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = facts.join_leagues(d, lg.distinct())
        plan = small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning(batting_team" not in plan
        with pytest.MonkeyPatch.context() as m:
            m.setattr(facts, "LEAGUE_ROWS", 0)
            large = facts.join_leagues(d, lg.distinct())
            assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert _rows(small) == _rows(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_listed_roles_equal_the_joins(spark, inputs, monkeypatch):
    """Names taken from the list of a match give the rows of four joins, whose balls were sorted once per role; repeated
    names are removed behind the same shuffle, and a match of many balls is joined (F15, F16, F17)."""
    d, mi, names, lg = inputs
    twice = names.unionByName(names)
    d = d.unionByName(d.withColumn("match_id", F.lit(None).cast("string"))).unionByName(d.withColumn("batter", F.lit(None).cast("string")))
    d = facts.add_delivery_id(d).localCheckpoint()

    def flagged(names, **more):
        return facts.flagged_deliveries(d, names, **more)[0].drop("_salt")
    listed = flagged(names)
    sorts = [ln for ln in listed._jdf.queryExecution().executedPlan().toString().split("\n") if "Sort [" in ln]
    assert not [ln for ln in sorts if "batter" in ln or "person_unique_name" in ln], sorts
    want = _rows(facts.delivery_projection(facts.add_ball_features(facts.resolve_roles(facts.add_innings_id(d), names))))
    assert len(want) > d.count()            # a ball whose batter and player out have two names each
    assert _rows(listed) == want == _rows(flagged(twice, distinct=False))
    assert _rows(facts.build_fact_table(d, mi, twice, lg, distinct=False)) == _rows(facts.build_fact_table(d, mi, names, lg))
    monkeypatch.setattr(facts, "LISTED_BALLS", 1)
    joined = flagged(twice, distinct=False)
    assert "person_unique_name" in joined._jdf.queryExecution().executedPlan().toString()
    assert _rows(joined) == want


def test_balls_are_numbered_where_they_are_joined(spark, inputs, monkeypatch):
    """Only one narrow row a match is put in order: balls are shuffled once, for numbers and joins together, and written
    nowhere; a large match or balls of no match are ranged as before (F7 to F14)."""
    d, mi, names, lg = inputs
    written = []
    monkeypatch.setattr(index, "stored", lambda df, name, real=index.stored: written.append(df.columns) or real(df, name))
    got = facts.add_delivery_id(d)
    assert not [c for c in written if "innings" in c], written
    want = with_row_index(d, list(d.columns), "delivery_id")
    assert _rows(got) == _rows(want)
    again = d.unionByName(d).withColumn("ball_pos", F.monotonically_increasing_id())
    assert _rows(facts.add_delivery_id(again, offset=7)) == _rows(with_row_index(again, ["match_id", "ball_pos"], "delivery_id", 7))
    none = d.unionByName(d.withColumn("match_id", F.lit(None).cast("string")))
    assert _rows(facts.add_delivery_id(none)) == _rows(with_row_index(none, list(d.columns), "delivery_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = facts.match_sizes(d)
        flagged = facts.flagged_deliveries(facts.add_delivery_id(d, sizes=sizes), names, sizes=sizes, together=True)[0]
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        balls = [ln for ln in plan.split("\n") if "Exchange hashpartitioning(match_id" in ln]
        # balls, first ids, names
        assert len(balls) == 3 and "rangepartitioning" not in plan and "_salt" not in "".join(balls), balls
        fact = facts.build_fact_table(d, mi, names, lg)
        assert "rangepartitioning" not in fact._jdf.queryExecution().executedPlan().toString()
        with monkeypatch.context() as m:
            m.setattr(facts, "LISTED_BALLS", 1)
            ranged = facts.build_fact_table(d, mi, names, lg)
        assert _rows(fact) == _rows(ranged) and "row_number" not in ranged._jdf.queryExecution().logical().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_registry_is_shuffled_once_for_the_people(spark, monkeypatch):
    """Repeated persons of a match are removed behind a shuffle by the person, which the join with the register then
    needs no more; with a person in too many rows it goes by match and person (F7 to F14)."""
    st = standins.Standins(spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def plan():
            names = people.resolve_people(st.registry(), st.people_raw(), st.profiles_raw(), distinct=False)
            return names, [ln for ln in names._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange " in ln]
        names, moved = plan()
        monkeypatch.setattr(standins, "hot_keys", lambda df, keys, real=standins.hot_keys: real(df, keys, 1))
        other, more = plan()
        assert len(more) == len(moved) + 1, (moved, more)
        assert _rows(names) == _rows(other)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
