"""The match model expressed over the driver's TPC-H-like tables.

Each stand-in is written twice, side by side: as a Spark transform and as the
SQL text the DuckDB oracle runs.  Mapping:

* ``lineitem`` -> deliveries: an order is a match, a line is a ball.
  ball key = quantity - 1 + linenumber / 10, batter/bowler/non-striker are the
  customer names of the part, supplier and part+linenumber keys, a returned
  line of a finished order is a wicket.
* ``orders``   -> match info; teams are 'Team F' / 'Team O'.
* ``lineitem`` + ``orders`` -> registry (every person seen in a match).
* ``customer`` -> people register; ``supplier`` -> player profiles (covers
  keys 0-99 only, so the profile join leaves real nulls).  Customers of the
  BUILDING segment carry a unique name unlike the in-file one (SURVEY Q3).
* ``orders``   -> team -> league list.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import functions as mf
from matchlake.operators.skew import hot_keys

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table scan, as Spark splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _person(key) -> F.Column:
    return F.concat(F.lit("Customer#"), F.lpad(F.col(key).cast("string") if isinstance(key, str)
                                               else key.cast("string"), 9, "0"))


def _sql_person(expr: str) -> str:
    return f"('Customer#' || lpad(CAST({expr} AS VARCHAR), 9, '0'))"


TEAMS = ["Team F", "Team O"]


# ------------------------------------------------------------------ deliveries

def delivery_columns(c: Callable[[str], F.Column]) -> list[F.Column]:
    """The columns of a ball from its line's (``c`` gives one by name: of a row, or of a struct in a list)."""
    wicket = (c("l_returnflag") == "R") & (c("l_linestatus") == "F")
    batting = F.concat(F.lit("Team "), c("l_linestatus"))
    batter_runs = (c("l_linenumber") - 1).cast("bigint")
    extra_runs = F.when(c("l_tax") > 0.04, 1).otherwise(0).cast("bigint")
    return [
        F.when(c("l_returnflag") == "R", "2nd innings").otherwise("1st innings").alias("innings"),
        batting.alias("batting_team"),
        F.when(c("l_linestatus") == "F", F.lit(TEAMS[1])).otherwise(F.lit(TEAMS[0])).alias("bowling_team"),
        mf.yes_flag(F.when(c("l_discount") >= 0.1, F.lit("YES"))).alias("declared"),
        ((c("l_quantity") - F.lit(1.0)) + c("l_linenumber") / F.lit(10.0)).alias("delivery"),
        _person(c("l_partkey")).alias("batter"),
        _person(c("l_suppkey")).alias("bowler"),
        _person(c("l_partkey") + c("l_linenumber")).alias("non_striker"),
        batter_runs.alias("batter_runs"),
        extra_runs.alias("extra_runs"),
        (batter_runs + extra_runs).alias("total_runs"),
        F.when(wicket, F.lit("bowled")).alias("wicket_type"),
        F.when(wicket, _person(c("l_partkey"))).alias("player_out"),
    ]


LINE_COLUMNS = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_returnflag", "l_linestatus"]


def deliveries(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_orderkey").cast("string").alias("match_id"), *delivery_columns(F.col))


DELIVERIES_SQL = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS match_id,
       CASE WHEN l_returnflag = 'R' THEN '2nd innings' ELSE '1st innings' END AS innings,
       'Team ' || l_linestatus AS batting_team,
       CASE WHEN l_linestatus = 'F' THEN 'Team O' ELSE 'Team F' END AS bowling_team,
       CAST(CASE WHEN lower(CASE WHEN l_discount >= 0.1 THEN 'YES' END) = 'yes' THEN 1 ELSE 0 END AS TINYINT) AS declared,
       (l_quantity - 1.0) + l_linenumber / CAST(10.0 AS DOUBLE) AS delivery,
       {_sql_person('l_partkey')} AS batter,
       {_sql_person('l_suppkey')} AS bowler,
       {_sql_person('l_partkey + l_linenumber')} AS non_striker,
       CAST(l_linenumber - 1 AS BIGINT) AS batter_runs,
       CAST(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS BIGINT) AS extra_runs,
       CAST(l_linenumber - 1 AS BIGINT) + CAST(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS BIGINT) AS total_runs,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'bowled' END AS wicket_type,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN {_sql_person('l_partkey')} END AS player_out
FROM lineitem"""


# ------------------------------------------------------------------ match info

def umpires(orders: DataFrame) -> F.Column:
    one = F.array(F.concat(F.lit("Umpire "), F.col("o_orderstatus")))
    two = F.array(F.concat(F.lit("Umpire "), F.col("o_orderstatus")),
                  F.concat(F.lit("Umpire "), F.substring("o_orderpriority", 1, 1)))
    return F.when(F.col("o_orderpriority") == "5-LOW", one).otherwise(two)


def match_info(orders: DataFrame, *more: F.Column) -> DataFrame:
    """One row per order; ``more`` columns follow."""
    ump = umpires(orders)
    return orders.select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("City "), F.col("o_orderstatus"))).alias("city"),
        F.col("o_orderdate").alias("match_start_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("match_end_date"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "ODM").otherwise("T20").alias("match_type"),
        F.when(F.col("o_orderpriority") < "3", "male").otherwise("female").alias("gender"),
        mf.first_of(ump).alias("umpire_1"),
        mf.last_of(ump).alias("umpire_2"),
        F.when(F.col("o_orderstatus") == "F", "runs").when(F.col("o_orderstatus") == "O", "wickets").alias("win_by"),
        F.when(F.col("o_orderstatus").isin("F", "O"), (F.col("o_custkey") % 100).cast("double"))
         .otherwise(F.lit(0.0)).alias("win_margin"),
        F.when(F.col("o_orderstatus") == "F", "Team F").when(F.col("o_orderstatus") == "O", "Team O").alias("winner"),
        _person("o_custkey").alias("player_of_match"),
        F.lit("Team F").alias("team1"),
        F.lit("Team O").alias("team2"),
        F.when(F.col("o_totalprice") > 150000, "bat").otherwise("field").alias("toss_decision"),
        F.when(F.col("o_totalprice") > 100000, "Team F").otherwise("Team O").alias("toss_winner"),
        F.concat(F.lit("Ground "), F.substring("o_orderpriority", 3, 100)).alias("venue"),
        *more,
    )


MATCH_INFO_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS match_id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'City ' || o_orderstatus END AS city,
       o_orderdate AS match_start_date,
       o_orderdate + INTERVAL 1 DAY AS match_end_date,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ODM' ELSE 'T20' END AS match_type,
       CASE WHEN o_orderpriority < '3' THEN 'male' ELSE 'female' END AS gender,
       'Umpire ' || o_orderstatus AS umpire_1,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'Umpire ' || o_orderstatus
            ELSE 'Umpire ' || substr(o_orderpriority, 1, 1) END AS umpire_2,
       CASE o_orderstatus WHEN 'F' THEN 'runs' WHEN 'O' THEN 'wickets' END AS win_by,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_custkey % 100 AS DOUBLE) ELSE 0.0 END AS win_margin,
       CASE o_orderstatus WHEN 'F' THEN 'Team F' WHEN 'O' THEN 'Team O' END AS winner,
       {_sql_person('o_custkey')} AS player_of_match,
       'Team F' AS team1,
       'Team O' AS team2,
       CASE WHEN o_totalprice > 150000 THEN 'bat' ELSE 'field' END AS toss_decision,
       CASE WHEN o_totalprice > 100000 THEN 'Team F' ELSE 'Team O' END AS toss_winner,
       'Ground ' || substr(o_orderpriority, 3, 100) AS venue
FROM orders"""


# ------------------------------------------------------------------ registry

def person_keys(c: Callable[[str], F.Column]) -> list[F.Column]:
    """Batter, bowler and non-striker of a line."""
    return [c("l_partkey"), c("l_suppkey"), c("l_partkey") + c("l_linenumber")]


def person_columns(key: F.Column) -> list[F.Column]:
    return [_person(key).alias("person_name"), F.concat(F.lit("P"), key.cast("string")).alias("person_id")]


def registry(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Everyone seen in a match: batter, bowler and non-striker keys of each
    line (one scan, three entries per line) plus the order's customer.
    Duplicates are removed on the numeric (match, person) keys, before any
    text is built.  That shuffle goes by the person, so that a join on
    ``person_id`` behind it needs no other one, unless some person is in so
    many rows that a task would have too many of them."""
    keys = person_keys(F.col)
    seen = lineitem.select(F.col("l_orderkey").alias("m"), F.explode(F.array(*keys)).alias("k"))
    pom = orders.select(F.col("o_orderkey").alias("m"), F.col("o_custkey").alias("k"))
    pairs = seen.unionByName(pom)
    name, person = person_columns(F.col("k"))
    if hot_keys(pairs, ["k"]).isEmpty():
        pairs = pairs.repartition(person).select("m", "k", person)
    else:
        pairs = pairs.select("m", "k", person)
    return pairs.distinct().select(F.col("m").cast("string").alias("match_id"), name, "person_id")


REGISTRY_SQL = f"""
SELECT DISTINCT match_id, person_name, person_id FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS match_id, {_sql_person('l_partkey')} AS person_name,
         'P' || CAST(l_partkey AS VARCHAR) AS person_id FROM lineitem
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), {_sql_person('l_suppkey')}, 'P' || CAST(l_suppkey AS VARCHAR) FROM lineitem
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), {_sql_person('l_partkey + l_linenumber')},
         'P' || CAST(l_partkey + l_linenumber AS VARCHAR) FROM lineitem
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), {_sql_person('o_custkey')}, 'P' || CAST(o_custkey AS VARCHAR) FROM orders
)"""


# ------------------------------------------------------------------ reference lists

def people_raw(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("identifier"),
        F.col("c_custkey").alias("key_cricinfo"),
        F.concat(F.lit("Customer "), F.col("c_custkey").cast("string")).alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING",
               F.concat(F.col("c_name"), F.lit(" ("), F.col("c_mktsegment"), F.lit(")")))
         .otherwise(F.col("c_name")).alias("unique_name"),
    )


PEOPLE_RAW_SQL = """
SELECT 'P' || CAST(c_custkey AS VARCHAR) AS identifier, c_custkey AS key_cricinfo,
       'Customer ' || CAST(c_custkey AS VARCHAR) AS name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' (' || c_mktsegment || ')' ELSE c_name END AS unique_name
FROM customer"""


def profiles_raw(supplier: DataFrame) -> DataFrame:
    """Headers as the profile export writes them: capitals and spaces."""
    return supplier.select(
        F.col("s_suppkey").alias("ID"),
        F.col("s_name").alias("Name"),
        F.when(F.col("s_acctbal") > 0, "Right-hand bat").otherwise("Left-hand bat").alias("Batting Style"),
        F.concat(F.lit("Style "), F.col("s_nationkey").cast("string")).alias("Bowling Style"),
    )


PROFILES_RAW_SQL = """
SELECT s_suppkey AS "ID", s_name AS "Name",
       CASE WHEN s_acctbal > 0 THEN 'Right-hand bat' ELSE 'Left-hand bat' END AS "Batting Style",
       'Style ' || CAST(s_nationkey AS VARCHAR) AS "Bowling Style"
FROM supplier"""


def leagues(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.concat(F.lit("Team "), F.col("o_orderstatus")).alias("team_name"),
        F.when(F.col("o_orderstatus") == "F", "ICC International")
         .when(F.col("o_orderstatus") == "O", "Domestic League").alias("league"),
    ).distinct()


LEAGUES_SQL = """
SELECT DISTINCT 'Team ' || o_orderstatus AS team_name,
       CASE o_orderstatus WHEN 'F' THEN 'ICC International' WHEN 'O' THEN 'Domestic League' END AS league
FROM orders"""

# Whole-value replacement used by the stand-in fact table: renames one team in
# every string column *before* the league join, so that team finds no league
# (the order of SURVEY Q16).
STANDIN_REPLACEMENTS = {"Team O": "Team Open"}


def standin_ctes() -> str:
    """WITH-clause bodies defining the stand-in tables for oracle SQL."""
    return ",\n".join([
        f"sd_deliveries AS ({DELIVERIES_SQL})",
        f"sd_match_info AS ({MATCH_INFO_SQL})",
        f"sd_registry AS ({REGISTRY_SQL})",
        f"sd_people_raw AS ({PEOPLE_RAW_SQL})",
        f"sd_profiles_raw AS ({PROFILES_RAW_SQL})",
        f"sd_leagues AS ({LEAGUES_SQL})",
    ])


class Standins:
    """Lazily built stand-in frames for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def t(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)

    def deliveries(self) -> DataFrame:
        return deliveries(self.t("lineitem"))

    def match_info(self) -> DataFrame:
        return match_info(self.t("orders"))

    def registry(self) -> DataFrame:
        return registry(self.t("lineitem"), self.t("orders"))

    def people_raw(self) -> DataFrame:
        return people_raw(self.t("customer"))

    def profiles_raw(self) -> DataFrame:
        return profiles_raw(self.t("supplier"))

    def leagues(self) -> DataFrame:
        return leagues(self.t("orders"))
