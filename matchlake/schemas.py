"""Declared schemas.

The three extracted tables have fixed column lists and types; config files can
still describe a schema as a ``{column: type-name}`` map, which
``schema_from_names`` turns into a ``StructType``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Type names accepted in name->type schema maps (the dataframe
# library vocabulary used by the configs) and the Spark type each becomes.
# Spark has no unsigned integers, so unsigned types widen to the next signed one.
TYPE_NAMES = {
    "String": T.StringType(),
    "Utf8": T.StringType(),
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "UInt8": T.ShortType(),
    "UInt16": T.IntegerType(),
    "UInt32": T.LongType(),
    "UInt64": T.DecimalType(20, 0),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "Boolean": T.BooleanType(),
    "Date": T.DateType(),
    "Datetime": T.TimestampNTZType(),
}


def schema_from_names(mapping: dict[str, str]) -> T.StructType:
    """``{"match_id": "String", "declared": "Int8"}`` -> StructType."""
    fields = []
    for name, type_name in mapping.items():
        if type_name not in TYPE_NAMES:
            raise ValueError(f"unknown type name {type_name!r} for column {name!r}")
        fields.append(T.StructField(name, TYPE_NAMES[type_name], True))
    return T.StructType(fields)


DELIVERIES = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("innings", T.StringType()),
    T.StructField("batting_team", T.StringType()),
    T.StructField("bowling_team", T.StringType()),
    T.StructField("declared", T.ByteType()),
    T.StructField("delivery", T.DoubleType()),
    T.StructField("batter", T.StringType()),
    T.StructField("bowler", T.StringType()),
    T.StructField("non_striker", T.StringType()),
    T.StructField("batter_runs", T.LongType()),
    T.StructField("extra_runs", T.LongType()),
    T.StructField("total_runs", T.LongType()),
    T.StructField("wicket_type", T.StringType()),
    T.StructField("player_out", T.StringType()),
])

MATCH_INFO = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("match_start_date", T.TimestampNTZType()),
    T.StructField("match_end_date", T.TimestampNTZType()),
    T.StructField("match_type", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("umpire_1", T.StringType()),
    T.StructField("umpire_2", T.StringType()),
    T.StructField("win_by", T.StringType()),
    T.StructField("win_margin", T.DoubleType()),
    T.StructField("winner", T.StringType()),
    T.StructField("player_of_match", T.StringType()),
    T.StructField("team1", T.StringType()),
    T.StructField("team2", T.StringType()),
    T.StructField("toss_decision", T.StringType()),
    T.StructField("toss_winner", T.StringType()),
    T.StructField("venue", T.StringType()),
])

REGISTRY = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("person_name", T.StringType()),
    T.StructField("person_id", T.StringType()),
])

MATCH_IDS = T.StructType([T.StructField("match_id", T.StringType())])

# Reference lists (CSV).  Profile headers arrive with capitals and spaces and are
# normalised by rule (P3); the key type must equal the people list's key type.
PROFILES_RAW = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Batting Style", T.StringType()),
    T.StructField("Bowling Style", T.StringType()),
])

# The people register's header names (including its key into
# the profile list, ``key_cricinfo``) are those of the published register file.
PEOPLE_RAW = T.StructType([
    T.StructField("identifier", T.StringType()),
    T.StructField("key_cricinfo", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("unique_name", T.StringType()),
])

LEAGUES = T.StructType([
    T.StructField("team_name", T.StringType()),
    T.StructField("league", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("committed_at", T.TimestampNTZType()),
])

QUARANTINE = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("raw", T.StringType()),
])

# Column order of the published fact table before the match columns (P21 less
# the four missing_* flags, P22).
FACT_DELIVERY_COLUMNS = [
    "delivery_id", "match_id", "innings_id", "innings", "batting_team", "bowling_team",
    "declared", "bowler", "batter", "non_striker", "player_out", "delivery", "over", "ball",
    "wickets", "batter_runs", "extra_runs", "total_runs", "six", "four", "wicket_type",
    "batter_id", "bowler_id", "non_striker_id", "player_out_id",
]

ROLES = ["batter", "bowler", "non_striker", "player_out"]
