"""Player identity resolution.

Reference lists are small (one row per person); the registry has one row per
(match, person).  Everything here is ordinary joins and a distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename every column by rule: lower case, spaces -> underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def profiles(raw: DataFrame) -> DataFrame:
    """Player profiles with normalised headers, projected and aliased."""
    p = normalise_headers(raw)
    return p.select(F.col("id").alias("key_cricinfo"), F.col("name").alias("profile_name"),
                    "batting_style", "bowling_style")


def people_register(raw: DataFrame) -> DataFrame:
    """People register projected and aliased (P5)."""
    return raw.select(F.col("identifier").alias("person_id"), "key_cricinfo",
                      F.col("name").alias("person_name"), F.col("unique_name").alias("person_unique_name"))


def people_with_profiles(people: DataFrame, profile: DataFrame) -> DataFrame:
    """people LEFT JOIN profiles on key_cricinfo; profile name wins.

    Keys are cast to one type on both sides.  Duplicate profile keys fan rows
    out, as a left join does (SURVEY Q13).
    """
    key_type = dict(people.dtypes)["key_cricinfo"]
    prof = profile.withColumn("key_cricinfo", F.col("key_cricinfo").cast(key_type))
    j = people.join(prof, "key_cricinfo", "left")
    return j.select("person_id", "key_cricinfo",
                    F.coalesce("profile_name", "person_name").alias("person_name"),
                    "person_unique_name")


def person_names(registry: DataFrame, people: DataFrame, distinct: bool = True) -> DataFrame:
    """Per-match names: registry LEFT JOIN people on person_id, full name wins,
    whole-row distinct (P9-P11).  Columns: match_id, person_name, person_id,
    person_unique_name.  Without ``distinct`` the caller removes equal rows
    where it has shuffled them by match anyway (``facts.build_fact_table``)."""
    ppl = people.select("person_id", F.col("person_name").alias("person_name_full"), "person_unique_name")
    j = registry.join(ppl, "person_id", "left")
    rows = j.select("match_id", F.coalesce("person_name_full", "person_name").alias("person_name"),
                    "person_id", "person_unique_name")
    return rows.distinct() if distinct else rows


def resolve_people(registry: DataFrame, people_raw: DataFrame, profiles_raw: DataFrame, distinct: bool = True) -> DataFrame:
    """P3-P11 end to end."""
    return person_names(registry, people_with_profiles(people_register(people_raw), profiles(profiles_raw)), distinct)
