"""Column expressions used by the transforms.

Every helper takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The per-ball feature thresholds, the declared marker and the result labels.
SIX_RUNS = 6
FOUR_RUNS_LOW, FOUR_RUNS_HIGH = 4, 5
DECLARED_MARKER = "yes"
WIN, LOSS = "win", "loss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- ids, lists

def file_stem(path) -> Column:
    """Last path segment without its final extension; query/fragment ignored."""
    no_query = F.regexp_replace(_c(path), r"[?#].*$", "")
    return F.regexp_extract(no_query, r"([^/]*?)(\.[^./]*)?$", 1)


def first_of(arr) -> Column:
    """First element, null for null/empty lists."""
    return F.try_element_at(_c(arr), F.lit(1))


def last_of(arr) -> Column:
    """Last element, null for null/empty lists; one element -> same as first."""
    return F.try_element_at(_c(arr), F.lit(-1))


def first_other(arr, value) -> Column:
    """First element of ``arr`` that is not ``value`` (null-safe), else null."""
    v = _c(value)
    return F.get(F.filter(_c(arr), lambda t: ~t.eqNullSafe(v)), 0)


def first_key(m) -> Column:
    """First key of a map in document order."""
    return F.get(F.map_keys(_c(m)), 0)


def first_value(m) -> Column:
    return F.get(F.map_values(_c(m)), 0)


# ---------------------------------------------------------------- parsing

def yes_flag(text) -> Column:
    """1 when the text equals 'yes' in any case, else 0, as tinyint."""
    return F.when(F.lower(_c(text)) == DECLARED_MARKER, 1).otherwise(0).cast("tinyint")


def to_double(text) -> Column:
    """Lenient string -> double; null when it does not parse (E5)."""
    return _c(text).try_cast("double")


def parse_day(text) -> Column:
    """'yyyy-MM-dd' (padded or not) -> midnight timestamp_ntz; null if it does not parse."""
    return F.try_to_timestamp(_c(text), F.lit("yyyy-M-d")).cast("timestamp_ntz")


def looks_nested(text) -> Column:
    """True when a string field actually carried a JSON object or list."""
    t = F.ltrim(_c(text))
    return t.startswith("{") | t.startswith("[")


# ---------------------------------------------------------------- features

def innings_key(match_id, innings) -> Column:
    """match_id + '_' + first character of the innings name (P2); null propagates."""
    return F.concat(_c(match_id), F.lit("_"), F.substring(_c(innings), 1, 1))


def over_of(delivery) -> Column:
    """Truncated ball key + 1."""
    return _c(delivery).cast("bigint") + F.lit(1)


def ball_of(delivery) -> Column:
    """Round(10 * fractional part) of the ball key."""
    d = _c(delivery)
    return F.round((d - d.cast("bigint")) * 10).cast("bigint")


def wicket_flag(wicket_type) -> Column:
    return F.when(_c(wicket_type).isNotNull(), 1).otherwise(0)


def six_flag(runs) -> Column:
    return F.when(_c(runs) >= SIX_RUNS, 1).otherwise(0)


def four_flag(runs) -> Column:
    return F.when(_c(runs).between(FOUR_RUNS_LOW, FOUR_RUNS_HIGH), 1).otherwise(0)


def missing_flag(x) -> Column:
    """Null test as a boolean column."""
    return _c(x).isNull()


def result_label(winner, team) -> Column:
    """'win' when the winner equals the team, else 'loss' (null compares as loss, N11)."""
    return F.when(_c(winner) == _c(team), WIN).otherwise(LOSS)


def recode_when_contains(value, match_value: str, new_value: str, text, token: str) -> Column:
    """``new_value`` when value == match_value and lower(text) contains token."""
    cond = (_c(value) == match_value) & F.lower(_c(text)).contains(token.lower())
    return F.when(cond, F.lit(new_value)).otherwise(_c(value))


# ---------------------------------------------------------------- hashing

def hash_key(x) -> Column:
    """Deterministic 64-bit key of a value: the first 60 bits of the md5 of a
    tagged text form, as bigint (cheap to shuffle, broadcast and join).

    Nulls hash to one non-null constant (like the notebook's ``hash``), and the
    'v:' tag keeps that constant apart from every real value.  md5 is used so a
    second engine can reproduce the keys exactly (oracle checks).  With 60 bits
    a dimension of a million members collides with probability ~4e-7; a
    collision behaves like one id with two names (SURVEY Q14).
    """
    v = _c(x).cast("string")
    digest = F.md5(F.when(v.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v:"), v)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
