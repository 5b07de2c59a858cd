"""Fact-table construction.

Physical plan at scale (see README "Plans"): the delivery table is shuffled
once on (match_id, salt); the per-match name table and the match table are
shuffled once each on the same key, and the four role joins plus the match
join all reuse that partitioning (``requireAllClusterKeysForCoPartition`` off,
see ``session.apply_settings``),
so the big side is never re-shuffled per role.  AQE turns a join into a hash
join that builds the per-match side only when every partition of that side is
under ``maxShuffledHashJoinLocalMapThreshold`` (a hash build cannot spill);
otherwise it stays a spilling sort-merge join.  Hot matches are split over
several salts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake import functions as mf
from matchlake.operators.index import running_offsets, with_row_index
from matchlake.operators.skew import DEFAULT_ROWS_PER_TASK, SALT, hot_keys, salt_big_side, salt_small_side
from matchlake.schemas import FACT_DELIVERY_COLUMNS, ROLES
from matchlake.session import stored

# The whole-value team-name correction applied to every string
# column, and the match-type recode (type, new type, league token).
DEFAULT_REPLACEMENTS = {"Royal Challengers Bengaluru": "Royal Challengers Bangalore"}
DEFAULT_RECODE = ("ODM", "ODI", "international")

MISSING_PREFIX = "missing_"

# Balls of a match whose names are looked up in the match's list; where any
# match has more, all names are joined instead.
LISTED_BALLS = 10_000

# Rows of a league list that are broadcast.
LEAGUE_ROWS = 1_000_000


def _q(c: str):
    return F.col(f"`{c}`")


def match_sizes(deliveries: DataFrame) -> DataFrame:
    """(match_id, n_balls): one narrow row a match, written down."""
    return stored(deliveries.groupBy("match_id").agg(F.count(F.lit(1)).alias("n_balls")), "match-sizes")


def add_delivery_id(deliveries: DataFrame, order_cols: list[str] | None = None, name: str = "delivery_id",
                    offset: int = 1, sizes: DataFrame | None = None) -> DataFrame:
    """Row index from ``offset`` in a total order (P1).  Default order: the place
    in the match when present, else every column.  Balls extracted from
    documents by a batch run are numbered without sorting them (see
    ``operators.ingest.with_first_ids``).

    Where the order begins with the match, only one narrow row a match is put
    in order (``sizes``, as ``match_sizes`` gives them): the balls before a
    match are a sum of sizes, and a ball's place in its match is found where
    the match's balls lie together, as the joins behind need them.  The balls
    are so shuffled once, and not written.  Matches of more than
    ``LISTED_BALLS`` balls and balls of no match are ranged with all others."""
    if order_cols is None:
        order_cols = ["match_id", "ball_pos"] if "ball_pos" in deliveries.columns else list(deliveries.columns)
    if order_cols[0] != "match_id":
        return with_row_index(deliveries, order_cols, name=name, offset=offset)
    sizes = match_sizes(deliveries) if sizes is None else sizes
    if not sizes.filter(F.col("match_id").isNull() | (F.col("n_balls") > LISTED_BALLS)).isEmpty():
        return with_row_index(deliveries, order_cols, name=name, offset=offset)
    first = running_offsets(sizes.select("match_id", "n_balls"), ["match_id"], "n_balls", "_first", offset).select("match_id", "_first")
    place = F.row_number().over(Window.partitionBy("match_id").orderBy(
        *[_q(c).asc_nulls_first() for c in order_cols[1:]] or [F.lit(0)]))
    placed = deliveries.withColumn("_place", place).join(first, "match_id")
    return placed.select((F.col("_first") + F.col("_place") - 1).cast("bigint").alias(name), *[_q(c) for c in deliveries.columns])


def add_innings_id(df: DataFrame) -> DataFrame:
    """innings_id = match_id + '_' + first char of innings."""
    return df.withColumn("innings_id", mf.innings_key("match_id", "innings"))


def add_ball_features(df: DataFrame) -> DataFrame:
    """over, ball, wickets, six, four."""
    return df.withColumns({
        "over": mf.over_of("delivery"),
        "ball": mf.ball_of("delivery"),
        "wickets": mf.wicket_flag("wicket_type"),
        "six": mf.six_flag("batter_runs"),
        "four": mf.four_flag("batter_runs"),
    })


def resolve_roles(deliveries: DataFrame, names: DataFrame, salted: bool = False) -> DataFrame:
    """Four role-playing left joins on (role name, match_id) (P12, P13), the
    null flags (P14) and coalesce of resolved over raw names (P15).

    The same name table is joined four times under aliases and renamed only
    after each join, so no projection separates its shuffle from the join: one
    exchange is reused by all four joins, and AQE can still see its partition
    sizes when choosing a hash join.  With ``salted`` both inputs carry
    ``_salt`` and share one partitioning on (match_id, _salt), so the joins add
    no exchange at all.
    """
    d = deliveries
    keys = ["match_id"] + ([SALT] if salted else [])
    for role in ROLES:
        left, right = d.alias("l"), names.alias("r")
        cond = [F.col(f"l.{role}") == F.col("r.person_unique_name")]
        cond += [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
        j = left.join(right, cond, "left")
        d = j.select(*[F.col(f"l.`{c}`") for c in d.columns],
                     F.col("r.person_name").alias(f"{role}_name"), F.col("r.person_id").alias(f"{role}_id"))
    return _flag_and_coalesce(d)


def _flag_and_coalesce(d: DataFrame) -> DataFrame:
    d = d.withColumns({f"{MISSING_PREFIX}{r}_name": mf.missing_flag(f"{r}_name") for r in ROLES})
    return d.withColumns({r: F.coalesce(f"{r}_name", r) for r in ROLES})


def resolve_roles_listed(deliveries: DataFrame, names: DataFrame, salted: bool = True) -> DataFrame:
    """``resolve_roles`` by one join: the names of a match
    become one list of distinct entries, and each role takes its entries from
    it, so the balls are sorted once instead of once per role.  A ball whose
    roles have several entries gives a row for every combination, as the joins
    do.  The work of a match is its balls times its names; see ``LISTED_BALLS``."""
    keys = ["match_id"] + ([SALT] if salted else [])
    lists = names.groupBy(*keys).agg(F.collect_set(F.struct("person_unique_name", "person_name", "person_id")).alias("_names"))
    left, right = deliveries.alias("l"), lists.alias("r")
    j = left.join(right, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys], "left")
    none = F.array(F.lit(None).cast("struct<person_unique_name:string,person_name:string,person_id:string>"))

    def entries(role: str):
        return F.filter("r._names", lambda x: x["person_unique_name"] == F.col(f"l.{role}"))

    def combined(roles: list[str], found: tuple = ()):
        """Every combination of one entry (null: none) for each role."""
        if not roles:
            return F.array(F.struct(*[c for r, x in zip(ROLES, found) for c in
                                      (x["person_name"].alias(f"{r}_name"), x["person_id"].alias(f"{r}_id"))]))
        some = F.when(F.size(f"_{roles[0]}") > 0, F.col(f"_{roles[0]}")).otherwise(none)
        return F.flatten(F.transform(some, lambda x: combined(roles[1:], (*found, x))))

    d = j.select(*[F.col(f"l.`{c}`") for c in deliveries.columns], *[entries(r).alias(f"_{r}") for r in ROLES])
    single = F.array(F.struct(*[c for r in ROLES for c in (F.get(f"_{r}", F.lit(0))["person_name"].alias(f"{r}_name"),
                                                           F.get(f"_{r}", F.lit(0))["person_id"].alias(f"{r}_id"))]))
    # the size of a null list (no names in the match) is -1 or null
    several = F.greatest(*[F.coalesce(F.size(f"_{r}"), F.lit(0)) for r in ROLES]) > 1
    rows = F.inline(F.when(several, combined(ROLES)).otherwise(single))
    return _flag_and_coalesce(d.select(*[_q(c) for c in deliveries.columns], rows))


def delivery_projection(df: DataFrame) -> DataFrame:
    """The 29 published delivery columns, flags included."""
    cols = FACT_DELIVERY_COLUMNS[:21] + [f"{MISSING_PREFIX}{r}_name" for r in ROLES] + FACT_DELIVERY_COLUMNS[21:]
    return df.select(*cols)


def drop_prefixed(df: DataFrame, prefix: str = MISSING_PREFIX) -> DataFrame:
    """Drop every column whose name starts with ``prefix``."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def match_with_player(match_info: DataFrame, names: DataFrame, resolve: bool = False, salted: bool = False) -> DataFrame:
    """match_info LEFT JOIN names on (player_of_match, match_id).

    The join stays even when its column is unused: duplicate names fan rows out.
    By default the published column keeps the raw name (SURVEY Q2); with
    ``resolve`` it takes the resolved one.  With ``salted`` both inputs carry
    ``_salt`` and share one partitioning on (match_id, _salt), so the join adds
    no exchange.
    """
    left, right = match_info.alias("l"), names.alias("r")
    cond = [F.col("l.player_of_match") == F.col("r.person_unique_name")]
    cond += [F.col(f"l.{k}") == F.col(f"r.{k}") for k in ["match_id"] + ([SALT] if salted else [])]
    j = left.join(right, cond, "left")
    player = F.coalesce("r.person_name", "l.player_of_match") if resolve else F.col("l.player_of_match")
    return j.select(*[(player.alias(c) if c == "player_of_match" else F.col(f"l.`{c}`").alias(c))
                      for c in match_info.columns])


def timestamps_to_dates(df: DataFrame) -> DataFrame:
    """Cast every timestamp / timestamp_ntz column to date (P25)."""
    ts = (T.TimestampType, T.TimestampNTZType)
    return df.select(*[(_q(f.name).cast("date").alias(f.name) if isinstance(f.dataType, ts) else _q(f.name))
                       for f in df.schema.fields])


def replace_in_strings(df: DataFrame, replacements: dict[str, str]) -> DataFrame:
    """Whole-value replacement in every string column (P26); substrings untouched."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not replacements or not cols:
        return df
    return df.na.replace(replacements, subset=cols)


def join_leagues(df: DataFrame, leagues: DataFrame, left_key: str = "batting_team",
                 right_key: str = "team_name") -> DataFrame:
    """LEFT JOIN the team->league list on different key names; the right key is
    dropped and every other mapping column follows the fact columns (P27).

    The list is written down and broadcast by its counted rows (up to
    ``LEAGUE_ROWS``): Spark guesses it from what it is derived from, and AQE
    takes no side of few filled partitions for a broadcast, so that the wide
    facts would be shuffled into as many partitions as there are teams.  In a
    larger list AQE splits skewed teams."""
    lg = stored(leagues.withColumnRenamed(right_key, left_key), "leagues")
    extra = [c for c in lg.columns if c != left_key]
    j = df.join(F.broadcast(lg) if lg.count() <= LEAGUE_ROWS else lg, left_key, "left")
    return j.select(*[_q(c) for c in df.columns], *[_q(c) for c in extra])


def recode_match_type(df: DataFrame, recode: tuple[str, str, str] = DEFAULT_RECODE,
                      column: str = "match_type", league: str = "league") -> DataFrame:
    """ODM -> ODI when the league mentions 'international' (P28); null league keeps it."""
    old, new, token = recode
    return df.withColumn(column, mf.recode_when_contains(column, old, new, league, token))


def flagged_deliveries(d: DataFrame, names: DataFrame, rows_per_task: int = DEFAULT_ROWS_PER_TASK,
                       sizes: DataFrame | None = None, distinct: bool = True,
                       together: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Indexed deliveries -> the 29 published columns plus ``_salt`` (P2,
    P12-P21), co-partitioned on (match_id, _salt).  Also returns the hot-match
    table and the salted names, so that the match join uses the same salts and
    the same exchange of the names.  Hot matches come from ``sizes`` (match_id,
    n_balls: one narrow row a match) where ingest has kept it, else from a
    partial aggregate of the balls.  Names are looked up in the list of their
    match, unless a match has more than ``LISTED_BALLS`` balls.  Without
    ``distinct``, equal rows of ``names`` are removed (P11) behind that shuffle,
    which then serves all joins.  With ``together`` the balls of a match lie
    together already (``add_delivery_id``); where none is hot, no salt is
    needed, they stay where they are, and the other inputs come to them."""
    d = add_innings_id(d)
    hot = hot_keys(d if sizes is None else sizes, ["match_id"], rows_per_task, None if sizes is None else "n_balls", LISTED_BALLS)
    listed = hot.isEmpty()
    if listed and together:
        ns = names.filter(F.col("person_unique_name").isNotNull()).repartition("match_id")
        d2 = add_ball_features(resolve_roles_listed(d, ns, salted=False))
        return (d2.select(*[_q(c) for c in delivery_projection(d2).columns], F.lit(0).alias(SALT)), hot,
                (ns if distinct else ns.distinct()).withColumn(SALT, F.lit(0)))
    ds = salt_big_side(d, hot, ["match_id"], ["delivery_id"]).repartition("match_id", SALT)
    # a name that is null equals no role
    ns = salt_small_side(names.filter(F.col("person_unique_name").isNotNull()), hot, ["match_id"]).repartition("match_id", SALT)
    unique = ns if distinct else ns.distinct()
    d2 = add_ball_features(resolve_roles_listed(ds, ns) if listed else resolve_roles(ds, unique, salted=True))
    ns = unique
    return d2.select(*[_q(c) for c in delivery_projection(d2).columns], SALT), hot, ns


def build_fact_table(deliveries: DataFrame, match_info: DataFrame, names: DataFrame, leagues: DataFrame,
                     replacements: dict[str, str] | None = None,
                     recode: tuple[str, str, str] = DEFAULT_RECODE,
                     resolve_player_of_match: bool = False,
                     order_cols: list[str] | None = None,
                     rows_per_task: int = DEFAULT_ROWS_PER_TASK,
                     keep_missing_flags: bool = False, sizes: DataFrame | None = None, distinct: bool = True) -> DataFrame:
    """Deliveries + names + match info + leagues -> one wide fact table.

    ``names`` is the per-match name table of ``operators.people.resolve_people``
    (``distinct`` as given there).
    """
    replacements = DEFAULT_REPLACEMENTS if replacements is None else replacements

    together = "delivery_id" not in deliveries.columns
    if together:
        sizes = match_sizes(deliveries) if sizes is None else sizes
    d = add_delivery_id(deliveries, order_cols, sizes=sizes) if together else deliveries
    flagged, hot, salted_names = flagged_deliveries(d, names, rows_per_task, sizes, distinct, together)
    if not keep_missing_flags:
        flagged = drop_prefixed(flagged)

    if together and hot.isEmpty():
        m = match_with_player(match_info.repartition("match_id"), salted_names.drop(SALT), resolve_player_of_match)
        fact = flagged.join(m, "match_id", "inner")
    else:
        ms = salt_small_side(match_info, hot, ["match_id"]).repartition("match_id", SALT)
        m = match_with_player(ms, salted_names, resolve_player_of_match, salted=True)
        fact = flagged.join(m, ["match_id", SALT], "inner")
    delivery_cols = [c for c in flagged.columns if c != SALT]
    match_cols = [c for c in match_info.columns if c != "match_id"]
    fact = fact.select(*[_q(c) for c in delivery_cols], *[_q(c) for c in match_cols])

    fact = timestamps_to_dates(fact)
    fact = replace_in_strings(fact, replacements)
    fact = join_leagues(fact, leagues)
    return recode_match_type(fact, recode)
