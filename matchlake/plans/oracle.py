"""SQL text (DuckDB dialect) for the oracle side of each registered query.

Built from the stand-in CTEs so each oracle is an independent restatement of
the same semantics over the raw driver tables.
"""

from __future__ import annotations

import re

from matchlake.plans.standins import standin_ctes
from matchlake.schemas import FACT_DELIVERY_COLUMNS, MATCH_INFO, ROLES

DELIVERY_COLS = ["match_id", "innings", "batting_team", "bowling_team", "declared", "delivery", "batter", "bowler",
                 "non_striker", "batter_runs", "extra_runs", "total_runs", "wicket_type", "player_out"]
MATCH_COLS = [f.name for f in MATCH_INFO.fields if f.name != "match_id"]


def q(name: str) -> str:
    return f'"{name}"'


def with_standins(*ctes: str, body: str) -> str:
    parts = [standin_ctes(), *ctes]
    # each step is computed once and joined as a table of known size
    steps = re.sub(r"\b((?:sd|dim)_\w+) AS \(", r"\1 AS MATERIALIZED (", ",\n".join(parts))
    return "WITH " + steps + "\n" + body


PEOPLE_CTE = """sd_people AS (
  SELECT pr.identifier AS person_id, pr.key_cricinfo, coalesce(pf."Name", pr.name) AS person_name,
         pr.unique_name AS person_unique_name
  FROM sd_people_raw pr LEFT JOIN sd_profiles_raw pf ON pr.key_cricinfo = pf."ID")"""

NAMES_CTE = """sd_names AS (
  SELECT DISTINCT r.match_id, coalesce(p.person_name, r.person_name) AS person_name, r.person_id,
         p.person_unique_name
  FROM sd_registry r LEFT JOIN sd_people p ON r.person_id = p.person_id)"""

ORDER_ALL = ", ".join(f"{c} NULLS FIRST" for c in DELIVERY_COLS)
INDEXED_CTE = f"""sd_indexed AS (
  SELECT CAST(row_number() OVER (ORDER BY {ORDER_ALL}) AS BIGINT) AS delivery_id, * FROM sd_deliveries)"""

# Ids as a run of two batches gives them: by batch (matches before the cut
# first), match, and place in the match document.
BATCH_INDEXED_CTE = """sd_indexed AS (
  SELECT CAST(row_number() OVER (ORDER BY m.match_start_date >= TIMESTAMP '{cut}', d.match_id, d.innings, d.batting_team,
                                 d.delivery, d.batter, d.bowler, d.non_striker, d.batter_runs, d.extra_runs, d.total_runs,
                                 d.wicket_type NULLS FIRST, d.player_out NULLS FIRST, d.declared) AS BIGINT) AS delivery_id, d.*
  FROM sd_deliveries d JOIN sd_match_info m ON d.match_id = m.match_id)"""


def roles_cte() -> str:
    sel = ["d.*"]
    joins = []
    for i, r in enumerate(ROLES):
        a = f"n{i}"
        sel += [f"{a}.person_name AS {r}_name", f"{a}.person_id AS {r}_id"]
        joins.append(f"LEFT JOIN sd_names {a} ON d.{r} = {a}.person_unique_name AND d.match_id = {a}.match_id")
    return "sd_roles AS (\n  SELECT " + ", ".join(sel) + "\n  FROM sd_indexed d\n  " + "\n  ".join(joins) + ")"


FLAGGED_CTE = """sd_flagged AS (
  SELECT delivery_id, match_id, match_id || '_' || substr(innings, 1, 1) AS innings_id, innings, batting_team,
         bowling_team, declared,
         coalesce(bowler_name, bowler) AS bowler, coalesce(batter_name, batter) AS batter,
         coalesce(non_striker_name, non_striker) AS non_striker, coalesce(player_out_name, player_out) AS player_out,
         delivery, CAST(trunc(delivery) AS BIGINT) + 1 AS "over",
         CAST(round((delivery - trunc(delivery)) * 10) AS BIGINT) AS ball,
         CASE WHEN wicket_type IS NOT NULL THEN 1 ELSE 0 END AS wickets,
         batter_runs, extra_runs, total_runs,
         CASE WHEN batter_runs >= 6 THEN 1 ELSE 0 END AS six,
         CASE WHEN batter_runs BETWEEN 4 AND 5 THEN 1 ELSE 0 END AS four,
         wicket_type,
         batter_name IS NULL AS missing_batter_name, bowler_name IS NULL AS missing_bowler_name,
         non_striker_name IS NULL AS missing_non_striker_name, player_out_name IS NULL AS missing_player_out_name,
         batter_id, bowler_id, non_striker_id, player_out_id
  FROM sd_roles)"""


def match_pom_cte(resolve: bool = False) -> str:
    pom = "coalesce(p.player_of_match_name, mi.player_of_match)" if resolve else "mi.player_of_match"
    cols = ", ".join(f"mi.{c}" if c != "player_of_match" else f"{pom} AS player_of_match"
                     for c in ["match_id"] + MATCH_COLS)
    return f"""sd_match AS (
  SELECT {cols}
  FROM sd_match_info mi LEFT JOIN (SELECT person_unique_name AS player_of_match,
                                          person_name AS player_of_match_name, match_id FROM sd_names) p
    ON mi.player_of_match = p.player_of_match AND mi.match_id = p.match_id)"""


STRING_FACT_COLS = ["match_id", "innings_id", "innings", "batting_team", "bowling_team", "bowler", "batter",
                    "non_striker", "player_out", "wicket_type", "batter_id", "bowler_id", "non_striker_id",
                    "player_out_id", "city", "match_type", "gender", "umpire_1", "umpire_2", "win_by", "winner",
                    "player_of_match", "team1", "team2", "toss_decision", "toss_winner", "venue"]


def fact_ctes(replacements: dict[str, str], resolve_pom: bool = False, indexed: str = INDEXED_CTE) -> list[str]:
    mcols = []
    for c in MATCH_COLS:
        if c in ("match_start_date", "match_end_date"):
            mcols.append(f"CAST(m.{c} AS DATE) AS {c}")
        else:
            mcols.append(f"m.{c}")
    dcols = ", ".join(f"f.{q(c)}" for c in FACT_DELIVERY_COLUMNS)
    fact0 = f"sd_fact0 AS (\n  SELECT {dcols}, {', '.join(mcols)}\n  FROM sd_flagged f JOIN sd_match m ON f.match_id = m.match_id)"
    all_cols = FACT_DELIVERY_COLUMNS + MATCH_COLS
    sel = []
    for c in all_cols:
        if c in STRING_FACT_COLS and replacements:
            expr = "CASE " + " ".join(f"WHEN {q(c)} = '{k}' THEN '{v}'" for k, v in replacements.items()) \
                   + f" ELSE {q(c)} END"
            sel.append(f"{expr} AS {q(c)}")
        else:
            sel.append(q(c))
    fact1 = "sd_fact1 AS (\n  SELECT " + ", ".join(sel) + " FROM sd_fact0)"
    out = []
    for c in all_cols:
        if c == "match_type":
            out.append("CASE WHEN f.match_type = 'ODM' AND contains(lower(lg.league), 'international') THEN 'ODI' "
                       "ELSE f.match_type END AS match_type")
        else:
            out.append(f"f.{q(c)}")
    fact = ("sd_fact AS (\n  SELECT " + ", ".join(out) + ", lg.league\n"
            "  FROM sd_fact1 f LEFT JOIN sd_leagues lg ON f.batting_team = lg.team_name)")
    return [PEOPLE_CTE, NAMES_CTE, indexed, roles_cte(), FLAGGED_CTE, match_pom_cte(resolve_pom), fact0, fact1, fact]


def fact_sql(replacements: dict[str, str], body: str = "SELECT * FROM sd_fact", extra: list[str] | None = None,
             indexed: str = INDEXED_CTE) -> str:
    return with_standins(*fact_ctes(replacements, indexed=indexed), *(extra or []), body=body)


HASH_SOURCES_SQL = {
    "batting_team": "batting_team",
    "bowling_team": "bowling_team",
    "batter": "coalesce(batter_id, batter)",
    "bowler": "coalesce(bowler_id, bowler)",
    "non_striker": "coalesce(non_striker_id, non_striker)",
    "player_out": "coalesce(player_out_id, player_out)",
}


def hash_sql(expr: str) -> str:
    digest = f"md5(CASE WHEN ({expr}) IS NULL THEN 'n' ELSE 'v:' || CAST(({expr}) AS VARCHAR) END)"
    return f"CAST(('0x' || substr({digest}, 1, 15)) AS BIGINT)"


HASHED_CTE = ("sd_hashed AS (\n  SELECT * EXCLUDE (batter_id, bowler_id, non_striker_id, player_out_id), "
              + ", ".join(f"{hash_sql(e)} AS {d}_hash" for d, e in HASH_SOURCES_SQL.items())
              + "\n  FROM sd_fact)")


def dim_cte(d: str) -> str:
    return (f"dim_{d} AS (\n  SELECT {d}, {d}_hash, CAST(row_number() OVER (ORDER BY {d}_hash NULLS FIRST, "
            f"{d} NULLS FIRST) AS BIGINT) AS {d}_sk\n  FROM (SELECT DISTINCT {d}, {d}_hash FROM sd_hashed))")
