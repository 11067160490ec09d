"""DuckDB oracle SQL for every registered query.

Each text rebuilds the league views from the driver tables with the same
expressions as :mod:`rinkstat.plans.league_views` and then states the query
in plain SQL, independently of the Spark implementation.  Typing rules for a
value-exact comparison: integer sums are cast to BIGINT (DuckDB would give
HUGEINT), half-even rounding is ``round_even``, division by zero is avoided
with ``NULLIF``, and doubles are truncated before casting to integers.
"""

from __future__ import annotations

from ..schemas import AGG_KEYS, CARD_KEYS, GOALIE_SUMS, SKATER_SUMS
from ..functions.scalar import TOI_PATTERN
from . import league_views as V


def _select(columns: dict[str, str]) -> str:
    return ",\n    ".join(f"{expr} AS {name}" for name, expr in columns.items())


def teams_cte() -> str:
    return f"teams AS (SELECT {_select(V.TEAM_COLUMNS)} FROM nation)"


def players_cte(
    name: str = "players", where: str | None = None, overrides: dict | None = None, everyone: bool = False
) -> str:
    cond = ("TRUE" if everyone else V.PLAYER_FILTER) + (f" AND {where}" if where else "")
    cols = {**V.PLAYER_COLUMNS, **(overrides or {})}
    return f"{name} AS (SELECT {_select(cols)} FROM part WHERE {cond})"


def games_cte(name: str = "games", where: str | None = None, overrides: dict | None = None) -> str:
    cols = {**V.GAME_COLUMNS, **(overrides or {})}
    cond = f"WHERE {where}" if where else ""
    return (
        f"{name} AS (SELECT {_select(cols)} FROM lineitem "
        f"JOIN supplier ON l_suppkey = s_suppkey {cond})"
    )


MART_CTE = """mart AS (
  SELECT g.*, p.headshot, p.positionCode, p.shootsCatches, p.birthDate, p.birthCity,
         p.birthCountry, p.birthStateProvince, p.triCodeCurrent, p.updatedDt,
         t1.fullName AS teamFullName, t2.fullName AS opponentFullName,
         t3.fullName AS currentTeamFullName,
         concat_ws(' ', p.firstName, p.lastName) AS playersFIO
  FROM games g
  LEFT JOIN players p USING (playerId)
  LEFT JOIN teams t1 ON g.teamAbbrev = t1.triCode
  LEFT JOIN teams t2 ON g.opponentAbbrev = t2.triCode
  LEFT JOIN teams t3 ON p.triCodeCurrent = t3.triCode)"""


def toi_seconds_sql(col: str) -> str:
    return (
        f"CASE WHEN regexp_matches({col}, '{TOI_PATTERN}') "
        f"THEN TRY_CAST(CAST(TRY_CAST(split_part({col}, ':', 1) AS INTEGER) AS BIGINT) * 60 "
        f"+ TRY_CAST(split_part({col}, ':', 2) AS INTEGER) AS INTEGER) END"
    )


def with_views(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (teams_cte(), players_cte(), games_cte(), MART_CTE)


def aggregate_sql(kind: str) -> str:
    sums = SKATER_SUMS if kind == "skater" else GOALIE_SUMS
    cond = "positionCode <> 'G'" if kind == "skater" else "positionCode = 'G'"
    keys = ", ".join(AGG_KEYS)
    aggs = ",\n  ".join(
        f"CAST(SUM({toi_seconds_sql('toi') if m == 'toi' else m}) AS BIGINT) AS {m}" for m in sums
    )
    return (
        f"SELECT {keys},\n  COUNT(gameId) AS gamesCNT,\n  {aggs}\n"
        f"FROM mart WHERE {cond}\nGROUP BY {keys}"
    )


def rollup_sql(kind: str) -> str:
    sums = ["gamesCNT"] + (SKATER_SUMS if kind == "skater" else GOALIE_SUMS)
    keys = ", ".join(CARD_KEYS)
    not_null = " AND ".join(f"{k} IS NOT NULL" for k in CARD_KEYS)
    aggs = ",\n  ".join(f"CAST(COALESCE(SUM({m}), 0) AS BIGINT) AS {m}" for m in sums)
    return (
        f"SELECT {keys},\n  {aggs}\nFROM ({aggregate_sql(kind)}) a\n"
        f"WHERE {not_null}\nGROUP BY {keys}"
    )


def card_rows_sql(kind: str) -> str:
    order = ", ".join(k for k in CARD_KEYS if k != "playersFIO")
    return (
        f"SELECT * FROM ({rollup_sql(kind)}) r WHERE playersFIO <> ''\n"
        f"QUALIFY row_number() OVER (PARTITION BY playersFIO ORDER BY {order}) = 1"
    )


def card_sql(kind: str) -> str:
    avg = "CAST(trunc(toi / NULLIF(gamesCNT, 0)) AS BIGINT)"
    common_head = (
        "playersFIO, playerId, headshot, birthDate, "
        f"CAST(datesub('year', birthDate, DATE '{V.AS_OF}') AS INTEGER) AS age, "
        "birthCountry, birthCity, teamFullName, teamAbbrev, gamesCNT"
    )
    tail = (
        f"toi, {avg} // 60 AS avg_toi_min, {avg} % 60 AS avg_toi_sec, toi % 60 AS ref_toi_sec, "
        "concat_ws('%20', string_split(playersFIO, ' ')[1], string_split(playersFIO, ' ')[2]) AS name_link"
    )
    if kind == "skater":
        mid = "points, goals, plusMinus, pim"
    else:
        mid = (
            "gamesStarted, shutouts, "
            "round_even(shotsAgainst / NULLIF(shotsAgainst + goalsAgainst, 0) * 100, 2) AS perc_goals, "
            "round_even((shotsAgainst - goalsAgainst) / NULLIF(shotsAgainst, 0) * 100, 2) AS save_pct, "
            "goals, pim"
        )
    return f"SELECT {common_head}, {mid}, {tail}\nFROM ({card_rows_sql(kind)}) c"
