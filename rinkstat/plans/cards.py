"""Player cards: the per-player summary the card query serves.

Pipeline: aggregate (skater or goalie) -> fold home/road -> one row per name
(the first in key order) -> derived fields (age, averages, ratios, link).
A name lookup filters on ``playersFIO``, a group key, so Catalyst pushes it
below both aggregates into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators.aggregates import goalie_aggregate, rollup_home_road, skater_aggregate
from ..operators.filters import by_exact_name
from ..operators.ordered import first_row_per_group
from ..schemas import CARD_KEYS

COMMON_HEAD = [
    "playersFIO", "playerId", "headshot", "birthDate", "age", "birthCountry",
    "birthCity", "teamFullName", "teamAbbrev", "gamesCNT",
]
SKATER_FIELDS = ["points", "goals", "plusMinus", "pim"]
GOALIE_FIELDS = ["gamesStarted", "shutouts", "perc_goals", "save_pct", "goals", "pim"]
COMMON_TAIL = ["toi", "avg_toi_min", "avg_toi_sec", "ref_toi_sec", "name_link"]


def card_rows(rolled: DataFrame) -> DataFrame:
    """First row per non-empty name, in the card key order."""
    named = rolled.filter(F.col("playersFIO") != F.lit(""))
    return first_row_per_group(named, ["playersFIO"], CARD_KEYS)


def _decorate(rows: DataFrame, as_of: str) -> DataFrame:
    avg = X.avg_toi_seconds("toi", "gamesCNT")
    return rows.select(
        "*",
        X.age_years("birthDate", F.lit(as_of).cast("date")).alias("age"),
        X.minutes_part(avg).alias("avg_toi_min"),
        X.seconds_part(avg).alias("avg_toi_sec"),
        # The card's original seconds figure: total toi mod 60.
        X.seconds_part("toi").alias("ref_toi_sec"),
        X.name_link("playersFIO").alias("name_link"),
    )


def cards_from_rolled(rolled: DataFrame, kind: str, as_of: str) -> DataFrame:
    """Cards from a card-grain table (``rollup_home_road`` output or
    :func:`rinkstat.plans.player_stats.card_aggregate`)."""
    rows = card_rows(rolled)
    if kind == "goalie":
        rows = rows.withColumn(
            "perc_goals", X.goalie_percentage("shotsAgainst", "goalsAgainst")
        ).withColumn("save_pct", X.save_percentage("shotsAgainst", "goalsAgainst"))
        fields = GOALIE_FIELDS
    else:
        fields = SKATER_FIELDS
    return _decorate(rows, as_of).select(*COMMON_HEAD, *fields, *COMMON_TAIL)


def cards_from_aggregate(agg: DataFrame, kind: str, as_of: str, name: str | None = None) -> DataFrame:
    """Cards served from a stored ``skaters_agg`` / ``goalies_agg`` table.

    The name filter is on a group key, so it reaches the parquet scan of the
    stored aggregate before home and road rows are folded.
    """
    src = by_exact_name(agg, name) if name is not None else agg
    return cards_from_rolled(rollup_home_road(src), kind, as_of)


def skater_cards(mart: DataFrame, as_of: str, name: str | None = None) -> DataFrame:
    src = by_exact_name(mart, name) if name is not None else mart
    rows = card_rows(rollup_home_road(skater_aggregate(src)))
    return _decorate(rows, as_of).select(*COMMON_HEAD, *SKATER_FIELDS, *COMMON_TAIL)


def goalie_cards(mart: DataFrame, as_of: str, name: str | None = None) -> DataFrame:
    src = by_exact_name(mart, name) if name is not None else mart
    rows = card_rows(rollup_home_road(goalie_aggregate(src)))
    rows = rows.withColumn(
        "perc_goals", X.goalie_percentage("shotsAgainst", "goalsAgainst")
    ).withColumn("save_pct", X.save_percentage("shotsAgainst", "goalsAgainst"))
    return _decorate(rows, as_of).select(*COMMON_HEAD, *GOALIE_FIELDS, *COMMON_TAIL)


def player_cards(mart: DataFrame, kind: str, as_of: str, name: str | None = None) -> DataFrame:
    """Dispatch on the player kind chosen by the user: ``goalie`` or ``skater``."""
    if kind == "goalie":
        return goalie_cards(mart, as_of, name)
    if kind == "skater":
        return skater_cards(mart, as_of, name)
    raise ValueError(f"kind must be 'goalie' or 'skater', not {kind!r}")


def card_text(card: DataFrame, kind: str) -> DataFrame:
    """A plain-text rendering of each card (one ``card`` string per row)."""
    lines = [
        F.concat(F.lit("Born: "), F.col("birthDate").cast("string")),
        F.concat(F.lit("Age: "), F.col("age").cast("string")),
        F.concat(F.lit("Country: "), F.col("birthCountry")),
        F.concat(F.lit("City: "), F.col("birthCity")),
        F.concat(F.lit("Team: "), F.col("teamFullName"), F.lit(" ("), F.col("teamAbbrev"), F.lit(")")),
        F.concat(F.lit("Games: "), F.col("gamesCNT").cast("string")),
    ]
    if kind == "goalie":
        lines += [
            F.concat(F.lit("Games started: "), F.col("gamesStarted").cast("string")),
            F.concat(F.lit("Shutouts: "), F.col("shutouts").cast("string")),
            F.concat(F.lit("Saved shots, %: "), F.col("perc_goals").cast("string")),
        ]
    lines.append(
        F.concat(
            F.lit("Average time on ice: "), F.col("avg_toi_min").cast("string"), F.lit(" min, "),
            F.col("avg_toi_sec").cast("string"), F.lit(" s"),
        )
    )
    if kind == "skater":
        lines.append(F.concat(F.lit("Points: "), F.col("points").cast("string")))
    lines.append(F.concat(F.lit("Goals: "), F.col("goals").cast("string")))
    if kind == "skater":
        lines.append(F.concat(F.lit("Plus/minus: "), F.col("plusMinus").cast("string")))
    lines.append(F.concat(F.lit("Penalty minutes: "), F.col("pim").cast("string")))
    return card.withColumn("card", F.concat_ws("\n", *lines))
