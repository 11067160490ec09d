"""Landed JSON payloads -> typed rows.

Payloads arrive either as files (one JSON document per file, read with
``read_payload_files``) or as a text column (``parse_payloads``).  Both use a
declared schema in PERMISSIVE mode: a malformed document lands in the corrupt
record column and is split off by ``split_malformed`` so the rest of the run
goes on and the rejects can be counted.

All flattening is per document (``explode`` / ``posexplode`` / higher-order
array functions), so it is a narrow transformation: no shuffle, and work
spreads over as many tasks as there are input splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import cast_id, localized_default
from ..schemas import CORRUPT_COLUMN

ENTITY_COLUMN = "entity"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema.fields if f.name != CORRUPT_COLUMN]
    return T.StructType(fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])


def read_payload_files(spark: SparkSession, path: str | Sequence[str], schema: T.DataType) -> DataFrame:
    """Read whole-file JSON documents; ``entity`` is the file name without
    extension (e.g. ``roster/TOR.json`` -> ``TOR``).  A map-shaped payload is
    exposed as column ``value``.  Malformed files keep only the corrupt column."""
    paths = [path] if isinstance(path, str) else list(path)
    text = spark.read.option("wholetext", "true").text(paths)
    text = text.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias(ENTITY_COLUMN),
        F.col("value").alias("_json"),
    )
    return parse_payloads(text, "_json", schema).drop("_json")


def parse_payloads(df: DataFrame, text_column: str, schema: T.DataType) -> DataFrame:
    """Parse a JSON text column with ``schema``.

    A struct payload's fields become top-level columns; any other payload
    (e.g. a map keyed by position group) becomes column ``value``.  Either way
    ``_corrupt_record`` holds the text of a document that did not parse.

    The parsed struct is expanded by a generator (``inline``) rather than a
    projection: a later filter on ``_corrupt_record`` then stays above it
    instead of being pushed below with a second copy of ``from_json``, so every
    document is parsed exactly once.
    """
    keep = list(df.columns)
    text = F.col(text_column)
    if isinstance(schema, T.StructType):
        parsed = F.from_json(
            text, _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
        )
        return df.select(*keep, F.inline(F.array(parsed)))
    value = df.select(*keep, F.from_json(text, schema, {"mode": "PERMISSIVE"}).alias("_value"))
    row = F.struct(
        F.col("_value").alias("value"),
        F.when(F.col("_value").isNull() & text.isNotNull(), text).alias(CORRUPT_COLUMN),
    )
    return value.select(*keep, F.inline(F.array(row)))


def split_malformed(parsed: DataFrame, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(well-formed documents, rejected documents); the run goes on with the first.

    A document that parses but lacks a ``required`` field (an empty file, an
    error body) is rejected too, so every skipped entity is counted.
    """
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    for field in required:
        bad = bad | F.col(field).isNull()
    return parsed.filter(~bad).drop(CORRUPT_COLUMN), parsed.filter(bad)


def flatten_record_array(docs: DataFrame, field: str = "data", carry: Sequence[str] = ()) -> DataFrame:
    """``{field: [rec, ...]}`` -> one row per record (record fields + ``carry``)."""
    return docs.select(*carry, F.explode(field).alias("_rec")).select(*carry, "_rec.*")


def flatten_map_of_arrays(docs: DataFrame, field: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    """``{group: [rec, ...], ...}`` -> one row per record of every group.

    The group names are discarded; the arrays are concatenated in any order.
    """
    records = F.explode(F.flatten(F.map_values(F.col(field))))
    return docs.select(*carry, records.alias("_rec")).select(*carry, "_rec.*")


def flatten_keyed_array(
    docs: DataFrame, field: str, stamps: Mapping[str, Column | str]
) -> DataFrame:
    """Explode ``field`` and stamp each record with the document's key(s)."""
    cols = {k: (F.col(v) if isinstance(v, str) else v) for k, v in stamps.items()}
    base = docs.select(*[c.alias(k) for k, c in cols.items()], F.explode(field).alias("_rec"))
    return base.select(*cols.keys(), "_rec.*")


def _kept_games(games: Column) -> Column:
    """Prefix of ``games`` before the first one whose away side has no score."""
    first_unscored = F.array_position(
        F.transform(games, lambda g: g["awayTeam"]["score"].isNull()), F.lit(True)
    )
    keep = F.coalesce(F.nullif(first_unscored, F.lit(0)) - 1, F.size(games))
    return F.slice(games, F.lit(1), keep.cast("int"))


def flatten_scoreboard(docs: DataFrame, board: str, take_while: bool = True) -> DataFrame:
    """``gamesByDate[] -> games[]`` -> one row per game.

    With ``take_while`` each date keeps its games only up to the first one
    whose away side has no score (later games of that date are dropped even if
    scored; the next date starts afresh).  The cut is computed on the array
    inside each document, so it needs no shuffle and no window.

    Output: ``board``, ``date_pos``, ``game_pos`` (0-based positions in the
    document, the display order), ``away_teams``, ``home_teams``,
    ``away_result``, ``home_result``, ``date_play`` and ``new_date``: true on
    the first shown game of a date that is not the board's first shown date.
    """
    days = F.col("gamesByDate")
    if take_while:
        days = F.transform(days, lambda d: d.withField("games", _kept_games(d["games"])))
    # Two steps so the (interpreted) array transform is evaluated once.
    shown = docs.select(F.col(board), days.alias("_days"))
    first_shown = F.array_position(F.transform("_days", lambda d: F.size(d["games"]) > 0), F.lit(True)) - 1
    per_day = shown.select(
        board, first_shown.alias("_first_shown"), F.posexplode("_days").alias("date_pos", "_day")
    )
    per_game = per_day.select(
        board, "date_pos", "_first_shown", F.col("_day.date").alias("date_play"),
        F.posexplode("_day.games").alias("game_pos", "_g"),
    )
    return per_game.select(
        board,
        F.col("date_pos").cast("int").alias("date_pos"),
        F.col("game_pos").cast("int").alias("game_pos"),
        localized_default(F.col("_g.awayTeam.name")).alias("away_teams"),
        localized_default(F.col("_g.homeTeam.name")).alias("home_teams"),
        F.col("_g.awayTeam.score").alias("away_result"),
        F.col("_g.homeTeam.score").alias("home_result"),
        "date_play",
        ((F.col("game_pos") == 0) & (F.col("date_pos") > F.col("_first_shown"))).alias("new_date"),
    )


# Localised fields of a roster record.
ROSTER_LOCALIZED = ["firstName", "lastName", "birthCity", "birthStateProvince"]


def roster_to_players_info(records: DataFrame, team_column: str, ds: str) -> DataFrame:
    """Roster records -> ``players_info`` rows: localised defaults resolved,
    ``id`` renamed ``playerId``, current team and run date stamped."""
    out = records
    for c in ROSTER_LOCALIZED:
        if c in out.columns:
            out = out.withColumn(c, localized_default(c))
    out = out.withColumnRenamed("id", "playerId")
    if "birthDate" in out.columns:
        out = out.withColumn("birthDate", F.try_to_date("birthDate"))
    return out.withColumn("triCodeCurrent", F.col(team_column)).drop(team_column).withColumn(
        "updatedDt", F.lit(ds)
    )


def game_log_to_games_info(records: DataFrame) -> DataFrame:
    """Game-log records -> ``games_info`` rows (names dropped, id as BIGINT)."""
    return records.drop("commonName", "opponentCommonName").withColumn("gameId", cast_id("gameId"))
