"""Results digest: one display line per shown game, in board order.

The digest is the ordered concatenation of ``line`` over
``(board, date_pos, game_pos)``; a blank line separates dates.  It is kept as
rows (one per game) so no board is ever gathered into a single task; write it
with :func:`rinkstat.sinks.parquet.write_text_sorted` or read it in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import result_line
from ..operators.ordered import change_marks

RESULT_COLUMNS = ["date_play", "away_teams", "away_result", "home_result", "home_teams"]


def result_lines(rows: DataFrame, board: str) -> DataFrame:
    return rows.select(board, "date_pos", "game_pos", result_line(*RESULT_COLUMNS).alias("line"))


def date_marks(rows: DataFrame, board: str) -> DataFrame:
    """Flat-table form: mark the first game of each date after a board's first
    shown date (per-date minima joined back; no global window)."""
    return change_marks(rows, [board], ["date_pos"], ["game_pos"], "new_date")


def digest_lines(rows: DataFrame, board: str) -> DataFrame:
    """Rows carrying ``new_date`` -> digest lines with the date separators."""
    sep = F.when(F.col("new_date"), F.lit("\n")).otherwise(F.lit(""))
    return rows.select(
        board, "date_pos", "game_pos", F.concat(sep, result_line(*RESULT_COLUMNS)).alias("line")
    )


def digest_text(lines: DataFrame, board: str) -> DataFrame:
    """One digest text per board: its lines concatenated in display order.

    A board is one landed scoreboard document, so the group is bounded by
    what one document holds; a table without that bound should be consumed
    as ordered lines (:func:`digest_lines`) instead.
    """
    ordered = F.array_sort(F.collect_list(F.struct("date_pos", "game_pos", "line")))
    return lines.groupBy(board).agg(
        F.array_join(F.transform(ordered, lambda x: x["line"]), "").alias("digest")
    )
