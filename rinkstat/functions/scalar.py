"""Scalar column functions (``Column -> Column``), all built-in Spark SQL
expressions so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed formats.
TOI_PATTERN = r"^[0-9]+:[0-9]+$"  # "MM:SS" (minutes may exceed 59)
NAME_LINK_SEPARATOR = "%20"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def toi_seconds(toi: ColumnOrName) -> Column:
    """``"MM:SS"`` time on ice -> INT seconds; anything else -> NULL.

    ``"65:00"`` is 3900; ``"x"``, NULL and ``"1:02:03"`` are NULL instead of
    failing the job.
    """
    t = _col(toi)
    # Casts run only on guarded digit strings (a failing cast is slow); the
    # try_ forms turn a value beyond INT into NULL, in either part or the sum.
    minutes = F.substring_index(t, ":", 1).try_cast("int")
    seconds = F.substring_index(t, ":", -1).try_cast("int")
    return F.when(t.rlike(TOI_PATTERN), F.try_add(F.try_multiply(minutes, F.lit(60)), seconds))


def localized_default(value: ColumnOrName) -> Column:
    """Localised text (VARIANT) -> its ``default`` entry, else ``""``.

    Also ``""`` when the entry is absent or the value is not an object.
    """
    v = _col(value)
    return F.coalesce(F.try_variant_get(v, "$.default", "string"), F.lit(""))


def full_name(*parts: ColumnOrName) -> Column:
    """Non-NULL parts joined by one space (all NULL -> ``""``)."""
    return F.concat_ws(" ", *[_col(p) for p in parts])


def cast_id(value: ColumnOrName) -> Column:
    """Id as BIGINT; a value that isn't one gives NULL (the key check rejects the row)."""
    return _col(value).try_cast("bigint")


def round_half_even(value: ColumnOrName, digits: int) -> Column:
    """Round a double half-to-even the way numpy/pandas ``round`` does: scale
    the binary value, ``rint``, scale back.  (``bround`` rounds the decimal
    representation instead and differs on values such as 2.675.)"""
    scale = float(10**digits)
    return F.rint(_col(value) * scale) / scale


def goalie_percentage(shots_against: ColumnOrName, goals_against: ColumnOrName) -> Column:
    """SA / (SA + GA) * 100, half-even to 2 places; 0/0 -> NULL."""
    sa = _col(shots_against)
    ga = _col(goals_against)
    return round_half_even(F.try_divide(sa.cast("double"), (sa + ga).cast("double")) * 100, 2)


def save_percentage(shots_against: ColumnOrName, goals_against: ColumnOrName) -> Column:
    """(SA - GA) / SA * 100, half-even to 2 places; no shots -> NULL."""
    sa = _col(shots_against)
    ga = _col(goals_against)
    return round_half_even(F.try_divide((sa - ga).cast("double"), sa.cast("double")) * 100, 2)


def age_years(birth: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Completed years between two dates (calendar years; 29 Feb births turn a
    year older on 28 Feb of non-leap years, as month-end arithmetic does)."""
    months = F.months_between(_col(as_of), _col(birth), roundOff=False)
    return F.floor(months / 12).cast("int")


def avg_toi_seconds(toi_total: ColumnOrName, games: ColumnOrName) -> Column:
    """Whole seconds of average time on ice per game (truncated)."""
    return F.try_divide(_col(toi_total).cast("double"), _col(games).cast("double")).cast("bigint")


def minutes_part(seconds: ColumnOrName) -> Column:
    return F.floor(_col(seconds) / 60).cast("bigint")


def seconds_part(seconds: ColumnOrName) -> Column:
    return F.pmod(_col(seconds), F.lit(60)).cast("bigint")


def result_line(
    date: ColumnOrName,
    away: ColumnOrName,
    away_score: ColumnOrName,
    home_score: ColumnOrName,
    home: ColumnOrName,
) -> Column:
    """``"<date> <away> <a>:<h> <home>.\\n"``; a missing score prints as "-"."""

    def score(c: ColumnOrName) -> Column:
        return F.coalesce(_col(c).cast("string"), F.lit("-"))

    return F.concat(
        _col(date), F.lit(" "), _col(away), F.lit(" "), score(away_score), F.lit(":"),
        score(home_score), F.lit(" "), _col(home), F.lit(".\n"),
    )


def first_word(name: ColumnOrName) -> Column:
    return F.split(_col(name), " ").getItem(0)


def second_word(name: ColumnOrName) -> Column:
    return F.try_element_at(F.split(_col(name), " "), F.lit(2))


def name_link(name: ColumnOrName) -> Column:
    """First and second word of a name joined with a literal ``%20``."""
    return F.concat_ws(NAME_LINK_SEPARATOR, first_word(name), second_word(name))
