"""Scalar helpers. Each takes a column (or its name) and returns a Column.

Everything here is built from Spark's own functions, so the expressions stay on
the JVM. Text that cannot be parsed gives NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def clock_seconds(clock) -> Column:
    """``mm:ss`` → seconds as BIGINT."""
    c = _col(clock)
    colon = F.instr(c, ":")
    minutes = F.substring_index(c, ":", 1).try_cast("bigint")
    seconds = F.substr(c, colon + 1).try_cast("bigint")
    return F.when(colon > 0, minutes * 60 + seconds)


def wall_clock_24h(text) -> Column:
    """``8:15 PM`` → ``20:15:00``."""
    return F.date_format(F.try_to_timestamp(_col(text), F.lit("h:mm a")), "HH:mm:ss")


def epoch_ms_text(ms) -> Column:
    """Epoch milliseconds → ``yyyy-MM-dd HH:mm:ssZ`` in UTC, whatever the session zone."""
    seconds = F.floor(_col(ms) / F.lit(1000)).cast("decimal(18,6)")
    wall = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=seconds)
    return F.date_format(wall, "yyyy-MM-dd HH:mm:ss'Z'")


def season_long(season) -> Column:
    """``2015-16`` → ``2015-2016``."""
    start = F.substring_index(_col(season), "-", 1)
    return F.concat(start, F.lit("-"), (start.try_cast("int") + 1).cast("string"))


def season_short(path) -> Column:
    """``2015-2016/...`` → ``2015-16``."""
    years = F.split(F.substring_index(_col(path), "/", 1), "-")
    return F.concat(F.get(years, F.lit(0)), F.lit("-"), F.right(F.get(years, F.lit(1)), F.lit(2)))


def matchup_teams(matchup) -> tuple[Column, Column]:
    """First and last word of a matchup text such as ``DET @ ATL``."""
    words = F.regexp_extract_all(_col(matchup), F.lit(r"(\w+)"))
    return F.get(words, F.lit(0)), F.get(words, F.size(words) - 1)


def compact_date(text) -> Column:
    """``2015-10-27`` → ``20151027``."""
    return F.replace(_col(text), F.lit("-"), F.lit(""))


def us_date(text) -> Column:
    """``2015-10-27`` → ``10/27/2015``."""
    year, month, day = (F.get(F.split(_col(text), "-"), F.lit(i)) for i in range(3))
    return F.concat(month, F.lit("/"), day, F.lit("/"), year)


def path_value(path, key: str) -> Column:
    """Value of a ``key=value`` folder in a path; NULL when the folder is absent."""
    return F.nullif(
        F.regexp_extract(_col(path), f"(?:^|/){key}=([^/]*)", 1), F.lit("")
    )


def score_pair(score) -> tuple[Column, Column]:
    """``2 - 4`` → (2, 4): visitor and home points as INT."""
    parts = F.split(_col(score), "-")
    return tuple(F.trim(F.get(parts, F.lit(i))).try_cast("int") for i in (0, 1))


def minutes_text(minutes) -> Column:
    """``32:44`` → ``32.44``, still text."""
    return F.replace(_col(minutes), F.lit(":"), F.lit("."))


def squared_distance(x1, y1, x2, y2) -> Column:
    dx, dy = _col(x1) - _col(x2), _col(y1) - _col(y2)
    return dx * dx + dy * dy


def court_side(x, middle: float = 47) -> Column:
    """Half of the court; NULL exactly on the middle line."""
    c = _col(x)
    return F.when(c < middle, "left").when(c > middle, "right")
