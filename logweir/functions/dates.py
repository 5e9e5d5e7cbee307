"""Day arithmetic as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------------
DEFAULT_READY_AFTER = "48:00"
RETRY_BASE_SECONDS = 300
# ----------------------------------------------------------------------------------------------------


def day_path(text: Column, today: Column | None = None) -> Column:
    """``YYYY-MM-DD``, ``yesterday`` or ``twodaysago`` as ``YYYY/MM/DD``; NULL for anything else."""
    today = F.current_date() if today is None else today
    day = (
        F.when(text == "yesterday", F.date_sub(today, 1))
        .when(text == "twodaysago", F.date_sub(today, 2))
        .when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))
    )
    return F.date_format(day, "yyyy/MM/dd")


def next_day(day: Column, step: int = 1) -> Column:
    return F.date_add(day, step)


def day_range(start: Column, end: Column, step: int = 1) -> Column:
    """All days from start to end inclusive, as an array; empty when the end is before the start."""
    days = F.sequence(start, F.greatest(start, end), F.make_dt_interval(F.lit(step)))
    return F.when(end >= start, days).when(end < start, F.array().cast("array<date>"))


def stepper_range(start: Column, end: Column, step: int = 1) -> Column:
    """Like ``day_range``, with swapped bounds exchanged."""
    return day_range(F.least(start, end), F.greatest(start, end), step)


def day_count(start: Column, end: Column, step: int = 1) -> Column:
    """Number of days of a range with a step."""
    return F.size(day_range(start, end, step))


def _day_or_none(day: Column) -> Column:
    """An empty text is no day; dates stay dates."""
    return F.when(day.cast("string") != "", day)


def earlier(a: Column, b: Column) -> Column:
    """The earlier of two days; an empty or missing one is ignored."""
    return F.least(_day_or_none(a), _day_or_none(b))


def later(a: Column, b: Column) -> Column:
    """The later of two days; an empty or missing one is ignored."""
    return F.greatest(_day_or_none(a), _day_or_none(b))


def ready_after(delay: Column, arguments: Column) -> Column:
    """The ``HH:MM`` delay that applies: from the JSON arguments, else the column, else 48 hours."""
    own = F.get_json_object(arguments, "$.time_log_need_to_be_available")
    return F.coalesce(own, delay, F.lit(DEFAULT_READY_AFTER))


def ready_day(now: Column, delay: Column, arguments: Column, known_complete: Column | None = None) -> Column:
    """The last day whose data must be there: known, or the day of ``now`` minus the delay."""
    parts = F.split(ready_after(delay, arguments), ":")
    wait = F.make_dt_interval(F.lit(0), parts[0].cast("int"), parts[1].cast("int"))
    by_clock = F.to_date(now - wait)
    return by_clock if known_complete is None else F.coalesce(known_complete, by_clock)


def retry_delay_seconds(failures: Column) -> Column:
    """Exponential back-off: 300 s times two to the number of failures."""
    return (F.lit(RETRY_BASE_SECONDS) * F.pow(F.lit(2.0), failures)).cast("bigint")


def is_saturday(day: Column) -> Column:
    return F.dayofweek(day) == 7
