"""Time expressions (FN13-FN19): all native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_HOUR = 3_600_000
MS_PER_MINUTE = 60_000


def hour_end_label(start: Column) -> Column:
    """Label of an hourly window as in the reference: (hour + 1) * 3,600,000 ms."""
    return ((F.hour(start) + 1).cast("long") * F.lit(MS_PER_HOUR))


def ms_of_day(start: Column) -> Column:
    """Milliseconds since midnight of a timestamp's hour and minute."""
    return ((F.hour(start) * 60 + F.minute(start)).cast("long") * F.lit(MS_PER_MINUTE))


def epoch_seconds(ts: Column) -> Column:
    """Seconds since the epoch (NTZ values are read in the session zone, UTC here)."""
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_seconds_of(df, col: str) -> Column:
    """Seconds since the epoch of a column, whatever its timestamp type:
    TIMESTAMP_NTZ wall-clock values are measured without a time zone, so a
    daylight-saving change in the session zone cannot shift them."""
    from pyspark.sql.types import TimestampNTZType
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_seconds(F.col(col).cast("timestamp"))


def parse_timestamp(col: Column, fmt: str | None = None) -> Column:
    """Lenient parse: bad input becomes NULL instead of raising under ANSI."""
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """FN16 date from parts; bad parts give NULL (never an ANSI error)."""
    s = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"),
                    F.lpad(month.cast("string"), 2, "0"),
                    F.lpad(day.cast("string"), 2, "0"))
    return F.try_to_date(s, "yyyy-MM-dd")


def format_day_month_year(ts: Column) -> Column:
    """FN19: dd/MM/yyyy text."""
    return F.date_format(ts, "dd/MM/yyyy")
