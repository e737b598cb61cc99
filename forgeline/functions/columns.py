"""Column expressions shared by the models (all JVM built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ISO-8601 form landed timestamps take ("...T...Z", microseconds).
ISO_UTC_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c




def day_of(c: str | Column) -> Column:
    """``date_trunc('day', x)::date``: calendar day of a naive timestamp."""
    return F.to_date(col_(c))


def same_day(a: str | Column, b: str | Column) -> Column:
    return day_of(a) == day_of(b)


def trailing_start(as_of, days: int = 28) -> Column:
    """``as_of - interval 'N days'`` as a midnight timestamp (inclusive lower bound)."""
    return F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")




def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(col_(c), F.lit(0).cast("bigint"))


def parse_target_list(text: str | None) -> list[str]:
    """``"a/b, ,c/d "`` -> ``["a/b", "c/d"]``: comma split, trim, drop blanks.

    A configuration value, parsed on the driver like any job parameter.
    """
    if not text:
        return []
    return [part.strip() for part in text.split(",") if part.strip()]


def chosen_targets(text: str | None, single: str | None = None) -> list[str]:
    """The repositories of a run: ``single`` alone if it is given, else the configured list."""
    one = (single or "").strip()
    return [one] if one else parse_target_list(text)


def parse_target_list_col(text: str | Column) -> Column:
    """Same parse as :func:`parse_target_list`, as a column expression."""
    raw = F.lit(text) if isinstance(text, str) else text
    parts = F.transform(F.split(raw, ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def count_where(cond: Column) -> Column:
    """``count(*) filter (where cond)`` as a bigint."""
    return F.count_if(cond).cast("bigint")



def session_tz(spark) -> str:
    return spark.conf.get("spark.sql.session.timeZone", "UTC") or "UTC"


def utc_instant(c: str | Column, spark) -> Column:
    """Naive UTC wall clock (``timestamp_ntz``) -> instant (``timestamp``), whatever the session zone.

    A plain cast would read the wall clock in the session zone.
    """
    tz = session_tz(spark)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col_(c)).cast("timestamp")


def utc_wall_clock(c: str | Column, spark) -> Column:
    """Instant (``timestamp``) -> naive UTC wall clock (``timestamp_ntz``)."""
    tz = session_tz(spark)
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), col_(c).cast("timestamp_ntz"))


def ntz_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from text or a naive datetime (no zone conversion on the way)."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")
