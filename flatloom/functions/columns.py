"""Small column expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The slice file name carries "slice", a separator and the range
# of parent keys in the file, as in "slice.2000-2999.json".
SLICE_RANGE = r"slice[.=](\d+)-(\d+)"


def text_flag(value: Column) -> Column:
    """The texts "true" and "false" as a boolean; NULL stays NULL for the not-null check."""
    return value == F.lit("true")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as an instant."""
    return F.timestamp_seconds(seconds)


def timestamp_to_epoch(value: str) -> Column:
    """Epoch seconds of a zone-less timestamp column, whatever the session's time zone."""
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', `{value}`)")


def slice_range_start(path: Column) -> Column:
    """First parent key named in a slice path, as a number; NULL if the name has none."""
    return F.try_element_at(F.regexp_extract_all(path, F.lit(SLICE_RANGE), F.lit(1)), F.lit(-1)).try_cast("long")


def first_number(text: Column) -> Column:
    """The first run of digits after a slash, as an int; NULL where there is none or it is too long."""
    return F.regexp_extract(text, r"/([0-9]+)", 1).try_cast("int")


def json_field(text: Column, name: str, dtype: str) -> Column:
    """One field of a JSON text, parsed with an explicit type; malformed text fails the job."""
    return F.from_json(text, f"`{name}` {dtype}", {"mode": "FAILFAST"})[name]


def bounded_rate(amount: Column, seconds: Column, digits: int | None = None) -> Column:
    """Amount per second, NULL for a zero duration; ``digits`` rounds half to even."""
    rate = F.try_divide(amount, seconds)
    return rate if digits is None else F.bround(rate, digits)
