"""Column functions of the cleansing layer; none raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """Trimmed text; blank is null."""
    return F.nullif(F.trim(c), F.lit(""))


def folded(c: Column) -> Column:
    return F.upper(present(c))


def titled(c: Column) -> Column:
    return F.initcap(present(c))


def instant(c: Column, tz: str) -> Column:
    """The instant that a text names: ISO-8601, epoch milliseconds or seconds, or local day-month-year; else null.

    Texts without a zone are local times of ``tz``, whatever the session's zone is.
    """
    zoned = F.concat_ws(" ", c, F.lit(tz))
    iso = F.try_to_timestamp(F.when(c.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), c).otherwise(zoned))
    number = c.try_cast("bigint")
    shapes = {
        r"\d{4}-\d{2}-\d{2}T.*": iso,
        r"\d{13}": F.timestamp_millis(number),
        r"\d{10}": F.timestamp_seconds(number),
        r"\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}": F.try_to_timestamp(zoned, F.lit("dd-MM-yyyy HH:mm:ss VV")),
    }
    return F.coalesce(*(F.when(c.rlike(f"^{shape}$"), value) for shape, value in shapes.items()))


def number(c: Column) -> Column:
    return c.try_cast("double")


def whole(c: Column) -> Column:
    return c.try_cast("int")


def masked_address(c: Column) -> Column:
    """``meera.rao@bankx`` becomes ``me***@bankx``; null stays null."""
    return F.concat(F.left(F.substring_index(c, "@", 1), F.lit(2)), F.lit("***@"), F.substring_index(c, "@", -1))


def masked_phone(c: Column) -> Column:
    """The last four digits; null stays null."""
    return F.concat(F.lit("XXXXXX"), F.right(c, F.lit(4)))


def keyed(c: Column, salt: str) -> Column:
    """16 hex digits of the salted SHA-256: a stable join key that names nobody; null stays null."""
    return F.left(F.sha2(F.concat(F.lit(salt), c), 256), F.lit(16))


def local(c: Column, tz: str) -> Column:
    """The wall clock of an instant in ``tz``, without regard to the session's zone.

    Not by way of the session's wall clock, which shows one hour twice where summer time ends.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch))


def day(c: Column) -> Column:
    """Year-month-day of a wall clock; ``date_format`` would move times that the session's zone leaves out."""
    return c.cast("date").cast("string")


def local_date(c: Column, tz: str) -> Column:
    return day(local(c, tz))


def local_hour(c: Column, tz: str) -> Column:
    return F.hour(local(c, tz))


def money(c: Column) -> Column:
    """For sums that do not depend on the order of rows."""
    return c.cast("decimal(18,2)")


def rounded(c: Column, digits: int) -> Column:
    return F.round(c.cast("double"), digits)


def ratio(part: Column, total: Column, digits: int) -> Column:
    """Null when there is nothing to divide by."""
    return rounded(F.try_divide(part.cast("double"), total.cast("double")), digits)
