"""Column expressions that normalise text, identifiers, money, dates and timestamps.

Everything here is a built-in Spark expression, so it stays in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofre.schemas import MONEY, SOURCE_TIMEZONE

# Unicode white space, and the four separators that Java leaves out of it.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
NON_DIGIT = r"(?U)\D"
UTC_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"
CARD_MASK = "**** **** **** "
DAY = "interval 1 day"
# Full ISO date, with an optional time of day.
FULL_DATE = r"^\d{4}-\d{2}-\d{2}([ T].*)?$"


def tidy(text: Column) -> Column:
    """Trim, and make each run of white space one blank. Null stays null, empty stays empty."""
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def clean_text(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply :func:`tidy` to every string column, or to those among ``columns``."""
    chosen = set(df.columns if columns is None else columns)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name in chosen]
    return df.withColumns({name: tidy(F.col(name)) for name in texts})


def digits(text: Column) -> Column:
    return F.regexp_replace(text, NON_DIGIT, "")


def _digits_of_length(text: Column, length: int) -> Column:
    return F.when(F.length(digits(text)) == length, digits(text))


def normalize_cpf(text: Column) -> Column:
    """The 11 digits of a CPF, null when there are more or fewer."""
    return _digits_of_length(text, 11)


def normalize_card(text: Column) -> Column:
    """The 16 digits of a card number, null when there are more or fewer."""
    return _digits_of_length(text, 16)


def mask_card(number: Column) -> Column:
    """Hide all but the last four characters of a card number."""
    return F.concat(F.lit(CARD_MASK), F.right(number, F.lit(4)))


def normalize_money(value: Column, data_type: T.DataType | None = None) -> Column:
    """Amount with two decimals, rounded half to even; null when it is no number or too large.

    25 decimals are kept before rounding: 13 integer digits are all that the result can hold.
    A decimal column is rounded as it is, without the way through text.
    """
    if isinstance(data_type, T.DecimalType):
        return (value if data_type.scale <= 2 else F.bround(value, 2)).try_cast(MONEY)
    exact = F.translate(value.cast("string"), "_", "").try_cast("decimal(38,25)")
    return F.bround(exact, 2).try_cast(MONEY)


def normalize_date(value: Column) -> Column:
    """Calendar date of an ISO text, date or timestamp; null when it cannot be read.

    A text has year, month and day in full, the year with four digits, with or without a time after it.
    """
    return F.when(value.cast("string").rlike(FULL_DATE), value.try_cast("date"))


def local_to_utc(local: Column, zone: str = SOURCE_TIMEZONE) -> Column:
    """UTC time of a local time without zone, null in a clock-change gap or overlap.

    The offsets of the day before and the day after give two candidates. They agree unless the
    clock changed in between; then the local time is well defined when exactly one of them,
    read back in the zone, gives it again.
    """
    day = F.expr(DAY)
    before = F.convert_timezone(F.lit(zone), F.lit("UTC"), local - day) + day
    after = F.convert_timezone(F.lit(zone), F.lit("UTC"), local + day) - day
    before_holds = F.convert_timezone(F.lit("UTC"), F.lit(zone), before) == local
    after_holds = F.convert_timezone(F.lit("UTC"), F.lit(zone), after) == local
    near_change = F.when(before_holds & ~after_holds, before).when(after_holds & ~before_holds, after)
    return F.when(before == after, before).otherwise(near_change)


def instant_to_utc(instant: Column) -> Column:
    """UTC wall-clock time of a zoned timestamp, whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def normalize_timestamp(value: Column, data_type: T.DataType, zone: str = SOURCE_TIMEZONE) -> Column:
    """UTC time without zone. Zoned input is converted, other input is local time in ``zone``."""
    if isinstance(data_type, T.TimestampType):
        return instant_to_utc(value)
    local = local_to_utc(value.try_cast("timestamp_ntz"), zone)
    if isinstance(data_type, T.StringType):
        # Only a text with a time of day can end in an offset: 2024-05-01 ends in -01 too.
        zoned = value.rlike(r"\d:\d.*" + UTC_OFFSET)
        return F.when(zoned, instant_to_utc(value.try_cast("timestamp"))).otherwise(local)
    return local
