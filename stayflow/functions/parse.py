"""Safe text-to-type conversions. Bad text becomes NULL; nothing raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value".
FILE_NULL_TOKENS = ("", "null", "none", "nan", "??")
AMOUNT_SENTINELS = ("NAN", "NONE", "??", "", "NULL")
PRICE_SENTINELS = ("NAN", "??", "", "NULL")
RATING_SENTINELS = ("NAN", "", "NULL")
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def parse_number(c: Column, to: str = "bigint") -> Column:
    """Text to integer, fractions rounded half away from zero.

    The step through decimal(38,0) does the rounding: a direct cast of '12.7' to an
    integer type yields NULL. Values beyond the target type become NULL too.
    """
    return c.try_cast("decimal(38,0)").try_cast(to)


def parse_key(c: Column) -> Column:
    """Text to a business key: a whole number of up to 38 digits, fractions rounded half away
    from zero. Anything else is NULL."""
    return c.try_cast("decimal(38,0)")


def parse_decimal(c: Column, precision: int = 10, scale: int = 2) -> Column:
    """Text to decimal(precision, scale), rounded half up; overflow gives NULL."""
    return c.try_cast(f"decimal({precision},{scale})")


def parse_ts(c: Column) -> Column:
    """Text to a zone-free timestamp. The time part is required: date-only text is NULL."""
    return F.try_to_timestamp(c, F.lit(TIMESTAMP_PATTERN)).cast("timestamp_ntz")


def null_if_sentinel(c: Column, tokens: Sequence[str]) -> Column:
    """NULL where the trimmed, upper-cased text is one of ``tokens`` (given in upper case)."""
    return F.when(~F.upper(F.trim(c)).isin(*tokens), c)


def parse_flag(c: Column, true_text: str = "YES", false_text: str = "NO") -> Column:
    """Two fixed words to boolean, ignoring case and outer blanks; anything else is NULL."""
    word = F.upper(F.trim(c))
    return F.when(word == true_text, F.lit(True)).when(word == false_text, F.lit(False))
