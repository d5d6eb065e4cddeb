"""Text cleaning rules as column expressions (no Python runs per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and tokens of the cleaning rules.
SYMBOLS = r"[#@$%&]+"
EMAIL_NOISE = r"[#$%&\s]+"
EMAIL_SHAPE = "%@%.%"
NOT_DIGIT = "[^0-9]"
NOT_LETTER_OR_SPACE = "[^A-Za-z ]"
COMMAS = "[,]+"
EXTENSION_MARK = "x"
UNKNOWN_CITIES = ("??", "###", "@@@", "")
COUNTRY_PREFIX = "+1"


def strip_symbols(c: Column) -> Column:
    return F.regexp_replace(c, SYMBOLS, "")


def initcap_words(c: Column, delimiters: str | None = None) -> Column:
    """First letter of every word upper, the rest lower.

    Words end at blanks only (Spark's ``initcap``); with ``delimiters`` every listed
    character ends a word, so ``"' -"`` turns ``o'neil-smith`` into ``O'Neil-Smith``.
    """
    if delimiters is None:
        return F.initcap(c)
    members = "".join("\\" + d for d in delimiters)
    pieces = F.regexp_extract_all(F.lower(c), F.lit(f"([^{members}]+|[{members}]+)"), F.lit(1))
    capitalised = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))
    )
    return F.array_join(capitalised, "")


def clean_name(c: Column) -> Column:
    return initcap_words(F.trim(strip_symbols(c)))


def clean_email(c: Column) -> Column:
    """Drop noise and blanks (``@`` stays), lower-case; NULL unless it looks like an address."""
    address = F.lower(F.trim(F.regexp_replace(c, EMAIL_NOISE, "")))
    return F.when(address.like(EMAIL_SHAPE), address)


def phone_digits(c: Column) -> Column:
    """Digits before the first ``x`` (the extension mark, also inside a word)."""
    return F.regexp_replace(F.substring_index(F.lower(c), EXTENSION_MARK, 1), NOT_DIGIT, "")


def normalize_phone(c: Column) -> Column:
    """Phone text to ``+1...`` where the digits are recognisably North American."""
    digits = phone_digits(c)
    size = F.length(digits)
    return (
        F.when(size == 0, F.lit(None))
        .when(digits.startswith("001"), F.concat(F.lit(COUNTRY_PREFIX), F.substr(digits, F.lit(4))))
        .when(size == 10, F.concat(F.lit(COUNTRY_PREFIX), digits))
        .when((size == 11) & digits.startswith("1"), F.concat(F.lit("+"), digits))
        .otherwise(digits)
    )


def clean_city(c: Column) -> Column:
    city = F.trim(strip_symbols(c))
    return F.when(~city.isin(*UNKNOWN_CITIES), initcap_words(city))


def clean_label(c: Column) -> Column:
    """Symbols out, outer blanks out, words capitalised; empty text stays empty."""
    return initcap_words(F.trim(strip_symbols(c)))


def clean_hotel_name(c: Column) -> Column:
    spaced = F.translate(strip_symbols(c), "-", " ")
    return initcap_words(F.trim(F.regexp_replace(spaced, COMMAS, "")))


def clean_shift(c: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(c, NOT_LETTER_OR_SPACE, "")))


def clean_comments(c: Column) -> Column:
    """Symbols out, words capitalised; text with nothing left is NULL."""
    return initcap_words(F.nullif(F.trim(strip_symbols(c)), F.lit("")))


def clean_sentiment(c: Column) -> Column:
    return initcap_words(F.trim(c))
