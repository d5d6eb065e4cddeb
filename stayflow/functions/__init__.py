from stayflow.functions.measures import (
    changed,
    count_when,
    customer_tier,
    label_is,
    percent,
    performance_band,
    ratio,
    same,
)
from stayflow.functions.parse import null_if_sentinel, parse_decimal, parse_flag, parse_key, parse_number, parse_ts
from stayflow.functions.text import (
    clean_city,
    clean_comments,
    clean_email,
    clean_hotel_name,
    clean_label,
    clean_name,
    clean_sentiment,
    clean_shift,
    initcap_words,
    normalize_phone,
    phone_digits,
    strip_symbols,
)

__all__ = [
    "changed",
    "clean_city",
    "clean_comments",
    "clean_email",
    "clean_hotel_name",
    "clean_label",
    "clean_name",
    "clean_sentiment",
    "clean_shift",
    "count_when",
    "customer_tier",
    "initcap_words",
    "label_is",
    "normalize_phone",
    "null_if_sentinel",
    "parse_decimal",
    "parse_flag",
    "parse_key",
    "parse_number",
    "parse_ts",
    "percent",
    "performance_band",
    "phone_digits",
    "ratio",
    "same",
    "strip_symbols",
]
