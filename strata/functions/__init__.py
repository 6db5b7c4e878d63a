"""Column → Column helpers."""

from strata.functions.cleaning import (  # noqa: F401
    approved_at, blank_to_null, clean_string, coerce_bool, conditional_amounts,
    first_non_null, is_blank, is_not_true, kyc_txn_filter, normalize_code,
    normalize_country_iso2, normalize_txn_sign, offset, parse_bool_safe,
    parse_datetime_utc, parse_numeric_safe, parse_timestamp_safe, to_int64, txn_day,
)
