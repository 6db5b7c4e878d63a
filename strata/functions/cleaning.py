"""Column-level cleaning and parsing functions (Column → Column).

Every function is a composition of built-in Spark SQL expressions, so plans stay
inside whole-stage codegen; nothing here runs Python per row.

"safe" parsers return NULL on malformed input (``try_cast``); pass
``strict=True`` to get the plain ``cast`` of the warehouse models, which raises
on malformed text under ANSI mode.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference behaviour).
# Whitespace class collapsed by clean_string: blank, tab, newline, form feed, carriage return.
WHITESPACE_CLASS = "[ \t\n\f\r]+"
# Characters kept by the numeric parser: digits, dot and minus.
NUMERIC_STRIP = "[^0-9.\\-]+"
# parse_bool_safe vocabulary (compared after lower-casing, no trimming).
BOOL_TRUE = ("true", "1", "t", "y", "yes")
BOOL_FALSE = ("false", "0", "f", "n", "no")
# coerce_bool vocabulary (compared after trim + lower-casing).
COERCE_TRUE = ("true", "yes", "y", "1")
COERCE_FALSE = ("false", "no", "n", "0")
# Default transaction labels of the models and checks.
DEPOSIT = "deposit"
WITHDRAW = "withdraw"

DEFAULT_NUMERIC = "decimal(38,9)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_text(c) -> Column:
    return _c(c).cast("string")


def _strip(c: Column) -> Column:
    """Strip leading/trailing whitespace of any kind (like Python ``str.strip``)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


# FN-01 / FN-02
def clean_string(c, to_lower: bool = True) -> Column:
    """Text → (lower) → whitespace runs to one blank → trim blanks."""
    s = _as_text(c)
    if to_lower:
        s = F.lower(s)
    return F.trim(F.regexp_replace(s, WHITESPACE_CLASS, " "), F.lit(" "))


# FN-03
def normalize_country_iso2(c) -> Column:
    """Upper-cased code, white space of any kind stripped, when it has exactly two characters, else NULL."""
    t = _strip(_as_text(c))
    return F.when(F.length(t) == 2, F.upper(t))


def _to_utc_ntz(text: Column, strict: bool) -> Column:
    # Zoned text ("...+00:00") is converted to UTC via the (UTC) session zone;
    # zone-less text is taken as UTC wall clock. Result: timestamp_ntz.
    # The cast reads text without a date ("12:30:00", "T1") as a time of the current
    # day: only text that begins with a year is a timestamp.
    if strict:
        dated = text.isNull() | text.rlike(r"^\s*\d{4}(-|\s*$)")
        ts = F.when(dated, text.cast("timestamp")).otherwise(F.raise_error(F.concat(F.lit("not a timestamp: "), text)))
    else:
        # other text is extracted as '', which casts to NULL: one pass, where a guard would evaluate ``text`` twice
        ts = F.regexp_extract(text, r"(?s)^\s*\d{4}(?:-.*|\s*)\z", 0).try_cast("timestamp")
    return ts.cast("timestamp_ntz")


# FN-04
def parse_timestamp_safe(c, strict: bool = False) -> Column:
    """``''`` → NULL, then text → timestamp (UTC, no zone)."""
    return _to_utc_ntz(F.nullif(_as_text(c), F.lit("")), strict)


# FN-05
def parse_bool_safe(c) -> Column:
    s = F.lower(_as_text(c))
    return F.when(s.isin(*BOOL_TRUE), F.lit(True)).when(s.isin(*BOOL_FALSE), F.lit(False))


# FN-06
def parse_numeric_safe(c, strict: bool = False, dtype: str = DEFAULT_NUMERIC) -> Column:
    """Drop everything but digits, ``.`` and ``-``; cast to decimal."""
    s = F.regexp_replace(_as_text(c), NUMERIC_STRIP, "")
    return s.cast(dtype) if strict else s.try_cast(dtype)


# FN-07
def normalize_txn_sign(type_col, amount_col, deposit: str = DEPOSIT, withdraw: str = WITHDRAW) -> Column:
    t = F.lower(_c(type_col))
    a = _c(amount_col)
    return F.when(t == deposit, a).when(t == withdraw, -a)


# FN-08
def kyc_txn_filter(ts, flag, approved_at) -> Column:
    return (_c(flag) == F.lit(True)) & (_c(ts) >= _c(approved_at))


# FN-09 / FN-17
def to_int64(c, strict: bool = False) -> Column:
    """Numeric text (also ``1.0``) → bigint, rounding half-up through decimal(38,0)."""
    s = _as_text(c)
    if strict:
        return s.cast("decimal(38,0)").cast("bigint")
    return s.try_cast("decimal(38,0)").try_cast("bigint")


# FN-10
def txn_day(c) -> Column:
    return F.to_date(_c(c))


# FN-11
def approved_at(flag, updated, created) -> Column:
    return F.when(_c(flag), F.coalesce(_c(updated), _c(created)))


# FN-12
def conditional_amounts(type_col, amount_col, deposit: str = DEPOSIT,
                        withdraw: str = WITHDRAW) -> tuple[Column, Column]:
    """(deposit amount else 0, minus withdraw amount else 0)."""
    t = F.lower(_c(type_col))
    a = _c(amount_col)
    zero = F.lit(0)
    return F.when(t == deposit, a).otherwise(zero), F.when(t == withdraw, -a).otherwise(zero)


# FN-13
def coerce_bool(c) -> Column:
    s = F.lower(_strip(_as_text(c)))
    return F.when(s.isin(*COERCE_TRUE), F.lit(True)).when(s.isin(*COERCE_FALSE), F.lit(False))


# FN-14
# The date formats told apart, as pattern and shape (month before day where both could be meant), and
# the time of day that may follow.  Text that begins with "yyyy-" needs no format.
DATE_SHAPES = {
    "M/d/yyyy": r"(\d{1,2})/(\d{1,2})/\d{4}", "d/M/yyyy": r"(\d{1,2})/(\d{1,2})/\d{4}",
    "M-d-yyyy": r"(\d{1,2})-(\d{1,2})-\d{4}", "d-M-yyyy": r"(\d{1,2})-(\d{1,2})-\d{4}",
    "M.d.yyyy": r"(\d{1,2})\.(\d{1,2})\.\d{4}", "d.M.yyyy": r"(\d{1,2})\.(\d{1,2})\.\d{4}",
    "yyyy/M/d": r"\d{4}/\d{1,2}/\d{1,2}", "yyyyMMdd": r"\d{8}",
    "MMM d, yyyy": r"[A-Za-z]{3} \d{1,2}, \d{4}", "MMMM d, yyyy": r"[A-Za-z]{4,9} \d{1,2}, \d{4}",
    "d MMM yyyy": r"\d{1,2} [A-Za-z]{3} \d{4}", "d MMMM yyyy": r"\d{1,2} [A-Za-z]{4,9} \d{4}",
}
TIME_SHAPES = {"": "", " H:mm": r" \d{1,2}:\d{2}", " H:mm:ss": r" \d{1,2}:\d{2}:\d{2}",
               " h:mm a": r" \d{1,2}:\d{2} [AaPp][Mm]", " h:mm:ss a": r" \d{1,2}:\d{2}:\d{2} [AaPp][Mm]"}
ISO = "iso"


def _shape(fmt: str) -> str:
    date = next(d for d in sorted(DATE_SHAPES, key=len, reverse=True) if fmt.startswith(d) and fmt[len(d):] in TIME_SHAPES)
    return f"^{DATE_SHAPES[date]}{TIME_SHAPES[fmt[len(date):]]}$"


def guess_datetime_format(value: str | None) -> str:
    """The format of one text: ``iso`` for text that begins with a year and a dash, or that no known format fits."""
    text = (value or "").strip()
    for date, shape in DATE_SHAPES.items():
        for time, more in TIME_SHAPES.items():
            m = re.match(f"^{shape}{more}$", text)
            if m and not (m.groups() and int(m.group(1 if date[0] == "M" else 2)) > 12):
                return date + time
    return ISO


def infer_datetime_formats(df: DataFrame, cols: Sequence[str], order: Sequence) -> dict[str, str]:
    """Per column the format of its first non-blank value under ``order``: one aggregate for all columns, one row to the driver."""
    ords = [F.col(o) if isinstance(o, str) else o for o in order]
    firsts = [F.min(F.when(~is_blank(c), F.struct(F.struct(*ords).alias("o"), _as_text(c).alias("v")))).alias(c) for c in cols]
    row = df.agg(*firsts).first() if cols else {}
    return {c: guess_datetime_format(row[c]["v"] if row[c] is not None else None) for c in cols}


def parse_datetime_utc(c, fmt: str = ISO) -> Column:
    """Unparseable (or blank) → NULL; result in UTC without zone.

    With a format (see ``infer_datetime_formats``) text of any other shape is NULL.
    """
    if fmt == ISO:
        return _to_utc_ntz(_as_text(c), strict=False)    # the cast ignores white space at both ends
    s = F.nullif(_strip(_as_text(c)), F.lit(""))
    return F.when(s.rlike(_shape(fmt)), F.try_to_timestamp(s, F.lit(fmt))).cast("timestamp_ntz")


# FN-15
def is_blank(c) -> Column:
    return _c(c).cast("string").rlike(r"^\s*$")


def blank_to_null(df, cols):
    """Whitespace-only strings → NULL for each listed column that exists."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.when(~is_blank(c), F.col(c)) for c in present}) if present else df


# FN-16
def normalize_code(c) -> Column:
    """Strip, upper-case, blank → NULL (NULL stays NULL)."""
    return F.nullif(F.upper(_strip(_as_text(c))), F.lit(""))


# FN-18
def is_not_true(c) -> Column:
    """``c IS DISTINCT FROM TRUE``."""
    return ~_c(c).eqNullSafe(F.lit(True))


# FN-19
def first_non_null(*cols) -> Column:
    return F.coalesce(*[_c(c) for c in cols])


# FN-20
def offset(c, days=0, minutes=0) -> Column:
    """Timestamp plus whole days and minutes (each an int or a Column)."""
    d = days if isinstance(days, Column) else F.lit(int(days))
    m = minutes if isinstance(minutes, Column) else F.lit(int(minutes))
    return F.timestamp_add("MINUTE", d.cast("bigint") * 1440 + m.cast("bigint"), _c(c))
