"""Column expressions: casts, keys, buckets, labels.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanlens import config as C


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- casts -----------------------------------------------------------------

def safe_int(col: str | Column) -> Column:
    """Integer or NULL; accepts '5.0' (whole decimal) like the contract does."""
    return F.trim(_c(col).cast("string")).try_cast("decimal(38,0)").try_cast("int")


def safe_decimal(col: str | Column, precision: int = 10, scale: int = 1) -> Column:
    """decimal(p,s) or NULL."""
    return F.trim(_c(col).cast("string")).try_cast(f"decimal({precision},{scale})")


def strict_date(col: str | Column) -> Column:
    """ANSI cast; accepts 'yyyy-MM-dd' and 'yyyy-MM-dd 00:00:00', errors otherwise."""
    return _c(col).cast("date")


def time_text(col: str | Column) -> Column:
    """TIME kept as 'HH:mm:ss' text (Spark has no TIME column type by default)."""
    t = F.to_timestamp_ntz(F.concat(F.lit("1970-01-01 "), _c(col)), F.lit("yyyy-MM-dd H:mm[:ss]"))
    return format_ntz(t, "HH:mm:ss")


def timestamp_from_parts(date_col: str | Column, time_col: str | Column) -> Column:
    """NTZ timestamp from a date and an 'H:mm[:ss]' time."""
    return F.to_timestamp_ntz(
        F.concat_ws(" ", F.date_format(_c(date_col), "yyyy-MM-dd"), _c(time_col)),
        F.lit("yyyy-MM-dd H:mm[:ss]"))


_FIELDS = {"yyyy": ("year", r"(\d{4})"), "MM": ("month", r"(\d{2})"), "M": ("month", r"(\d{1,2})"),
           "dd": ("day", r"(\d{2})"), "d": ("day", r"(\d{1,2})"), "HH": ("hour", r"(\d{2})"),
           "H": ("hour", r"(\d{1,2})"), "mm": ("minute", r"(\d{2})"), "ss": ("second", r"(\d{2})")}


def _pattern_regex(fmt: str) -> tuple[str, list[str]]:
    """Anchored regex with one group per date-time field of a simple pattern."""
    rx, fields, i = "^", [], 0
    while i < len(fmt):
        tok = next((t for t in ("yyyy", "MM", "dd", "HH", "mm", "ss", "M", "d", "H") if fmt.startswith(t, i)), None)
        if tok:
            name, group = _FIELDS[tok]
            rx, i = rx + group, i + len(tok)
            fields.append(name)
        else:
            rx, i = rx + ("\\s+" if fmt[i] == " " else "\\" + fmt[i] if not fmt[i].isalnum() else fmt[i]), i + 1
    return rx + "$", fields


_DIGITS = {"yyyy": (4, F.year), "MM": (2, F.month), "M": (1, F.month), "dd": (2, F.dayofmonth),
           "d": (1, F.dayofmonth), "HH": (2, F.hour), "H": (1, F.hour), "mm": (2, F.minute),
           "ss": (2, F.second)}


def _digits(number: Column, width: int) -> Column:
    """A number with leading zeros to a width, as ``format_string`` renders it (NULL: 'null'),
    at a fraction of its cost; that is left for numbers that don't fit the width."""
    plain = F.lpad(number.cast("string"), width, "0") if width > 1 else number.cast("string")
    if width == 4:
        plain = F.when(number.between(0, 9999), plain).when(number.isNotNull(), F.format_string("%04d", number))
    return F.coalesce(plain, F.lit("null"))


def format_ntz(ts: str | Column, fmt: str) -> Column:
    """Render a timestamp_ntz by a simple pattern from its fields.

    ``date_format`` passes a timestamp_ntz through the session time zone, which
    moves wall-clock times inside a daylight-saving gap; field extraction does
    not, so this is exact in every zone."""
    t = _c(ts)
    parts, i = [], 0
    while i < len(fmt):
        tok = next((k for k in ("yyyy", "MM", "dd", "HH", "mm", "ss", "M", "d", "H") if fmt.startswith(k, i)), None)
        if tok:
            width, fn = _DIGITS[tok]
            parts, i = [*parts, _digits(fn(t), width)], i + len(tok)
        else:
            parts, i = [*parts, F.lit(fmt[i])], i + 1
    return F.concat(*parts)


def safe_timestamp(col: str | Column, fmt: str = "M/d/yyyy H:mm") -> Column:
    """NTZ timestamp by one format, NULL when the text does not match or is no
    valid date. Fields are read by pattern and assembled without a zone, so the
    result never depends on one (a parse through the session zone would move times
    inside a daylight-saving gap)."""
    rx, fields = _pattern_regex(fmt)
    c = F.trim(_c(col))
    at = {name: f"${i}" for i, name in enumerate(fields, 1)}
    if "second" not in at and {"year", "month", "day"} <= set(at):
        # one replacement puts the fields in the order a cast reads; any other text is left without them
        iso = f"{at['year']}-{at['month']}-{at['day']} {at.get('hour', '0')}:{at.get('minute', '0')}:0"
        return F.regexp_replace(c, f"{rx}|(?s)^.*$", iso).try_cast("timestamp_ntz")

    def assembled(numbers: Column) -> Column:
        part = {name: F.get(numbers, F.lit(i)).try_cast("int") for i, name in enumerate(fields)}
        return F.try_make_timestamp_ntz(part["year"], part["month"], part["day"], part.get("hour", F.lit(0)),
                                        part.get("minute", F.lit(0)), part.get("second", F.lit(0)))

    # the text is split once for all fields: a plain reference per field would split it each time
    ts = F.get(F.transform(F.array(F.split(c, "[^0-9]+")), assembled), F.lit(0))
    return F.when(c.rlike(rx), ts)


# --- keys ------------------------------------------------------------------

def surrogate_key(*parts: str | Column) -> Column:
    """md5 over parts rendered as text, NULL-safe and order-sensitive."""
    rendered = [F.coalesce(_c(p).cast("string"), F.lit(C.KEY_NULL_SENTINEL)) for p in parts]
    return F.md5(F.concat_ws(C.KEY_DELIMITER, *rendered))


def conditional_key(cond: Column, *parts: str | Column) -> Column:
    """P10: surrogate key only where ``cond`` holds, NULL otherwise."""
    return F.when(cond, surrogate_key(*parts))


def date_key(col: str | Column) -> Column:
    """Integer YYYYMMDD, from the fields (a formatter costs several times as much)."""
    d = _c(col)
    year = F.year(d)
    of_era = F.when(year > 0, year).otherwise(1 - year)
    return (of_era * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(col: str | Column) -> Column:
    return F.to_date(_c(col).cast("string"), "yyyyMMdd")


# --- buckets ---------------------------------------------------------------

def _bucket_below(col: Column, buckets: Sequence) -> Column:
    expr = None
    for bound, label in buckets:
        if bound is None:
            expr = expr.otherwise(F.lit(label)) if expr is not None else F.lit(label)
        else:
            cond = col < F.lit(bound)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def duration_bucket(col: str | Column) -> Column:
    """Five labels at 300/900/1800/3600 s (NULL falls to the last)."""
    return _bucket_below(_c(col), C.DURATION_BUCKETS)


def temperature_bucket(col: str | Column) -> Column:
    """Four ordered labels at 0/10/20 degrees; NULL falls into the warm label."""
    return _bucket_below(_c(col), C.TEMPERATURE_BUCKETS)


def delay_day_bucket(col: str | Column) -> Column:
    """>500 high, >100 medium, else (NULL too) low."""
    c = _c(col)
    expr = None
    for bound, label in C.DELAY_DAY_BUCKETS:
        if bound is None:
            expr = expr.otherwise(F.lit(label))
        else:
            cond = c > F.lit(bound)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def weather_condition(snow: str | Column, rain: str | Column) -> Column:
    """Snow > Rain > Clear; Clear also covers NULL rain and snow (Q13)."""
    s, r = _c(snow), _c(rain)
    return (F.when(s > 0, F.lit("Snow"))
            .when((r > 0) & ((s == 0) | s.isNull()), F.lit("Rain"))
            .otherwise(F.lit("Clear")))


def right_closed_bin(col: str | Column, lo: int = C.TEMP_BIN_RANGE[0],
                     hi: int = C.TEMP_BIN_RANGE[1], step: int = C.TEMP_BIN_RANGE[2]) -> Column:
    """Q22: lower edge of the (l, l+step] bin holding the value; NULL outside (lo, hi]."""
    c = _c(col).cast("double")
    lower = (F.ceil(c / step) * step - step).cast("int")
    return F.when((c > lo) & (c <= hi), lower)


# --- labels and small helpers ------------------------------------------------

def period_label(year: str | Column, month: str | Column) -> Column:
    """P31: 'YYYY-MM'."""
    return F.format_string("%d-%02d", _c(year), _c(month))


def null_if_token(col: str | Column, tokens: Iterable[str] = C.NULL_TOKENS) -> Column:
    """Q24: map the NULL tokens of a delimited file to NULL."""
    c = _c(col)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def as_double(col: str | Column, default: float | None = None) -> Column:
    """P20: ``::float`` and ``coalesce(x, 0)::float``."""
    c = _c(col).cast("double")
    return F.coalesce(c, F.lit(float(default))) if default is not None else c


def one_of(col: str | Column, values: Iterable[str], domain: Iterable[str]) -> Column:
    """IN-list checked against a closed domain; empty or unknown values raise."""
    vals = sorted(set(values))
    if not vals:
        raise ValueError("at least one value required")
    bad = set(vals) - set(domain)
    if bad:
        raise ValueError(f"values outside the domain: {sorted(bad)}")
    return _c(col).isin(vals)
