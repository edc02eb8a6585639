"""Scalar column functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "strip", "norm_text", "norm_city", "norm_state", "norm_zip", "blank_to_null",
    "to_ts", "to_num", "np_round", "clip", "floor_days_between", "hours_between",
    "month_bucket", "haversine_km", "strip_accents", "price_band", "feature_price_band",
    "score_band", "sentiment_band", "safe_ratio", "sentiment_of", "cents", "cents_sum",
    "ci_equal", "fixed_point", "WHITESPACE", "SENTIMENT_LABELS", "PRICE_BANDS",
]

# Characters pandas' ``str.strip()`` removes for our inputs.
WHITESPACE = " \t\n\r\f\u000b"

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim leading/trailing whitespace (not only blanks, like pandas)."""
    return F.trim(_c(c), F.lit(WHITESPACE))


def norm_text(c) -> Column:
    """Trim; ``''``, ``'nan'``, ``'None'`` become null."""
    s = strip(c)
    return F.when(s.isin("", "nan", "None"), F.lit(None).cast("string")).otherwise(s)


def norm_city(c) -> Column:
    """Trim + lower; blank (or the text 'nan') becomes null."""
    s = F.lower(strip(c))
    return F.when(s.isin("", "nan"), F.lit(None).cast("string")).otherwise(s)


def norm_state(c) -> Column:
    """Trim + upper; blank becomes null, null stays null (trap T3)."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def norm_zip(c, width: int = 5) -> Column:
    """P5: first digit run, left-padded to ``width``; never truncates (T4)."""
    d = F.nullif(F.regexp_extract(_c(c).cast("string"), r"(\d+)", 1), F.lit(""))
    return F.when(F.length(d) < width, F.lpad(d, width, "0")).otherwise(d)


def blank_to_null(c) -> Column:
    """Whitespace-only strings become null."""
    col = _c(c)
    return F.when(col.rlike(r"^\s*$"), F.lit(None).cast("string")).otherwise(col)


def to_ts(c) -> Column:
    """Unparseable -> null (``try_cast``)."""
    return F.expr(f"try_cast({c} as timestamp_ntz)") if isinstance(c, str) else c.try_cast("timestamp_ntz")


def to_num(c, dtype: str = "double") -> Column:
    """Unparseable -> null."""
    return _c(c).try_cast(dtype)


def np_round(c, digits: int) -> Column:
    """Numpy-style rounding: scale, round half to even, unscale.
    Bit-identical to ``numpy.round`` and to the oracle's
    ``round_even(x * 10^d, 0) / 10^d``."""
    scale = float(10 ** digits)
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def clip(c, lower=None, upper=None) -> Column:
    """Clip to bounds, null stays null (``greatest``/``least`` skip nulls)."""
    col = _c(c)
    out = col
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(col.isNull(), F.lit(None)).otherwise(out)


def _micros(a, b) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {a}, {b})") if isinstance(a, str) and isinstance(b, str) \
        else F.timestamp_diff("MICROSECOND", _c(a), _c(b))


def floor_days_between(start, end) -> Column:
    """whole days from ``start`` to ``end``, floored like pandas
    ``Timedelta.days`` (-5 h -> -1; trap T1)."""
    return F.floor(_micros(start, end) / F.lit(MICROS_PER_DAY)).cast("bigint")


def hours_between(start, end) -> Column:
    """fractional hours."""
    return _micros(start, end) / F.lit(float(MICROS_PER_HOUR))


def month_bucket(c) -> Column:
    """``yyyy-MM`` month label."""
    return F.date_format(_c(c), "yyyy-MM")


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = 6371.0) -> Column:
    """great-circle distance; any null coordinate gives null."""
    la1, lo1, la2, lo2 = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    dlat = la2 - la1
    dlon = lo2 - lo1
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(radius_km) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def _plain_letters() -> tuple[str, str]:
    """Characters whose compatibility decomposition is one ASCII character
    and marks, and that character (F6)."""
    found = {}
    for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if ord(c) < 128)
        if len(plain) == 1:
            found[chr(code)] = plain
    return "".join(found), "".join(found.values())


_ACCENTED, _PLAIN = _plain_letters()


def strip_accents(c) -> Column:
    """lower-case, marks dropped, and whatever is left outside ASCII dropped."""
    return F.lower(F.regexp_replace(F.translate(_c(c), _ACCENTED, _PLAIN), r"[^\x00-\x7F]", ""))


# Dashboard price bands, left-closed.
PRICE_BANDS = [(0, 50, "0-50"), (50, 100, "50-100"), (100, 200, "100-200"),
               (200, 500, "200-500"), (500, 1000, "500-1000"), (1000, None, "1000+")]


def price_band(c) -> Column:
    """band label; out of range (negative, null) -> null."""
    col = _c(c)
    expr = None
    for lo, hi, label in PRICE_BANDS:
        cond = (col >= lo) if hi is None else ((col >= lo) & (col < hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


# Thresholds and labels of the three feature bands below.
def feature_price_band(c) -> Column:
    """F8 price: null compares false everywhere -> ``price_high``."""
    col = _c(c)
    return (F.when(col < 50, "price_very_low").when(col < 150, "price_low")
            .when(col < 500, "price_medium").otherwise("price_high"))


def score_band(c) -> Column:
    col = _c(c)
    return (F.when(col.isNull() | F.isnan(col), "score_unknown").when(col >= 4.0, "score_high")
            .when(col >= 3.0, "score_medium").otherwise("score_low"))


def sentiment_band(c) -> Column:
    col = _c(c)
    return (F.when(col.isNull() | F.isnan(col) | (col == 0), "sentiment_unknown")
            .when(col >= 0.6, "sentiment_positive").when(col >= 0.3, "sentiment_neutral")
            .otherwise("sentiment_negative"))


def safe_ratio(a, b) -> Column:
    """a / b with division by zero (inf/NaN) -> 0."""
    return F.coalesce(F.try_divide(_c(a).cast("double"), _c(b).cast("double")), F.lit(0.0))


# Review score -> sentiment label.
SENTIMENT_LABELS = {1: "muito negativo", 2: "negativo", 3: "neutro", 4: "positivo", 5: "muito positivo"}


def sentiment_of(score) -> Column:
    col = _c(score)
    expr = None
    for k, label in SENTIMENT_LABELS.items():
        expr = F.when(col == k, label) if expr is None else expr.when(col == k, label)
    return expr


def cents(c) -> Column:
    """Money as exact integer cents (values are 2-decimal after silver)."""
    return F.rint(_c(c) * F.lit(100.0)).cast("bigint")


def cents_sum(c) -> Column:
    """Order-independent exact money sum (integer cents), as double."""
    return F.sum(cents(c)) / F.lit(100.0)


def fixed_point(c, digits: int = 6) -> Column:
    """Value as an exact integer at ``digits`` decimals (for exact sums)."""
    return F.rint(_c(c) * F.lit(float(10 ** digits))).cast("bigint")


def ci_equal(a, b) -> Column:
    """case-insensitive equality."""
    return F.upper(_c(a)) == F.upper(_c(b))


def exact_mean(c, digits: int):
    """Mean of a column carried at ``digits`` decimals, from an exact
    integer sum: the same value whatever the summation order."""
    col = _c(c)
    return F.try_divide(F.sum(F.rint(col * F.lit(float(10 ** digits))).cast("bigint")), F.count(col)) \
        / F.lit(float(10 ** digits))


__all__.append("exact_mean")
