"""Number -> label formatting (X11-X15), as column expressions.

Rounding is half-to-even on the binary value (``bround``) before any text is
made, so a label never depends on the formatter's own rounding mode.  Negative
zero is normalised away ("-0%" never appears).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: short-scale and time-span suffixes -------------------------
SHORT_SCALE = ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K"))
TIMESPAN_UNITS = ((604800.0, "w"), (86400.0, "d"), (3600.0, "h"), (60.0, "m"), (1.0, "s"),
                  (1e-3, "ms"), (1e-6, "us"))
TIMESPAN_SMALLEST = (1e-9, "ns")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fixed(x: Column, digits: int) -> Column:
    """``x`` rounded half-even to ``digits`` decimals, as text without grouping."""
    if digits <= 0:
        return F.bround(x, 0).cast("bigint").cast("string")
    return F.format_string(f"%.{digits}f", F.bround(x, digits) + F.lit(0.0))


def pct(x, digits: int = 0) -> Column:
    """``label_percent(accuracy = 10^-digits)``: 0.285 -> "28%" (half-even)."""
    return F.concat(_fixed(_c(x).cast("double") * 100, digits), F.lit("%"))


def comma(x) -> Column:
    """``label_comma(1)``: 18401 -> "18,401"."""
    return F.format_number(F.bround(_c(x).cast("double"), 0) + F.lit(0.0), 0)


def number(x, digits: int = 1, suffix: str = "") -> Column:
    """``label_number(accuracy = 10^-digits, suffix = suffix)``."""
    return F.concat(_fixed(_c(x).cast("double"), digits), F.lit(suffix))


def short_scale(x, digits: int = 1, unscaled_digits: int | None = None) -> Column:
    """``label_number(scale_cut = cut_short_scale())``: 18401 -> "18.4K".
    ``unscaled_digits`` sets the decimals of values below one thousand
    (default: ``digits``)."""
    v = _c(x).cast("double")
    a = F.abs(v)
    out = None
    for bound, suffix in SHORT_SCALE:
        branch = number(v / bound, digits, suffix)
        out = F.when(a >= bound, branch) if out is None else out.when(a >= bound, branch)
    return out.otherwise(number(v, digits if unscaled_digits is None else unscaled_digits))


def timespan(x, unit: str = "secs", digits: int = 0) -> Column:
    """``label_timespan(unit = unit, space = FALSE)``: the value is converted to
    seconds and shown in the largest unit it reaches (12.5 min -> "12m")."""
    factor = {"secs": 1.0, "mins": 60.0, "hours": 3600.0, "days": 86400.0, "weeks": 604800.0}[unit]
    s = _c(x).cast("double") * factor
    a = F.abs(s)
    out = F.when(s == 0, number(s, digits, "s"))
    for bound, suffix in TIMESPAN_UNITS:
        out = out.when(a >= bound, number(s / bound, digits, suffix))
    b, suffix = TIMESPAN_SMALLEST
    return out.otherwise(number(s / b, digits, suffix))


def sentence_case(x) -> Column:
    c = _c(x)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))
