"""Numeric scalars and KPI formulas (S-06, F-08..F-14) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellfold.functions.text import jtrim

# Text accepted by java.math.BigDecimal(String): sign, digits with an optional
# point, optional exponent; no surrounding blanks.
_DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def nan() -> Column:
    """A NaN literal (NaN is a value here: 'nothing planned')."""
    return F.lit(float("nan"))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_read(ctype="ctype", num="num") -> Column:
    """S-06: the numeric view of a cell.

    numeric -> value, blank -> 0.0, formula -> cached number. A string,
    boolean, error or missing cell has no numeric view: NULL here, and
    ``numeric_read_error`` names why.
    """
    t, n = _c(ctype), _c(num)
    return (F.when(t == "numeric", n)
            .when(t == "blank", F.lit(0.0))
            .when((t == "formula") & n.isNotNull(), n)
            .otherwise(F.lit(None).cast("double")))


def numeric_read_error(ctype="ctype", num="num") -> Column:
    t, n = _c(ctype), _c(num)
    return (F.when(t.isNull(), F.lit("missing cell"))
            .when(t.isin("numeric", "blank"), F.lit(None).cast("string"))
            .when((t == "formula") & n.isNotNull(), F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("not numeric: "), t)))


def string_read(ctype="ctype", s="str") -> Column:
    """S-07: the string view: text cells (and formulas with a cached string)."""
    t, v = _c(ctype), _c(s)
    return (F.when(t == "string", v)
            .when(t == "blank", F.lit(""))
            .when((t == "formula") & v.isNotNull(), v)
            .otherwise(F.lit(None).cast("string")))


def clamp_nonneg(c) -> Column:
    """F-08: negatives become 0; NaN and NULL pass through."""
    x = _c(c)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def round_half_up(c, scale: int = 2) -> Column:
    """F-09: HALF_UP on the shortest decimal text of a double (Spark's round)."""
    return F.round(_c(c), scale)


def efficiency_pct(metered, unplanned) -> Column:
    """F-10: round(m / (m + u) * 100, 2); NULL when m + u = 0 (P-12 drops it).

    The zero test sits inside the expression so no reordering of filters can
    divide by zero under ANSI mode.
    """
    m, u = _c(metered), _c(unplanned)
    d = m + u
    return F.when(d != 0, round_half_up(m / d * 100, 2))


def completion_pct(planned_cnt, done_cnt) -> Column:
    """F-11: done/planned*100 (unrounded, may exceed 100); 0/0 -> NaN; x/0 -> 0."""
    p, d = _c(planned_cnt).cast("double"), _c(done_cnt).cast("double")
    return (F.when(p == 0, F.when(d == 0, nan()).otherwise(F.lit(0.0)))
            .otherwise(d / p * 100))


def parse_decimal_text(c) -> Column:
    """BigDecimal(String) parse; NULL when the text is not a decimal."""
    s = _c(c)
    return F.when(s.rlike(_DECIMAL_PATTERN), s.try_cast("decimal(38,18)"))


def text_percent(c) -> Column:
    """F-12/F-13: fraction text -> whole percent.

    round(x, 2) HALF_UP, clamp at 0, x 100, round 2; a parse failure is NaN.
    Decimal arithmetic keeps it exact.
    """
    x = F.round(parse_decimal_text(c), 2)
    x = F.when(x < 0, F.lit(0).cast("decimal(38,18)")).otherwise(x)
    pct = F.round(x * 100, 2).cast("double")
    return F.coalesce(pct, nan())


def guarded_percent(all_planned_zero, c) -> Column:
    """F-14: every planned quarter 0 -> NaN whatever the text says."""
    return F.when(_c(all_planned_zero), nan()).otherwise(text_percent(c))


__all__ = [
    "nan", "numeric_read", "numeric_read_error", "string_read", "clamp_nonneg",
    "round_half_up", "efficiency_pct", "completion_pct", "parse_decimal_text",
    "text_percent", "guarded_percent", "jtrim",
]
