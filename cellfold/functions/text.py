"""Text scalars as Catalyst column expressions (F-01..F-07, P-01, S-05..S-07).

All of these stay JVM-side: no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim strips every char <= U+0020 (Spark's trim strips spaces only).
_JTRIM_CHARS = "".join(chr(i) for i in range(0x21))
# Strict integer text: what Integer.parseInt accepts (optional sign, digits).
_INT_PATTERN = r"^[+-]?[0-9]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jtrim(c) -> Column:
    """F-01: strip leading/trailing chars <= U+0020 (btrim with that set;
    no regular expression on the hot path)."""
    return F.btrim(_c(c), F.lit(_JTRIM_CHARS))


def norm_key(c) -> Column:
    """P-01/F-02: the normalised comparison key lower(jtrim(s)); NULL -> ''."""
    return F.lower(jtrim(F.coalesce(_c(c), F.lit(""))))


def norm_key_sql(x: str) -> str:
    """The same of an SQL expression, as SQL text."""
    chars = ", ".join(f"chr({i})" for i in range(0x21))
    return f"lower(btrim(coalesce({x}, ''), concat({chars})))"


def label_key(label: str) -> str:
    """Normalise a literal label the same way, on the driver (a constant)."""
    return label.strip(_JTRIM_CHARS).lower()


def formatted_text(c="text") -> Column:
    """S-05: the formatted-text view of a cell; a missing cell reads ''."""
    return F.coalesce(_c(c), F.lit(""))


def parse_int_strict(c) -> Column:
    """F-06: Integer.parseInt semantics; anything else is NULL (an issue)."""
    s = _c(c)
    return F.when(s.rlike(_INT_PATTERN), s.try_cast("int")).otherwise(F.lit(None).cast("int"))


def blank_to_zero_int(c) -> Column:
    """F-07 then F-06: trimmed '' reads 0, otherwise a strict integer."""
    s = jtrim(formatted_text(c))
    return F.when(s == "", F.lit(0)).otherwise(parse_int_strict(s))


def arith_text_eval(c) -> Column:
    """F-04/F-05: '<a>', '<a> + <b>', '<a> - <b>', '<a> * <b>' -> INT.

    Split on single spaces; one token is an int, otherwise token 2 is the
    operator and the first and last tokens are the operands (tokens between
    them are ignored). A bad operator or operand is NULL (an issue row).
    Overflow wraps in the source system; here it is NULL (an issue row).
    """
    s = _c(c)
    parts = F.split(s, " ")
    n = F.size(parts)
    a = parse_int_strict(F.element_at(parts, 1))
    b = parse_int_strict(F.element_at(parts, -1))
    op = F.element_at(parts, 2)
    return (F.when(n == 1, parse_int_strict(s))
            .when(op == "+", F.try_add(a, b))
            .when(op == "-", F.try_subtract(a, b))
            .when(op == "*", F.try_multiply(a, b))
            .otherwise(F.lit(None).cast("int")))
