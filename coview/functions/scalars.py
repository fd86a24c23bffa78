"""Column expressions shared by the operators. All built-in, all JVM-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line breaks as a Hadoop text reader sees them: \r\n, \r or \n.
LINE_BREAK = r"\r\n|\r|\n"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c: str | Column, sep: str = " ") -> Column:
    """``String.split(sep)`` as Java does it, for a literal one-char separator.

    Java drops trailing empty strings: ``"a b  "`` gives ``[a, b]``, a line of
    separators only gives ``[]``, and the empty line gives ``[""]``. Spark's
    ``split`` keeps the trailing empties, so trailing separators are trimmed
    first (``rtrim`` with the separator: no regex pass).
    """
    if len(sep) != 1:
        raise ValueError("java_split takes a one-character separator")
    c = col_(c)
    esc = "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep
    stripped = F.rtrim(c, F.lit(sep))
    return (F.when(c == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, esc)))


def text_lines(c: str | Column) -> Column:
    """Lines of a text as a file reader gives them: split on \\r\\n, \\r or \\n,
    and a break at the very end does not start another (empty) line."""
    parts = F.split(col_(c), LINE_BREAK)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def stable_round(c: str | Column, places: int = 6, bias: float = 1e-9) -> Column:
    """Round after a small bias, so engines that sum in another order agree."""
    return F.round(col_(c) + F.lit(bias), places)


def fixed5(c: str | Column) -> Column:
    """A score as text with five decimals, ``0.57735``.

    The value is rounded to 9 places (bias 1e-12) and then to 5 before it is
    formatted, so a printf-style oracle gives the same digits.
    """
    v = F.round(F.round(col_(c) + F.lit(1e-12), 9), 5)
    return F.format_string("%.5f", v)


def sigmoid(c: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_(c)))


def dot(xs: Sequence[str | Column], ws: Sequence[float | Column]) -> Column:
    """Sum of ``x_i * w_i``; weights may be literals (driver-held) or columns."""
    terms = [col_(x) * (w if isinstance(w, Column) else F.lit(float(w))) for x, w in zip(xs, ws)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def ci_equals(a: str | Column, literal: str) -> Column:
    """Case-insensitive equality with a literal (Java ``equalsIgnoreCase``)."""
    return F.lower(col_(a)) == F.lit(literal.lower())


def drop_first_field(c: str | Column, sep: str = ",") -> Column:
    """The list without its first field, joined again by ``sep``."""
    parts = java_split(c, sep)
    return F.array_join(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), sep)


def today_ds() -> Column:
    """Today's date as ``yyyy-MM-dd`` (the partition value of a daily write)."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")
