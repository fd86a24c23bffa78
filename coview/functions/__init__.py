"""Scalar column expressions (built-in Spark functions only)."""

from coview.functions.scalars import (  # noqa: F401
    LINE_BREAK, ci_equals, col_, dot, drop_first_field, fixed5, java_split, sigmoid,
    stable_round, text_lines, today_ds,
)
