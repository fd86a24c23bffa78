"""Word counts and text-to-column scalar projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coview.functions.scalars import java_split, text_lines
from coview.operators.layout import widen


def lines_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per line of every text (``line``), as a file reader splits them.

    A narrow input (fewer partitions than cores) is spread first, so the
    splitting runs on every core; a wide one is left as it is.
    """
    docs = widen(docs.select(text_col))
    return docs.select(F.explode(text_lines(F.col(text_col))).alias("line"))


def word_count(lines: DataFrame, line_col: str = "line", sep: str = " ") -> DataFrame:
    """(word, n): tokens of ``line.split(sep)`` counted, Java's trailing rule included.

    Words are counted with a partial aggregate before the shuffle, so a word
    that is a third of all tokens leaves each map task as one row.
    """
    words = lines.select(F.explode(java_split(F.col(line_col), sep)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
