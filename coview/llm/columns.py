"""Run a per-batch text function inside Spark tasks and keep chosen columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coview.llm import kernel as K


def _apply(batches: Iterator[pa.RecordBatch], compute: Callable, names: list[str], n_keep: int,
           text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:n_keep], *compute(batch.column(text))], names=names)


def map_text(docs: DataFrame, compute: Callable, fields: Sequence[T.StructField],
             keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of ``docs`` and ``fields``, row by row.

    ``compute`` takes an Arrow string column (nulls included) and returns one
    Arrow array per field; it is pickled, so it holds a model at most. Only the
    kept columns and the text reach Python, the text once, kept or not; other
    columns, whatever their names, are not read.
    """
    kept = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    sent = text_col in keep and isinstance(docs.schema[text_col].dataType, T.StringType)
    source = docs.select(*kept, *([] if sent else [F.col(text_col).cast("string").alias("text")]))
    schema = T.StructType([*source.schema.fields[:len(kept)], *fields])
    out = source.mapInArrow(K.ends(partial(_apply, compute=compute, names=schema.names, n_keep=len(keep),
                                           text=list(keep).index(text_col) if sent else len(kept))), schema)
    return out.select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)),
                      *(f.name for f in fields))
