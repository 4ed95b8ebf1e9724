"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Memo(dict):
    """What ``make(key)`` gave, for the keys seen last: at most two generations of ``size`` entries, no long keys."""

    def __init__(self, make: Callable, size: int = 200_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
            if isinstance(key, (str, bytes)) and len(key) > 100:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator reads, so that no other column of the input can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def per_batch(fn: Callable[[pa.RecordBatch], dict[str, Iterable]], schema: pa.Schema) -> Callable:
    """A function for ``mapInArrow`` from one that gives the columns of the rows made from a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = fn(batch)
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    return run


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
