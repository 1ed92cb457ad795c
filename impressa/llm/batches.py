"""Running a function over the rows of Arrow batches in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

# Texts are handled in pieces of about this many bytes; a longer text is a piece by itself.
PIECE_BYTES = 2 << 20


def pieces(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` whose texts have about ``PIECE_BYTES`` together."""
    lengths = pc.fill_null(pc.binary_length(batch[text]), 0).to_pylist()
    start = size = 0
    for i, length in enumerate(lengths):
        if i > start and size + length > PIECE_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += length
    if start < len(lengths):
        yield batch.slice(start)


def map_texts(
    documents: DataFrame, carry: Sequence[str], prepare: Callable[[], Callable], schema: str
) -> DataFrame:
    """The ``carry`` columns of every row of ``documents``, and columns of ``schema`` made of its text.

    ``prepare`` is called once a task and returns a function from a list of texts, null as the
    empty text, to a dictionary of the columns of ``schema``. Carried columns may have any name
    that is not one of ``schema``.
    """
    inner = {f"_carried{i}": c for i, c in enumerate(carry)}
    types = [documents.schema[c].dataType.simpleString() for c in carry]
    kept = [f"{name} {kind}" for name, kind in zip(inner, types, strict=True)]
    full = ", ".join([*kept, schema])
    arrow = to_arrow_schema(_struct(full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepare()
        for batch in batches:
            for piece in pieces(batch):
                columns = function([t or "" for t in piece["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        piece[f.name] if f.name in inner else _array(columns[f.name], f.type)
                        for f in arrow
                    ],
                    schema=arrow,
                )

    chosen = documents.select(*[F.col(f"`{c}`").alias(n) for n, c in inner.items()], "text")
    return chosen.mapInArrow(run, full).withColumnsRenamed(inner)


def _array(values: object, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def _struct(schema: str) -> StructType:
    return _parse_datatype_string(schema)
