"""Arrow batches with columns appended by a Python function, in bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: Text bytes handled at once; a longer single text is a piece of its own.
PIECE_BYTES = 4 << 20

#: ASCII letters fold to lower case, digits stay, every other ASCII byte is a space.
WORD_BYTES = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower()
)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` less the columns called one of ``names``, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in gone])


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row slices of about ``limit`` bytes of ``column`` each."""
    texts = batch.column(batch.schema.get_field_index(column))
    start, held = 0, 0
    for i, size in enumerate(pa.compute.binary_length(texts).to_pylist()):
        if held and held + (size or 0) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's UTF-8 bytes; a null is empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


def append_columns(
    df: DataFrame,
    text: str,
    fields: Sequence[StructField],
    make: Callable[[], Callable[[pa.RecordBatch], list[list]]],
    limit: int | None = None,
) -> DataFrame:
    """``df`` with ``fields`` appended; columns that had these names are replaced.

    ``make`` runs once in each task and returns the function that turns a batch
    into the new columns; it gets about ``limit`` bytes of text at a time. Rows stay
    where they are: nothing is shuffled.
    """
    kept = without(df, [f.name for f in fields])
    schema = StructType([*kept.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]
        work = make()
        for batch in batches:
            for piece in pieces(batch, text, limit) if limit else pieces(batch, text):
                new = [pa.array(x, t) for x, t in zip(work(piece), types, strict=True)]
                names = [*piece.schema.names, *(f.name for f in fields)]
                yield pa.RecordBatch.from_arrays([*piece.columns, *new], names=names)

    return kept.mapInArrow(run, schema)
