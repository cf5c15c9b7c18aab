"""Row-wise text work in Arrow batches, shared by the operators of this package.

A document is a row. Batches are cut to a few MB of text before Python objects are
made of them, so that a task's memory does not depend on how many long documents meet.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 4 << 20
TEXT = "__text"

Maker = Callable[[], Callable[[list], dict[str, Sequence]]]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``SLICE_BYTES`` of text each, or a single row."""
    sizes = batch.column(column).cast(pa.large_string()).cast(pa.large_binary())
    start, total = 0, 0
    for i, size in enumerate(pa.compute.binary_length(sizes).to_pylist()):
        size = size or 0
        if i > start and total + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def append_columns(df: DataFrame, text_col: str, make: Maker, fields: str, keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep`` and, computed from the text of each row, the columns ``fields``.

    ``make`` is called once per task and gives a function from a list of texts (null:
    None) to one list per new column. A kept column with a new column's name is replaced.
    """
    added = T._parse_datatype_string(fields)
    kept = [c for c in keep if c not in added.names]
    body = free_name(TEXT, kept, added.names)
    source = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text_col}`").cast("string").alias(body))
    schema = T.StructType([source.schema[c] for c in kept] + added.fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in slices(batch, body):
                new = compute(part.column(body).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(new[f.name], type=arrow.field(f.name).type) for f in added.fields],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)


def filter_rows(df: DataFrame, text_col: str, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows, with all their columns, whose text the function made by ``make`` accepts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accept = make()
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(accept(part.column(text_col).to_pylist()), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def free_name(wanted: str, *taken: Sequence[str]) -> str:
    """``wanted``, with as many underscores behind it as keep it apart from the ``taken`` names in any case of letters."""
    used = {c.lower() for names in taken for c in names}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def id_hash(id_col: str):
    """CRC-32 of an id written as text: the fixed split of labelled rows."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def documents(spark, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
