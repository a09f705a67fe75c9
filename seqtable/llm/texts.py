"""Runs a function over the texts of a frame, in slices of bounded size, inside Spark tasks."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of text handled at once in a task; a longer text makes a slice of its own.
SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts (column number `text`) have at most `most` bytes together."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        used = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, used + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_texts(
    frame: DataFrame, keep: list[str], text: str, made: str, prepare: Callable[[], Callable[[pa.Array], list]]
) -> DataFrame:
    """Columns `keep`, then the columns `made` (a DDL schema) computed from column `text`.

    `prepare` runs once in each task and returns the function that turns an Arrow
    array of texts into the made columns (lists, numpy or Arrow arrays). One row
    comes out for each row that goes in.
    """
    n = len(keep)
    at = keep.index(text) if text in keep else n
    chosen = frame.select(*[frame[c] for c in keep], *([frame[text].alias("_".join(["_", *keep]))] if at == n else []))
    added = T._parse_datatype_string(made)
    out = T.StructType(chosen.schema.fields[:n] + added.fields)
    kinds = [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            for part in slices(batch, at):
                columns = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(work(part.column(at)), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(part.columns[:n] + columns, names=out.names)

    return chosen.mapInArrow(run, out)


def map_rows(
    frame: DataFrame, text: str, prepare: Callable[[], Callable[[pa.RecordBatch, pa.Array], pa.RecordBatch]]
) -> DataFrame:
    """Rows with the columns they had, after a function that may drop rows or change the text.

    The prepared function gets a slice of rows and its texts; all columns pass
    through by position, whatever their names.
    """
    at = frame.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            for part in slices(batch, at):
                yield work(part, part.column(at))

    return frame.mapInArrow(run, frame.schema)


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal values in the first `keys` columns; rows come sorted by these."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        start = 0
        for at, name in enumerate(zip(*(batch.column(k).to_pylist() for k in range(keys)), strict=True)):
            if name != current:
                if at > start:
                    held.append(batch.slice(start, at - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, current, start = [], name, at
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in one array, and the offsets of the texts in it; null counts as empty."""
    texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(bounds):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]
