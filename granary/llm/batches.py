"""Texts in batches: rows of some megabytes that travel as one.

A batch row has the rows' ids and text lengths (``docs``), their texts in one
compressed block (``texts``) and the other columns as an Arrow stream (``rest``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import lean, written

#: The id that null ids have inside a batch.
NULL = np.iinfo(np.int64).max
#: Rows of a batch at most, and the bits of a row's number that its place takes.
ROWS = 1 << 16
PLACE_BITS = 16
STORED = "batch long, docs binary, texts binary, rest binary"


#: Messages of less are squeezed by one compressor, as its tables cost more than they do.
SMALL = 1 << 16


@cache
def _squeezer(level: int):
    import zstandard

    return zstandard.ZstdCompressor(level=level)


@cache
def _unsqueezer():
    import zstandard

    return zstandard.ZstdDecompressor()


def squeeze(data: bytes, level: int = 3) -> bytes:
    if len(data) < SMALL:
        return _squeezer(level).compress(data)
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(data)


def unsqueeze(data) -> bytes:
    return _unsqueezer().decompress(data)


def pack(*arrays: np.ndarray) -> bytes:
    """Columns of one length, compressed."""
    return squeeze(len(arrays[0]).to_bytes(8, "little") + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpack(blob, *types: str) -> list[np.ndarray]:
    """What :func:`pack` joined."""
    raw = unsqueeze(blob)
    n = int.from_bytes(raw[:8], "little")
    out, at = [], 8
    for t in types:
        size = np.dtype(t).itemsize * n
        out.append(np.frombuffer(raw, t, n, at))
        at += size
    return out


def record(**columns) -> pa.RecordBatch:
    """A record batch of messages; columns not named here are binary."""
    kinds = {"batch": pa.int64(), "bucket": pa.int32(), "kind": pa.int32(), "least": pa.int64(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.binary())) for k, v in columns.items()], list(columns))


def _ipc(slices: list[pa.RecordBatch]) -> bytes:
    """Columns that only travel along, as an Arrow stream."""
    if not slices or not slices[0].num_columns:
        return b""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, slices[0].schema) as out:
        for x in slices:
            out.write_batch(x)
    return squeeze(sink.getvalue().to_pybytes())


def _store(size: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, ids, texts, rest, held = TaskContext.get().partitionId() << 24, [], [], [], 0

        def close() -> pa.RecordBatch:
            null = np.array([i is None for i in ids], bool)
            key = np.array([NULL if i is None else i for i in ids], "<i8")
            lens = np.array([len(t) for t in texts], "<i8")
            return record(batch=[made], docs=[pack(key, null, lens)], texts=[squeeze(b"".join(texts), level)], rest=[_ipc(rest)])

        for b in batches:
            more, done = pa.RecordBatch.from_arrays(b.columns[2:], [str(i) for i in range(b.num_columns - 2)]), 0
            for at, (i, t) in enumerate(zip(b.column(0), b.column(1)), 1):
                ids.append(i.as_py())
                texts.append(t.as_buffer().to_pybytes() if t.is_valid else b"")
                held += len(texts[-1])
                if held >= size or len(ids) == ROWS:
                    rest.append(more.slice(done, at - done))
                    yield close()
                    made, ids, texts, rest, held, done = made + 1, [], [], [], 0, at
            if done < b.num_rows:
                rest.append(more.slice(done))
        if ids:
            yield close()

    return run


def stored(docs: DataFrame, rest: list[str], size: int, level: int = 9) -> DataFrame:
    """Batches of about ``size`` bytes of the texts of ``docs`` (doc_id, text),
    the columns ``rest`` with them, as a written table of STORED rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").alias("_text"), *(F.col(f"`{c}`") for c in rest))
    return written(rows.mapInArrow(lean(_store(size, level)), STORED), "texts", "uncompressed")


def opened(docs: bytes, texts: bytes) -> tuple[np.ndarray, ...]:
    """Ids, which of them are null, text lengths and the joined texts."""
    key, null, lens = unpack(docs, "<i8", "?", "<i8")
    return key, null, lens, np.frombuffer(unsqueeze(texts), np.uint8)


def rest_columns(rest: bytes) -> list[pa.Array]:
    """The other columns of a batch."""
    table = pa.ipc.open_stream(unsqueeze(rest)).read_all() if rest else pa.table({})
    return [c.combine_chunks() for c in table.columns]


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows sorted by bucket, one bucket at a time.  Binary cells are views of
    what Arrow holds, not copies."""
    at, held = None, []
    for b in batches:
        binary = [pa.types.is_binary(t) for t in b.schema.types]
        names, buckets = b.schema.names, b.column("bucket").to_pylist()
        for i, bucket in enumerate(buckets):
            if bucket != at and held:
                yield at, held
                held = []
            at = bucket
            cells = (c[i].as_buffer() if binary[k] else c[i].as_py() for k, c in enumerate(b.columns))
            held.append(dict(zip(names, cells)))
    if held:
        yield at, held


def to_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    """Messages shuffled and sorted by their bucket, a task for each bucket."""
    return rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")


def at_batches(rows: DataFrame, parts: int) -> DataFrame:
    """Rows shuffled to their batch, in so many partitions whatever their size:
    a task has few batches, and rows of all tables meet without another shuffle."""
    return rows.repartition(parts, "batch")
