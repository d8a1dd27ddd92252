"""Best-two-fit packing of tokenized documents into sequences.

A document is its ids and an end id.  One that is longer than a sequence is cut
into full pieces after a first piece that may be shorter.  Pieces are packed in
groups of about GROUP: a sequence is filled greedily, the largest fitting piece
first; then its smallest piece gives way to two unpacked pieces if two fit
the widened gap more tightly than the one did.  Sequences with a gap of more
than TIGHT tokens are opened again and their pieces packed in the next round,
over all groups, until one group holds what is left.  Only lengths and checksums
are shuffled, never ids.

The ids are those of the byte-level vocabulary ``byte_bpe_50k``.  They are made
by the faster of the two installed encoders that share this vocabulary; a
test holds them against the other one's.

Defined results: a null text is the end id alone; repeated rows are packed each
for itself; extra columns are ignored; an empty table gives no row.  Numbers of
sequences are unique but have gaps.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import dropped, lean, written

TOKENIZER = "byte_bpe_50k.json"
LENGTH = 1024
END = 2
GROUP = 1 << 16
TIGHT = 2
ROUNDS = 6

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_cache: dict = {}


def encoder(path: str):
    """Encoder of the vocabulary file's ranks (the ``.tiktoken`` file beside it)."""
    if path not in _cache:
        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _cache[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})
    return _cache[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            doc, out = [], [[], [], [], []]
            ids = batch.column(0)
            for i, text in enumerate(batch.column(1)):
                t = enc.encode_to_numpy(text.as_py() or "", allowed_special="all").astype("<u4")
                t = np.append(t, np.uint32(end))
                cuts = [0, *range(len(t) % length or length, len(t) + 1, length)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    doc.append(i)
                    for column, x in zip(out, (k, a, b - a, zlib.crc32(t[a:b].tobytes()))):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc, pa.int64())), pa.array(out[0], pa.int32()), *(pa.array(x, pa.int64()) for x in out[1:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), PIECES)


class _Stock:
    """Unpacked pieces by length; which lengths are left is one integer's bits."""

    def __init__(self, lengths) -> None:
        self.rows: dict[int, list[int]] = {}
        for row, n in enumerate(lengths):
            self.rows.setdefault(int(n), []).append(row)
        self.left = sum(1 << n for n in self.rows)

    def most(self, upto: int) -> int:
        """The largest length left that is at most ``upto``, or 0."""
        return (self.left & ((1 << (upto + 1)) - 1)).bit_length() - 1 if upto > 0 and self.left & ((1 << (upto + 1)) - 1) else 0

    def take(self, n: int) -> int:
        rows = self.rows[n]
        row = rows.pop()
        if not rows:
            self.left &= ~(1 << n)
        return row

    def back(self, n: int, row: int) -> None:
        self.rows[n].append(row)
        self.left |= 1 << n

    def two(self, gap: int, beat: int) -> tuple[int, int] | None:
        """Two lengths with the largest sum over ``beat`` that fits ``gap``."""
        best, found = beat, None
        a = self.most(gap - 1)
        while a and 2 * a > best:
            b = self.most(min(a, gap - a))
            if b == a and len(self.rows[a]) < 2:
                b = self.most(a - 1)
            if b and a + b > best:
                best, found = a + b, (a, b)
                if best == gap:
                    break
            a = self.most(a - 1)
        return found


def best_two_fit(lengths, length: int = LENGTH) -> list[list[int]]:
    """Sequences as lists of rows; every row of ``lengths`` is in one."""
    stock, out = _Stock(lengths), []
    while stock.left:
        gap, held = length, []
        while n := stock.most(gap):
            held.append((n, stock.take(n)))
            gap -= n
        while gap and len(held) > 1:
            n, row = held[-1]
            if not (pair := stock.two(gap + n, n)):
                break
            held.pop()
            stock.back(n, row)
            held += [(x, stock.take(x)) for x in pair]
            gap += n - sum(pair)
            held.sort(reverse=True)
        out.append([row for _, row in held])
    return out


def pack(table: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces."""
    packed = ", sequence_id long, offset long, full boolean"

    def run(r: int, last: bool):
        def of(f: pd.DataFrame) -> pd.DataFrame:
            seq, off, full = (np.zeros(len(f), t) for t in ("i8", "i8", bool))
            sizes = f["length"].to_numpy()
            first = (r << 58) + (int(f["g"].iat[0]) << 20)
            for k, rows in enumerate(best_two_fit(sizes, length)):
                seq[rows] = first + k
                off[rows] = np.cumsum(sizes[rows]) - sizes[rows]
                full[rows] = last or length - sizes[rows].sum() <= TIGHT
            return f.drop(columns="g").assign(sequence_id=seq, offset=off, full=full)

        return of

    done, rest = [], table
    types = ", ".join(f"{c} {t}" for c, t in table.dtypes)
    for r in range(ROUNDS):
        count = rest.count()
        groups = max(1, -(-count // group))
        last = groups == 1 or r == ROUNDS - 1
        # doc_id as text: pandas would turn a column with nulls into floats.
        rows = rest.withColumn("doc_id", F.col("doc_id").cast("string"))
        # Also by the row's place in the written table, so rows alike are dealt out.
        g = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id(), F.lit(r)), F.lit(groups))
        out = rows.withColumn("g", g).groupBy("g").applyInPandas(run(r, last), types.replace("doc_id bigint", "doc_id string") + packed)
        out = written(out.withColumn("doc_id", F.col("doc_id").cast("long")), "packed")
        done.append(out.where("full").drop("full"))
        if last:
            break
        rest = out.where("not full").drop("full", "sequence_id", "offset")
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    table = written(pieces(docs, path), "pieces")
    packed = pack(table)
    dropped(table)
    return packed


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
