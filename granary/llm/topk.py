"""Exact top-k inner-product search by a three-phase uniform threshold.

A vector's score is the sum of partial scores that NODES slices of its
dimensions hold.  Rows and queries are packed into blocks of one slice each;
blocks of a slice meet pairwise, a slice in its own tasks.

1. Every slice gives each query its NAMED * k best rows by partial score, and its least
   and greatest partial score.  The rows seen get exact scores, and the k-th of
   them is the query's cutoff (score, vec_id).
2. The cutoff goes back to the slices.  Above its own least partial score, a
   slice has an equal share of what the cutoff leaves; a row below its share in
   every slice is below the cutoff.  A slice sends the rows at or above its
   share that could reach the cutoff with the other slices' greatest scores; at
   a tie, only those with a vec_id up to the cutoff's.
3. The rows that any slice sent get their exact scores, pair of blocks by pair of
   blocks; those that reach the cutoff are ranked.

Scores are integers: components become floor(scale * x) and are summed exactly
(in floats while every sum stays below 2^24, in doubles below 2^53, else in 64-bit
integers).  Memory: a task holds two blocks and the scores of STRIP queries against
one block.  Joins of blocks and vectors are merge joins: files of blocks are small
beside what they hold, and each block of queries comes once for every shard, so a
broadcast that sizes allow would not fit the driver.

Defined results: vectors that are null or empty or hold a null or non-finite
component take no part; vectors of different lengths have no score with each
other; a query has fewer than k rows where fewer exist; ties go to the smaller
vec_id; a null vec_id takes no part; of rows that repeat a vec_id, each is a
candidate, but none for a query of that id; a query row that is stored more than
once, or two with one vec_id, have a list each with ``per_row``, and otherwise
(as the SQL has it) one list under their query_id, in which a candidate comes
once for each of them; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm.common import partitions, scratch, written

K = 5
NODES = 2
#: How many times k rows a slice names in phase 1, of the k best of its parts; more
#: of them raise the cutoff.
NAMED = 8
ROW_BLOCK = 4096
QUERY_BLOCK = 512
#: Queries of a block whose scores are held at a time.
STRIP = 64
#: Scores of which only the greatest is compared at first.
PART = 64
#: Sent rows that are scored at a time.
ENTRIES = 1 << 15
EVERY = 50
SCALE = 256
#: The cutoff of a query that has seen fewer than k rows.
_OPEN = -(1 << 62)


def _packed(m: np.ndarray) -> bytes:
    """A matrix in the least integers that hold it: their size, then the cells."""
    most = max(int(m.max(initial=0)), -int(m.min(initial=0)))
    size = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return size.to_bytes(8, "little") + np.ascontiguousarray(m, f"<i{size}").tobytes()


def _matrix(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=8).reshape(n, -1)


def _blocks(name: str, size: int):
    """Rows (row, id, v) to blocks of at most ``size`` vectors of one length by
    ascending id: one for each slice and, as slice -1, the whole vectors."""

    def pack(dim: int, rows: list) -> list[dict]:
        rows.sort(key=lambda r: r[:2])
        ids, places, vectors = zip(*rows)
        m = np.array(vectors, "<i8")
        cut = np.linspace(0, dim, NODES + 1).astype(int)
        shared = {"dim": dim, f"{name}_ids": np.array(ids, "<i8").tobytes(), f"{name}_rows": np.array(places, "<i8").tobytes()}
        parts = [(-1, m), *((i, m[:, x:y]) for i, (x, y) in enumerate(zip(cut, cut[1:])))]
        return [shared | {"slice": i, f"{name}_mat": _packed(x)} for i, x in parts]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for f in frames:
            for row, i, v in zip(f["row"], f["id"], f["v"]):
                held.setdefault(len(v), []).append((i, row, v))
                if len(held[len(v)]) == size:
                    yield pd.DataFrame(pack(len(v), held.pop(len(v))))
        for dim, rows in held.items():
            yield pd.DataFrame(pack(dim, rows))

    return run


class _Pair:
    """A pair of blocks of one slice."""

    def __init__(self, f: pd.DataFrame, i: int) -> None:
        part = lambda c: np.frombuffer(f[c][i], "<i8")
        self.ids, self.rows, self.query_ids, self.query_rows = map(part, ("row_ids", "row_rows", "query_ids", "query_rows"))
        a, b = _matrix(f["row_mat"][i], len(self.ids)), _matrix(f["query_mat"][i], len(self.query_ids))
        peak = max(1, int(abs(a).max(initial=0))) * max(1, int(abs(b).max(initial=0))) * max(1, a.shape[1])
        kind = np.float32 if peak < 1 << 24 else np.float64 if peak < 1 << 53 else np.int64
        #: Above and below every score, and exact in its type.
        self.most = 1 << 24 if kind is np.float32 else 1 << 53 if kind is np.float64 else (1 << 63) - 1
        self.a, self.b = a.astype(kind), b.astype(kind)

    def strips(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first query, partial scores, which are whole numbers; the places of a
        query's own id as (query, row))."""
        mine = np.isin(self.query_ids, self.ids)
        for at in range(0, len(self.b), STRIP):
            own = np.nonzero(self.query_ids[at : at + STRIP, None] == self.ids) if mine[at : at + STRIP].any() else (np.zeros(0, np.intp),) * 2
            yield at, self.b[at : at + STRIP] @ self.a.T, own


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the k greatest of each row, the first ones at a tie."""
    n, width = scores.shape
    part = max(1, min(PART, width // k))
    whole = width // part
    if whole <= k:
        q, r = np.nonzero(np.ones(scores.shape, bool))
    else:
        # The k-th of the parts' greatest scores is at most the k-th score.
        peaks = scores[:, : whole * part].reshape(n, whole, part).max(axis=2)
        q, r = np.nonzero(scores >= np.partition(peaks, whole - k, axis=1)[:, whole - k, None])
    if len(q) > PART * k * n:  # so many ties that they are counted, not sorted
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        take, tie = scores > least, scores == least
        return np.nonzero(take | (tie & (np.cumsum(tie, axis=1) <= k - take.sum(axis=1, keepdims=True))))
    order = np.lexsort((r, -scores[q, r], q))
    q, r = q[order], r[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], r[keep]


LISTS = "query_row long, slice int, row long, id long, part long"


def _phase1(k: int):
    """Each query's best rows, and, as row -1, its least partial score.

    Pairs of one block of queries that follow each other give one list."""

    def lists(p: _Pair, mine: int) -> pd.DataFrame:
        out = []
        for at, scores, own in p.strips():
            n, low = len(scores), scores.min(axis=1)
            scores[own] = -p.most
            q, r = _best(scores, k)
            q, r = (x[scores[q, r] > -p.most] for x in (q, r))
            out.append((np.concatenate([p.query_rows[at + q], p.query_rows[at : at + n]]), np.concatenate([p.rows[r], np.full(n, -1)]), np.concatenate([p.ids[r], np.full(n, -1)]), np.concatenate([scores[q, r], low]).astype(np.int64)))
        asks, row, ids, part = map(np.concatenate, zip(*out))
        return pd.DataFrame({"query_row": asks, "slice": mine, "row": row, "id": ids, "part": part})

    def merged(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        f = pd.concat([a, b])
        least = f["row"] == -1
        best = f[~least].sort_values(["query_row", "part", "id"], ascending=[True, False, True]).groupby("query_row").head(k)
        return pd.concat([best, f[least].sort_values("part").groupby("query_row").head(1)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at = None, None
        for f in frames:
            for i in range(len(f)):
                here, found = (int(f["block"][i]), int(f["slice"][i])), lists(_Pair(f, i), int(f["slice"][i]))
                if held is not None and here != at:
                    yield held
                    held = None
                held, at = (found if held is None else merged(held, found)), here
        if held is not None:
            yield held

    return run


def _phase2(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The (query, row) places of a pair of blocks that a slice must send."""
    for f in frames:
        for i in range(len(f)):
            p, places = _Pair(f, i), []
            cutoff, cut_id, low, rest, others = np.frombuffer(f["bounds"][i], "<i8").reshape(5, -1)
            # The share, rounded up to a whole score, and what the other slices leave.
            reach = cutoff - others
            floor = np.clip(np.maximum(low - -rest // NODES, reach), -p.most, p.most).astype(p.a.dtype)
            for at, scores, own in p.strips():
                scores[own] = -p.most
                q, r = np.nonzero(scores >= floor[at : at + len(scores), None])
                score = scores[q, r].astype(np.int64)
                send = (score > -p.most) & ((score > reach[at + q]) | (p.ids[r] <= cut_id[at + q]))
                q, r = q[send], r[send]
                places.append((at + q).astype("<u4") << np.uint32(16) | r.astype("<u4"))
            places = np.concatenate(places)
            if len(places):
                yield pd.DataFrame({"block": [f["block"][i]], "rblock": [f["rblock"][i]], "sent": [places.tobytes()]})


def _phase3(k: int):
    """Each query's k best of the rows that the slices sent, by exact scores."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for i in range(len(f)):
                p = _Pair(f, i)
                cutoff, cut_id = np.frombuffer(f["bounds"][i], "<i8").reshape(5, -1)[:2]
                places, found = np.unique(np.concatenate([np.frombuffer(x, "<u4") for x in f["sent"][i]])), []
                for at in range(0, len(places), ENTRIES):
                    q, r = places[at : at + ENTRIES] >> np.uint32(16), places[at : at + ENTRIES] & np.uint32(0xFFFF)
                    score = np.einsum("ij,ij->i", p.b[q], p.a[r]).astype(np.int64)
                    keep = (score > cutoff[q]) | ((score == cutoff[q]) & (p.ids[r] <= cut_id[q]))
                    found.append(pd.DataFrame({"query_row": p.query_rows[q[keep]], "query_id": p.query_ids[q[keep]], "id": p.ids[r[keep]], "score": score[keep]}))
                best = pd.concat(found).sort_values(["query_row", "score", "id"], ascending=[True, False, True])
                yield best.groupby("query_row").head(k)

    return run


def _bounds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A block's bounds in the order of its queries."""
    for f in frames:
        packed = []
        for c in f["c"]:
            packed.append(np.array([[x[k] for x in c] for k in ("cutoff", "cut_id", "low", "rest", "others")], "<i8").tobytes())
        yield pd.DataFrame({"block": f["block"], "slice": f["slice"], "bounds": packed})


def _exact(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs`` (query_row, row, ...) with their full ``score``."""
    v = vectors.select("row", "v")
    both = pairs.join(v.toDF("row", "_v").hint("merge"), "row").join(v.toDF("query_row", "_q").hint("merge"), "query_row")
    score = F.aggregate(F.zip_with("_v", "_q", lambda x, y: x * y), F.lit(0).cast("long"), lambda a, x: a + x)
    return both.withColumn("score", score).drop("_v", "_q")


def _top(rows: DataFrame, by: str, k: int) -> DataFrame:
    best = Window.partitionBy(by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = K, scale: float = SCALE, per_row: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score for every row of ``vectors`` (vec_id,
    embedding) where the Column ``is_query`` holds, against all rows.  With
    ``per_row`` ranks are each query row's own, whose number comes first."""
    spark = vectors.sparkSession
    inf = F.lit(float("inf"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf)
    v = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & (F.size(v) > 0) & ~F.coalesce(F.exists(v, bad), F.lit(True))
    rows = vectors.where(good).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    with scratch() as keep:
        # Written, so that a row's number is the same wherever it is used.
        rows = written(rows, "vectors")
        block = "dim int, slice int, {0}_ids binary, {0}_rows binary, {0}_mat binary".format
        shards = partitions(spark)
        row_blocks = rows.select("row", "id", "v").mapInPandas(_blocks("row", ROW_BLOCK), block("row"))
        # Rows stay in ``shards`` groups; every block of queries visits each group.
        shard = F.pmod(F.xxhash64("row_rows"), F.lit(shards)).cast("int")
        row_blocks = written(row_blocks.withColumn("shard", shard).withColumn("rblock", F.xxhash64("row_rows")), "rows")
        asking = rows.where("asks")
        query_blocks = asking.select("row", "id", "v").mapInPandas(_blocks("query", QUERY_BLOCK), block("query"))
        query_blocks = written(query_blocks.withColumn("block", F.xxhash64("query_rows")), "queries")
        all_shards = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
        meet = ["dim", "slice", "shard"]
        # Phase 1.  Spark keeps so many rows of each query and slice before it shuffles them.
        lists = written(query_blocks.where("slice >= 0").select("*", all_shards).join(row_blocks.hint("merge"), meet).mapInPandas(_phase1(k), LISTS), "lists")
        local = Window.partitionBy("query_row", "slice").orderBy(F.desc("part"), "id")
        lists_top = lists.where("row >= 0").withColumn("r", F.row_number().over(local)).where(F.col("r") <= NAMED * k)
        seen = _exact(lists_top.select("query_row", "row", "id").distinct(), rows)
        cut = _top(seen, "query_row", k).where(F.col("rank") == k).select(F.col("query_row").alias("cq"), F.col("score").alias("cutoff"), F.col("id").alias("cut_id"))
        span = lists.groupBy("query_row", "slice").agg(F.min("part").alias("low"), F.max("part").alias("high"))
        every = span.groupBy("query_row").agg(F.sum("low").alias("lows"), F.sum("high").alias("highs")).withColumnRenamed("query_row", "sq")
        # Where fewer than k rows were seen, nothing is safe to leave out.
        bounds = span.join(every, F.col("query_row") == F.col("sq")).join(cut, F.col("query_row") == F.col("cq"), "left")
        cutoff = F.coalesce("cutoff", F.lit(_OPEN))
        bounds = bounds.select("query_row", "slice", "low", cutoff.alias("cutoff"), F.coalesce("cut_id", F.lit((1 << 63) - 1)).alias("cut_id"), F.when(F.col("cutoff").isNull(), F.lit(_OPEN)).otherwise(F.col("cutoff") - F.col("lows")).alias("rest"), (F.col("highs") - F.col("high")).alias("others"))
        bounds = written(bounds, "bounds")
        asked = query_blocks.where("slice = 0").select("block", "query_rows").mapInPandas(_unpacked, "block long, at int, query_row long")
        packed = asked.join(bounds, "query_row").groupBy("block", "slice").agg(F.sort_array(F.collect_list(F.struct("at", "cutoff", "cut_id", "low", "rest", "others"))).alias("c"))
        armed = query_blocks.hint("merge").join(packed.mapInPandas(_bounds, "block long, slice int, bounds binary"), ["block", "slice"])
        # Phase 2.
        sent = row_blocks.hint("merge").join(armed.select("*", all_shards), meet).mapInPandas(_phase2, "block long, rblock long, sent binary")
        sent = sent.groupBy("block", "rblock").agg(F.collect_list("sent").alias("sent"))
        # Phase 3.
        whole = query_blocks.where("slice = -1").hint("merge").join(armed.where("slice = 0").select("block", "bounds"), "block").drop("dim", "slice")
        pairs = sent.join(row_blocks.where("slice = -1").drop("dim", "slice", "shard").hint("merge"), "rblock").join(whole.hint("merge"), "block")
        found = pairs.mapInPandas(_phase3(k), "query_row long, query_id long, id long, score long")
        found = _top(found.withColumn("vec_id", F.col("id")), "query_row" if per_row else "query_id", k)
        found = keep(written(found.drop("id"), "found"))
    return found.select(*["query_row"] * per_row, "query_id", "rank", "vec_id", "score")


def _unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        for block, rows in zip(f["block"], f["query_rows"]):
            rows = np.frombuffer(rows, "<i8")
            yield pd.DataFrame({"block": block, "at": np.arange(len(rows), dtype="i4"), "query_row": rows})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)


SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
