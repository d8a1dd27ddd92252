"""SimHash near-dedup with BK-trees.

A text's fingerprint has a bit for each of the 64 bits of its shingles' hashes,
set where more than half of them set it.  Fingerprints within RADIUS bits link.

Distinct fingerprints are sharded so that every pair in reach shares a shard:
of PARTS bit ranges, two fingerprints that differ in at most RADIUS bits agree
in at least PARTS - RADIUS of them, so there is a shard for each choice of so
many ranges and each value they take.  A shard's fingerprints become BK-trees
of at most TREE nodes, children keyed by their Hamming distance to the parent,
and each tree is sent to the shard's queries only (sending every tree to every
executor would grow with the corpus).  A search follows only edges whose
distance is within the radius of the query's own.  A large shard is several trees;
a tree meets itself and each later one in groups of their own, so no group holds
a whole hot shard, and a very large one is sharded again by its other bits.
Of a group's links a spanning forest is kept, never all pairs.

Defined results: texts without words have fingerprint 0 and link like any
other; null text counts as empty; identical fingerprints are one node and all
their rows belong to its component; a null doc_id has the component of its
links, and null if it has none; repeated rows come out once each; extra
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.batches import PLACE_BITS, at_batches, by_bucket, opened, pack, record, rest_columns, squeeze, to_buckets, unpack, unsqueeze
from granary.llm.batches import stored as store_texts
from granary.llm.common import dropped, lean, partitions, scratch, tidy, written
from granary.llm.components import components

WORDS = 4
RADIUS = 4
PARTS = 6
TREE = 1024
#: Trees of one shard from which it is sharded again.
DEEP = 16
SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _hashes(text: str | None, words: int) -> np.ndarray:
    """Hash of each word shingle of a text, A-Z lower-cased; none for no word."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    line = b" ".join(w)
    hashed = xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([hashed(line, SEED)] if w else [], "<u8")
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = [0, *ends[: len(w) - words].tolist()]
    return np.fromiter((hashed(line[a : b - 1], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())), "<u8", len(w) - words + 1)


def majority(h: np.ndarray) -> int:
    """The bits that over half of the hashes set; 0 for none."""
    count = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        count += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit fingerprint of a text's word shingles, repeats included."""
    return majority(_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = WORDS, keep: list[str] | None = None) -> DataFrame:
    """``docs`` columns named in ``keep`` (doc_id alone if None) and ``fp``,
    the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return docs.select(*(keep or ["doc_id"]), fp("text").alias("fp"))


class BKTree:
    """Fingerprints, each under its parent's edge of their Hamming distance."""

    def __init__(self, values) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        for v in values:
            self.add(int(v))

    def add(self, value: int) -> None:
        at = 0
        new = len(self.values)
        while new:
            d = (self.values[at] ^ value).bit_count()
            if d not in self.children[at]:
                self.children[at][d] = new
                break
            at = self.children[at][d]
        self.values.append(value)
        self.children.append({})

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, places of the queries within the radius of it)."""
        if not self.values:
            return
        stack = [(0, np.arange(len(queries)))]
        while stack:
            node, rows = stack.pop()
            d = np.bitwise_count(queries[rows] ^ np.uint64(self.values[node])).astype(np.int64)
            near = rows[d <= radius]
            if len(near):
                yield node, near
            for edge, child in self.children[node].items():
                inside = rows[abs(d - edge) <= radius]
                if len(inside):
                    stack.append((child, inside))


def forest(tree: np.ndarray, queries: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what the tree's links between both lists connect."""
    if len(tree) <= 8 and len(queries) <= 8:
        near = ((a, b) for a in tree.tolist() for b in queries.tolist() if a != b and (a ^ b).bit_count() <= radius)
        return list({(min(p), max(p)) for p in near})
    label = np.arange(len(tree) + len(queries))
    out = []
    for node, rows in BKTree(tree.tolist()).search(queries, radius):
        at = np.append(rows + len(tree), node)
        kinds, first = np.unique(label[at], return_index=True)
        if len(kinds) > 1:
            a = int(tree[node])
            out += [(a, int(b)) for b in (int(queries[at[i] - len(tree)]) for i in first if at[i] >= len(tree)) if a != b]
            label[np.isin(label, kinds)] = kinds[0]
    return out


def _ranges(parts: int) -> list[tuple[int, int]]:
    cut = [64 * i // parts for i in range(parts + 1)]
    return list(zip(cut, cut[1:]))


def shard_keys(fp: Column, radius: int = RADIUS, parts: int = PARTS) -> Column:
    """The shard of each choice of bit ranges, as an array of longs."""
    chosen = []
    for i, pick in enumerate(combinations(_ranges(parts), parts - radius)):
        mask = sum(((1 << b) - 1) ^ ((1 << a) - 1) for a, b in pick)
        signed = mask - (1 << 64) if mask >> 63 else mask
        chosen.append(F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(signed))))
    return F.array(*chosen)


def _forests(radius: int):
    """Sorted rows (key, chunk, fp, node) to links; one tree at a time."""

    def links(fps: np.ndarray, node: np.ndarray) -> list[tuple[int, int]]:
        fps = fps.view(np.uint64)
        # A tree's own members where nobody else visits it.
        return forest(fps[node], fps if node.all() else fps[~node], radius) if len(fps) > 1 and node.any() else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        out: list[tuple[int, int]] = []

        def flush(cols: tuple[np.ndarray, ...]) -> None:
            key, chunk, fps, node = cols
            new = np.flatnonzero((key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])) + 1
            edges = np.concatenate([[0], new, [len(key)]])
            for i in np.flatnonzero(np.diff(edges) > 1):
                a, b = edges[i], edges[i + 1]
                out.extend(links(fps[a:b], node[a:b]))

        def rows() -> pa.RecordBatch:
            a = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

        for batch in batches:
            cols = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(cols[0]):
                continue
            held.append(cols)
            key, chunk = cols[0], cols[1]
            inside = np.flatnonzero((key != key[-1]) | (chunk != chunk[-1]))
            if not len(inside):  # the group may go on in the next batch
                continue
            cut = int(inside[-1]) + 1
            held[-1] = tuple(c[:cut] for c in cols)
            flush(tuple(np.concatenate(c) for c in zip(*held)))
            held = [tuple(c[cut:] for c in cols)]
            if out:
                yield rows()
        if held:
            flush(tuple(np.concatenate(c) for c in zip(*held)))
        if out:
            yield rows()

    return run


def _deeper(radius: int, parts: int) -> list[list[int]]:
    """For each choice of bit ranges, masks that choose again among the other bits:
    two fingerprints in reach agree under at least one of them, too."""
    out = []
    for pick in combinations(_ranges(parts), parts - radius):
        left = [i for i in range(64) if not any(a <= i < b for a, b in pick)]
        cut = [len(left) * i // parts for i in range(parts + 1)]
        ranges = [sum(1 << i for i in left[a:b]) for a, b in zip(cut, cut[1:])]
        masks = [sum(again) for again in combinations(ranges, parts - radius)]
        out.append([m - (1 << 64) if m >> 63 else m for m in masks])
    return out


def _counted(e: DataFrame, tree: int) -> DataFrame:
    """``e`` with ``n``, how many fingerprints the shard has, where over ``tree``."""
    hot = e.groupBy("key").count().where(F.col("count") > tree).select(F.col("key").alias("hot_key"), F.col("count").alias("n"))
    return e.join(written(hot, "hot"), F.col("key") == F.col("hot_key"), "left").drop("hot_key")


def groups(fps: DataFrame, radius: int = RADIUS, parts: int = PARTS, tree: int = TREE) -> DataFrame:
    """(key, chunk, fp, node): who is searched for in which tree.

    A shard of over ``tree`` fingerprints is several trees, and a group is one
    of them and the members of it or of one later tree, so it has at most about
    2 * tree rows.  Those groups grow with the square of the shard, so a shard of
    over DEEP trees is first sharded again by its other bits."""
    picked = F.posexplode(shard_keys(F.col("fp"), radius, parts)).alias("pick", "key")
    e = _counted(fps.select("fp", picked), tree)
    deep = F.coalesce(F.col("n") > DEEP * tree, F.lit(False))
    if e.where(deep).limit(1).count():
        masks = F.array(*(F.array(*(F.lit(m) for m in row)) for row in _deeper(radius, parts)))
        again = F.transform(F.element_at(masks, F.col("pick") + 1), lambda m, i: F.xxhash64("key", i, F.col("fp").bitwiseAND(m)))
        below = e.where(deep).select("fp", F.explode(again).alias("key"))
        e = e.where(~deep).select("fp", "key", "n").unionByName(_counted(below, tree))
    # Trees are a little smaller than ``tree`` on average, as hashes deal them out.
    trees = F.coalesce(F.ceil(1.25 * F.col("n") / tree), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit("tree")), trees).cast("int")
    e = e.select("key", "fp", trees.alias("trees"), own.alias("own"))
    chunk = lambda i, j: F.shiftleft(i.cast("long"), 31) + j
    as_node = F.transform(F.sequence("own", F.col("trees") - 1), lambda j: F.struct(chunk(F.col("own"), j).alias("chunk"), F.lit(True).alias("node")))
    as_query = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda i: F.struct(chunk(i, F.col("own")).alias("chunk"), F.lit(False).alias("node")))
    places = F.when(F.col("own") == 0, as_node).otherwise(F.concat(as_node, as_query))
    return e.select("key", "fp", F.explode(places).alias("p")).select("key", "p.chunk", "fp", "p.node")


def links(fps: DataFrame, radius: int = RADIUS, parts: int = PARTS, tree: int = TREE) -> DataFrame:
    """Links (a, b) whose components are those of all links within the radius
    among the distinct fingerprints of column ``fp``."""
    rows = groups(fps, radius, parts, tree)
    return rows.repartition("key", "chunk").sortWithinPartitions("key", "chunk").mapInArrow(lean(_forests(radius)), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, parts: int = PARTS) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id of the component)."""
    with scratch() as keep:
        rows = keep(written(fingerprints(docs.select("doc_id", "text"), words), "fps"))
        distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp")
        roots = components(links(distinct.select("fp"), radius, parts))
        of = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
        least = of.groupBy("root").agg(F.min("least").alias("component_id"))
        table = keep(written(of.join(least, "root").select(F.col("fp").alias("of"), "component_id"), "ids"))
    return rows.join(table, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


# ---- one document of each group of similar texts ----------------------------

#: Text bytes of a stored batch, and of all texts that one bucket counts for.
BATCH, BUCKET = 2 << 20, 16 << 20
#: Rows of one side of a block.
BLOCK = 256
SIMILARITY = 0.8
#: Bytes that are hashed at a time.
_SLICE = 1 << 20
#: The shingle set of a text without words.
_EMPTY = np.array([0x9E3779B97F4A7C15], np.uint64)
#: Fixed odd multipliers: of a byte's place, of a word's place, of mixing.
_PLACE, _WORD, _MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(text: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, its text) of joined texts, A-Z lower-cased.

    A word's hash is a polynomial in its bytes, from running sums of the whole
    block, so a slice of bytes is one pass however many words it has.
    """
    n = len(text)
    low = np.frombuffer(text.tobytes().translate(_LOWER), np.uint8)
    inside = np.ones(256, bool)
    inside[[32, *range(9, 14)]] = False
    word = np.zeros(n + 2, bool)
    word[1:-1] = inside[low]
    # A text's first byte starts a word even where the text before has no space.
    cut = np.cumsum(lens)[:-1]
    new = np.zeros(n + 1, bool)
    new[cut] = True
    start = np.flatnonzero(word[1:] & (~word[:-1] | new))
    end = np.flatnonzero(word[:-1] & (~word[1:] | new))
    value = _mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
    power, back = _powers(_PLACE, min(n, _SLICE) + 1), _powers(pow(_PLACE, -1, 1 << 64), min(n, _SLICE) + 1)
    head, tail, inverse = (np.zeros(len(start), np.uint64) for _ in range(3))
    total, up, down = 0, 1, 1
    for at in range(0, n, _SLICE):
        part = value[low[at : at + _SLICE]]
        m = len(part)
        part *= power[:m]
        run = np.zeros(m + 1, np.uint64)
        np.cumsum(part, out=run[1:])
        run *= np.uint64(up)
        run += np.uint64(total)
        i, j = np.searchsorted(start, (at, at + m))
        head[i:j] = run[start[i:j] - at]
        inverse[i:j] = back[start[i:j] - at] * np.uint64(down)
        i, j = np.searchsorted(end, (at, at + m), side="right")
        tail[i:j] = run[end[i:j] - at]
        total = int(run[m])
        up, down = up * int(power[m]) & (1 << 64) - 1, down * int(back[m]) & (1 << 64) - 1
    return _mixed((tail - head) * inverse), np.searchsorted(cut, start, side="right")


def shingles(text: np.ndarray, lens: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, text) of every word shingle of joined texts, in their order;
    a text of fewer words is one shingle, one of none has a hash of its own."""
    h, doc = word_hashes(text, lens)
    many = np.bincount(doc, minlength=len(lens))
    first = np.cumsum(many) - many
    n = np.maximum(1, many - words + 1)
    owner = np.repeat(np.arange(len(lens)), n)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    out = np.zeros(len(owner), np.uint64)
    left = many[owner]
    for i in range(words):
        here = np.flatnonzero(left > i)
        out[here] = out[here] * np.uint64(_WORD) + h[at[here] + i]
    out = _mixed(out)
    out[left == 0] = _EMPTY
    return out, owner


def token_sets(text: np.ndarray, lens: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes of all texts, sorted; places in them of each text's
    distinct hashes, ascending, text after text; how many each text has)."""
    h, doc = shingles(text, lens, words)
    order = np.argsort(h)
    kinds, of = _ranks(h[order])
    doc = doc[order].astype(np.uint32 if len(lens) > 1 << 16 else np.uint16)
    by = np.argsort(doc, kind="stable")
    of, doc = of[by], doc[by]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (doc[1:] != doc[:-1])
    return kinds, of[new], np.bincount(doc[new], minlength=len(lens))


def _ranks(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and each one's place in them."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new], np.cumsum(new) - 1


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of a text's word shingles, sorted."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return token_sets(raw, np.array([len(raw)]), words)[0]


def overlap_needed(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """The least number of common hashes for two sets of ``sizes`` together."""
    return np.ceil(sizes * (similarity / (1 + similarity)) - 1e-6).astype(np.int64)


def prefix_length(size: np.ndarray, similarity: float) -> np.ndarray:
    """Sets at ``similarity`` share at least ceil(similarity * size) hashes, so in
    any one order of all hashes both have the first they share among so many."""
    return size - np.ceil(similarity * size - 1e-6).astype(np.int64) + 1


def prefixes(of: np.ndarray, size: np.ndarray, often: np.ndarray, kinds: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``of``, text, rank in its text) of each text's prefix in the
    order of ``often`` and then of the hash; hashes that no other text has
    (``often`` 0) take their ranks but are left out."""
    doc = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((kinds[of], often[of], doc))
    rank = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    keep = (rank < prefix_length(size, similarity)[doc]) & (often[of[order]] > 0)
    return order[keep], doc[keep], rank[keep]


def _bucket_keys(kinds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket, and where each bucket begins in it.  Inside a bucket
    hashes ascend, and 32 of their upper bits tell them apart."""
    bucket = (kinds % np.uint64(buckets)).astype(np.uint32)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _steps(values: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as compressed differences, byte plane by plane."""
    step = np.diff(values, prepend=np.uint32(0))
    return squeeze(len(values).to_bytes(8, "little") + step.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unsteps(data: bytes) -> np.ndarray:
    raw = unsqueeze(data)
    n = int.from_bytes(raw[:8], "little")
    step = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 8).reshape(4, n).T).view(np.uint32).ravel()
    return np.cumsum(step, dtype=np.uint32)


def _representatives(text: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The first of a batch's texts that is byte for byte each text, by 128-bit digest."""
    import xxhash

    ends, view, seen = np.cumsum(lens), memoryview(text), {}
    return np.array([seen.setdefault(xxhash.xxh3_128_digest(view[b - n : b]), i) for i, (b, n) in enumerate(zip(ends.tolist(), lens.tolist()))], np.int64)


def _distinct_sets(docs: bytes, texts: bytes, words: int) -> tuple[np.ndarray, ...]:
    """A batch's ids, each row's distinct text, and the token sets of those."""
    key, null, lens, text = opened(docs, texts)
    first = _representatives(text, lens)
    some, of = np.unique(first, return_inverse=True)
    if len(some) < len(lens):
        ends = np.cumsum(lens)
        text = np.concatenate([text[ends[i] - lens[i] : ends[i]] for i in some.tolist()])
    return key, null, of, *token_sets(text, lens[some], words)


def _ask(words: int, buckets: int):
    """Stored batches to rows (bucket, batch, data): the batch's distinct hashes
    of the bucket, and those that several of its texts have with how many."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for batch, docs, texts in zip(*(c.to_pylist() for c in b.columns)):
                *_, kinds, of, _ = _distinct_sets(docs, texts, words)
                texts_with = np.bincount(of, minlength=len(kinds))
                order, cut = _bucket_keys(kinds, buckets)
                short, texts_with = (kinds >> np.uint64(32)).astype(np.uint32)[order], texts_with[order]
                out = []
                for k in np.flatnonzero(np.diff(cut)).tolist():
                    n = texts_with[cut[k] : cut[k + 1]]
                    many = np.flatnonzero(n > 1)
                    out.append((k, _steps(short[cut[k] : cut[k + 1]]), pack(many.astype("<u4"), n[many].astype("<u4"))))
                if out:
                    k, data, more = zip(*out)
                    yield record(bucket=k, batch=[batch] * len(k), data=data, more=more)

    return run


def _answer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (batch, bucket, data): for each hash that the batch asked for, 0 if
    no other text has it, else eighths of the logarithm of how many have it."""
    for bucket, asked in by_bucket(rows):
        parts = [_unsteps(r["data"]) for r in asked]
        sizes = np.array([len(p) for p in parts])
        keys = np.concatenate(parts)
        count = np.ones(len(keys), np.int64)
        for base, r in zip((np.cumsum(sizes) - sizes).tolist(), asked):
            many, n = unpack(r["more"], "<u4", "<u4")
            count[base + many.astype(np.int64)] = n
        order = np.argsort(keys)
        _, of = _ranks(keys[order])
        total = np.bincount(of, count[order])
        often = np.empty(len(keys), np.uint8)
        often[order] = np.minimum(255, np.ceil(8 * np.log2(total))).astype(np.uint8)[of]
        cut = np.cumsum(sizes)
        yield record(batch=[r["batch"] for r in asked], bucket=[bucket] * len(asked), data=[squeeze(often[b - n : b].tobytes(), 1) for b, n in zip(cut.tolist(), sizes.tolist())])


MARKS = "rid long, id long, digest binary, size int, fp long, keys array<long>, ranks array<int>, hashes binary"


def _mark(words: int, buckets: int, similarity: float):
    """Batches and answers to MARKS rows, of texts that may have a partner: those
    with a hash of their prefix that another text has, and rows whose set of
    shingles another row of the batch has (these without keys, but for one)."""

    def one(batch: int, docs: bytes, texts: bytes, answers: list[dict]) -> pa.RecordBatch:
        import xxhash

        key, null, text_of, kinds, of, size = _distinct_sets(docs, texts, words)
        order, cut = _bucket_keys(kinds, buckets)
        often = np.zeros(len(kinds), np.uint8)
        for a in answers or []:
            k = a["bucket"]
            often[order[cut[k] : cut[k + 1]]] = np.frombuffer(unsqueeze(a["data"]), np.uint8)
        at, doc, rank = prefixes(of, size, often, kinds, similarity)
        has = np.bincount(doc, minlength=len(size))
        first_key = np.cumsum(has) - has
        ends = np.cumsum(size)
        rows_of = np.bincount(text_of, minlength=len(size))
        out: dict[str, list] = {c.split()[0]: [] for c in MARKS.split(", ")}
        seen: dict[bytes, int] = {}
        twice = (has > 0) | (rows_of > 1)
        by_text = np.argsort(text_of, kind="stable")
        begin = np.cumsum(rows_of) - rows_of
        for t in np.flatnonzero(twice).tolist():
            mine = kinds[of[ends[t] - size[t] : ends[t]]]
            digest = xxhash.xxh3_128_digest(mine.tobytes())
            lead = seen.setdefault(digest, t) == t
            for i in by_text[begin[t] : begin[t] + rows_of[t]].tolist():
                full = lead
                lead = False
                a, b = first_key[t], first_key[t] + has[t]
                out["rid"].append((batch << PLACE_BITS) + i)
                out["id"].append(None if null[i] else int(key[i]))
                out["digest"].append(digest)
                out["size"].append(len(mine) if full else None)
                out["fp"].append(int(np.uint64(majority(mine)).view(np.int64)) if full else None)
                out["keys"].append(kinds[of[at[a:b]]].view(np.int64) if full else None)
                out["ranks"].append(rank[a:b].astype(np.int32) if full else None)
                out["hashes"].append(mine.tobytes() if full else None)
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for i in range(b.num_rows):
                yield one(*(b.column(c)[i].as_py() for c in range(4)))

    return run


def _hash_sets(blobs) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in blobs]


def reaches(common: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Whether two sets of ``sizes`` together with so many ``common`` hashes are similar."""
    return common >= similarity * (sizes - common) - 1e-9


def _possible(similarity: float):
    """Of one block, the rows that may reach the similarity with a row of the
    other side and of another component."""

    def run(table: pa.Table) -> pa.Table:
        here = table["here"].to_numpy()
        root, size, left = (table[c].to_numpy() for c in ("root", "size", "left"))
        a, b = np.flatnonzero(here), np.flatnonzero(~here)
        keep = np.zeros(len(here), bool)
        for at in range(0, len(b), 64):
            v = b[at : at + 64, None]
            ok = (root[v] != root[a]) & (np.minimum(left[v], left[a]) >= overlap_needed(size[v].astype(np.int64) + size[a], similarity))
            keep[a] |= ok.any(axis=0)
            keep[v.ravel()] |= ok.any(axis=1)
        return table.filter(pa.array(keep)).select(["key", "i", "j", "here", "node", "root"])

    return run


def _similar(similarity: float):
    """Of one block, links that connect what all its similar pairs of different
    components connect.  Common hashes are counted by an index of one side."""

    def run(table: pa.Table) -> pa.Table:
        here, node, root = (table[c].to_numpy() for c in ("here", "node", "root"))
        a, b = np.flatnonzero(here), np.flatnonzero(~here)
        sets = _hash_sets(table["hashes"].to_pylist())
        size = np.array([len(s) for s in sets])
        tokens = np.concatenate([sets[i] for i in a.tolist()]) if len(a) else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(a)), size[a])
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        label, out = {int(r): int(r) for r in root.tolist()}, []

        def top(x: int) -> int:
            while label[x] != x:
                label[x] = x = label[label[x]]
            return x

        for v in b.tolist():
            lo, hi = np.searchsorted(tokens, sets[v]), np.searchsorted(tokens, sets[v], side="right")
            n = hi - lo
            hit = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            common = np.bincount(owner[hit], minlength=len(a))
            for i in a[reaches(common, size[a] + size[v], similarity)].tolist():
                x, y = top(int(root[i])), top(int(root[v]))
                if x != y:
                    label[max(x, y)] = min(x, y)
                    out.append((int(node[i]), int(node[v])))
        u, v = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(u, pa.int64()), "b": pa.array(v, pa.int64())})

    return run


def _meetings(band: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between similar texts that share a key but no component.

    A key of one component gives nothing.  The rest are cut into blocks of about
    BLOCK nodes by BLOCK visitors; members of a key's largest component are only
    nodes, since they need not meet each other.  Rows that no row of the other
    side can reach by size and rank leave a block before the sets are sent, and
    of blocks with the same rows one stays.
    """
    at = band.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kinds = at.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    keys = kinds.groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n")).where("n > top.n")
    rows, columns = (F.ceil(x / BLOCK).cast("int").alias(c) for x, c in ((F.col("n"), "rows"), (F.col("n") - F.col("top.n"), "columns")))
    keys = keys.select("key", F.col("top.root").alias("main"), rows, columns)
    own_row = F.pmod(F.xxhash64("node", F.lit("row")), F.col("rows")).cast("int")
    own_column = F.pmod(F.xxhash64("node", F.lit("column")), F.col("columns")).cast("int")
    as_node = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda j: F.struct(own_row.alias("i"), j.alias("j"), F.lit(True).alias("here")))
    as_visitor = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda i: F.struct(i.alias("i"), own_column.alias("j"), F.lit(False).alias("here")))
    places = F.when(F.col("root") == F.col("main"), as_node).otherwise(F.concat(as_node, as_visitor))
    placed = at.join(keys, "key").select("key", "node", "root", "size", "left", F.explode(places).alias("p"))
    placed = placed.select("key", "p.i", "p.j", "p.here", "node", "root", "size", "left")
    block = ["key", "i", "j"]
    placed = written(placed.groupBy(*block).applyInArrow(_possible(similarity), "key long, i int, j int, here boolean, node long, root long"), "blocks")
    of = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("n"), *(F.bit_xor(F.xxhash64("node", "here", F.lit(x))).alias(f"x{x}") for x in (0, 1)))
    once = of.groupBy("n", "x0", "x1").agg(F.min(F.struct(*block)).alias("b")).select("b.*")
    placed = placed.join(once, block, "left_semi").join(sets, "node")
    return placed.groupBy(*block).applyInArrow(_similar(similarity), "a long, b long")


def _kept_rows(text_at: int, schema_names: int):
    """Batches with the places of rows that go, to the rows that stay."""

    def one(docs: bytes, texts: bytes, rest: bytes, gone: list[int] | None) -> pa.RecordBatch:
        _, _, lens, text = opened(docs, texts)
        keep = np.ones(len(lens), bool)
        keep[gone or []] = False
        arrays = rest_columns(rest)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int64())
        whole = pa.Array.from_buffers(pa.large_binary(), len(lens), [None, offsets.buffers()[1], pa.py_buffer(text)])
        null = arrays.pop()
        body = pa.array([None if n else t.as_buffer().to_pybytes() for t, n in zip(whole, null.to_pylist())], pa.binary()).view(pa.string())
        arrays.insert(text_at, body)
        return pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(schema_names)]).filter(pa.array(keep))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for i in range(b.num_rows):
                yield one(*(b.column(c)[i].as_py() for c in range(4)))

    return run


def deduplicated(docs: DataFrame, words: int = 5, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group, the one with the
    smallest doc_id stays (nulls last).

    A pair is a link if the share of common shingles, counted on whole texts, is
    at least ``similarity``; groups are the links' components, as a comparison
    of all pairs gives them.

    1. How many texts have each shingle is counted over all texts.  In the order
       of that number, rarest first, similar texts share a hash of both texts'
       first fifth (:func:`prefixes`); a text whose first fifth no other text has
       is alone and goes no further.
    2. Candidates are texts with fingerprints within ``radius`` bits (BK-trees),
       and each text with the first text of each key, a hash of its prefix.
    3. Texts of a key that are still in different components then meet in blocks,
       every pair of them that sizes and ranks allow, so no link is left out.

    Defined results: texts without words are alike; null texts are empty and come
    out null; rows with one doc_id are rows like any other; extra columns come
    out as they are; an empty table gives no row.
    """
    spark = docs.sparkSession
    at = docs.columns.index("text")
    rest = [c for i, c in enumerate(docs.columns) if i != at]
    null = "_no_text"
    while null in docs.columns:
        null += "_"
    with scratch() as keep:
        stored = keep(store_texts(docs.withColumn(null, F.col("text").isNull()), [*rest, null], BATCH, 3))
        total = stored.agg(F.sum(F.octet_length("texts")).alias("n")).head().n or 0
        # Texts take about a quarter of their bytes where they are stored.
        buckets = max(partitions(spark), 4 * total // BUCKET)
        message = "bucket int, batch long, data binary, more binary"
        told = written(to_buckets(stored.select("batch", "docs", "texts").mapInArrow(lean(_ask(words, buckets)), message), buckets).mapInArrow(lean(_answer), "batch long, bucket int, data binary"), "often", "uncompressed")
        tidy(spark)
        answers = at_batches(told, buckets).groupBy("batch").agg(F.collect_list(F.struct("bucket", "data")).alias("answers"))
        marks = written(at_batches(stored.select("batch", "docs", "texts"), buckets).join(answers, "batch", "left").mapInArrow(lean(_mark(words, buckets, similarity)), MARKS), "marks", "uncompressed")
        dropped(told)
        tidy(spark)
        # Rows with one set of shingles are one node, by 128-bit digest.
        first = F.struct(F.col("id").isNull().alias("late"), "id", "rid")
        full = F.when(F.col("size").isNotNull(), F.col("rid"))
        classes = written(marks.groupBy("digest").agg(F.min(first).alias("first"), F.min(full).alias("node"), F.count(F.lit(1)).alias("rows")), "classes")
        texts = marks.where("size IS NOT NULL").join(classes.select(F.col("node").alias("rid")), "rid", "left_semi").withColumnRenamed("rid", "node")
        sets = texts.select("node", "hashes")
        band = texts.select("node", "size", F.explode(F.arrays_zip("keys", "ranks")).alias("k"))
        band = written(band.select("node", "size", F.col("k.keys").alias("key"), (F.col("size") - F.col("k.ranks")).cast("int").alias("left")), "band")
        # Candidates by fingerprint: distinct ones within the radius, and equal ones.
        prints = texts.select("node", "fp", "size")
        by_fp = written(prints.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("of")).select("fp", "of.*"), "fp")
        near = links(by_fp.select("fp"), radius)
        u, v = (by_fp.toDF(f, x, n) for f, x, n in (("a", "u", "n1"), ("b", "v", "n2")))
        pairs = near.join(u, "a").join(v, "b").select("u", "n1", "v", "n2")
        pairs = pairs.unionByName(prints.toDF("u", "a", "n1").join(v.withColumnRenamed("b", "a"), "a").select("u", "n1", "v", "n2"))
        pairs = pairs.withColumn("left", F.least("n1", "n2"))
        # Candidates by key: each text with the key's first.
        head = band.groupBy("key").agg(F.min(F.struct("node", "size", "left")).alias("h"), F.count(F.lit(1)).alias("n")).where("n > 1")
        with_head = band.join(head, "key").select(F.col("node").alias("u"), F.col("size").alias("n1"), F.col("h.node").alias("v"), F.col("h.size").alias("n2"), F.least("left", "h.left").alias("left"))
        least = F.ceil((F.col("n1") + F.col("n2")) * (similarity / (1 + similarity)) - 1e-6)
        pairs = pairs.unionByName(with_head).where((F.col("u") != F.col("v")) & (F.col("left") >= least))
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

        @F.pandas_udf("boolean")
        def alike(a: pd.Series, b: pd.Series) -> pd.Series:
            both = ((x, y) for x, y in zip(_hash_sets(a), _hash_sets(b)))
            return pd.Series([bool(reaches(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y), similarity)) for x, y in both])

        found = pairs.join(sets.toDF("u", "s1"), "u").join(sets.toDF("v", "s2"), "v").where(alike("s1", "s2")).select(F.col("u").alias("a"), F.col("v").alias("b"))
        roots = components(found)
        new = _meetings(band, roots, sets, similarity)
        roots = components(new.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
        # Of each group of more than one row, all but the first go.
        of = classes.join(roots, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("root"))
        stay = of.groupBy("root").agg(F.min("first").alias("stay"))
        stay = of.join(stay, "root").select("digest", F.col("stay.rid").alias("stay"))
        gone = marks.select("rid", "digest").join(stay, "digest").where("rid <> stay")
        gone = at_batches(gone.withColumn("batch", F.shiftright("rid", PLACE_BITS)), buckets).groupBy("batch").agg(F.collect_list((F.col("rid") % (1 << PLACE_BITS)).cast("int")).alias("gone"))
        gone = keep(written(gone, "gone"))
    last = at_batches(stored, buckets).join(gone, "batch", "left").select("docs", "texts", "rest", "gone")
    return last.mapInArrow(lean(_kept_rows(at, len(docs.columns))), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
