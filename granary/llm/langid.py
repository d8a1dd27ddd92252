"""Language ID by prediction by partial matching over byte contexts.

Each language has a tree of byte contexts of up to ORDER bytes.  A byte's code
length is taken from the longest known context; a byte that the context has not
seen pays the context's escape probability and falls to the next shorter one,
down to a uniform order -1 (method C, without exclusions).  Every byte of the
sample is a symbol of its own; bytes that it lacks are one symbol, spelled out
by the number of such bytes.  The statistics are
frozen after training, so the code length of every (context, byte) pair is
resolved once into a table, and a text's exact code length under a language is
a sum of table entries.  The shortest code wins.

The model is fitted on a bounded sample: at most PER_LANGUAGE different texts of
each language, of at most SAMPLE_CHARS characters, and at most SAMPLE_TEXTS (one
of each language at least) in all; of more than LANGUAGES languages the most
frequent are learned.  Its table holds at most CELLS numbers (32 MB) beside one
for each symbol and language, so its broadcast does not grow with the corpus.

Defined results: ``und`` with score 0 where the text is null or has no letter
(general category L: numerals are none), or no labelled text exists; ties go to the language first in code point order;
repeated rows are judged each for itself; a null doc_id is learned from and is
not held out; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm.common import lean

ORDER = 3
PER_LANGUAGE = 300
SAMPLE_CHARS = 200_000
CELLS = 8_000_000
SAMPLE_TEXTS = 60_000
LANGUAGES = 10_000
_LETTER = regex.compile(r"\p{L}")
_SLICE = 1 << 20


def bounded_sample(rows: DataFrame, by: str, per: int, key: Column) -> DataFrame:
    """At most ``per`` rows of each value of ``by``, different in ``key``: those
    with the smallest hashes of it.

    Of more than LANGUAGES values the most frequent have a sample, and all
    samples have at most SAMPLE_TEXTS rows, or one of each value.  Only rows
    whose hash makes them likely are sorted; a value of which these are few, since
    a few keys fill it, is sampled again from all of its rows."""
    spark = rows.sparkSession
    counts = rows.groupBy(by).count().orderBy(F.desc("count"), by).limit(LANGUAGES).collect()
    if not counts:
        return rows.limit(0)
    per = max(1, min(per, SAMPLE_TEXTS // len(counts)))
    kind = dict(rows.dtypes)[by]
    shares = spark.createDataFrame([(r[by], min(1.0, 4 * per / r["count"])) for r in counts], f"_by {kind}, _share double")
    place = F.xxhash64(key, F.lit("sample"))
    placed = rows.withColumn("_place", place).join(F.broadcast(shares), F.col(by) == F.col("_by"))
    first = Window.partitionBy(by).orderBy("_place")

    def least(found: DataFrame) -> DataFrame:
        # Equal keys are one row before anything is shuffled.
        once = found.groupBy(by, "_place").agg(F.first(F.struct(*(F.col(f"`{c}`") for c in rows.columns))).alias("_row"))
        return once.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per)

    likely = placed.where(F.pmod("_place", F.lit(1 << 20)) < F.col("_share") * (1 << 20))
    found = {r[by]: r["count"] for r in least(likely).groupBy(by).count().collect()}
    few = [r[by] for r in counts if found.get(r[by], 0) < min(per, r["count"])]
    again = placed.join(F.broadcast(spark.createDataFrame([(x,) for x in few], f"_few {kind}")), F.col(by) == F.col("_few")) if few else None
    if again is not None:
        likely = likely.join(F.broadcast(spark.createDataFrame([(x,) for x in few], f"_few {kind}")), F.col(by) == F.col("_few"), "left_anti").unionByName(again.drop("_few"))
    return least(likely).select("_row.*")


class Model:
    """Resolved code lengths: ``bits[context * A + byte class, language]``."""

    def __init__(self, samples: dict[str, list[bytes]], order: int = ORDER, cells: int = CELLS) -> None:
        self.languages = sorted(samples, key=str.encode)
        self.order = order
        texts = {x: [np.frombuffer(t, np.uint8) for t in samples[x]] for x in self.languages}
        seen = sum((np.bincount(np.concatenate(t), minlength=256) for t in texts.values()), np.zeros(256, int))
        common = np.flatnonzero(seen > 0)
        self.code = np.zeros(256, np.int64)
        self.code[common] = np.arange(1, len(common) + 1)
        self.size = a = len(common) + 1
        self.spelled = float(np.log2(max(1, 256 - len(common))))
        streams = {x: self._codes(t) for x, t in texts.items()}
        most = max(1, cells // (a * len(self.languages)))
        # Row 0 is the empty context; known[k] maps a packed context of k bytes to its row.
        counts = {x: [self._count(codes, k) for k in range(order + 1)] for x, codes in streams.items()}
        rows, known = 1, [np.zeros(1, np.int64)]
        for k in range(1, order + 1):
            total = np.zeros(a**k, np.int64)
            for x in self.languages:
                keys, n = counts[x][k]
                np.add.at(total, keys // a, n)
            found = np.flatnonzero(total >= 2)
            found = np.sort(found[np.argsort(-total[found], kind="stable")[: max(0, most - rows)]])
            shorter = known[k - 1][np.arange(a**k) % a ** (k - 1)]
            shorter[found] = rows + np.arange(len(found))
            known.append(shorter)
            rows += len(found)
        self.row = known[order].astype(np.int32)
        bits = np.empty((rows, a, len(self.languages)), np.float32)
        for j, x in enumerate(self.languages):
            done = np.zeros(rows, bool)
            for k in range(order + 1):
                keys, n = counts[x][k]
                ctx, sym = keys // a, keys % a
                own = np.ones(1, bool) if k == 0 else known[k] != known[k - 1][np.arange(a**k) % a ** (k - 1)]
                if k == 0:
                    bits[0, :, j] = np.log2(a)
                else:
                    mine = np.flatnonzero(own)
                    bits[known[k][mine], :, j] = bits[known[k - 1][mine % a ** (k - 1)], :, j]
                total = np.bincount(ctx, n, minlength=a**k)
                kinds = np.bincount(ctx, minlength=a**k)
                live = np.flatnonzero((total > 0) & own)
                bits[known[k][live], :, j] += np.log2((total + kinds)[live] / kinds[live])[:, None]
                ok = own[ctx]
                bits[known[k][ctx[ok]], sym[ok], j] = np.log2((total + kinds)[ctx[ok]] / n[ok])
                done[known[k]] = True
        self.bits = bits.reshape(rows * a, len(self.languages))

    def _codes(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' classes, each text after a gap, and which are no gap."""
        gap = np.zeros(self.order, np.int64)
        codes = np.concatenate([x for t in texts for x in (gap, self.code[t])] or [gap])
        real = np.concatenate([np.repeat([False, True], [self.order, len(t)]) for t in texts] or [gap > 0])
        return codes, real[self.order :]

    def _count(self, stream: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        codes, real = stream
        n = len(codes) - self.order
        key = np.zeros(n, np.int64)
        for i in range(k, -1, -1):
            key = key * self.size + codes[self.order - i : self.order - i + n]
        return np.unique(key[real], return_counts=True)

    def code_lengths(self, text: bytes) -> np.ndarray:
        """Bits of the whole text under each language."""
        out = np.zeros(len(self.languages))
        raw = np.frombuffer(text, np.uint8)
        tail = np.zeros(self.order, np.int64)
        for at in range(0, len(raw), _SLICE):
            codes = np.concatenate([tail, self.code[raw[at : at + _SLICE]]])
            n = len(codes) - self.order
            ctx = codes[:n].copy()
            for i in range(1, self.order):
                ctx *= self.size
                ctx += codes[i : i + n]
            cell = self.row[ctx].astype(np.int64)
            cell *= self.size
            cell += codes[self.order :]
            out += self.bits[cell].sum(axis=0, dtype=np.float64) + self.spelled * np.count_nonzero(codes[self.order :] == 0)
            tail = codes[n:]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not _LETTER.search(text):
            return "und", 0.0
        bits = self.code_lengths(text.encode("utf-8", "replace"))
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(np.clip(bits[best] - bits, -1000, 0)).sum())


def held_out(doc_id: Column, of: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == part, F.lit(False))


def fit(labelled: DataFrame, per: int = PER_LANGUAGE) -> Model | None:
    """A model of (doc_id, text, lang) rows; None where there are none."""
    rows = labelled.where(F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS)).select("doc_id", "text", "lang")
    samples: dict[str, list[bytes]] = {}
    for r in bounded_sample(rows, "lang", per, F.struct("doc_id", "text")).collect():
        samples.setdefault(r.lang, []).append(r.text.encode("utf-8", "replace"))
    return Model(samples) if any(map(any, samples.values())) else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            yield pd.DataFrame([model.predict(t) if model else ("und", 0.0) for t in texts], columns=["lang_pred", "score"])

    @F.pandas_udf("lang_pred string, score double")
    def said(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return lean(predicted)(batches)

    return docs.select("doc_id", "held_out", said("text").alias("said")).select("doc_id", "held_out", "said.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    return predict(docs, fit(docs.where("not held_out")))
