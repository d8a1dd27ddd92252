"""Mixing sources to target weights by hash-threshold histograms.

Sizes are summed by source and hash bucket; a running sum over a source's
buckets finds the bucket in which its budget ends; only that bucket is split
into finer buckets, level by level, until few documents are left in it.  A
document is then taken or not by comparing its hash with its source's
threshold, so no table is sorted.  Thresholds are nested: a larger budget
takes a superset.

Targets: sources in code point order, null last, weigh WEIGHTS in turn and
share ``share`` of all sizes; a target stops at ``most`` times its source's
size and the excess is shared by weight among the others.  A target above its
source's size takes every document whole and the rest a second time by the
threshold, so no document is taken more than ``most`` times.

Defined results: null text has size 0 and is taken 0 words; the threshold falls
on a whole document, the one that leaves the sum nearest the target; repeated
doc_ids with the same text and null doc_ids have equal hashes and are told
apart by their text's hash, and rows alike in both are taken or left together;
an empty table gives no row.  Sources may be as many as documents: their
table is a table like others, and the driver sees a few sums of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.functions.ranges import range_of
from granary.llm.common import n_words, scratch, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Ranges of sources that are numbered by a task each.
RANGES = 64
#: Bits of the hash that one level's buckets stand for, and the hash's levels.
BITS = 10
LEVELS = 6


def source_table(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target, ``whole`` copies that the target takes of every
    document, and ``need``, the words it takes beyond them.

    The level that the budget fills the sources to, by weight, is found in rounds:
    a source whose share is above its limit is full, and what it leaves goes to the
    others.  A round is one aggregate of the sources."""
    sums = written(sized.groupBy("source").agg(F.sum("size").alias("s")), "sources")
    order = [F.col("source").isNull(), F.col("source")]
    ranged = sums.withColumn("_p", range_of(sums, order, RANGES))
    sizes = ranged.groupBy("_p").count()
    before = F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("_p").alias("_q"), F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    ranged = ranged.withColumn("_n", place).join(F.broadcast(sizes), F.col("_p") == F.col("_q"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("_n") + F.col("_before")) % len(weights) + 1).cast("int"))
    table = written(ranged.select("source", "s", weight.alias("w")), "weights")
    total, many = table.agg(F.sum("s"), F.sum("w")).head()
    budget = share * float(total or 0)
    limit = most * F.col("s").cast("double")
    level, full = budget / many if many else 0.0, -1
    while True:
        is_full = F.lit(level) * F.col("w") >= limit
        n, filled, open_ = table.agg(F.count_if(is_full), F.sum(F.when(is_full, limit)), F.sum(F.when(~is_full, F.col("w")))).head()
        if n == full or not open_:
            break
        full, level = n, max(0.0, budget - (filled or 0.0)) / open_
    target = F.least(F.lit(level) * F.col("w"), limit) if table.head(1) else F.lit(0.0)
    out = table.select("source", F.col("s").alias("source_size"), target.alias("target"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    out = out.withColumn("whole", whole).withColumn("need", F.when(F.col("source_size") > 0, F.col("target") - F.col("whole") * F.col("source_size")).otherwise(0.0))
    return written(out, "targets")


def _hash(doc_id, text):
    """The place of a document between 0 and 2^(BITS * LEVELS)."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("mix"), F.coalesce(F.xxhash64(text), F.lit(0))), 64 - BITS * LEVELS)


def _sized(docs: DataFrame) -> DataFrame:
    return written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _hash(F.col("doc_id"), F.col("text")).alias("h")), "mix")


def thresholds(sized: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per source: src, source_size, target, ``whole`` copies of every
    document, and one more of those whose hash is below ``cut``."""
    total = BITS * LEVELS
    sources = source_table(sized, weights, share)
    # Where each source's search stands: all hashes below ``low`` are taken.
    at = sources.where("need > 0").select(F.col("source").alias("src"), "need", F.lit(0).cast("long").alias("low"), F.lit(0.0).alias("below"), F.lit(0).cast("long").alias("last"))
    for level in range(LEVELS):
        shift = total - BITS * (level + 1)
        inside = F.shiftrightunsigned(F.col("h"), shift + BITS) == F.shiftrightunsigned(F.col("low"), shift + BITS)
        d = sized.where("size > 0").join(at, F.col("source").eqNullSafe(F.col("src")) & inside)
        b = d.groupBy("src", F.shiftrightunsigned("h", shift).alias("bucket")).agg(F.sum("size").alias("s"), F.first("need").alias("need"), F.first("below").alias("below"))
        # At most 2^BITS rows per source.
        upto = F.col("below") + F.sum("s").over(Window.partitionBy("src").orderBy("bucket"))
        b = b.withColumn("upto", upto).where(F.col("upto") >= F.col("need"))
        first = b.groupBy("src").agg(F.min_by(F.struct("bucket", "upto", "s", "need"), "bucket").alias("x"))
        at = written(first.select("src", F.col("x.need").alias("need"), F.shiftleft(F.col("x.bucket"), shift).alias("low"), (F.col("x.upto") - F.col("x.s")).alias("below"), F.col("x.s").alias("last")), "at")
    # The last bucket holds one hash: take it if that leaves the sum nearer.
    more = F.col("last") - (F.col("need") - F.col("below")) < F.col("need") - F.col("below")
    cuts = at.select("src", (F.col("low") + F.when(more, 1).otherwise(0)).alias("cut"))
    return sources.join(cuts, F.col("source").eqNullSafe(F.col("src")), "left").select(F.col("source").alias("src"), "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut"))


def _copies(h):
    return F.col("whole") + F.when((h < F.col("cut")) & (F.col("whole") < MOST), 1).otherwise(0)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    with scratch() as keep:
        sized = keep(_sized(docs))
        cuts = keep(written(thresholds(sized, weights, share), "cuts"))
    out = sized.join(cuts, F.col("source").eqNullSafe(F.col("src")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * _copies(F.col("h"))).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken."""
    with scratch() as keep:
        table = thresholds(_sized(docs), weights, share).toDF("_src", "_size", "_target", "whole", "cut")
        table = keep(written(table.select("_src", "whole", "cut"), "cuts"))
    row = docs.select(F.col("source").alias("_source"), _hash(F.col("doc_id"), F.col("text")).alias("_h"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    out = row.join(table, F.col("_source").eqNullSafe(F.col("_src")))
    out = out.select("_row", _copies(F.col("_h")).cast("int").alias("_n")).where("_n > 0")
    return out.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_n")))).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
