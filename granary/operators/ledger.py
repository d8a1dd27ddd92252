"""Zero-floored stock from an event log, in closed form.

With running sum S from 0, stock floored at every step is
S - least(0, smallest S so far).  An absolute set starts a new segment whose
first change is the set value, so windows replace the sequential fold.

Events are cut into CHUNKS ranges of their order, so the events of one item
are not one task's.  What a chunk does to the stock x that it finds is
greatest(x + a, b), or b alone if it sets; those few pairs per item are folded
in order and give each chunk the stock it begins with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.ranges import range_of

_MONEY = "decimal(18,2)"
_SUM = "decimal(28,2)"
CHUNKS = 32


def _local(log: DataFrame, key: str, order: list[str], delta: Column, is_set: Column | None, chunks: int) -> DataFrame:
    """Adds, within a key's chunk, the segment, the running sum and its least value."""
    out = log.withColumn("_d", delta.cast(_MONEY)).withColumn("_c", range_of(log, [F.col(c) for c in order], chunks))

    def upto(*more: str):
        return Window.partitionBy(key, "_c", *more).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    out = out.withColumn("_seg", F.sum(F.when(is_set, 1).otherwise(0)).over(upto()) if is_set is not None else F.lit(0))
    # decimal sums cannot lose cents, whatever the order of addition.
    out = out.withColumn("_s", F.sum("_d").over(upto("_seg")).cast(_SUM))
    return out.withColumn("_low", F.min("_s").over(upto("_seg")))


def _effects(local: DataFrame, key: str, order: list[str]) -> DataFrame:
    """key, effects: (chunk, a, b) of a key's chunks in order; a is null after a set."""
    zero = F.lit(0).cast(_SUM)
    first = F.col("_seg") == 0
    end = F.struct(F.when(first, F.col("_s")).alias("a"), F.when(first, F.col("_s") - F.col("_low")).otherwise(F.col("_s") - F.least(zero, "_low")).cast(_SUM).alias("b"))
    ends = local.groupBy(key, "_c").agg(F.max_by(end, F.struct(*order)).alias("e"))
    return ends.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_c", "e.a", "e.b"))).alias("effects"))


def _folded(effects: Column) -> Column:
    """Stock after the effects, from none."""
    return F.aggregate(effects, F.lit(0).cast(_SUM), lambda x, e: F.greatest((x + e["a"]).cast(_SUM), e["b"]))


def history(log: DataFrame, key: str, order: list[str], delta: Column, is_set: Column | None = None, chunks: int = CHUNKS) -> DataFrame:
    """Stock after every event, as column ``qty``.

    ``order`` must be total within a key.  Where ``is_set`` holds, ``delta`` is
    the new absolute value.  A null delta changes nothing."""
    local = _local(log, key, order, F.coalesce(delta, F.lit(0)), is_set, chunks)
    effects = _effects(local, key, order)
    begin = F.transform("effects", lambda e, i: F.struct(e["_c"].alias("c"), _folded(F.slice("effects", 1, i)).alias("x")))
    begins = effects.select(F.col(key).alias("_k"), F.explode(begin).alias("_b")).select("_k", F.col("_b.c").alias("_bc"), F.col("_b.x").alias("_x"))
    out = local.join(begins, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_c") == F.col("_bc")))
    found = F.when(F.col("_seg") == 0, F.col("_x")).otherwise(F.lit(0).cast(_SUM))
    qty = (F.col("_s") - F.least(-found, F.col("_low"))).cast("double")
    return out.withColumn("qty", qty).select(*log.columns, "qty")


def state(log: DataFrame, key: str, order: list[str], delta: Column, is_set: Column | None = None, chunks: int = CHUNKS) -> DataFrame:
    """key, qty: last stock of every key."""
    effects = _effects(_local(log, key, order, F.coalesce(delta, F.lit(0)), is_set, chunks), key, order)
    return effects.select(key, _folded(F.col("effects")).cast("double").alias("qty"))


def purchase_clock(log: DataFrame, key: str, order: list[str], ts: str, delta: Column, strict: bool = False) -> DataFrame:
    """Time of the last purchase of every key; null where there is none.

    ``strict`` also starts the clock at a key's first event, whatever its sign."""
    bought = F.when(delta > 0, F.col(ts))
    if strict:
        first = F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1
        log = log.withColumn("_b", F.when((delta > 0) | first, F.col(ts)))
        bought = F.col("_b")
    return log.groupBy(key).agg(F.max(bought).alias("bought_at"))


def expired(clock: DataFrame, shelf: Column, as_of: Column) -> DataFrame:
    """Adds ``expired``: bought_at plus shelf days lies before as_of."""
    until = F.date_add(F.to_date("bought_at"), shelf.cast("int"))
    return clock.withColumn("expired", F.coalesce(until < F.to_date(as_of), F.lit(False)))
