"""Plates with their items, and the changes to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators import merge


def kept_plates(plates: DataFrame, planned: bool = False, since=None) -> DataFrame:
    """Eaten or intended plates, from an inclusive date on if one is given."""
    out = plates.where(F.col("planned") == planned)
    return out if since is None else out.where(F.col("date") >= F.lit(since))


def with_items(plates: DataFrame, items: DataFrame, order: str = "line") -> DataFrame:
    """Each plate with its items in order; an empty list where it has none."""
    nested = items.groupBy(F.col("plate_id").alias("_p")).agg(F.sort_array(F.collect_list(F.struct(order, "ing_id", "qty"))).alias("items"))
    out = plates.join(nested, F.col("id") == F.col("_p"), "left").drop("_p")
    empty = F.array().cast(dict(nested.dtypes)["items"])
    return out.withColumn("items", F.transform(F.coalesce("items", empty), lambda x: F.struct(x["ing_id"].alias("id"), x["qty"].alias("qty"))))


def items_of(items: DataFrame, plates: DataFrame) -> DataFrame:
    """Items of the kept plates only."""
    return items.join(plates.select(F.col("id").alias("plate_id")), "plate_id", "left_semi")


def _moves(items: DataFrame, plates: DataFrame, sign: int) -> DataFrame:
    return items_of(items, plates).groupBy("ing_id").agg((F.sum("qty") * sign).alias("delta"))


def save_plate(state: dict[str, DataFrame], plate: DataFrame, items: DataFrame, now, strict: bool = False) -> dict[str, DataFrame]:
    """Insert or replace a plate and its items; stock follows eaten plates.

    An eaten plate that replaces one first credits the old items; ``strict``
    also credits those of a plate that was only planned."""
    old = state["plates"].join(plate.select("id"), "id", "left_semi")
    credit = old if strict else old.where("not planned")
    stock = merge.add_stock(state["stock"], _moves(state["plate_items"], credit, 1), now)
    items = items.withColumn("qty", F.coalesce("qty", F.lit(1.0)))
    stock = merge.add_stock(stock, _moves(items, plate.where("not planned"), -1), now)
    rest = state["plate_items"].join(plate.select(F.col("id").alias("plate_id")), "plate_id", "left_anti")
    return state | {"plates": merge.merge(state["plates"], plate, "id"), "plate_items": rest.unionByName(items.select(*rest.columns)), "stock": stock}


def delete_plates(state: dict[str, DataFrame], ids: DataFrame, now) -> dict[str, DataFrame]:
    """Eaten plates give back their stock; items go with their plate."""
    gone = state["plates"].join(ids.select("id"), "id", "left_semi")
    stock = merge.add_stock(state["stock"], _moves(state["plate_items"], gone.where("not planned"), 1), now)
    plates = state["plates"].join(ids.select("id"), "id", "left_anti")
    items = state["plate_items"].join(ids.select(F.col("id").alias("plate_id")), "plate_id", "left_anti")
    return state | {"plates": plates, "plate_items": items, "stock": stock}


def cook_slot(state: dict[str, DataFrame], plate_id: str, now) -> dict[str, DataFrame]:
    """A planned plate becomes eaten and its items leave the stock."""
    slot = state["plates"].where((F.col("id") == plate_id) & F.col("planned"))
    if not slot.take(1):
        raise ValueError(f"no planned plate {plate_id}")
    stock = merge.add_stock(state["stock"], _moves(state["plate_items"], slot, -1), now)
    plates = state["plates"].withColumn("planned", F.col("planned") & (F.col("id") != plate_id))
    return state | {"plates": plates, "stock": stock}


def save_menu(plates: DataFrame, slots: DataFrame) -> DataFrame:
    """Planned plates within the batch's dates give way to the batch."""
    return merge.replace_range(plates, slots.withColumn("planned", F.lit(True)), "date", F.col("planned"))


def clear_menu(plates: DataFrame, lo, hi) -> DataFrame:
    return merge.clear_range(plates, "date", lo, hi, F.col("planned"))


def with_id(plates: DataFrame, now_ms: Column) -> DataFrame:
    """Plates without an id get the default one: ``m`` or ``p`` and a time (MG4)."""
    mark = F.concat(F.when(F.col("planned"), "m").otherwise("p"), now_ms.cast("string"))
    return plates.withColumn("id", F.coalesce(F.nullif(F.col("id").cast("string"), F.lit("")), mark))


def import_plates(plates: DataFrame, incoming: DataFrame) -> DataFrame:
    """Bulk import without stock movement; rows lacking date or meal are skipped."""
    return merge.merge(plates, _complete(incoming), "id")


def _complete(incoming: DataFrame) -> DataFrame:
    return incoming.where(F.col("date").isNotNull() & F.col("meal").isNotNull() & (F.col("meal") != ""))


def import_local(state: dict[str, DataFrame], incoming: DataFrame, items: DataFrame, recipes: DataFrame, now_ms: Column) -> tuple[dict[str, DataFrame], DataFrame]:
    """Bulk import of plates with their items, and of recipes; stock stays.

    Returns the new state and one row of counts, of what came in and not of what
    was kept.  Plates lacking date or meal are skipped with their items; a missing
    quantity is 1; importing again changes nothing."""
    good = _complete(incoming).withColumn("planned", F.lit(False))
    ids = good.select(F.col("id").alias("plate_id"))
    rest = state["plate_items"].join(ids, "plate_id", "left_anti")
    new = items.join(ids.distinct(), "plate_id", "left_semi").withColumn("qty", F.coalesce("qty", F.lit(1.0)))
    counts = incoming.agg(F.count(F.lit(1)).alias("plates")).crossJoin(recipes.agg(F.count(F.lit(1)).alias("recipes")))
    kept = {"plates": merge.merge(state["plates"], good, "id"), "plate_items": rest.unionByName(new.select(*rest.columns)), "recipes": merge.save_recipe(state["recipes"], merge.user_recipes(recipes, now_ms))}
    return state | kept, counts
