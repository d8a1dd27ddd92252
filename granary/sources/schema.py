"""Tables of the domain.  ``NUTRIENTS`` is the one place to add a nutrient."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column -> (short key, name among targets, decimals)
NUTRIENTS = {
    "kcal": ("kcal", "kcal", 0),
    "protein": ("p", "protein", 1),
    "carbs": ("c", "carbs", 1),
    "fibre": ("f", "fibre", 1),
    "iron": ("fe", "iron", 2),
    "calcium": ("ca", "calcium", 0),
    "vitc": ("vc", "vitc", 1),
    "folate": ("fol", "folate", 0),
    "omega3": ("o3", "omega3", 2),
    "omega3_dha": ("o3d", "omega3dha", 2),
    "zinc": ("zn", "zinc", 2),
    "vita": ("va", "vita", 0),
    "magnesium": ("mg", "magnesium", 0),
    "potassium": ("k", "potassium", 0),
}
FLAGS = ("pantry", "base", "green", "probiotic", "topper")


INGREDIENTS = dict(id="string", name="string", unit="string", default_qty="double", role="string", **{f: "boolean" for f in FLAGS}, **{n: "double" for n in NUTRIENTS}, note="string", shelf="int", pack="double", packname="string", lead="double", prep="string", makes="array<string>", keep="boolean", needform="string", gated="array<string>", ifct_code="string", grams="double", grams_src="string", sort="int")
TARGETS = dict(fname="string", nkey="string", name="string", unit="string", cadence="string", daily="double", meal="double", permeal="boolean", sort="int")
RECIPES = dict(id="string", name="string", method="string", cuisine="string", effort_src="string", src="string", meals="array<string>", core="array<string>", opt="array<string>", amounts="map<string,double>", effort="int", is_user="boolean")
PLATES = dict(id="string", meal="string", recipe_id="string", date="date", created_at="timestamp", planned="boolean")
PLATE_ITEMS = dict(plate_id="string", ing_id="string", qty="double")
STOCK = dict(ing_id="string", qty="double", updated_at="timestamp", bought_at="timestamp", useup="boolean")
PINS = dict(recipe_id="string", perweek="double")
TABLES = {"ingredients": INGREDIENTS, "targets": TARGETS, "recipes": RECIPES, "plates": PLATES, "plate_items": PLATE_ITEMS, "stock": STOCK, "pins": PINS}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in TABLES[table].items()))


def with_missing_columns(df: DataFrame, columns: dict[str, str], defaults: dict | None = None) -> DataFrame:
    """Additive evolution: add what is missing, with its default."""
    have = set(df.columns)
    return df.withColumns({c: F.lit((defaults or {}).get(c)).cast(t) for c, t in columns.items() if c not in have})
