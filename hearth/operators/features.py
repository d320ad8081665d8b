"""Feature columns for price models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.operators import quantiles

FEATURES = [
    "area", "latitude", "longitude", "bedroom", "bathroom", "floor_count", "province_id", "district_id", "total_rooms", "area_per_room", "bedroom_bathroom_ratio", "population_density",
]


def rooms(rows: DataFrame) -> DataFrame:
    """Null where a part is null or zero rooms would divide."""
    total = F.col("bedroom") + F.col("bathroom")
    return rows.withColumns(
        {
            "total_rooms": total,
            "area_per_room": F.try_divide(F.col("area"), F.nullif(total, F.lit(0))),
            "bedroom_bathroom_ratio": F.try_divide(F.col("bedroom").cast("double"), F.nullif(F.col("bathroom"), F.lit(0)).cast("double")),
        }
    )


def density(rows: DataFrame, by_province: DataFrame, default: float = 0.0) -> DataFrame:
    """``population_density`` by province; the dimension holds one row a province."""
    d = by_province.select(F.col("province_id").alias("_pid"), "population_density")
    return rows.join(d, F.col("province_id") == F.col("_pid"), "left").drop("_pid").withColumn("population_density", F.coalesce("population_density", F.lit(default)))


def served(rows: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Serving-time form: defaults for missing inputs, divisors of at least one."""
    filled = rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in defaults.items()})
    total = F.col("bedroom") + F.col("bathroom")
    return filled.withColumns(
        {"total_rooms": total, "area_per_room": F.col("area") / F.greatest(total, F.lit(1.0)), "bedroom_bathroom_ratio": F.col("bedroom") / F.greatest(F.col("bathroom"), F.lit(1.0))}
    )


def calendar(ts: Column) -> dict[str, Column]:
    month = F.month(ts)
    season = F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring").when(month.isin(6, 7, 8), "summer").otherwise("autumn")
    return {"year": F.year(ts), "month": month, "day": F.dayofmonth(ts), "quarter": F.quarter(ts), "season": season, "days": F.unix_date(F.to_date(ts))}


def interactions() -> dict[str, Column]:
    return {"price_per_area": F.try_divide(F.col("price"), F.col("area")), "log_price": F.log("price"), "area_squared": F.pow("area", F.lit(2.0)), "log_area": F.log("area")}


def tier(province: Column, first: tuple[str, ...], second: tuple[str, ...]) -> Column:
    return F.when(province.isin(*first), 1).when(province.isin(*second), 2).otherwise(3)


def null_if_unknown(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumns({c: F.nullif(F.col(c), F.lit(-1)) for c in columns})


def fallback_price(area: Column, province_id: Column, bedroom: Column, bathroom: Column, base: dict[int, float], default: float) -> Column:
    """A heuristic price: base by area and province, raised by rooms."""
    per = F.lit(default)
    for pid, value in base.items():
        per = F.when(province_id == pid, value).otherwise(per)
    return area * per * (1 + 0.05 * F.coalesce(bedroom, F.lit(0)) + 0.03 * F.coalesce(bathroom, F.lit(0)))


def plausible(price: Column) -> Column:
    return F.when(price < 1e8, "too_low").when(price > 5e10, "too_high").otherwise("ok")


def quality_01() -> Column:
    """Completeness from 0 to 1: four main values, four details, text and place."""
    parts = [(c, 0.1) for c in ("price", "area", "latitude", "longitude")] + [(c, 0.075) for c in ("bedroom", "bathroom", "floor_count", "house_type")] + [("title", 0.15), ("district", 0.15)]
    total = F.lit(0.0)
    for name, weight in parts:
        total = total + F.when(F.col(name).isNotNull(), weight).otherwise(0.0)
    return F.round(total, 4)


def completeness(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(*[F.round(F.count(c) / F.count(F.lit(1)), 6).alias(c) for c in columns])


def correlations(rows: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Correlation of each column with the label, one row a column, from one pass."""
    parts = [F.struct(F.lit(c).alias("name"), F.round(F.corr(c, label), 6).alias("r")) for c in columns]
    return rows.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def segments(rows: DataFrame, least: int = 1000) -> DataFrame:
    """Rows of the price segments that are large enough to train on."""
    marked = rows.withColumn("segment", F.when(F.col("price") >= 1e10, "luxury").when(F.col("price") >= 1e9, "mid"))
    sizes = marked.where("segment is not null").groupBy("segment").agg(F.count("*").alias("_n")).where(F.col("_n") > least)
    return marked.join(F.broadcast(sizes.select("segment")), "segment")


# The target and the sixteen features of the feature store.
STORED = (
    "price", "area", "latitude", "longitude", "bedroom", "bathroom", "floor_count", "house_direction_code", "legal_status_code", "interior_code", "province_id", "district_id", "ward_id",
    "total_rooms", "area_per_room", "bedroom_bathroom_ratio", "population_density",
)
NUMBERS = ("area", "latitude", "longitude", "bedroom", "bathroom", "floor_count", "population_density", "total_rooms", "area_per_room", "bedroom_bathroom_ratio")
CODES = ("province_id", "interior_code", "legal_status_code", "house_direction_code")
MANY_CODES = ("district_id", "ward_id")


def stored(rows: DataFrame) -> DataFrame:
    """The columns of the feature store and the id; a missing one is an error, others are dropped."""
    missing = [c for c in STORED if c not in rows.columns]
    if missing:
        raise ValueError(f"missing features: {', '.join(missing)}")
    return rows.select(*STORED, "id")


def filled(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Exact medians in place of nulls; columns without any value stay null."""
    held = rows.select(*columns).persist()
    try:
        typical = {c: quantiles.exact(held, c, [0.5])[0] for c in columns}
    finally:
        held.unpersist()
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(typical[c]).cast("double")) for c in columns})


def trained(rows: DataFrame) -> DataFrame:
    """Training-time form: medians for rooms, floors and area, then the derived columns with divisors a little above zero."""
    full = filled(rows, ("bedroom", "bathroom", "floor_count", "area")).withColumn("total_rooms", F.col("bedroom") + F.col("bathroom"))
    return full.withColumns({"area_per_room": F.col("area") / (F.col("total_rooms") + 1e-5), "bedroom_bathroom_ratio": F.col("bedroom") / (F.col("bathroom") + 1e-5)})


def for_trees(rows: DataFrame) -> DataFrame:
    """Codes as integers with -1 for none, medians for the other numbers."""
    codes = {c: F.coalesce(F.col(c), F.lit(-1)).cast("int") for c in CODES + MANY_CODES if c in rows.columns}
    return filled(trained(rows).withColumns(codes), tuple(c for c in NUMBERS if c in rows.columns or c in ("total_rooms", "area_per_room", "bedroom_bathroom_ratio")))


def for_lines(rows: DataFrame) -> DataFrame:
    """Logarithm of the price, codes as texts with "missing" for none, medians for the numbers."""
    codes = {c: F.when(F.col(c).isNull() | (F.col(c) == -1), "missing").otherwise(F.col(c).cast("string")) for c in CODES if c in rows.columns}
    return filled(trained(rows).withColumns(codes | {"log_price": F.log("price")}), tuple(c for c in NUMBERS if c in rows.columns or c in ("total_rooms", "area_per_room", "bedroom_bathroom_ratio")))


def modes(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The most frequent value in place of nulls, the smallest of equally frequent ones."""
    counted = [rows.where(F.col(c).isNotNull()).groupBy(F.col(c)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), c).limit(1).first() for c in columns]
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(r[0])) for c, r in zip(columns, counted, strict=True) if r is not None})
