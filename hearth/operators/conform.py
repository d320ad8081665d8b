"""Schema conformance, serving projection and surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Lengths of the serving columns.
LENGTHS = {"province": 100, "district": 100, "ward": 200, "street": 200, "house_direction": 50, "legal_status": 100, "interior": 100, "house_type": 100}


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema in its order and types; missing ones are typed nulls, others are dropped."""
    have = set(rows.columns)
    return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def require(rows: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return rows.select(*columns)


def surrogate_id(url: Column, source: Column, fallback: Column) -> Column:
    """md5 of url and source; without a source of the url alone; without an url of source and fallback key."""
    return F.when(url.isNotNull() & source.isNotNull(), F.md5(F.concat(url, source))).when(url.isNotNull(), F.md5(url)).otherwise(F.md5(F.concat(F.coalesce(source, F.lit("")), fallback)))


def serving(rows: DataFrame) -> DataFrame:
    """Valid rows only, casts and length limits of the serving table."""
    short = {c: F.substring(c, 1, n) for c, n in LENGTHS.items() if c in rows.columns}
    price_ok = F.col("price").isNull() | (F.col("price") >= 0)
    area_ok = F.col("area").isNull() | (F.col("area") > 0)
    nowhere = F.col("latitude").isNull() & F.col("longitude").isNull()
    place_ok = nowhere | (F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))
    valid = rows.where(F.col("id").isNotNull() & F.col("title").isNotNull() & price_ok & area_ok & place_ok)
    return valid.withColumns(short | {"price": F.round("price").cast("long"), "price_per_m2": F.round("price_per_m2").cast("long"), "floor_count": F.col("floor_count").cast("int")})
