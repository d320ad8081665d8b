"""The listings view over the driver tables, and its SQL twin for checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# What a listing's key, and so its id, is made of; equal keys have equal numbers.
NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def listing_key() -> Column:
    """The key of a line's listing."""
    return F.concat_ws("-", *[F.col(c).cast("string") for c in NUMBERS])


def listings(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, numbered: bool = False) -> DataFrame:
    """One listing for each order line (or each of ``lines``), with its ``NUMBERS`` where asked; dimension sides are small and left to Catalyst's broadcast choice.

    Grouped by the numbers, in place of the id made of them, listings stay where the joins by order or part have dealt them.

    The large joins come before those that bring names, and that of the suppliers, which a filter on districts reaches, first: lines are
    dealt out by order and by part as narrow as they are.
    """
    line = table(spark, sf_dir, "lineitem") if lines is None else lines
    part, supplier = (table(spark, sf_dir, t) for t in ("part", "supplier"))
    nation, region, orders = (table(spark, sf_dir, t) for t in ("nation", "region", "orders"))
    joined = (
        line.join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(orders, line.l_orderkey == orders.o_orderkey)
        .join(part, line.l_partkey == part.p_partkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    key = listing_key()
    size = F.col("p_size")
    return joined.select(
        *NUMBERS if numbered else [],
        F.md5(key).alias("id"),
        key.alias("listing_key"),
        F.when(F.col("l_returnflag") == "R", "src_b").otherwise("src_a").alias("source"),
        F.col("p_name").alias("title"),
        F.concat(F.lit("https://example.org/listing/"), F.col("l_orderkey").cast("string"), F.lit(".htm")).alias("url"),
        F.col("r_name").alias("province"),
        F.col("n_name").alias("district"),
        F.col("p_brand").alias("ward"),
        F.col("p_name").alias("street"),
        F.col("r_regionkey").cast("int").alias("province_id"),
        F.col("n_nationkey").cast("int").alias("district_id"),
        (F.col("l_extendedprice") * 200000).alias("price"),
        (F.col("l_quantity") * 10).alias("area"),
        F.nullif(size % 6, F.lit(0)).alias("bedroom"),
        F.nullif(size % 4, F.lit(0)).alias("bathroom"),
        F.nullif(F.col("l_linenumber") % 5, F.lit(0)).alias("floor_count"),
        (F.lit(8.0) + (F.col("l_partkey") % 1550).cast("double") / 100.0).alias("latitude"),
        (F.lit(102.0) + (F.col("l_suppkey") % 800).cast("double") / 100.0).alias("longitude"),
        F.col("p_type").alias("house_type"),
        F.col("o_orderdate").alias("posted_date"),
        F.col("l_shipdate").alias("processing_timestamp"),
        (F.col("l_extendedprice") * 200000 / (F.col("l_quantity") * 10)).alias("price_per_m2"),
    )


def leading_listings(spark: SparkSession, sf_dir: str, n: int = 1, sought: int = 1000) -> DataFrame:
    """Listings that hold the ``n`` least keys: those of the ``sought`` least lines, or all where too few of these have all their sides."""
    lines = table(spark, sf_dir, "lineitem")
    few = listings(spark, sf_dir, lines.orderBy(listing_key()).limit(sought))
    return few if few.select("listing_key").distinct().count() >= n else listings(spark, sf_dir)


LISTINGS_SQL = """
SELECT md5(concat_ws('-', l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber)) AS id,
  concat_ws('-', l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber) AS listing_key,
  CASE WHEN l.l_returnflag = 'R' THEN 'src_b' ELSE 'src_a' END AS source,
  p.p_name AS title, 'https://example.org/listing/' || l.l_orderkey || '.htm' AS url,
  r.r_name AS province, n.n_name AS district, p.p_brand AS ward, p.p_name AS street,
  CAST(r.r_regionkey AS INT) AS province_id, CAST(n.n_nationkey AS INT) AS district_id,
  l.l_extendedprice * 200000 AS price, l.l_quantity * 10 AS area,
  nullif(p.p_size % 6, 0) AS bedroom, nullif(p.p_size % 4, 0) AS bathroom, nullif(l.l_linenumber % 5, 0) AS floor_count,
  CAST(8 AS DOUBLE) + CAST(l.l_partkey % 1550 AS DOUBLE) / CAST(100 AS DOUBLE) AS latitude,
  CAST(102 AS DOUBLE) + CAST(l.l_suppkey % 800 AS DOUBLE) / CAST(100 AS DOUBLE) AS longitude,
  p.p_type AS house_type, o.o_orderdate AS posted_date, l.l_shipdate AS processing_timestamp,
  l.l_extendedprice * 200000 / (l.l_quantity * 10) AS price_per_m2
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
JOIN orders o ON o.o_orderkey = l.l_orderkey
"""


def with_listings(sql: str) -> str:
    """Oracle SQL over the listings view (``sql`` may start with further CTEs: ``name AS (...), ... SELECT``)."""
    rest = sql.strip()
    glue = "," if not rest.upper().startswith("SELECT") else ""
    return f"WITH listings AS ({LISTINGS_SQL}){glue} {rest}"
