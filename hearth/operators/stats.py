"""Market statistics: overviews, histograms, trends and profiles; one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.operators import quantiles

# Histogram bounds of the market endpoints.
PRICE_BINS = ((0, 1e9, "< 1 tỷ"), (1e9, 3e9, "1-3 tỷ"), (3e9, 5e9, "3-5 tỷ"), (5e9, 1e10, "5-10 tỷ"), (1e10, 2e10, "10-20 tỷ"), (2e10, None, "> 20 tỷ"))
AREA_BINS = ((0, 50, "< 50 m²"), (50, 100, "50-100 m²"), (100, 200, "100-200 m²"), (200, 500, "200-500 m²"), (500, None, "> 500 m²"))
# Edges by the largest value, in billions (price), millions (price by area) and billions (overview).
PRICE_EDGES = ((10, (0, 2, 4, 6, 8, 10)), (20, (0, 3, 6, 10, 15, 20)), (50, (0, 5, 10, 20, 35, 50)), (None, (0, 10, 25, 50, 100, None)))
PPM2_EDGES = ((50, (0, 10, 20, 30, 40, 50)), (100, (0, 15, 30, 50, 70, 100)), (200, (0, 30, 60, 100, 150, 200)), (None, (0, 50, 100, 200, 300, None)))
OVERVIEW_EDGES = ((15, (0, 2, 4, 7, 12, None)), (30, (0, 3, 6, 12, 20, None)), (None, (0, 5, 15, 30, 50, None)))


def whole_sum(c: str | Column) -> Column:
    """The sum of a column of numbers below 1e19, added exactly and rounded once to a whole number that a double holds: no order of the rows changes it."""
    return F.round(F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(28,9)")).cast("double")).cast("long")


def valued(listings: DataFrame) -> DataFrame:
    return listings.where((F.col("price") > 0) & (F.col("area") > 0))


def whole(c: Column | str) -> Column:
    """Averages of money are shown in whole units."""
    return F.round(F.avg(c)).cast("long")


def averages() -> list[Column]:
    return [
        F.count("*").alias("n"),
        whole("price").alias("avg_price"),
        F.round(F.avg("area"), 2).alias("avg_area"),
        whole("price_per_m2").alias("avg_ppm2"),
    ]


def overview(listings: DataFrame, where: Column | None = None) -> DataFrame:
    rows = valued(listings) if where is None else valued(listings).where(where)
    return rows.agg(
        *averages(), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.count_distinct("province").alias("provinces"), F.count_distinct("district").alias("districts"),
    )


def histogram(rows: DataFrame, value: str, bins, extra: list[Column]) -> DataFrame:
    """Counts and further aggregates by fixed bins in one pass; empty bins stay, as the dimension is on the left."""
    number = F.lit(None).cast("int")
    for i, (low, high, _) in reversed(list(enumerate(bins))):
        inside = F.col(value) >= low if high is None else (F.col(value) >= low) & (F.col(value) < high)
        number = F.when(inside, i).otherwise(number)
    found = rows.select("*", number.alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"), *extra)
    labels = F.array(*(F.struct(F.lit(i).alias("bin"), F.lit(label).alias("label")) for i, (_, _, label) in enumerate(bins)))
    dim = rows.sparkSession.range(0, 1, 1, 1).select(F.inline(labels))
    return dim.join(found, "bin", "left").fillna({"n": 0})


def adaptive_histogram(rows: DataFrame, value: Column, edges, unit: float) -> DataFrame:
    """Bins chosen by the largest value; empty ones are left out; the share in percent has one decimal.

    The largest value rides along as a window over the per-bin counts of every regime (five bins each), so the
    listings are read once.
    """
    v = rows.select(value.alias("v")).where("v is not null")
    counted = v.agg(
        F.max("v").alias("top"), F.count("*").alias("total"),
        *[
            agg
            for r, (_, cuts) in enumerate(edges)
            for i in range(len(cuts) - 1)
            for inside in [(F.col("v") >= cuts[i] * unit) & (F.lit(True) if cuts[i + 1] is None else F.col("v") < cuts[i + 1] * unit)]
            for agg in (F.count_if(inside).alias(f"n{r}_{i}"), F.sum(F.when(inside, F.col("v"))).alias(f"s{r}_{i}"))
        ],
    )
    rows_of = [
        F.struct(F.lit(r).alias("regime"), F.lit(float(cuts[i])).alias("low"), F.lit(None if cuts[i + 1] is None else float(cuts[i + 1])).cast("double").alias("high"),
                 F.col(f"n{r}_{i}").alias("n"), F.col(f"s{r}_{i}").alias("s"))
        for r, (_, cuts) in enumerate(edges) for i in range(len(cuts) - 1)
    ]
    regime = F.lit(len(edges) - 1)
    for r in range(len(edges) - 2, -1, -1):
        regime = F.when(F.col("top") / unit <= edges[r][0], r).otherwise(regime)
    each = counted.select("top", "total", regime.alias("chosen"), F.explode(F.array(*rows_of)).alias("b"))
    return each.where("b.regime = chosen and b.n > 0").select(
        F.col("b.low").alias("low"), F.col("b.high").alias("high"), F.col("b.n").alias("n"),
        F.round(F.col("b.s") / F.col("b.n")).cast("long").alias("avg_value"), F.round(F.col("b.n") * 100.0 / F.col("total"), 1).alias("pct"),
    )


def by_location(listings: DataFrame, level: str, limit: int) -> DataFrame:
    keys = ["province"] if level == "province" else ["district", "province"]
    found = valued(listings).where(F.col(level).isNotNull()).groupBy(*keys).agg(*averages())
    return found.orderBy(F.desc("n"), *keys).limit(limit)


def monthly_trend(listings: DataFrame) -> DataFrame:
    month = F.date_format(F.date_trunc("month", F.col("posted_date").cast("timestamp")), "yyyy-MM")
    return valued(listings).groupBy(month.alias("month")).agg(*averages())


def location_profile(listings: DataFrame) -> DataFrame:
    return valued(listings).groupBy("province_id").agg(
        F.count("*").alias("n"), whole("price").alias("avg_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.round(F.stddev_pop("price")).cast("long").alias("std_price"), F.round(F.avg("area"), 2).alias("avg_area"),
        F.round(F.avg("price") / F.avg("area")).cast("long").alias("ratio_ppm2"),
    )


def top_groups(listings: DataFrame, key: str, limit: int) -> DataFrame:
    return listings.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(limit)


def missing_profile(listings: DataFrame, columns: list[str]) -> DataFrame:
    return listings.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def numeric_profile(listings: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, sample deviation, extremes and exact median of each column, as one row a column; the columns are read once."""
    held = listings.select(*columns).persist()
    try:
        medians = {c: quantiles.exact(held, c, [0.5])[0] for c in columns}
    finally:
        held.unpersist()
    parts = [
        F.struct(
            F.lit(c).alias("name"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("dev"), F.min(c).cast("double").alias("low"),
            F.max(c).cast("double").alias("high"), F.lit(medians[c]).cast("double").alias("median"),
        )
        for c in columns
    ]
    one = listings.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p"))
    show = lambda n, d=2: F.round(F.col(f"p.{n}"), d).alias(n)
    return one.select("p.name", show("mean"), show("dev"), show("low"), show("high"), show("median"))


def price_errors(rows: DataFrame, actual: str, predicted: str, *by: str) -> DataFrame:
    """Error measures of predictions: shares within 10, 20 and 30 %, median and mean relative error, RMSE, MAE, R2.

    All groups of ``by`` (at most 1,000) come from one pass; their exact medians are found before, without sorting a group, and joined to the result.
    """
    e = rows.select(*by, F.col(actual).alias("y"), F.col(predicted).alias("p")).where("y is not null and p is not null and y <> 0")
    e = e.select(*by, "y", "p", (F.abs(F.col("y") - F.col("p")) / F.abs("y")).alias("rel"))
    held = e.persist()
    try:
        medians = quantiles.exact_by(held, list(by), "rel", [0.5]) if by else {(): quantiles.exact(held, "rel", [0.5])}
    finally:
        held.unpersist()
    within = lambda x: F.round(F.avg((F.col("rel") <= x).cast("double")) * 100, 4)
    sse = F.sum(F.pow(F.col("y") - F.col("p"), F.lit(2.0)))
    median = F.lit(None).cast("double")
    for group, (found,) in medians.items():
        mine = F.lit(True)
        for name, v in zip(by, group, strict=True):
            mine = mine & F.col(name).eqNullSafe(F.lit(v))
        median = F.when(mine, found).otherwise(median) if by else F.lit(found).cast("double")
    return e.groupBy(*by).agg(
        F.count("*").alias("n"), within(0.1).alias("within_10"), within(0.2).alias("within_20"), within(0.3).alias("within_30"),
        F.round(median * 100, 4).alias("median_error"), F.round(F.avg("rel") * 100, 4).alias("mape"),
        F.round(F.sqrt(F.avg(F.pow(F.col("y") - F.col("p"), F.lit(2.0))))).cast("long").alias("rmse"),
        F.round(F.avg(F.abs(F.col("y") - F.col("p")))).cast("long").alias("mae"), F.round(1 - sse / (F.var_pop("y") * F.count("*")), 6).alias("r2"),
    )


def error_spread(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Median, extremes and deviation of the absolute error, mean squared error, and the share of errors above their 95th percentile."""
    e = rows.select((F.col(actual) - F.col(predicted)).cast("double").alias("d")).where("d is not null").select(F.abs("d").alias("e"))
    held = e.persist()
    try:
        median, p95 = quantiles.exact(held, "e", [0.5, 0.95])
    finally:
        held.unpersist()
    money = lambda c: F.round(c).cast("long")
    return e.agg(
        F.count("*").alias("n"), F.round(F.avg(F.pow("e", F.lit(2.0))) / 1e12).cast("long").alias("mse_1e12"), money(F.max("e")).alias("max_error"), money(F.min("e")).alias("min_error"),
        money(F.stddev_pop("e")).alias("std_error"), money(F.lit(median)).alias("median_abs_error"),
        F.count_if(F.col("e") > p95).alias("outliers") if p95 is not None else F.lit(0).cast("long").alias("outliers"),
        F.round(F.avg((F.col("e") > F.lit(p95)).cast("double")) * 100, 4).alias("outliers_pct"),
    )


def band_profile(rows: DataFrame, actual: str, predicted: str, bands: tuple[tuple[str, float, float | None], ...]) -> DataFrame:
    """Mean absolute and relative error and number of rows by named band of the true value; empty bands are left out."""
    name = F.lit(None).cast("string")
    for label, low, high in bands:
        inside = (F.col(actual) >= low) & (F.lit(True) if high is None else F.col(actual) < high)
        name = F.when(inside, label).otherwise(name)
    gap = F.abs(F.col(actual) - F.col(predicted))
    found = rows.where(name.isNotNull()).groupBy(name.alias("band"))
    return found.agg(F.count("*").alias("n"), F.round(F.avg(gap)).cast("long").alias("mae"), F.round(F.avg(gap / F.col(actual)), 6).alias("mape"))


def band_errors(rows: DataFrame, actual: str, predicted: str, bounds: tuple[float, ...], least: int = 10) -> DataFrame:
    """Mean absolute error by band of the true value, for bands with more than ``least`` rows."""
    band = F.lit(0)
    for i, b in enumerate(bounds, 1):
        band = F.when(F.col(actual) >= b, i).otherwise(band)
    found = rows.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.round(F.avg(F.abs(F.col(actual) - F.col(predicted)))).cast("long").alias("mae"))
    return found.where(F.col("n") > least)


def share_of_total(counts: DataFrame, n: str = "n") -> DataFrame:
    return counts.withColumn("pct", F.round(F.col(n) * 100.0 / F.sum(n).over(Window.partitionBy(F.lit(1))), 1))


def covariances(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``a, b, n, covariance, correlation`` of every pair of columns (a column with itself too) over the rows that hold both, in one pass.

    A column without spread has no correlation (null).
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    value = {c: F.col(c).cast("double") for c in columns}
    both = {(a, b): F.col(a).isNotNull() & F.col(b).isNotNull() for a, b in pairs}
    spread = lambda a, b: F.sqrt(F.var_samp(F.when(both[a, b], value[a])) * F.var_samp(F.when(both[a, b], value[b])))
    sums = rows.agg(*[
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"), F.count(F.when(both[a, b], 1)).alias("n"), F.covar_samp(value[a], value[b]).alias("covariance"),
            F.try_divide(F.covar_samp(value[a], value[b]), spread(a, b)).alias("correlation"),
        ).alias(f"p{i}")
        for i, (a, b) in enumerate(pairs)
    ])
    return sums.select(F.inline(F.array(*[f"p{i}" for i in range(len(pairs))])))


def chosen_features(matrix: DataFrame, target: str, least_variance: float = 0.0, most: int = 10) -> DataFrame:
    """``name, variance, strength`` of the columns of a covariance matrix that vary more than a bound, the ``most`` of greatest
    correlation (either sign) with the target first; of equal ones the first by name."""
    own = matrix.where((F.col("a") == F.col("b")) & (F.col("a") != target)).select(F.col("a").alias("name"), F.col("covariance").alias("variance"))
    with_target = matrix.where((F.col("a") != F.col("b")) & ((F.col("a") == target) | (F.col("b") == target)))
    strength = with_target.select(F.when(F.col("a") == target, F.col("b")).otherwise(F.col("a")).alias("name"), F.abs("correlation").alias("strength"))
    return own.where(F.col("variance") > least_variance).join(strength, "name").orderBy(F.desc_nulls_last("strength"), "name").limit(most)
