"""Summaries: robust vectors, weighted percentiles, threshold counts, regression, outlier flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUANTILES = {"q10": 0.1, "q25": 0.25, "median": 0.5, "q75": 0.75, "q90": 0.9}


def finite(c: Column) -> Column:
    """The value if it is a finite number, else null."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def summary(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """count, min, q10 .. q90, max, mean, stdev and MAD of the finite values.

    Percentiles interpolate linearly; the deviation of a single value is 0; the MAD is unscaled.
    """
    rows = df.select(*keys, finite(F.col(value).cast("double")).alias("__v")).where("__v is not null")
    v = F.col("__v")
    first = rows.groupBy(*keys).agg(
        F.count(v).alias("count"), F.min(v).alias("min"), F.percentile(v, F.array(*[F.lit(q) for q in QUANTILES.values()])).alias("__q"), F.max(v).alias("max"),
        F.avg(v).alias("mean"), F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("stdev"),
    )
    named = first.select(*keys, "count", "min", *[F.col("__q")[i].alias(n) for i, n in enumerate(QUANTILES)], "max", "mean", "stdev")
    if not keys:
        away = rows.join(F.broadcast(named.select("median")))  # one row
        return named.join(F.broadcast(away.agg(F.percentile(F.abs(v - F.col("median")), F.lit(0.5)).alias("mad"))))
    deviation = rows.join(named.select(*keys, "median"), keys).groupBy(*keys).agg(F.percentile(F.abs(v - F.col("median")), F.lit(0.5)).alias("mad"))
    return named.join(deviation, keys)


def long_metrics(df: DataFrame, keys: list[str], metrics: list[str], metric: str = "metric", value: str = "value") -> DataFrame:
    """One row a key and metric."""
    return df.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(keys, metrics, metric, value)


def weighted_percentiles(df: DataFrame, keys: list[str], value: str, weight: str, shares: dict[str, float]) -> DataFrame:
    """The first value whose running weight reaches the share of the total; no interpolation.

    Weights are added up per value before they are scanned, so a window holds one row a value.
    """
    sums = df.groupBy(*keys, F.col(value).alias("__v")).agg(F.sum(weight).alias("__w"))
    order = Window.partitionBy(*keys).orderBy("__v")
    run = F.sum("__w").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("__w").over(Window.partitionBy(*keys))
    scanned = sums.withColumn("__run", run).withColumn("__total", total)
    return scanned.groupBy(*keys).agg(*[F.min(F.when(F.col("__run") >= F.col("__total") * s, F.col("__v"))).alias(n) for n, s in shares.items()])


def threshold_counts(value: str, limits: list[float], weight: Column | None = None, name: str = "above") -> list[Column]:
    """Weighted counts of values over each limit."""
    w = F.lit(1) if weight is None else weight
    return [F.sum(F.when(F.col(value) > t, w).otherwise(0)).alias(f"{name}_{str(t).replace('.', '_')}") for t in limits]


def bin_counts(value: str, edges: list[float], name: str = "bin") -> list[Column]:
    """Counts of half-open bins."""
    v = F.col(value)
    return [F.count(F.when((v >= a) & (v < b), 1)).alias(f"{name}_{i}") for i, (a, b) in enumerate(zip(edges, edges[1:]))]


def weighted_mean(value: Column, weight: Column, floor: float = 1e-6) -> Column:
    """Histogram mean with a guard for no weight at all (A10)."""
    return F.sum(value * weight) / F.greatest(F.sum(weight), F.lit(floor))


def packed(order: Column, value: Column, sep: str = ";") -> Column:
    """A histogram's values in order as one text (A10)."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"].cast("string")), sep)


def regression(x: Column, y: Column) -> list[Column]:
    """slope, intercept and correlation of y on x."""
    return [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.corr(y, x).alias("r")]


def sex_call(kmers: DataFrame, keys: list[str], limit: float = 0.05) -> DataFrame:
    """Sex by k-mer coverage (N05). ``kmers``: keys, part (auto, x, y, m), gc, count.

    Medians and 101 percentiles a part, regression of log(count + 0.01) on the GC excess of
    the autosomal k-mers, ratios to the autosomal median, F if the Y ratio is under ``limit``.
    """
    parts = ("auto", "x", "y", "m")
    grid = F.array(*[F.lit(i / 100) for i in range(101)])
    own = lambda p, c: F.when(F.col("part") == p, c)
    log = F.log(F.col("count") + 0.01)
    wide = kmers.groupBy(*keys).agg(
        *[F.percentile(own(p, F.col("count")), F.lit(0.5)).alias(f"{p}_median") for p in parts],
        *[F.percentile(own(p, F.col("count")), grid).alias(f"{p}_percentiles") for p in parts],
        F.regr_slope(own("auto", log), F.col("gc")).alias("gc_slope"), F.regr_intercept(own("auto", log), F.col("gc")).alias("gc_intercept"),
    )
    ratio = lambda p: F.try_divide(F.col(f"{p}_median"), F.col("auto_median"))
    return wide.withColumns({f"{p}_ratio": ratio(p) for p in ("x", "y", "m")}).withColumn("sex", F.when(F.col("y_ratio").isNull(), None).when(F.col("y_ratio") < limit, "F").otherwise("M"))


def outlier_flags(df: DataFrame, scope: list[str], entity: str, value: str, factor: float = 6.0) -> DataFrame:
    """Entities beyond median +- factor * MAD of their scope; without spread over twice the median or under 0."""
    base = summary(df, scope, value).select(*scope, "median", "mad")
    joined = df.join(base, scope) if scope else df.join(F.broadcast(base))  # one row
    high = F.when(F.col("mad") > 0, F.col("median") + factor * F.col("mad")).otherwise(2 * F.col("median"))
    low = F.when(F.col("mad") > 0, F.greatest(F.lit(0.0), F.col("median") - factor * F.col("mad"))).otherwise(F.lit(0.0))
    flag = F.when(F.col(value) > F.col("high"), "HIGH").when(F.col(value) < F.col("low"), "LOW")
    return joined.withColumn("high", high).withColumn("low", low).withColumn("flag", flag).where("flag is not null").select(*scope, entity, value, "median", "mad", "high", "low", "flag")


def phred(errors: Column, total: Column, most: float = 100.0) -> Column:
    """-10 log10(errors / total), at most ``most``; no error gives ``most``, no total null."""
    rate = F.try_divide(errors.cast("double"), total.cast("double"))
    return F.when(rate.isNull(), None).when(rate <= 0, most).otherwise(F.least(F.lit(most), -10 * F.log10(rate)))


def mixed_aggregate(df: DataFrame, keys: list[str], order: Column, largest: tuple[str, ...] = ()) -> DataFrame:
    """Columns of mixed types added up by type: numbers summed, the named ones' maximum, texts first in order."""
    out = []
    for name, kind in df.dtypes:
        if name in keys:
            continue
        if name in largest:
            out.append(F.max(name).alias(name))
        elif kind == "string":
            out.append(F.min_by(name, order).alias(name))
        elif kind in ("int", "bigint", "double", "float", "smallint", "tinyint") or kind.startswith("decimal"):
            out.append(F.sum(name).alias(name))
    return df.groupBy(*keys).agg(*out)


def arg_first(df: DataFrame, keys: list[str], best: Column, order: Column) -> DataFrame:
    """The row with the largest ``best`` of each key, the first in order on ties."""
    w = Window.partitionBy(*keys).orderBy(best.desc(), order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def ratio_of_means(df: DataFrame, is_top: Column, is_bottom: Column, value: Column, weight: Column, factor: float = 1.0) -> DataFrame:
    """factor * weighted mean of one group over that of another; null if either has no weight."""
    mean = lambda cond: F.try_divide(F.sum(F.when(cond, value * weight)), F.sum(F.when(cond, weight)))
    return df.agg(F.try_divide(factor * mean(is_top), mean(is_bottom)).alias("ratio"))
