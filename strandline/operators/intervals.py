"""Interval algebra on half-open, zero-based intervals.

Tables have ``start`` and ``end`` columns and any number of key columns (a chromosome,
a sample, a type). Intervals with end <= start or a null bound take no part.

Overlap joins put intervals into bins of fixed width, join on (keys, bin) and keep a
pair only in the bin of the later start, so no pair shows up twice and no
de-duplication shuffle is needed; the bins also spread a hot key. Ordered scans
(merge, subtract, breakpoints) use one window a key, or with ``width`` two levels
(bins of a key, then the sums of its bins), so one hot chromosome doesn't end in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.genome import contig_rank


def valid(df: DataFrame) -> DataFrame:
    return df.where((F.col("end") > F.col("start")) & F.col("start").isNotNull())


def from_closed(df: DataFrame) -> DataFrame:
    """One-based closed intervals as half-open ones."""
    return df.withColumn("start", F.col("start") - 1)


def to_closed(df: DataFrame) -> DataFrame:
    """Half-open intervals as one-based closed ones."""
    return df.withColumn("start", F.col("start") + 1)


def islands(df: DataFrame, keys: list[str], gap: int = 0, width: int | None = None) -> DataFrame:
    """Adds ``island``: the running number of the merged interval a row belongs to.

    A row starts an island if its start is more than ``gap`` after the largest end before it.
    """
    if width is None:
        order = Window.partitionBy(*keys).orderBy("start", "end")
        prev = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
        flagged = df.withColumn("__new", F.when(prev.isNull() | (F.col("start") > prev + gap), 1).otherwise(0))
        return flagged.withColumn("island", F.sum("__new").over(order.rangeBetween(Window.unboundedPreceding, 0))).drop("__new")
    binned = df.withColumn("__bin", F.floor(F.col("start") / width))
    over_bins = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = binned.groupBy(*keys, "__bin").agg(F.max("end").alias("__top")).select(*keys, "__bin", F.max("__top").over(over_bins).alias("__carried"))
    order = Window.partitionBy(*keys, "__bin").orderBy("start", "end")
    prev = F.greatest(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.col("__carried"))
    flagged = binned.join(carried, [*keys, "__bin"]).withColumn("__new", F.when(prev.isNull() | (F.col("start") > prev + gap), 1).otherwise(0))
    base = flagged.groupBy(*keys, "__bin").agg(F.sum("__new").alias("__n")).select(*keys, "__bin", F.coalesce(F.sum("__n").over(over_bins), F.lit(0)).alias("__base"))
    own = F.sum("__new").over(order.rangeBetween(Window.unboundedPreceding, 0))  # equal intervals share an island
    return flagged.join(base, [*keys, "__bin"]).withColumn("island", F.col("__base") + own).drop("__bin", "__carried", "__new", "__base")


def merge(df: DataFrame, keys: list[str], gap: int = 0, width: int | None = None) -> DataFrame:
    """Unions of overlapping or touching intervals: keys, start, end, n."""
    found = islands(valid(df).select(*keys, "start", "end"), keys, gap, width)
    return found.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n")).drop("island")


def recurrent_loci(calls: DataFrame, keys: list[str], sample: str, gap: int, least: int, means: list[str], width: int | None = None) -> DataFrame:
    """Islands of closed intervals that ``least`` samples share: bounds, calls, samples, means of columns."""
    found = islands(calls, keys, gap, width)
    return (
        found.groupBy(*keys, "island")
        .agg(
            F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("call_count"), F.countDistinct(sample).alias("sample_count"),
            *[F.avg(c).alias(f"mean_{c}") for c in means],
        )
        .where(F.col("sample_count") >= least).withColumn("length", F.col("end") - F.col("start") + 1).drop("island")
    )


def bin_width(df: DataFrame, share: float = 0.95) -> int:
    """A bin width from the lengths: their ``share`` quantile."""
    row = df.select(F.percentile_approx(F.col("end") - F.col("start"), share)).first()
    return max(1, int(row[0] or 1))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int, how: str = "inner", slack: int = 0) -> DataFrame:
    """Pairs of overlapping intervals with equal keys (I04); right columns get the prefix ``r_``.

    ``how``: inner, left, semi or anti. Intervals of any length are matched; ``width`` only
    sets how many bins an interval is copied to. ``slack`` widens the left side.
    """
    bins = lambda s, e: F.sequence(F.floor(s / width), F.floor((e - 1) / width))
    renamed = valid(right).select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    b = renamed.withColumn("__bin", F.explode(bins(F.col("r_start"), F.col("r_end"))))
    lo, hi = F.col("start") - slack, F.col("end") + slack
    numbered = valid(left)
    if how != "inner":  # equal rows are rows of their own
        numbered = numbered.withColumn("__row", F.monotonically_increasing_id())
    a = numbered.withColumn("__bin", F.explode(bins(lo, hi)))
    on = [F.col(k) == F.col(f"r_{k}") for k in keys]
    a = a.withColumnRenamed("__bin", "__abin")
    on += [F.col("__abin") == F.col("__bin"), lo < F.col("r_end"), F.col("r_start") < hi]
    first = F.floor(F.greatest(lo, F.col("r_start")) / width) == F.col("__bin")
    if how in ("semi", "anti"):
        hit = a.join(b, on, "left_semi").select(*left.columns, "__row").dropDuplicates(["__row"])
        return (hit if how == "semi" else numbered.join(hit.select("__row"), "__row", "left_anti")).select(*left.columns)
    pairs = a.join(b, [*on, first]).drop("__abin", "__bin")
    if how == "inner":
        return pairs
    lonely = numbered.join(pairs.select("__row").distinct(), "__row", "left_anti")
    return pairs.unionByName(lonely, allowMissingColumns=True).drop("__row")


def overlap_length() -> Column:
    """Of a pair from ``overlap_join``."""
    return F.least("end", "r_end") - F.greatest("start", "r_start")


def intersect(left: DataFrame, right: DataFrame, keys: list[str], width: int) -> DataFrame:
    """The parts of left intervals that lie in right ones, one row a pair."""
    pairs = overlap_join(left, right, keys, width)
    return pairs.select(*keys, F.greatest("start", "r_start").alias("start"), F.least("end", "r_end").alias("end"))


def _depths(sides: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Segments between breakpoints with the depth of every side."""
    points = None
    for name, df in sides.items():
        df = valid(df)
        change = F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("by")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("by"))))
        own = df.select(*keys, change.alias("p")).select(*keys, "p.at", *[(F.col("p.by") if n == name else F.lit(0)).alias(f"__{n}") for n in sides])
        points = own if points is None else points.unionByName(own)
    steps = points.groupBy(*keys, "at").agg(*[F.sum(f"__{n}").alias(f"__{n}") for n in sides])
    order = Window.partitionBy(*keys).orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return steps.select(*keys, F.col("at").alias("start"), F.lead("at").over(order).alias("end"), *[F.sum(f"__{n}").over(upto).alias(n) for n in sides]).where("end is not null")


def subtract(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """What of the left intervals' union no right interval covers."""
    return merge(_depths({"a": left, "b": right}, keys).where("a > 0 and b = 0").select(*keys, "start", "end"), keys).drop("n")


def segments(sides: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """The union cut at every breakpoint, with each side's depth and the number of sides present."""
    n = sum(((F.col(s) > 0).cast("int") for s in sides), F.lit(0))
    return _depths(sides, keys).withColumn("sides", n).where("sides > 0")


def windows(df: DataFrame, size: int) -> DataFrame:
    """Intervals cut into windows of ``size``, the last one shorter."""
    at = df.withColumn("__at", F.explode(F.sequence(F.col("start"), F.col("end") - 1, F.lit(size).cast(dict(df.dtypes)["start"]))))
    return at.withColumn("end", F.least(F.col("__at") + size, F.col("end"))).withColumn("start", F.col("__at")).drop("__at")


def slop(df: DataFrame, lengths: DataFrame, key: str, by: int, last_base: bool = False) -> DataFrame:
    """Intervals widened on both sides within their chromosome; ``lengths``: key, length.

    ``last_base`` clips the end to length - 1.
    """
    limit = F.col("__length") - (1 if last_base else 0)
    return (
        df.join(lengths.select(F.col(key), F.col("length").alias("__length")), key)
        .withColumn("start", F.greatest(F.lit(0), F.col("start") - by)).withColumn("end", F.least(limit, F.col("end") + by)).drop("__length")
    )


def slop_ends(df: DataFrame, lengths: DataFrame, key: str, by: int, order: str = "start") -> DataFrame:
    """Only the first record's start and the last record's end of each chromosome are widened."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(order)) == 1
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order))) == 1
    marked = df.withColumn("__first", first).withColumn("__last", last).join(lengths.select(F.col(key), F.col("length").alias("__length")), key)
    return (
        marked.withColumn("start", F.when(F.col("__first"), F.greatest(F.lit(0), F.col("start") - by)).otherwise(F.col("start")))
        .withColumn("end", F.when(F.col("__last"), F.least(F.col("__length") - 1, F.col("end") + by)).otherwise(F.col("end")))
        .drop("__first", "__last", "__length")
    )


def genome_order(df: DataFrame, key: str = "chrom") -> DataFrame:
    """Sorted by chromosome rank, start, end."""
    return df.orderBy(contig_rank(F.col(key)), "start", "end")


def base_content(df: DataFrame, reference: DataFrame, key: str, block: int) -> DataFrame:
    """Adds n_share and gc_share of each interval (I10, I14). ``reference``: key, block number, seq of ``block`` bases."""
    rows = df.withColumn("__row", F.monotonically_increasing_id())
    parts = rows.withColumn("__block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    ref = reference.select(F.col(key), F.col("block").alias("__block"), "seq")
    base = F.col("__block") * block
    piece = F.substring("seq", (F.greatest("start", base) - base + 1).cast("int"), (F.least(F.col("end"), base + block) - F.greatest("start", base)).cast("int"))
    count = lambda chars: F.sum(F.length(F.regexp_replace("__piece", f"[^{chars}]", "")))
    sums = parts.join(ref, [key, "__block"], "left").withColumn("__piece", piece).groupBy("__row").agg(count("Nn").alias("__n"), count("GCgc").alias("__gc"))
    size = F.col("end") - F.col("start")
    return rows.join(sums, "__row").withColumn("n_share", F.col("__n") / size).withColumn("gc_share", F.try_divide(F.col("__gc"), size - F.col("__n"))).drop("__row", "__n", "__gc")


def split_even(df: DataFrame, n: int, order: list, keys: list[str] | None = None) -> DataFrame:
    """Adds ``part``: one of n parts of nearly equal numbers of rows, in order."""
    return df.withColumn("part", F.ntile(n).over(Window.partitionBy(*(keys or [])).orderBy(*order)) - 1)


def reunite(df: DataFrame, digits: int) -> DataFrame:
    """Coarser parts by the leading digits of a part's zero-padded number."""
    return df.withColumn("group", F.substring(F.lpad(F.col("part").cast("string"), digits + 1, "0"), 1, digits))


def weighted_overlap(calls: DataFrame, bins: DataFrame, keys: list[str], value: str, width: int, id_cols: list[str]) -> DataFrame:
    """Overlap-weighted mean of the bins' values for each call."""
    pairs = overlap_join(calls, bins, keys, width)
    w = overlap_length()
    return pairs.groupBy(*id_cols).agg((F.sum(F.col(f"r_{value}") * w) / F.sum(w)).alias("weighted_mean"), F.sum(w).alias("covered"), F.count(F.lit(1)).alias("bins"))


def covered_share(kits: DataFrame, coverage: DataFrame, keys: list[str], kit: str, value: str, least: float, width: int, merged: bool = False) -> DataFrame:
    """Per kit the share of its bases with at least ``least`` coverage.

    Overlapping intervals of a kit count twice unless ``merged``.
    """
    base = merge(kits, [kit, *keys]).drop("n") if merged else valid(kits).select(kit, *keys, "start", "end")
    total = base.groupBy(kit).agg(F.sum(F.col("end") - F.col("start")).alias("total"))
    pairs = overlap_join(base, coverage.where(F.col(value) >= least), keys, width)
    got = pairs.groupBy(kit).agg(F.sum(overlap_length()).alias("covered"))
    return total.join(got, kit, "left").select(kit, "total", F.coalesce("covered", F.lit(0)).alias("covered"), (F.coalesce("covered", F.lit(0)) / F.col("total")).alias("score"))


def best_kit(scores: DataFrame, kit: str, declared: str, order: str = "ord") -> DataFrame:
    """The kit with the highest score, the first in order on ties, and whether it differs from the declared one without regard to case."""
    best = scores.agg(F.max_by(F.col(kit), F.struct(F.col("score"), -F.col(order))).alias("best"), F.max("score").alias("score"))
    return best.withColumn("differs", F.lower("best") != F.lit(declared.lower()))


def shift_circular(df: DataFrame, by: int, length: int) -> DataFrame:
    """Positions on a circle moved by ``by`` (I15): pos stays in 1..length."""
    return df.withColumn("pos", (F.col("pos") - 1 + by) % length + 1)


def span(df: DataFrame, order: str) -> DataFrame:
    """First chromosome and start, last chromosome and end in the file's order."""
    return df.agg(
        F.min_by(F.struct("chrom", "start"), order).alias("first"), F.max_by(F.struct("chrom", "end"), order).alias("last")
    ).select(F.col("first.chrom").alias("first_chrom"), F.col("first.start").alias("start"), F.col("last.chrom").alias("last_chrom"), F.col("last.end").alias("end"))
