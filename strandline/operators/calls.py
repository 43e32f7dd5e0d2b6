"""Copy-number calls: confidence filters, summaries, cohort comparison and matching."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default limits of a high-confidence call.
LIMITS = {"qs": 50, "np": 2, "length": 1000}
EXCLUDED = ("chrX", "chrY", "chrM", "X", "Y", "M", "MT")


def non_reference(copies: Column, alt: Column) -> Column:
    """Copy number other than 2; without a number, an alternative allele."""
    n = copies.cast("string").try_cast("int")
    return F.when(n.isNotNull(), n != 2).otherwise(F.coalesce(~alt.isin("", "."), F.lit(False)))


def passes(filter_: Column) -> Column:
    """FILTER empty, '.' or PASS."""
    return F.coalesce(filter_.isin("", ".", "PASS"), F.lit(True))


def high_confidence(call: Column, limits: dict = LIMITS, excluded: tuple[str, ...] = EXCLUDED) -> Column:
    """All conditions on a call struct<contig,start,end,copies,alt,filter,qs,np>; an unknown score fails."""
    cond = (
        non_reference(call["copies"], call["alt"]) & ~call["contig"].isin(*excluded) & passes(call["filter"])
        & (call["qs"] >= limits["qs"]) & (call["np"] >= limits["np"]) & (call["end"] - call["start"] >= limits["length"])
    )
    return F.coalesce(cond, F.lit(False))


def segment_summary(calls: DataFrame, keys: list[str]) -> DataFrame:
    """Counters of raw and confident calls by sample (A05). ``calls`` has svtype, confident, copies, start, end, qs, np."""
    size = F.col("end") - F.col("start")
    good = F.col("confident")
    n = lambda cond: F.count(F.when(cond, 1))
    kind = lambda k: good & (F.col("svtype") == k)
    copies = F.col("copies").cast("string").try_cast("int")
    return calls.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("raw_calls"), n(good).alias("calls"), n(kind("DEL")).alias("dels"), n(kind("DUP")).alias("dups"),
        F.sum(F.when(good, size).otherwise(0)).alias("bases"), F.sum(F.when(kind("DEL"), size).otherwise(0)).alias("del_bases"),
        F.sum(F.when(kind("DUP"), size).otherwise(0)).alias("dup_bases"), F.sum(F.when(good, F.col("np")).otherwise(0)).alias("intervals"),
        F.avg(F.when(good, F.col("qs"))).alias("mean_qs"), F.percentile(F.when(good, size), F.lit(0.5)).alias("median_length"),
        n(kind("DEL") & (copies == 0)).alias("hom_dels"), n(kind("DEL") & (copies == 1)).alias("het_dels"),
    )


def type_summary(calls: DataFrame, keys: list[str], sample: str = "sample") -> DataFrame:
    """Calls, samples, bases and the copy-number histogram by type."""
    size = F.col("end") - F.col("start")
    copies = F.col("copies").cast("string")
    return calls.groupBy(*keys, "svtype").agg(
        F.count(F.lit(1)).alias("calls"), F.countDistinct(sample).alias("samples"), F.sum(size).alias("bases"),
        *[F.count(F.when(copies == str(k), 1)).alias(f"copies_{k}") for k in range(6)],
    )


def contig_summary(calls: DataFrame, contigs: DataFrame, keys: list[str], sample: str = "sample") -> DataFrame:
    """Calls by chromosome and per megabase of it (A07). ``contigs``: contig, length."""
    rows = calls.groupBy(*keys, "contig").agg(F.count(F.lit(1)).alias("calls"), F.countDistinct(sample).alias("samples"))
    return rows.join(contigs, "contig", "left").withColumn("per_mb", F.try_divide(F.col("calls") * 1e6, F.col("length")))


def interval_summary(observations: DataFrame, by: list[list[str]]) -> DataFrame:
    """Copy-number counters and the best and second best likelihood gap, for each grouping.

    ``observations``: copies, cnq, cnlp (array). ``by``: grouping sets; absent keys are null.
    """
    keys = list(dict.fromkeys(k for g in by for k in g))
    ranked = F.array_sort("cnlp")
    rows = observations.withColumn("gap", F.when(F.size("cnlp") > 1, F.get(ranked, F.lit(1)) - F.get(ranked, F.lit(0))))
    return rows.groupingSets([[F.col(k) for k in g] for g in by], *[F.col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("intervals"), *[F.count(F.when(F.col("copies") == k, 1)).alias(f"copies_{k}") for k in range(5)],
        F.avg("cnq").alias("mean_cnq"), F.avg("gap").alias("mean_gap"),
    )


def ratio_summary(ratios: DataFrame, keys: list[str], value: str = "ratio") -> DataFrame:
    """Shares of copy ratios beyond fixed limits; non-finite values are counted apart."""
    v = F.col(value)
    fine = ~F.isnan(v) & (F.abs(v) != float("inf"))
    ok = F.when(fine, v)
    share = lambda cond: F.avg(F.when(ok.isNotNull(), F.when(cond, 1.0).otherwise(0.0)))
    return ratios.groupBy(*keys).agg(
        F.count(ok).alias("bins"), F.count(F.when(~fine, 1)).alias("nonfinite"), F.avg(ok).alias("mean"), F.percentile(ok, F.lit(0.5)).alias("median"),
        share(ok < 0.5).alias("under_half"), share(ok < 1.5).alias("under_one_and_half"), share(ok > 2.5).alias("over_two_and_half"), share(ok > 3.5).alias("over_three_and_half"),
    )


def frequency_bins(calls: DataFrame, keys: list[str], column: str, edges: tuple[float, ...] = (0.0, 0.01, 0.05, 0.1, 0.5, 1.0 + 1e-9)) -> DataFrame:
    """Allele frequencies in comma lists by half-open bins."""
    values = calls.select(*keys, F.explode(F.split(column, ",")).alias("t")).select(*keys, F.trim("t").try_cast("double").alias("v")).where("v is not null and not isnan(v)")
    return values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), *[F.count(F.when((F.col("v") >= a) & (F.col("v") < b), 1)).alias(f"bin_{i}") for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def compare_samples(left: DataFrame, right: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """Samples of two runs: both, left_only or right_only, and differences where both have values."""
    a = left.select(F.col(key), *[F.col(m).alias(f"left_{m}") for m in metrics], F.lit(True).alias("__l"))
    b = right.select(F.col(key), *[F.col(m).alias(f"right_{m}") for m in metrics], F.lit(True).alias("__r"))
    status = F.when(F.col("__l") & F.col("__r"), "both").when(F.col("__l"), "left_only").otherwise("right_only")
    joined = a.join(b, key, "full_outer").withColumn("status", status)
    return joined.withColumns({f"delta_{m}": F.when(F.col("status") == "both", F.col(f"right_{m}") - F.col(f"left_{m}")) for m in metrics}).drop("__l", "__r")


def reciprocal_overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """The smaller of the two covered shares; 0 without overlap."""
    o = F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))
    return F.least(o / (a_end - a_start), o / (b_end - b_start))


def greedy_match(left: DataFrame, right: DataFrame, keys: list[str], order: str, least: float = 0.5) -> DataFrame:
    """One-to-one matches by reciprocal overlap.

    Left calls in order each take the free right call with the largest overlap among those
    with both shares of at least ``least``, the first in order on ties. Candidate pairs
    come from a binned overlap join; only calls that compete for each other meet in one
    group (a key). Unmatched calls are left_only or right_only. Intervals are half-open.
    """
    from strandline.operators.intervals import bin_width, overlap_join

    cols = [*keys, order, "start", "end"]
    pairs = overlap_join(left.select(*cols), right.select(*cols), keys, bin_width(left))
    o = F.least("end", "r_end") - F.greatest("start", "r_start")
    share = reciprocal_overlap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end"))
    candidates = pairs.withColumn("overlap", o).where(share >= least).select(*keys, F.col(order).alias("l"), F.col(f"r_{order}").alias("r"), "overlap")
    kinds = {f.name: f.dataType for f in left.schema.fields}
    schema = T.StructType([*[T.StructField(k, kinds[k]) for k in keys], T.StructField("l", kinds[order]), T.StructField("r", kinds[order]), T.StructField("overlap", T.LongType())])

    n = len(keys)

    def pick(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, current, done, taken = None, None, False, set()
        for pdf in it:
            rows = []
            for row in pdf.itertuples(index=False, name=None):
                if row[:n] != key:
                    key, current, taken = row[:n], None, set()
                if row[n] != current:
                    current, done = row[n], False
                if not done and row[n + 1] not in taken:
                    taken.add(row[n + 1])
                    done = True
                    rows.append(row)
            yield pd.DataFrame(rows, columns=pdf.columns)

    # one ordered pass a partition; only the taken calls of one key are held
    ordered = candidates.withColumn("overlap", F.col("overlap").cast("bigint")).repartition(*keys).sortWithinPartitions(*keys, "l", F.desc("overlap"), "r")
    matched = ordered.mapInPandas(pick, schema)
    a = left.select(*keys, F.col(order).alias("l")).join(matched, [*keys, "l"], "left")
    status = F.when(F.col("r").isNotNull(), "both").otherwise("left_only")
    alone = right.select(*keys, F.col(order).alias("r")).join(matched.select(*keys, "r"), [*keys, "r"], "left_anti")
    return a.withColumn("status", status).unionByName(alone.withColumn("status", F.lit("right_only")), allowMissingColumns=True)


def call_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Shared keys, left only and right only."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return (
        a.intersect(b).withColumn("where", F.lit("both"))
        .unionByName(a.exceptAll(b).withColumn("where", F.lit("left_only"))).unionByName(b.exceptAll(a).withColumn("where", F.lit("right_only")))
    )


def qc_flags(samples: DataFrame, cohort: str = "cohort", sample: str = "sample", value: str = "calls", tiny: int = 10) -> DataFrame:
    """Outlying burdens, samples of tiny cohorts and unassigned samples."""
    from strandline.operators.stats import outlier_flags

    flags = outlier_flags(samples.where(F.col(cohort).isNotNull()), [cohort], sample, value).select(cohort, sample, F.concat(F.lit("BURDEN_"), "flag").alias("flag"))
    small = samples.where(F.col(cohort).isNotNull()).groupBy(cohort).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < tiny)
    few = samples.join(small, cohort).select(cohort, sample, F.lit("TINY_COHORT").alias("flag"))
    lost = samples.where(F.col(cohort).isNull()).select(cohort, sample, F.lit("UNASSIGNED").alias("flag"))
    return flags.unionByName(few).unionByName(lost)

