"""Tool reports as DataFrames: a registry of section parsers and the composed readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions.fields import clean_identifier, real, whole
from strandline.operators.qc import pivot_metrics, safe_ratio
from strandline.sources.lines import header_row, key_values, lines, sample_of, tagged

SECTIONS: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {}


def section(report: str, name: str):
    """Register a parser lines -> DataFrame of one section of a kind of report."""

    def add(f: Callable[[DataFrame], DataFrame]):
        SECTIONS.setdefault(report, {})[name] = f
        return f

    return add


def read_sections(spark: SparkSession, report: str, path: str | list[str]) -> dict[str, DataFrame]:
    """Every registered section of the reports at ``path``."""
    text = lines(spark, path)
    return {name: f(text) for name, f in SECTIONS[report].items()}


# Variant statistics (S23). Columns after the tag and the set id.
_VARIANTS = {
    "SN": ["id", "key", "value"], "TSTV": ["id", "ts", "tv", "tstv", "ts_first", "tv_first", "tstv_first"], "ICS": ["id", "rc", "rn", "ri", "ratio"], "ICL": ["id", "length", "n", "genotypes", "repeat"],
    "SIS": ["id", "n", "snps", "ts", "tv", "indels"], "AF": ["id", "frequency", "snps", "ts", "tv", "indels", "repeat_c", "repeat_i", "na"], "QUAL": ["id", "quality", "snps", "ts", "tv", "indels"],
    "ST": ["id", "kind", "n"], "IDD": ["id", "length", "n", "genotypes", "mean_vaf"],
}


def _variant_section(tag: str, names: list[str]):
    def parse(text: DataFrame) -> DataFrame:
        rows = tagged(text, "SiS" if tag == "SIS" else tag, names)
        typed = [c for c in names if c not in ("id", "key", "kind")]
        return rows.withColumns({c: real(c) for c in typed})

    return parse


for _tag, _names in _VARIANTS.items():
    section("variants", _tag)(_variant_section(_tag, _names))

# Alignment statistics.
for _tag, _names in {
    "SN": ["key", "value"], "MPC": ["cycle", "mismatches"], "GCF": ["gc", "n"], "GCL": ["gc", "n"], "IS": ["size", "pairs", "inward", "outward", "other"], "RL": ["length", "n"],
    "ID": ["length", "insertions", "deletions"], "IC": ["cycle", "ins_first", "ins_last", "del_first", "del_last"], "COV": ["range", "depth", "n"], "GCD": ["gc", "unique", "p10", "p25", "p50", "p75", "p90"],
    "GCC": ["cycle", "a", "c", "g", "t", "n", "o"],
}.items():
    section("alignments", _tag)(lambda text, tag=_tag, names=_names: tagged(text, tag, names).withColumns({c: real(c) for c in names if c not in ("key", "range")}) if tag != "SN" else tagged(text, tag, names).withColumn("key", F.regexp_replace("key", ":$", "")).withColumn("value", real("value")))


def _cycle_quality(tag: str):
    def parse(text: DataFrame) -> DataFrame:
        parts = F.split("text", "\t")
        rows = text.where(parts[0] == tag).select("file", parts[1].cast("int").alias("cycle"), F.slice(parts, F.lit(3), F.size(parts)).alias("v"))
        return rows.select("file", "cycle", F.posexplode("v").alias("quality", "n")).withColumn("n", real("n"))

    return parse


for _tag in ("FFQ", "LFQ"):
    section("alignments", _tag)(_cycle_quality(_tag))


#: Kinds of summary lines that a table may have as columns.
METRICS = 500


def alignment_metrics(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row a file: the summary numbers plus mean qualities, GC, indel lengths and covered share."""
    from strandline.operators.stats import weighted_mean

    s = read_sections(spark, "alignments", path)
    numbers = s["SN"].withColumn("metric", clean_identifier("key"))
    names = [r[0] for r in numbers.select("metric").distinct().orderBy("metric").limit(METRICS + 1).collect()]  # a fixed set of report lines
    if len(names) > METRICS:
        raise ValueError(f"more than {METRICS} kinds of summary lines; these are not reports of one tool")
    out = pivot_metrics(numbers, ["file"], names)
    quality = lambda t, n: s[t].groupBy("file").agg(weighted_mean(F.col("quality"), F.col("n")).alias(n))
    gc = lambda t, n: s[t].groupBy("file").agg(weighted_mean(F.col("gc"), F.col("n")).alias(n))
    indels = s["ID"].groupBy("file").agg(weighted_mean(F.col("length"), F.col("insertions")).alias("mean_insertion"), weighted_mean(F.col("length"), F.col("deletions")).alias("mean_deletion"))
    covered = s["COV"].groupBy("file").agg((F.sum(F.when(F.col("depth") >= 10, F.col("n")).otherwise(0.0)) / F.greatest(F.sum("n"), F.lit(1e-6))).alias("covered_10"))
    for t in (quality("FFQ", "quality_first"), quality("LFQ", "quality_last"), gc("GCF", "gc_first"), gc("GCL", "gc_last"), indels, covered):
        out = out.join(t, "file", "left")
    return out


def contamination(spark: SparkSession, path: str | list[str], least: float = 0.01) -> DataFrame:
    """The seventh column of the second line; under ``least`` it counts as none."""
    v = real(F.get(F.split("text", "\t"), F.lit(6)))
    return lines(spark, path).where("line = 2").select("file", v.alias("contamination")).withColumn("used", F.when(F.col("contamination") < least, 0.0).otherwise(F.col("contamination")))


def capture_metrics(spark: SparkSession, path: str | list[str], names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(header row by name, histogram) of hybrid-capture metrics."""
    text = lines(spark, path)
    parts = F.split("text", "\t")
    at = text.where(F.col("text").startswith("## HISTOGRAM")).groupBy("file").agg(F.min("line").alias("at"))
    histogram = text.join(at, "file").where(F.col("line") > F.col("at") + 1).where(F.trim("text") != "").select("file", real(parts[0]).alias("coverage"), real(F.get(parts, F.lit(1))).alias("n"))
    return header_row(text, "BAIT_SET", names), histogram.where("coverage is not null")


def adapter_removal(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trimming statistics with ratios to the pairs; no pair gives 0."""
    text = lines(spark, path)
    after = text.where(F.col("text").contains("Trimming statistics")).groupBy("file").agg(F.min("line").alias("at"))
    rows = key_values(text.join(after, "file").where("line > at").drop("at"), ":").withColumn("metric", clean_identifier("metric")).withColumn("value", real("value"))
    names = ["total_number_of_read_pairs", "number_of_unaligned_read_pairs", "number_of_well_aligned_read_pairs", "number_of_reads_with_adapters_1", "number_of_retained_reads", "number_of_retained_nucleotides"]
    out = pivot_metrics(rows, ["file"], names)
    pairs = F.col("total_number_of_read_pairs")
    return out.withColumns({"aligned_ratio": safe_ratio(F.col("number_of_well_aligned_read_pairs"), pairs), "adapter_ratio": safe_ratio(F.col("number_of_reads_with_adapters_1"), pairs), "retained_ratio": safe_ratio(F.col("number_of_retained_reads"), 2 * pairs)})


def fixed_lines(spark: SparkSession, path: str | list[str], places: dict[str, tuple[int, int]]) -> DataFrame:
    """Values at fixed lines and offsets of a log (S15): name -> (line, first character from 1)."""
    return lines(spark, path).groupBy("file").agg(*[F.max(F.when(F.col("line") == n, F.trim(F.expr(f"substring(text, {at})")))).alias(k) for k, (n, at) in places.items()])


def count_stats(spark: SparkSession, path: str | list[str], names: list[str], ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """Counters of merge and dechimer logs with guarded ratios."""
    rows = key_values(lines(spark, path), "\t", until_blank=True).withColumn("metric", clean_identifier("metric")).withColumn("value", real("value"))
    out = pivot_metrics(rows, ["file"], names).na.fill(0.0)
    return out.withColumns({k: safe_ratio(F.col(a), F.col(b)) for k, (a, b) in ratios.items()})


def mapper_log(spark: SparkSession, path: str | list[str], metrics: list[str]) -> DataFrame:
    """Values and ratios of an aligner's log by read group, with mean and difference of the mates."""
    parts = F.split("text", ",")
    rows = lines(spark, path).where(F.col("text").contains("MAPPING")).select(
        "file", F.trim(F.get(parts, F.lit(1))).alias("group"), clean_identifier(F.get(parts, F.lit(2))).alias("metric"), real(F.get(parts, F.lit(3))).alias("value"), real(F.get(parts, F.lit(4))).alias("ratio")
    )
    agg = []
    for m in metrics:
        own = F.col("metric") == m
        agg += [F.max(F.when(own, F.col("value"))).alias(m), F.max(F.when(own, F.col("ratio"))).alias(f"{m}_ratio")]
    out = rows.groupBy("file", "group").agg(*agg)
    for m in metrics:
        if m.endswith("_r1") and m[:-1] + "2" in metrics:
            base, a, b = m[:-3], F.col(m), F.col(m[:-1] + "2")
            out = out.withColumns({f"{base}_mean": (a + b) / 2, f"{base}_difference": a - b})
    return out


def two_lines(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """A header line (a leading # goes) and one line of values."""
    return header_row(lines(spark, path).withColumn("text", F.regexp_replace("text", "^#", "")), names[0], names)


def region_metrics(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, metric, value (double), whole (bigint) of metric files."""
    return key_values(lines(spark, path)).select("file", clean_identifier("metric").alias("metric"), real("value").alias("value"), whole("value").alias("whole"))


def taxonomy(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Classification reports with 6 or more columns; depth is the indent."""
    parts = F.split("text", "\t")
    name = F.try_element_at(parts, F.lit(-1))
    return lines(spark, path).where(F.size(parts) >= 6).select(
        "file", "line", sample_of(F.col("file")).alias("sample"), real(parts[0]).alias("share"), whole(parts[1]).alias("clade"), whole(parts[2]).alias("own"),
        F.trim(F.try_element_at(parts, F.lit(-3))).alias("rank"), whole(F.try_element_at(parts, F.lit(-2))).alias("taxid"), F.trim(name).alias("name"),
        ((F.length(name) - F.length(F.ltrim(name))) / 2).cast("int").alias("depth"),
    )


def species_shares(spark: SparkSession, path: str | list[str], least: float) -> DataFrame:
    """Species with at least a share of all reads."""
    rows = spark.read.csv(path, sep="\t", header=True)
    return rows.select("name", F.col("taxonomy_lvl"), real("fraction_total_reads").alias("share")).where((F.col("taxonomy_lvl") == "S") & (F.col("share") >= least))


def phasing_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, chrom, block (null outside of a block list), metric, value of phasing statistics."""
    text = lines(spark, path)
    chrom = F.when(F.col("text").rlike(r"^-+ *Chromosome"), F.regexp_extract("text", r"Chromosome ([^ -]+)", 1))
    part = F.when(F.col("text").rlike(r"^-+ *Chromosome"), F.lit("")).when(F.col("text").rlike(r"^ *(Block|Variants|Bases)[^:]*:? *$"), F.trim(F.regexp_replace("text", ":", "")))
    w = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    filled = text.withColumn("chrom", F.last(chrom, ignorenulls=True).over(w)).withColumn("part", F.last(part, ignorenulls=True).over(w))
    kv = F.split("text", ":", 2)
    return filled.where(F.col("chrom").isNotNull() & (F.size(kv) == 2)).select(
        "file", "chrom", F.nullif(F.col("part"), F.lit("")).alias("part"), clean_identifier(kv[0]).alias("metric"), real(F.regexp_extract(kv[1], r"(-?[0-9.]+)", 1)).alias("value")
    ).where("value is not null")


def artifacts(spark: SparkSession, path: str | list[str], detail: bool = False) -> DataFrame:
    """Substitution artifacts: summary rows, or detail rows of 11 or 13 columns."""
    parts = F.split("text", "\t")
    base = lines(spark, path).where(F.size(parts) >= (11 if detail else 5)).where(parts[2].rlike("^[ACGT]$") & parts[3].rlike("^[ACGT]$"))
    if not detail:
        return base.select("file", parts[2].alias("ref"), parts[3].alias("alt"), real(parts[4]).alias("q")).where("q is not null")
    counts = ("pro_ref", "pro_alt", "con_ref", "con_alt")
    return base.select("file", parts[2].alias("ref"), parts[3].alias("alt"), parts[4].alias("context"), *[whole(parts[5 + i]).alias(c) for i, c in enumerate(counts)])
