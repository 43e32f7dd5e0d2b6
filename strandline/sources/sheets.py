"""Sample sheets and their side files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.fields import protocol, with_prefix
from strandline.sources.lines import lines

COLUMNS = ("study", "sample", "file_type", "sample_type", "capture_kit", "sex", "filenames1", "filenames2", "options")
# What a sheet may hold, and the sizes assumed without one (GB).
FILE_TYPES = ("fastq_paired", "fastq_interleaved", "bam", "cram", "sra_paired", "sra_single", "gvcf")
SAMPLE_TYPES = ("illumina_exome", "illumina_wgs", "illumina_wgs_pcr_free")
SEXES = ("F", "M", "U")
SIZES = {"exome": 8.0, "wgs": 75.0}


def read_sheets(spark: SparkSession, path: str | list[str], prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """(samples, issues). Rows of 7, 8 or 9 tab-separated columns; lists by comma, the last column k=v pairs."""
    p = F.split("text", "\t")
    n = F.size(p)
    base = lines(spark, path).where(F.trim("text") != "").withColumn("n", n)
    get = lambda i: F.trim(F.get(p, F.lit(i)))
    files = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.transform(F.split(c, ","), lambda x: with_prefix(F.trim(x), prefix) if prefix else F.trim(x)))
    rows = base.select(
        "file", "line", "n", *[get(i).alias(c) for i, c in enumerate(COLUMNS[:6])], files(get(6)).alias("files1"), files(F.when(F.col("n") > 7, get(7))).alias("files2"),
        F.str_to_map(F.when((F.col("n") > 8) & (get(8) != ""), get(8)), F.lit(","), F.lit("=")).alias("options"),
    )
    rules = {
        "columns": ~F.col("n").isin(7, 8, 9), "file_type": ~F.coalesce(F.col("file_type").isin(*FILE_TYPES), F.lit(False)), "sample_type": ~F.coalesce(F.col("sample_type").isin(*SAMPLE_TYPES), F.lit(False)),
        "sex": ~F.coalesce(F.col("sex").isin(*SEXES), F.lit(False)), "files": F.col("files1").isNull(),
        "pairs": (F.col("file_type") == "fastq_paired") & (F.size(F.coalesce("files1", F.array())) != F.size(F.coalesce("files2", F.array()))),
        "protocols": F.size(F.array_distinct(F.transform(F.coalesce("files1", F.array().cast("array<string>")), lambda x: protocol(x)))) > 1,
    }
    issues = F.filter(F.array(*[F.when(F.coalesce(cond, F.lit(True)), F.lit(k)) for k, cond in rules.items()]), lambda x: x.isNotNull())
    checked = rows.withColumn("issues", issues)
    assumed = F.when(F.col("sample_type").contains("exome"), SIZES["exome"]).otherwise(SIZES["wgs"]) * F.when(F.col("file_type") == "cram", 0.5).otherwise(1.0)
    size = F.coalesce(F.col("options")["filesize"].try_cast("double"), assumed)
    samples = checked.where(F.size("issues") == 0).withColumn("filesize", size).drop("n", "issues")
    return samples, checked.where(F.size("issues") > 0).select("file", "line", "sample", F.explode("issues").alias("issue"))


def find_sheets(spark: SparkSession, path: str) -> DataFrame:
    """Files whose first line has 7 to 9 columns."""
    return lines(spark, path).where("line = 1").where(F.size(F.split("text", "\t")).between(7, 9)).select("file")


def side_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, reason of an exclusion list; # starts a comment."""
    p = F.split("text", "\t", 2)
    return lines(spark, path).where(~F.col("text").startswith("#") & (F.trim("text") != "")).select(F.trim(p[0]).alias("sample"), F.coalesce(F.trim(F.get(p, F.lit(1))), F.lit("")).alias("reason"))


def single_value(spark: SparkSession, path: str) -> DataFrame:
    """The one line of a .source or .target file."""
    return lines(spark, path).where("line = 1").select("file", F.trim("text").alias("value"))


def latest(samples: DataFrame) -> DataFrame:
    """A sample of several sheets or lines: the last one counts (Q23)."""
    from strandline.operators.samples import last_by

    return last_by(samples, ["sample"], F.col("file"), F.col("line"))
