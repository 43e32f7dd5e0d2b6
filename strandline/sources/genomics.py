"""SAM, FASTQ, VCF, BED and read-group headers as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions.fields import info_map, real, sample_fields, whole
from strandline.sources.lines import lines

SAM = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")


def _tags(items: Column) -> Column:
    """TAG:T:VALUE items as a map, the last of a repeated tag."""
    named = F.filter(items, lambda x: x.rlike("^[A-Za-z][A-Za-z0-9]:[A-Za-z]:"))
    pairs = F.transform(named, lambda x, i: F.struct(F.substring(x, 1, 2).alias("k"), F.regexp_replace(x, "^[^:]*:[^:]*:", "").alias("v"), i.alias("i")))
    last = F.filter(pairs, lambda p: ~F.exists(pairs, lambda q: (q["k"] == p["k"]) & (q["i"] > p["i"])))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"], p["v"])))


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignment records; tags keep their text, ``flag`` and positions are numbers."""
    p = F.split("value", "\t")
    text = spark.read.text(path).where(~F.col("value").startswith("@") & (F.size(p) >= 11))
    numbers = {"flag": "int", "pos": "bigint", "mapq": "int", "pnext": "bigint", "tlen": "bigint"}
    return text.select(*[p[i].cast(numbers[c]).alias(c) if c in numbers else p[i].alias(c) for i, c in enumerate(SAM)], _tags(F.slice(p, F.lit(12), F.greatest(F.size(p) - 11, F.lit(0)))).alias("tags"))


def sam_text(df: DataFrame) -> DataFrame:
    """Records as SAM lines (K07); numeric tags are written as integers, others as text."""
    kind = lambda v: F.when(v.rlike("^-?[0-9]+$"), F.lit("i")).when(v.rlike(r"^-?[0-9]*\.[0-9]+$"), F.lit("f")).otherwise(F.lit("Z"))
    tags = F.transform(F.map_entries(F.coalesce("tags", F.create_map().cast("map<string,string>"))), lambda e: F.concat_ws(":", e["key"], kind(e["value"]), e["value"]))
    return df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in SAM], tags).alias("value"))


def fastq_text(df: DataFrame) -> DataFrame:
    """qname, seq, qual as FASTQ records."""
    return df.select(F.concat(F.lit("@"), F.col("qname"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual")).alias("value"))


def read_groups(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file and the fields of each @RG header line as a map."""
    items = F.filter(F.split("text", "\t"), lambda x: x.contains(":"))
    pairs = F.transform(items, lambda x: F.struct(F.split(x, ":", 2)[0].alias("k"), F.split(x, ":", 2)[1].alias("v")))
    return lines(spark, path).where(F.col("text").startswith("@RG\t")).select("file", F.map_from_entries(pairs).alias("info"))


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, record, name, seq, qual of four-line records.

    A file is the unit, as records can't be found from the middle of a stream; a file whose
    line count isn't a multiple of four has a last row with a null sequence.
    """
    text = lines(spark, path)
    record = F.floor((F.col("line") - 1) / 4)
    at = lambda k: F.max(F.when((F.col("line") - 1) % 4 == k, F.col("text")))
    rows = text.groupBy("file", record.alias("record")).agg(at(0).alias("name"), at(1).alias("seq"), at(3).alias("qual"), F.count(F.lit(1)).alias("n"))
    whole_ = F.col("n") == 4
    return rows.select("file", "record", F.regexp_replace("name", "^@", "").alias("name"), F.when(whole_, F.col("seq")).alias("seq"), F.when(whole_, F.col("qual")).alias("qual"))


def header_fields(name: Column) -> Column:
    """struct<instrument,run,flowcell,lane,index,pair> of a FASTQ header: Casava 1.8, '#' and '/' styles; pair 3 counts as 2."""
    head, tail = F.split(name, " ", 2)[0], F.try_element_at(F.split(name, " ", 2), F.lit(2))
    p, q = F.split(head, ":"), F.split(tail, ":")
    pair = lambda x: F.when(x == "3", "2").otherwise(x)
    casava = tail.isNotNull() & tail.rlike("^[123](:|$)")
    hashed = head.rlike("#.*/[123]$")
    n = F.size(p)
    new = F.struct(
        F.regexp_replace(p[0], "^@", "").alias("instrument"), F.when(n >= 7, F.get(p, F.lit(1))).alias("run"), F.when(n >= 7, F.get(p, F.lit(2))).when(n == 6, F.get(p, F.lit(1))).alias("flowcell"),
        F.when(n >= 7, F.get(p, F.lit(3))).when(n == 6, F.get(p, F.lit(2))).alias("lane"), F.when(F.size(q) >= 4, F.get(q, F.lit(3))).alias("index"), pair(q[0]).alias("pair"),
    )
    old = F.struct(
        F.regexp_replace(p[0], "^@", "").alias("instrument"), F.lit(None).cast("string").alias("run"), F.lit(None).cast("string").alias("flowcell"), F.get(p, F.lit(1)).alias("lane"),
        F.when(hashed, F.regexp_extract(head, "#([^/]*)/", 1)).alias("index"), pair(F.nullif(F.regexp_extract(head, "/([123])$", 1), F.lit(""))).alias("pair"),
    )
    return F.when(casava, new).otherwise(old)


def fastq_layout(spark: SparkSession, path: str, first: int = 4000) -> DataFrame:
    """Records of 2 or 4 lines and the base of the quality codes, from a file's first lines."""
    text = lines(spark, path).where(F.col("line") <= first)
    four = F.max(F.when((F.col("line") == 3) & F.col("text").startswith("+"), 4).otherwise(2))
    codes = text.join(text.groupBy("file").agg(four.alias("lines")), "file").where((F.col("line") - 1) % F.col("lines") == F.col("lines") - 1)
    values = codes.select("file", "lines", F.explode(F.split("text", "")).alias("c")).where("c <> ''").select("file", "lines", F.ascii("c").alias("v"))
    out = values.groupBy("file", "lines").agg(F.min("v").alias("least"), F.max("v").alias("most"))
    return out.withColumn("base", F.when((F.col("least") >= 64) & (F.col("most") > 74), 64).otherwise(33))


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file and the fixed columns with INFO as a map and the samples' columns as an array of maps."""
    p = F.split("value", "\t")
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(~F.col("value").startswith("#") & (F.size(p) >= 8))
    values = F.slice(p, F.lit(10), F.greatest(F.size(p) - 9, F.lit(0)))
    return text.select(
        "file", p[0].alias("chrom"), whole(p[1]).alias("pos"), p[2].alias("id"), p[3].alias("ref"), F.filter(F.split(p[4], ","), lambda a: a != ".").alias("alts"), real(p[5]).alias("qual"), p[6].alias("filter"),
        info_map(p[7]).alias("info"), F.when(F.size(p) > 9, F.transform(values, lambda v: sample_fields(F.get(p, F.lit(8)), v))).alias("samples"),
    )


def vcf_samples(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, samples of the header."""
    p = F.split("text", "\t")
    return lines(spark, path).where(F.col("text").startswith("#CHROM")).select("file", F.slice(p, F.lit(10), F.greatest(F.size(p) - 9, F.lit(0))).alias("samples"))


def contig_lengths(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """contig, length from the headers of the first file (by name) that has any."""
    rows = lines(spark, path).where(F.col("text").startswith("##contig=")).select(
        "file", F.regexp_extract("text", "ID=([^,>]+)", 1).alias("contig"), F.regexp_extract("text", "length=([0-9]+)", 1).try_cast("bigint").alias("length")
    ).where("length is not null")
    first = rows.agg(F.min("file").alias("file"))
    return rows.join(F.broadcast(first), "file", "left_semi").select("contig", "length")  # one row


def segment_calls(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Copy-number segments with cohort and sample from the file name, half-open."""
    from strandline.functions.fields import event_type

    v = read_vcf(spark, path)
    s = F.get("samples", F.lit(0))
    name = r"COHORT_(.+?)_SAMPLE_(.+?)(?:_[0-9]+)?\.vcf"
    rows = v.select(
        F.regexp_extract("file", name, 1).alias("cohort"), F.regexp_extract("file", name, 2).alias("sample"), F.col("chrom").alias("contig"), (F.col("pos") - 1).alias("start"),
        F.coalesce(whole(F.col("info")["END"]), F.col("pos")).alias("end"), F.array_join("alts", ",").alias("alt"), "filter", "info",
        s["CN"].alias("copies"), whole(s["NP"]).alias("np"), whole(s["QS"]).alias("qs"), whole(s["QA"]).alias("qa"), whole(s["QSS"]).alias("qss"), whole(s["QSE"]).alias("qse"),
    )
    return rows.withColumn("svtype", event_type("alt", "copies", "info")).withColumn("af", F.col("info")["AF_Orig"]).drop("info")


def interval_copies(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Copy number, quality and likelihoods of every interval."""
    from strandline.functions.fields import real_list

    s = F.get("samples", F.lit(0))
    return read_vcf(spark, path).select("file", F.col("chrom").alias("contig"), (F.col("pos") - 1).alias("start"), whole(s["CN"]).alias("copies"), real(s["CNQ"]).alias("cnq"), real_list(s["CNLP"]).alias("cnlp"))


def copy_ratios(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Denoised copy ratios, half-open."""
    rows = spark.read.csv(path, sep="\t", header=True, comment="@").select("*", F.col("_metadata.file_path").alias("file"))
    return rows.select("file", F.col("CONTIG").alias("contig"), (whole("START") - 1).alias("start"), whole("END").alias("end"), F.col("LINEAR_COPY_RATIO").try_cast("double").alias("ratio"))


def read_bed(spark: SparkSession, path: str | list[str], names: tuple[str, ...] = ("name",)) -> DataFrame:
    """chrom, start, end and further columns; malformed rows go, a missing name is chrom:start-end."""
    p = F.split("text", "\t")
    rows = lines(spark, path).where(~F.col("text").rlike("^(#|track|browser)") & (F.size(p) >= 3))
    out = rows.select("file", "line", p[0].alias("chrom"), whole(p[1]).alias("start"), whole(p[2]).alias("end"), *[F.nullif(F.trim(F.get(p, F.lit(3 + i))), F.lit("")).alias(n) for i, n in enumerate(names)])
    out = out.where("start >= 0 and end > start")
    return out.withColumn("name", F.coalesce("name", F.concat("chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string")))) if "name" in names else out


def cohort_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, cohort, samplefile: the first assignment by file and line."""
    text = lines(spark, path)
    head = text.where("line = 1").select("file", F.split("text", "\t").alias("h"))
    v = F.split("text", "\t")
    at = lambda n: F.when(F.array_position("h", F.lit(n)) > 0, F.get(v, F.array_position("h", F.lit(n)).cast("int") - 1))
    rows = text.where("line > 1").join(head, "file").select("file", "line", at("sample").alias("sample"), at("cohort").alias("cohort"), at("samplefile").alias("samplefile")).where("sample is not null")
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy("sample").orderBy("file", "line"))).where("__r = 1").select("sample", "cohort", "samplefile")


def sex_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, sex."""
    return spark.read.csv(path, sep="\t", header=True).select("sample", F.upper(F.substring(F.trim("sex"), 1, 1)).alias("sex"))


def listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A storage listing in JSON as rows."""
    from strandline.functions.fields import epoch_time

    schema = "children array<struct<fileName:string,fileType:string,size:bigint,mtime:bigint,creationTime:bigint,checksums:array<struct<type:string,value:string>>,labels:array<string>>>"
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("j")).select(F.explode("j.children").alias("c"))
    return rows.select(F.col("c.fileName").alias("name"), F.col("c.fileType").alias("kind"), "c.size", epoch_time(F.col("c.mtime")).alias("modified"), "c.checksums", "c.labels").orderBy("name")

