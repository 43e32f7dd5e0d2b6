"""Scans and sinks: each query writes files made from the driver's tables and reads them with the engine's readers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.plans.registry import Tables, query
from strandline.plans.scalar_queries import _qty
from strandline.sources import genomics, lines, reports, sinks


def _folder(t: Tables, name: str) -> str:
    """A new folder that driver and executors share; a local one only where the session names none."""
    root = t.spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="strandline-")
    return f"{root.rstrip('/')}/strandline/{name}-{uuid.uuid4().hex}"


def _files(t: Tables, name: str, rows: DataFrame, key: str | None = None, order: str = "line") -> str:
    """Text files of the column ``value``, in ``order``; one a ``key``, or one in all where there is none (a report)."""
    path = _folder(t, name)
    if key is None:
        rows.coalesce(1).sortWithinPartitions(order).select("value").write.text(path)
    else:
        rows.repartition(key).sortWithinPartitions(key, order).select(F.col(key), "value").write.partitionBy(key).text(path)
    return path


def _joined(*columns: Column | str) -> Column:
    return F.concat_ws("\t", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])


def _nation(file: str = "file") -> Column:
    return F.regexp_extract(file, "/s_nationkey=([0-9]+)/", 1).cast("bigint")


def _by_line(*lines_: tuple[Column, Column]) -> Column:
    """(number, text) pairs as an array to explode."""
    return F.explode(F.array(*[F.struct(n.alias("line"), v.alias("value")) for n, v in lines_]))


@query(
    "S07_sam",
    "select 'r' || l_orderkey as qname, cast(l_linenumber * 16 as int) as flag, 'chr' || l_linenumber as rname, l_partkey as pos, cast(cast(l_quantity as bigint) as varchar) as score, case when l_linenumber > 4 then 'x:y' end as note from lineitem",
)
def sam(t: Tables) -> DataFrame:
    """Records as SAM lines (K07) and back."""
    n = F.col("l_linenumber")
    tags = F.when(n > 4, F.create_map(F.lit("AS"), _qty().cast("string"), F.lit("CO"), F.lit("x:y"))).otherwise(F.create_map(F.lit("AS"), _qty().cast("string")))
    rows = t.lineitem.select(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("qname"), (n * 16).cast("int").alias("flag"), F.concat(F.lit("chr"), n.cast("string")).alias("rname"), F.col("l_partkey").alias("pos"),
        F.lit(60).alias("mapq"), F.lit("4M").alias("cigar"), F.lit("=").alias("rnext"), F.lit(0).alias("pnext"), F.lit(0).alias("tlen"), F.lit("ACGT").alias("seq"), F.lit("IIII").alias("qual"), tags.alias("tags"),
    )
    path = _folder(t, "sam")
    genomics.sam_text(rows).write.text(path)
    return genomics.read_sam(t.spark, path).select("qname", "flag", "rname", "pos", F.col("tags")["AS"].alias("score"), F.col("tags")["CO"].alias("note"))


@query("S08_fastq", "select 'p' || p_partkey as name, 'ACGT' || p_size as seq, 'IIII' || p_size as qual from part")
def fastq(t: Tables) -> DataFrame:
    """Reads as FASTQ records (K07) and back."""
    size = F.col("p_size").cast("string")
    rows = t.part.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("qname"), F.concat(F.lit("ACGT"), size).alias("seq"), F.concat(F.lit("IIII"), size).alias("qual"))
    path = _folder(t, "fastq")
    genomics.fastq_text(rows).write.text(path)
    return genomics.read_fastq(t.spark, path).select("name", "seq", "qual")


@query("S05_read_groups", "select s_nationkey, 'rg' || s_suppkey as id, s_name as sample from supplier")
def read_groups(t: Tables) -> DataFrame:
    value = F.concat(F.lit("@RG\tID:rg"), F.col("s_suppkey").cast("string"), F.lit("\tSM:"), F.col("s_name"), F.lit("\tPL:x:y"))
    path = _files(t, "headers", t.supplier.select("s_nationkey", value.alias("value"), F.col("s_suppkey").alias("line")), "s_nationkey")
    return genomics.read_groups(t.spark, path).select(_nation().alias("s_nationkey"), F.col("info")["ID"].alias("id"), F.col("info")["SM"].alias("sample"))


def _key() -> Column:
    return F.col("s_suppkey").cast("bigint")


def _report(t: Tables, name: str, *numbered: tuple[Column, Column]) -> str:
    """One file a nation, with the given lines for each of its suppliers; the numbers order them."""
    rows = t.supplier.select("s_nationkey", _by_line(*numbered).alias("x")).select("s_nationkey", "x.line", "x.value")
    return _files(t, name, rows, "s_nationkey")




@query(
    "S10_alignment_summary",
    "select s_nationkey, 'raw_total_sequences_' || s_suppkey as metric, cast(s_suppkey * 3 as double) as value from supplier union all select s_nationkey, 'reads_mapped_' || s_suppkey, s_suppkey + 0.5 from supplier",
)
def alignment_summary(t: Tables) -> DataFrame:
    k = _key().cast("string")
    path = _report(
        t, "stats", (_key() * 3, F.lit("# a comment")), (_key() * 3 + 1, F.concat(F.lit("SN\traw total sequences "), k, F.lit(":\t"), (_key() * 3).cast("string"), F.lit("\t# all"))),
        (_key() * 3 + 2, F.concat(F.lit("SN\treads mapped "), k, F.lit(":\t"), k, F.lit(".5"))),
    )
    from strandline.functions.fields import clean_identifier

    return reports.read_sections(t.spark, "alignments", path)["SN"].select(_nation().alias("s_nationkey"), clean_identifier("key").alias("metric"), "value")


@query(
    "S11_alignment_metrics",
    """select s_nationkey, round(sum(s_suppkey % 50 * (1 + s_suppkey % 7)) / sum(1 + s_suppkey % 7), 9) as gc_first, round(sum((1 + s_suppkey % 9) * (s_suppkey % 4 + 1)) / sum(s_suppkey % 4 + 1), 9) as mean_insertion,
        round(coalesce(sum(case when s_suppkey % 30 >= 10 then s_suppkey end), 0) / greatest(sum(s_suppkey), 1e-6), 9) as covered_10 from supplier group by 1""",
)
def alignment_metrics(t: Tables) -> DataFrame:
    """Weighted means of the sections of alignment statistics (A10)."""
    path = _report(
        t, "stats", (_key() * 4, F.lit("SN\tsequences:\t7")), (_key() * 4 + 1, _joined(F.lit("GCF"), _key() % 50, 1 + _key() % 7)), (_key() * 4 + 2, _joined(F.lit("ID"), 1 + _key() % 9, _key() % 4 + 1, F.lit(0))),
        (_key() * 4 + 3, _joined(F.lit("COV"), F.lit("[x]"), _key() % 30, _key())),
    )
    out = reports.alignment_metrics(t.spark, path)
    return out.select(_nation().alias("s_nationkey"), *[F.round(c, 9).alias(c) for c in ("gc_first", "mean_insertion", "covered_10")])


@query(
    "S23_variant_stats",
    "select s_nationkey, 'ST' as section, 'A>C' as kind, s_suppkey::double as n from supplier union all select s_nationkey, 'IDD', cast(s_suppkey % 11 - 5 as varchar), s_suppkey * 2.0 from supplier",
)
def variant_stats(t: Tables) -> DataFrame:
    path = _report(t, "variants", (_key() * 2, _joined(F.lit("ST"), F.lit(0), F.lit("A>C"), _key())), (_key() * 2 + 1, _joined(F.lit("IDD"), F.lit(0), _key() % 11 - 5, _key() * 2, F.lit(0), F.lit("."))))
    s = reports.read_sections(t.spark, "variants", path)
    st = s["ST"].select(_nation().alias("s_nationkey"), F.lit("ST").alias("section"), "kind", "n")
    return st.unionByName(s["IDD"].select(_nation().alias("s_nationkey"), F.lit("IDD").alias("section"), F.col("length").cast("bigint").cast("string").alias("kind"), "n"))


@query(
    "S12_contamination",
    """select s_nationkey, min(s_suppkey) % 5 / 100 as contamination, case when min(s_suppkey) % 5 / 100 < 0.02 then 0 else min(s_suppkey) % 5 / 100 end as used from supplier group by 1""",
)
def contamination(t: Tables) -> DataFrame:
    least = t.supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("k"))
    row = F.concat(F.lit("a\tb\tc\td\te\tf\t0.0"), (F.col("k") % 5).cast("string"), F.lit("\tz"))
    rows = least.select("s_nationkey", _by_line((F.lit(1), F.lit("#SEQ_ID\tRG")), (F.lit(2), row)).alias("x")).select("s_nationkey", "x.line", "x.value")
    return reports.contamination(t.spark, _files(t, "self", rows, "s_nationkey"), 0.02).select(_nation().alias("s_nationkey"), "contamination", "used")


@query("S22_region_metrics", "select s_nationkey, lower(replace(s_name, '#', '_')) as metric, case when s_suppkey % 3 = 0 then s_suppkey + 0.25 when s_suppkey % 3 = 1 then s_suppkey end as value from supplier")
def region_metrics(t: Tables) -> DataFrame:
    text = F.when(_key() % 3 == 0, F.concat(_key().cast("string"), F.lit(".25"))).when(_key() % 3 == 1, _key().cast("string")).otherwise("NaN")
    return reports.region_metrics(t.spark, _report(t, "regions", (_key(), _joined("s_name", text)))).select(_nation().alias("s_nationkey"), "metric", "value")


def _vcf(t: Tables, name: str, alt: Column, info: Column, form: str, sample: Column, file: Column | None = None) -> str:
    k = F.col("p_partkey")
    row = _joined(F.concat(F.lit("chr"), (k % 3 + 1).cast("string")), k + 1, F.lit("."), F.lit("N"), alt, F.lit("50"), F.lit("PASS"), info, F.lit(form), sample)
    return _files(t, name, t.part.select((file if file is not None else F.lit("x")).alias("run"), row.alias("value"), k.alias("line")), "run")


@query(
    "S27_segments",
    """select 'c1' as cohort, 's' || (p_partkey % 4) as sample, 'chr' || (p_partkey % 3 + 1) as contig, p_partkey as start, p_partkey + p_size + 1 as "end", cast(p_size % 5 as varchar) as copies, cast(p_size as bigint) as qs,
        case when p_size % 5 < 2 then 'DEL' when p_size % 5 > 2 then 'DUP' else 'REF' end as svtype from part""",
)
def segments(t: Tables) -> DataFrame:
    """Copy-number segment files with cohort and sample in the file name."""
    k, n = F.col("p_partkey"), F.col("p_size")
    alt = F.when(n % 5 < 2, "<DEL>").when(n % 5 > 2, "<DUP>").otherwise(".")
    name = F.concat(F.lit("COHORT_c1_SAMPLE_s"), (k % 4).cast("string"), F.lit(".vcf"))
    path = _vcf(t, "segments", alt, F.concat(F.lit("END="), (k + n + 1).cast("string"), F.lit(";FLAG")), "GT:CN:NP:QS", F.concat_ws(":", F.lit("0"), (n % 5).cast("string"), F.lit("3"), n.cast("string")), name)
    return genomics.segment_calls(t.spark, path).select("cohort", "sample", "contig", "start", "end", "copies", "qs", "svtype")


@query("S28_intervals", "select 'chr' || (p_partkey % 3 + 1) as contig, p_partkey as start, cast(p_size % 5 as bigint) as copies, p_size / 2 as cnq, p_size::double as second from part")
def interval_copies(t: Tables) -> DataFrame:
    n = F.col("p_size")
    sample = F.concat_ws(":", F.lit("0"), (n % 5).cast("string"), (n / 2).cast("string"), F.concat(F.lit("1,"), n.cast("string"), F.lit(",x")))
    rows = genomics.interval_copies(t.spark, _vcf(t, "intervals", F.lit("."), F.lit("."), "GT:CN:CNQ:CNLP", sample))
    return rows.select("contig", "start", "copies", "cnq", F.get("cnlp", F.lit(1)).alias("second"))


@query("S29_copy_ratios", "select 'chr' || (p_partkey % 3 + 1) as contig, p_partkey as start, p_partkey + p_size as \"end\", p_size / 4 as ratio from part")
def copy_ratios(t: Tables) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    rows = t.part.select(_joined(F.concat(F.lit("chr"), (k % 3 + 1).cast("string")), k + 1, k + n, n / 4).alias("value"), (k + 1).alias("line"))
    head = t.spark.createDataFrame([("@HD", -1), ("CONTIG\tSTART\tEND\tLINEAR_COPY_RATIO", 0)], "value string, line long")
    return genomics.copy_ratios(t.spark, _files(t, "ratios", head.unionByName(rows))).select("contig", "start", "end", "ratio")


@query(
    "S31_bed",
    """select 'chr' || (p_partkey % 3) as chrom, p_partkey as start, p_partkey + p_size % 7 as "end", case when p_size % 2 = 0 then p_name else 'chr' || (p_partkey % 3) || ':' || p_partkey || '-' || (p_partkey + p_size % 7) end as name from part where p_size % 7 > 0""",
)
def bed(t: Tables) -> DataFrame:
    """Malformed and empty intervals go, a missing name is made from the place."""
    k, n = F.col("p_partkey"), F.col("p_size")
    row = _joined(F.concat(F.lit("chr"), (k % 3).cast("string")), k, k + n % 7, F.when(n % 2 == 0, F.col("p_name")).otherwise(""))
    rows = t.part.select(_by_line((k * 2, row), (k * 2 + 1, F.lit("chr1\tx\t9"))).alias("x")).select("x.line", "x.value")
    return genomics.read_bed(t.spark, _files(t, "bed", rows)).select("chrom", "start", "end", "name")


@query("S30_contig_lengths", "select 'c' || p_partkey as contig, p_size * 100 as length from part where p_size % 2 = 0")
def contig_lengths(t: Tables) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    row = F.concat(F.lit("##contig=<ID=c"), k.cast("string"), F.when(n % 2 == 0, F.concat(F.lit(",length="), (n * 100).cast("string"))).otherwise(""), F.lit(">"))
    return genomics.contig_lengths(t.spark, _files(t, "contigs", t.part.select(row.alias("value"), k.alias("line")))).select("contig", F.col("length").cast("bigint").alias("length"))


@query("S34_vcf_samples", "select s_nationkey, list(s_name order by s_suppkey) as samples from supplier group by 1")
def vcf_samples(t: Tables) -> DataFrame:
    names = t.supplier.groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("x"))
    row = F.concat_ws("\t", F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"), F.transform("x", lambda x: x["s_name"]))
    path = _files(t, "names", names.select("s_nationkey", row.alias("value"), F.lit(1).alias("line")), "s_nationkey")
    return genomics.vcf_samples(t.spark, path).select(_nation().alias("s_nationkey"), "samples")


@query("S35_sex_table", "select s_name as sample, case when s_suppkey % 2 = 0 then 'F' else 'M' end as sex from supplier")
def sex_table(t: Tables) -> DataFrame:
    """A table with a header (K01) read as the map of sexes."""
    path = _folder(t, "sexes")
    sinks.write_tsv(t.supplier.select("s_name", F.col("s_name").alias("sample"), F.when(_key() % 2 == 0, "female").otherwise("male").alias("sex")), path, ["sample", "sex"])
    return genomics.sex_table(t.spark, path)


@query("S39_listing", "select 'f' || s_suppkey as name, s_suppkey * 10 as size, epoch_ms(cast(s_suppkey as bigint) * 100000000 + 1000000000000) as modified from supplier")
def listing(t: Tables) -> DataFrame:
    child = F.struct(F.concat(F.lit("f"), _key().cast("string")).alias("fileName"), F.lit("REGULAR").alias("fileType"), (_key() * 10).alias("size"), (_key() * 100_000_000 + 1_000_000_000_000).alias("mtime"))
    rows = t.supplier.groupBy("s_nationkey").agg(F.to_json(F.struct(F.collect_list(child).alias("children"))).alias("value"))
    path = _files(t, "listing", rows.withColumn("line", F.lit(1)), "s_nationkey")
    return genomics.listing(t.spark, path).select("name", "size", F.col("modified").cast("timestamp_ntz").alias("modified"))


@query("K02_table", "select cast(p_partkey as varchar) as p_partkey, case when p_size % 2 = 0 then cast(p_size // 2 as varchar) else printf('%.4f', p_size / 2) end as half, p_name || ';x' as names from part")
def table(t: Tables) -> DataFrame:
    """Chosen columns of a table, report numbers, lists joined; read back as text."""
    path = _folder(t, "table")
    rows = t.part.select("p_partkey", (F.col("p_size") / 2).alias("half"), F.array("p_name", F.lit("x")).alias("names"), "p_type")
    sinks.write_tsv(rows, path, ["p_partkey", "half", "names"], formatted=True)
    return t.spark.read.csv(path, sep="\t", header=True)


@query("K12_kits", "select o_orderpriority as kit, count(*) as bins, min(o_orderkey) as first from orders group by 1")
def kits(t: Tables) -> DataFrame:
    """Kits as JSON with their bins in order, read back."""
    path = _folder(t, "kits")
    sinks.write_kits(t.orders.select(F.col("o_orderpriority").alias("kit"), F.lit("c").alias("chrom"), F.col("o_orderkey").alias("start"), (F.col("o_orderkey") + 1).alias("end")), path)
    return t.spark.read.json(path).select("kit", "bins", F.col("intervals")[0]["start"].alias("first"))


@query("K09_scalar_metadata", "select s_suppkey, '{\"a\":' || s_nationkey || ',\"b\":[1,2]}' as info from supplier")
def scalar_metadata(t: Tables) -> DataFrame:
    return sinks.scalar_metadata(t.supplier.select("s_suppkey", F.struct(F.col("s_nationkey").alias("a"), F.array(F.lit(1), F.lit(2)).alias("b")).alias("info")))


@query("S21_two_lines", "select s_nationkey, cast(min(s_suppkey) as varchar) as first, cast(count(*) as varchar) as n from supplier group by 1")
def two_lines(t: Tables) -> DataFrame:
    rows = t.supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("a"), F.count(F.lit(1)).alias("b"))
    rows = rows.select("s_nationkey", _by_line((F.lit(1), F.lit("#first\tn")), (F.lit(2), _joined("a", "b"))).alias("x")).select("s_nationkey", "x.line", "x.value")
    return reports.two_lines(t.spark, _files(t, "two", rows, "s_nationkey"), ["first", "n"]).select(_nation().alias("s_nationkey"), F.col("first").cast("string").alias("first"), F.col("n").cast("string").alias("n"))


@query("S13_header_row", "select s_nationkey, cast(min(s_suppkey) as varchar) as pf_reads, cast(count(*) as varchar) as bait from supplier group by 1")
def header_row(t: Tables) -> DataFrame:
    """The row below a report's header line, by name."""
    rows = t.supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("a"), F.count(F.lit(1)).alias("b"))
    rows = rows.select("s_nationkey", _by_line((F.lit(1), F.lit("## made")), (F.lit(2), F.lit("BAIT\tPF_READS\tX")), (F.lit(3), _joined("b", "a", F.lit(0))), (F.lit(4), F.lit(""))).alias("x")).select("s_nationkey", "x.line", "x.value")
    found = lines.header_row(lines.lines(t.spark, _files(t, "capture", rows, "s_nationkey")), "BAIT", ["PF_READS", "BAIT"])
    return found.select(_nation().alias("s_nationkey"), "pf_reads", "bait")
