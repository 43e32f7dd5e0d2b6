"""Alignment edits, sample workflow steps and further report scans on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import alignments as al
from strandline.operators import cohort as co
from strandline.operators import genotypes as gt
from strandline.operators import intervals as iv
from strandline.operators import phasing as ph
from strandline.operators import samples as sa
from strandline.operators import stats as st
from strandline.plans.registry import Tables, query
from strandline.plans.source_queries import _by_line, _files, _folder, _joined, _nation
from strandline.sources import genomics, reports, sheets, sinks


def _text(column: str):
    return F.col(column).cast("string")


def _big(*columns: str):
    return [F.col(c).cast("bigint").alias(c) for c in columns]


def _records(rows: DataFrame, keep: list[str], **made) -> DataFrame:
    """``keep`` columns and a whole record; what is not ``made`` has a plain value."""
    plain = {
        "qname": F.lit("r"), "flag": F.lit(0), "rname": F.lit("chr1"), "pos": F.lit(100), "mapq": F.lit(60), "cigar": F.lit("5M"), "rnext": F.lit("="), "pnext": F.lit(100), "tlen": F.lit(0),
        "seq": F.lit("ACGTA"), "qual": F.lit("IIIII"), "tags": F.create_map().cast("map<string,string>"),
    }
    numbers = ("flag", "pos", "mapq", "pnext", "tlen")
    return rows.select(*keep, *[(v.cast("int") if c in numbers else v).alias(c) for c, v in (plain | made).items()])


_MAIN, _MAPPED = "f & 2304 = 0", "f & 4 = 0"


@query(
    "A01_sample_statistics",
    f"""select sample, reads, mapped, proper, duplicates, supplementary, bases, clipped, aligned, 2 * both_ as inserted, 3 * both_ as deleted, mean_mapq, mapped / reads as mapped_ratio, proper / reads as proper_ratio,
        duplicates / reads as duplicate_ratio, supplementary / greatest(mapped, 1) as supplementary_ratio, clipped / bases as clip_ratio, aligned / bases as aligned_ratio, 2 * both_ / aligned as insert_ratio, 3 * both_ / aligned as delete_ratio
    from (select sample, count(*) filter ({_MAIN}) as reads, count(*) filter ({_MAIN} and {_MAPPED}) as mapped, count(*) filter ({_MAIN} and f & 2 <> 0) as proper, count(*) filter ({_MAIN} and f & 1024 <> 0) as duplicates,
        count(*) filter (f & 2048 <> 0) as supplementary, coalesce(sum(2 * n + q + 2) filter ({_MAIN}), 0)::bigint as bases, coalesce(sum(2 * n) filter ({_MAIN} and {_MAPPED}), 0)::bigint as clipped,
        coalesce(sum(q) filter ({_MAIN} and {_MAPPED}), 0)::bigint as aligned, count(*) filter ({_MAIN} and {_MAPPED}) as both_, avg(q) filter ({_MAIN} and {_MAPPED}) as mean_mapq
        from (select l_suppkey % 50 as sample, l_orderkey % 4096 as f, l_linenumber as n, cast(l_quantity as bigint) as q from lineitem) group by 1)""",
)
def sample_statistics(t: Tables) -> DataFrame:
    n, q = F.col("l_linenumber").cast("int"), F.col("l_quantity").cast("int")
    cigar = F.concat(n.cast("string"), F.lit("S"), q.cast("string"), F.lit("M2I3D"), n.cast("string"), F.lit("S"))
    rows = _records(t.lineitem, [(F.col("l_suppkey") % 50).alias("sample")], flag=F.col("l_orderkey") % 4096, mapq=q, cigar=cigar, seq=F.repeat(F.lit("A"), 2 * n + q + 2))
    return al.sample_statistics(rows, ["sample"]).drop("motifs", "motif_ratio")


@query("A32_length_histogram", "select p_size, length(p_name) as length, count(*) as n from part group by 1, 2")
def length_histogram(t: Tables) -> DataFrame:
    return al.length_histogram(t.part, ["p_size"], "p_name").select("p_size", *_big("length"), "n")


@query("F05_main_chromosomes", "select p_partkey from part where p_size between 1 and 23 or p_size = 25")
def main_chromosomes(t: Tables) -> DataFrame:
    n = F.col("p_size")
    name = F.concat(F.lit("chr"), F.when(n == 23, "X").when(n == 24, "Y").when(n == 25, "M").otherwise(n.cast("string")))
    return co.main_chromosomes(t.part.select("p_partkey", name.alias("chrom"))).select("p_partkey")


@query("F07_usable_samples", "select c_custkey from customer where c_custkey % 5 = 3")
def usable_samples(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 5
    mapped = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, 0.0).when(k == 3, F.col("c_custkey").cast("double"))
    return co.usable_samples(t.customer.select("c_custkey", mapped.alias("bases_mapped"))).select("c_custkey")


@query(
    "J17_resolve_regions",
    """select s_name as sample, region, file_region, s_name || '.' || file_region as path from (select *, case when s_suppkey % 2 = 0 then case region when 'A12' then 'A1' else region end else case region when 'A12' then 'F' else region end end as file_region
        from supplier, (select unnest(['A12', 'XH', 'Y']) as region)) where not (s_suppkey % 3 = 0 and region in ('XH', 'Y'))""",
)
def resolve_regions(t: Tables) -> DataFrame:
    """Genomes at the first split, exomes whole; females without Y and haploid regions."""
    k = F.col("s_suppkey")
    samples = t.supplier.select(F.col("s_name").alias("sample"), F.when(k % 2 == 0, "WGS").otherwise("WES").alias("sample_type"), F.when(k % 3 == 0, "F").otherwise("M").alias("sex"))
    regions = t.spark.createDataFrame([("A12",), ("XH",), ("Y",)], "region string")
    files = t.supplier.select(F.col("s_name").alias("sample"), F.explode(F.array(*map(F.lit, ("A1", "F", "XH", "Y")))).alias("region")).withColumn("path", F.concat_ws(".", "sample", "region"))
    return sa.resolve_regions(samples, regions, files).select("sample", "region", "file_region", "path")


@query("J18_read_groups", "select o_custkey as sample, 'rg' || o_orderkey as id from orders where o_orderkey % 10 = 3")
def read_groups(t: Tables) -> DataFrame:
    """Read groups of the files whose name holds a part."""
    key = _text("o_orderkey")
    group = F.struct(F.concat(F.lit("rg"), key).alias("id"), F.array(F.concat(F.lit("/in/k"), (F.col("o_orderkey") % 10).cast("string"), F.lit(".bam"))).alias("files"))
    groups = t.orders.groupBy(F.col("o_custkey").alias("sample")).agg(F.collect_list(group).alias("readgroups"))
    return sa.group_readgroups(groups, F.lit("/k3."), "part").select("sample", "rg.id")


@query("N12_active_bytes", "select o_custkey, sum(o_orderkey)::double * 2.5::double as active from orders group by 1")
def active_bytes(t: Tables) -> DataFrame:
    return sa.active_bytes(t.orders, ["o_custkey"], "o_orderkey")


@query("N14_quota", "select p_partkey, p_partkey * 100 - p_size - p_partkey - 7 as pinned from part")
def quota(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return sa.quota(t.part.select("p_partkey", (k * 100).alias("total"), F.col("p_size").alias("free"), k.alias("precious"), F.lit(7).alias("removable"))).select("p_partkey", "pinned")


@query("F14_metadata", "select p_partkey from part where p_partkey % 2 = 0 and (p_size::varchar like '4%' or p_name like '4%' or p_partkey::varchar like '4%')")
def metadata(t: Tables) -> DataFrame:
    path = F.concat(F.when(F.col("p_partkey") % 2 == 0, "/a/").otherwise("/b/"), _text("p_partkey"))
    rows = t.part.select("p_partkey", path.alias("path"), F.array(F.col("p_name"), _text("p_partkey")).alias("labels"), F.create_map(F.lit("size"), _text("p_size")).alias("xattr"))
    return sa.matching_metadata(rows, "^4", prefix="/a/").select("p_partkey")


@query(
    "W03_single_batches",
    """select o_custkey, o_orderkey, case when alone then s else max(case when first and not alone then s end) over (partition by o_custkey order by o_orderkey) end as batch
    from (select *, sum(first::int) over (partition by o_custkey order by o_orderkey) as s from (select *, alone or (row_number() over (partition by o_custkey, alone order by o_orderkey) - 1) % 3 = 0 as first
        from (select o_custkey, o_orderkey, o_orderkey % 5 = 0 as alone from orders)))""",
)
def single_batches(t: Tables) -> DataFrame:
    """Oversize rows alone, without ending the batch that is being filled: three of 30 go into 100."""
    rows = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, 500.0).otherwise(30.0).alias("size"))
    return sa.batches(rows, ["o_custkey"], "o_orderkey", "size", 100.0, alone=True).select("o_custkey", "o_orderkey", *_big("batch"))


@query("J09_position_join", "select p_partkey as pos, case when p_partkey % 4 = 0 then 'AT' end as p_ref from part")
def position_join(t: Tables) -> DataFrame:
    """A phased record of a longer reference fits where the rewritten alternatives agree."""
    k = F.col("p_partkey")
    place = [F.lit("s").alias("sample"), F.lit("chr1").alias("chrom"), k.alias("pos")]
    calls = t.part.select(*place, F.lit("A").alias("ref"), F.array(F.lit("G")).alias("alts"))
    phased = t.part.where(k % 2 == 0).select(*place, F.lit("AT").alias("ref"), F.array(F.when(k % 4 == 0, "GT").otherwise("CT")).alias("alts"))
    return ph.position_join(calls, phased).select("pos", "p_ref")


@query(
    "J16_annotate_back",
    "select p_partkey as pos, case when p_partkey % 2 = 0 then p_size end as called_af, case when p_partkey % 2 = 0 then 'PASS' else 'low' end as filter from part",
)
def annotate_back(t: Tables) -> DataFrame:
    """Called values back on the genotype rows (J15), the called FILTER where there is one."""
    sites = t.part.select(F.concat(F.lit("chr"), _text("p_size")).alias("chrom"), F.col("p_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    called = sites.where("pos % 2 = 0").withColumn("af", F.regexp_replace("chrom", "chr", "").cast("bigint")).withColumn("filter", F.lit("PASS"))
    rows = gt.annotate(sites.withColumn("filter", F.lit("low")), {"called": called})
    return rows.select("pos", "called_af", gt.first_filter(F.col("filter"), F.col("called_filter")).alias("filter"))


@query(
    "N09_phase_transfer",
    """select p_partkey, reason, case when reason in ('exact', 'suffix', 'deletion') then 0 when reason = 'swapped' then 1 end as a, case when reason in ('exact', 'suffix', 'deletion') then 1 when reason = 'swapped' then 0 end as b
    from (select p_partkey, ['exact', 'swapped', 'suffix', 'deletion', 'mismatch', 'missing'][p_partkey % 6 + 1] as reason from part)""",
)
def phase_transfer(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 6
    ref = F.when(k == 2, "AT").otherwise("A")
    alleles = F.when(k == 2, F.array(F.lit("AT"), F.lit("GT"))).otherwise(F.array(F.lit("A"), F.lit("G")))
    left = F.when(k == 1, "G").when(k == 3, "*").when(k == 4, "C").otherwise("A")
    packed = F.when(k != 5, F.struct(left.alias("left"), F.when(k == 1, "A").when(k == 4, "C").otherwise("G").alias("right"), F.lit(1).alias("ref_len")))
    rows = t.part.select("p_partkey", ph.transfer(ref, alleles, F.array(F.lit(0), F.lit(1)), packed).alias("x"))
    return rows.select("p_partkey", "x.reason", F.get("x.phase", F.lit(0)).cast("bigint").alias("a"), F.get("x.phase", F.lit(1)).cast("bigint").alias("b"))


@query("O06_arg_first", "select o_custkey, min(o_orderkey) as o_orderkey from orders join (select o_custkey, max(o_orderpriority) as o_orderpriority from orders group by 1) using (o_custkey, o_orderpriority) group by 1")
def arg_first(t: Tables) -> DataFrame:
    return st.arg_first(t.orders, ["o_custkey"], F.col("o_orderpriority"), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@query("U06_united_groups", "select s_suppkey as id, s_name as name, null::varchar as reason from supplier union all select s_suppkey, null, 'bad' from supplier where s_suppkey % 7 = 0")
def united_groups(t: Tables) -> DataFrame:
    """Read groups and badly mapped ones in one table; columns that one side lacks are null."""
    k = F.col("s_suppkey").alias("id")
    return sa.concatenate([t.supplier.select(k, F.col("s_name").alias("name")), t.supplier.where("s_suppkey % 7 = 0").select(k, F.lit("bad").alias("reason"))], strict=False)


def _in_regions(keep: str) -> str:
    return f"select {keep} from lineitem where l_partkey % 100 < 20 or l_partkey % 100 > 95"


def _regions(t: Tables) -> DataFrame:
    """chr1 from 0 to 20 of every hundred, over all the parts."""
    k = F.floor(F.col("p_partkey") / 100)
    k = F.explode(F.array(k, k + 1))
    return t.part.select(k.alias("k")).distinct().select(F.lit("chr1").alias("chrom"), (F.col("k") * 100).alias("start"), (F.col("k") * 100 + 20).alias("end"))


@query("F10_region_extraction", _in_regions("l_orderkey, l_linenumber"))
def region_extraction(t: Tables) -> DataFrame:
    """Variants of five reference bases that touch a region of a BED."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.lit("chr1").alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + 5).alias("end"))
    return iv.overlap_join(rows, _regions(t), ["chrom"], 100, "semi").select("l_orderkey", "l_linenumber")


@query(
    "S38_region_statistics",
    f"""unpivot (select sample, count(*)::double as reads, count(*)::double * 5 as bases, count(*) filter (f & 1024 <> 0)::double as duplicates, count(*) filter (f & 2 <> 0)::double as proper
        from ({_in_regions('l_linenumber as sample, l_orderkey % 4096 as f')}) where f & 4 = 0 group by 1) on reads, bases, duplicates, proper into name metric value value""",
)
def region_statistics(t: Tables) -> DataFrame:
    rows = _records(t.lineitem, [F.col("l_linenumber").alias("sample")], qname=_text("l_orderkey"), flag=F.col("l_orderkey") % 4096, pos=F.col("l_partkey") + 1)
    return al.region_statistics(rows, "sample", _regions(t), 4, 100)


@query("R19_dechimer", "select 'r' || s_suppkey as qname, unnest([64, 128]) as mate, case when s_suppkey % 2 = 1 then unnest([97, 145]) else unnest([99, 147]) end as flag, case when s_suppkey % 2 = 1 then unnest([200100, 100]) else unnest([300, 100]) end as pnext from supplier")
def dechimer(t: Tables) -> DataFrame:
    """Mates more than 100,000 bases apart lose the proper flag; mate places follow."""
    k = F.col("s_suppkey")
    far = F.when(k % 2 == 1, 200_100).otherwise(300)
    name, whole = F.concat(F.lit("r"), k.cast("string")), {"cigar": F.lit("60M"), "seq": F.repeat(F.lit("A"), 60), "qual": F.repeat(F.lit("I"), 60)}
    first = _records(t.supplier, [], qname=name, flag=F.lit(99), pos=F.lit(100), pnext=F.lit(0), **whole)
    rows = first.unionByName(_records(t.supplier, [], qname=name, flag=F.lit(147), pos=far, pnext=F.lit(0), **whole))
    return al.dechimer(rows).select("qname", F.col("flag").bitwiseAND(192).cast("bigint").alias("mate"), *_big("flag", "pnext"))


@query("R20_invented_bases", "select 'r' || s_suppkey as qname, 104 as at, 'G' as base from supplier where s_suppkey % 2 = 1")
def invented_bases(t: Tables) -> DataFrame:
    name = F.concat(F.lit("r"), _text("s_suppkey"))
    old = _records(t.supplier, [], qname=name)
    return al.invented_bases(old, _records(t.supplier, [], qname=name, seq=F.when(F.col("s_suppkey") % 2 == 1, "ACGTG").otherwise("ACGTA"))).select("qname", "at", "base")


@query("R20_bad_runs", "select p_partkey from part where p_partkey % 4 in (1, 2)")
def bad_runs(t: Tables) -> DataFrame:
    """A clip inside, a sequence of another length; hard clips outside and '*' are fine."""
    k = F.col("p_partkey") % 4
    return al.bad_runs(_records(t.part, ["p_partkey"], cigar=F.when(k == 1, "2M1S2M").when(k == 2, "4M").when(k == 3, "2H3M2S").otherwise("*"))).select("p_partkey")


@query("R21_restored_bases", "select 'r' || s_suppkey as qname, case when s_suppkey % 3 = 0 then 589 else 65 end as flag, case when s_suppkey % 3 <> 0 then 'GG' end as before, case when s_suppkey % 3 <> 0 then 'T' end as after from supplier")
def restored_bases(t: Tables) -> DataFrame:
    """Trimmed bases come back as tags; reads without an alignment as unmapped records."""
    name = F.concat(F.lit("r"), _text("s_suppkey"))
    aligned = _records(t.supplier.where("s_suppkey % 3 <> 0"), [], qname=name, flag=F.lit(65))
    reads = t.supplier.select(name.alias("qname"), F.lit(1).alias("mate"), F.lit("GGACGTAT").alias("seq"), F.lit("!!IIIII#").alias("qual"))
    return al.merge_with_reads(aligned, reads).select("qname", *_big("flag"), F.col("tags")["YB"].alias("before"), F.col("tags")["ZB"].alias("after"))


@query("J11_paired_reads", "select 'r' || o_orderkey as qname, 'A' || o_orderkey as seq1, 'C' || o_orderkey as seq2 from orders where o_orderkey % 3 <> 1 and o_orderkey % 3 <> 2")
def paired_reads(t: Tables) -> DataFrame:
    """Mates meet by normalised name wherever they are in their files."""
    def side(mate: str, base: str, lost: int) -> DataFrame:
        return t.orders.where(F.col("o_orderkey") % 3 != lost).select(
            F.concat(F.lit("r"), _text("o_orderkey"), F.lit(f"/{mate}")).alias("name"), F.concat(F.lit(base), _text("o_orderkey")).alias("seq"), F.lit("I").alias("qual")
        )

    return al.pair_reads(side("1", "A", 1), side("2", "C", 2))[0].select("qname", "seq1", "seq2")


@query("R25_long_clips", "select p_partkey, p_size as clipped, repeat('C', p_size) as before, 'AAAAA' as middle from part where p_size >= 10 and p_partkey % 3 <> 0")
def long_clips(t: Tables) -> DataFrame:
    n = F.col("p_size").cast("int")
    rows = _records(t.part, ["p_partkey"], flag=F.when(F.col("p_partkey") % 3 == 0, 1024).otherwise(0), cigar=F.concat(n.cast("string"), F.lit("S5M")), seq=F.concat(F.repeat(F.lit("C"), n), F.lit("AAAAA")))
    return al.long_clips(rows, 10).select("p_partkey", *_big("clipped"), "parts.before", "parts.middle")


@query(
    "S01_sample_sheets",
    """select s_name as sample, case when s_suppkey % 2 = 0 then 'cram' else 'bam' end as file_type, case when s_suppkey % 5 = 0 then 12.5::double else case when s_suppkey % 4 < 2 then 8.0::double else 75.0::double end * case when s_suppkey % 2 = 0 then 0.5::double else 1.0::double end end as filesize
    from supplier where s_suppkey % 3 <> 0""",
)
def sample_sheets(t: Tables) -> DataFrame:
    """Rows of a sheet that hold to its rules; a stated size goes before the assumed one."""
    k = F.col("s_suppkey")
    head = [F.lit("st"), F.col("s_name"), F.when(k % 2 == 0, "cram").otherwise("bam"), F.when(k % 4 < 2, "illumina_exome").otherwise("illumina_wgs"), F.lit("kit"), F.when(k % 3 == 0, "x").otherwise("F"), F.lit("a.bam")]
    row = F.when(k % 5 == 0, _joined(*head, F.lit(""), F.lit("filesize=12.5"))).otherwise(_joined(*head))
    path = _files(t, "sheets", t.supplier.select("s_nationkey", row.alias("value"), k.alias("line")), "s_nationkey")
    return sheets.read_sheets(t.spark, path)[0].select("sample", "file_type", "filesize")


@query("S02_side_files", "select s_name as sample, case when s_suppkey % 2 = 0 then 'low' else '' end as reason from supplier")
def side_files(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    row = F.when(k % 2 == 0, _joined("s_name", F.lit("low"))).otherwise(F.col("s_name"))
    rows = t.supplier.select("s_nationkey", _by_line((k * 2, F.lit("# note")), (k * 2 + 1, row)).alias("x")).select("s_nationkey", "x.line", "x.value")
    return sheets.side_file(t.spark, _files(t, "exclude", rows, "s_nationkey"))


@query("S03_found_sheets", "select distinct s_nationkey from supplier where s_nationkey % 5 between 1 and 3")
def found_sheets(t: Tables) -> DataFrame:
    """Files whose first line has seven to nine columns."""
    row = F.array_join(F.array_repeat(F.lit("x"), (F.col("s_nationkey") % 5 + 6).cast("int")), "\t")
    path = _files(t, "found", t.supplier.select("s_nationkey", row.alias("value"), F.col("s_suppkey").alias("line")), "s_nationkey")
    return sheets.find_sheets(t.spark, path).select(_nation().alias("s_nationkey"))


def _report(t: Tables, name: str, *texts) -> str:
    """A file a nation: the given lines, made of ``a`` (least supplier) and ``b`` (suppliers)."""
    rows = t.supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("a"), F.count(F.lit(1)).alias("b"))
    numbered = [(F.lit(i), x if not isinstance(x, str) else F.lit(x)) for i, x in enumerate(texts)]
    return _files(t, name, rows.select("s_nationkey", _by_line(*numbered).alias("x")).select("s_nationkey", "x.line", "x.value"), "s_nationkey")


def _line(label: str, column: str):
    return F.concat(F.lit(label), _text(column))


_OF = "(select s_nationkey, min(s_suppkey) as a, count(*) as b from supplier group by 1)"


@query("S14_adapter_removal", f"select s_nationkey, (a + b)::double as pairs, a / (a + b) as aligned_ratio, b / (a + b) as adapter_ratio, a / (2 * (a + b)) as retained_ratio from {_OF}")
def adapter_removal(t: Tables) -> DataFrame:
    pairs = F.concat(F.lit("Total number of read pairs: "), (F.col("a") + F.col("b")).cast("string"))
    path = _report(t, "trimming", "Total number of read pairs: 9", "[Trimming statistics]", pairs, _line("Number of well aligned read pairs: ", "a"), _line("Number of reads with adapters[1]: ", "b"), _line("Number of retained reads: ", "a"))
    return reports.adapter_removal(t.spark, path).select(_nation().alias("s_nationkey"), F.col("total_number_of_read_pairs").alias("pairs"), "aligned_ratio", "adapter_ratio", "retained_ratio")


@query("S15_fixed_lines", f"select s_nationkey, a::varchar as first, 'AC' || b as adapter from {_OF}")
def fixed_lines(t: Tables) -> DataFrame:
    path = _report(t, "adapters", "made", _line("value: ", "a"), "", _line("   --adapter1:  AC", "b"))
    return reports.fixed_lines(t.spark, path, {"first": (2, 8), "adapter": (4, 15)}).select(_nation().alias("s_nationkey"), "first", "adapter")


@query("S16_merge_counts", f"select s_nationkey, a::double as reads, b::double as merged, 0.0::double as lost, coalesce(b / nullif(a, 0), 0) as merged_ratio, 0.0::double as lost_ratio from {_OF}")
def merge_counts(t: Tables) -> DataFrame:
    """Counters up to the first blank line with guarded ratios."""
    path = _report(t, "merge", _line("reads\t", "a"), _line("merged\t", "b"), "", "reads\t0")
    return reports.count_stats(t.spark, path, ["reads", "merged", "lost"], {"merged_ratio": ("merged", "reads"), "lost_ratio": ("merged", "lost")}).select(_nation().alias("s_nationkey"), "reads", "merged", "lost", "merged_ratio", "lost_ratio")


@query("S18_mapper_log", f"select s_nationkey, 'rg1' as \"group\", a::double as mapped_r1, b::double as mapped_r2, (a + b) / 2 as mapped_mean, (a - b)::double as mapped_difference, 0.5::double as mapped_r1_ratio from {_OF}")
def mapper_log(t: Tables) -> DataFrame:
    one = F.concat(F.lit("MAPPING/ALIGNING PER RG,rg1,Mapped R1,"), _text("a"), F.lit(",0.5"))
    path = _report(t, "mapper", "TRIMMER,rg1,Mapped R1,1,1", one, _line("MAPPING/ALIGNING PER RG,rg1,Mapped R2,", "b"))
    return reports.mapper_log(t.spark, path, ["mapped_r1", "mapped_r2"]).select(_nation().alias("s_nationkey"), "group", "mapped_r1", "mapped_r2", "mapped_mean", "mapped_difference", "mapped_r1_ratio")


@query("S19_artifact_scores", f"select s_nationkey, unnest(['A', 'C']) as ref, unnest(['G', 'T']) as alt, unnest([a::double, b / 2]) as q from {_OF}")
def artifact_scores(t: Tables) -> DataFrame:
    two = F.concat(F.lit("s\tl\tC\tT\t"), (F.col("b") / 2).cast("string"))
    path = _report(t, "artifacts", "SAMPLE\tLIBRARY\tREF_BASE\tALT_BASE\tTOTAL_QSCORE", _line("s\tl\tA\tG\t", "a"), two, "s\tl\tG\tA\tNA")
    return reports.artifacts(t.spark, path).select(_nation().alias("s_nationkey"), "ref", "alt", "q")


@query("S20_artifact_details", f"select s_nationkey, 'ACA' as context, a as pro_ref, b as pro_alt, a as con_ref, 0 as con_alt from {_OF}")
def artifact_details(t: Tables) -> DataFrame:
    row = F.concat_ws("\t", F.lit("s\tl\tC\tT\tACA"), _text("a"), _text("b"), _text("a"), F.lit("0\t0.1\t30"))
    return reports.artifacts(t.spark, _report(t, "details", "SAMPLE", row), detail=True).select(_nation().alias("s_nationkey"), "context", "pro_ref", "pro_alt", "con_ref", "con_alt")


@query("S24_taxonomy", f"select s_nationkey, unnest([b, a]) as clade, unnest(['D', 'S']) as rank, unnest([2, 562]) as taxid, unnest(['Bacteria', 'E. coli']) as name, unnest([1, 3]) as depth from {_OF}")
def taxonomy(t: Tables) -> DataFrame:
    path = _report(t, "taxa", F.concat_ws("\t", F.lit("99.0"), _text("b"), F.lit("0\tD\t2\t  Bacteria")), F.concat_ws("\t", F.lit("1.0"), _text("a"), F.lit("1\t5\t7\tS\t562\t      E. coli")))
    return reports.taxonomy(t.spark, path).select(_nation().alias("s_nationkey"), "clade", "rank", "taxid", "name", *_big("depth"))


@query("S25_species_shares", "select p_partkey::varchar as name, p_size / 100 as share from part where p_size % 2 = 0 and p_size >= 25")
def species_shares(t: Tables) -> DataFrame:
    path = _folder(t, "species")
    rows = t.part.select(_text("p_partkey").alias("name"), F.when(F.col("p_size") % 2 == 0, "S").otherwise("G").alias("taxonomy_lvl"), (F.col("p_size") / 100).alias("fraction_total_reads"))
    sinks.write_tsv(rows, path)
    return reports.species_shares(t.spark, path, 0.25).select("name", "share")


@query("S26_phase_report", f"select s_nationkey, unnest(['chr1', 'chr2']) as chrom, unnest(['phased', 'phased']) as metric, unnest([a, b])::double as value from {_OF}")
def phase_report(t: Tables) -> DataFrame:
    """Values belong to the last chromosome header above them."""
    bar = "---------------- Chromosome {} ----------------"
    path = _report(t, "phasing", "Phasing statistics for sample x", bar.format("chr1"), _line("               Phased: ", "a"), bar.format("chr2"), _line("               Phased: ", "b"))
    return reports.phasing_report(t.spark, path).select(_nation().alias("s_nationkey"), "chrom", "metric", "value")


@query("S36_coverage_cube", "select p_partkey as region_id, p_size / 2 as cov from part where p_partkey between 50 and 1200")
def coverage_cube(t: Tables) -> DataFrame:
    """A cube written in blocks of regions (K05), of which only some are read."""
    path = _folder(t, "cube")
    co.write_cube(t.part.select(F.col("p_partkey").alias("region_id"), (F.col("p_size") / 2).alias("cov")), path, 100)
    return co.read_cube(t.spark, path, 50, 1200, regions_a_block=100).select("region_id", "cov")


@query("S37_read_layout", "select distinct s_nationkey, 4 as lines, case when s_nationkey % 2 = 1 then 64 else 33 end as base from supplier")
def read_layout(t: Tables) -> DataFrame:
    code = F.when(F.col("s_nationkey") % 2 == 1, "hhhh").otherwise("IIII")
    return genomics.fastq_layout(t.spark, _report(t, "layout", "@r", "ACGT", "+", code)).select(_nation().alias("s_nationkey"), *_big("lines", "base"))


@query("K03_appended_table", "select s_suppkey::varchar as id, s_name as name, null::varchar as more from supplier where s_suppkey % 2 = 0 union all select s_suppkey::varchar, s_name, 'x' from supplier where s_suppkey % 2 = 1")
def appended_table(t: Tables) -> DataFrame:
    """Rows below an existing table (K01), columns united."""
    first, second = _folder(t, "old"), _folder(t, "appended")
    k = _text("s_suppkey").alias("id")
    sinks.append_tsv(t.supplier.where("s_suppkey % 2 = 0").select(k, F.col("s_name").alias("name")), None, first)
    old = t.spark.read.csv(first, sep="\t", header=True)
    sinks.append_tsv(t.supplier.where("s_suppkey % 2 = 1").select(k, F.col("s_name").alias("name"), F.lit("x").alias("more")), old, second)
    return t.spark.read.csv(second, sep="\t", header=True)


@query("K04_sections", "select 'nation' as section, n_name as name from nation union all select 'region', r_name from region")
def sections(t: Tables) -> DataFrame:
    path = _folder(t, "sections")
    sinks.write_sections({"nation": t.nation.select(F.col("n_name").alias("name")), "region": t.region.select(F.col("r_name").alias("name"))}, path)
    read = [t.spark.read.csv(f"{path}/{s}.tsv", sep="\t", header=True).select(F.lit(s).alias("section"), "name") for s in ("nation", "region")]
    return read[0].unionByName(read[1])
