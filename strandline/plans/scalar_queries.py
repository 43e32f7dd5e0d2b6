"""Column functions and small operators on the driver's tables: fields, records, regions, intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import fields, genome, hashing
from strandline.functions import records as rec
from strandline.operators import alignments as al
from strandline.operators import calls as ca
from strandline.operators import intervals as iv
from strandline.plans.record_queries import _DNA, _dna
from strandline.plans.registry import Tables, query
from strandline.sources.genomics import header_fields
from strandline.sources.sinks import number_text

_QTY = "cast(l_quantity as bigint)"
_RUNS = f"l_linenumber || 'S' || {_QTY} || 'M2I3D4=5X' || l_linenumber || 'H'"


def _qty():
    return F.col("l_quantity").cast("bigint")


def _runs():
    n = F.col("l_linenumber").cast("string")
    return rec.runs(F.concat(n, F.lit("S"), _qty().cast("string"), F.lit("M2I3D4=5X"), n, F.lit("H")))


@query("R04_run_totals", f"select l_orderkey, l_linenumber, cast(2 * l_linenumber as bigint) as clipped, {_QTY} + 4 as aligned, 2::bigint as inserted, 3::bigint as deleted from lineitem")
def run_totals(t: Tables) -> DataFrame:
    x = rec.run_totals(_runs())
    return t.lineitem.select("l_orderkey", "l_linenumber", *[x[c].cast("bigint").alias(c) for c in ("clipped", "aligned", "inserted", "deleted")])


@query(
    "R05_lengths",
    f"select l_orderkey, l_linenumber, {_QTY} + 9 as aligned, {_QTY} + 11 as aligned_read, {_QTY} + 11 + 2 * l_linenumber as original, {_QTY} + 12 as reference from lineitem",
)
def lengths(t: Tables) -> DataFrame:
    r = _runs()
    made = {"aligned": rec.aligned_length(r), "aligned_read": rec.aligned_read_length(r), "original": rec.original_length(r), "reference": rec.reference_length(r)}
    return t.lineitem.select("l_orderkey", "l_linenumber", *[v.cast("bigint").alias(k) for k, v in made.items()])


@query(
    "R06_read_span",
    f"""select l_orderkey, l_linenumber, cast(a as bigint) as first, a + {_QTY} as last from (select *, case when l_orderkey % 2 = 1 then 5 else l_linenumber end as a from lineitem)""",
)
def read_span(t: Tables) -> DataFrame:
    r = rec.runs(F.concat(F.col("l_linenumber").cast("string"), F.lit("S"), _qty().cast("string"), F.lit("M5H")))
    x = rec.read_span(r, F.col("l_orderkey") % 2 == 1)
    return t.lineitem.select("l_orderkey", "l_linenumber", x["start"].cast("bigint").alias("first"), x["end"].cast("bigint").alias("last"))


@query(
    "R08_original_sequence",
    f"""select p_partkey, case when p_partkey % 2 = 1 then translate(reverse('AC' || s || 'GGT'), 'ACGTacgt', 'TGCAtgca') else 'AC' || s || 'GGT' end as seq,
        case when p_partkey % 2 = 1 then reverse('!#' || s || 'IJK') else '!#' || s || 'IJK' end as qual from (select p_partkey, {_DNA.format('p_name')} as s from part)""",
)
def original_sequence(t: Tables) -> DataFrame:
    tags = F.create_map(F.lit("YB"), F.lit("AC"), F.lit("ZB"), F.lit("GGT"), F.lit("YQ"), F.lit("!#"), F.lit("ZQ"), F.lit("IJK"))
    back = F.col("p_partkey") % 2 == 1
    return t.part.select("p_partkey", rec.original_sequence(_dna("p_name"), back, tags).alias("seq"), rec.original_quality(_dna("p_name"), back, tags).alias("qual"))


@query(
    "R12_mate_overlap",
    f"""select l_orderkey, l_linenumber, l_partkey % 3 = l_suppkey % 3 and l_orderkey % 2 <> l_linenumber % 2 and least(100 + {_QTY}, 120 + l_linenumber) > greatest(100, 90 + {_QTY}) as overlap from lineitem""",
)
def mate_overlap(t: Tables) -> DataFrame:
    c, q = F.col, _qty()
    hit = rec.mates_overlap(c("l_partkey") % 3, F.lit(100), 100 + q, c("l_orderkey") % 2, c("l_suppkey") % 3, 90 + q, 120 + c("l_linenumber"), c("l_linenumber") % 2)
    return t.lineitem.select("l_orderkey", "l_linenumber", hit.alias("overlap"))


@query(
    "R13_consensus",
    f"""select p_partkey, array_to_string(list_transform(range(1, 9), lambda i: case when a[i] = b[i] or ascii(qa[i]) >= ascii(qb[i]) then a[i] else b[i] end), '') as seq,
        array_to_string(list_transform(range(1, 9), lambda i: chr(33 + cast(greatest(2, least(73, case when a[i] = b[i] then ascii(qa[i]) + ascii(qb[i]) - 66 else abs(ascii(qa[i]) - ascii(qb[i])) end)) as int))), '') as qual
    from (select p_partkey, string_split(substr(s, 1, 8), '') as a, string_split(substr(reverse(s), 1, 8), '') as b, string_split('IJ#5AAII', '') as qa, string_split('#IJ5KBA!', '') as qb
          from (select p_partkey, rpad({_DNA.format('p_name')}, 8, 'A') || 'ACGTACGT' as s from part))""",
)
def consensus(t: Tables) -> DataFrame:
    s = F.concat(F.rpad(_dna("p_name"), 8, "A"), F.lit("ACGTACGT"))
    x = rec.consensus(F.substring(s, 1, 8), F.lit("IJ#5AAII"), F.substring(F.reverse(s), 1, 8), F.lit("#IJ5KBA!"))
    return t.part.select("p_partkey", x["seq"].alias("seq"), x["qual"].alias("qual"))


@query(
    "R14_supplementary_tag",
    f"select l_orderkey, l_linenumber, 'chr' || l_linenumber || ',' || l_partkey || ',' || case when l_suppkey % 2 = 1 then '-' else '+' end || ',' || {_QTY} || 'M,60,' || coalesce(cast(case when l_linenumber > 3 then l_linenumber end as varchar), '0') as sa from lineitem",
)
def supplementary_tag(t: Tables) -> DataFrame:
    n = F.col("l_linenumber")
    tag = rec.supplementary_tag(F.concat(F.lit("chr"), n.cast("string")), F.col("l_partkey"), F.col("l_suppkey") % 2 == 1, F.concat(_qty().cast("string"), F.lit("M")), F.lit(60), F.when(n > 3, n))
    return t.lineitem.select("l_orderkey", "l_linenumber", tag.alias("sa"))


@query(
    "R17_clip_parts",
    """select p_partkey, substr(p_name, 1, 2) as before, substr(p_name, 3, greatest(0, length(p_name) - 5)) as middle, substr(p_name, length(p_name) - 2, 3) as after,
        round(list_sum(list_transform(string_split(p_name, ''), lambda c: ascii(c) - 33)) / length(p_name), 9) as quality from part where length(p_name) > 5""",
)
def clip_parts(t: Tables) -> DataFrame:
    x = rec.clip_parts(F.col("p_name"), rec.runs(F.concat(F.lit("2S"), (F.length("p_name") - 5).cast("string"), F.lit("M3S"))))
    return t.part.where("length(p_name) > 5").select("p_partkey", x["before"].alias("before"), x["middle"].alias("middle"), x["after"].alias("after"), F.round(rec.mean_quality(F.col("p_name")), 9).alias("quality"))


@query(
    "R22_quality_shift",
    """select p_partkey, case when lo >= 64 and hi > 74 then 31 else 0 end as shift, case when lo >= 64 and hi > 74 then array_to_string(list_transform(c, lambda x: chr(cast(ascii(x) - 31 as int))), '') else q end as qual
    from (select *, list_min(list_transform(c, lambda x: ascii(x))) as lo, list_max(list_transform(c, lambda x: ascii(x))) as hi
          from (select p_partkey, q, string_split(q, '') as c from (select p_partkey, case when p_partkey % 3 = 0 then upper(p_name) else replace(upper(p_name), ' ', 'Z') end as q from part)))""",
)
def quality_shift(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.replace(F.upper("p_name"), F.lit(" "), F.lit("Z"))).alias("q"))
    codes = F.transform(F.split("q", ""), lambda c: F.ascii(c))
    shift = rec.quality_shift(F.array_min(codes), F.array_max(codes))
    return rows.select("p_partkey", shift.alias("shift"), rec.shift_quality(F.col("q"), shift).alias("qual"))


@query("R23_plain_quality", "select p_partkey, replace(replace(p_name, 'a', '#'), '#', '!') as qual from part")
def plain_quality(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", rec.plain_quality(F.replace(F.col("p_name"), F.lit("a"), F.lit("#"))).alias("qual"))


@query(
    "R02_query_groups",
    """select l_orderkey, l_suppkey % 3 as mate, count(*) filter (l_linenumber % 4 = 1) as supplementary, count(*) filter (l_linenumber % 4 = 2) as secondary, count(*) filter (l_linenumber % 4 = 3) as both_marks,
        count(*) filter (l_linenumber % 4 = 0) > 1 as duplicate_primary, count(*) filter (l_linenumber % 4 = 0) > 0 as has_primary from lineitem group by 1, 2""",
)
def query_groups(t: Tables) -> DataFrame:
    mark = F.element_at(F.array(F.lit(0), F.lit(2048), F.lit(256), F.lit(2304)), (F.col("l_linenumber") % 4 + 1).cast("int"))
    mate = F.element_at(F.array(F.lit(0), F.lit(64), F.lit(128)), (F.col("l_suppkey") % 3 + 1).cast("int"))
    rows = al.read_group(t.lineitem.select(F.col("l_orderkey").alias("qname"), (mark + mate).alias("flag"), "l_partkey"))
    return rows.select(
        F.col("qname").alias("l_orderkey"), F.col("mate").cast("bigint").alias("mate"), *[F.size(c).cast("bigint").alias(n) for c, n in (("supplementary", "supplementary"), ("secondary", "secondary"), ("supplementary_secondary", "both_marks"))],
        "duplicate_primary", F.col("primary").isNotNull().alias("has_primary"),
    )


@query(
    "R15_low_scores",
    f"""select l_orderkey, sum({_QTY}) as score, max({_QTY}) as best from lineitem group by 1 having (sum({_QTY}) < 50 and sum({_QTY}) < 0.5 * 80) or bool_or(l_partkey % 50 = 0)""",
)
def low_scores(t: Tables) -> DataFrame:
    name = F.when(F.col("l_partkey") % 50 == 0, "decoy1").otherwise("chr1")
    rows = t.lineitem.select(F.col("l_orderkey").alias("qname"), name.alias("rname"), F.create_map(F.lit("AS"), _qty().cast("string")).alias("tags"))
    return al.badly_mapped(al.alignment_score(rows), F.lit(80)).select(F.col("qname").alias("l_orderkey"), F.col("score").cast("bigint").alias("score"), F.col("best").cast("bigint").alias("best"))


@query(
    "F01_non_reference",
    """select p_partkey, case when p_size % 4 < 3 then p_size % 4 <> 2 else p_size % 3 = 0 end as called from part""",
)
def non_reference(t: Tables) -> DataFrame:
    n = F.col("p_size") % 4
    alt = F.when(F.col("p_size") % 3 == 0, "<DEL>").when(F.col("p_size") % 3 == 1, ".").otherwise("")
    return t.part.select("p_partkey", ca.non_reference(F.when(n < 3, n.cast("string")).otherwise("."), alt).alias("called"))


@query("F02_filter", "select o_orderpriority, count(*) as n from orders where o_orderkey % 4 <> 3 group by 1")
def filtered(t: Tables) -> DataFrame:
    mark = F.element_at(F.array(F.lit("PASS"), F.lit("."), F.lit(""), F.lit("LowQ")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.where(ca.passes(mark)).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P02_section_keys",
    """select p_partkey, case when k = '' then 'unknown' else k end as key from (select p_partkey, trim(regexp_replace(trim(p_type || ' (' || p_size || '/%)'), '[^A-Za-z0-9%]+', '_', 'g'), '_') as k from part)""",
)
def section_keys(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", fields.clean_key(F.concat("p_type", F.lit(" ("), F.col("p_size").cast("string"), F.lit("/%)")), keep="%").alias("key"))


@query("P05_sample_fields", "select p_partkey, '0/1' as gt, cast(p_size as varchar) as dp, case when p_size % 2 = 0 then '99' end as gq from part")
def sample_fields(t: Tables) -> DataFrame:
    values = F.concat(F.lit("0/1:"), F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, ":99").otherwise(""))
    x = fields.sample_fields(F.lit("GT:DP:GQ"), values)
    return t.part.select("p_partkey", x["GT"].alias("gt"), x["DP"].alias("dp"), x["GQ"].alias("gq"))


@query(
    "P07_number_text",
    """select l_orderkey, l_linenumber, case when v = floor(v) then cast(cast(v as bigint) as varchar) else printf('%.4f', v) end as text
    from (select l_orderkey, l_linenumber, l_extendedprice / (l_linenumber * 2) as v from lineitem)""",
)
def numbers(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", number_text((F.col("l_extendedprice") / (F.col("l_linenumber") * 2)).cast("double")).alias("text"))


@query(
    "P09_paths",
    """select p_partkey, regexp_extract(p, '^([A-Za-z0-9+.-]+)://', 1) as protocol, case when starts_with(p, '/') or contains(p, '://') then p else '/data/in/' || p end as path
    from (select p_partkey, case p_size % 3 when 0 then 'archive://' when 1 then '/' else '' end || 'a/' || p_partkey as p from part)""",
)
def paths(t: Tables) -> DataFrame:
    p = F.concat(F.when(F.col("p_size") % 3 == 0, "archive://").when(F.col("p_size") % 3 == 1, "/").otherwise(""), F.lit("a/"), F.col("p_partkey").cast("string"))
    return t.part.select("p_partkey", fields.protocol(p).alias("protocol"), fields.with_prefix(p, "/data/in/").alias("path"))


_REGION = "case p_size % 4 when 0 then 'A' when 1 then 'F' when 2 then 'X' else 'Y' end || case when p_partkey % 2 = 0 then 'H' else '' end"


def _region():
    k = F.col("p_size") % 4
    return F.concat(F.when(k == 0, "A").when(k == 1, "F").when(k == 2, "X").otherwise("Y"), F.when(F.col("p_partkey") % 2 == 0, "H").otherwise(""))


@query("P11_region_slice", f"select p_partkey, case substr(r, 1, 1) when 'A' then 'auto' when 'F' then 'full' when 'X' then 'chrx' else 'chry' end || case when r[1] in ('X', 'Y') and ends_with(r, 'H') then 'h' else '' end as slice from (select p_partkey, {_REGION} as r from part)")
def region_slice(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", genome.region_slice(_region()).alias("slice"))


@query("P12_chromosome_group", "select p_partkey, case when p_size between 1 and 22 then 'auto' when p_size = 23 then 'chrx' when p_size = 25 then 'chrm' end as part_of from part")
def chromosome_group(t: Tables) -> DataFrame:
    n = F.col("p_size")
    name = F.concat(F.lit("chr"), F.when(n == 23, "X").when(n == 24, "Y").when(n == 25, "M").otherwise(n.cast("string")))
    return t.part.select("p_partkey", genome.chromosome_group(name).alias("part_of"))


@query("P14_read_name", "select p_partkey, 'run:' || p_partkey as name from part")
def read_names(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select("p_partkey", fields.read_name(F.concat(F.lit("@run:"), k.cast("string"), F.when(k % 3 == 0, "/1").when(k % 3 == 1, "/2 extra").otherwise(" 1:N:0:AC"))).alias("name"))


@query(
    "P15_common_stem",
    """select o_custkey, case when n > 8 then substr(a, 1, n) end as stem from (select o_custkey, a, list_max(list_filter(range(0, least(length(a), length(b)) + 1), lambda k: substr(a, 1, k) = substr(b, 1, k))) as n
        from (select o_custkey, min('sample_' || o_orderkey || '.fq') as a, max('sample_' || o_orderkey || '.fq') as b from orders group by 1))""",
)
def common_stem(t: Tables) -> DataFrame:
    names = t.orders.groupBy("o_custkey").agg(F.collect_list(F.concat(F.lit("/in/sample_"), F.col("o_orderkey").cast("string"), F.lit(".fq"))).alias("x"))
    return names.select("o_custkey", fields.common_stem("x").alias("stem"))


@query(
    "P17_durations_and_sizes",
    """select o_orderkey, case when s >= 86400 then (s // 86400) || 'd ' else '' end || lpad(cast(s % 86400 // 3600 as varchar), 2, '0') || ':' || lpad(cast(s % 3600 // 60 as varchar), 2, '0') || ':' || lpad(cast(s % 60 as varchar), 2, '0') as took,
        cast(trunc((s + 0.5) * power(1024, o_orderkey % 4)) as bigint) as size from (select o_orderkey, o_custkey * 977 as s from orders)""",
)
def durations(t: Tables) -> DataFrame:
    s = F.col("o_custkey") * 977
    unit = F.element_at(F.array(F.lit(""), F.lit("k"), F.lit(" MB"), F.lit("GiB")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select("o_orderkey", fields.duration_text(s).alias("took"), fields.size_bytes(F.concat(s.cast("string"), F.lit(".5"), unit)).alias("size"))


@query(
    "P18_phase_codes",
    """select p_partkey, (p_partkey * 37) % 1000 as pos, 1 + p_size % 3 as ref_len, 'A' as a, 'GT' as b, p_size % 2 = 0 as phased,
        list_sort(list_transform([-1000, 0, 1000], lambda d: [abs(near - near % 1000 + (p_partkey * 37) % 1000 + d - near), near - near % 1000 + (p_partkey * 37) % 1000 + d]))[1][2] as nearest
    from (select *, p_partkey * 53 + 5000 as near from part)""",
)
def phase_codes(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    text = fields.phase_text(k * 37, 1 + F.col("p_size") % 3, F.lit("A"), F.lit("GT"), F.col("p_size") % 2 == 0)
    x = fields.phase_code(text)
    return t.part.select(
        "p_partkey", x["pos"].cast("bigint").alias("pos"), x["ref_len"].cast("bigint").alias("ref_len"), x["left"].alias("a"), x["right"].alias("b"), x["phased"].alias("phased"),
        fields.nearest_position(x["pos"].cast("bigint"), k * 53 + 5000).alias("nearest"),
    )


@query(
    "I09_genome_order",
    """select p_partkey, row_number() over (order by case when p_size <= 22 then p_size when p_size = 23 then 23 when p_size = 24 then 24 when p_size = 25 then 25 else 26 end, case when p_size > 25 then 'chr' || p_size else '' end, p_partkey) as place from part""",
)
def genome_order(t: Tables) -> DataFrame:
    n = F.col("p_size")
    name = F.concat(F.lit("chr"), F.when(n == 23, "X").when(n == 24, "Y").when(n == 25, "M").otherwise(n.cast("string")))
    rows = t.part.select("p_partkey", name.alias("chrom"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + 1).alias("end"))
    # the query numbers a whole order only to make it comparable
    return rows.select("p_partkey", F.row_number().over(Window.orderBy(genome.contig_rank(F.col("chrom")), "start", "end")).cast("bigint").alias("place"))


@query(
    "I10_base_content",
    f"""select p_partkey, round(length(regexp_replace(s, '[^N]', '', 'g')) / length(s), 9) as n_share,
        round(length(regexp_replace(s, '[^CG]', '', 'g')) / nullif(length(s) - length(regexp_replace(s, '[^N]', '', 'g')), 0), 9) as gc_share
    from (select p_partkey, substr(whole, cast(p_partkey // 5 * 16 + 4 as bigint), 25) as s from part join
        (select p_partkey % 5 as c, string_agg(substr(rpad({_DNA.format('p_name')}, 16, 'N'), 1, 16), '' order by p_partkey) || repeat('N', 0) as whole from part group by 1) on c = p_partkey % 5
        where length(whole) >= p_partkey // 5 * 16 + 28)""",
)
def base_content(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    block = F.floor(k / 5)
    reference = t.part.select((k % 5).alias("chrom"), block.alias("block"), F.rpad(_dna("p_name"), 16, "N").alias("seq"))
    size = reference.groupBy("chrom").agg((F.count(F.lit(1)) * 16).alias("size"))
    rows = t.part.select("p_partkey", (k % 5).alias("chrom"), (block * 16 + 3).alias("start"), (block * 16 + 28).alias("end")).join(size, "chrom").where("end <= size")
    return iv.base_content(rows, reference, "chrom", 16).select("p_partkey", F.round("n_share", 9).alias("n_share"), F.round("gc_share", 9).alias("gc_share"))


@query(
    "I13_best_kit",
    """select arg_max(n, score - k / 1e12) as best, max(score) as score, true as differs from (select n_nationkey as k, n_name as n, count(*)::double as score from supplier join nation on s_nationkey = n_nationkey group by 1, 2)""",
)
def best_kit(t: Tables) -> DataFrame:
    scores = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("kit")).agg(F.count(F.lit(1)).cast("double").alias("score"))
    return iv.best_kit(scores, "kit", "no such kit")


@query("I15_shift_circular", "select l_orderkey, l_linenumber, (l_partkey % 500 - 1 + 500 + 173) % 500 + 1 as pos from lineitem where l_partkey % 500 > 0")
def shift_circular(t: Tables) -> DataFrame:
    return iv.shift_circular(t.lineitem.where("l_partkey % 500 > 0").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 500).alias("pos")), 173, 500)


@query(
    "S04_read_headers",
    """select p_partkey, 'M' || p_size as instrument, case when p_partkey % 3 = 0 then '7' end as run, case when p_partkey % 3 = 0 then 'FC' end as flowcell, '4' as lane,
        case p_partkey % 3 when 0 then 'ACGT' when 1 then 'TTT' end as index, case p_partkey % 3 when 2 then '1' else '2' end as pair from part""",
)
def read_headers(t: Tables) -> DataFrame:
    head = F.concat(F.lit("@M"), F.col("p_size").cast("string"))
    k = F.col("p_partkey") % 3
    name = F.when(k == 0, F.concat(head, F.lit(":7:FC:4:1:2:3 3:N:0:ACGT"))).when(k == 1, F.concat(head, F.lit(":4:1:2:3#TTT/2"))).otherwise(F.concat(head, F.lit(":4:1:2:3/1")))
    x = header_fields(name)
    return t.part.select("p_partkey", *[x[c].alias(c) for c in ("instrument", "run", "flowcell", "lane", "index", "pair")])


@query(
    "N11_adler32",
    """select p_partkey, printf('%08x', cast(((length(p_name) + list_sum(list_transform(range(1, length(p_name) + 1), lambda i: (length(p_name) - i + 1) * ascii(p_name[i])))) % 65521) * 65536
        + (1 + list_sum(list_transform(range(1, length(p_name) + 1), lambda i: ascii(p_name[i])))) % 65521 as bigint)) as adler from part""",
)
def adler(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", hashing.adler32_hex(F.col("p_name").cast("binary")).alias("adler"))
