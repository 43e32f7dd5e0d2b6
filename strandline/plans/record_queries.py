"""Flags, sequences, identifiers, k-mers and filters on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import fields, genome
from strandline.functions import records as rec
from strandline.operators import calls as ca
from strandline.operators import kmers as km
from strandline.plans.registry import Tables, query


@query(
    "R01_flags",
    """select o_orderkey, (o_orderkey & 4) <> 0 as unmapped, (o_orderkey & 16) <> 0 as reverse, (o_orderkey & 1024) <> 0 as duplicate, (o_orderkey & 2304) = 0 as is_primary from orders""",
)
def flags(t: Tables) -> DataFrame:
    f = F.col("o_orderkey")
    return t.orders.select("o_orderkey", rec.has(f, "unmapped").alias("unmapped"), rec.has(f, "reverse").alias("reverse"), rec.has(f, "duplicate").alias("duplicate"), rec.is_primary(f).alias("is_primary"))


_DNA = "translate(upper({}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789', 'ACGTACGTACGTACGTACGTACGTACNNNNNNNNNNN')"


def _dna(c: str):
    return F.translate(F.upper(c), "ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789", "ACGTACGTACGTACGTACGTACGTACNNNNNNNNNNN")


@query(
    "R03_cigar",
    """select l_orderkey, l_linenumber, cigar, cast(l_linenumber as bigint) + 3 as clipped, cast(l_quantity as bigint) as aligned, cast(l_quantity as bigint) + l_linenumber + 3 as original
    from (select *, l_linenumber || 'S' || cast(l_quantity as bigint) || 'M3H' as cigar from lineitem)""",
)
def cigar(t: Tables) -> DataFrame:
    text = F.concat(F.col("l_linenumber").cast("string"), F.lit("S"), F.col("l_quantity").cast("bigint").cast("string"), F.lit("M3H"))
    r = rec.runs(text)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", rec.runs_text(r).alias("cigar"), rec.run_totals(r)["clipped"].cast("bigint").alias("clipped"),
        rec.run_totals(r)["aligned"].cast("bigint").alias("aligned"), rec.original_length(r).cast("bigint").alias("original"),
    )


@query("R09_revcomp", f"select p_partkey, translate(reverse({_DNA.format('p_name')}), 'ACGTacgt', 'TGCAtgca') as seq from part")
def revcomp(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", rec.reverse_complement(_dna("p_name")).alias("seq"))


@query(
    "R16_motifs",
    """select doc_id, len(list_filter(f, lambda x: x = 'th')) as th, len(list_filter(f, lambda x: x = 'he')) as he from (select doc_id, regexp_extract_all(text, '(th|he)') as f from documents)""",
)
def motifs(t: Tables) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit("(th|he)"), F.lit(0))
    return t.documents.select("doc_id", F.size(F.filter(found, lambda x: x == "th")).cast("bigint").alias("th"), F.size(F.filter(found, lambda x: x == "he")).cast("bigint").alias("he"))


@query("R24_fnv")
def fnv(t: Tables) -> DataFrame:
    from strandline.functions.hashing import fnv1a64

    return t.part.select("p_partkey", fnv1a64(F.col("p_name")).alias("fnv"))


@query("R26_gc", f"select p_partkey, length(regexp_replace({_DNA.format('p_name')}, '[^CG]', '', 'g')) - 16 as gc from part")
def gc(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", rec.gc_excess(_dna("p_name")).cast("bigint").alias("gc"))


@query(
    "P01_sanitize",
    """select p_partkey, case when k = '' then 'funknown' when regexp_matches(k, '^[0-9]') then '_' || k else k end as name
    from (select p_partkey, trim(regexp_replace(lower(p_type || ' (' || p_size || '%)'), '[^a-z0-9]+', '_', 'g'), '_') as k from part)""",
)
def sanitize(t: Tables) -> DataFrame:
    raw = F.concat("p_type", F.lit(" ("), F.col("p_size").cast("string"), F.lit("%)"))
    return t.part.select("p_partkey", fields.clean_identifier(raw).alias("name"))


@query(
    "P03_casts",
    """select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k, try_cast(event_type as double) as none from events""",
)
def casts(t: Tables) -> DataFrame:
    return t.events.select("event_id", fields.whole(F.get_json_object("props", "$.k")).alias("k"), fields.real("event_type").alias("none"))


@query(
    "P04_info_map",
    """select p_partkey, p_brand as brand, cast(p_size as varchar) as size, case when p_size > 25 then '' end as big from part""",
)
def info_map(t: Tables) -> DataFrame:
    info = F.concat(F.lit("SIZE=x;BRAND="), "p_brand", F.lit(";SIZE="), F.col("p_size").cast("string"), F.when(F.col("p_size") > 25, ";BIG").otherwise(""))
    m = fields.info_map(info)
    return t.part.select("p_partkey", m["BRAND"].alias("brand"), m["SIZE"].alias("size"), m["BIG"].alias("big"))


@query(
    "P06_case",
    """select l_orderkey, l_linenumber, case when l_linenumber < 2 then 'DEL' when l_linenumber > 2 then 'DUP' else 'REF' end as svtype from lineitem""",
)
def event_type(t: Tables) -> DataFrame:
    kind = fields.event_type(F.lit("."), F.col("l_linenumber"), F.create_map(F.lit("X"), F.lit("y")))
    return t.lineitem.select("l_orderkey", "l_linenumber", kind.alias("svtype"))


@query(
    "P08_contig_order",
    """select p_partkey, row_number() over (order by case when n <= 22 then n when n = 23 then 23 when n = 24 then 24 when n = 25 then 25 else 26 end,
        case when n > 25 then 'chrUn' || n else '' end, p_partkey) as place from (select p_partkey, p_size as n from part)""",
)
def contig_order(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    n = F.col("p_size")
    name = F.when(n <= 22, F.concat(F.lit("chr"), n.cast("string"))).when(n == 23, "chrX").when(n == 24, "chrY").when(n == 25, "chrM").otherwise(F.concat(F.lit("chrUn"), n.cast("string")))
    rank = genome.contig_rank(F.col("contig"))
    rows = t.part.select("p_partkey", name.alias("contig")).select("p_partkey", rank.alias("rank"))
    # ranks are counted by value first, so only the parts of one value meet in a window
    sizes = rows.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
    base = sizes.select("rank", F.coalesce(F.sum("n").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    place = F.col("base") + F.row_number().over(Window.partitionBy("rank").orderBy("p_partkey"))
    return rows.join(base, "rank").select("p_partkey", place.alias("place"))


@query(
    "P10_regions",
    """select p_partkey, 'A' || lpad(cast(p_size as varchar), 3, '0') as region, 'F' as level0, 'A' || left(lpad(cast(p_size as varchar), 3, '0'), 1) as level1 from part""",
)
def regions(t: Tables) -> DataFrame:
    name = genome.region_name(F.lit("A"), F.lit(3), F.col("p_size"), F.lit(2))
    return t.part.select("p_partkey", name.alias("region"), genome.to_level0(name).alias("level0"), genome.to_level1(name).alias("level1"))


@query("P13_read_group", "select c_custkey, 'S_' || c_custkey || '_ACGT' as name from customer")
def read_group(t: Tables) -> DataFrame:
    raw = F.concat(F.lit("S_"), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, "_1_ACGT").otherwise("_3_ACGT"))
    return t.customer.select("c_custkey", fields.read_group_name(raw).alias("name"))


@query(
    "P16_epoch",
    """select event_id, date_diff('second', timestamp '1970-01-01', ts) as seconds from events""",
)
def epoch(t: Tables) -> DataFrame:
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    scaled = seconds * F.when(F.col("event_id") % 3 == 0, 1).when(F.col("event_id") % 3 == 1, 1000).otherwise(1_000_000)
    return t.events.select("event_id", F.unix_timestamp(fields.epoch_time(scaled)).alias("seconds"))


@query(
    "A25_kmers",
    """select lang, kmer, n from (select lang, substr(t, cast(i as bigint), 5) as kmer, count(*) as n from (
        select lang, lower(text) as t, unnest(range(1, length(text) - 3)) as i from documents where length(text) >= 5) group by 1, 2) where n >= 2""",
)
def kmers(t: Tables) -> DataFrame:
    return km.count_kmers(t.documents.select("lang", F.lower("text").alias("seq")), "seq", 5, ["lang"], canonical=False, cap=None)


_KMERS = """(select substr(p, cast(i as bigint), 4) as kmer, count(*) as n from (select p, unnest(range(1, length(p) - 2)) as i from (select upper(regexp_replace({}, '[^A-Za-z]', '', 'g')) as p from part where {})) group by 1)"""


def _part_kmers(t: Tables, column: str, cond: str) -> DataFrame:
    return km.count_kmers(t.part.where(cond).select(F.upper(F.regexp_replace(column, "[^A-Za-z]", "")).alias("seq")), "seq", 4, canonical=False, least=1, cap=None)


@query(
    "J19_kmer_setops",
    f"""select 'both' as kind, a.kmer, a.n as n from {_KMERS.format('p_name', 'true')} a where a.kmer in (select kmer from {_KMERS.format('p_type', 'true')})
    union all select 'sum', kmer, sum(n)::bigint from (select * from {_KMERS.format('p_name', 'true')} union all select * from {_KMERS.format('p_type', 'true')}) group by kmer
    union all select 'expected', b.kmer, coalesce(a.n, 0) + 1 from {_KMERS.format('p_type', 'true')} b left join {_KMERS.format('p_name', 'p_size > 25')} a on a.kmer = b.kmer""",
)
def kmer_sets(t: Tables) -> DataFrame:
    a, b, c = _part_kmers(t, "p_name", "true"), _part_kmers(t, "p_type", "true"), _part_kmers(t, "p_name", "p_size > 25")
    named = lambda df, kind: df.select(F.lit(kind).alias("kind"), "kmer", F.col("n").cast("bigint").alias("n"))
    return named(km.intersect_left(a, b), "both").unionByName(named(km.union_sum(a, b), "sum")).unionByName(named(km.with_absent(c, b), "expected"))


@query(
    "F03_conjunction",
    """select l_orderkey, l_linenumber from lineitem where l_linenumber <> 2 and l_returnflag not in ('A') and l_linestatus in ('F') and l_extendedprice >= 50 and nullif(l_linenumber, 3) >= 2 and l_quantity * 100 >= 1000""",
)
def conjunction(t: Tables) -> DataFrame:
    call = F.struct(
        F.col("l_returnflag").alias("contig"), F.lit(0.0).alias("start"), (F.col("l_quantity") * 100).alias("end"), F.col("l_linenumber").alias("copies"), F.lit(".").alias("alt"),
        F.when(F.col("l_linestatus") == "F", "PASS").otherwise("LowQ").alias("filter"), F.col("l_extendedprice").alias("qs"), F.nullif(F.col("l_linenumber"), F.lit(3)).alias("np"),
    )
    return t.lineitem.where(ca.high_confidence(call, excluded=("A",))).select("l_orderkey", "l_linenumber")


@query(
    "F11_variant_kind",
    """select p_partkey, case when length(r) = 1 and length(a) = 1 then 'SNP' when length(r) <> length(a) then 'INDEL' else 'OTHER' end as kind
    from (select p_partkey, left(p_name, 0) || repeat('A', p_size % 3 + 1) as r, repeat('C', p_size % 2 + 1) as a from part)""",
)
def variant_kind(t: Tables) -> DataFrame:
    ref, alt = F.repeat(F.lit("A"), F.col("p_size") % 3 + 1), F.repeat(F.lit("C"), F.col("p_size") % 2 + 1)
    return t.part.select("p_partkey", rec.kind_of_variant(ref, F.array(alt)).alias("kind"))
