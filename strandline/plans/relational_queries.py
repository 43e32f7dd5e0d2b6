"""Joins, ordered folds, set operations and reshapes on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import calls as ca
from strandline.operators import genotypes as gt
from strandline.operators import qc
from strandline.operators import samples as sm
from strandline.plans.registry import Tables, query


@query(
    "J01_gather",
    """select c_custkey, c_name, orders, round(total, 2) as total, items, flags from customer
    join (select o_custkey, count(*) as orders, sum(o_totalprice) as total from orders group by 1) o on o.o_custkey = c_custkey
    join (select o_custkey, count(*) as items, count(distinct l_returnflag) as flags from lineitem join orders on l_orderkey = o_orderkey group by 1) l on l.o_custkey = c_custkey""",
)
def gather(t: Tables) -> DataFrame:
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    items = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("items"), F.countDistinct("l_returnflag").alias("flags"))
    return qc.gather(t.customer.select("c_custkey", "c_name"), [orders, items], ["c_custkey"])


@query(
    "J01_missing_inputs",
    """select c_custkey, 'orders' as "table" from customer where c_custkey not in (select o_custkey from orders)""",
)
def missing(t: Tables) -> DataFrame:
    return qc.missing_inputs(t.customer.select("c_custkey"), {"orders": t.orders.select(F.col("o_custkey").alias("c_custkey"))}, ["c_custkey"])


_HALF = "select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as total from orders where o_orderkey % 2 = {} group by 1"


@query(
    "J04_sample_comparison",
    f"""select coalesce(a.o_custkey, b.o_custkey) as o_custkey, case when a.n is null then 'right_only' when b.n is null then 'left_only' else 'both' end as status,
        a.n as left_n, b.n as right_n, b.n - a.n as delta_n, round(b.total - a.total, 2) as delta_total from ({_HALF.format(0)}) a full join ({_HALF.format(1)}) b using (o_custkey)""",
)
def sample_comparison(t: Tables) -> DataFrame:
    half = lambda k: t.orders.where(f"o_orderkey % 2 = {k}").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    out = ca.compare_samples(half(0), half(1), "o_custkey", ["n", "total"])
    return out.select("o_custkey", "status", "left_n", "right_n", "delta_n", F.round("delta_total", 2).alias("delta_total"))


@query(
    "J12_count_compare",
    """select k, a.n as n_left, b.n as n_right, case when a.n is null then 'extra' when b.n is null then 'missing' when b.n > a.n then 'duplicated' else 'fewer' end as kind
    from (select l_partkey as k, count(*) as n from lineitem where l_returnflag = 'N' group by 1) a full join (select l_partkey as k, count(*) as n from lineitem where l_returnflag = 'R' group by 1) b using (k)
    where a.n is distinct from b.n""",
)
def count_compare(t: Tables) -> DataFrame:
    side = lambda f: t.lineitem.where(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("k"))
    return qc.compare_counts(side("N"), side("R"), "k")


@query(
    "J14_annotate",
    """select l_orderkey, l_linenumber, p_brand as part_brand, s_name as supplier_name from lineitem left join (select * from part where p_size > 10) p on p_partkey = l_partkey
    left join (select * from supplier where s_acctbal > 0) s on s_suppkey = l_suppkey""",
)
def annotate(t: Tables) -> DataFrame:
    parts = t.part.where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    suppliers = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("name"))
    out = gt.annotate(gt.annotate(t.lineitem, {"part": parts}, ("l_partkey",)), {"supplier": suppliers}, ("l_suppkey",))
    return out.select("l_orderkey", "l_linenumber", "part_brand", "supplier_name")


@query(
    "F04_exclusions",
    """select 'kept' as state, c_custkey from customer where c_custkey % 7 <> 0 union all select 'excluded', c_custkey from customer where c_custkey % 7 = 0
    union all select 'missing', n_nationkey + 10000000 from nation""",
)
def exclusions(t: Tables) -> DataFrame:
    listed = t.customer.where("c_custkey % 7 = 0").select("c_custkey", F.lit("odd").alias("reason")).unionByName(t.nation.select((F.col("n_nationkey") + F.lit(10_000_000)).cast("bigint").alias("c_custkey"), F.lit("odd").alias("reason")))
    parts = dict(zip(("kept", "excluded", "missing"), sm.apply_exclusions(t.customer.select("c_custkey"), listed, "c_custkey")))
    out = None
    for state, df in parts.items():
        one = df.select(F.lit(state).alias("state"), "c_custkey")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "W02_batches",
    """with recursive o as (select o_custkey, o_orderkey, o_totalprice as s, row_number() over (partition by o_custkey order by o_orderkey) as i from orders),
        b as (select o_custkey, o_orderkey, i, s as used, 1 as batch from o where i = 1 union all
            select o.o_custkey, o.o_orderkey, o.i, case when b.used + o.s > 500000 then o.s else b.used + o.s end, case when b.used + o.s > 500000 then b.batch + 1 else b.batch end
            from b join o on o.o_custkey = b.o_custkey and o.i = b.i + 1)
    select o_custkey, o_orderkey, batch from b""",
)
def batches(t: Tables) -> DataFrame:
    return sm.batches(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_orderkey", "o_totalprice", 500_000).select("o_custkey", "o_orderkey", "batch")


@query(
    "W05_suffix",
    """select o_orderkey, case when r > 1 then o_orderpriority || '.' || r else o_orderpriority end as name from (select *, row_number() over (partition by o_custkey, o_orderpriority order by o_orderkey) as r from orders)""",
)
def suffix(t: Tables) -> DataFrame:
    return sm.disambiguate(t.orders, ["o_custkey"], "o_orderpriority", "o_orderkey").select("o_orderkey", F.col("o_orderpriority").alias("name"))


@query(
    "W06_forward_fill",
    """select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (partition by user_id order by event_id rows unbounded preceding) as last_purchase from events""",
)
def forward_fill(t: Tables) -> DataFrame:
    rows = t.events.withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return sm.fill_forward(rows, ["user_id"], "event_id", "v", "last_purchase").select("event_id", "last_purchase")


@query("W07_first", "select user_id, min(event_id) as event_id from events group by 1")
def first(t: Tables) -> DataFrame:
    return sm.first_by(t.events, ["user_id"], "event_id").select("user_id", "event_id")


@query("W08_index", "select c_custkey, row_number() over (partition by c_nationkey order by c_custkey) - 1 as index from customer")
def index(t: Tables) -> DataFrame:
    from strandline.operators.cohort import sample_index

    return sample_index(t.customer, "c_nationkey", "c_custkey").select("c_custkey", F.col("index").cast("bigint").alias("index"))


@query(
    "W09_jump",
    """with recursive e as (select user_id, event_id, cast(floor(value) as bigint) as pos, row_number() over (partition by user_id order by cast(floor(value) as bigint), event_id) as i from events),
        r as (select user_id, event_id, i, pos as last, true as accepted from e where i = 1 union all
            select e.user_id, e.event_id, e.i, case when e.pos - r.last <= 5 then e.pos else r.last end, e.pos - r.last <= 5 from r join e on e.user_id = r.user_id and e.i = r.i + 1)
    select event_id, accepted from r""",
)
def jump(t: Tables) -> DataFrame:
    from strandline.operators.phasing import accept_variants

    rows = t.events.select("user_id", F.floor("value").alias("pos"), F.col("event_id").alias("id"))
    return accept_variants(rows, ["user_id"], 5).select(F.col("id").alias("event_id"), "accepted")


@query("S32_first_assignment", "select user_id, arg_min(event_type, event_id) as event_type from events group by 1")
def first_assignment(t: Tables) -> DataFrame:
    return sm.first_by(t.events, ["user_id"], "event_id").select("user_id", "event_type")


@query("U01_union", "select n_name as name, n_nationkey as k from nation union all select r_name, r_regionkey from region")
def union(t: Tables) -> DataFrame:
    return sm.concatenate([t.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("k")), t.region.select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("k"))])


@query("U02_keys", "select o_custkey as k from orders union select c_custkey from customer")
def key_union(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("k")).union(t.customer.select("c_custkey")).distinct()


@query(
    "U03_setdiff",
    """select 'both' as "where", k from (select l_partkey as k from lineitem where l_returnflag = 'R' intersect select l_partkey from lineitem where l_returnflag = 'A')
    union all select 'left_only', k from (select l_partkey as k from lineitem where l_returnflag = 'R' except select l_partkey from lineitem where l_returnflag = 'A')
    union all select 'right_only', k from (select l_partkey as k from lineitem where l_returnflag = 'A' except select l_partkey from lineitem where l_returnflag = 'R')""",
)
def setdiff(t: Tables) -> DataFrame:
    side = lambda f: t.lineitem.where(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("k"))
    return ca.call_sets(side("R"), side("A"), "k").select("where", "k")


@query("U04_split_merge", "select p_partkey, case when p_size <= 10 then 'snp' when p_size <= 30 then 'indel' else 'mix' end as part from part")
def split_merge(t: Tables) -> DataFrame:
    cut = {"snp": "p_size <= 10", "indel": "p_size > 10 and p_size <= 30", "mix": "p_size > 30"}
    return sm.concatenate([t.part.where(c).select("p_partkey", F.lit(k).alias("part")) for k, c in cut.items()])


@query("U05_distinct", "select distinct l_partkey, l_suppkey from lineitem")
def distinct(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey").dropDuplicates()


@query("U07_dedup", "select min(doc_id) as doc_id from documents group by text")
def dedup(t: Tables) -> DataFrame:
    # texts are compared by two independent 64-bit hashes, so the shuffle carries no text
    rows = t.documents.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.reverse("text"), F.length("text")).alias("h2"))
    return rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@query(
    "X01_pivot",
    """pivot (select o_orderstatus, left(o_orderpriority, 1) as p from orders) on p in ('1', '2', '3', '4', '5') using count(*) group by o_orderstatus""",
)
def pivot(t: Tables) -> DataFrame:
    return t.orders.withColumn("prio", F.left("o_orderpriority", F.lit(1))).groupBy("o_orderstatus").pivot("prio", ["1", "2", "3", "4", "5"]).count().na.fill(0)


@query("X02_unpivot", "unpivot (select s_suppkey, cast(s_nationkey as double) as nation, s_acctbal as balance from supplier) on nation, balance into name metric value value")
def unpivot(t: Tables) -> DataFrame:
    from strandline.operators.stats import long_metrics

    return long_metrics(t.supplier.withColumnsRenamed({"s_nationkey": "nation", "s_acctbal": "balance"}), ["s_suppkey"], ["nation", "balance"])


@query("X03_explode", "select vec_id, i - 1 as i, cast(embedding[i] as double) as v from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings)")
def explode(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("i", "v")).select("vec_id", F.col("i").cast("bigint").alias("i"), F.col("v").cast("double").alias("v"))


@query(
    "A26_multiallelic",
    """select o_orderkey, 2 as nma_alt, round(1 - (a + b) / 100.0, 9) as ma_ref_af, ((1 - (a + b) / 100.0) < a / 100.0)::int + ((1 - (a + b) / 100.0) < b / 100.0)::int as ma_reflow_count
    from (select o_orderkey, o_orderkey % 50 as a, o_custkey % 50 as b from orders)""",
)
def multiallelic(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.array(F.lit("A"), F.lit("C")).alias("alts"), F.array(F.col("o_orderkey") % 50, F.col("o_custkey") % 50).alias("ac"), F.lit(100).alias("an"))
    return gt.multiallelic(rows).select("o_orderkey", "nma_alt", F.round("ma_ref_af", 9).alias("ma_ref_af"), "ma_reflow_count")


@query(
    "X04_split_alleles",
    """select o_orderkey, 'A' as alt, o_orderkey % 50 as ac, [0, 1, 2] as pl from orders union all select o_orderkey, 'C', o_custkey % 50, [0, 3, 5] from orders""",
)
def split_alleles(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", F.array(F.lit("A"), F.lit("C")).alias("alts"), F.array(F.col("o_orderkey") % 50, F.col("o_custkey") % 50).alias("ac"), F.array(*[F.lit(i) for i in range(6)]).alias("pl")
    )
    return gt.split_alleles(rows, per_alt=("ac",), per_genotype=("pl",)).select("o_orderkey", "alt", "ac", "pl")


@query("A30_duplicates", "select l_orderkey, l_linenumber, row_number() over (partition by l_partkey, l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber) > 1 as duplicate from lineitem")
def duplicates(t: Tables) -> DataFrame:
    from strandline.operators.alignments import mark_duplicates

    rows = t.lineitem.withColumn("ord", F.struct("l_orderkey", "l_linenumber"))
    return mark_duplicates(rows, ["l_partkey", "l_suppkey"], "l_extendedprice", "ord").select("l_orderkey", "l_linenumber", "duplicate")


@query("J03_left_label", "select c_custkey, coalesce(n, -1) as cluster from customer left join (select o_custkey, count(*) as n from orders where o_totalprice > 200000 group by 1) on o_custkey = c_custkey")
def left_label(t: Tables) -> DataFrame:
    from strandline.operators.cohort import with_labels

    labels = t.orders.where("o_totalprice > 200000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("cluster"))
    return with_labels(t.customer.select("c_custkey"), labels, "c_custkey")



@query("F06_finite_regions", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_partkey not in (select l_partkey from lineitem where l_discount < 0.005)")
def finite_regions(t: Tables) -> DataFrame:
    from strandline.operators.cohort import usable_regions

    cube = t.lineitem.withColumn("cov", F.when(F.col("l_discount") < 0.005, float("nan")).otherwise(F.col("l_discount")))
    return usable_regions(cube, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "F12_minor_alleles",
    """select o_orderkey from (select o_orderkey, o_orderkey % 50 as a, o_custkey % 50 as b from orders) where 100 - greatest(a, b, 100 - a - b) >= 60""",
)
def minor_alleles(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.array(F.col("o_orderkey") % 50, F.col("o_custkey") % 50).alias("ac"), F.lit(100).cast("bigint").alias("an"))
    return gt.minor_alleles(rows, least=60).select("o_orderkey")


@query("F13_small_to_zero", "select l_orderkey, l_linenumber, case when l_discount < 0.03 then 0.0 else l_discount end as used from lineitem")
def small_to_zero(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_discount") < 0.03, 0.0).otherwise(F.col("l_discount")).alias("used"))


@query("J13_record_compare", "select distinct l_orderkey as qname from lineitem where l_partkey % 100 = 0")
def record_compare(t: Tables) -> DataFrame:
    from strandline.operators.alignments import compare_tables

    left = t.lineitem.select(F.col("l_orderkey").alias("qname"), "l_linenumber", "l_partkey", "l_quantity")
    right = left.withColumn("l_quantity", F.when(F.col("l_partkey") % 100 == 0, F.col("l_quantity") + 1000).otherwise(F.col("l_quantity")))
    return compare_tables({"left": left, "right": right}, ["l_linenumber", "l_partkey", "l_quantity"]).select("qname")


@query(
    "J10_leftovers",
    """select o_orderkey as qname, case when l_orderkey is null then 'lost' else 'aligned' end as state from orders left join (select distinct l_orderkey from lineitem where l_quantity > 30) on l_orderkey = o_orderkey""",
)
def leftovers(t: Tables) -> DataFrame:
    reads = t.orders.select(F.col("o_orderkey").alias("qname"))
    hit = t.lineitem.where("l_quantity > 30").select(F.col("l_orderkey").alias("qname"))
    return reads.join(hit, "qname", "left_semi").withColumn("state", F.lit("aligned")).unionByName(reads.join(hit, "qname", "left_anti").withColumn("state", F.lit("lost")))


@query("O03_loci_order", "select l_partkey, count(distinct l_suppkey) as samples from lineitem group by 1 order by samples desc, l_partkey limit 20")
def loci_order(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("samples")).orderBy(F.desc("samples"), "l_partkey").limit(20)


@query(
    "N10_cohort_assignment",
    """select c_custkey, case when n >= 0 then cast(n as varchar) end as cohort, case when n >= 0 then 'cluster' else 'unassigned' end as assignment
    from (select c_custkey, coalesce(n, -1) as n from customer left join (select o_custkey, count(*) as n from orders where o_totalprice > 250000 group by 1) on o_custkey = c_custkey)""",
)
def cohort_assignment(t: Tables) -> DataFrame:
    from strandline.operators.cohort import assign_cohorts

    labels = t.orders.where("o_totalprice > 250000").groupBy(F.col("o_custkey").alias("sample")).agg(F.count(F.lit(1)).alias("cluster"))
    out = assign_cohorts(t.customer.select(F.col("c_custkey").alias("sample")), labels, "error")
    return out.select(F.col("sample").alias("c_custkey"), "cohort", "assignment")
