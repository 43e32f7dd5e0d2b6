"""Summaries, grouping sets, percentiles and flags on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators import calls as ca
from strandline.operators import qc
from strandline.operators import stats as st
from strandline.plans.registry import Tables, query


def _rounded(df: DataFrame, digits: int = 6, *keep: str) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" and c not in keep else F.col(c) for c, kind in df.dtypes])


@query(
    "A02_numeric_summary",
    """select o_orderpriority, count(*) as count, min(o_totalprice) as min, round(quantile_cont(o_totalprice, 0.1), 6) as q10,
        round(quantile_cont(o_totalprice, 0.25), 6) as q25, round(quantile_cont(o_totalprice, 0.5), 6) as median, round(quantile_cont(o_totalprice, 0.75), 6) as q75,
        round(quantile_cont(o_totalprice, 0.9), 6) as q90, max(o_totalprice) as max, round(avg(o_totalprice), 4) as mean,
        round(coalesce(stddev_samp(o_totalprice), 0), 4) as stdev, round(mad(o_totalprice), 6) as mad from orders group by 1""",
)
def numeric_summary(t: Tables) -> DataFrame:
    out = st.summary(t.orders, ["o_orderpriority"], "o_totalprice")
    return _rounded(out).withColumns({"mean": F.round("mean", 4), "stdev": F.round("stdev", 4)})


@query(
    "A03_metric_rows",
    """unpivot (select o_orderkey, o_totalprice as price, cast(o_custkey as double) as customer from orders) on price, customer into name metric value value""",
)
def metric_rows(t: Tables) -> DataFrame:
    return st.long_metrics(t.orders.withColumnsRenamed({"o_totalprice": "price", "o_custkey": "customer"}), ["o_orderkey"], ["price", "customer"])


@query(
    "A05_conditional",
    """select l_suppkey, count(*) as raw_calls, count(*) filter (l_discount < 0.05) as calls,
        count(*) filter (l_discount < 0.05 and l_returnflag = 'R') as dels, count(*) filter (l_discount < 0.05 and l_returnflag = 'A') as dups,
        coalesce(sum(cast(l_quantity as bigint)) filter (l_discount < 0.05), 0)::bigint as bases, coalesce(sum(l_linenumber) filter (l_discount < 0.05), 0)::bigint as intervals,
        round(avg(l_extendedprice) filter (l_discount < 0.05), 4) as mean_qs, quantile_cont(cast(l_quantity as bigint), 0.5) filter (l_discount < 0.05) as median_length
    from lineitem group by 1""",
)
def conditional(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_suppkey", F.when(F.col("l_returnflag") == "R", "DEL").when(F.col("l_returnflag") == "A", "DUP").otherwise("REF").alias("svtype"),
        (F.col("l_discount") < 0.05).alias("confident"), F.lit(0).cast("bigint").alias("start"), F.col("l_quantity").cast("bigint").alias("end"),
        F.col("l_extendedprice").alias("qs"), F.col("l_linenumber").alias("np"), F.col("l_linenumber").alias("copies"),
    )
    out = ca.segment_summary(rows, ["l_suppkey"])
    return out.select("l_suppkey", "raw_calls", "calls", "dels", "dups", "bases", "intervals", F.round("mean_qs", 4).alias("mean_qs"), "median_length")


@query(
    "A06_type_summary",
    """select l_linestatus, l_returnflag as svtype, count(*) as calls, count(distinct l_suppkey) as samples, sum(cast(l_quantity as bigint))::bigint as bases,
        count(*) filter (l_linenumber = 0) as copies_0, count(*) filter (l_linenumber = 1) as copies_1, count(*) filter (l_linenumber = 2) as copies_2,
        count(*) filter (l_linenumber = 3) as copies_3, count(*) filter (l_linenumber = 4) as copies_4, count(*) filter (l_linenumber = 5) as copies_5
    from lineitem group by 1, 2""",
)
def type_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_linestatus", F.col("l_returnflag").alias("svtype"), F.col("l_suppkey").alias("sample"), F.lit(0).cast("bigint").alias("start"), F.col("l_quantity").cast("bigint").alias("end"), F.col("l_linenumber").alias("copies"))
    return ca.type_summary(rows, ["l_linestatus"])


@query(
    "A07_rate",
    """select c.c_nationkey as contig, count(*) as calls, count(distinct o_custkey) as samples, any_value(length) as length, round(count(*) * 1e6 / any_value(length), 6) as per_mb
    from orders join customer c on o_custkey = c_custkey left join (select n_nationkey, 1000000 + n_nationkey * 10000 as length from nation) n on n.n_nationkey = c.c_nationkey group by 1""",
)
def rate(t: Tables) -> DataFrame:
    calls = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("contig"), F.col("o_custkey").alias("sample"))
    contigs = t.nation.select(F.col("n_nationkey").alias("contig"), (1_000_000 + F.col("n_nationkey") * 10_000).alias("length"))
    return ca.contig_summary(calls, contigs, []).withColumn("per_mb", F.round("per_mb", 6)).select("contig", "calls", "samples", "length", "per_mb")


@query(
    "A08_size_groups",
    """select r_name, c_mktsegment, count(*) as n, round(avg(c_acctbal), 4) as mean, round(quantile_cont(c_acctbal, 0.5), 6) as median
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by grouping sets ((r_name, c_mktsegment), (c_mktsegment))""",
)
def size_groups(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupingSets([[F.col("r_name"), F.col("c_mktsegment")], [F.col("c_mktsegment")]], F.col("r_name"), F.col("c_mktsegment")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"), F.round(F.percentile("c_acctbal", F.lit(0.5)), 6).alias("median")
    )


@query(
    "A09_bins",
    """select l_returnflag, count(*) as n, round(avg(l_discount), 6) as mean, count(*) filter (l_discount >= 0 and l_discount < 0.01) as bin_0,
        count(*) filter (l_discount >= 0.01 and l_discount < 0.05) as bin_1, count(*) filter (l_discount >= 0.05 and l_discount < 0.1) as bin_2,
        count(*) filter (l_discount >= 0.1 and l_discount < 0.5) as bin_3, count(*) filter (l_discount >= 0.5 and l_discount < 1.000000001) as bin_4 from lineitem group by 1""",
)
def bins(t: Tables) -> DataFrame:
    return ca.frequency_bins(t.lineitem.withColumn("l_discount", F.col("l_discount").cast("string")), ["l_returnflag"], "l_discount").withColumn("mean", F.round("mean", 6))


@query(
    "A10_weighted_mean",
    """select l_returnflag, round(sum(l_extendedprice * l_quantity) / greatest(sum(l_quantity), 1e-6), 4) as mean, string_agg(n, ';' order by l_linenumber) as counts from (
        select l_returnflag, l_linenumber, cast(count(*) as varchar) as n, sum(l_extendedprice * l_quantity) / sum(l_quantity) as l_extendedprice, sum(l_quantity) as l_quantity from lineitem group by 1, 2) group by 1""",
)
def weighted_mean(t: Tables) -> DataFrame:
    steps = t.lineitem.groupBy("l_returnflag", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), (F.sum(F.col("l_extendedprice") * F.col("l_quantity")) / F.sum("l_quantity")).alias("x"), F.sum("l_quantity").alias("w"))
    return steps.groupBy("l_returnflag").agg(F.round(st.weighted_mean(F.col("x"), F.col("w")), 4).alias("mean"), st.packed(F.col("l_linenumber"), F.col("n")).alias("counts"))


@query(
    "A11_group_burden",
    """unpivot (select n_name as cohort, c_mktsegment as samplefile, cast(count(*) as double) as samples, round(sum(c_acctbal), 2) as total, max(c_acctbal) as highest
        from customer join nation on c_nationkey = n_nationkey group by grouping sets ((), (n_name), (c_mktsegment))) on samples, total, highest into name metric value value""",
)
def group_burden(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumnsRenamed({"n_name": "cohort", "c_mktsegment": "samplefile"})
    sums = rows.groupingSets([[], [F.col("cohort")], [F.col("samplefile")]], F.col("cohort"), F.col("samplefile")).agg(
        F.count(F.lit(1)).alias("samples"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.max("c_acctbal").alias("highest")
    )
    return st.long_metrics(sums, ["cohort", "samplefile"], ["samples", "total", "highest"])


@query(
    "A12_interval_summary",
    """with r as (select l_returnflag, l_linestatus, l_linenumber as copies, l_discount as cnq, list_sort([l_tax, l_discount, l_quantity]) as g from lineitem)
    select l_returnflag, l_linestatus, count(*) as intervals, count(*) filter (copies = 0) as copies_0, count(*) filter (copies = 1) as copies_1, count(*) filter (copies = 2) as copies_2,
        count(*) filter (copies = 3) as copies_3, count(*) filter (copies = 4) as copies_4, round(avg(cnq), 6) as mean_cnq, round(avg(g[2] - g[1]), 6) as mean_gap
    from r group by grouping sets ((l_returnflag), (l_returnflag, l_linestatus))""",
)
def interval_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_returnflag", "l_linestatus", F.col("l_linenumber").alias("copies"), F.col("l_discount").alias("cnq"), F.array("l_tax", "l_discount", "l_quantity").alias("cnlp"))
    return _rounded(ca.interval_summary(rows, [["l_returnflag"], ["l_returnflag", "l_linestatus"]]))


@query(
    "A13_fractions",
    """select l_linestatus, count(*) as bins, 0::bigint as nonfinite, round(avg(r), 6) as mean, round(quantile_cont(r, 0.5), 6) as median, round(avg((r < 0.5)::int), 6) as under_half,
        round(avg((r < 1.5)::int), 6) as under_one_and_half, round(avg((r > 2.5)::int), 6) as over_two_and_half, round(avg((r > 3.5)::int), 6) as over_three_and_half
    from (select l_linestatus, l_quantity / 12.5 as r from lineitem) group by 1""",
)
def fractions(t: Tables) -> DataFrame:
    return _rounded(ca.ratio_summary(t.lineitem.select("l_linestatus", (F.col("l_quantity") / 12.5).alias("ratio")), ["l_linestatus"]))


@query(
    "A14_weighted_percentile",
    """with s as (select l_returnflag, l_extendedprice as v, sum(l_quantity) as w from lineitem group by 1, 2),
        c as (select *, sum(w) over (partition by l_returnflag order by v rows unbounded preceding) as run, sum(w) over (partition by l_returnflag) as total from s)
    select l_returnflag, min(v) filter (run >= total * 0.025) as p2_5, min(v) filter (run >= total * 0.25) as p25, min(v) filter (run >= total * 0.5) as p50,
        min(v) filter (run >= total * 0.75) as p75, min(v) filter (run >= total * 0.975) as p97_5 from c group by 1""",
)
def weighted_percentile(t: Tables) -> DataFrame:
    shares = {"p2_5": 0.025, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p97_5": 0.975}
    return st.weighted_percentiles(t.lineitem, ["l_returnflag"], "l_extendedprice", "l_quantity", shares)


@query(
    "A15_thresholds",
    """select l_linestatus, sum(case when l_quantity > 10 then l_linenumber else 0 end)::bigint as above_10, sum(case when l_quantity > 20 then l_linenumber else 0 end)::bigint as above_20,
        sum(case when l_quantity > 30 then l_linenumber else 0 end)::bigint as above_30 from lineitem group by 1""",
)
def thresholds(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linestatus").agg(*st.threshold_counts("l_quantity", [10, 20, 30], F.col("l_linenumber")))


@query(
    "A16_substitutions",
    """pivot (select l_shipyear, l_returnflag || '_' || l_linestatus as kind, 1 as n from (select *, year(l_shipdate) as l_shipyear from lineitem)) on kind in ('A_F', 'N_F', 'N_O', 'R_F') using coalesce(sum(n), 0)::bigint group by l_shipyear""",
)
def substitutions(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.year("l_shipdate").cast("bigint").alias("l_shipyear"), F.concat_ws("_", "l_returnflag", "l_linestatus").alias("kind"))
    return rows.groupBy("l_shipyear").pivot("kind", ["A_F", "N_F", "N_O", "R_F"]).count().na.fill(0)


@query(
    "A17_metric_rollup",
    """select c_custkey, coalesce(orders, 0) as orders, round(coalesce(total, 0), 2) as total, coalesce(items, 0) as items, round(coalesce(items, 0) / nullif(coalesce(orders, 0), 0), 9) as items_per_order
    from customer left join (select o_custkey, count(*) as orders, sum(o_totalprice) as total from orders group by 1) o on o_custkey = c_custkey
    left join (select o_custkey as k, count(*) as items from lineitem join orders on l_orderkey = o_orderkey group by 1) l on k = c_custkey""",
)
def metric_rollup(t: Tables) -> DataFrame:
    orders = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total")).withColumnRenamed("o_custkey", "c_custkey")
    items = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("items")).withColumnRenamed("o_custkey", "c_custkey")
    return qc.gather(t.customer.select("c_custkey"), [orders, items], ["c_custkey"], "left", {"orders": 0, "total": 0.0, "items": 0}).select(
        "c_custkey", "orders", F.round("total", 2).alias("total"), "items", F.round(F.try_divide("items", "orders"), 9).alias("items_per_order")
    )


@query(
    "A18_mixed_agg",
    """select p_brand, sum(p_size)::bigint as p_size, max(p_retailprice) as p_retailprice, arg_min(p_type, p_partkey) as p_type from part group by 1""",
)
def mixed(t: Tables) -> DataFrame:
    rows = t.part.select("p_brand", "p_partkey", "p_size", "p_retailprice", "p_type")
    return st.mixed_aggregate(rows, ["p_brand"], F.col("p_partkey"), ("p_retailprice",)).select("p_brand", "p_size", "p_retailprice", "p_type")


@query(
    "A19_rollup",
    """select c_mktsegment, n_name, sum(o) as total, max(o) as highest, min(nullif(o, 0)) as least_positive from (
        select c_custkey, c_mktsegment, n_name, count(o_orderkey) as o from customer join nation on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by 1, 2, 3)
    group by rollup (c_mktsegment, n_name)""",
)
def rollup(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("o"))
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(counts, F.col("o_custkey") == F.col("c_custkey"), "left").withColumn("o", F.coalesce("o", F.lit(0)))
    return qc.add_up(rows, ["c_mktsegment", "n_name"], "o")


@query(
    "A20_argmax_first",
    """select p_brand, p_partkey, p_name, p_retailprice from (select *, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as r from part) where r = 1""",
)
def argmax_first(t: Tables) -> DataFrame:
    return st.arg_first(t.part, ["p_brand"], F.col("p_retailprice"), F.col("p_partkey")).select("p_brand", "p_partkey", "p_name", "p_retailprice")


@query(
    "A21_xor_checksum",
    """select l_linestatus, bit_xor(l_orderkey * 8 + l_linenumber) as checksum, count(*) as n from lineitem group by 1""",
)
def xor_checksum(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linestatus").agg(F.bit_xor(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("checksum"), F.count(F.lit(1)).alias("n"))


@query(
    "A22_reconcile",
    """select a.k = b.k as keys_match, a.n = b.n as counts_match, a.k = b.k and a.n = b.n as compare_all from
        (select bit_xor(o_orderkey) as k, count(*) as n from orders) a,
        (select bit_xor(l_orderkey) as k, count(*) as n from (select distinct l_orderkey from lineitem)) b""",
)
def reconcile(t: Tables) -> DataFrame:
    a = t.orders.agg(F.bit_xor("o_orderkey").alias("checksum"), F.count(F.lit(1)).alias("count"))
    b = t.lineitem.select("l_orderkey").distinct().agg(F.bit_xor("l_orderkey").alias("checksum"), F.count(F.lit(1)).alias("count"))
    return qc.reconcile(a, b)


@query(
    "A23_ratio_of_weighted_means",
    """select round(2 * (sum(l_extendedprice * l_quantity) filter (l_returnflag = 'R') / sum(l_quantity) filter (l_returnflag = 'R'))
        / (sum(l_extendedprice * l_quantity) filter (l_returnflag <> 'R') / sum(l_quantity) filter (l_returnflag <> 'R')), 9) as ratio from lineitem""",
)
def ratio(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag") == "R"
    return st.ratio_of_means(t.lineitem, flag, ~flag, F.col("l_extendedprice"), F.col("l_quantity"), 2.0).select(F.round("ratio", 9).alias("ratio"))


@query(
    "A27_phred",
    """select l_suppkey, sum((l_returnflag = 'R')::int)::bigint as errors, count(*) as total,
        round(case when sum((l_returnflag = 'R')::int) = 0 then 100 else least(100, -10 * log10(sum((l_returnflag = 'R')::int) / count(*))) end, 6) as q from lineitem group by 1""",
)
def phred(t: Tables) -> DataFrame:
    rows = t.lineitem.groupBy("l_suppkey").agg(F.sum((F.col("l_returnflag") == "R").cast("bigint")).alias("errors"), F.count(F.lit(1)).alias("total"))
    return rows.withColumn("q", F.round(st.phred(F.col("errors"), F.col("total")), 6))


@query(
    "A29_ledger",
    """select o_orderstatus as status, count(*) as files, round(sum(o_totalprice), 2) as bytes from orders group by 1""",
)
def ledger(t: Tables) -> DataFrame:
    return qc.ledger(t.orders, "o_orderstatus", "o_totalprice").select("status", "files", F.round("bytes", 2).alias("bytes"))


@query(
    "N05_regression",
    """select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) as slope, round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept,
        round(corr(l_extendedprice, l_quantity), 8) as r from lineitem group by 1""",
)
def regression(t: Tables) -> DataFrame:
    out = t.lineitem.groupBy("l_returnflag").agg(*st.regression(F.col("l_quantity"), F.col("l_extendedprice")))
    return out.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round("r", 8).alias("r"))


@query(
    "N06_outliers",
    """with c as (select user_id % 3 as cohort, user_id, count(*) as n from events group by 1, 2), m as (select cohort, quantile_cont(n, 0.5) as med, mad(n) as mad from c group by 1),
        l as (select *, case when mad > 0 then med + 2 * mad else 2 * med end as high, case when mad > 0 then greatest(0, med - 2 * mad) else 0 end as low from m)
    select cohort, user_id, n, cast(med as double) as median, cast(mad as double) as mad, cast(high as double) as high, cast(low as double) as low, case when n > high then 'HIGH' else 'LOW' end as flag from c join l using (cohort) where n > high or n < low""",
)
def outliers(t: Tables) -> DataFrame:
    counts = t.events.groupBy((F.col("user_id") % 3).alias("cohort"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return st.outlier_flags(counts, ["cohort"], "user_id", "n", 2.0)


@query(
    "A31_centroid_distance",
    """with p as (select vec_id, label, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y from embeddings), c as (select label, avg(x) as cx, avg(y) as cy from p group by 1)
    select vec_id, label, round(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), 9) as distance from p join c using (label)""",
)
def centroid(t: Tables) -> DataFrame:
    from strandline.operators.cohort import centroid_distance

    rows = t.embeddings.select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return centroid_distance(rows, "label", "x", "y").select("vec_id", "label", F.round("distance", 9).alias("distance"))


@query(
    "O02_top10",
    """select o_custkey, count(*) as n from orders group by 1 order by n desc, o_custkey limit 10""",
)
def top10(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)


@query(
    "W04_running_weight",
    """select event_id, round(sum(value) over (partition by user_id order by event_id rows unbounded preceding), 4) as running from events""",
)
def running(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return t.events.select("event_id", F.round(F.sum("value").over(w), 4).alias("running"))
