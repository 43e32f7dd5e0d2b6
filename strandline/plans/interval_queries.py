"""Interval algebra on the driver's tables: days as positions, parts, customers or users as chromosomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import intervals as iv
from strandline.operators.calls import greedy_match
from strandline.plans.registry import Tables, query

DAY = "date_diff('day', date '1970-01-01', cast({} as date))"
_SHIP, _ORDER = DAY.format("l_shipdate"), DAY.format("o_orderdate")


def _day(c: str):
    return F.unix_date(F.to_date(c)).cast("bigint")


def shipments(t: Tables) -> DataFrame:
    """Line items as intervals of days within a part."""
    start = _day("l_shipdate")
    return t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_orderkey", "l_linenumber", start.alias("start"), (start + F.col("l_quantity").cast("bigint")).alias("end"))


_SHIPMENTS = f"select l_partkey, l_suppkey, l_quantity, l_orderkey, l_linenumber, {_SHIP} as s, {_SHIP} + cast(l_quantity as bigint) as e from lineitem"
_ISLANDS = """
    select *, sum(new) over (partition by {key} order by s, e rows unbounded preceding) as island from (
        select *, case when p is null or s > p + {gap} then 1 else 0 end as new from (
            select *, max(e) over (partition by {key} order by s, e rows between unbounded preceding and 1 preceding) as p from ({rows})))
"""


@query(
    "I02_recurrent_loci",
    f"""select l_partkey, min(s) as start, max(e) as "end", count(*) as call_count, count(distinct l_suppkey) as sample_count,
        round(avg(l_quantity), 6) as mean_quantity, max(e) - min(s) + 1 as length
    from ({_ISLANDS.format(key="l_partkey", gap=1, rows=_SHIPMENTS)}) group by l_partkey, island having count(distinct l_suppkey) >= 2""",
)
def recurrent_loci(t: Tables) -> DataFrame:
    found = iv.recurrent_loci(shipments(t), ["l_partkey"], "l_suppkey", 1, 2, ["l_quantity"])
    return found.select("l_partkey", "start", "end", "call_count", "sample_count", F.round("mean_l_quantity", 6).alias("mean_quantity"), "length")


def _orders(t: Tables, length: int) -> DataFrame:
    start = _day("o_orderdate")
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", start.alias("start"), (start + length).alias("end"))


_ORDERS = f"select o_orderkey, o_custkey, o_totalprice, {_ORDER} as s, {_ORDER} + {{}} as e from orders"


@query(
    "I01_merge",
    f"""select o_custkey, min(s) as start, max(e) as "end", count(*) as n
    from ({_ISLANDS.format(key="o_custkey", gap=0, rows=_ORDERS.format(60))}) group by o_custkey, island""",
)
def merge(t: Tables) -> DataFrame:
    return iv.merge(_orders(t, 60), ["o_custkey"], width=365)


def _customer_shipments(t: Tables) -> DataFrame:
    start = _day("l_shipdate")
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "l_orderkey", "l_linenumber", "l_quantity", start.alias("start"), (start + 30).alias("end")
    )


_CUSTOMER_SHIPMENTS = f"select o_custkey, l_orderkey, l_linenumber, l_quantity, {_SHIP} as s, {_SHIP} + 30 as e from lineitem join orders on l_orderkey = o_orderkey"


@query(
    "I03_intersect",
    f"""select o_custkey, greatest(a.s, b.s) as start, least(a.e, b.e) as "end"
    from ({_ORDERS.format(45)}) a join ({_CUSTOMER_SHIPMENTS}) b using (o_custkey) where a.s < b.e and b.s < a.e""",
)
def intersect(t: Tables) -> DataFrame:
    return iv.intersect(_orders(t, 45), _customer_shipments(t), ["o_custkey"], 45)


@query(
    "I04_intersect_pairs",
    f"""select o_custkey, o_orderkey, l_orderkey, l_linenumber, least(a.e, b.e) - greatest(a.s, b.s) as overlap
    from ({_ORDERS.format(45)}) a join ({_CUSTOMER_SHIPMENTS}) b using (o_custkey) where a.s < b.e and b.s < a.e""",
)
def intersect_pairs(t: Tables) -> DataFrame:
    pairs = iv.overlap_join(_orders(t, 45), _customer_shipments(t), ["o_custkey"], 45)
    return pairs.select("o_custkey", "o_orderkey", F.col("r_l_orderkey").alias("l_orderkey"), F.col("r_l_linenumber").alias("l_linenumber"), iv.overlap_length().alias("overlap"))


@query(
    "F09_overlap_filter",
    f"""select o_orderkey from ({_ORDERS.format(45)}) a where exists (
        select 1 from ({_CUSTOMER_SHIPMENTS}) b where a.o_custkey = b.o_custkey and a.s < b.e and b.s < a.e)""",
)
def overlap_filter(t: Tables) -> DataFrame:
    return iv.overlap_join(_orders(t, 45), _customer_shipments(t), ["o_custkey"], 45, "semi").select("o_orderkey")


_DEPTH = """
    select k, pos as s, lead(pos) over (partition by k order by pos) as e,
        sum(a) over (partition by k order by pos rows unbounded preceding) as a, sum(b) over (partition by k order by pos rows unbounded preceding) as b
    from (select k, pos, sum(a) as a, sum(b) as b from (
        select o_custkey as k, s as pos, 1 as a, 0 as b from ({left}) union all select o_custkey, e, -1, 0 from ({left})
        union all select o_custkey, s, 0, 1 from ({right}) union all select o_custkey, e, 0, -1 from ({right})) group by k, pos)
""".format(left=_ORDERS.format(60), right=_CUSTOMER_SHIPMENTS)


@query(
    "I05_subtract",
    f"""select k as o_custkey, min(s) as start, max(e) as "end" from (
        select *, sum(new) over (partition by k order by s rows unbounded preceding) as island from (
            select *, case when lag(e) over (partition by k order by s) = s then 0 else 1 end as new from ({_DEPTH}) where a > 0 and b = 0 and e is not null))
    group by k, island""",
)
def subtract(t: Tables) -> DataFrame:
    return iv.subtract(_orders(t, 60), _customer_shipments(t), ["o_custkey"])


@query(
    "I06_multiinter",
    f"""select k as o_custkey, s as start, e as "end", cast(a as bigint) as orders, cast(b as bigint) as shipments,
        (a > 0)::int + (b > 0)::int as sides from ({_DEPTH}) where e is not null and (a > 0 or b > 0)""",
)
def multiinter(t: Tables) -> DataFrame:
    found = iv.segments({"orders": _orders(t, 60), "shipments": _customer_shipments(t)}, ["o_custkey"])
    return found.select("o_custkey", "start", "end", "orders", "shipments", "sides")


@query(
    "I07_makewindows",
    f"""select o_orderkey, w as start, least(w + 7, e) as "end" from (select o_orderkey, e, unnest(range(s, e, 7)) as w from ({_ORDERS.format(30)}))""",
)
def makewindows(t: Tables) -> DataFrame:
    return iv.windows(_orders(t, 30), 7).select("o_orderkey", "start", "end")


@query(
    "I08_slop",
    f"""select o_orderkey, greatest(0, s - 300) as start, least(10000 + o_custkey % 500, e + 300) as "end" from ({_ORDERS.format(30)})""",
)
def slop(t: Tables) -> DataFrame:
    lengths = t.customer.select(F.col("c_custkey").alias("o_custkey"), (10000 + F.col("c_custkey") % 500).alias("length"))
    return iv.slop(_orders(t, 30), lengths, "o_custkey", 300).select("o_orderkey", "start", "end")


@query(
    "I08_slop_ends",
    f"""select o_orderkey, case when f = 1 then greatest(0, s - 1000) else s end as start,
        case when l = 1 then least(10000 - 1, e + 1000) else e end as "end" from (
        select *, row_number() over (partition by o_custkey order by o_orderkey) as f, row_number() over (partition by o_custkey order by o_orderkey desc) as l
        from ({_ORDERS.format(30)}))""",
)
def slop_ends(t: Tables) -> DataFrame:
    lengths = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.lit(10000).alias("length"))
    return iv.slop_ends(_orders(t, 30), lengths, "o_custkey", 1000, "o_orderkey").select("o_orderkey", "start", "end")


@query(
    "I11_split",
    "select c_custkey, ntile(10) over (partition by c_nationkey order by c_custkey) - 1 as part from customer",
)
def split(t: Tables) -> DataFrame:
    return iv.split_even(t.customer, 10, ["c_custkey"], ["c_nationkey"]).select("c_custkey", "part")


@query(
    "J06_weighted_overlap",
    f"""select o_orderkey, round(sum(l_quantity * o) / sum(o), 6) as weighted_mean, cast(sum(o) as bigint) as covered, count(*) as bins from (
        select a.o_orderkey, b.l_quantity, least(a.e, b.e) - greatest(a.s, b.s) as o
        from ({_ORDERS.format(90)}) a join ({_CUSTOMER_SHIPMENTS}) b using (o_custkey) where a.s < b.e and b.s < a.e) group by 1""",
)
def weighted_overlap(t: Tables) -> DataFrame:
    found = iv.weighted_overlap(_orders(t, 90), _customer_shipments(t), ["o_custkey"], "l_quantity", 90, ["o_orderkey"])
    return found.withColumn("weighted_mean", F.round("weighted_mean", 6))


@query(
    "J07_annotation_overlap",
    f"""select a.o_custkey, a.o_orderkey, b.flag as l_returnflag, count(*) as calls, count(distinct b.l_suppkey) as samples
    from ({_ORDERS.format(90)}) a join (
        select o_custkey, l_suppkey, l_returnflag as flag, {_SHIP} as s, {_SHIP} + 30 as e from lineitem join orders on l_orderkey = o_orderkey) b
    using (o_custkey) where a.s < b.e and b.s < a.e group by 1, 2, 3""",
)
def annotation_overlap(t: Tables) -> DataFrame:
    start = _day("l_shipdate")
    calls = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_suppkey", "l_returnflag", start.alias("start"), (start + 30).alias("end"))
    pairs = iv.overlap_join(_orders(t, 90), calls, ["o_custkey"], 90)
    return pairs.groupBy("o_custkey", "o_orderkey", F.col("r_l_returnflag").alias("l_returnflag")).agg(F.count(F.lit(1)).alias("calls"), F.countDistinct("r_l_suppkey").alias("samples"))


@query(
    "J08_covered_share",
    f"""select k.o_custkey, total, coalesce(covered, 0) as covered, round(coalesce(covered, 0) / total, 9) as score from (
        select o_custkey, cast(sum(e - s) as bigint) as total from ({_ORDERS.format(60)}) group by 1) k left join (
        select o_custkey, cast(sum(least(a.e, b.e) - greatest(a.s, b.s)) as bigint) as covered
        from ({_ORDERS.format(60)}) a join ({_CUSTOMER_SHIPMENTS}) b using (o_custkey) where a.s < b.e and b.s < a.e and b.l_quantity >= 20 group by 1) c using (o_custkey)""",
)
def covered_share(t: Tables) -> DataFrame:
    kits = _orders(t, 60).withColumn("kit", F.col("o_custkey"))
    found = iv.covered_share(kits, _customer_shipments(t), ["o_custkey"], "kit", "l_quantity", 20, 60)
    return found.select(F.col("kit").alias("o_custkey"), "total", "covered", F.round("score", 9).alias("score"))


@query(
    "J05_greedy_match",
)
def greedy(t: Tables) -> DataFrame:
    rows = shipments(t).withColumn("ord", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    left, right = rows.where("l_linenumber % 2 = 0"), rows.where("l_linenumber % 2 = 1")
    keep = ["l_partkey", "ord", "start", "end"]
    return greedy_match(left.select(*keep), right.select(*keep), ["l_partkey"], "ord")


@query(
    "S33_span",
    f"""select first_chrom, start, last_chrom, "end" from
        (select o_custkey as first_chrom, s as start from ({_ORDERS.format(30)}) order by o_orderkey limit 1) x,
        (select o_custkey as last_chrom, e as "end" from ({_ORDERS.format(30)}) order by o_orderkey desc limit 1) y""",
)
def bed_span(t: Tables) -> DataFrame:
    return iv.span(_orders(t, 30).withColumnRenamed("o_custkey", "chrom"), "o_orderkey")


@query(
    "A24_mean_coverage",
    f"""select a.o_orderkey as region_id, b.l_returnflag as sample, cast(sum(least(a.e, b.e) - greatest(a.s, b.s)) as bigint) as bases
    from ({_ORDERS.format(45)}) a join (select o_custkey, l_returnflag, {_SHIP} as s, {_SHIP} + 30 as e from lineitem join orders on l_orderkey = o_orderkey) b using (o_custkey)
    where a.s < b.e and b.s < a.e group by 1, 2""",
)
def mean_coverage(t: Tables) -> DataFrame:
    from strandline.operators.cohort import mean_coverage as covered

    start = _day("l_shipdate")
    blocks = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("chrom"), F.col("l_returnflag").alias("sample"), start.alias("start"), (start + 30).alias("end"))
    regions = _orders(t, 45).select(F.col("o_orderkey").alias("region_id"), F.col("o_custkey").alias("chrom"), "start", "end")
    return covered(blocks, regions, 45).select("region_id", "sample", "bases")
