"""Iterative kernels on the driver's tables: EM, components, clusters, union-find. SQL can't express them; tests hold them against plain models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import cohort, genotypes, phasing, stats
from strandline.plans.registry import Tables, query


@query("N01_em")
def em(t: Tables) -> DataFrame:
    """Allele frequencies of parts as sites, their line items as samples."""
    sites = t.lineitem.groupBy(F.col("l_partkey").alias("site")).agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_quantity"))).alias("x"))
    rows = sites.select("site", F.transform("x", lambda x: F.array(x["l_quantity"].cast("int"), (x["l_quantity"].cast("int") * 7) % 61, (x["l_quantity"].cast("int") * 13) % 97)).alias("pl"), F.lit(2).alias("n_alleles"))
    return genotypes.recall(rows).select("site", F.round(F.get("af", F.lit(0)), 5).alias("ref_af"), F.size("gt").alias("samples"))


@query("N03_pca")
def pca(t: Tables) -> DataFrame:
    """Principal components of nations by revenue of each part."""
    cube = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("sample"), F.col("l_partkey").alias("region_id"))
        .agg(F.sum("l_extendedprice").alias("cov"))
    )
    return cohort.principal_components(cube, 2).select("sample", F.round("pc1", 3).alias("pc1"), F.round("pc2", 3).alias("pc2"))


@query("N04_dbscan")
def clusters(t: Tables) -> DataFrame:
    """Density clusters of embedding labels by their mean coordinates."""
    means = t.embeddings.groupBy("label").agg(*[F.avg(F.col("embedding")[i]).alias(f"x{i}") for i in range(2)])
    return cohort.best_clusters(means, "label", ["x0", "x1"], eps=(0.3, 0.6, 0.9, 1.2), least=(2, 3))


@query("N07_union_find")
def union_find(t: Tables) -> DataFrame:
    """Phase blocks of customers joined by line items."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", F.concat(F.lit("chr1:"), F.col("l_partkey").cast("string")).alias("a"), F.concat(F.lit("chr1:"), F.col("l_suppkey").cast("string")).alias("b"),
        (F.col("l_linenumber") % 2 == 1).alias("flipped"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
    )
    return phasing.merge_blocks(rows, ["o_custkey"])


@query(
    "N08_block_statistics",
    """select o_custkey, count(*) as blocks, round(avg(length), 6) as mean_length, quantile_cont(length, 0.5) as median_length, max(length) as longest, round(avg(n), 6) as mean_variants, max(n) as most_variants
    from (select o_custkey, o_orderpriority, max(o_orderkey) - min(o_orderkey) + 1 as length, count(*) as n from orders group by 1, 2) group by 1""",
)
def block_statistics(t: Tables) -> DataFrame:
    out = phasing.block_statistics(t.orders.select("o_custkey", F.col("o_orderpriority").alias("block"), F.col("o_orderkey").alias("pos")), ["o_custkey"])
    return out.withColumns({"mean_length": F.round("mean_length", 6), "mean_variants": F.round("mean_variants", 6)})


@query("N05_sex_call")
def sex_call(t: Tables) -> DataFrame:
    """Sex of suppliers as samples from the sizes of their line items."""
    part = F.when(F.col("l_linenumber") <= 3, "auto").when(F.col("l_linenumber") <= 5, "x").when(F.col("l_linenumber") == 6, "y").otherwise("m")
    rows = t.lineitem.select("l_suppkey", part.alias("part"), (F.col("l_quantity") - 25).alias("gc"), F.col("l_quantity").alias("count"))
    return stats.sex_call(rows, ["l_suppkey"]).select("l_suppkey", "auto_median", "x_ratio", "y_ratio", "sex")
