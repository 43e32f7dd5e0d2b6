"""Chromosome order, chromosome groups and the region-name code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How many regions each split level has.
LEVELS = {0: 1, 1: 10, 2: 100, 3: 1000, 4: 10000}


def contig_rank(contig: Column) -> Column:
    """Sort key: 1-22, X, Y, M, then all others by name."""
    name = F.regexp_replace(contig, "^chr", "")
    n = name.try_cast("int")
    rank = F.when(n.between(1, 22), n).when(name == "X", 23).when(name == "Y", 24).when(name.isin("M", "MT"), 25).otherwise(26)
    return F.struct(rank.alias("rank"), F.when(rank == 26, contig).otherwise("").alias("name"))


def chromosome_group(contig: Column) -> Column:
    """auto, chrx or chrm; null for all others, chrY among them."""
    name = F.regexp_replace(contig, "^chr", "")
    return F.when(name.try_cast("int").between(1, 22), "auto").when(name == "X", "chrx").when(name.isin("M", "MT"), "chrm")


def region_slice(region: Column) -> Column:
    """auto, full, chrx, chrxh, chry or chryh by a region's component and ploidy."""
    kind, haploid = F.substring(region, 1, 1), region.endswith("H")
    return (
        F.when(kind == "A", "auto").when(kind == "F", "full")
        .when(kind == "X", F.when(haploid, "chrxh").otherwise("chrx")).when(kind == "Y", F.when(haploid, "chryh").otherwise("chry"))
    )


def region_name(component: Column, level: Column, split: Column, ploidy: Column) -> Column:
    """(A, 2, 3, 2) -> A03: the split number has as many digits as the level; haploid sex regions end in H (P10)."""
    number = F.when(level == 0, "").otherwise(F.lpad(split.cast("string"), level, "0"))
    return F.concat(component, number, F.when((ploidy == 1) & component.isin("X", "Y"), "H").otherwise(""))


def region_parts(region: Column) -> Column:
    """The parts of a region's name: component, digits, level, haploid (P10)."""
    digits = F.regexp_extract(region, "^[A-Z]([0-9]*)H?$", 1)
    return F.struct(F.substring(region, 1, 1).alias("component"), digits.alias("digits"), F.length(digits).alias("level"), region.endswith("H").alias("haploid"))


def to_level0(region: Column) -> Column:
    """The whole-component region: autosomes and others belong to F, sex regions keep their ploidy (P10)."""
    kind = F.substring(region, 1, 1)
    suffix = F.when(region.endswith("H"), "H").otherwise("")
    return F.when(kind.isin("X", "Y"), F.concat(kind, suffix)).otherwise(F.lit("F"))


def to_level1(region: Column) -> Column:
    """The first-split region: autosomes by their first digit, O regions in the last autosomal split, sex regions whole (P10)."""
    kind, digit = F.substring(region, 1, 1), F.substring(region, 2, 1)
    suffix = F.when(region.endswith("H"), "H").otherwise("")
    return (
        F.when(kind == "A", F.concat(F.lit("A"), digit)).when(kind == "O", "A9").when(kind.isin("X", "Y"), F.concat(kind, suffix)).otherwise(region)
    )


def regions(spark, component: str, level: int):
    """All regions of a component at a level, as (region, split)."""
    n = LEVELS[level]
    split = F.col("id").cast("int")
    return spark.range(n).select(region_name(F.lit(component), F.lit(level), split, F.lit(2)).alias("region"), split.alias("split"))
