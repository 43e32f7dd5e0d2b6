"""Cohort structure: principal components, density clustering, assignment, coverage tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.genome import chromosome_group

# The grid of the cluster search.
EPS = tuple(round(0.1 + 0.1 * i, 1) for i in range(30))
LEAST = tuple(range(3, 16))


def usable_regions(cube: DataFrame, region: str = "region_id", value: str = "cov") -> DataFrame:
    """Rows of the regions in which every sample has a finite value."""
    v = F.col(value).cast("double")
    fine = ~F.isnan(v) & (F.abs(v) != float("inf"))
    good = cube.groupBy(region).agg(F.every(F.coalesce(fine, F.lit(False))).alias("ok")).where("ok").select(region)
    return cube.join(good, region, "left_semi")


def usable_samples(samples: DataFrame, mapped: str = "bases_mapped") -> DataFrame:
    """Samples with a finite, positive number of mapped bases."""
    v = F.col(mapped).cast("double")
    return samples.where(~F.isnan(v) & (F.abs(v) != float("inf")) & (v > 0))


def main_chromosomes(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Rows on autosomes, X and M by name; chrY and others go."""
    return df.where(chromosome_group(F.col(chrom)).isNotNull())


def gram_matrix(cube: DataFrame, sample: str, region: str, value: str, samples: list) -> np.ndarray:
    """Sums over regions of products of centred sample values; a samples x samples matrix.

    The number of samples is the bound of what reaches the driver. Each task folds its own
    regions into one matrix, so only as many matrices as tasks are added up.
    """
    place = {s: i for i, s in enumerate(samples)}
    n = len(samples)

    def fold(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n, n))
        for pdf in it:
            for names, values in zip(pdf["names"], pdf["vals"]):
                x = np.zeros(n)
                x[[place[s] for s in names]] = values
                x -= x.mean()
                total += np.outer(x, x)
        yield pd.DataFrame({"row": np.arange(n), "sums": list(total)})

    grouped = cube.where(F.col(sample).isin(samples)).groupBy(region).agg(F.collect_list(F.struct(sample, F.col(value).cast("double").alias("v"))).alias("x"))
    rows = grouped.select(F.expr(f"transform(x, p -> p.{sample})").alias("names"), F.expr("transform(x, p -> p.v)").alias("vals")).mapInPandas(fold, "row long, sums array<double>")
    sums = rows.select("row", F.posexplode("sums").alias("col", "v")).groupBy("row", "col").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((n, n))
    for r in sums:
        out[r["row"], r["col"]] = r["v"]
    return out


def principal_components(cube: DataFrame, k: int, sample: str = "sample", region: str = "region_id", value: str = "cov") -> DataFrame:
    """(sample, pc1..pck) from the exact covariance of the samples over all regions (N03). Signs: the largest entry of each component is positive."""
    spark = cube.sparkSession
    names = [r[0] for r in cube.select(sample).distinct().orderBy(sample).collect()]
    kind = cube.schema[sample].dataType.simpleString()
    schema = ", ".join([f"`{sample}` {kind}", *[f"pc{i + 1} double" for i in range(k)]])
    if not names:
        return spark.createDataFrame([], schema)
    values, vectors = np.linalg.eigh(gram_matrix(cube, sample, region, value, names))
    order = np.argsort(-values)[:k]
    scores = vectors[:, order] * np.sqrt(np.maximum(values[order], 0))
    if scores.shape[1] < k:
        scores = np.pad(scores, ((0, 0), (0, k - scores.shape[1])))
    sign = np.sign(scores[np.abs(scores).argmax(0), np.arange(k)])
    scores = scores * np.where(sign == 0, 1, sign)
    return spark.createDataFrame([(s, *map(float, row)) for s, row in zip(names, scores)], schema)


def dbscan(x: np.ndarray, eps: float, least: int) -> np.ndarray:
    """Density clusters, -1 for noise; a point counts among its own neighbours."""
    n = len(x)
    near = ((x[:, None] - x[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= least
    labels, cluster = np.full(n, -1), 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        labels[i], stack = cluster, [i]
        while stack:
            for j in np.nonzero(near[stack.pop()] & (labels == -1))[0]:
                labels[j] = cluster
                if core[j]:
                    stack.append(int(j))
        cluster += 1
    return labels


def silhouette(x: np.ndarray, labels: np.ndarray) -> float:
    """Mean silhouette by Euclidean distance; noise counts as a cluster of its own; -1 with fewer than two clusters."""
    kinds = np.unique(labels)
    if len(kinds) < 2 or len(kinds) >= len(x):
        return -1.0
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    means = np.stack([d[:, labels == k].sum(1) for k in kinds], 1)
    size = np.array([(labels == k).sum() for k in kinds])
    own = np.searchsorted(kinds, labels)
    rows = np.arange(len(x))
    a = means[rows, own] / np.maximum(size[own] - 1, 1)
    other = means / size
    other[rows, own] = np.inf
    b = other.min(1)
    return float(np.where(size[own] > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0).mean())


def best_clusters(points: DataFrame, id_col: str, columns: list[str], eps: tuple = EPS, least: tuple = LEAST) -> DataFrame:
    """(id, cluster) of the grid point with the best silhouette, one cluster for all if none parts them.

    The points are samples of a cohort, which bounds them; the grid is what is spread out.
    Values are standardised first; ties go to the smaller eps, then to the smaller count.
    """
    spark = points.sparkSession
    rows = points.select(id_col, *[F.col(c).cast("double") for c in columns]).orderBy(id_col).collect()
    kind = points.schema[id_col].dataType.simpleString()
    if not rows:
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int")
    x = np.array([[r[c] for c in columns] for r in rows], float)
    x = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    shared = spark.sparkContext.broadcast(x)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for e, m in zip(pdf["eps"], pdf["least"]):
                labels = dbscan(shared.value, e, int(m))
                out.append((e, int(m), silhouette(shared.value, labels), labels.astype(np.int32)))
            yield pd.DataFrame(out, columns=["eps", "least", "score", "labels"])

    grid = spark.createDataFrame([(float(e), int(m)) for e in eps for m in least], "eps double, least int")
    tried = grid.repartition(min(len(eps), 64)).mapInPandas(run, "eps double, least int, score double, labels array<int>")
    best = tried.orderBy(F.desc("score"), "eps", "least").first()
    labels = best["labels"] if best["score"] > -1 else [0] * len(rows)
    return spark.createDataFrame([(r[id_col], int(c)) for r, c in zip(rows, labels)], f"`{id_col}` {kind}, cluster int")


def with_labels(samples: DataFrame, labels: DataFrame, key: str, label: str = "cluster") -> DataFrame:
    """Samples with their label, -1 where there is none."""
    return samples.join(labels, key, "left").withColumn(label, F.coalesce(label, F.lit(-1)))


def assign_cohorts(samples: DataFrame, labels: DataFrame | None, fallback: str, key: str = "sample", sheet: str = "samplefile") -> DataFrame:
    """Cohort of every sample (N10). Without labels: ``single`` puts all in cohort 0, ``samplefile`` makes one a sheet, ``error`` raises. Label -1 is unassigned."""
    if labels is None:
        if fallback == "single":
            return samples.withColumn("cohort", F.lit("0")).withColumn("assignment", F.lit("single"))
        if fallback == "samplefile":
            return samples.withColumn("cohort", F.col(sheet)).withColumn("assignment", F.lit("samplefile"))
        raise ValueError("there are no cluster labels")
    joined = with_labels(samples, labels, key)
    return joined.withColumn("assignment", F.when(F.col("cluster") >= 0, "cluster").otherwise("unassigned")).withColumn("cohort", F.when(F.col("cluster") >= 0, F.col("cluster").cast("string"))).drop("cluster")


def centroid_distance(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Adds the group's centre and each row's distance to it (A31). Centres are aggregated before they are joined, so a large group stays spread out."""
    centres = df.groupBy(group).agg(F.avg(x).alias("centre_x"), F.avg(y).alias("centre_y"))
    dx, dy = F.col(x) - F.col("centre_x"), F.col(y) - F.col("centre_y")
    return df.join(centres, group).withColumn("distance", F.sqrt(dx * dx + dy * dy))


def sample_index(samples: DataFrame, cohort: str = "cohort", sample: str = "sample") -> DataFrame:
    """Adds the zero-based place of a sample in its sorted cohort."""
    return samples.withColumn("index", F.row_number().over(Window.partitionBy(cohort).orderBy(sample)) - 1)


def mean_coverage(blocks: DataFrame, regions: DataFrame, width: int) -> DataFrame:
    """Mean depth of every region from aligned blocks (A24). ``blocks``: sample, chrom, start, end; ``regions``: region_id, chrom, start, end."""
    from strandline.operators.intervals import overlap_join, overlap_length

    pairs = overlap_join(regions, blocks, ["chrom"], width)
    sums = pairs.groupBy("region_id", F.col("r_sample").alias("sample")).agg(F.sum(overlap_length()).alias("bases"))
    size = regions.select("region_id", (F.col("end") - F.col("start")).alias("length"))
    return sums.join(size, "region_id").withColumn("cov", (F.col("bases") / F.col("length")).cast("float"))


def write_cube(cube: DataFrame, path: str, regions_a_block: int = 1000, region: str = "region_id") -> None:
    """A coverage table in blocks of regions, for partition pruning."""
    blocked = cube.withColumn("region_block", F.floor(F.col(region) / regions_a_block).cast("int"))
    blocked.repartition("region_block").sortWithinPartitions(region).write.mode("overwrite").partitionBy("region_block").parquet(path)


def read_cube(spark, path: str, first: int, last: int, samples: Column | None = None, regions_a_block: int = 1000, region: str = "region_id") -> DataFrame:
    """Regions first..last of a coverage table; only their blocks are read."""
    rows = spark.read.parquet(path).where(F.col("region_block").between(first // regions_a_block, last // regions_a_block) & F.col(region).between(first, last))
    return rows.where(samples) if samples is not None else rows
