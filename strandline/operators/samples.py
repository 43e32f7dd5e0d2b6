"""Sample sheets: exclusions, batches, read-group names, unions and de-duplication."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_exclusions(samples: DataFrame, exclusions: DataFrame, key: str = "sample") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, excluded with their reason, listed but absent)."""
    listed = exclusions.dropDuplicates([key])
    return samples.join(listed, key, "left_anti"), samples.join(listed, key), listed.join(samples, key, "left_anti")


def batches(items: DataFrame, keys: list[str], order: str, size: str, cap: float, alone: bool = False) -> DataFrame:
    """Adds ``batch``: rows in order fill a batch until the next would exceed the cap.

    A row larger than the cap has a batch to itself; no empty batch is counted (Q11).
    With ``alone`` such a row doesn't end the batch that is being filled. A missing size
    counts as nothing. The fold is sequential within a key (a sheet and protocol); keys are
    dealt to tasks and each task folds its sorted rows in one pass.
    """
    schema = T.StructType([*items.schema.fields, T.StructField("batch", T.IntegerType())])
    columns, names = items.columns, schema.fieldNames()
    at_keys, at_size = [columns.index(k) for k in keys], columns.index(size)

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, batch, used, following = None, 0, 0.0, 1
        for rows in batches_:
            out = []
            for k, s in zip(zip(*(rows.column(i).to_pylist() for i in at_keys)), rows.column(at_size).to_pylist()):
                if k != key:
                    key, batch, used, following = k, 0, 0.0, 1
                s = float(s or 0)
                if alone and s > cap:
                    out.append(following)
                    following += 1
                    continue
                if batch == 0 or used + s > cap:
                    batch, used, following = following, 0.0, following + 1
                out.append(batch)
                used += s
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.int32())], names=names)

    dealt = items.repartition(*keys).sortWithinPartitions(*keys, F.col(order).asc_nulls_last())
    return dealt.mapInArrow(run, schema)


def disambiguate(groups: DataFrame, keys: list[str], name: str, order: str) -> DataFrame:
    """The second and later of equal names get .2, .3, ...."""
    n = F.row_number().over(Window.partitionBy(*keys, name).orderBy(order))
    return groups.withColumn(name, F.when(n > 1, F.concat(F.col(name), F.lit("."), n.cast("string"))).otherwise(F.col(name)))


def first_by(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def last_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key: a later sheet overrides an earlier one (Q23)."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*[o.desc() for o in order]))).where("__r = 1").drop("__r")


def fill_forward(df: DataFrame, keys: list[str], order: str, value: str, to: str) -> DataFrame:
    """Adds the last known value up to each row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(to, F.last(value, ignorenulls=True).over(w))


def concatenate(tables: list[DataFrame], strict: bool = True) -> DataFrame:
    """One table below the other by column name; ``strict`` raises if headers differ, else missing columns are null."""
    out = tables[0]
    for t in tables[1:]:
        if strict and t.columns != out.columns:
            raise ValueError(f"headers differ: {out.columns} and {t.columns}")
        out = out.unionByName(t, allowMissingColumns=not strict)
    return out


def resolve_regions(samples: DataFrame, regions: DataFrame, files: DataFrame) -> DataFrame:
    """The file of every sample and region (J17, F08): WGS at the first split, exomes whole; females have no Y or haploid regions.

    Regions are a fixed, small list, so the product is with a bounded table.
    """
    from strandline.functions.genome import to_level0, to_level1

    level = F.when(F.col("sample_type") == "WGS", to_level1(F.col("region"))).otherwise(to_level0(F.col("region")))
    pairs = samples.withColumn("region", F.explode(F.array(*[F.lit(r[0]) for r in regions.select("region").distinct().orderBy("region").collect()])))
    skip = (F.col("sex") == "F") & (F.col("region").startswith("Y") | F.col("region").endswith("H"))
    return pairs.where(~F.coalesce(skip, F.lit(False))).withColumn("file_region", level).join(files.withColumnRenamed("region", "file_region"), ["sample", "file_region"])


def group_readgroups(groups: DataFrame, needle: Column, how: str = "equal") -> DataFrame:
    """Read groups by id or by a part of a file name."""
    exploded = groups.select("sample", F.explode("readgroups").alias("rg"))
    cond = F.col("rg.id") == needle if how == "equal" else F.exists("rg.files", lambda f: f.contains(needle))
    return exploded.where(cond)


def active_bytes(files: DataFrame, keys: list[str], size: str = "filesize", overhead: float = 2.5) -> DataFrame:
    """Working storage that samples need."""
    return files.groupBy(*keys).agg((F.sum(size) * overhead).alias("active"))


def quota(pools: DataFrame) -> DataFrame:
    """Adds pinned = total - free - precious - removable."""
    return pools.withColumn("pinned", F.col("total") - F.col("free") - F.col("precious") - F.col("removable"))


def matching_metadata(rows: DataFrame, pattern: str, attribute: str | None = None, prefix: str = "") -> DataFrame:
    """Paths below a prefix with a label or an attribute value that matches."""
    values = rows.where(F.col("path").startswith(prefix))
    if attribute:
        return values.where(F.coalesce(F.col("xattr")[attribute].rlike(pattern), F.lit(False)))
    return values.where(F.exists("labels", lambda x: x.rlike(pattern)) | F.exists(F.map_values("xattr"), lambda x: x.rlike(pattern)))
