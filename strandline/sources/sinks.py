"""Writers: delimited tables, sections, JSON, text reports."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def number_text(values: pd.Series) -> pd.Series:
    """Report form of numbers (P07): whole ones as integers, others to four places of their exact binary value, nothing for missing and non-finite ones.

    SQL's own formatting rounds the shortest decimal form half up, so it can't stand in here.
    """
    v = pd.to_numeric(values, errors="coerce").to_numpy(float)
    text = np.char.mod("%.4f", v).astype(object)
    whole = np.isfinite(v) & (np.floor(v) == v)
    text[whole] = np.char.mod("%d", v[whole])
    text[~np.isfinite(v)] = ""
    return pd.Series(text)


def write_tsv(df: DataFrame, path: str, fields: list[str] | None = None, single: bool = False, formatted: bool = False) -> None:
    """A tab-separated table with a header; other columns than ``fields`` are left out.

    ``formatted`` renders doubles for reports, where rounding has to be half to even (Q20).
    """
    out = df.select(*fields) if fields else df
    if formatted:
        out = out.withColumns({c: number_text(c) for c, kind in out.dtypes if kind in ("double", "float")})
    out = out.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ";") for c, kind in out.dtypes if kind.startswith("array")})
    (out.coalesce(1) if single else out).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def append_tsv(df: DataFrame, old: DataFrame | None, path: str) -> None:
    """Rows below an existing table, columns united."""
    write_tsv(df if old is None else old.unionByName(df, allowMissingColumns=True), path)


def write_sections(sections: dict[str, DataFrame], folder: str) -> None:
    """One table a section."""
    for name, df in sections.items():
        write_tsv(df, f"{folder}/{name}.tsv")


def write_kits(bed: DataFrame, path: str) -> None:
    """Capture kits as JSON: kit, number of bins, bins in order."""
    bins = F.array_sort(F.collect_list(F.struct("chrom", "start", "end")))
    bed.groupBy("kit").agg(F.count(F.lit(1)).alias("bins"), bins.alias("intervals")).write.mode("overwrite").json(path)


def scalar_metadata(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, others as they are."""
    return df.select(*[F.to_json(c).alias(c) if kind.startswith(("struct", "map", "array")) else F.col(c) for c, kind in df.dtypes])


def text_report(samples: DataFrame, flags: DataFrame, loci: DataFrame, value: str = "calls") -> str:
    """A short report: ten largest burdens, twenty flags, twenty loci (K08, O02, O03). The limits are the report's."""
    top = samples.orderBy(F.desc(value), "sample").limit(10).select("sample", number_text(F.col(value).cast("double")).alias("v")).collect()
    out = ["Largest burdens"] + [f"  {r['sample']}\t{r['v']}" for r in top]
    out += ["Flags"] + ["  " + "\t".join(map(str, r)) for r in flags.limit(20).collect()]
    out += ["Loci"] + ["  " + "\t".join(map(str, r)) for r in loci.orderBy(F.desc("sample_count"), *loci.columns[:2]).limit(20).collect()]
    return "\n".join(out) + "\n"
