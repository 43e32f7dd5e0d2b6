"""Quality-control reports: gathers of metric tables, roll-ups, reconciliation, taxonomy, artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gather(base: DataFrame, tables: list[DataFrame], keys: list[str], how: str = "inner", defaults: dict | None = None) -> DataFrame:
    """One wide row an entity from metric tables with equal keys.

    ``inner`` drops entities that lack a table, ``left`` keeps them with ``defaults``; use
    ``missing_inputs`` to list what an inner gather would drop.
    """
    out = base
    for t in tables:
        out = out.join(t, keys, how)
    return out.na.fill(defaults) if defaults else out


def missing_inputs(base: DataFrame, tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(keys, table) of every entity without a row in a table (Q24)."""
    out = None
    for name, t in tables.items():
        part = base.select(*keys).join(t.select(*keys), keys, "left_anti").withColumn("table", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def pivot_metrics(long: DataFrame, keys: list[str], names: list[str], metric: str = "metric", value: str = "value") -> DataFrame:
    """Long metric rows as one wide row, the named metrics only."""
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col(metric) == n, F.col(value))).alias(n) for n in names])


def with_aliases(long: DataFrame, aliases: dict[str, str], keys: list[str], metric: str = "metric", value: str = "value") -> DataFrame:
    """Alternative metric names folded into one; a metric under its own name wins."""
    mapping = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    target = F.coalesce(mapping[F.col(metric)], F.col(metric))
    own = (F.col(metric) == target).cast("int")
    return long.groupBy(*keys, target.alias(metric)).agg(F.max_by(value, F.struct(own, F.col(metric))).alias(value))


def safe_ratio(top: Column, bottom: Column, default: float = 0.0) -> Column:
    """top / bottom, the default where there is nothing to divide by."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(default))


def add_up(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sum, maximum and least positive value by rollup of the keys."""
    return df.rollup(*keys).agg(F.sum(value).alias("total"), F.max(value).alias("highest"), F.min(F.nullif(F.col(value), F.lit(0))).alias("least_positive"))


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Whether two one-row (checksum, count) tables agree."""
    a = left.select(F.col("checksum").alias("a"), F.col("count").alias("n"))
    b = right.select(F.col("checksum").alias("b"), F.col("count").alias("m"))
    keys, counts = F.col("a").eqNullSafe(F.col("b")), F.col("n") == F.col("m")
    return a.join(F.broadcast(b)).select(keys.alias("keys_match"), counts.alias("counts_match"), (keys & counts).alias("compare_all"))  # one row each


def compare_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Names whose numbers differ: extra, missing, duplicated, fewer."""
    a, b = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_left")), right.groupBy(key).agg(F.count(F.lit(1)).alias("n_right"))
    kind = F.when(F.col("n_left").isNull(), "extra").when(F.col("n_right").isNull(), "missing").when(F.col("n_right") > F.col("n_left"), "duplicated").when(F.col("n_right") < F.col("n_left"), "fewer")
    return a.join(b, key, "full_outer").withColumn("kind", kind).where("kind is not null")


def ledger(df: DataFrame, status: str, size: str) -> DataFrame:
    """Files and bytes by status."""
    return df.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"))


def taxon_summary(report: DataFrame, human: int = 9606, bacteria: int = 2, viruses: int = 10239) -> DataFrame:
    """Shares of a classification report by sample (A20, S24): human, bacteria, viruses, unclassified, and the top species and genus (the earlier line on ties).

    ``report``: sample, line, clade, rank, taxid, name.
    """
    total = F.sum(F.when(F.col("taxid").isin(0, 1), F.col("clade")))
    at = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("clade"))), F.lit(0))
    best = lambda r: F.max_by(F.struct("name", "clade"), F.when(F.col("rank") == r, F.struct(F.col("clade"), -F.col("line"))))
    return (
        report.groupBy("sample").agg(
            total.alias("reads"), at(F.col("taxid") == 0).alias("unclassified"), at(F.col("taxid") == human).alias("human"), at(F.col("taxid") == bacteria).alias("bacteria"),
            at(F.col("taxid") == viruses).alias("viruses"), best("S").alias("s"), best("G").alias("g"),
        )
        .select("sample", "reads", "unclassified", "human", "bacteria", "viruses", F.col("s.name").alias("top_species"), F.col("s.clade").alias("top_species_reads"), F.col("g.name").alias("top_genus"), F.col("g.clade").alias("top_genus_reads"))
    )


def artifact_minimum(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Least score of each substitution, one column each (S19). ``rows``: keys, ref, alt, q."""
    pairs = [f"{a}_{b}" for a in "ACGT" for b in "ACGT" if a != b]
    return rows.groupBy(*keys).agg(*[F.min(F.when(F.concat_ws("_", "ref", "alt") == p, F.col("q"))).alias(p) for p in pairs])


def artifact_counters(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of the four counters by substitution and flank (S20). ``rows``: keys, ref, alt, context, pro_ref, pro_alt, con_ref, con_alt."""
    return rows.groupBy(*keys, "ref", "alt", "context").agg(*[F.sum(c).alias(c) for c in ("pro_ref", "pro_alt", "con_ref", "con_alt")])


def artifact_triples(sums: DataFrame) -> DataFrame:
    """Phred of the forward, the reverse and the excess error rate."""
    from strandline.operators.stats import phred

    rate = lambda a, r: F.try_divide(F.col(a).cast("double"), (F.col(a) + F.col(r)).cast("double"))
    first, second = rate("pro_alt", "pro_ref"), rate("con_alt", "con_ref")
    excess = F.when(first > second, F.least(F.lit(100.0), -10 * F.log10(first - second))).otherwise(100.0)
    return sums.withColumn("first", phred(F.col("pro_alt"), F.col("pro_alt") + F.col("pro_ref"))).withColumn("second", phred(F.col("con_alt"), F.col("con_alt") + F.col("con_ref"))).withColumn(
        "excess", F.when(first.isNotNull() & second.isNotNull(), excess)
    )


def indel_lengths(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Insertions, deletions and length-weighted totals (A16). ``rows``: keys, length (negative: deletion), n."""
    size = F.col("length")
    return rows.groupBy(*keys).agg(
        F.sum(F.when(size > 0, F.col("n")).otherwise(0)).alias("insertions"), F.sum(F.when(size < 0, F.col("n")).otherwise(0)).alias("deletions"),
        F.sum(F.when(size > 0, size * F.col("n")).otherwise(0)).alias("inserted_bases"), F.sum(F.when(size < 0, -size * F.col("n")).otherwise(0)).alias("deleted_bases"),
    )


def phase_totals(blocks: DataFrame) -> DataFrame:
    """Phase metrics by sample and chromosome group with an 'all' row (A19). ``blocks``: sample, grp, variants, phased, block_count, longest, shortest."""
    out = blocks.where("grp is not null").rollup("sample", "grp").agg(
        F.sum("variants").alias("variants"), F.sum("phased").alias("phased"), F.sum("block_count").alias("blocks"), F.max("longest").alias("longest"), F.min(F.nullif(F.col("shortest"), F.lit(0))).alias("shortest")
    )
    return out.where("sample is not null").withColumn("grp", F.coalesce("grp", F.lit("all")))
