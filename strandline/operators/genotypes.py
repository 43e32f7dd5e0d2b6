"""Genotype likelihoods: allele frequencies by EM, posteriors, site statistics, annotation joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integers that stand for missing likelihoods.
MISSING = (-2147483648, -2147483647)
STOP = 1e-7
#: Likelihoods of the sites that are solved together.
TENSOR = 2_000_000


def genotype_alleles(alleles: int, ploidy: int) -> np.ndarray:
    """Allele counts (genotype, allele) in the order of likelihood lists: 0/0, 0/1, 1/1, 0/2, ..."""
    if ploidy == 1:
        return np.eye(alleles, dtype=int)
    rows = [(j, k) for k in range(alleles) for j in range(k + 1)]
    out = np.zeros((len(rows), alleles), int)
    for r, (j, k) in enumerate(rows):
        out[r, j] += 1
        out[r, k] += 1
    return out


def allele_frequencies(likelihoods: np.ndarray, alleles: int, ploidy: int = 2, limit: int = 1000, signed: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """EM under Hardy-Weinberg proportions: (frequencies, posteriors) of one site.

    ``likelihoods``: samples x genotypes, rows of ones where unknown. Stops when no frequency
    moves by more than STOP; ``signed`` looks at increases only (Q2).
    """
    freq, post = frequencies_of_sites(likelihoods[None], alleles, ploidy, limit, signed)
    return freq[0], post[0]


def frequencies_of_sites(likelihoods: np.ndarray, alleles: int, ploidy: int = 2, limit: int = 1000, signed: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """EM of many sites of one shape (sites x samples x genotypes) at once; a site rests when it has settled."""
    counts = genotype_alleles(alleles, ploidy)
    ways = np.where((counts == 1).sum(1) == 2, 2.0, 1.0) if ploidy == 2 else np.ones(len(counts))
    freq = np.full((len(likelihoods), alleles), 1.0 / alleles)
    post = np.full_like(likelihoods, 1.0 / len(counts), dtype=float)
    todo = np.arange(len(likelihoods))
    for _ in range(limit):
        if not len(todo):
            break
        old = freq[todo]
        prior = ways * np.prod(old[:, None, :] ** counts, axis=2)
        now = likelihoods[todo] * prior[:, None, :]
        total = now.sum(2, keepdims=True)
        now = np.where(total > 0, now / np.where(total > 0, total, 1), (prior / prior.sum(1, keepdims=True))[:, None, :])
        new = (now @ counts).sum(1)
        new /= new.sum(1, keepdims=True)
        post[todo], freq[todo] = now, new
        moved = (new - old).max(1) if signed else np.abs(new - old).max(1)
        todo = todo[moved > STOP]
    return freq, post


def leave_one_out(likelihoods: np.ndarray, alleles: int, ploidy: int = 2) -> np.ndarray:
    """Each sample's posteriors with frequencies of all other samples."""
    n = len(likelihoods)
    counts = genotype_alleles(alleles, ploidy)
    ways = np.where((counts == 1).sum(1) == 2, 2.0, 1.0) if ploidy == 2 else np.ones(len(counts))
    out = np.empty_like(likelihoods, dtype=float)
    for i in range(n):
        others = np.delete(likelihoods, i, axis=0)
        freq = allele_frequencies(others, alleles, ploidy)[0] if n > 1 else np.full(alleles, 1.0 / alleles)
        post = likelihoods[i] * ways * np.prod(freq[None, :] ** counts, axis=1)
        out[i] = post / post.sum() if post.sum() > 0 else 1.0 / len(counts)
    return out


def mixed_frequencies(likelihoods: np.ndarray, alleles: int, prior: np.ndarray, weight: float, ploidy: int = 2) -> np.ndarray:
    """Cohort frequencies pulled towards outside ones as if ``weight`` alleles of those had been seen."""
    freq, _ = allele_frequencies(likelihoods, alleles, ploidy)
    n = ploidy * len(likelihoods)
    return (freq * n + prior * weight) / (n + weight)


def likelihoods_of(pl: list, genotypes: int) -> np.ndarray:
    """Phred-scaled likelihood lists as likelihoods; missing ones are flat."""
    out = np.ones((len(pl), genotypes))
    for i, row in enumerate(pl):
        if row is not None and len(row) == genotypes and not any(v is None or v in MISSING for v in row):
            out[i] = 10.0 ** (-np.asarray(row, float) / 10)
    return out


def recall(sites: DataFrame, alleles: str = "n_alleles", pl: str = "pl", ploidy: int = 2, signed: bool = False) -> DataFrame:
    """Adds af, gt (likeliest genotype of each sample), gq (at most 99) and gp to sites (N01). ``pl``: array of one list a sample. No shuffle."""
    schema = sites.select("*", F.expr("cast(null as array<double>)").alias("af"), F.expr("cast(null as array<int>)").alias("gt"), F.expr("cast(null as array<int>)").alias("gq"), F.expr("cast(null as array<array<double>>)").alias("gp")).schema

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            af, gt, gq, gp = ([None] * len(pdf) for _ in range(4))
            shapes: dict[tuple[int, int], list[int]] = {}
            for i, (n, lists) in enumerate(zip(pdf[alleles], pdf[pl])):
                shapes.setdefault((int(n), len(lists)), []).append(i)
            for (n, samples), sites_ in shapes.items():
                genotypes = len(genotype_alleles(n, ploidy))
                per = max(1, TENSOR // max(1, samples * genotypes))
                for at in range(0, len(sites_), per):
                    some = sites_[at : at + per]
                    freq, post = frequencies_of_sites(np.stack([likelihoods_of(list(pdf[pl].iloc[i]), genotypes) for i in some]), n, ploidy, signed=signed)
                    error = np.maximum(1 - post.max(2), 10**-9.9) if samples else np.zeros(post.shape[:2])
                    quality = np.minimum(99, np.floor(-10 * np.log10(error))).astype(int)
                    for k, i in enumerate(some):
                        af[i], gt[i], gq[i], gp[i] = freq[k].tolist(), post[k].argmax(1).tolist(), quality[k].tolist(), post[k].tolist()
            yield pdf.assign(af=af, gt=gt, gq=gq, gp=gp)

    return sites.mapInPandas(run, schema)


def split_alleles(sites: DataFrame, alts: str = "alts", per_alt: tuple[str, ...] = (), per_allele: tuple[str, ...] = (), per_genotype: tuple[str, ...] = ()) -> DataFrame:
    """One row an alternative allele, lists by allele or genotype cut to it.

    A: one value an alternative; R: the reference's first; G: a diploid likelihood list, of
    which 0/0, 0/k and k/k stay.
    """
    out = sites.select("*", F.posexplode(alts).alias("__i", "alt"))
    k = F.col("__i") + 1
    for c in per_alt:
        out = out.withColumn(c, F.get(F.col(c), F.col("__i")))
    for c in per_allele:
        out = out.withColumn(c, F.array(F.get(F.col(c), F.lit(0)), F.get(F.col(c), k)))
    for c in per_genotype:
        het = (k * (k + 1) / 2).cast("int")
        out = out.withColumn(c, F.array(F.get(F.col(c), F.lit(0)), F.get(F.col(c), het), F.get(F.col(c), het + k)))
    return out.drop("__i", alts)


def multiallelic(sites: DataFrame, alts: str = "alts", ac: str = "ac", an: str = "an") -> DataFrame:
    """NMA_ALT, MA_REF_AF and MA_REFLOW_COUNT of sites with several alternatives and any called allele."""
    ref = 1 - F.aggregate(F.transform(ac, lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x) / F.col(an)
    low = F.size(F.filter(F.col(ac), lambda x: ref < x / F.col(an)))
    return sites.where((F.size(alts) > 1) & (F.col(an) > 0)).withColumn("nma_alt", F.size(alts)).withColumn("ma_ref_af", ref).withColumn("ma_reflow_count", low)


def minor_alleles(sites: DataFrame, ac: str = "ac", an: str = "an", least: int = 1) -> DataFrame:
    """Sites with called genotypes and at least ``least`` alleles that are not the commonest."""
    seen = F.aggregate(F.transform(ac, lambda x: x.cast("bigint")), F.lit(0).cast("bigint"), lambda s, x: s + x)
    top = F.greatest(F.array_max(F.transform(ac, lambda x: x.cast("bigint"))), F.col(an) - seen)
    return sites.where((F.col(an) > 0) & (F.col(an) - top >= least))


def annotate(sites: DataFrame, sources: dict[str, DataFrame], keys: tuple[str, ...] = ("chrom", "pos", "ref", "alt")) -> DataFrame:
    """Left lookups of several sources by site and allele (J14, J15, J16); the sources' value columns get their name as prefix."""
    out = sites
    for name, t in sources.items():
        values = [c for c in t.columns if c not in keys]
        out = out.join(t.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in values]).dropDuplicates(list(keys)), list(keys), "left")
    return out


def first_filter(original: Column, called: Column) -> Column:
    """The called set's FILTER where there is one."""
    return F.coalesce(called, original)
