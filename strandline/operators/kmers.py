"""k-mer counting and set operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.records import reverse_complement

CAP = 8192
#: Rows and positions that are counted together before the shuffle.
ROWS, POSITIONS = 5000, 1_000_000
LARGEST = 1 << 62


def count_kmers(reads: DataFrame, seq: str, k: int, keys: list[str] | None = None, canonical: bool = True, least: int = 2, cap: int | None = CAP) -> DataFrame:
    """Counts of k-mers (A25): canonical ones are the smaller of a k-mer and its reverse complement; rare ones go, counts stop at the cap.

    Tasks count before the shuffle; null and short texts have none.
    """
    keys = keys or []
    schema = T.StructType([*reads.select(*keys).schema.fields, *T._parse_datatype_string("kmer string, n long").fields])
    source = reads.select(*keys, F.col(seq).alias("__seq")).where(F.length("__seq") >= k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                group = np.zeros(len(batch), np.int64)
                for column in batch.columns[:-1]:
                    codes = column.dictionary_encode(null_encoding="encode")
                    group = np.unique(group * len(codes.dictionary) + codes.indices.to_numpy(), return_inverse=True)[1]
                first = np.unique(group, return_index=True)[1]
                for g, gram, n in _counted(batch.column(len(keys)).to_pylist(), group, k):
                    owner = pa.array(first[g])
                    yield pa.RecordBatch.from_arrays([*(c.take(owner) for c in batch.columns[:-1]), gram, pa.array(n)], names=schema.fieldNames())

    kmers = source.mapInArrow(run, schema)
    if canonical:
        kmers = kmers.where(F.col("kmer").rlike("^[ACGT]+$")).withColumn("kmer", F.least("kmer", reverse_complement(F.col("kmer"))))
    out = kmers.groupBy(*keys, "kmer").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return out.withColumn("n", F.least("n", F.lit(cap))) if cap else out


def _counted(texts: list[str], group: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(group, k-mer, count) of the different pairs, a bounded stretch of positions at a time.

    A k-mer is its letters' number in the base of the alphabet, renumbered whenever that gets too large.
    """
    at, size = 0, np.fromiter(map(len, texts), np.int64, len(texts))
    while at < len(texts):
        end = max(at + 1, at + int(np.searchsorted(np.cumsum(size[at:]), POSITIONS, side="right")))
        codes = np.frombuffer("".join(texts[at:end]).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(at, end), size[at:end])
        for start in range(0, max(1, len(codes) - k + 1), POSITIONS):
            part, rows = codes[start : start + POSITIONS + k - 1], owner[start : start + POSITIONS + k - 1]
            if len(part) < k:
                continue
            letter, alphabet = pd.factorize(part)
            n_starts = len(part) - k + 1
            inside = np.nonzero(rows[:n_starts] == rows[k - 1 :])[0]
            number, bound = group[rows[inside]], int(group.max(initial=0)) + 1
            for step in range(k):
                if bound > LARGEST // len(alphabet):
                    number, known = pd.factorize(number)
                    bound = len(known)
                number, bound = number * np.int64(len(alphabet)) + letter[inside + step], bound * len(alphabet)
            which, known = pd.factorize(number)
            n = np.bincount(which, minlength=len(known))
            one = np.zeros(len(known), np.int64)
            one[which[::-1]] = np.arange(len(which))[::-1]
            place = inside[one]
            raw = part[place[:, None] + np.arange(k)].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            yield group[rows[place]], pa.array([raw[i * k : i * k + k] for i in range(len(place))], pa.string()), n
        at = end


def intersect_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """k-mers of both, the left counts."""
    return left.join(right.select("kmer").distinct(), "kmer", "left_semi")


def union_sum(left: DataFrame, right: DataFrame) -> DataFrame:
    """k-mers of either, counts added."""
    return left.select("kmer", "n").unionByName(right.select("kmer", "n")).groupBy("kmer").agg(F.sum("n").alias("n"))


def with_absent(sample: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected k-mers with their count in the sample plus one, so that absent ones show up."""
    return expected.select("kmer").distinct().join(sample.select("kmer", "n"), "kmer", "left").select("kmer", (F.coalesce("n", F.lit(0)) + 1).alias("n"))
