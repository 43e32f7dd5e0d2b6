"""SimHash near-duplicate groups through a Gray-ordered hierarchical index.

Fingerprints. ASCII letters are lower-cased, words are runs of anything but the six
ASCII white-space characters, shingles are ``WIDTH`` words joined by a space with
repeats kept (a shorter text is one shingle; no word at all gives fingerprint 0).
A bit is set where it is set in over half of the shingles' XXH64 hashes, seed 42.

Linking. Equal fingerprints collapse first. Two different fingerprints that differ
in at most ``RADIUS`` = 2 bits agree on at least one of three disjoint bit blocks,
so the index's upper nodes are (mask, masked pattern) pairs: three for each
fingerprint, with no difference accumulated on the shared bits. A node with more
than ``NODE_LIMIT`` fingerprints gets three children in the same way, which share
further bits; after four levels at most 13 bits are free, so no node can hold
more than 8192 different fingerprints, whatever the data. Inside a node the
fingerprints are sorted by Gray rank and cut into leaf groups; groups and groups of
groups keep the bits on which all their members agree, and a pair of groups is
dropped as soon as the differences accumulated on the common bits exceed RADIUS.
A node returns a spanning star of each linked set, not its pairs.

Components of the links are found by ``components.connected_components``.

Edge cases. Null and empty texts have fingerprint 0 and link like any other.
Repeated rows appear once each in the result. A null ``doc_id`` is never a
component's name unless it is alone. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.components import connected_components
from strandline.llm.shared import materialize

WIDTH, SEED, RADIUS = 3, 42, 2
NODE_LIMIT, LEVELS, LEAF = 2048, 4, 16
_SLICE = 400_000
_ALL = (1 << 64) - 1


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    return np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(words) - width + 1)


def fold(hashes: np.ndarray) -> int:
    """The fingerprint of one document's hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at : at + _SLICE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, width: int = WIDTH) -> DataFrame:
    """``keep`` columns plus ``fp`` (the fingerprint as a signed long)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "fp"]
    source = docs.select(*keep, F.col(text_col).alias("__text"))
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.fromiter((fold(shingle_hashes(t, width)) for t in batch.column(n).to_pylist()), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(got.view(np.int64))], names=[*keep, "fp"])

    return source.mapInArrow(run, T.StructType([*source.select(*keep).schema.fields, T.StructField("fp", T.LongType())]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def child_masks(mask: int) -> list[int]:
    """The mask with each of three blocks of its free bits added."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    cuts = [round(len(free) * k / (RADIUS + 1)) for k in range(RADIUS + 2)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:])]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class _Union:
    """Union of array positions; the root of a set is its least position."""

    def __init__(self, n: int):
        self.p = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.p[i], self.p[j]
            apart = a != b
            if not apart.any():
                return
            i, j = np.unique(np.stack([np.minimum(a, b)[apart], np.maximum(a, b)[apart]]), axis=1)
            np.minimum.at(self.p, j, i)
            while True:
                up = self.p[self.p]
                if (up == self.p).all():
                    break
                self.p = up


def _group(patterns: np.ndarray, shared: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Factor what ``size`` neighbours have in common into one upper entry each."""
    at = np.arange(0, len(patterns), size)
    first = np.repeat(patterns[at], np.diff(np.append(at, len(patterns))), axis=0)
    differ = np.bitwise_or.reduceat(patterns ^ first, at)
    common = np.bitwise_and.reduceat(shared, at) & ~differ
    return patterns[at] & common, common


def _near(pa_: np.ndarray, sa: np.ndarray, pb: np.ndarray, sb: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count((pa_ ^ pb) & sa & sb).sum(-1) <= radius


def near_pairs(codes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, difference), i < j, of all codes (rows of 64-bit words, sorted by Gray rank) within ``radius`` bits of each other."""
    full = np.full(codes.shape, _ALL, np.uint64)
    leaf_p, leaf_s = _group(codes, full, LEAF)
    top_p, top_s = _group(leaf_p, leaf_s, LEAF)
    offsets = np.arange(LEAF)
    for t in range(len(top_p)):
        tops = np.nonzero(_near(top_p[t], top_s[t], top_p[t:], top_s[t:], radius))[0] + t
        right = (tops[:, None] * LEAF + offsets).ravel()
        right = right[right < len(leaf_p)]
        for g in range(t * LEAF, min(len(leaf_p), (t + 1) * LEAF)):
            leaves = right[right >= g]
            leaves = leaves[_near(leaf_p[g], leaf_s[g], leaf_p[leaves], leaf_s[leaves], radius)]
            members = (leaves[:, None] * LEAF + offsets).ravel()
            members = members[members < len(codes)]
            own = np.arange(g * LEAF, min(len(codes), (g + 1) * LEAF))
            differ = np.bitwise_count(codes[own][:, None] ^ codes[members][None, :]).sum(-1)
            i, j = np.nonzero((differ <= radius) & (own[:, None] < members[None, :]))
            if len(i):
                yield own[i], members[j], differ[i, j]


def index_links(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) codes of every linked set of the different ``codes`` of one node."""
    codes = codes[np.argsort(gray_rank(codes))]
    union = _Union(len(codes))
    for i, j, _ in near_pairs(codes[:, None], RADIUS):
        union.join(i, j)
    moved = np.nonzero(union.p != np.arange(len(codes)))[0]
    return codes[moved], codes[union.p[moved]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every node; a partition's rows come sorted by node."""

    def nodes(mask: np.ndarray, pattern: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.append(True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1]))
        node = np.cumsum(new) - 1
        size = np.bincount(node)[node]
        left, right = [], []
        small = size <= LEAF  # one leaf group
        for k in range(1, LEAF):
            if len(fp) > k:
                i = np.nonzero(small[:-k] & (node[:-k] == node[k:]) & (np.bitwise_count(fp[:-k] ^ fp[k:]) <= RADIUS))[0]
                left.append(fp[i]), right.append(fp[i + k])
        for at in np.nonzero(new & ~small)[0]:
            a, b = index_links(fp[at : at + size[at]])
            left.append(a), right.append(b)
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], names=["a", "b"])

    rest: list[np.ndarray] | None = None
    for batch in batches:
        now = [np.asarray(c).astype(np.int64).view(np.uint64) for c in batch.columns]
        if not len(now[0]):
            continue
        if rest is not None:
            now = [np.concatenate([a, b]) for a, b in zip(rest, now)]
        cut = np.nonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))[0]
        cut = cut[-1] + 1 if len(cut) else 0
        if cut:
            yield from nodes(*(x[:cut] for x in now))
        rest = [x[cut:] for x in now]
    if rest is not None:
        yield from nodes(*rest)


def links(fps: DataFrame) -> DataFrame:
    """(a, b): edges that connect all fingerprints within RADIUS of each other. ``fps``: different ``fp`` values."""
    spark = fps.sparkSession

    def spread(rows: DataFrame, masks: list[int]) -> DataFrame:
        every = F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
        return rows.select("fp", every.alias("mask")).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"), "fp")

    rows, masks, leaves = spread(fps, child_masks(0)), child_masks(0), []
    for level in range(LEVELS):
        if level == LEVELS - 1:
            break
        sizes = rows.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n"))
        big = materialize(sizes.where(F.col("n") > NODE_LIMIT).select("mask", "pattern"), "nodes")
        if big.isEmpty():
            break
        leaves.append(rows.join(big, ["mask", "pattern"], "left_anti").select("mask", "pattern", "fp"))
        pairs = spark.createDataFrame([(_signed(m), _signed(c)) for m in masks for c in child_masks(m)], "mask long, child long")
        down = rows.join(big, ["mask", "pattern"], "left_semi").join(F.broadcast(pairs), "mask")  # 3**level masks
        rows = materialize(down.select(F.col("child").alias("mask"), F.col("fp").bitwiseAND(F.col("child")).alias("pattern"), "fp"), "nodes")
        masks = [c for m in masks for c in child_masks(m)]
    leaves.append(rows)
    whole = leaves[0]
    for more in leaves[1:]:
        whole = whole.unionByName(more)
    return whole.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern").mapInArrow(_search, "a long, b long")


def _components(rows: DataFrame) -> DataFrame:
    """(fp, component_id): the least __id of all fingerprints reachable. ``rows``: __id, fp, written."""
    uniq = materialize(rows.groupBy("fp").agg(F.min("__id").alias("first")), "uniq")
    roots = materialize(connected_components(links(uniq.select("fp"))), "roots")
    named = roots.join(uniq, roots.node == uniq.fp)
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    moved = roots.join(least, "root").select("node", "least")
    return materialize(uniq.join(moved, uniq.fp == moved.node, "left").select("fp", F.coalesce("least", "first").alias("component_id")), "names")


def group_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, fingerprint, component_id) for every row; component_id is the least id reachable."""
    rows = materialize(fingerprints(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")), "__t", ["__id"]), "fingerprints")
    return rows.join(_components(rows), "fp").select(
        F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
