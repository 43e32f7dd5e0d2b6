"""One document of each near-duplicate group, by SimHash and the Gray-ordered index.

Similarity. Texts are compared by their sets of ``WIDTH``-word shingles (words and
short texts as in ``simhash``); two are near copies if the Jaccard similarity of the
sets is ``SIMILARITY`` or more, which is checked exactly.

Candidates. Texts with equal sets collapse first. A set's fingerprint has ``64 * WORDS`` SimHash bits. At the least similarity
a bit differs with probability ``DIFFER``, so the radius is that share of the bits plus
two standard deviations. The index's upper nodes are
(mask, masked pattern) pairs as in ``simhash``; masks are random sets of bits, so many
that two near copies share a node with probability ``RECALL``, and so long that a node
has a few unrelated fingerprints whatever their number: a mask has ``log2(n) - 3`` bits
and the number of masks follows. Nodes are dealt by ranges of (node, Gray rank), so one
that holds a third of all rows is spread over tasks. Inside a node, fingerprints are in
Gray order and groups are pruned as in ``simhash``; a node of more than ``WINDOW``
fingerprints is searched in half-overlapping stretches of that order, which differs from
mask to mask. A node's near pairs are thinned to a spanning forest, nearest first, so
what is connected at any distance stays connected and large groups add no pair for
every two members.

Texts that are in a pair send their shingle hashes to the exact check. Forests, stretches,
task borders and masks leave out pairs, so the links found so far only contract the texts,
and an exact way finds every link between the rest: two sets as similar as that share one
of their first ``n - ceil(SIMILARITY * n) + 1`` shingles in any one order of all shingles
(rare ones first here; how rare is told by a sample, which bears on the cost alone). Each
text sends these, texts of different groups that share one are a pair unless their sizes
or the places of that shingle rule it out, and the pairs go to the same exact check.
Before whole sets are joined, counts of their hashes by bucket bound what two sets share.
Which rows stay travels back to the scan by file and row number.

Edge cases. Null and empty texts are copies of each other. The row with the least id
stays, the first in the input on ties; null ids come last. Repeated rows are copies.
An empty table stays empty. Very long texts count as a whole. All columns
pass through unchanged; names that begin with two underscores are reserved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.components import connected_components
from strandline.llm.shared import by_split, forget, held, materialize, read_side, read_table_files, scratch, with_rows, write_side
from strandline.llm.simhash import LEAF, _signed, _Union, gray_rank, near_pairs, shingle_hashes

WIDTH, SIMILARITY = 5, 0.8
WORDS, RECALL, SEED = 4, 0.95, 5
WINDOW, SPAN = 2048, 1 << 20
_SLICE = 100_000
#: Texts whose shingles tell the rare from the frequent, and comparisons done at once.
SAMPLE, STEP = 10_000, 1 << 21
#: Bits of a shingle's hash that choose its bucket in a set's counts.
BUCKETS = 8
#: Probability that a bit differs at the least similarity (the angle between two sets of that overlap).
DIFFER = math.acos(2 * SIMILARITY / (1 + SIMILARITY)) / math.pi
RADIUS = math.floor(64 * WORDS * DIFFER + 2 * math.sqrt(64 * WORDS * DIFFER * (1 - DIFFER)))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_CODE = [f"f{k}" for k in range(WORDS)]


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The SimHash words of one text's different shingle hashes; zero without any."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), _SLICE):
        x = hashes[at : at + _SLICE, None] * _ODD
        x = (x ^ (x >> np.uint64(32))) * _ODD[::-1]
        x ^= x >> np.uint64(29)
        ones += np.unpackbits(np.ascontiguousarray(x).view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


def masks(count: int, bits: int | None = None) -> list[list[int]]:
    """The index's masks for ``count`` fingerprints: sets of bits as words."""
    bits = bits or max(8, math.ceil(math.log2(max(2, count))) - 3)
    repeats = math.ceil(math.log(1 - RECALL) / math.log1p(-((1 - DIFFER) ** bits)))
    rng, out = np.random.default_rng(SEED), []
    for _ in range(repeats):
        mask = np.zeros(64 * WORDS, bool)
        mask[rng.choice(64 * WORDS, min(bits, 64 * WORDS), replace=False)] = True
        out.append(np.packbits(mask, bitorder="little").view(np.uint64).tolist())
    return out


def spanning(i: np.ndarray, j: np.ndarray, differ: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a spanning forest of the pairs (i, j), the nearest first."""
    union, left, right = _Union(n), [], []
    for level in np.unique(differ):
        a, b = i[differ == level], j[differ == level]
        while True:
            ra, rb = union.p[a], union.p[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            one = np.unique(np.maximum(ra, rb), return_index=True)[1]  # a pair for each set
            left.append(a[one]), right.append(b[one])
            union.join(a[one], b[one])
    none = np.zeros(0, np.int64)
    return np.concatenate(left) if left else none, np.concatenate(right) if right else none


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the nodes of a partition, whose rows (key, node, words) come sorted by key and Gray rank."""

    def pairs(key: np.ndarray, node: np.ndarray, code: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        size = np.bincount(group)[group]
        left, right = [], []
        small = size <= LEAF
        for k in range(1, min(LEAF, len(key))):
            i = np.nonzero(small[:-k] & (key[:-k] == key[k:]))[0]
            i = i[np.bitwise_count(code[i] ^ code[i + k]).sum(-1) <= RADIUS]
            left.append(i), right.append(i + k)
        for at in np.nonzero(new & ~small)[0]:
            n = int(size[at])
            for start in range(0, max(1, n - WINDOW // 2), WINDOW // 2):
                part = code[at + start : at + min(n, start + WINDOW)]
                found = list(near_pairs(part, RADIUS))
                if found:
                    i, j = spanning(*map(np.concatenate, zip(*found)), len(part))
                    left.append(i + at + start), right.append(j + at + start)
        if left:
            a, b = (node[np.concatenate(x).astype(np.int64)] for x in (left, right))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    rest = None
    for batch in batches:
        if not len(batch):
            continue
        now = [np.asarray(batch.column(0)), np.asarray(batch.column(1)), np.stack([np.asarray(c).view(np.uint64) for c in batch.columns[2:]], axis=1)]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now)]
        last = np.nonzero(now[0] != now[0][-1])[0]
        cut = int(last[-1]) + 1 if len(last) else 0
        # of a very large last node only half a window waits for what follows
        over = len(now[0]) - cut > 16 * WINDOW
        yield from pairs(*(x[: len(x) if over else cut] for x in now)) if over or cut else ()
        rest = [x[-WINDOW // 2 :] if over else x[cut:] for x in now]
    if rest is not None:
        yield from pairs(*rest)


def candidate_pairs(uniq: DataFrame) -> DataFrame:
    """(a, b) nodes whose fingerprints are near; ``uniq``: node, f0, f1, ..."""
    chosen = masks(uniq.count())
    ranked = uniq
    for k, name in enumerate(_CODE):  # the position in the reflected Gray sequence
        x = F.col(name)
        for s in (1, 2, 4, 8, 16, 32):
            x = x.bitwiseXOR(F.shiftrightunsigned(x, s))
            ranked = ranked.withColumn(f"g{k}", x)
            x = F.col(f"g{k}")
    entry = lambda t, m: F.struct(
        F.xxhash64(F.lit(t), *[F.col(c).bitwiseAND(F.lit(_signed(w))) for c, w in zip(_CODE, m)]).alias("key"), F.col(f"g{t % WORDS}").alias("rank"))
    spread = ranked.select("node", *_CODE, F.explode(F.array(*[entry(t, m) for t, m in enumerate(chosen)])).alias("e"))
    rows = spread.select("e.key", "e.rank", "node", *_CODE)
    dealt = rows.repartitionByRange("key", "rank").sortWithinPartitions("key", "rank").select("key", "node", *_CODE)
    return dealt.mapInArrow(_search, "a long, b long").distinct()


def bucket_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of a set's hashes lie in each bucket; 255 stands for any number from there."""
    return np.minimum(np.bincount((hashes >> np.uint64(64 - BUCKETS)).astype(np.int64), minlength=1 << BUCKETS), 255).astype(np.uint8)


def most_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """No two sets with these rows of bucket counts share more."""
    least = np.minimum(a, b)
    return np.where((least == 255).any(-1), np.inf, least.sum(-1, dtype=np.int64))


def near_copies(docs: DataFrame, text_col: str, pairs: DataFrame, uniq: DataFrame) -> DataFrame:
    """The pairs whose shingle sets are similar enough; ``docs`` with __split and __row."""
    named = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
    uri = write_side(named.join(uniq, "node").select("node", F.col("x.__split").alias("__split"), F.col("x.__row").alias("row")), "compared")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, wanted = None, {}
        for split, batch in by_split(batches, 2):
            if split != at:
                side = read_side(uri, split)
                at, wanted = split, dict(zip(side.column("row").to_pylist(), side.column("node").to_pylist())) if side is not None else {}
            numbers = batch.column(1).to_pylist()
            here = [k for k, r in enumerate(numbers) if r in wanted]
            for k in range(0, len(here), 200):
                some = here[k : k + 200]
                texts = batch.column(0).take(pa.array(some)).to_pylist()
                sets = [np.unique(shingle_hashes(t, WIDTH)) for t in texts]
                columns = [pa.array([wanted[numbers[r]] for r in some], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array([bucket_counts(x).tobytes() for x in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "n", "counts", "set"])

    sets = materialize(docs.select(F.col(text_col).alias("__t"), "__row", "__split").mapInArrow(shingles, "node long, n long, counts binary, set binary"), "shingles")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            na, nb = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            ca, cb = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, 1 << BUCKETS) for c in batch.columns[4:])
            least = SIMILARITY / (1 + SIMILARITY) * (na + nb) - 1e-9
            can = (np.minimum(na, nb) >= least) & (most_shared(ca, cb) >= least)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(can)) for c in batch.columns[:2]], names=["a", "b"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                least = SIMILARITY / (1 + SIMILARITY) * (len(a) + len(b))  # the overlap at that similarity
                keep.append(min(len(a), len(b)) >= least - 1e-9 and len(np.intersect1d(a, b, assume_unique=True)) >= least - 1e-9)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    counts = sets.select("node", "n", "counts")
    both = pairs.join(counts.toDF("a", "na", "ca"), "a").join(counts.toDF("b", "nb", "cb"), "b").select("a", "b", "na", "nb", "ca", "cb")
    can = materialize(both.mapInArrow(bound, "a long, b long"), "pairs")
    few = sets.join(can.select("a").union(can.select("b")).distinct().toDF("node"), "node", "left_semi")
    left, right = few.select(F.col("node").alias("a"), F.col("set").alias("sa")), few.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    return can.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def _frequent(docs: DataFrame, text_col: str, count: int) -> str:
    """A table (token, n) of the shingles that occur in three or more texts of a sample."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(shingle_hashes(t, WIDTH)).view(np.int64))], names=["token"])

    some = docs.where(F.pmod(F.xxhash64("__row", "__split"), F.lit(max(1, count // SAMPLE))) == 0).select(text_col)
    uri = scratch(docs.sparkSession, "frequent")
    some.mapInArrow(tokens, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n >= 3").write.parquet(uri)
    return uri


def prefix(hashes: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles of a set, rarest first, of which a near copy shares one; ``tokens``, sorted, occur ``counts`` times."""
    times = np.zeros(len(hashes), np.int64)
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
        times = np.where(tokens[at] == hashes, counts[at], 0)
    return hashes[np.lexsort((hashes, times))][: len(hashes) - math.ceil(SIMILARITY * len(hashes) - 1e-9) + 1]


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows (token, node, root, n, after) with a token in common; a partition's rows come sorted by token."""

    def fits(x: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        _, _, root, n, after = x
        least = SIMILARITY / (1 + SIMILARITY) * (n[i] + n[j]) - 1e-9
        # of the first shingle in common, all others come after it
        return (root[i] != root[j]) & (np.minimum(n[i], n[j]) >= least) & (np.minimum(after[i], after[j]) + 1 >= least)

    def pairs(x: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        same = x[0][1:] == x[0][:-1]
        x = [c[np.append(False, same) | np.append(same, False)] for c in x]
        new = np.append(True, x[0][1:] != x[0][:-1])
        size = np.bincount(np.cumsum(new) - 1) if len(x[0]) else np.zeros(0, np.int64)
        small = np.repeat(size <= LEAF, size)
        found = []
        for k in range(1, min(LEAF, len(x[0]))):
            i = np.nonzero(small[:-k] & (x[0][:-k] == x[0][k:]))[0]
            i = i[fits(x, i, i + k)]
            found.append((i, i + k))
        start = np.cumsum(size) - size
        for at, m in zip(start[size > LEAF].tolist(), size[size > LEAF].tolist()):
            rows = max(1, STEP // m)
            for own in range(at, at + m, rows):
                i, j = np.arange(own, min(own + rows, at + m))[:, None], np.arange(own, at + m)[None, :]
                i, j = np.nonzero((i < j) & fits(x, i, j))
                found.append((i + own, j + own))
                if sum(len(f[0]) for f in found) > STEP:
                    yield out(x[1], found)
                    found = []
        if found:
            yield out(x[1], found)

    def out(node: np.ndarray, found: list) -> pa.RecordBatch:
        a, b = (node[np.concatenate(f)] for f in zip(*found))
        ab = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in ab], names=["a", "b"])

    waiting: list = []
    for batch in batches:
        if not len(batch):
            continue
        now = [np.asarray(c) for c in batch.columns]
        last = np.nonzero(now[0] != now[0][-1])[0]
        cut = int(last[-1]) + 1 if len(last) else 0
        # a token's rows wait for each other
        if cut or (waiting and waiting[-1][0][-1] != now[0][0]):
            yield from pairs([np.concatenate(c) for c in zip(*waiting, [x[:cut] for x in now])])
            waiting = []
        waiting.append([x[cut:] for x in now])
    if waiting:
        yield from pairs([np.concatenate(c) for c in zip(*waiting)])


def remaining_pairs(docs: DataFrame, text_col: str, uniq: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b) of all nodes of different roots that can be near copies; ``uniq``: node, x; ``docs`` with __split and __row."""
    order = _frequent(docs, text_col, uniq.count())
    named = uniq.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), F.col("x.__split").alias("__split"), F.col("x.__row").alias("row"))
    uri = write_side(named, "prefixes")

    def load() -> tuple[np.ndarray, np.ndarray]:
        table = read_table_files(order)
        tokens = table.column("token").to_numpy().view(np.uint64)
        at = np.argsort(tokens)
        return tokens[at], table.column("n").to_numpy()[at]

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(("shingle order", order), load)
        at, wanted = None, {}
        for split, batch in by_split(batches, 2):
            if split != at:
                side = read_side(uri, split)
                at, wanted = split, dict(zip(side.column("row").to_pylist(), zip(side.column("node").to_pylist(), side.column("root").to_pylist()))) if side is not None else {}
            numbers = batch.column(1).to_pylist()
            here = [k for k, r in enumerate(numbers) if r in wanted]
            for k in range(0, len(here), 200):
                some = here[k : k + 200]
                sets = [np.unique(shingle_hashes(t, WIDTH)) for t in batch.column(0).take(pa.array(some)).to_pylist()]
                first = [prefix(x, *known) if len(x) else x for x in sets]
                long = [len(x) for x in first]
                node, root = (np.repeat(np.array(c, np.int64), long) for c in zip(*[wanted[numbers[r]] for r in some]))
                n = np.array([len(x) for x in sets], np.int32)
                after = np.concatenate([len(x) - 1 - np.arange(m) for x, m in zip(sets, long)]).astype(np.int32)
                columns = [np.concatenate(first).view(np.int64), node, root, np.repeat(n, long), after]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "node", "root", "n", "after"])

    rows = docs.select(F.col(text_col).alias("__t"), "__row", "__split").mapInArrow(tokens, "token long, node long, root long, n int, after int")
    return rows.repartition("token").sortWithinPartitions("token").mapInArrow(_share, "a long, b long").distinct()


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each group of near copies, all columns unchanged."""
    source = with_rows(docs, SPAN)
    names, width = docs.columns, len(docs.columns)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        forget()
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, WIDTH)) for t in batch.column(3).to_pylist()]
            got = np.array([[*fingerprint(x), xxh64_intdigest(x.tobytes(), SEED)] for x in sets], np.uint64).reshape(-1, WORDS + 1).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(np.ascontiguousarray(c)) for c in got.T]], names=["__id", "__split", "__row", *_CODE, "__set"])

    fields = [T.StructField("__id", docs.schema[id_col].dataType), *T._parse_datatype_string("__split long, __row long, " + ", ".join(f"{c} long" for c in [*_CODE, "__set"])).fields]
    coded = source.select(F.col(id_col).alias("__id"), "__split", "__row", F.col(text_col).alias("__t")).mapInArrow(code, T.StructType(fields))
    first = F.min(F.struct(F.col("__id").isNull(), "__id", "__split", "__row")).alias("x")
    uniq = materialize(coded.groupBy(*_CODE, "__set").agg(first).withColumn("node", F.monotonically_increasing_id()), "fingerprints")
    pairs = materialize(candidate_pairs(uniq.select("node", *_CODE)), "pairs")
    roots = connected_components(near_copies(source, text_col, pairs, uniq.select("node", "x")))
    others = materialize(remaining_pairs(source, text_col, uniq.select("node", "x"), roots), "pairs")
    if not others.isEmpty():
        more = near_copies(source, text_col, others, uniq.select("node", "x"))
        roots = connected_components(roots.toDF("a", "b").unionByName(more))
    # a component's row is the least of its sets' rows
    kept = uniq.join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("x").alias("x"))
    uri = write_side(kept.select(F.col("x.__split").alias("__split"), F.col("x.__row").alias("row")), "kept")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stay = None, np.zeros(0, np.int64)
        for split, batch in by_split(batches, width + 1):
            if split != at:
                side = read_side(uri, split)
                at, stay = split, np.sort(side.column("row").to_numpy()) if side is not None else np.zeros(0, np.int64)
            out = batch.filter(pa.array(np.isin(np.asarray(batch.column(width)), stay)))
            yield pa.RecordBatch.from_arrays(out.columns[:width], names=names)

    return source.mapInArrow(sift, docs.schema)
