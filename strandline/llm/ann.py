"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Index. Equal vectors collapse into one node (its id is the least of theirs). The first
lists come from blocks of random-hyperplane orderings; rounds of NN-descent follow until
one changes at most ``SETTLED`` of all list entries, each a set of Spark joins: a node gets the vectors of a sample of its
neighbours and reverse neighbours (fresh edges first), and any two of them that are
closer than one's worst list entry propose each other. Proposals are reduced to the
least ``NEIGHBOURS`` a node after the shuffle. A round takes four shuffles, a search round three:
what a node has and who wants it are dealt by the node together. The search graph has the lists,
up to ``REVERSE`` nearest reverse edges of each node, and for each node a tree of bounded
degree over those that have it as their nearest, so a node and its nearest reach each
other. The components of edges that go both ways get one member each, the least, and
these are linked in the same manner, over again until there are at most as many as
start points; a least spanning tree then links those: every node is reached from every
other. All of them being start points, no other edge between them changes a search.

Search. Queries are handled in blocks whose vectors have a bounded size. Each round
expands the ``EXPAND`` nearest unexpanded members of each query's beam of ``BEAM`` by a
join with the graph, measures the new neighbours in a join with the vectors (only ids
and distances are shuffled to the queries) and merges; it ends when every member of
every beam is expanded. Start points are the query's own node, ``PIVOTS`` nodes (or twice the
square root of their number, if that is more) chosen by hash, and the members that
stand for the components once there are at most as many. Distances are Euclidean in
double precision.

Edge cases. Null, zero and empty vectors, vectors with a null or non-finite component,
and vectors not of the most frequent length (the greater on ties) take no part. Copies
are separate candidates; ties go to the smaller id. With fewer candidates than asked
for, all are returned; tables of up to PIVOTS different vectors are searched exactly.
Rows with equal ids count once for each row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.components import connected_components
from strandline.llm.shared import materialize, remove

NEIGHBOURS, REVERSE = 20, 20
TREES, TREE_BLOCK, SETTLED, SAMPLE = 8, 512, 0.001, 10
BEAM, EXPAND, PIVOTS = 600, 128, 512
QUERY_BYTES = 8_000_000


def _matrix(column: pa.Array, dtype: np.dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _flat(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, np.dtype, int]:
    """(id, vec as bytes) of the rows that take part, the component type and the dimension."""
    dtype = np.dtype("<f4") if "float" in dict(rows.dtypes)[vec_col] else np.dtype("<f8")
    sizes = rows.groupBy(F.size(vec_col).alias("n")).agg(F.count(F.lit(1)).alias("c")).where("n > 0").orderBy(F.desc("c"), F.desc("n")).limit(1).collect()
    width = sizes[0]["n"] if sizes else 1
    kind = "float" if dtype.itemsize == 4 else "double"
    fine = f"size(`{vec_col}`) = {width} and not exists(`{vec_col}`, x -> x is null or isnan(x) or abs(x) = {kind}('Infinity')) and exists(`{vec_col}`, x -> x != 0)"
    source = rows.where(f"coalesce({fine}, false)").select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where("id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(dtype) + dtype.type(0)  # -0 becomes 0
            raw, step = flat.tobytes(), width * dtype.itemsize
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw[k : k + step] for k in range(0, len(raw), step)], pa.binary())], names=["id", "vec"])

    return source.mapInArrow(run, "id long, vec binary"), dtype, width


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole runs of equal first column from sorted batches."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        now = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        key = now.column(0).to_numpy()
        cut = int(np.nonzero(key != key[-1])[0][-1]) + 1 if key[0] != key[-1] else 0
        if cut:
            yield now.slice(0, cut)
        rest = now.slice(cut)
    if rest is not None:
        yield rest


def _forget(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    if files := df.inputFiles():
        remove(df.sparkSession, files[0].rsplit("/", 1)[0])


def _tree(found: list[tuple[int, bytes]], dtype: np.dtype, width: int) -> list[tuple[int, int, bool]]:
    """The edges, both ways, of a least spanning tree over some nodes and their vectors."""
    x = np.frombuffer(b"".join(f[1] for f in found), dtype).reshape(-1, width).astype(np.float64)
    near, into, edges, last = np.full(len(x), np.inf), np.zeros(len(x), np.int64), [], 0
    out = np.ones(len(x), bool)
    out[0] = False
    for _ in range(len(x) - 1):
        d = ((x - x[last]) ** 2).sum(1)
        closer = d < near
        near[closer], into[closer] = d[closer], last
        rest = np.nonzero(out)[0]
        last = int(rest[near[rest].argmin()])
        out[last] = False
        a, b = found[last][0], found[into[last]][0]
        edges += [(a, b, True), (b, a, True)]
    return edges


class NeighbourGraph:
    """nodes (node, vec, ids: up to ``top`` + 1 least ids), graph (node, nbrs), starts (node)."""

    def __init__(self, nodes: DataFrame, graph: DataFrame, dtype: np.dtype, width: int, rows: DataFrame, starts: DataFrame):
        self.nodes, self.graph, self.dtype, self.width, self.rows, self.starts = nodes, graph, dtype, width, rows, starts

    @classmethod
    def build(cls, table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = 10, seed: int = 11) -> NeighbourGraph:
        flat, dtype, width = _flat(table, id_col, vec_col)
        rows = materialize(flat, "vectors")
        rank = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
        nodes = materialize(
            rows.withColumn("r", rank).where(F.col("r") <= top + 1).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
            .select(F.col("ids")[0].alias("node"), "vec", "ids"),
            "nodes",
        )
        vectors = nodes.select("node", "vec")
        all_nodes = count = nodes.count()
        pivots = max(PIVOTS, int(2 * count**0.5))
        starts = nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(pivots)
        links, part = cls._links(vectors, count, dtype, width, seed), vectors
        both = links
        while count > 1 and all_nodes > pivots:  # else every node is a start point
            heads = materialize(cls._heads(links), "heads")
            count = heads.count()
            if count <= pivots:
                starts = starts.unionByName(heads)
                if count > 1:  # few enough for the driver, which holds as many start points in a search
                    found = sorted((r["node"], bytes(r["vec"])) for r in part.join(heads, "node").select("node", "vec").collect())
                    both = both.unionByName(table.sparkSession.createDataFrame(_tree(found, dtype, width), "a long, b long, sure boolean"))
                break
            part = materialize(part.join(heads, "node").select("node", "vec"), "heads")
            links = cls._links(part, count, dtype, width, seed)
            both = both.unionByName(links)
        graph = materialize(both.select("a", "b").distinct().groupBy("a").agg(F.collect_list("b").alias("nbrs")).withColumnRenamed("a", "node"), "graph")
        return cls(nodes, graph, dtype, width, rows, materialize(starts.distinct(), "starts"))

    @classmethod
    def _links(cls, vectors: DataFrame, count: int, dtype: np.dtype, width: int, seed: int) -> DataFrame:
        """(a, b, sure): directed edges of the search graph; if ``sure``, other edges lead back from b to a."""
        edges = materialize(cls._first_lists(vectors, count, dtype, width, seed), "edges")
        turn, new = 0, count
        while new > SETTLED * NEIGHBOURS * count:
            old, edges = edges, materialize(cls._descend(edges, vectors, turn, dtype, width), "edges")
            _forget(old)
            turn, new = turn + 1, edges.where("fresh").count()
        back = edges.withColumn("p", F.row_number().over(Window.partitionBy("b").orderBy("d", "a"))).where(F.col("p") <= REVERSE)
        first = edges.where("r = 1")
        # those with the same nearest are ranked by distance; rank r hangs below rank (r - 1) / REVERSE, the first ranks below the nearest itself
        first = materialize(first.select("a", "b", F.row_number().over(Window.partitionBy("b").orderBy("d", "a")).cast("long").alias("r")), "nearest")
        top = first.where(F.col("r") <= REVERSE).select(F.col("b").alias("a"), F.col("a").alias("b"))
        upper = first.select(F.col("a").alias("above"), "b", F.col("r").alias("up"))
        below = first.where(F.col("r") > REVERSE).withColumn("up", F.expr(f"(r - 1) div {REVERSE}")).join(upper, ["b", "up"]).select(F.col("above").alias("a"), F.col("a").alias("b"))
        plain = edges.select("a", "b").unionByName(back.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(top).unionByName(below).distinct()
        ways = plain.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("from"))
        known = ways.join(first.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct().withColumn("near", F.lit(True)), ["x", "y"], "left")
        one = F.struct(F.col("from").alias("a"), F.when(F.col("from") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("b"))
        two = F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b")), F.struct(F.col("y").alias("a"), F.col("x").alias("b")))
        sure = ((F.col("n") == 2) | F.coalesce("near", F.lit(False))).alias("sure")
        return materialize(known.select(F.explode(F.when(F.col("n") == 2, two).otherwise(F.array(one))).alias("e"), sure).select("e.a", "e.b", "sure"), "links")

    @staticmethod
    def _heads(links: DataFrame) -> DataFrame:
        """(node): the least node of each set whose members reach each other."""
        return connected_components(links.where("sure").select("a", "b")).select(F.col("root").alias("node")).distinct()

    @staticmethod
    def _first_lists(vectors: DataFrame, count: int, dtype: np.dtype, width: int, seed: int) -> DataFrame:
        """(a, b, d, fresh, ...): neighbours inside blocks of TREES hyperplane orderings; d is squared."""
        bits = max(0, min(40, int(np.log2(max(1, count / TREE_BLOCK)))))
        planes = np.random.default_rng(seed).normal(size=(TREES, bits + 1, width))

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1), dtype, width).astype(np.float64)
                for t in range(TREES):
                    side = x @ planes[t].T
                    code = ((side[:, :bits] > 0) << np.arange(bits, dtype=np.int64)).sum(1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t)), pa.array(code.astype(np.int64)), pa.array(side[:, bits]), *batch.columns], names=["tree", "code", "side", "node", "vec"])

        def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            n = 0

            def block(part: pa.Table) -> Iterator[pa.RecordBatch]:
                tree, node = part.column(0).to_numpy(), part.column(1).to_numpy()
                x = _matrix(part.column(2).combine_chunks(), dtype, width).astype(np.float64)
                for at in range(0, len(x), TREE_BLOCK):
                    v, who, t = x[at : at + TREE_BLOCK], node[at : at + TREE_BLOCK], tree[at : at + TREE_BLOCK]
                    if len(v) < 2:
                        continue
                    sq = (v * v).sum(1)
                    d = np.maximum(sq[:, None] + sq[None] - 2 * v @ v.T, 0)
                    d[t[:, None] != t[None]] = np.inf
                    np.fill_diagonal(d, np.inf)
                    k = min(NEIGHBOURS, len(v) - 1)
                    near = np.argpartition(d, k - 1, axis=1)[:, :k]
                    a, b, dd = np.repeat(who, k), who[near].ravel(), np.take_along_axis(d, near, 1).ravel()
                    ok = np.isfinite(dd)
                    yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok]), pa.array(dd[ok]), pa.array(np.ones(ok.sum(), bool))], names=["a", "b", "d", "fresh"])

            for batch in batches:
                held.append(batch)
                n += len(batch)
                if n >= 16 * TREE_BLOCK:
                    whole = pa.Table.from_batches(held)
                    cut = n // TREE_BLOCK * TREE_BLOCK
                    yield from block(whole.slice(0, cut))
                    held, n = whole.slice(cut).to_batches(), n - cut
            if n:
                yield from block(pa.Table.from_batches(held))

        keyed = vectors.mapInArrow(spread, "tree long, code long, side double, node long, vec binary")
        parts = max(1, min(2000, TREES * count // 20_000))
        dealt = keyed.repartitionByRange(parts, "tree", "code", "side").sortWithinPartitions("tree", "code", "side").select("tree", "node", "vec")
        return _least(dealt.mapInArrow(inside, "a long, b long, d double, fresh boolean"), 0)

    @staticmethod
    def _descend(edges: DataFrame, vectors: DataFrame, turn: int, dtype: np.dtype, width: int) -> DataFrame:
        """One round: neighbours of neighbours propose each other."""
        behind = edges.withColumn("p", F.row_number().over(Window.partitionBy("b").orderBy(*_drawn(turn)))).where(F.col("p") <= SAMPLE)
        # what a node has, and who wants it: one shuffle by the node, and the rest is filled in beside it
        has = vectors.select(F.col("node").alias("m"), "vec").unionByName(edges.where("r = 1").select(F.col("a").alias("m"), "worst"), allowMissingColumns=True)
        wants = edges.where("picked").select(F.col("a").alias("at"), F.col("b").alias("m")).unionByName(behind.select(F.col("b").alias("at"), F.col("a").alias("m")))
        met = _filled(has.unionByName(wants, allowMissingColumns=True), "m", ["worst", "vec"]).where("at is not null and worst is not null")
        met = met.select("at", "m", "worst", "vec").repartition("at").sortWithinPartitions("at", "m")

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _runs(batches):
                at, m = part.column(0).to_numpy(), part.column(1).to_numpy()
                part = part.filter(pa.array(np.append(True, (at[1:] != at[:-1]) | (m[1:] != m[:-1]))))  # one may be ahead and behind
                at, m, worst_of = (part.column(k).to_numpy() for k in range(3))
                x = _matrix(part.column(3).combine_chunks(), dtype, width).astype(np.float64)  # single precision loses what parts near vectors far from the origin
                begin = np.nonzero(np.append(True, at[1:] != at[:-1]))[0]
                size = np.diff(np.append(begin, len(at)))
                for k in np.unique(size):
                    if k < 2:
                        continue
                    for some in np.array_split(begin[size == k], max(1, int((size == k).sum() * k * k // 200_000))):
                        if not len(some):
                            continue
                        rows = some[:, None] + np.arange(k)
                        v = x[rows]
                        sq = np.einsum("gid,gid->gi", v, v)
                        d = np.maximum(sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1)), 0)
                        who = m[rows]
                        good = (d < worst_of[rows][:, :, None]) & (who[:, :, None] != who[:, None, :])
                        g, i, j = np.nonzero(good)
                        yield pa.RecordBatch.from_arrays([pa.array(who[g, i]), pa.array(who[g, j]), pa.array(d[g, i, j]), pa.array(np.ones(len(g), bool))], names=["a", "b", "d", "fresh"])

        proposed = met.mapInArrow(join, "a long, b long, d double, fresh boolean")
        return _least(edges.select("a", "b", "d", F.lit(False).alias("fresh")).unionByName(proposed), turn + 1)

    def search(self, top: int = 10, queries: str = "true") -> DataFrame:
        """(query_id, rank, id, score) of the rows for which the SQL condition ``queries`` on ``id`` holds, against every other row."""
        spark, dtype, width = self.nodes.sparkSession, self.dtype, self.width
        asked = materialize(self.rows.where(queries).join(self.nodes.select("node", "vec"), "vec").select(F.col("id").alias("query_id"), F.col("node").alias("q")), "asked")
        wanted = materialize(asked.select("q").distinct(), "wanted")
        per = max(1, QUERY_BYTES // (width * dtype.itemsize))
        blocks = max(1, -(-wanted.count() // per))
        pivots = self.nodes.join(self.starts, "node").select("node", "vec").collect()  # at most twice PIVOTS or 4 roots of the table
        found = None
        for k in range(blocks):
            part = wanted.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == k)
            chosen = sorted((r["node"], bytes(r["vec"])) for r in part.join(self.nodes, part.q == self.nodes.node).select("node", "vec").collect())  # about QUERY_BYTES
            beams = self._beams(spark, chosen, [(r["node"], bytes(r["vec"])) for r in pivots])
            found = beams if found is None else found.unionByName(beams)
        last = F.row_number().over(Window.partitionBy("q").orderBy("d", "node"))
        best = found.withColumn("r", last).withColumn("edge", F.max(F.when(F.col("r") == top + 1, F.col("d"))).over(Window.partitionBy("q"))).where(
            (F.col("r") <= top + 1) | (F.col("d") == F.col("edge"))
        )
        near = best.join(self.nodes.select("node", "ids"), "node").select("q", "d", F.explode("ids").alias("id"))
        rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))
        near = near.withColumn("r", rank).where(F.col("r") <= 2 * top + 2).groupBy("q").agg(F.sort_array(F.collect_list(F.struct("d", "id"))).alias("near"))
        near = materialize(near, "near")
        mine = asked.join(near, "q").select("query_id", F.expr(f"slice(filter(near, x -> x.id != query_id), 1, {top})").alias("near"))
        return mine.select("query_id", F.posexplode("near").alias("p", "x")).select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.id").alias("id"), F.col("x.d").alias("score"))

    def _beams(self, spark, chosen: list[tuple[int, bytes]], pivots: list[tuple[int, bytes]]) -> DataFrame:
        """(q, node, d): the final beams of one block of queries."""
        dtype, width = self.dtype, self.width
        empty = "q long, node long, d double, s int"
        if not chosen:
            return spark.createDataFrame([], empty).select("q", "node", "d")
        shared = spark.sparkContext.broadcast((np.array([c[0] for c in chosen]), b"".join(c[1] for c in chosen), np.array([p[0] for p in pivots]), b"".join(p[1] for p in pivots)))

        def matrices():
            ids, raw, pivot_ids, pivot_raw = shared.value
            return ids, np.frombuffer(raw, dtype).reshape(-1, width), pivot_ids, np.frombuffer(pivot_raw, dtype).reshape(-1, width)

        def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, x, pivot_ids, p = matrices()
            p = p.astype(np.float64)
            for batch in batches:
                for at in batch.column(0).to_pylist():
                    d = np.append(np.sqrt(((p - x[at].astype(np.float64)) ** 2).sum(1)), 0.0)  # the last is the query's own node
                    n = len(d)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, ids[at])), pa.array(np.append(pivot_ids, ids[at])), pa.array(d), pa.array(np.zeros(n, np.int32))], names=["q", "node", "d", "s"])

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, x, _, _ = matrices()
            for whole in batches:
                for k in range(0, len(whole), 5000):
                    batch = whole.slice(k, 5000)
                    q = batch.column(0).to_numpy()
                    y = _matrix(batch.column(2), dtype, width).astype(np.float64)
                    d = np.sqrt(((y - x[np.searchsorted(ids, q)].astype(np.float64)) ** 2).sum(1))
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d), pa.array(np.zeros(len(q), np.int32))], names=["q", "node", "d", "s"])

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _runs(batches):
                q, node, d, s = (part.column(k).to_numpy() for k in range(4))
                keep = np.append(True, (q[1:] != q[:-1]) | (node[1:] != node[:-1]))  # the same pair has the same distance, so it is adjacent
                q, node, d, s = q[keep], node[keep], d[keep], s[keep].copy()
                begin = np.nonzero(np.append(True, q[1:] != q[:-1]))[0]
                size = np.diff(np.append(begin, len(q)))
                place = np.arange(len(q)) - np.repeat(begin, size)
                keep = place < BEAM
                q, node, d, s = q[keep], node[keep], d[keep], s[keep]
                open_ = (s == 0).astype(np.int64)
                begin = np.nonzero(np.append(True, q[1:] != q[:-1]))[0]
                run = np.cumsum(open_)
                before = np.repeat(run[begin] - open_[begin], np.diff(np.append(begin, len(q))))
                s[(s == 0) & (run - before <= EXPAND)] = 1
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(node), pa.array(d), pa.array(s)], names=["q", "node", "d", "s"])

        def merged(rows: DataFrame) -> DataFrame:
            return materialize(rows.repartition("q").sortWithinPartitions("q", "d", "node", F.desc("s")).mapInArrow(merge, empty), "beams")

        state = merged(spark.range(len(chosen)).mapInArrow(start, empty))
        while True:
            ahead = state.where("s = 1").select("q", "node")
            if ahead.isEmpty():
                return state.select("q", "node", "d")
            asked = _filled(ahead.unionByName(self.graph, allowMissingColumns=True), "node", ["nbrs"]).where("q is not null")
            reached = asked.select("q", F.explode("nbrs").alias("node")).unionByName(self.nodes.select("node", "vec"), allowMissingColumns=True)
            reached = _filled(reached.repartition("node").groupBy("node", "q").agg(F.first("vec", ignorenulls=True).alias("vec")), "node", ["vec"])
            measured = reached.where("q is not null").select("q", "node", "vec").mapInArrow(measure, empty)
            done = state.withColumn("s", F.when(F.col("s") > 0, F.lit(2)).otherwise(F.col("s")).cast("int"))
            old, state = state, merged(done.unionByName(measured))
            _forget(old)


def _drawn(turn: int) -> list:
    """The order in which a round samples edges: fresh ones first, else by hash."""
    return [F.desc("fresh"), F.xxhash64("a", "b", F.lit(turn))]


def _least(edges: DataFrame, turn: int) -> DataFrame:
    """The NEIGHBOURS nearest different b of every a; an edge that was there before isn't fresh.

    r: the place in the list; worst: the distance that a proposal has to beat; picked: whether round ``turn`` samples the edge.
    All of it is told after one shuffle by a.
    """
    mine = Window.partitionBy("a")
    one = edges.repartition("a").groupBy("a", "b").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    kept = one.withColumn("r", F.row_number().over(mine.orderBy("d", "b"))).where(F.col("r") <= NEIGHBOURS)
    worst = F.when(F.count(F.lit(1)).over(mine) >= NEIGHBOURS, F.max("d").over(mine)).otherwise(F.lit(float("inf")))
    return kept.withColumn("worst", worst).withColumn("picked", F.row_number().over(mine.orderBy(*_drawn(turn))) <= SAMPLE)


def _filled(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of several kinds after one shuffle by ``key``: each gets the ``columns`` of the row of its key that has them."""
    every = Window.partitionBy(key)
    return rows.withColumns({c: F.first(c, ignorenulls=True).over(every) for c in columns})
