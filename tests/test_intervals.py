"""Interval algebra against nested loops, and its identities."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import intervals as iv
from strandline.operators.calls import greedy_match


def table(rng, n, span=3000, longest=120):
    rows = []
    for i in range(n):
        s = rng.randrange(span)
        rows.append((rng.choice("ab"), s, s + rng.randint(1, longest), i))
    return rows


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(5)
    a, b = table(rng, 300), table(rng, 300, longest=900)
    schema = "chrom string, start long, end long, id int"
    return a, b, spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)


def loop(a, b, slack=0):
    return {(x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] - slack < y[2] and y[1] < x[2] + slack}


@pytest.mark.parametrize("width,slack", [(50, 0), (1000, 0), (100, 7)])
def test_overlap_join_is_the_nested_loop(sides, width, slack):
    a, b, l, r = sides
    got = [(x["id"], x["r_id"]) for x in iv.overlap_join(l, r, ["chrom"], width, slack=slack).collect()]
    assert len(got) == len(set(got)) and set(got) == loop(a, b, slack)


def test_left_semi_anti(sides):
    a, b, l, r = sides
    far = r.where("id < 20")
    pairs = loop(a, [y for y in b if y[3] < 20])
    hit = {x for x, _ in pairs}
    left = iv.overlap_join(l, far, ["chrom"], 100, "left").collect()
    assert len(left) == len(pairs) + 300 - len(hit)
    assert {x["id"] for x in iv.overlap_join(l, far, ["chrom"], 100, "semi").collect()} == hit
    assert {x["id"] for x in iv.overlap_join(l, far, ["chrom"], 100, "anti").collect()} == set(range(300)) - hit


def covered(rows):
    return {(c, p) for c, s, e, *_ in rows for p in range(s, e)}


@pytest.mark.parametrize("width", [None, 64])
def test_merge_covers_the_same_bases_and_is_stable(sides, width):
    a, _, l, _ = sides
    m = iv.merge(l, ["chrom"], width=width)
    rows = [(x["chrom"], x["start"], x["end"]) for x in m.collect()]
    assert covered(rows) == covered(a) and sum(e - s for _, s, e in rows) == len(covered(a))
    again = iv.merge(m.drop("n"), ["chrom"], width=width).drop("n")
    assert sorted(map(tuple, again.select("chrom", "start", "end").collect())) == sorted(rows)


def test_subtract_and_intersect_part_the_left_side(sides):
    a, b, l, r = sides
    s = covered(map(tuple, iv.subtract(l, r, ["chrom"]).select("chrom", "start", "end").collect()))
    i = covered(map(tuple, iv.intersect(l, r, ["chrom"], 100).collect()))
    assert s | i == covered(a) and not s & i and i == covered(a) & covered(b)


def test_segments_and_windows(sides, spark):
    a, b, l, r = sides
    seg = iv.segments({"x": l, "y": r}, ["chrom"]).collect()
    assert covered((x["chrom"], x["start"], x["end"]) for x in seg) == covered(a) | covered(b)
    w = iv.windows(spark.createDataFrame([("a", 0, 25)], "chrom string, start long, end long"), 10).orderBy("start").collect()
    assert [(x["start"], x["end"]) for x in w] == [(0, 10), (10, 20), (20, 25)]


def test_recurrent_loci_fixture(spark):
    rows = [("chr1", "DEL", 1000, 3000, "s1", 1.0), ("chr1", "DEL", 4000, 5000, "s2", 2.0), ("chr1", "DEL", 6001, 7000, "s3", 3.0), ("chr1", "DUP", 1000, 2000, "s1", 4.0)]
    df = spark.createDataFrame(rows, "contig string, svtype string, start long, end long, sample string, qs double")
    for width in (None, 500):
        got = iv.recurrent_loci(df, ["contig", "svtype"], "sample", 1000, 2, ["qs"], width).collect()
        assert [(r["start"], r["end"], r["call_count"], r["sample_count"], r["length"]) for r in got] == [(1000, 5000, 2, 2, 4001)]


def test_kit_score_fixture(spark):
    kit = spark.createDataFrame([("k", "c", 0, 100), ("k", "c", 200, 300)], "kit string, chrom string, start long, end long")
    cov = spark.createDataFrame([("c", 0, 50, 25.0), ("c", 50, 100, 10.0), ("c", 200, 300, 20.0)], "chrom string, start long, end long, cov double")
    r = iv.covered_share(kit, cov, ["chrom"], "kit", "cov", 20, 50).first()
    assert r["score"] == 0.75
    best = iv.best_kit(spark.createDataFrame([("A", 0.5, 1), ("B", 0.5, 0)], "kit string, score double, ord int"), "kit", "b").first()
    assert best["best"] == "B" and not best["differs"]


def test_greedy_match_fixture(spark):
    schema = "sample string, ord int, start long, end long"
    l = spark.createDataFrame([("s", 0, 99, 199), ("s", 1, 99, 199), ("t", 0, 99, 199)], schema)
    r = spark.createDataFrame([("s", 0, 149, 249), ("t", 0, 150, 250)], schema)
    got = sorted((x["sample"], x["l"], x["r"], x["status"]) for x in greedy_match(l, r, ["sample"], "ord").fillna(-1).collect())
    assert got == [("s", 0, 0, "both"), ("s", 1, -1, "left_only"), ("t", -1, 0, "right_only"), ("t", 0, -1, "left_only")]


def test_greedy_match_is_the_sequential_model(sides):
    a, b, l, r = sides
    got = {(x["l"], x["r"]) for x in greedy_match(l.withColumnRenamed("id", "ord"), r.withColumnRenamed("id", "ord"), ["chrom"], "ord", 0.2).where("status = 'both'").collect()}
    taken, want = set(), set()
    for x in sorted(a, key=lambda x: x[3]):
        best = None
        for y in sorted(b, key=lambda y: y[3]):
            o = min(x[2], y[2]) - max(x[1], y[1])
            if x[0] == y[0] and y[3] not in taken and o > 0 and min(o / (x[2] - x[1]), o / (y[2] - y[1])) >= 0.2 and (best is None or o > best[0]):
                best = (o, y[3])
        if best:
            taken.add(best[1])
            want.add((x[3], best[1]))
    assert got == want


def test_slop_and_base_content(spark):
    df = spark.createDataFrame([("c", 100, 200), ("c", 900, 950)], "chrom string, start long, end long")
    size = spark.createDataFrame([("c", 1000)], "chrom string, length long")
    assert [(r["start"], r["end"]) for r in iv.slop(df, size, "chrom", 300).orderBy("start").collect()] == [(0, 500), (600, 1000)]
    assert [(r["start"], r["end"]) for r in iv.slop_ends(df, size, "chrom", 1000).orderBy("start").collect()] == [(0, 200), (900, 999)]
    ref = spark.createDataFrame([("c", i, "NNACGGTTNN" * 10) for i in range(10)], "chrom string, block long, seq string")
    r = iv.base_content(df, ref, "chrom", 100).orderBy("start").first()
    assert (r["n_share"], r["gc_share"]) == (0.4, 0.5)


def test_empty_tables(spark):
    e = spark.createDataFrame([], "chrom string, start long, end long, id int")
    assert iv.merge(e, ["chrom"]).count() == iv.subtract(e, e, ["chrom"]).count() == iv.overlap_join(e, e, ["chrom"], 10).count() == 0


def test_interval_order(spark):
    df = spark.createDataFrame([(c, 1, 2) for c in ("chrX", "chr10", "chr2", "chrM", "chrUn", "chrY")], "chrom string, start long, end long")
    assert [r["chrom"] for r in iv.genome_order(df).collect()] == ["chr2", "chr10", "chrX", "chrY", "chrM", "chrUn"]
    assert iv.shift_circular(df.select(F.lit(99).alias("pos")), 5, 100).first()["pos"] == 4


def test_semi_and_anti_joins_keep_repeated_rows(spark):
    schema = "chrom string, start long, end long, note string"
    left = spark.createDataFrame([("a", 0, 300, None), ("a", 0, 300, None), ("a", 900, 950, "x"), ("a", 900, 950, "x"), (None, 1, 5, "n")], schema)
    right = spark.createDataFrame([("a", 10, 20, ""), ("a", 250, 260, "")], schema)
    assert sorted(r["start"] for r in iv.overlap_join(left, right, ["chrom"], 50, "semi").collect()) == [0, 0]
    assert sorted(r["start"] for r in iv.overlap_join(left, right, ["chrom"], 50, "anti").collect()) == [1, 900, 900]
