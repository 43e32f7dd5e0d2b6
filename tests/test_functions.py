"""Scalar functions on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from strandline.functions import fields, genome, hashing
from strandline.functions import records as rec
from strandline.operators import stats as st
from strandline.sources.sinks import number_text


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [("Reads with MAPQ [40:inf)", "reads_with_mapq_40_inf"), ("1st read", "_1st_read"), ("%%", "funknown")])
def test_identifier(spark, raw, want):
    assert one(spark, fields.clean_identifier(F.lit(raw))) == want


def test_fields(spark):
    assert one(spark, fields.info_map(F.lit("A=1;FLAG;B=x=y;A=2;."))) == {"A": "2", "FLAG": "", "B": "x=y"}
    assert one(spark, fields.sample_fields(F.lit("GT:CN:NP"), F.lit("0/1:2"))) == {"GT": "0/1", "CN": "2"}
    assert one(spark, fields.read_group_name(F.lit("TM014_4_1_GATCAG"))) == "TM014_4_GATCAG"
    assert one(spark, fields.read_group_name(F.lit("a_b"))) == "a_b"
    assert one(spark, fields.read_name(F.lit("@r1/2 x"))) == "r1"
    assert tuple(one(spark, fields.phase_code(F.lit("123+4ACGT|A")))) == (123, 4, "ACGT", "A", True)
    assert tuple(one(spark, fields.phase_code(F.lit("045G!T")))) == (45, 1, "G", "T", False)
    assert one(spark, fields.nearest_position(F.lit(995), F.lit(2003))) == 1995
    assert one(spark, fields.size_bytes(F.lit("1.5K"))) == 1536
    assert one(spark, fields.duration_text(F.lit(90061))) == "1d 01:01:01"
    assert one(spark, fields.common_stem(F.array(F.lit("/a/sample_one_1.fq"), F.lit("/b/sample_one_2.fq")))) == "sample_one_"
    assert [one(spark, fields.whole(F.lit(v))) for v in ("", ".", "7", "x")] == [None, None, 7, None]
    assert one(spark, fields.real_list(F.lit("1,x,2.5"))) == [1.0, 2.5]


def test_regions(spark):
    pick = lambda f, v: one(spark, f(F.lit(v)))
    assert [pick(genome.to_level0, v) for v in ("A33", "X22H")] == ["F", "XH"]
    assert [pick(genome.to_level1, v) for v in ("A33", "X22H", "O1")] == ["A3", "XH", "A9"]
    assert one(spark, genome.region_name(F.lit("A"), F.lit(2), F.lit(3), F.lit(2))) == "A03"
    assert [pick(genome.chromosome_group, v) for v in ("chr7", "X", "chrY", "MT")] == ["auto", "chrx", None, "chrm"]


def test_runs(spark):
    r = rec.runs(F.lit("10S80M5I3D5X"))
    assert tuple(one(spark, rec.run_totals(r))) == (10, 80, 5, 3)
    assert one(spark, rec.aligned_read_length(r)) == 90 and one(spark, rec.original_length(r)) == 100
    assert one(spark, rec.runs_text(r)) == "10S80M5I3D5X" and one(spark, rec.runs_text(rec.runs(F.lit("*")))) == "*"
    assert [tuple(x) for x in one(spark, rec.merged_clips(rec.runs(F.lit("5H3S10M"))))] == [(8, "SH"), (10, "M")]
    assert tuple(one(spark, rec.read_span(rec.runs(F.lit("2H3S10M5S")), F.lit(False)))) == (5, 15)
    assert tuple(one(spark, rec.read_span(rec.runs(F.lit("2H3S10M5S")), F.lit(True)))) == (5, 15)
    assert one(spark, rec.reverse_complement(F.lit("ACGTN"))) == "NACGT"
    assert one(spark, rec.motif_counts(F.lit("AAAAAAAAATTTTTTTT")))["aaaaaaaa"] == 1
    c = one(spark, rec.consensus(F.lit("ACG"), F.lit("III"), F.lit("ACT"), F.lit("II#")))
    assert c["seq"] == "ACG" and [ord(x) - 33 for x in c["qual"]] == [73, 73, 38]


def test_checksums(spark):
    rows = spark.createDataFrame([("",), ("ACGT",), ("TTGA",), (None,)], "s string").select("s", hashing.unsigned(hashing.fnv1a64("s")).alias("h")).collect()
    assert [int(r["h"]) if r["h"] is not None else None for r in rows] == [14695981039346656037, 11137427767090403918, 11694005428531796437, None]
    df = spark.createDataFrame([("ACGT",), ("TTGA",)], "s string")
    for n in (1, 2):
        assert df.repartition(n).agg(hashing.xor_sum(hashing.fnv1a64("s")).alias("x")).first()["x"] == 4096415774608868251
    assert spark.createDataFrame([(bytearray(b"ACGT"),)], "b binary").select(hashing.adler32_hex("b").alias("x")).first()["x"] == "02b30120"


def test_summary(spark):
    df = spark.createDataFrame([("a", 1000.0), ("a", 2000.0), ("a", 4000.0), ("a", 9000.0), ("b", 5.0), ("b", float("nan"))], "k string, v double")
    r = {x["k"]: x for x in st.summary(df, ["k"], "v").collect()}
    a = r["a"]
    assert (a["count"], a["min"], a["q10"], a["q25"], a["median"], a["q75"], round(a["q90"], 9), a["max"], a["mean"], round(a["stdev"], 4), a["mad"]) == (4, 1000, 1300, 1750, 3000, 5250, 7500, 9000, 4000, 3559.0261, 1500)
    assert r["b"]["count"] == 1 and r["b"]["stdev"] == 0.0
    assert st.summary(df, [], "v").first()["count"] == 5


def test_weighted_percentiles_and_ratio(spark):
    df = spark.createDataFrame([(3.0, 1), (10.0, 4), (20.0, 3), (30.5, 2)], "q double, n int")
    r = st.weighted_percentiles(df, [], "q", "n", {"a": 0.025, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.975}).first()
    assert tuple(r) == (3.0, 10.0, 10.0, 20.0, 30.5)
    cov = spark.createDataFrame([("chr1", 100, 30.0), ("chr2", 300, 34.0), ("chrM", 50, 3300.0), ("chrX", 100, 15.0)], "c string, n int, cov double")
    m = lambda d: st.ratio_of_means(d, F.col("c") == "chrM", F.col("c").isin("chr1", "chr2"), F.col("cov"), F.col("n"), 2.0).first()["ratio"]
    assert m(cov) == 200.0 and m(cov.where("c <> 'chrM'")) is None


def test_outliers_without_spread(spark):
    df = spark.createDataFrame([("c", f"s{i}", v) for i, v in enumerate((10, 10, 10, 10, 50))], "cohort string, sample string, calls int")
    r = st.outlier_flags(df, ["cohort"], "sample", "calls").collect()
    assert [(x["sample"], x["median"], x["mad"], x["high"], x["low"], x["flag"]) for x in r] == [("s4", 10, 0, 20, 0, "HIGH")]


def test_number_text(spark):
    values = [3.0, 0.12345, None, float("inf"), 2.0, -0.5, 0.00015, 1e20]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r["t"] for r in df.select("i", number_text("v").alias("t")).orderBy("i").collect()]
    assert got == ["3", f"{0.12345:.4f}", "", "", "2", "-0.5000", f"{0.00015:.4f}", "100000000000000000000"]
