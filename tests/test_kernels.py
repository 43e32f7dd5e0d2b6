"""EM, phasing, cohorts, batches and alignments against plain models."""

import random
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions.fields import phase_code
from strandline.operators import alignments as al
from strandline.operators import calls, cohort, genotypes, phasing, qc, samples


def test_em_fixture():
    pl = [[0, 30, 60], [30, 0, 30], [0, 3, 30]]
    freq, post = genotypes.allele_frequencies(genotypes.likelihoods_of(pl, 3), 2)
    assert np.allclose(freq, [0.800181, 0.199819], atol=2e-6)
    assert np.allclose(post, [[0.9995, 0.0005, 0], [0.0020, 0.9979, 0.0001], [0.7998, 0.2002, 0]], atol=1e-4)
    assert np.allclose(genotypes.leave_one_out(genotypes.likelihoods_of(pl, 3), 2).sum(1), 1)
    haploid, _ = genotypes.allele_frequencies(np.array([[1, 0], [1, 0], [0, 1.0]]), 2, ploidy=1)
    assert np.allclose(haploid, [2 / 3, 1 / 3])


def test_recall_marks_missing(spark):
    df = spark.createDataFrame([(1, 2, [[0, 30, 60], [-2147483648, 0, 0], None])], "site int, n_alleles int, pl array<array<int>>")
    r = genotypes.recall(df).first()
    assert r["gt"][0] == 0 and len(r["gp"]) == 3 and max(r["gq"]) <= 99


def test_multiallelic_and_split(spark):
    df = spark.createDataFrame([(["A", "C"], [30, 50], 100, [0, 1, 2, 3, 4, 5]), (["A"], [3], 100, [0, 1, 2]), (["A", "C"], [0, 0], 0, [0] * 6)], "alts array<string>, ac array<int>, an int, pl array<int>")
    r = genotypes.multiallelic(df).collect()
    assert [(x["nma_alt"], round(x["ma_ref_af"], 9), x["ma_reflow_count"]) for x in r] == [(2, 0.2, 2)]
    rows = genotypes.split_alleles(df.limit(1), per_alt=("ac",), per_genotype=("pl",)).orderBy("alt").collect()
    assert [(x["alt"], x["ac"], x["pl"]) for x in rows] == [("A", 30, [0, 1, 2]), ("C", 50, [0, 3, 5])]


def test_union_find_marks_conflicts(spark):
    rows = [("s", "c:900", "c:1000", False, 1), ("s", "c:1000", "c:20", True, 2), ("s", "c:900", "c:20", True, 3), ("s", "d:1", "d:2", False, 4), ("s", "d:1", "d:2", True, 5)]
    df = spark.createDataFrame(rows, "sample string, a string, b string, flipped boolean, ord int")
    got = {r["block"]: (r["root"], r["flipped"], r["valid"]) for r in phasing.merge_blocks(df, ["sample"]).collect()}
    assert got["c:900"] == ("c:20", True, True) and got["c:1000"] == ("c:20", True, True) and got["d:1"] == ("d:1", False, True) and got["d:2"] == ("d:2", False, False)
    # what hangs below a block that is cut off stays with it; an invalid block takes no further part
    rows = [("s", "c:5", "c:9", False, 1), ("s", "c:1", "c:5", True, 2), ("s", "c:1", "c:5", False, 3), ("s", "c:5", "c:7", False, 4)]
    got = {r["block"]: (r["root"], r["flipped"], r["valid"]) for r in phasing.merge_blocks(spark.createDataFrame(rows, df.schema), ["sample"]).collect()}
    assert got == {"c:1": ("c:1", False, True), "c:5": ("c:5", False, False), "c:9": ("c:5", False, True), "c:7": ("c:7", False, True)}
    assert phasing.SignedForest(numeric=False)._key("c:900") > phasing.SignedForest(numeric=False)._key("c:1000")


def test_rejected_variant_changes_nothing(spark):
    df = spark.createDataFrame([("b", 100, 1), ("b", 900, 2), ("b", 105, 3), ("b", 109, 4)], "block string, pos long, id long")
    got = {r["id"]: r["accepted"] for r in phasing.accept_variants(df, ["block"], 6).collect()}
    assert got == {1: True, 3: True, 4: True, 2: False}


def test_position_join_and_transfer(spark):
    c = spark.createDataFrame([("s", "1", 5, "AT", ["GT"]), ("s", "1", 9, "A", ["C"])], "sample string, chrom string, pos int, ref string, alts array<string>")
    p = spark.createDataFrame([("s", "1", 5, "A", ["G"], "0|1"), ("s", "1", 9, "A", ["T"], "1|0")], "sample string, chrom string, pos int, ref string, alts array<string>, gt string")
    got = {r["pos"]: r["p_gt"] for r in phasing.position_join(c, p).collect()}
    assert got == {5: "0|1", 9: None}
    df = spark.createDataFrame([("A", ["A", "G"], [0, 1], "005G|A"), ("AT", ["AT", "GT"], [0, 1], "005A|G"), ("A", ["A", "G"], [0, 1], "005C|G"), ("A", ["A", "*"], [0, 1], "005A|*")], "ref string, alleles array<string>, gt array<int>, code string")
    out = df.select(phasing.transfer(F.col("ref"), F.col("alleles"), F.col("gt"), phase_code("code")).alias("t")).collect()
    assert [(r["t"]["reason"], r["t"]["phase"]) for r in out] == [("swapped", [1, 0]), ("suffix", [0, 1]), ("mismatch", None), ("exact", [0, 1])]


def test_batches_fixture(spark):
    df = spark.createDataFrame([("k", i, float(s)) for i, s in enumerate((1000, 1000, 100, 2000))], "k string, ord int, size double")
    assert [r["batch"] for r in samples.batches(df, ["k"], "ord", "size", 2048).orderBy("ord").collect()] == [1, 1, 2, 3]
    big = spark.createDataFrame([("k", 0, 9000.0), ("k", 1, 1.0)], "k string, ord int, size double")
    assert [r["batch"] for r in samples.batches(big, ["k"], "ord", "size", 2048).orderBy("ord").collect()] == [1, 2]


def test_exclusions_fixture(spark):
    s = spark.createDataFrame([("a",), ("b",), ("c",)], "sample string")
    kept, out, lost = samples.apply_exclusions(s, spark.createDataFrame([("b", "bad"), ("z", "")], "sample string, reason string"))
    assert {r[0] for r in kept.collect()} == {"a", "c"} and out.first()["reason"] == "bad" and lost.first()["sample"] == "z"
    with pytest.raises(ValueError):
        samples.concatenate([s, s.withColumnRenamed("sample", "x")])


def test_components_and_clusters(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(6, 40)) + np.repeat([[0], [4]], 3, axis=0) * rng.normal(size=(1, 40))
    df = spark.createDataFrame([(f"s{i}", j, float(x[i, j])) for i in range(6) for j in range(40)], "sample string, region_id int, cov double")
    got = np.array([[r["pc1"], r["pc2"]] for r in cohort.principal_components(df, 2).orderBy("sample").collect()])
    c = x - x.mean(0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(u[:, :2] * s[:2]))
    pts = [(i, float(v), float(w)) for i, (v, w) in enumerate(np.concatenate([rng.normal(0, 0.1, (12, 2)), rng.normal(5, 0.1, (12, 2))]))]
    labels = [r["cluster"] for r in cohort.best_clusters(spark.createDataFrame(pts, "id int, x double, y double"), "id", ["x", "y"], eps=(0.2, 0.5), least=(3,)).orderBy("id").collect()]
    assert len(set(labels[:12])) == len(set(labels[12:])) == 1 and labels[0] != labels[12]


def test_taxon_tie_takes_the_earlier_line(spark):
    rows = [("s", 1, 10, "S", 7, "one"), ("s", 2, 10, "S", 8, "two"), ("s", 0, 100, "R", 1, "root"), ("s", 3, 5, "D", 2, "Bacteria")]
    r = qc.taxon_summary(spark.createDataFrame(rows, "sample string, line int, clade long, rank string, taxid int, name string")).first()
    assert (r["top_species"], r["bacteria"], r["reads"]) == ("one", 5, 100)


def test_artifact_triples(spark):
    df = spark.createDataFrame([(990, 10, 995, 5), (995, 5, 990, 10)], "pro_ref int, pro_alt int, con_ref int, con_alt int")
    got = [tuple(round(r[c], 3) for c in ("first", "second", "excess")) for r in qc.artifact_triples(df).orderBy("pro_ref").collect()]
    assert got == [(20.0, 23.01, 23.01), (23.01, 20.0, 100.0)]


def record(**k):
    base = dict(qname="q", flag=67, rname="c", pos=101, mapq=60, cigar="10M", rnext="=", pnext=0, tlen=0, seq="ACGTACGTAC", qual="IIIIIIIIII", tags={})
    return base | k


def test_clip_keeps_the_original_sequence():
    r = record(cigar="2S6M1D2M", seq="ACGTACGTAC", qual="ABCDEFGHIJ")
    c = al.clip(r, 4, 9)
    assert c["cigar"] == "4H4M1D1M1H" and c["pos"] == 103 and c["seq"] == "ACGTA"
    u = al.unmap(c)
    assert (u["seq"], u["qual"], u["cigar"]) == (r["seq"], r["qual"], "*")
    assert al.reference_to_read(record(cigar="2S4M2D4M"), 102, 108) == (4, 8)


def test_dechimer_only_removes_mappings(spark):
    schema = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags map<string,string>"
    seq = "ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGT"
    rows = [
        record(flag=65, cigar="25M15S", seq=seq, qual="I" * 40, tags={"AS": "25"}), record(flag=65 | 2048, rname="d", pos=500, cigar="20S20M", seq=seq, qual="I" * 40, tags={"AS": "20"}),
        record(flag=129, pos=300, cigar="40M", seq=seq, qual="I" * 40),
    ]
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    out = al.dechimer(df, least=10)
    got = {(r["flag"] & 0xFC0, r["rname"]): r["cigar"] for r in out.collect()}
    assert got[(64, "c")].startswith("25M") and got[(64 | 2048, "d")] == "25H15M"
    assert al.invented_bases(df, out).count() == 0 and al.bad_runs(out).count() == 0
    a, b = al.checksums(df).orderBy("mate").collect(), al.checksums(out).orderBy("mate").collect()
    assert a == b


def test_merge_restores_trimmed_bases(spark):
    schema = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags map<string,string>"
    r = record(flag=65, cigar="4M", seq="GTAC", qual="IIII")
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", "))], schema)
    reads = spark.createDataFrame([("q", 1, "ACGTACGG", "ABIIIICD"), ("lost", 2, "TT", "II")], "qname string, mate int, seq string, qual string")
    got = {x["qname"]: x for x in al.merge_with_reads(df, reads).collect()}
    assert got["q"]["tags"] == {"YB": "AC", "YQ": "AB", "ZB": "GG", "ZQ": "CD"} and got["lost"]["flag"] & 0x204 == 0x204


def test_sample_comparison_status(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "s string, n int")
    b = spark.createDataFrame([("y", 5), ("z", 3)], "s string, n int")
    got = {r["s"]: (r["status"], r["delta_n"]) for r in calls.compare_samples(a, b, "s", ["n"]).collect()}
    assert got == {"x": ("left_only", None), "y": ("both", 3), "z": ("right_only", None)}


@pytest.mark.parametrize("change,want", [({}, True), ({"qs": 49}, False), ({"np": 1}, False), ({"end": 999}, False), ({"contig": "chrX"}, False), ({"filter": "LowQ"}, False), ({"qs": None}, False), ({"copies": "2"}, False)])
def test_high_confidence_fixture(spark, change, want):
    row = {"contig": "chr2", "start": 0, "end": 1000, "copies": "1", "alt": ".", "filter": "PASS", "qs": 50, "np": 2} | change
    schema = "contig string, start long, end long, copies string, alt string, filter string, qs int, np int"
    df = spark.createDataFrame([tuple(row.values())], schema)
    assert df.select(calls.high_confidence(F.struct(*row)).alias("x")).first()["x"] is want


def test_kmers_match_plain_counts(spark, monkeypatch):
    from strandline.operators import kmers

    monkeypatch.setattr(kmers, "POSITIONS", 37)
    monkeypatch.setattr(kmers, "ROWS", 7)
    rng = random.Random(1)
    rows = [(rng.choice(["x", None, "y"]), "".join(rng.choices("ACGT😀é", k=rng.randint(0, 30)))) for _ in range(60)] + [("x", None)]
    df = spark.createDataFrame(rows, "g string, seq string")
    for k in (1, 3, 5, 8):
        want: dict = {}
        for g, s in rows:
            for i in range(len(s or "") - k + 1):
                want[g, s[i : i + k]] = want.get((g, s[i : i + k]), 0) + 1
        got = {(r["g"], r["kmer"]): r["n"] for r in kmers.count_kmers(df, "seq", k, ["g"], canonical=False, least=1, cap=None).collect()}
        assert got == want


def test_sites_are_solved_alike_one_by_one_and_together():
    rng = np.random.default_rng(0)
    x = rng.random((30, 7, 6))
    x[3] = 0
    freq, post = genotypes.frequencies_of_sites(x, 3)
    for i in range(30):
        f, p = genotypes.allele_frequencies(x[i], 3)
        assert np.allclose(f, freq[i], atol=1e-12) and np.allclose(p, post[i], atol=1e-12)
