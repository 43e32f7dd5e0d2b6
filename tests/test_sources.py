"""File formats on small files."""

import gzip

from pyspark.sql import functions as F

from strandline.operators import qc
from strandline.sources import genomics, reports, sheets, sinks
from strandline.sources.lines import lines


def put(path, text):
    path.write_text(text)
    return str(path)


def test_sam_round_trip(spark, tmp_path):
    text = "@HD\tVN:1.6\n@RG\tID:a\tPU:x:1\tSM:s\nq\t99\tchr1\t5\t60\t4M\t=\t9\t8\tACGT\tIIII\tNM:i:0\tRG:Z:a:b\n"
    path = put(tmp_path / "a.sam", text)
    r = genomics.read_sam(spark, path).first()
    assert (r["flag"], r["pos"], r["tags"]) == (99, 5, {"NM": "0", "RG": "a:b"})
    assert genomics.sam_text(genomics.read_sam(spark, path)).first()["value"] == text.splitlines()[-1]
    assert genomics.read_groups(spark, path).first()["info"] == {"ID": "a", "PU": "x:1", "SM": "s"}


def test_fastq(spark, tmp_path):
    path = put(tmp_path / "a.fq", "@M1:2:FC:3:4:5:6 1:N:0:ACGT\nACGT\n+\nIIII\n@r#IDX/3\nAC\n+\nhh\n@cut\nA\n")
    rows = genomics.read_fastq(spark, path).orderBy("record").collect()
    assert [(r["seq"], r["qual"]) for r in rows] == [("ACGT", "IIII"), ("AC", "hh"), (None, None)]
    h = genomics.read_fastq(spark, path).orderBy("record").select(genomics.header_fields(F.col("name")).alias("h")).collect()
    assert tuple(h[0]["h"]) == ("M1", "2", "FC", "3", "ACGT", "1") and (h[1]["h"]["index"], h[1]["h"]["pair"]) == ("IDX", "2")
    assert genomics.fastq_layout(spark, put(tmp_path / "b.fq", "@a\nAC\n+\nhh\n")).first()["base"] == 64


def test_vcf_segments(spark, tmp_path):
    p = tmp_path / "COHORT_c1_SAMPLE_s_1_0.vcf.gz"
    body = "##contig=<ID=chr1,length=1000>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts_1\nchr1\t11\t.\tN\t<DEL>\t.\tPASS\tEND=20;AF_Orig=0.5\tGT:CN:NP:QS\t1:1:3:77\n"
    p.write_bytes(gzip.compress(body.encode()))
    r = genomics.segment_calls(spark, str(p)).first()
    assert (r["cohort"], r["sample"], r["start"], r["end"], r["copies"], r["np"], r["qs"], r["svtype"], r["af"]) == ("c1", "s_1", 10, 20, "1", 3, 77, "DEL", "0.5")
    assert genomics.vcf_samples(spark, str(p)).first()["samples"] == ["s_1"]
    assert tuple(genomics.contig_lengths(spark, str(p)).first()) == ("chr1", 1000)


def test_bed_and_reports(spark, tmp_path):
    bed = put(tmp_path / "a.bed", "#c\nchr1\t5\t9\tx\nchr1\t9\t5\tbad\nchr1\tq\t5\nchr2\t0\t3\n")
    assert [r["name"] for r in genomics.read_bed(spark, bed).orderBy("line").collect()] == ["x", "chr2:0-3"]
    stats = put(tmp_path / "v.txt", "SN\t0\tnumber of records:\t5\nQUAL\t0\t30.5\t2\t1\t1\t0\nSiS\t0\t1\t2\t1\t1\t0\n")
    s = reports.read_sections(spark, "variants", stats)
    assert s["QUAL"].first()["quality"] == 30.5 and s["SN"].first()["value"] == 5 and s["SIS"].first()["snps"] == 2
    bam = put(tmp_path / "b.txt", "SN\treads mapped:\t10\t# c\nFFQ\t1\t0\t0\t4\nLFQ\t1\t0\t2\t0\nGCF\t50\t3\nGCL\t40\t1\nID\t2\t3\t1\nCOV\t[1-1]\t10\t7\nCOV\t[0-0]\t1\t3\n")
    m = reports.alignment_metrics(spark, bam).first()
    assert (m["reads_mapped"], m["quality_first"], m["quality_last"], m["gc_first"], m["mean_insertion"], m["covered_10"]) == (10, 2, 1, 50, 2, 0.7)


def test_small_reports(spark, tmp_path):
    c = put(tmp_path / "c.selfSM", "#a\tb\tc\td\te\tf\tFREEMIX\ns\t0\t0\t0\t0\t0\t0.004\n")
    assert (lambda r: (r["contamination"], r["used"]))(reports.contamination(spark, c).first()) == (0.004, 0.0)
    k = put(tmp_path / "k.txt", " 50.00\t5\t5\tU\t0\tunclassified\n 40.00\t4\t0\tS\t9606\t    Homo sapiens\n")
    rows = reports.taxonomy(spark, k).orderBy("line").collect()
    assert (rows[1]["depth"], rows[1]["name"], rows[1]["taxid"]) == (2, "Homo sapiens", 9606)
    m = put(tmp_path / "m.txt", "fragments\t10\nadapters\t5\n\n36\t1\n")
    r = reports.count_stats(spark, m, ["fragments", "adapters", "none"], {"share": ("adapters", "fragments"), "zero": ("adapters", "none")}).first()
    assert (r["share"], r["zero"]) == (0.5, 0.0)
    d = put(tmp_path / "d.log", "MAPPING/ALIGNING PER RG,rg1,Reads mapped R1,10,50.0\nMAPPING/ALIGNING PER RG,rg1,Reads mapped R2,8,40.0\nother,x\n")
    r = reports.mapper_log(spark, d, ["reads_mapped_r1", "reads_mapped_r2"]).first()
    assert (r["reads_mapped_mean"], r["reads_mapped_difference"], r["reads_mapped_r1_ratio"]) == (9, 2, 50)
    w = put(tmp_path / "w.txt", "---- Chromosome chr1 ----\nVariants in VCF: 12\nBlock sizes\nMedian: 3\n---- Chromosome chr2 ----\nVariants in VCF: 2\n")
    got = {(r["chrom"], r["metric"]): r["value"] for r in reports.phasing_report(spark, w).collect()}
    assert got[("chr1", "variants_in_vcf")] == 12 and got[("chr1", "median")] == 3 and got[("chr2", "variants_in_vcf")] == 2


def test_sheets(spark, tmp_path):
    p = put(tmp_path / "a.tsv", "st\ts1\tfastq_paired\tillumina_exome\tkit\tF\ta_1.fq,b_1.fq\ta_2.fq,b_2.fq\tbatch=3\nst\ts2\tcram\tillumina_wgs\tkit\tM\tx.cram\nst\ts3\tzip\tillumina_wgs\tkit\tM\tx\nst\ts4\tfastq_paired\tillumina_wgs\tk\tM\ta\tb,c\n")
    good, bad = sheets.read_sheets(spark, p, "/data")
    rows = {r["sample"]: r for r in good.collect()}
    assert rows["s1"]["files2"] == ["/data/a_2.fq", "/data/b_2.fq"] and rows["s1"]["options"] == {"batch": "3"} and rows["s1"]["filesize"] == 8.0 and rows["s2"]["filesize"] == 37.5
    assert {(r["sample"], r["issue"]) for r in bad.collect()} == {("s3", "file_type"), ("s4", "pairs")}
    assert sheets.find_sheets(spark, str(tmp_path)).count() == 1
    e = put(tmp_path / "a.exclude", "# no\ns1\tbad\ns2\n")
    assert [tuple(r) for r in sheets.side_file(spark, e).collect()] == [("s1", "bad"), ("s2", "")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.125, [1, 2])], "k string, v double, xs array<int>")
    sinks.write_tsv(df, str(tmp_path / "o"), single=True, formatted=True)
    assert [r["text"] for r in lines(spark, str(tmp_path / "o")).orderBy("line").collect()] == ["k\tv\txs", "a\t0.1250\t1;2"]
    long = spark.createDataFrame([("s", "a", 1.0), ("s", "b_old", 2.0)], "s string, metric string, value double")
    wide = qc.pivot_metrics(qc.with_aliases(long, {"b_old": "b"}, ["s"]), ["s"], ["a", "b"]).first()
    assert (wide["a"], wide["b"]) == (1.0, 2.0)
