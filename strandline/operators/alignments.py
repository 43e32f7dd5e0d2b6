"""Alignment tables: groups of a read, clipping, dechimering, merging with the original reads, statistics.

Columns: qname, flag, rname, pos (one-based), mapq, cigar, rnext, pnext, tlen, seq, qual,
tags (map). A read's alignments meet in one group; the number of alignments of a read is small.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import records as rec
from strandline.functions.hashing import fnv1a64

_RUN = re.compile(r"([0-9]+)([MIDNSHP=X])")
READ, REFERENCE = frozenset("MIS=X"), frozenset("MDN=X")


def read_group(df: DataFrame) -> DataFrame:
    """A row for each read and mate: primary, supplementary, secondary and supplementary-secondary records, and whether there are two primaries."""
    flag = F.col("flag")
    whole = F.struct(*df.columns)
    sup, sec = rec.has(flag, "supplementary"), rec.has(flag, "secondary")
    mate = F.when(rec.has(flag, "read1"), 1).when(rec.has(flag, "read2"), 2).otherwise(0)
    pick = lambda cond: F.collect_list(F.when(cond, whole))
    out = df.withColumn("mate", mate).groupBy("qname", "mate").agg(
        pick(~sup & ~sec).alias("primaries"), pick(sup & ~sec).alias("supplementary"), pick(sec & ~sup).alias("secondary"), pick(sup & sec).alias("supplementary_secondary")
    )
    return out.withColumn("primary", F.get("primaries", F.lit(0))).withColumn("duplicate_primary", F.size("primaries") > 1).drop("primaries")


def alignment_score(df: DataFrame) -> DataFrame:
    """Sum and maximum of the AS tag by read, and whether a decoy contig is hit."""
    score = F.col("tags")["AS"].try_cast("int")
    return df.groupBy("qname").agg(F.coalesce(F.sum(score), F.lit(0)).alias("score"), F.coalesce(F.max(score), F.lit(0)).alias("best"), F.max(F.coalesce(F.col("rname").contains("decoy"), F.lit(False))).alias("decoy"))


def badly_mapped(scores: DataFrame, most: Column) -> DataFrame:
    """Reads under 50 and under half of the possible score, or on a decoy."""
    return scores.where(((F.col("score") < 50) & (F.col("score") < 0.5 * most)) | F.col("decoy"))


def runs_of(text: str | None) -> list[tuple[int, str]]:
    return [(int(n), op) for n, op in _RUN.findall(text or "")]


def text_of(runs: list[tuple[int, str]]) -> str:
    merged: list[tuple[int, str]] = []
    for n, op in runs:
        if n and merged and merged[-1][1] == op:
            merged[-1] = (merged[-1][0] + n, op)
        elif n:
            merged.append((n, op))
    return "".join(f"{n}{op}" for n, op in merged) or "*"


def cut_start(runs: list[tuple[int, str]], bases: int) -> tuple[list[tuple[int, str]], int, int]:
    """Hard-clip ``bases`` read bases (clips that are there included) from the start: (runs, reference bases passed, sequence bases removed)."""
    left, passed, removed, out, hard = bases, 0, 0, [], 0
    items = list(runs)
    while items and (left > 0 or items[0][1] in "DN" and out == []):
        n, op = items[0]
        if op == "H":
            hard += n
            left -= n
            items.pop(0)
        elif op in "DN":
            passed += n
            items.pop(0)
        elif op == "P":
            items.pop(0)
        else:
            take = min(n, left)
            if take <= 0:
                break
            hard += take
            removed += take
            left -= take
            passed += take if op in REFERENCE else 0
            items[0] = (n - take, op)
            if not items[0][0]:
                items.pop(0)
    while items and items[0][1] in "DNI" and hard:  # an alignment starts with aligned bases
        n, op = items.pop(0)
        if op == "I":
            hard += n
            removed += n
        else:
            passed += n
    return ([(hard, "H"), *items] if hard else items), passed, removed


def clip(record: dict, start: int, end: int) -> dict:
    """A copy of a record with only read bases start..end (of the alignment's orientation) left; removed bases are kept in YB/YQ and ZB/ZQ."""
    out = dict(record, tags=dict(record["tags"] or {}))
    runs = runs_of(record["cigar"])
    whole = sum(n for n, op in runs if op in "MIS=XH")
    runs, passed, removed = cut_start(runs, start)
    seq, qual = record["seq"], record["qual"]
    if removed:
        out["tags"]["YB"], out["tags"]["YQ"] = (out["tags"].get("YB") or "") + seq[:removed], (out["tags"].get("YQ") or "") + qual[:removed]
        seq, qual = seq[removed:], qual[removed:]
    back, _, removed = cut_start(runs[::-1], whole - end)
    if removed:
        cut = len(seq) - removed
        out["tags"]["ZB"], out["tags"]["ZQ"] = seq[cut:] + (out["tags"].get("ZB") or ""), qual[cut:] + (out["tags"].get("ZQ") or "")
        seq, qual = seq[:cut], qual[:cut]
    return dict(out, cigar=text_of(back[::-1]), pos=record["pos"] + passed, seq=seq, qual=qual)


def unmap(record: dict) -> dict:
    """The record without its alignment, sequence and qualities as sequenced."""
    tags = dict(record["tags"] or {})
    seq = (tags.pop("YB", None) or "") + record["seq"] + (tags.pop("ZB", None) or "")
    qual = (tags.pop("YQ", None) or "") + record["qual"] + (tags.pop("ZQ", None) or "")
    if record["flag"] & rec.FLAGS["reverse"]:
        seq, qual = seq[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca")), qual[::-1]
    flag = record["flag"] & ~(rec.FLAGS["reverse"] | rec.FLAGS["proper"] | rec.FLAGS["supplementary"] | rec.FLAGS["secondary"]) | rec.FLAGS["unmapped"]
    return dict(record, flag=flag, rname="*", pos=0, mapq=0, cigar="*", seq=seq, qual=qual, tags=tags)


def reference_to_read(record: dict, start: int, stop: int) -> tuple[int, int]:
    """Read positions (of the alignment's orientation, zero-based, end exclusive) of reference start..stop (R11); a bound inside a deletion goes to its edge."""
    ref, read, first, last = record["pos"] - 1, 0, None, 0
    for n, op in runs_of(record["cigar"]):
        in_read, in_ref = op in READ or op == "H", op in REFERENCE
        if in_ref and in_read:
            a, b = max(start, ref), min(stop, ref + n)
            if a < b:
                first = read + a - ref if first is None else first
                last = read + b - ref
        read += n if in_read else 0
        ref += n if in_ref else 0
    return (first, last) if first is not None else (0, 0)


def _aligned(record: dict) -> tuple[int, int]:
    """Read span of the aligned part, as sequenced."""
    runs = runs_of(record["cigar"])
    whole = sum(n for n, op in runs if op in "MIS=XH")
    lead = 0
    for n, op in runs:
        if op not in "SH":
            break
        lead += n
    size = sum(n for n, op in runs if op in "MI=X")
    return (whole - lead - size, whole - lead) if record["flag"] & rec.FLAGS["reverse"] else (lead, lead + size)


def disjoint(records: list[dict], least: int = 30) -> list[dict]:
    """Split alignments of one read cut to disjoint read spans; the earlier record keeps contested bases; what keeps under ``least`` bases goes."""
    taken: list[tuple[int, int]] = []
    out = []
    for r in records:
        a, b = _aligned(r)
        for s, e in taken:
            if s <= a < e:
                a = e
            if s < b <= e:
                b = s
            if a < s and e < b:  # cut through: the longer side stays
                a, b = (a, s) if s - a >= b - e else (e, b)
        if b - a < least:
            continue
        whole = sum(n for n, op in runs_of(r["cigar"]) if op in "MIS=XH")
        lo, hi = (whole - b, whole - a) if r["flag"] & rec.FLAGS["reverse"] else (a, b)
        if (a, b) != _aligned(r):
            r = clip(r, lo, hi)
        taken.append((a, b))
        out.append(r)
    return out


def dechimer_group(records: list[dict], least: int = 30, far: int = 100_000) -> list[dict]:
    """Clean one read pair.

    Supplementary alignments are cut to disjoint spans; a primary without enough bases left
    is replaced by its best supplementary one or unmapped; a trailing clip goes for good if
    the mate is unmapped or far away; mate fields, proper flags and SA tags follow.
    """
    primaries = {}
    out: list[dict] = []
    for mate in (rec.FLAGS["read1"], rec.FLAGS["read2"], 0):
        own = [r for r in records if (r["flag"] & (rec.FLAGS["read1"] | rec.FLAGS["read2"])) == mate and not r["flag"] & rec.FLAGS["secondary"]]
        if not own:
            continue
        own.sort(key=lambda r: (bool(r["flag"] & rec.FLAGS["supplementary"]), -int((r["tags"] or {}).get("AS") or 0)))
        head = own[0]
        if head["flag"] & rec.FLAGS["unmapped"]:
            kept = [head]
        else:
            kept = disjoint(own, least)
            if not kept:
                kept = [unmap(head)]
            elif kept[0]["flag"] & rec.FLAGS["supplementary"]:  # the primary went: its best supplementary takes over
                kept[0] = dict(kept[0], flag=kept[0]["flag"] & ~rec.FLAGS["supplementary"])
        primaries[mate] = kept[0]
        out += kept
    one, two = primaries.get(rec.FLAGS["read1"]), primaries.get(rec.FLAGS["read2"])
    if one and two:
        for mine, other in ((rec.FLAGS["read1"], two), (rec.FLAGS["read2"], one)):
            for k, r in enumerate(out):
                if not r["flag"] & mine:
                    continue
                lost = bool(other["flag"] & rec.FLAGS["unmapped"])
                apart = lost or other["rname"] != r["rname"] or abs(other["pos"] - r["pos"]) > far
                flag = r["flag"] & ~(rec.FLAGS["mate_unmapped"] | rec.FLAGS["mate_reverse"])
                flag |= (rec.FLAGS["mate_unmapped"] if lost else 0) | (rec.FLAGS["mate_reverse"] if other["flag"] & rec.FLAGS["reverse"] else 0)
                if apart or r["flag"] & rec.FLAGS["unmapped"]:
                    flag &= ~rec.FLAGS["proper"]
                out[k] = dict(r, flag=flag, rnext="=" if other["rname"] == r["rname"] else other["rname"], pnext=other["pos"])
    for mate in {r["flag"] & 0xC0 for r in out}:
        mapped = [k for k, r in enumerate(out) if r["flag"] & 0xC0 == mate and not r["flag"] & rec.FLAGS["unmapped"]]
        entry = {k: ",".join([out[k]["rname"], str(out[k]["pos"]), "-" if out[k]["flag"] & rec.FLAGS["reverse"] else "+", out[k]["cigar"], str(out[k]["mapq"]), str((out[k]["tags"] or {}).get("NM") or 0)]) for k in mapped}
        for k in mapped:
            tags = dict(out[k]["tags"] or {})
            others = [entry[j] for j in mapped if j != k]
            tags.pop("SA", None)
            if others:
                tags["SA"] = ";".join(others) + ";"
            out[k] = dict(out[k], tags=tags)
    return out


def dechimer(df: DataFrame, least: int = 30, far: int = 100_000) -> DataFrame:
    """``dechimer_group`` over all reads."""
    schema = df.schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        records = [dict(r, tags=dict(r["tags"]) if r["tags"] is not None else {}) for r in pdf.to_dict("records")]
        return pd.DataFrame(dechimer_group(records, least, far), columns=schema.fieldNames())

    return df.groupBy("qname").applyInPandas(run, schema)


def base_triples(df: DataFrame) -> DataFrame:
    """(qname, mate, at, base, quality) of every aligned reference position."""
    kinds = T._parse_datatype_string("qname string, mate int, rname string, at long, base string, quality string")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for r in pdf.itertuples(index=False):
                ref, read = r.pos, 0
                for n, op in runs_of(r.cigar):
                    if op in "M=X":
                        rows += [(r.qname, r.flag & 0xC0, r.rname, ref + i, r.seq[read + i], r.qual[read + i]) for i in range(n)]
                    read += n if op in READ else 0
                    ref += n if op in REFERENCE else 0
            yield pd.DataFrame(rows, columns=kinds.fieldNames())

    return df.select("qname", "flag", "rname", "pos", "cigar", "seq", "qual").mapInPandas(run, kinds)


def invented_bases(old: DataFrame, new: DataFrame) -> DataFrame:
    """Aligned bases of ``new`` that ``old`` doesn't have; an edit that only removes mappings gives none."""
    a, b = base_triples(new).distinct(), base_triples(old).distinct()
    return a.join(b, a.columns, "left_anti")


def bad_runs(df: DataFrame) -> DataFrame:
    """Records whose run-length text breaks a rule: clips inside, sequence length, an edge that isn't aligned."""
    r = rec.runs(F.col("cigar"))
    inner = F.exists(F.slice(F.filter(r, lambda x: x["op"] != "H"), F.lit(2), F.greatest(F.size(F.filter(r, lambda x: x["op"] != "H")) - 2, F.lit(0))), lambda x: x["op"].isin("S", "H"))
    length = rec.run_sum(r, "MIS=X") != F.length("seq")
    return df.where((F.col("cigar") != "*") & (inner | (length & (F.col("seq") != "*"))))


def merge_with_reads(alignments: DataFrame, reads: DataFrame) -> DataFrame:
    """Alignments with bases that trimming removed restored from the original reads.

    ``reads``: qname, mate (1, 2), seq, qual. The aligned sequence must lie inside the
    original; what is before and after it goes to YB/YQ and ZB/ZQ (in the alignment's
    orientation). Reads without any alignment come back as unmapped, QC-failed records.
    """
    mate = F.when(rec.has(F.col("flag"), "read1"), 1).when(rec.has(F.col("flag"), "read2"), 2).otherwise(0)
    a = alignments.withColumn("__mate", mate)
    o = reads.select("qname", F.col("mate").alias("__mate"), F.col("seq").alias("__seq"), F.col("qual").alias("__qual"))
    joined = a.join(o, ["qname", "__mate"], "left")
    back = rec.has(F.col("flag"), "reverse")
    seq, qual = rec.as_sequenced(F.col("__seq"), back), F.when(back, F.reverse("__qual")).otherwise(F.col("__qual"))
    place = F.when(F.col("__seq").isNotNull(), F.position("seq", seq))
    n = F.length("seq")
    more = F.when(
        place > 0,
        F.map_concat(
            F.coalesce("tags", F.create_map().cast("map<string,string>")),
            F.when(place > 1, F.create_map(F.lit("YB"), F.substring(seq, F.lit(1), place - 1), F.lit("YQ"), F.substring(qual, F.lit(1), place - 1))).otherwise(F.create_map().cast("map<string,string>")),
            F.when(F.length(seq) > place + n - 1, F.create_map(F.lit("ZB"), F.substring(seq, place + n, F.length(seq)), F.lit("ZQ"), F.substring(qual, place + n, F.length(qual)))).otherwise(F.create_map().cast("map<string,string>")),
        ),
    ).otherwise(F.col("tags"))
    merged = joined.withColumn("tags", more).select(*alignments.columns)
    lost = o.join(a.select("qname", "__mate").distinct(), ["qname", "__mate"], "left_anti")
    both = rec.FLAGS["paired"] | rec.FLAGS["unmapped"] | rec.FLAGS["mate_unmapped"] | rec.FLAGS["qcfail"]
    flag = F.lit(both) + F.when(F.col("__mate") == 1, rec.FLAGS["read1"]).when(F.col("__mate") == 2, rec.FLAGS["read2"]).otherwise(0)
    filled = {"qname": F.col("qname"), "flag": flag.cast("int"), "rname": F.lit("*"), "pos": F.lit(0), "mapq": F.lit(0), "cigar": F.lit("*"), "rnext": F.lit("*"), "pnext": F.lit(0), "tlen": F.lit(0), "seq": F.col("__seq"), "qual": F.col("__qual"), "tags": F.create_map().cast("map<string,string>")}
    kinds = dict(alignments.dtypes)
    return merged.unionByName(lost.select(*[filled.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in alignments.columns]))


def checksums(df: DataFrame) -> DataFrame:
    """Order-free checksums of the reads as sequenced, by mate (A21). Secondary and supplementary records don't count."""
    back = rec.has(F.col("flag"), "reverse")
    seq = rec.original_sequence(F.col("seq"), back, F.col("tags"))
    qual = rec.plain_quality(rec.original_quality(F.col("qual"), back, F.col("tags")))
    mate = F.when(rec.has(F.col("flag"), "read2"), 2).otherwise(1)
    rows = df.where(rec.is_primary(F.col("flag"))).select(mate.alias("mate"), fnv1a64(seq).alias("s"), fnv1a64(qual).alias("q"), F.length(seq).alias("n"))
    return rows.groupBy("mate").agg(F.count(F.lit(1)).alias("reads"), F.sum("n").alias("bases"), F.bit_xor("s").alias("seq_xor"), F.bit_xor("q").alias("qual_xor"))


def mark_duplicates(fragments: DataFrame, key: list[str], quality: str, order: str) -> DataFrame:
    """All but the best fragment of each position and orientation."""
    w = Window.partitionBy(*key).orderBy(F.desc(quality), order)
    return fragments.withColumn("duplicate", F.row_number().over(w) > 1)


def pair_reads(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs by normalised name, reads left over)."""
    from strandline.functions.fields import read_name

    a = first.select(read_name("name").alias("qname"), F.col("seq").alias("seq1"), F.col("qual").alias("qual1"))
    b = second.select(read_name("name").alias("qname"), F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    both = a.join(b, "qname")
    alone = a.join(b, "qname", "left_anti").select("qname", F.lit(1).alias("mate")).unionByName(b.join(a, "qname", "left_anti").select("qname", F.lit(2).alias("mate")))
    return both, alone


def compare_tables(tables: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Reads whose records differ between tables, order inside a read ignored."""
    out = None
    for name, t in tables.items():
        own = t.groupBy("qname").agg(F.sort_array(F.collect_list(F.to_json(F.struct(*columns)))).alias(name))
        out = own if out is None else out.join(own, "qname", "full_outer")
    first, *rest = tables
    same = F.lit(True)
    for name in rest:
        same = same & F.col(first).eqNullSafe(F.col(name))
    return out.where(~same)


def sample_statistics(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and ratios of a sample's records in one pass (A01, A32). Motifs are counted on mapped reads and divided by all reads."""
    flag, r = F.col("flag"), rec.runs(F.col("cigar"))
    main, mapped = rec.is_primary(flag), ~rec.has(flag, "unmapped")
    n = lambda cond: F.count(F.when(cond, 1))
    total = lambda c, cond: F.coalesce(F.sum(F.when(cond, c)), F.lit(0))
    base = df.select(*keys, "flag", "mapq", F.length("seq").alias("n"), rec.run_totals(r).alias("t"), rec.motif_counts(F.col("seq")).alias("m"))
    motifs = sum((F.col(f"m.{m.lower()}") for m in rec.MOTIFS), F.lit(0))
    out = base.groupBy(*keys).agg(
        n(main).alias("reads"), n(main & mapped).alias("mapped"), n(main & rec.has(flag, "proper")).alias("proper"), n(main & rec.has(flag, "duplicate")).alias("duplicates"),
        n(rec.has(flag, "supplementary")).alias("supplementary"), total(F.col("n"), main).alias("bases"), total(F.col("t.clipped"), main & mapped).alias("clipped"),
        total(F.col("t.aligned"), main & mapped).alias("aligned"), total(F.col("t.inserted"), main & mapped).alias("inserted"), total(F.col("t.deleted"), main & mapped).alias("deleted"),
        total(motifs, main & mapped).alias("motifs"), F.avg(F.when(main & mapped, F.col("mapq"))).alias("mean_mapq"),
    )
    share = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return out.withColumns({
        "mapped_ratio": share("mapped", "reads"), "proper_ratio": share("proper", "reads"), "duplicate_ratio": share("duplicates", "reads"), "motif_ratio": share("motifs", "reads"),
        "supplementary_ratio": F.col("supplementary") / F.greatest("mapped", F.lit(1)), "clip_ratio": share("clipped", "bases"), "aligned_ratio": share("aligned", "bases"),
        "insert_ratio": share("inserted", "aligned"), "delete_ratio": share("deleted", "aligned"),
    })


def quality_by_cycle(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean quality at each cycle (R17): scores are added up per position before they are shuffled."""
    at = df.select(*keys, F.posexplode(F.split("qual", "")).alias("cycle", "c"))
    return at.groupBy(*keys, "cycle").agg(F.avg(F.ascii("c") - 33).alias("quality"), F.count(F.lit(1)).alias("reads"))


def length_histogram(df: DataFrame, keys: list[str], column: str = "seq") -> DataFrame:
    """Reads by length."""
    return df.groupBy(*keys, F.length(column).alias("length")).agg(F.count(F.lit(1)).alias("n"))


def long_clips(df: DataFrame, least: int) -> DataFrame:
    """Clipped records that are not duplicates with at least ``least`` clipped bases, with their clipped parts."""
    r = rec.runs(F.col("cigar"))
    rows = df.where(~rec.has(F.col("flag"), "duplicate")).withColumn("clipped", rec.run_sum(r, "SH")).where(F.col("clipped") >= least)
    return rows.withColumn("parts", rec.clip_parts(F.col("seq"), r))


def region_statistics(df: DataFrame, sample: str, regions: DataFrame, without: int, width: int = 10_000, share: float = 1.0) -> DataFrame:
    """Read metrics of a region set as long rows (S38, F09): flag mask, overlap filter, sampling by name so that mates stay together."""
    r = rec.runs(F.col("cigar"))
    rows = df.where(F.col("flag").bitwiseAND(without) == 0).withColumn("start", (F.col("pos") - 1).cast("bigint")).withColumn("end", F.col("start") + rec.reference_length(r)).withColumn("chrom", F.col("rname"))
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("qname"), F.lit(1_000_000)) < share * 1_000_000)
    from strandline.operators.intervals import overlap_join

    kept = overlap_join(rows.withColumn("__id", F.xxhash64("qname", "flag", "pos", "cigar")).select(sample, "__id", "flag", "chrom", "start", "end", F.length("seq").alias("n")), regions, ["chrom"], width, "semi")
    flag = F.col("flag")
    out = kept.groupBy(sample).agg(F.count(F.lit(1)).cast("double").alias("reads"), F.sum("n").cast("double").alias("bases"), F.count(F.when(rec.has(flag, "duplicate"), 1)).cast("double").alias("duplicates"), F.count(F.when(rec.has(flag, "proper"), 1)).cast("double").alias("proper"))
    return out.unpivot([sample], ["reads", "bases", "duplicates", "proper"], "metric", "value")
