"""Alignment-record algebra: flags, run-length alignments, sequences and qualities.

A run-length alignment is an array of struct<len int, op string>; ``runs`` makes it from
text and ``runs_text`` turns it back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of the flag field.
FLAGS = {
    "paired": 0x1, "proper": 0x2, "unmapped": 0x4, "mate_unmapped": 0x8, "reverse": 0x10, "mate_reverse": 0x20, "read1": 0x40, "read2": 0x80,
    "secondary": 0x100, "qcfail": 0x200, "duplicate": 0x400, "supplementary": 0x800,
}
# Adapter motifs, scanned left to right in one alternation.
MOTIFS = ("AAAAAAAA", "CCCCCCCC", "GGGGGGGG", "TTTTTTTT", "AGATCGGAAGAG", "CTGTCTCTTATA")


def has(flag: Column, name: str) -> Column:
    """Whether a flag bit is set."""
    return flag.bitwiseAND(FLAGS[name]) != 0


def is_primary(flag: Column) -> Column:
    """Neither secondary nor supplementary."""
    return flag.bitwiseAND(FLAGS["secondary"] | FLAGS["supplementary"]) == 0


def flag_struct(flag: Column) -> Column:
    """All bits as booleans, with ``primary``."""
    return F.struct(*[has(flag, k).alias(k) for k in FLAGS], is_primary(flag).alias("primary"))


def runs(text: Column) -> Column:
    """'10S80M' as an array of runs; '*' and null have none."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(0))
    return F.transform(found, lambda x: F.struct(F.substring(x, F.lit(1), F.length(x) - 1).cast("int").alias("len"), F.right(x, F.lit(1)).alias("op")))


def runs_text(array: Column) -> Column:
    """The text of an array of runs, '*' if there is none."""
    text = F.array_join(F.transform(array, lambda r: F.concat(r["len"].cast("string"), r["op"])), "")
    return F.when(text == "", "*").otherwise(text)


def merged_clips(array: Column) -> Column:
    """Neighbouring soft and hard clips as one run of op SH."""
    is_clip = lambda r: r["op"].isin("S", "H", "SH")
    start = F.array().cast("array<struct<len:int,op:string>>")

    def step(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct((last["len"] + r["len"]).alias("len"), F.lit("SH").alias("op"))))
        return F.when(is_clip(r) & F.coalesce(is_clip(last), F.lit(False)) & (F.size(done) > 0), joined).otherwise(F.concat(done, F.array(F.struct(r["len"].alias("len"), r["op"].alias("op")))))

    return F.aggregate(array, start, step)


def run_sum(array: Column, ops: str) -> Column:
    """Total length of the runs with an op in ``ops``."""
    return F.aggregate(F.filter(array, lambda r: r["op"].isin(*ops)), F.lit(0), lambda s, r: s + r["len"])


def run_totals(array: Column) -> Column:
    """clipped, aligned (M and = only), inserted, deleted."""
    return F.struct(
        run_sum(array, "SH").alias("clipped"), run_sum(array, "M=").alias("aligned"), run_sum(array, "I").alias("inserted"), run_sum(array, "D").alias("deleted")
    )


def aligned_length(array: Column) -> Column:
    """Aligned bases: M, = and X."""
    return run_sum(array, "M=X")


def aligned_read_length(array: Column) -> Column:
    """Read bases between the clips: M, I, = and X."""
    return run_sum(array, "MI=X")


def original_length(array: Column) -> Column:
    """Bases of the read as sequenced: S, M, I, =, X and H."""
    return run_sum(array, "SMI=XH")


def reference_length(array: Column) -> Column:
    """Reference bases covered: M, D, N, = and X."""
    return run_sum(array, "MDN=X")


def read_span(array: Column, reverse: Column) -> Column:
    """struct<start,end> of the aligned part of the read, in the orientation of sequencing."""
    first, second = F.get(array, F.lit(0)), F.get(array, F.lit(1))
    clip = lambda r: r["op"].isin("S", "H")
    lead = F.when(clip(first), first["len"] + F.when(clip(second), second["len"]).otherwise(0)).otherwise(0)
    size, whole = aligned_read_length(array), original_length(array)
    start = F.when(reverse, whole - lead - size).otherwise(lead)
    return F.struct(start.alias("start"), (start + size).alias("end"))


def reverse_complement(seq: Column) -> Column:
    """(R09)"""
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def as_sequenced(seq: Column, reverse: Column) -> Column:
    """The sequence in the orientation of sequencing."""
    return F.when(reverse, reverse_complement(seq)).otherwise(seq)


def original_sequence(seq: Column, reverse: Column, tags: Column) -> Column:
    """With bases that clipping removed (tags YB before, ZB after), as sequenced."""
    return as_sequenced(F.concat(F.coalesce(tags["YB"], F.lit("")), seq, F.coalesce(tags["ZB"], F.lit(""))), reverse)


def original_quality(qual: Column, reverse: Column, tags: Column) -> Column:
    """With qualities that clipping removed (tags YQ and ZQ), as sequenced."""
    whole = F.concat(F.coalesce(tags["YQ"], F.lit("")), qual, F.coalesce(tags["ZQ"], F.lit("")))
    return F.when(reverse, F.reverse(whole)).otherwise(whole)


def mates_overlap(chrom1: Column, start1: Column, end1: Column, rev1: Column, chrom2: Column, start2: Column, end2: Column, rev2: Column) -> Column:
    """Same chromosome, opposite strands, positive overlap."""
    return (chrom1 == chrom2) & (rev1 != rev2) & (F.least(end1, end2) > F.greatest(start1, start2))


def consensus(seq1: Column, qual1: Column, seq2: Column, qual2: Column) -> Column:
    """struct<seq,qual> of two equally long overlapping reads: agreement adds the scores, conflict keeps the better base and subtracts; scores stay in 2..73."""
    score = lambda q: F.transform(F.split(q, ""), lambda c: F.ascii(c) - 33)
    left = F.arrays_zip(F.split(seq1, "").alias("b"), score(qual1).alias("q"))
    right = F.arrays_zip(F.split(seq2, "").alias("b"), score(qual2).alias("q"))

    def pick(x: Column, y: Column) -> Column:
        same = x["b"] == y["b"]
        q = F.when(same, x["q"] + y["q"]).otherwise(F.abs(x["q"] - y["q"]))
        return F.struct(F.when(same | (x["q"] >= y["q"]), x["b"]).otherwise(y["b"]).alias("b"), F.greatest(F.lit(2), F.least(F.lit(73), q)).alias("q"))

    both = F.zip_with(left, right, pick)
    return F.struct(F.array_join(F.transform(both, lambda x: x["b"]), "").alias("seq"), F.array_join(F.transform(both, lambda x: F.char(x["q"] + 33)), "").alias("qual"))


def supplementary_tag(rname: Column, pos: Column, reverse: Column, cigar: Column, mapq: Column, nm: Column) -> Column:
    """One entry of the SA tag."""
    return F.concat_ws(",", rname, pos.cast("string"), F.when(reverse, "-").otherwise("+"), cigar, mapq.cast("string"), F.coalesce(nm.cast("string"), F.lit("0"))) 


def _count(array: Column, value: str) -> Column:
    return F.size(F.filter(array, lambda x: x == F.lit(value)))


def motif_counts(seq: Column) -> Column:
    """How often each adapter motif is found by one non-overlapping scan."""
    found = F.regexp_extract_all(seq, F.lit("(" + "|".join(MOTIFS) + ")"), F.lit(0))
    return F.struct(*[_count(found, m).alias(m.lower()) for m in MOTIFS])


def clip_parts(seq: Column, array: Column) -> Column:
    """struct<before,middle,after>: the sequence cut at its soft clips."""
    first, last = F.get(array, F.lit(0)), F.try_element_at(array, F.lit(-1))
    lead = F.when(first["op"] == "S", first["len"]).otherwise(0)
    tail = F.when((last["op"] == "S") & (F.size(array) > 1), last["len"]).otherwise(0)
    return F.struct(
        F.substring(seq, F.lit(1), lead).alias("before"), F.substring(seq, lead + 1, F.length(seq) - lead - tail).alias("middle"),
        F.substring(seq, F.length(seq) - tail + 1, tail).alias("after"),
    )


def quality_shift(least: Column, most: Column) -> Column:
    """31 if the least score code is 64 or more and the largest over 74, else 0."""
    return F.when((least >= 64) & (most > 74), 31).otherwise(0)


def shift_quality(qual: Column, shift: Column) -> Column:
    """Codes lowered by ``shift``."""
    return F.when(shift == 0, qual).otherwise(F.array_join(F.transform(F.split(qual, ""), lambda c: F.char(F.ascii(c) - shift)), ""))


def plain_quality(qual: Column) -> Column:
    """'#' as '!' (R23)."""
    return F.replace(qual, F.lit("#"), F.lit("!"))


def gc_excess(kmer: Column, half: int = 16) -> Column:
    """C and G bases of a k-mer over ``half``."""
    return F.length(F.regexp_replace(kmer, "[^CG]", "")) - half


def mean_quality(qual: Column) -> Column:
    """Mean score of one quality string."""
    scores = F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33)
    return F.when(F.length(qual) > 0, F.aggregate(scores, F.lit(0), lambda s, x: s + x) / F.length(qual))


def kind_of_variant(ref: Column, alts: Column) -> Column:
    """SNP, INDEL or OTHER over all alternatives."""
    plain = lambda a: a.rlike("^[ACGTNacgtn]+$")
    snp = F.forall(alts, lambda a: plain(a) & (F.length(a) == 1)) & (F.length(ref) == 1)
    indel = F.forall(alts, lambda a: plain(a) & (F.length(a) != F.length(ref)))
    return F.when(F.size(alts) == 0, "OTHER").when(snp, "SNP").when(indel, "INDEL").otherwise("OTHER")
