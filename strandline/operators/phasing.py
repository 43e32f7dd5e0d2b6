"""Phase merging: position joins, signed union-find of phase blocks, transfer onto joint calls."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest distance between neighbours of one phase block.
JUMP = 150_000


def align_alleles(ref: Column, alts: Column, longer: Column) -> Column:
    """Alternatives rewritten for a longer reference of the same position."""
    rest = F.substring(longer, F.length(ref) + 1, F.length(longer))
    return F.when(longer.startswith(ref), F.transform(alts, lambda a: F.when(a.rlike("^[ACGTN]+$"), F.concat(a, rest)).otherwise(a)))


def position_join(calls: DataFrame, phased: DataFrame, keys: tuple[str, ...] = ("sample", "chrom", "pos")) -> DataFrame:
    """Calls with the phased record of their position if its alternatives fit after reference alignment, else nulls.

    Both sides: keys, ref, alts; the phased side's other columns get the prefix ``p_``.
    """
    p = phased.select(*keys, *[F.col(c).alias(f"p_{c}") for c in phased.columns if c not in keys])
    joined = calls.join(p, list(keys), "left")
    longer = F.when(F.length("ref") >= F.length("p_ref"), F.col("ref")).otherwise(F.col("p_ref"))
    mine, theirs = align_alleles(F.col("ref"), F.col("alts"), longer), align_alleles(F.col("p_ref"), F.col("p_alts"), longer)
    fits = F.coalesce(F.size(F.array_except(theirs, mine)) == 0, F.lit(False))
    cleared = [F.when(F.col("__fits"), F.col(c)).alias(c) if c.startswith("p_") else F.col(c) for c in joined.columns]
    out = joined.withColumn("__fits", fits).select(*cleared, "__fits")
    # several phased records may share a position: the one that fits stays, or one row without
    w = Window.partitionBy(*keys, "ref", F.to_json(F.struct("alts"))).orderBy(F.desc("__fits"))
    return out.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__fits")


class SignedForest:
    """Trees of blocks with a relative orientation; a contradicting edge cuts off the later of its blocks and marks only that one invalid."""

    def __init__(self, numeric: bool = True):
        self.parent: dict[str, tuple[str, bool]] = {}
        self.invalid: set[str] = set()
        self.numeric = numeric

    def _key(self, block: str):
        head, _, tail = block.rpartition(":")
        return (head, int(tail)) if self.numeric and tail.isdigit() else (block, 0)

    def find(self, block: str) -> tuple[str, bool]:
        """(root, whether the orientation flips on the way). Paths stay as they are, so that a block can be cut off with what hangs below it."""
        flip = False
        while block in self.parent:
            block, turned = self.parent[block]
            flip ^= turned
        return block, flip

    def link(self, a: str, b: str, flipped: bool) -> None:
        if a in self.invalid or b in self.invalid:
            return
        (ra, fa), (rb, fb) = self.find(a), self.find(b)
        if ra == rb:
            if fa ^ fb != flipped:  # the later block leaves its parent and takes no further part
                late = max(a, b, key=self._key)
                self.parent.pop(late, None)
                self.invalid.add(late)
            return
        if self._key(rb) < self._key(ra):
            (ra, fa), (rb, fb) = (rb, fb), (ra, fa)
        self.parent[rb] = (ra, fa ^ fb ^ flipped)


def merge_blocks(edges: DataFrame, keys: list[str], numeric: bool = True) -> DataFrame:
    """Blocks joined by shared variants: keys, block, root, flipped, valid.

    ``edges``: keys, a, b, flipped, ord; edges are taken in order. The smaller id is the root:
    by number, or as texts if not ``numeric`` (Q12). One group a sample and chromosome.
    """
    kinds = ", ".join(f"`{k}` {edges.schema[k].dataType.simpleString()}" for k in keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        forest, seen = SignedForest(numeric), {}
        for r in pdf.sort_values("ord").itertuples(index=False):
            seen[r.a] = seen[r.b] = True
            if r.a != r.b:
                forest.link(r.a, r.b, bool(r.flipped))
        rows = [(b, *forest.find(b)) for b in seen]
        out = pd.DataFrame(rows, columns=["block", "root", "flipped"])
        out["valid"] = ~out["block"].isin(forest.invalid)
        for i, k in enumerate(keys):
            out.insert(i, k, pdf[k].iloc[0])
        return out

    return edges.groupBy(*keys).applyInPandas(run, f"{kinds}, block string, root string, flipped boolean, valid boolean")


def accept_variants(variants: DataFrame, keys: list[str], jump: int = JUMP) -> DataFrame:
    """Adds ``accepted``: a variant too far from the last accepted one of its block is rejected and changes nothing."""
    order = F.array_sort(F.collect_list(F.struct("pos", "id")))
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast("array<struct<id:bigint,ok:boolean>>").alias("out"))

    def step(s: Column, v: Column) -> Column:
        ok = s["last"].isNull() | (v["pos"] - s["last"] <= jump)
        return F.struct(F.when(ok, v["pos"]).otherwise(s["last"]).cast("bigint").alias("last"), F.concat(s["out"], F.array(F.struct(v["id"].cast("bigint").alias("id"), ok.alias("ok")))).alias("out"))

    folded = variants.groupBy(*keys).agg(order.alias("v")).select(*keys, F.explode(F.aggregate("v", start, step, lambda s: s["out"])).alias("x"))
    return folded.select(*keys, F.col("x.id").alias("id"), F.col("x.ok").alias("accepted"))


def block_statistics(variants: DataFrame, keys: list[str], block: str = "block") -> DataFrame:
    """Number, mean, median and longest length of blocks and variants in a block."""
    one = variants.groupBy(*keys, block).agg((F.max("pos") - F.min("pos") + 1).alias("length"), F.count(F.lit(1)).alias("n"))
    return one.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("blocks"), F.avg("length").alias("mean_length"), F.percentile("length", F.lit(0.5)).alias("median_length"), F.max("length").alias("longest"),
        F.avg("n").alias("mean_variants"), F.max("n").alias("most_variants"),
    )


def transfer(ref: Column, alleles: Column, gt: Column, packed: Column) -> Column:
    """How a packed phased genotype maps onto a joint call: struct<reason,phase>.

    ``alleles``: reference first; ``gt``: two indexes; ``packed``: from ``functions.fields.phase_code``.
    Reasons: exact, swapped, suffix (the joint call has further common bases), deletion (an
    allele is '*'), missing.
    """
    a, b = F.get(alleles, gt[0]), F.get(alleles, gt[1])
    left, right = packed["left"], packed["right"]
    extra = F.substring(ref, packed["ref_len"] + 1, F.length(ref))
    long = lambda x: F.concat(x, extra)
    gone = (left == "*") | (right == "*") | (a == "*") | (b == "*")
    same = lambda x, y: (x == "*") | (y == "*") | (x == y) | (long(x) == y)
    reason = (
        F.when(packed.isNull(), "missing").when((left == a) & (right == b), "exact").when((left == b) & (right == a), "swapped")
        .when((long(left) == a) & (long(right) == b), "suffix").when((long(left) == b) & (long(right) == a), "suffix_swapped")
        .when(gone & same(left, a) & same(right, b), "deletion").when(gone & same(left, b) & same(right, a), "deletion_swapped").otherwise("mismatch")
    )
    phase = F.when(reason.isin("exact", "suffix", "deletion"), F.array(gt[0], gt[1])).when(reason.endswith("swapped"), F.array(gt[1], gt[0]))
    return F.struct(reason.alias("reason"), phase.alias("phase"))
