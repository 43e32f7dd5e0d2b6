"""Text quality: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, order ``ORDER``, context reset at word boundaries, case
and punctuation kept, digits folded to 0. Counts come from all trusted documents (label
``quality`` = 1); lower orders are continuation counts; every order has three
discounts from its counts of counts.

Counts stay in tables sharded by n-gram. Each span of input rows lists its different n-grams
(distinct words are expanded once), the distinct ones of all spans get their
probabilities by shuffle joins with the count shards, order by order, and go back to the
spans that asked as one side file each, which a scoring task loads. So a worker's
memory is bounded by its own span and texts are never shuffled. The set of trusted
ids reaches the spans in the same way.

A document is kept if its perplexity is at most ``MARGIN`` times the ``QUANTILE``
quantile of the trusted documents of its language (of all trusted documents where a
language has none). Both sides use the perplexity smoothed by ``PRIOR`` symbols at the
language's mean, as that of a few words says little.

Edge cases. Null, empty and white-space texts have no perplexity and are not kept.
Without any trusted document nothing has a threshold and every document with a
perplexity is kept. A null language is a language of its own. Repeated rows are
scored alike; repeated labels count once. Null ``doc_id`` rows are never trusted.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.shared import by_split, forget, materialize, read_side, with_rows, write_side

ORDER = 5
QUANTILE, MARGIN, PRIOR = 0.99, 1.1, 60.0
#: Symbols assumed for the uniform distribution below the first order.
ALPHABET = 1000
WORDS_KEPT = 400_000
#: Rows that ask for their n-grams together.
SPAN = 8192
_PAD, _END = "\x02" * (ORDER - 1), "\x03"
_DIGIT = re.compile(r"\d")


def grams(word: str) -> list[str]:
    """The n-grams of the highest order of one word, its end included."""
    s = _PAD + _DIGIT.sub("0", word) + _END
    return [s[i : i + ORDER] for i in range(len(s) - ORDER + 1)]


def _count(uri: str):
    """Partial n-gram counts of trusted texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        words: Counter = Counter()
        counts: Counter = Counter()
        at, trusted = None, frozenset()

        def fold() -> None:
            for w, n in words.items():
                for g in grams(w):
                    counts[g] += n
            words.clear()

        for split, batch in by_split(batches, 2):
            if split != at:
                side = read_side(uri, split)
                at, trusted = split, frozenset(side.column("doc_id").to_pylist()) if side else frozenset()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text and doc_id in trusted:
                    words.update(text.split())
            if len(words) > WORDS_KEPT:
                fold()
        fold()
        items = list(counts.items())
        for k in range(0, len(items), 50_000):
            g, n = zip(*items[k : k + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(n, pa.int64())], names=["gram", "n"])

    return run


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different n-grams of each split."""

    def rows(split: int, found: set[str]) -> Iterator[pa.RecordBatch]:
        every = list(found)
        for k in range(0, len(every), 50_000):
            part = every[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([split] * len(part), pa.int64()), pa.array(part, pa.string())], names=["__split", "gram"])

    forget()
    at, found, words = None, set(), set()
    for split, batch in by_split(batches, 1):
        if split != at:
            found.update(g for w in words for g in grams(w))
            yield from rows(at, found)
            at, found, words = split, set(), set()
        for text in batch.column(0).to_pylist():
            if text:
                words.update(text.split())
            if len(words) > WORDS_KEPT:
                found.update(g for w in words for g in grams(w))
                words.clear()
    found.update(g for w in words for g in grams(w))
    yield from rows(at, found)


def _score(uri: str, trusted_uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, logs, known, trusted = None, {}, {}, frozenset()
        for split, batch in by_split(batches, 3):
            if split != at:
                side, ids = read_side(uri, split), read_side(trusted_uri, split)
                logs = dict(zip(side.column("gram").to_pylist(), side.column("logp").to_pylist())) if side else {}
                at, known, trusted = split, {}, frozenset(ids.column("doc_id").to_pylist()) if ids else frozenset()
            total, length = [], []
            for text in batch.column(1).to_pylist():
                words = text.split() if text else []
                for w in words:
                    if w not in known:
                        if len(known) > WORDS_KEPT:
                            known.clear()
                        known[w] = sum(map(logs.__getitem__, grams(w)))
                try:
                    total.append(sum(map(known.__getitem__, words)))
                except KeyError:  # the memory was emptied in the middle of this text
                    total.append(sum(known[w] if w in known else sum(map(logs.__getitem__, grams(w))) for w in words))
                length.append(sum(map(len, words)) + len(words))
            ids = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([math.exp(-t / n) if n else None for t, n in zip(total, length)], pa.float64()),
                 pa.array(length, pa.int64()), pa.array([i in trusted for i in ids], pa.bool_())],
                names=["doc_id", "lang", "perplexity", "n_symbols", "trusted"],
            )

    return run


class KneserNey:
    """Count shards of every order: grams (gram, prob: discounted share) and contexts (ctx, back: back-off weight)."""

    def __init__(self, grams_: list[DataFrame], contexts: list[DataFrame], base: float):
        self.grams, self.contexts, self.base = grams_, contexts, base

    @classmethod
    def from_counts(cls, counts: DataFrame) -> KneserNey:
        """``counts``: gram of the highest order, n."""
        tables, found = [None] * ORDER, materialize(counts, "counts")
        for k in range(ORDER, 0, -1):
            tables[k - 1] = found
            if k > 1:  # in how many n-grams of the next order this one is the suffix
                found = materialize(found.groupBy(F.substring("gram", 2, k - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "counts")
        shards, contexts, base = [], [], 1.0 / ALPHABET
        for k, table in enumerate(tables, 1):
            r = table.agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
            d = discounts(r["n1"], r["n2"], r["n3"], r["n4"])
            off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
            keyed = table.withColumn("ctx", F.substring("gram", 1, k - 1) if k > 1 else F.lit(""))
            context = materialize(keyed.groupBy("ctx").agg(F.sum("n").alias("total"), (F.sum(off) / F.sum("n")).alias("back")), "contexts")
            shards.append(materialize(keyed.join(context, "ctx").select("gram", ((F.col("n") - off) / F.col("total")).alias("prob")), "grams"))
            contexts.append(context.select("ctx", "back"))
        return cls(shards, contexts, base)

    def probabilities(self, wanted: DataFrame) -> DataFrame:
        """(gram, p) of the different n-grams ``wanted``: one pass of joins for each order, lowest first."""
        levels = [materialize(wanted.select("gram"), "wanted")]
        for k in range(ORDER - 1, 0, -1):
            levels.insert(0, materialize(levels[0].select(F.substring("gram", 2, k).alias("gram")).distinct(), "wanted"))
        below = None
        for k, level in enumerate(levels, 1):
            rows = level.withColumn("ctx", F.substring("gram", 1, k - 1) if k > 1 else F.lit("")).withColumn("suffix", F.substring("gram", 2, k - 1) if k > 1 else F.lit(""))
            rows = rows.join(self.grams[k - 1], "gram", "left").join(self.contexts[k - 1], "ctx", "left")
            rows = rows.join(below.withColumnRenamed("gram", "suffix"), "suffix") if k > 1 else rows.withColumn("p", F.lit(self.base))
            p = F.coalesce("prob", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("p")
            below = materialize(rows.select("gram", p.alias("p")), "probabilities")
        return below


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of n-grams seen once, twice and more often; plain ones where a count of counts is missing."""
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return min(max(d1, 0.05), 0.95), min(max(d2, 0.05), 1.9), min(max(d3, 0.05), 2.9)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, perplexity, n_symbols, trusted of every row of ``docs`` (doc_id, text, lang)."""
    spark: SparkSession = docs.sparkSession
    source = with_rows(docs.select("doc_id", "text", "lang"), SPAN)
    good = labels.where("quality = 1").select("doc_id").distinct()
    trusted = write_side(source.select("doc_id", "__split").join(good, "doc_id"), "trusted")
    counts = source.select("doc_id", "text", "__split").mapInArrow(_count(trusted), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    model = KneserNey.from_counts(counts)
    asked = materialize(source.select("text", "__split").mapInArrow(_ask, "__split long, gram string"), "asked")
    found = model.probabilities(asked.select("gram").distinct())
    side = write_side(asked.join(found, "gram").select("__split", "gram", F.log("p").alias("logp")), "log-probabilities")
    run = _score(side, trusted)
    return materialize(source.select("doc_id", "text", "lang", "__split").mapInArrow(run, "doc_id long, lang string, perplexity double, n_symbols long, trusted boolean"), "perplexities")


def decide(scored: DataFrame) -> DataFrame:
    """Adds smoothed (perplexity), threshold and keep."""
    usual = F.avg(F.log("perplexity"))
    trusted = scored.where("trusted and perplexity is not null")
    means = trusted.groupBy(F.col("lang").alias("__lang")).agg(usual.alias("__mean"))
    mean = trusted.agg(usual.alias("m")).first()["m"]
    same = scored["lang"].eqNullSafe(F.col("__lang"))
    middle = F.coalesce("__mean", F.lit(mean).cast("double"), F.lit(0.0))
    smooth = F.exp((F.col("n_symbols") * F.log("perplexity") + PRIOR * middle) / (F.col("n_symbols") + PRIOR))
    rows = materialize(scored.join(means, same, "left").withColumn("smoothed", smooth).drop("__lang", "__mean"), "smoothed")
    trusted = rows.where("trusted and perplexity is not null")
    share = F.percentile_approx("smoothed", QUANTILE, 100_000) * MARGIN
    limits = trusted.groupBy(F.col("lang").alias("__lang")).agg(share.alias("__own"))
    overall = trusted.agg(share.alias("t")).first()["t"]
    joined = rows.join(limits, rows["lang"].eqNullSafe(F.col("__lang")), "left")
    limit = F.coalesce("__own", F.lit(overall).cast("double"), F.lit(float("inf")))
    return joined.withColumn("threshold", limit).withColumn("keep", F.coalesce(F.col("smoothed") <= limit, F.lit(False))).drop("__lang", "__own")
