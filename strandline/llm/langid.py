"""Language identification with interpolated Kneser-Ney character models.

One character model per language value, orders 1 to 4, context reset at word
boundaries. Counting and scoring work on distinct words: a task counts words
first and expands each distinct word into n-grams once.

* Counts cover every learnable document. Each task emits partial n-gram counts,
  which are summed by one shuffle keyed by (language, order, n-gram).
* n-grams are hashed into ``2**HASH_BITS`` slots an order, so a model has a fixed
  upper size whatever the corpus. A language's model is kept as sorted slot
  arrays (n-gram -> discounted probability, context -> back-off weight), written
  to the shared folder. A worker puts a direct index of slots before them.
* The prediction is the language of lowest cross-entropy per character. A
  document is rejected if its cross-entropy is far above, or its distance to the
  second language far below, what learnable documents with that language show, or
  if it has no letter. "Far" is by median and median absolute deviation over the
  document's length class and its two neighbours, over the whole language where
  these have under ``LEAST_ROWS`` documents. Only documents whose known language
  is the predicted one count, so what has no language never moves a limit.

Edge cases. Null or letter-free text: ``und``, score 0, rejected. Ties: the
language that sorts first. No learnable row at all: every row is ``und``. Repeated
rows are scored alike, one output row each. Null ``lang`` rows and null ``doc_id``
rows are scored but never learned from. Extra columns are passed through when
asked for; result columns replace columns of the same name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.shared import forget, held, materialize, read_table_files, scratch

ORDER = 4
HASH_BITS = 21
FOLDS = 5
#: Distinct words that a task keeps before it folds them into n-gram counts.
WORDS_KEPT = 120_000
#: Words that are cut into n-grams at once, and documents and bytes of text that are split at once: two workers share an executor with Spark's heap.
WORDS_AT_ONCE, ROWS_AT_ONCE, BYTES_AT_ONCE = 20_000, 250, 500_000
#: Allowed distance from the median, in (robust) standard deviations, the least deviation assumed (nats a character), and the documents a length class needs.
REJECT_SIGMAS, LEAST_SIGMA, LEAST_ROWS = 6.0, 0.15, 20

_START, _END = "\x02", "\x03"
_COUNTS = "lang string, ord int, slot int, ctx int, suf int, n long"
_MODEL = "lang string, ord int, slots binary, probs binary, ctxs binary, backs binary"
_OTHER = re.compile(r"[\W\d_]+")


def letters(word: str) -> str:
    """The letters of a lower-cased word."""
    return word if word.isalpha() else _OTHER.sub("", word)


def _slots(words: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per order the slot of the n-gram that ends at each position, which positions are predicted, and each word's first one."""
    pad = _START * (ORDER - 1)
    codes = np.frombuffer("".join(pad + w + _END for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths + ORDER - 1)
    real = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        real[ends - lengths - ORDER + 1 + k] = False
    h, out = np.zeros(len(codes), np.uint64), []
    for k in range(ORDER):
        back = np.concatenate([np.zeros(k, np.uint64), codes[: len(codes) - k]]) if k else codes
        h = (h ^ (back + np.uint64(k + 1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        out.append(((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - HASH_BITS)).astype(np.int32))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return out, real, starts


def _fold(counter: Counter, into: dict) -> None:
    """Add the n-gram counts of counted words: into[order] = slots, contexts, suffixes, counts."""
    merged: dict[str, int] = {}
    for w, n in counter.items():
        if w := letters(w):
            merged[w] = merged.get(w, 0) + n
    counter.clear()
    words, size = list(merged), 1 << HASH_BITS
    for at in range(0, len(words), WORDS_AT_ONCE):
        part = words[at : at + WORDS_AT_ONCE]
        slots, real, starts = _slots(part)
        lengths = np.diff(np.append(starts, real.sum()))
        weight = np.repeat(np.fromiter(map(merged.get, part), np.float64, len(part)), lengths)
        for k in range(ORDER):
            slot = slots[k][real]
            sums = np.bincount(slot, weights=weight, minlength=size)
            ctx, suf = np.zeros(size, np.int32), np.zeros(size, np.int32)
            if k:  # of n-grams that share a slot the least context and suffix count, in whatever order words come
                ctx[slot] = suf[slot] = size
                np.minimum.at(ctx, slot, slots[k - 1][:-1][real[1:]])
                np.minimum.at(suf, slot, slots[k - 1][real])
            if k in into:
                old = into[k]
                seen = sums[old[0]] > 0
                sums[old[0]] += old[3]
                ctx[old[0]] = np.where(seen, np.minimum(ctx[old[0]], old[1]), old[1])
                suf[old[0]] = np.where(seen, np.minimum(suf[old[0]], old[2]), old[2])
            have = np.nonzero(sums)[0]
            into[k] = (have, ctx[have], suf[have], sums[have])


def _pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ROWS_AT_ONCE rows and, but for single rows, BYTES_AT_ONCE bytes of the text column."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(batch):
            most = BYTES_AT_ONCE + (ends[at - 1] if at else 0)
            stop = max(at + 1, min(at + ROWS_AT_ONCE, int(np.searchsorted(ends, most, "right"))))
            yield batch.slice(at, stop - at)
            at = stop


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    words: dict[str, Counter] = {}
    grams: dict[str, dict] = {}
    for batch in _pieces(batches, 0):
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.setdefault(lang, Counter()).update(text.lower().split())
        if sum(map(len, words.values())) > WORDS_KEPT:
            for name, counter in words.items():
                _fold(counter, grams.setdefault(name, {}))
    for lang, counter in words.items():
        _fold(counter, found := grams.setdefault(lang, {}))
        for k, (slot, ctx, suf, n) in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(slot), pa.string()), pa.array(np.full(len(slot), k + 1, np.int32)), pa.array(slot.astype(np.int32)),
                    pa.array(ctx), pa.array(suf), pa.array(n.astype(np.int64)),
                ],
                names=["lang", "ord", "slot", "ctx", "suf", "n"],
            )


def _build(pdf):
    """The sorted arrays of one language's model from its summed counts."""
    import pandas as pd

    lang, rows = pdf["lang"].iloc[0], []
    by = {k: g for k, g in pdf.groupby("ord")}
    for k in range(1, ORDER + 1):
        g = by.get(k)
        if g is None:
            continue
        if k < ORDER and k + 1 in by:  # continuation counts: in how many longer n-grams this one is the suffix
            left = by[k + 1].groupby("suf").size()
            n = g["slot"].map(left).fillna(1).to_numpy(np.float64)
        else:
            n = g["n"].to_numpy(np.float64)
        slot, ctx = g["slot"].to_numpy(), g["ctx"].to_numpy() if k > 1 else np.zeros(len(g), int)
        once, twice = (n == 1).sum(), (n == 2).sum()
        d = once / (once + 2 * twice) if once and twice else 0.5
        size = 1 << HASH_BITS if k > 1 else 1
        total, kinds = np.bincount(ctx, weights=n, minlength=size), np.bincount(ctx, minlength=size)
        at = np.argsort(slot)
        slots, probs = slot[at], ((n - d).clip(0) / total[ctx])[at]
        ctxs = np.nonzero(kinds)[0]
        backs = d * kinds[ctxs] / total[ctxs]
        rows.append((lang, k, slots.astype(np.int32).tobytes(), probs.astype(np.float32).tobytes(), ctxs.astype(np.int32).tobytes(), backs.astype(np.float32).tobytes()))
    return pd.DataFrame(rows, columns=["lang", "ord", "slots", "probs", "ctxs", "backs"])


class _Scorer:
    """Cross-entropies of words under every language, with a bounded memory of words."""

    LIMIT = 120_000

    def __init__(self, uri: str):
        table = {(r["lang"], r["ord"]): r for r in read_table_files(uri).to_pylist()}
        self.langs = sorted({lang for lang, _ in table})
        self.grams = [self._index(table, k, "slots", "probs", 0.0) for k in range(1, ORDER + 1)]
        self.backs = [self._index(table, k, "ctxs", "backs", 1.0) for k in range(1, ORDER + 1)]
        self.reset()

    def _index(self, table: dict, k: int, keys: str, values: str, default: float) -> tuple[np.ndarray, np.ndarray]:
        """slot -> row of a matrix with a column a language; row 0 is for what no language has."""
        found = {lang: (np.frombuffer(table[lang, k][keys], np.int32), np.frombuffer(table[lang, k][values], np.float32)) for lang in self.langs if (lang, k) in table}
        every = np.unique(np.concatenate([f[0] for f in found.values()])) if found else np.zeros(0, np.int32)
        rank = np.zeros(1 << HASH_BITS, np.int32)
        rank[every] = np.arange(1, len(every) + 1)
        rows = np.full((len(every) + 1, max(1, len(self.langs))), default, np.float32)
        for j, lang in enumerate(self.langs):
            if lang in found:
                rows[np.searchsorted(every, found[lang][0]) + 1, j] = found[lang][1]
        return rank, rows

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((0, max(1, len(self.langs)) + 1), np.float32)

    def learn(self, new: list[str]) -> None:
        """Score words not met yet."""
        out = np.zeros((len(new), self.rows.shape[1]), np.float32)
        clean = [letters(w) for w in new]
        have = [i for i, w in enumerate(clean) if w]
        for a in range(0, len(have), WORDS_AT_ONCE):
            part = have[a : a + WORDS_AT_ONCE]
            slots, real, starts = _slots([clean[i] for i in part])
            out[part, -1] = np.diff(np.append(starts, real.sum()))
            p = np.float32(1e-4)
            for k in range(ORDER):
                rank, rows = self.grams[k]
                gram = rows[rank[slots[k][real]]]
                rank, rows = self.backs[k]
                p = gram + (rows[rank[slots[k - 1][:-1][real[1:]]]] if k else rows[rank[0]]) * p
            out[part, :-1] = np.add.reduceat(-np.log(np.maximum(p, 1e-12)), starts, axis=0)
        base = len(self.rows)
        self.rows = np.concatenate([self.rows, out])
        self.index.update(zip(new, range(base, base + len(new))))

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """Per text the summed cross-entropies and the number of predicted characters."""
        split = [t.lower().split() if t else [] for t in texts]
        words: set[str] = set()
        for ws in split:
            words.update(ws)
        new = list(words.difference(self.index))
        if len(self.index) + len(new) > self.LIMIT:
            self.reset()
            new = list(words)
        if new:
            self.learn(new)
        out, lengths = np.zeros((len(texts), self.rows.shape[1])), np.fromiter(map(len, split), np.int64, len(split))
        if lengths.any():
            at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, lengths.sum())
            some = np.nonzero(lengths)[0]
            out[some] = np.add.reduceat(self.rows[at], np.cumsum(lengths)[some] - lengths[some], axis=0, dtype=np.float64)
        return out


class LanguageIdentifier:
    """A fitted identifier; ``uri`` names its model files in the shared folder."""

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri, self.limits = spark, uri, None

    @classmethod
    def fit(cls, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", learn: str | None = None) -> LanguageIdentifier:
        """Learn from rows with a non-null text and language for which the SQL condition ``learn`` holds."""
        spark = docs.sparkSession
        rows = docs.where(learn) if learn else docs
        rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
        counts = rows.mapInArrow(_count_batches, _COUNTS).groupBy("lang", "ord", "slot").agg(F.min("ctx").alias("ctx"), F.min("suf").alias("suf"), F.sum("n").alias("n"))
        uri = scratch(spark, "langid")
        # A language's table has at most ORDER * 2**HASH_BITS slots, whatever the corpus.
        counts.groupBy("lang").applyInPandas(_build, _MODEL).write.parquet(uri)
        return cls(spark, uri)

    def score(self, docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
        """``keep`` columns plus lang_pred, score, xent and margin to the second language (nats a character), n_letters."""
        keep = docs.columns if keep is None else keep
        added = ["lang_pred", "score", "xent", "margin", "n_letters"]
        keep = [c for c in keep if c not in added]
        source = docs.select(*keep, F.col(text_col).alias("__text"))
        schema = T.StructType(source.select(*keep).schema.fields + T._parse_datatype_string("lang_pred string, score double, xent double, margin double, n_letters long").fields)
        uri, width = self.uri, len(keep)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = held(("langid", uri), lambda: _Scorer(uri))
            for batch in _pieces(batches, width):
                sums = scorer.documents(batch.column(width).to_pylist())
                n = sums[:, -1]
                known, total = (n > 0) & bool(scorer.langs), sums[:, :-1]
                best = total.argmin(1)
                low = total.min(1)
                second = np.partition(total, 1, axis=1)[:, 1] if total.shape[1] > 1 else low
                odds = 1.0 / np.exp(np.clip(low[:, None] - total, -700, 0)).sum(1)
                names = [scorer.langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:width],
                        pa.array(names, pa.string()),
                        pa.array(np.where(known, odds, 0.0)),
                        pa.array(np.where(known, low / np.maximum(n, 1), 0.0), mask=~known),
                        pa.array((second - low) / np.maximum(n, 1), mask=~known | (total.shape[1] < 2)),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=[*keep, *added],
                )

        return source.mapInArrow(run, schema)

    def calibrate(self, scored: DataFrame, lang_col: str = "lang") -> LanguageIdentifier:
        """Learn from rows whose known language is the predicted one how far ordinary documents stray, by language and length class."""
        klass = F.floor(F.log2(F.col("n_letters"))).cast("int")
        own = scored.where(F.col(lang_col) == F.col("lang_pred")).where("n_letters > 0").select(F.col("lang_pred").alias("__lang"), "xent", "margin", klass.alias("c"))
        # a row counts for its class and the two beside it, and for its language as a whole (null)
        near = own.select("__lang", "xent", "margin", F.explode(F.array(F.col("c") - 1, F.col("c"), F.col("c") + 1, F.lit(None).cast("int"))).alias("__class"))
        middle = lambda x: F.percentile_approx(x, 0.5, 1000)
        medians = near.groupBy("__lang", "__class").agg(middle("xent").alias("x"), middle("margin").alias("m"), F.count(F.lit(1)).alias("n"))
        medians = materialize(medians.where(F.col("__class").isNull() | (F.col("n") >= LEAST_ROWS)), "langid-medians")
        same = (near["__lang"] == medians["__lang"]) & near["__class"].eqNullSafe(medians["__class"])
        apart = near.join(F.broadcast(medians), same).select(medians["__lang"], medians["__class"], "x", "m", F.abs(F.col("xent") - F.col("x")).alias("dx"), F.abs(F.col("margin") - F.col("m")).alias("dm"))
        stray = lambda d: REJECT_SIGMAS * F.greatest(1.4826 * middle(d), F.lit(LEAST_SIGMA))
        limits = apart.groupBy("__lang", "__class", "x", "m").agg(stray("dx").alias("dx"), stray("dm").alias("dm"))
        self.limits = materialize(limits.select("__lang", "__class", (F.col("x") + F.col("dx")).alias("__limit"), (F.col("m") - F.col("dm")).alias("__least")), "langid-limits")
        return self

    def decide(self, scored: DataFrame) -> DataFrame:
        """Adds ``rejected``; the limits are one row for each language and length class (under 64 a language), so they are broadcast.

        A language that none of its own documents is taken for has no limit, and its predictions are rejected.
        """
        if self.limits is None:
            raise ValueError("calibrate() comes first")
        klass = F.floor(F.log2(F.greatest("n_letters", F.lit(1)))).cast("int")
        whole = self.limits.where("__class is null").select(F.col("__lang").alias("__of"), F.col("__limit").alias("__limit_all"), F.col("__least").alias("__least_all"))
        joined = scored.join(F.broadcast(self.limits.where("__class is not null")), (F.col("lang_pred") == F.col("__lang")) & (klass == F.col("__class")), "left")
        joined = joined.join(F.broadcast(whole), F.col("lang_pred") == F.col("__of"), "left")
        strange = F.coalesce(F.col("xent") > F.coalesce("__limit", "__limit_all"), F.lit(True))
        unsure = F.coalesce(F.col("margin") < F.coalesce("__least", "__least_all"), F.lit(False))
        return joined.withColumn("rejected", (F.col("lang_pred") == "und") | strange | unsure).drop("__lang", "__class", "__limit", "__least", "__of", "__limit_all", "__least_all")


#: Documents of fold 0 are held out.
HELD_OUT = f"crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % {FOLDS} = 0"
LEARNABLE = f"doc_id is not null and not ({HELD_OUT})"


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, xent, n_letters, rejected for every row of ``docs``."""
    model = LanguageIdentifier.fit(docs, learn=LEARNABLE)
    scored = materialize(model.score(docs, keep=["doc_id", "lang"]), "langid-scores")
    model.calibrate(scored.where(LEARNABLE))
    return model.decide(scored).selectExpr("doc_id", f"{HELD_OUT} as held_out", "lang_pred", "score", "xent", "n_letters", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns unchanged; ``lang`` becomes the predicted language where it was null."""
    columns = docs.columns
    at = {c: f"__c{i}" for i, c in enumerate(columns)}  # the input's own score, rejected, ... are not touched
    model = LanguageIdentifier.fit(docs, learn=LEARNABLE)
    model.calibrate(materialize(model.score(docs.select("doc_id", "text", "lang"), keep=["doc_id", "lang"]), "langid-scores").where(LEARNABLE))
    kept = model.decide(model.score(docs.toDF(*at.values()), at["text"])).where(~F.col("rejected"))
    return kept.select(*[(F.coalesce(at[c], "lang_pred") if c == "lang" else F.col(at[c])).alias(c) for c in columns])
