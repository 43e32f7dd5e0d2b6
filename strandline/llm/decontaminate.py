"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A document is contaminated by an item if some stretch of its words is within
``floor((1 - SIMILARITY) * n)`` word edits of the item's ``n`` words (items of under
six words must occur exactly). Words are lower-cased runs of anything but ASCII white
space, ASCII punctuation and control characters; in scripts written without spaces
each code point is a word, and their punctuation parts words too.

0. Items of one or two words are looked up as they are.
1. Windows. Every word of a document starts a window of the size of each length class of
   items (a factor of 1.4 apart). A stretch within k edits of an n-word item shares at
   least n - 2 - 3k of its word trigrams, so windows with fewer trigrams of the item set
   are passed over; that loses nothing and names no item.
2. ``WALKS`` CGK random walks embed window and items: word edits become Hamming
   differences. A walk takes 1.5 steps a word, so it seldom reaches an item's end.
3. Each walk is sampled ``repeats`` times at ``BITS`` positions; the number of repeats
   follows from the target recall. Window and item are a candidate pair if they fall in
   one bucket, that is, agree in all positions of a sample.
4. Semi-global edit distance of the candidates, exact, decides.

The item set is handled in blocks of bounded size (``BLOCK_ITEMS``, ``BLOCK_BYTES``), so
any number of items works with bounded worker memory; documents are never shuffled.

Edge cases. Null and empty texts match nothing; null and empty items match nothing. An
item with a null id is an item like any other.
Repeated document rows are each reported; repeated items are reported under each id.
An empty table on either side gives no match. Ids may be of any type; a document id named
like the item id gets the prefix ``doc_``.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strandline.llm.shared import held

SIMILARITY, LEAST_WORDS, GRAM = 0.8, 1, 3
WALKS, BITS, RECALL = 8, 3, 0.999
#: Share of a walk's positions assumed to differ at the least similarity.
HAMMING_SHARE = 0.6
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 8_000_000
_CHUNK = 256
_SPACES = bytes(32 if b < 33 or b == 127 or (b < 127 and not chr(b).isalnum()) else b for b in range(256))
#: Thai, Lao, Tibetan, Burmese, Khmer, kana, bopomofo and ideographs; before them the punctuation of these.
_UNSPACED = re.compile("([\u3000-\u3004\u3008-\u3020\u3030\u303d\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65])|[\u0e00-\u109f\u1780-\u17ff\u3005-\u30ff\u3100-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]")


def words_of(text: str | None) -> list[bytes]:
    if text and not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(lambda m: " " if m[1] else f" {m[0]} ", text)
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACES).split() if text else []


def allowed_edits(n: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n + 1e-9) if n >= 6 else 0


def repeats(recall: float = RECALL, share: float = HAMMING_SHARE, bits: int = BITS, walks: int = WALKS) -> int:
    """Samples of each walk that reach the target recall."""
    hit = (1 - share) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit) / walks))


def _bits(walk: np.ndarray, step: int, symbol: np.ndarray) -> np.ndarray:
    """The shared random function of (walk, step, symbol): 0 or 1."""
    x = (symbol.astype(np.uint64) + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) ^ (walk.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) >> np.uint64(63)).astype(np.int64)


def cgk(words: np.ndarray, steps: int, walks: int = WALKS) -> Iterator[np.ndarray]:
    """CGK embeddings, a step at a time: the symbols (row, walk) of padded rows of word ids; -1 stands after a row's end."""
    n, width = words.shape
    padded = np.concatenate([words, np.full((n, 1), -1, words.dtype)], axis=1)
    at, rows, walk = np.zeros((n, walks), np.int64), np.arange(n)[:, None], np.arange(walks)[None, :]
    for step in range(steps):
        symbol = padded[rows, np.minimum(at, width)]
        yield symbol
        at += np.where(symbol >= 0, _bits(walk, step, symbol + 1), 0)


def semi_global(items: np.ndarray, n: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Fewest edits between each item (row of ids, length n) and any stretch of its region (padded by -2)."""
    ramp = np.arange(regions.shape[1] + 1)
    best, d = np.full(len(items), 1 << 30), np.zeros((len(items), regions.shape[1] + 1), np.int64)
    for i in range(items.shape[1]):
        t = d + 1
        t[:, 1:] = np.minimum(t[:, 1:], d[:, :-1] + (regions != items[:, i : i + 1]))
        d = np.minimum.accumulate(t - ramp, axis=1) + ramp
        done = n == i + 1
        best[done] = d[done].min(1)
    return best


class LengthClass:
    """The bucket index of the items of about one length."""

    def __init__(self, rows: np.ndarray, items: list[np.ndarray], n: np.ndarray, k: np.ndarray):
        self.rows, self.n, self.k = rows, n, k
        floor = int(n.min())
        self.steps = math.ceil(1.5 * floor)
        self.least, self.span = int(np.maximum(1, n - GRAM + 1 - GRAM * k).min()), int((n + k).max())
        places = np.random.default_rng(floor).random((repeats(), WALKS, BITS))
        self.places = ((places + np.arange(BITS)) / BITS * self.steps).astype(np.int64)  # one position in each part of the walk
        words = np.full((len(rows), self.steps), -1, np.int64)
        for r, w in enumerate(items):
            words[r, : len(w)] = w[: self.steps]
        row, key = self.buckets(words)
        order = np.argsort(key, kind="stable")
        self.item = rows[row[order]]
        self.keys, self.first, self.count = np.unique(key[order], return_index=True, return_counts=True)

    def buckets(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, bucket) of all samples of all walks that meet item words only."""
        got = np.empty((len(words), *self.places.shape), np.int64)
        for step, symbol in enumerate(cgk(words, self.steps)):
            r, w, b = np.nonzero(self.places == step)
            got[:, r, w, b] = symbol[:, w]
        row, r, w = np.nonzero((got[..., 0] > 0) & (got != 0).all(-1))
        key = (r * WALKS + w).astype(np.uint64)
        for b in range(BITS):
            key = (key ^ (got[row, r, w, b] + 2).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return row, key

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs that share a bucket."""
        row, key = self.buckets(words)
        where = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
        hit = self.keys[where] == key
        row, where = row[hit], where[hit]
        n = self.count[where]
        post = np.repeat(self.first[where] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.unique(np.stack([np.repeat(row, n), self.item[post]]), axis=1)


class ItemIndex:
    """Buckets and words of one block of items. Without ``sieve`` every window is hashed."""

    def __init__(self, items: list[tuple[object, str]], similarity: float = SIMILARITY, sieve: bool = True):
        split = [(i, w) for i, t in items if len(w := words_of(t)) >= LEAST_WORDS]
        self.ids, self.sieve = [i for i, _ in split], sieve
        self.vocab: dict[bytes, int] = {}
        for w in chain.from_iterable(ws for _, ws in split):
            self.vocab.setdefault(w, len(self.vocab) + 1)
        self.base = len(self.vocab) + 1
        self.n = np.array([len(ws) for _, ws in split], np.int64)
        self.k = np.array([allowed_edits(int(n), similarity) for n in self.n], np.int64)
        self.words = [np.fromiter(map(self.vocab.__getitem__, ws), np.int64, len(ws)) for _, ws in split]
        grams = [self._codes(w[:-2], w[1:-1], w[2:]) for w in self.words if len(w) >= GRAM]
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.int64)
        step = np.floor(2 * np.log2(np.maximum(self.n, 1))).astype(int)
        self.classes = [
            LengthClass(rows, [self.words[r] for r in rows], self.n[rows], self.k[rows])
            for c in np.unique(step[self.n >= GRAM]) for rows in [np.nonzero((step == c) & (self.n >= GRAM))[0]]
        ]
        self.short = []
        for length in range(1, GRAM):
            row = np.nonzero(self.n == length)[0]
            if len(row):
                words = np.stack([self.words[r] for r in row])
                code = self._codes(0, words[:, -2] if length > 1 else 0, words[:, -1])
                order = np.argsort(code, kind="stable")
                self.short.append((length, row[order], *np.unique(code[order], return_index=True, return_counts=True)))

    def _codes(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (a * self.base + b) * self.base + c

    def numbered(self, split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words, the documents' starts and sizes)."""
        size = np.fromiter(map(len, split), np.int64, len(split))
        ids = np.fromiter(map(self.vocab.get, chain.from_iterable(split), repeat(0)), np.int64, size.sum())
        return ids, np.cumsum(size) - size, size

    def windows(self, ids: np.ndarray) -> Iterator[tuple[LengthClass, np.ndarray]]:
        """Of each class the positions at which a window may start."""
        if len(ids) < GRAM:
            return
        if not self.sieve:
            for c in self.classes:
                yield c, np.arange(len(ids))
            return
        at = np.nonzero((ids[:-2] > 0) & (ids[1:-1] > 0) & (ids[2:] > 0))[0]
        code = self._codes(ids[at], ids[at + 1], ids[at + 2])
        at = at[self.grams[np.searchsorted(self.grams, code).clip(max=max(0, len(self.grams) - 1))] == code] if len(self.grams) else at[:0]
        if not len(at):
            return
        for c in self.classes:
            # starts from which the class's span holds enough trigrams: between the places of one and of the one ``least`` before it
            held = len(at) - c.least + 1
            if held <= 0:
                continue
            first, last = at[:held], at[c.least - 1 :]
            near = last - first <= c.span - GRAM
            low, high = np.maximum(last[near] - (c.span - GRAM), 0), first[near]
            mark = np.zeros(len(ids) + 1, np.int64)
            np.add.at(mark, low, 1)
            np.add.at(mark, high + 1, -1)
            yield c, np.nonzero(np.cumsum(mark[:-1]))[0]

    def candidates(self, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, start) of windows and items that share a bucket; starts nearer than half the edits count once."""
        found = [np.zeros((3, 0), np.int64)]
        for c, at in self.windows(ids):
            per = max(1, 1_500_000 // (c.places.size + c.steps))
            for some in (at[k : k + per] for k in range(0, len(at), per)):
                doc = np.searchsorted(begin, some, side="right") - 1  # empty documents share a start; the last of them is the owner
                place = some[:, None] + np.arange(c.steps)
                words = np.where(place < (begin + size)[doc][:, None], ids[np.minimum(place, len(ids) - 1)], -1)
                row, item = c.candidates(words)
                step = np.maximum(1, self.k[item] // 2)
                found.append(np.stack([doc[row], item, (some[row] - begin[doc[row]]) // step * step]))
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1))

    def exact(self, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
        """(document, item) of the items too short for a trigram."""
        for length, row, codes, first, count in self.short:
            at = np.arange(max(0, len(ids) - length + 1))
            doc = np.searchsorted(begin, at, side="right") - 1
            keep = (at + length <= begin[doc] + size[doc]) & (ids[at] > 0) & (ids[at + length - 1] > 0)
            at, doc = at[keep], doc[keep]
            code = self._codes(0, *(ids[at + k] if k >= 0 else 0 for k in range(length - 2, length)))
            where = np.searchsorted(codes, code).clip(max=len(codes) - 1)
            hit = codes[where] == code
            if hit.any():
                for d, w in np.unique(np.stack([doc[hit], where[hit]]), axis=1).T.tolist():
                    for r in row[first[w] : first[w] + count[w]].tolist():
                        yield d, r

    @staticmethod
    def _cut(ids: np.ndarray, begin: np.ndarray, size: np.ndarray, start: np.ndarray, width: int, length: np.ndarray, pad: int) -> np.ndarray:
        place = start[:, None] + np.arange(width)
        inside = (place >= 0) & (place < size[:, None]) & (np.arange(width) < length[:, None])
        return np.where(inside, ids[np.clip(begin[:, None] + place, 0, max(0, len(ids) - 1))], pad)

    def matches(self, texts: list[str | None]) -> list[tuple[int, object, int, int]]:
        """(position of the text, item id, words of the item, edits), best window of each pair."""
        ids, begin, size = self.numbered([words_of(t) for t in texts])
        doc, item, start = self.candidates(ids, begin, size)
        best: dict[tuple[int, int], int] = dict.fromkeys(self.exact(ids, begin, size), 0)
        order = np.argsort(self.n[item], kind="stable")
        doc, item, start = doc[order], item[order], start[order]
        at = 0
        while at < len(doc):
            # items come by length, so a slice's padding is small
            end = at + max(1, min(500, 4_000_000 // int(self.n[item[min(len(item) - 1, at + 499)]])))
            d, i, s = doc[at:end], item[at:end], start[at:end]
            at = end
            width = int(self.n[i].max())
            words = np.full((len(i), width), -1, np.int64)
            for r, x in enumerate(i):
                words[r, : self.n[x]] = self.words[x]
            slack = 2 * self.k[i] + 1
            wide = self.n[i] + 2 * slack
            region = self._cut(ids, begin[d], size[d], s - slack, int(wide.max()), wide, -2)
            edits = semi_global(words, self.n[i], region)
            for a, b, e in zip(d[edits <= self.k[i]].tolist(), i[edits <= self.k[i]].tolist(), edits[edits <= self.k[i]].tolist()):
                best[a, b] = min(e, best.get((a, b), e))
        return [(a, self.ids[b], int(self.n[b]), e) for (a, b), e in sorted(best.items())]


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks of bounded size, one block at a time on the driver."""
    block, held = [], 0
    for row in items.select(F.col(id_col), F.col(text_col)).where(F.col(text_col).isNotNull()).toLocalIterator():
        block.append((row[0], row[1]))
        held += len(row[1])
        if len(block) >= BLOCK_ITEMS or held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


class _Shared:
    """A broadcast block with a name that workers can keep its index by."""

    def __init__(self, block):
        self.block, self.id = block, uuid.uuid4().hex

    @property
    def value(self):
        return self.block.value


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row (id, item_id, item_words, edits, similarity) for each document row and item that it holds."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    fields = [T.StructField(f"doc_{id_col}" if id_col == "item_id" else id_col, docs.schema[id_col].dataType), T.StructField("item_id", items.schema[item_id_col].dataType)]
    schema = T.StructType([*fields, *T._parse_datatype_string("item_words int, edits int, similarity double").fields])
    kind = to_arrow_type(fields[1].dataType)
    result = spark.createDataFrame([], schema)
    for block in _blocks(items, item_id_col, item_text_col):
        shared = _Shared(spark.sparkContext.broadcast(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = held(("items", shared.id), lambda: ItemIndex(shared.value))
            for batch in batches:
                for at in range(0, len(batch), _CHUNK):
                    part = batch.slice(at, _CHUNK)
                    if found := index.matches(part.column(1).to_pylist()):
                        row, item, n, edits = zip(*found)
                        columns = [
                            part.column(0).take(pa.array(row)), pa.array(item, kind),
                            pa.array(n, pa.int32()), pa.array(edits, pa.int32()), pa.array([1 - e / w for e, w in zip(edits, n)]),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

        result = result.unionByName(source.mapInArrow(run, schema))
    return result


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns unchanged."""
    spark, at_text = docs.sparkSession, docs.columns.index(text_col)
    for block in _blocks(items, item_id_col, item_text_col):
        shared = _Shared(spark.sparkContext.broadcast(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = held(("items", shared.id), lambda: ItemIndex(shared.value))
            for batch in batches:
                for at in range(0, len(batch), _CHUNK):
                    part = batch.slice(at, _CHUNK)
                    bad = {m[0] for m in index.matches(part.column(at_text).to_pylist())}
                    yield part.filter(pa.array([i not in bad for i in range(len(part))]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
