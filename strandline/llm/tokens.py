"""Token ids of whole texts, shared by the packing and the token-file operators.

The ids are those of the tokenizers library called on the whole text with
``add_special_tokens=False``. It is called on distinct words only: a text is cut before
each single space, which is a pre-token boundary of the supported vocabularies; a chunk
is cut at line ends inside it and before trailing punctuation; and a worker keeps the ids
of words it has met (two generations of ``KEPT`` at most). Cutting, de-duplication and
putting together run on Arrow arrays. A text with a chunk for which the cut isn't safe
(it starts with further white space), or with the string of an added token, is encoded
whole.

Edge cases. Null is the empty text, which has no id. Repeated texts have equal ids; an
empty batch gives no result. Very long texts are cut like any other.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strandline.llm.shared import held

KEPT = 300_000
#: Bytes of text that are encoded at a time.
SLICE_BYTES = 4_000_000
#: Punctuation that is a pre-token of its own after a letter or digit (the apostrophe may start a contraction).
_TAIL = ".,;:!?#$%&*|"
#: Letters of words that are one pre-token and stay letters under the vocabularies' normalisation.
_PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+$"
_SPACE = "\\x09-\\x0d\\x1c-\\x20\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _offsets(array: pa.Array) -> np.ndarray:
    """Offsets of a large_binary array without an offset of its own."""
    return np.frombuffer(array.buffers()[1], np.int64)[: len(array) + 1]


class ChunkEncoder:
    """Ids of texts by a vocabulary file of the tokenizers library."""

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.name = name
        self.tokenizer = Tokenizer.from_file(vocabulary(name))
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.always_whole = any(t.normalized for t in added)  # such tokens are found in the normalised text
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        pieces = self.tokenizer.get_vocab(with_added_tokens=False)
        self.by_end = any(p.endswith("</w>") for p in pieces)  # pieces mark the ends of words, or else their starts
        self.edge = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.edge[[i for p, i in pieces.items() if (p.endswith("</w>") if self.by_end else p.startswith("\u0120"))]] = True
        self.known: dict[str, bytes] = {}  # word, with its leading space if it has one -> ids
        self.old: dict[str, bytes] = {}  # the generation before
        self.tails: dict[str, bytes] = {}
        self.line_end = self._ids(["\n"])[0]

    def _ids(self, texts: list[str]) -> list[bytes]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)) * self.dtype.itemsize).tolist()
        flat = np.fromiter(chain.from_iterable(lists), self.dtype).tobytes()
        return [flat[i:j] for i, j in zip([0, *ends], ends)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of plain words after a space: many words a call, cut apart where pieces mark a word's edge."""
        texts = ["".join(words[k : k + 500]) for k in range(0, len(words), 500)]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(lists), self.dtype)
        at = np.nonzero(self.edge[flat])[0]
        if len(at) != len(words):  # a vocabulary without such marks
            return self._ids(words)
        bounds = np.append(0, at + 1) if self.by_end else np.append(at, len(flat))
        bounds, data = (bounds * self.dtype.itemsize).tolist(), flat.tobytes()
        return [data[i:j] for i, j in zip(bounds, bounds[1:])]

    def _lookup(self, keys: list[str], plain: np.ndarray) -> list[bytes]:
        """Ids of words; ``plain`` ones consist of plain letters but for the leading space."""
        found = list(map(self.known.get, keys))
        missing = [i for i, f in enumerate(found) if f is None]
        if len(self.known) + len(missing) > KEPT:
            self.old, self.known = self.known, {}
            missing = list(range(len(keys)))
        spaced, other = [], []
        for i in missing:
            key = keys[i]
            if (ids := self.old.get(key)) is not None:
                self.known[key] = ids
            elif plain[i] and key[0] == " ":
                spaced.append(key)
            else:
                other.append(key)
        for make, some in ((self._word_ids, spaced), (self._ids, other)):
            for at in range(0, len(some), 20_000):
                part = some[at : at + 20_000]
                self.known.update(zip(part, make(part)))
        return list(map(self.known.__getitem__, keys)) if missing else found

    def _tail_ids(self, tails: list[str]) -> tuple[list[bytes], np.ndarray]:
        """Ids of the different tails, and which one each is."""
        place = {t: i for i, t in enumerate(dict.fromkeys(tails))}
        if len(self.tails) + len(place) > KEPT // 8:
            self.tails.clear()
        if new := [t for t in place if t not in self.tails]:
            self.tails.update(zip(new, self._ids(new)))
        return [self.tails[t] for t in place], np.fromiter(map(place.__getitem__, tails), np.int64, len(tails))

    def _chunk_ids(self, chunks: pa.Array, started: np.ndarray) -> pa.Array:
        """Ids of chunks; a space stands before those that aren't ``started``."""
        lines = pc.split_pattern(chunks, "\n")
        bounds, parts = lines.offsets.to_numpy().astype(np.int64), lines.flatten()
        size = np.diff(bounds)
        if (size > 1).any():  # a line end next to other white space is left to the library
            edge = np.asarray(pc.match_substring_regex(parts, f"^$|^[{_SPACE}]|[{_SPACE}]$"))
            bad = np.logical_or.reduceat(edge, bounds[:-1]) & (size > 1)
            if bad.any():
                own = chunks.filter(pa.array(bad))
                index = np.where(np.repeat(bad, size), -1, np.arange(len(parts)))
                index[bounds[:-1][bad]] = len(parts) + np.arange(bad.sum())
                parts = pa.concat_arrays([parts, own]).take(pa.array(index[index >= 0]))
                size = np.where(bad, 1, size)
                bounds = np.append(0, np.cumsum(size))
        bare = pc.utf8_rtrim(parts, characters=_TAIL)
        plain = pc.match_substring_regex(bare, _PLAIN)
        words = pc.if_else(plain, bare, parts)
        first = np.zeros(len(parts), bool)
        first[bounds[:-1]] = True
        lead = first & ~np.repeat(started, size)
        blank = pa.scalar("", pa.large_string())
        keys = pc.binary_join_element_wise(pc.if_else(pa.array(lead), pa.scalar(" ", pa.large_string()), blank), words, blank).dictionary_encode()
        index = keys.indices.to_numpy().astype(np.int64)
        is_plain = np.zeros(len(keys.dictionary), bool)
        is_plain[index] = np.asarray(plain)
        ids = self._lookup(keys.dictionary.to_pylist(), is_plain)
        cut = np.asarray(pc.binary_length(parts)) - np.asarray(pc.binary_length(words))
        with_tail = np.nonzero(cut)[0]
        tails, which = self._tail_ids([p[-k:] for p, k in zip(parts.take(pa.array(with_tail)).to_pylist(), cut[with_tail].tolist())])
        pool = pa.array([*ids, *tails, self.line_end, b""], pa.large_binary())
        pieces = np.full((len(parts), 3), len(pool) - 1)
        pieces[~first, 0] = len(pool) - 2
        pieces[:, 1] = index
        pieces[with_tail, 2] = len(ids) + which
        flat = pool.take(pa.array(pieces.ravel()))
        return pa.Array.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(_offsets(flat)[3 * bounds].tobytes()), flat.buffers()[2]])

    def _encode(self, texts: pa.Array) -> list[bytes]:
        split = pc.split_pattern(texts, " ")
        bounds, flat = split.offsets.to_numpy().astype(np.int64), split.flatten()
        coded = flat.dictionary_encode()
        chunks, heads = coded.dictionary, flat.take(pa.array(bounds[:-1]))
        at = coded.indices.to_numpy().astype(np.int64)
        at[bounds[:-1]] = len(chunks) + np.arange(len(texts))
        started = np.arange(len(chunks) + len(texts)) >= len(chunks)
        unsafe = np.append(np.asarray(pc.match_substring_regex(chunks, f"^$|^[\\x00-\\x20{_SPACE}]")), np.zeros(len(texts), bool))
        whole = np.logical_or.reduceat(unsafe[at], bounds[:-1]) | self.always_whole
        for content in self.added:
            whole |= np.asarray(pc.match_substring(texts, content))
        joined = self._chunk_ids(pa.concat_arrays([chunks, heads]), started).take(pa.array(at))
        ends, data = _offsets(joined)[bounds].tolist(), memoryview(joined.buffers()[2] or b"")
        out = [bytes(data[i:j]) for i, j in zip(ends, ends[1:])]
        some = np.nonzero(whole)[0].tolist()
        for i, ids in zip(some, self._ids(texts.take(pa.array(some, pa.int64())).to_pylist()) if some else []):
            out[i] = ids
        return out

    def encode(self, texts) -> list[bytes]:
        """The ids of each text as little-endian integers of ``dtype``; null is the empty text. Takes a list or an Arrow array."""
        column = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).cast(pa.large_string()).fill_null("")
        out: list[bytes] = []
        size = np.cumsum(np.asarray(pc.binary_length(column)))
        at = 0
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES, side="right")))
            out += self._encode(pa.concat_arrays([column.slice(at, end - at)]))
            at = end
        return out


def encoder(name: str) -> ChunkEncoder:
    """This worker's encoder of a vocabulary."""
    return held(("tokens", name), lambda: ChunkEncoder(name))


def wide(ids: bytes, dtype: np.dtype) -> bytes:
    """Stored ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(ids, dtype).astype("<u4").tobytes()
