"""Token-id files: blocks of canonical Huffman codes with bit-offset checkpoints.

Writing. Texts are encoded once and kept as a table; ids are counted over the whole
corpus; one code is made from the counts (at most a vocabulary's worth of rows reach
the driver). The rows are then dealt by ranges of ``doc_id`` and every task writes one
file, blocks of ``BLOCK`` ids, in ascending ``doc_id`` order. A task's file name is new
at every attempt and only names in the returned index are read, so a lost executor
or a speculative attempt leaves no half file behind.

File: MAGIC, length of the header, header (JSON: code lengths deflated, base64), then
blocks: a fixed struct (documents that begin here, ids, checkpoints, bytes), those
documents' ids and total id counts (a document may run on into later blocks),
checkpoints, bits. A block decodes without any other.

Edge cases. Null and empty texts have the end id alone. Equal ``doc_id`` values are
ordered by their ids' bytes. Null ``doc_id`` values come first. An empty table gives an
empty index and an empty result.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.huffman import Code, code_lengths
from strandline.llm.shared import materialize, open_fs, scratch
from strandline.llm.tokens import encoder

MAGIC = b"SLTOKEN1"
VOCABULARY, END_ID = "word_bpe_49k.json", 2
BLOCK = 1 << 18
FILE_IDS = 8_000_000
_HEAD = struct.Struct("<IIIQ")
_NULL = -(1 << 63)


def tokenized(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id and the ids with the end id, as the encoder's little-endian integers."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = end_id.to_bytes(enc.dtype.itemsize, "little")
        for whole in batches:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                ids = [raw + end for raw in enc.encode(batch.column(1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return source.mapInArrow(run, "doc_id long, ids binary")


def counted(table: DataFrame, width: int) -> np.ndarray:
    """How often each id occurs; the result has one row an id of the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 17, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 2000):
                ids = np.frombuffer(b"".join(batch.column(0).slice(at, 2000).to_pylist()), f"<u{width}")
                n = np.bincount(ids)
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[: len(n)] += n
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])

    rows = table.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def header(code_sizes: np.ndarray, vocabulary: str, end_id: int) -> bytes:
    said = json.dumps({"vocabulary": vocabulary, "end_id": end_id, "lengths": base64.b64encode(zlib.compress(code_sizes.astype(np.uint8).tobytes())).decode()}).encode()
    return MAGIC + struct.pack("<I", len(said)) + said


def write_block(out, code: Code, docs: list[tuple[int, int]], ids: np.ndarray) -> None:
    bits, checkpoints = code.encode(ids)
    out.write(_HEAD.pack(len(docs), len(ids), len(checkpoints), len(bits)))
    out.write(np.array([d for d, _ in docs], "<i8").tobytes() + np.array([n for _, n in docs], "<u8").tobytes())
    out.write(checkpoints.astype("<u4").tobytes() + bits)


def read_file(uri: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of every document of a file, in order."""
    filesystem, path = open_fs(uri)
    with filesystem.open_input_stream(path) as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        said = json.loads(f.read(struct.unpack("<I", f.read(4))[0]))
        code = Code(np.frombuffer(zlib.decompress(base64.b64decode(said["lengths"])), np.uint8))
        waiting: list[tuple[int, int]] = []
        left: list[np.ndarray] = []
        have = 0
        while head := f.read(_HEAD.size):
            n_docs, n, n_check, n_bytes = _HEAD.unpack(head)
            doc_ids, sizes = np.frombuffer(f.read(8 * n_docs), "<i8"), np.frombuffer(f.read(8 * n_docs), "<u8")
            waiting += zip(doc_ids.tolist(), sizes.tolist())
            checkpoints = np.frombuffer(f.read(4 * n_check), "<u4")
            left.append(code.decode(f.read(n_bytes), checkpoints, n))
            have += n
            if waiting and waiting[0][1] <= have:
                ids, at, done = np.concatenate(left), 0, 0
                for doc_id, size in waiting:
                    if at + size > have:
                        break
                    yield (None if doc_id == _NULL else doc_id), ids[at : at + size]
                    at, done = at + size, done + 1
                waiting, left, have = waiting[done:], [ids[at:]], have - at


def write_token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID, uri: str | None = None) -> DataFrame:
    """Write the files; the index: part, file, documents, ids."""
    spark = docs.sparkSession
    uri = uri or scratch(spark, "tokens")
    table = materialize(tokenized(docs, id_col, text_col, vocabulary, end_id), "token-ids")
    width = encoder(vocabulary).dtype.itemsize
    counts = counted(table, width)
    sizes = code_lengths(counts)
    head = header(sizes, vocabulary, end_id)
    parts = max(1, -(-int(counts.sum()) // FILE_IDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        code, name, out = Code(sizes), f"{uri}/part-{part:06d}-{uuid.uuid4().hex}.slt", None
        filesystem, path = open_fs(name)
        documents = total = 0
        begun: list[tuple[int, int]] = []
        held: list[np.ndarray] = []
        have = 0
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if out is None:
                    filesystem.create_dir(path.rpartition("/")[0], recursive=True)
                    out = filesystem.open_output_stream(path)
                    out.write(head)
                ids = np.frombuffer(raw, f"<u{width}")
                begun.append((_NULL if doc_id is None else doc_id, len(ids)))
                held.append(ids)
                documents, total, have = documents + 1, total + len(ids), have + len(ids)
                while have >= BLOCK:
                    ids = np.concatenate(held)
                    write_block(out, code, begun, ids[:BLOCK])
                    begun, held, have = [], [ids[BLOCK:]], have - BLOCK
        if out is not None:
            if begun or have:
                write_block(out, code, begun, np.concatenate(held))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([name]), pa.array([documents]), pa.array([total])], names=["part", "file", "documents", "ids"])

    ordered = table.repartitionByRange(parts, F.col("doc_id")).sortWithinPartitions("doc_id", "ids")
    return materialize(ordered.mapInArrow(run, "part long, file string, documents long, ids long"), "token-index")


def read_token_files(spark: SparkSession, index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian uint32) of every document, in the files' order."""
    files, base = [], 0
    for r in index.orderBy("part").collect():  # one row a file
        files.append((r["file"], base))
        base += r["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                name, start = files[k]
                rows: list[tuple] = []
                held = 0
                for doc_id, ids in read_file(name):
                    rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes()))
                    start, held = start + len(ids), held + len(ids)
                    if held > 1_000_000:
                        yield _rows(rows)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        a, b, c, d = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    n = len(files)
    return spark.range(0, n, 1, max(1, n)).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
