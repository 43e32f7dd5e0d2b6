"""Packing by power-of-two decomposition: no sequence crosses documents.

A document's ids (its end id included) are cut into pieces of ``LONGEST`` ids and then
into pieces whose lengths are the powers of two of the binary form of the rest,
longest first. Every piece is a sequence of its own, bucketed with those of equal
length, so sequences need no padding at all and a batch of one bucket is a dense
matrix. The number of pieces a document adds is at most ``log2(LONGEST)`` over the
number of full sequences.

A sequence's id holds its bucket (log2 of the length) in the top bits, then the task
and the place in the task, so ids are unique, equal lengths sort together and neither
a shuffle nor a count of all rows is needed.

Edge cases. Null and empty texts consist of the end id alone. Repeated rows are
packed once each. Null ids pass through. An empty table packs to no sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.tokens import encoder, wide

LONGEST = 1024
VOCABULARY, END_ID = "byte_bpe_50k.json", 0
_TASK_SHIFT, _BUCKET_SHIFT = 34, 59


def pieces(n: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(start, length) of every piece of a document of ``n`` ids."""
    out = [(at, longest) for at in range(0, n - n % longest, longest)]
    at = n - n % longest
    for bit in range(longest.bit_length() - 1, -1, -1):
        if (n - at) >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID, longest: int = LONGEST) -> DataFrame:
    """One row a piece: id, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32)."""
    if longest & (longest - 1) or longest > 1 << 15:
        raise ValueError("the longest sequence must be a power of two, 32768 at most")
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *T._parse_datatype_string("start long, length long, doc_tokens long, sequence_id long, offset long, ids binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, made = encoder(vocabulary), 0
        task = TaskContext.get().partitionId() << _TASK_SHIFT
        end = end_id.to_bytes(4, "little")
        for whole in batches:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                rows, start, length, tokens, sequence, ids = [], [], [], [], [], []
                for r, raw in enumerate(enc.encode(batch.column(1))):
                    data = wide(raw, enc.dtype) + end
                    n = len(data) // 4
                    for s, k in pieces(n, longest):
                        rows.append(r), start.append(s), length.append(k), tokens.append(n)
                        sequence.append((k.bit_length() - 1) << _BUCKET_SHIFT | task | made)
                        ids.append(data[4 * s : 4 * (s + k)])
                        made += 1
                long = pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, long)), pa.array(start, long), pa.array(length, long), pa.array(tokens, long),
                     pa.array(sequence, long), pa.array([0] * len(rows), long), pa.array(ids, pa.binary())],
                    names=schema.fieldNames(),
                )

    return source.mapInArrow(run, schema)
