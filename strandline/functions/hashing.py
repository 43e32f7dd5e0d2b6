"""Checksums: FNV-1a (64 bits), Adler-32, and order-free sums of them."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of FNV-1a.
_OFFSET, _PRIME = 14695981039346656037, 1099511628211


def _fnv(values: list[bytes]) -> np.ndarray:
    """Hashes of byte strings: all strings advance together, one byte a step."""
    n = np.fromiter(map(len, values), np.int64, len(values))
    out = np.full(len(values), _OFFSET, np.uint64)
    if not len(values) or not n.max(initial=0):
        return out
    flat, begin = np.frombuffer(b"".join(values), np.uint8), np.cumsum(n) - n
    order = np.argsort(-n, kind="stable")
    begin, left = begin[order], n[order]
    h, prime = out.copy(), np.uint64(_PRIME)
    for k in range(int(n.max())):
        live = int(np.searchsorted(-left, -k, side="left"))
        h[:live] = (h[:live] ^ flat[begin[:live] + k]) * prime
    out[order] = h
    return out


@F.pandas_udf(T.LongType())
def fnv1a64(text: pd.Series) -> pd.Series:
    """FNV-1a of a text's UTF-8 bytes, its 64 bits as a signed number; null stays null."""
    known = text.notna()
    out = pd.Series([None] * len(text), dtype="Int64")
    out[known.to_numpy()] = _fnv([t.encode() for t in text[known]]).view(np.int64)
    return out


@F.pandas_udf(T.StringType())
def adler32_hex(data: pd.Series) -> pd.Series:
    """Adler-32 of binary data, eight hex digits."""
    return data.map(lambda b: None if b is None else f"{zlib.adler32(bytes(b)) & 0xFFFFFFFF:08x}")


def unsigned(hash_: Column) -> Column:
    """A signed 64-bit hash as the unsigned number it stands for."""
    return F.when(hash_ < 0, hash_.cast("decimal(20,0)") + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(hash_.cast("decimal(20,0)"))


def xor_sum(hash_: Column) -> Column:
    """Order-free checksum of a column of hashes."""
    return F.bit_xor(hash_)


def normal_checksum(text: Column) -> Column:
    """A checksum as eight lower-case hex digits, any '0x', algorithm name and case removed."""
    return F.lpad(F.regexp_replace(F.lower(F.trim(text)), "^(?:adler32[:=])?(?:0x)?", ""), 8, "0")
