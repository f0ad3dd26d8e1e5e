"""Helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITESPACE_WORD = r"[^\x20\x09-\x0D]+"
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def source_key(source: Column) -> Column:
    """A key that is never null: equal for equal sources, its own value for a missing one."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def pack(array: np.ndarray) -> bytes:
    """Array to compressed bytes, equal byte places side by side."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), -1).T if len(array) else array
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as compressed differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def by_bytes(sizes, bound: int):
    """Ranges [a, b) of consecutive items holding at most ``bound`` bytes, one item at least."""
    a, total = 0, 0
    for i, size in enumerate(sizes):
        if i > a and total + size > bound:
            yield a, i
            a, total = i, 0
        total += size
    if len(sizes) > a:
        yield a, len(sizes)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of arange(start, start + count)."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total) + shift
