"""Chunked texts and compact exchange of sorted hash sets.

Corpus-wide questions about n-grams ("does another document have it?") are
asked per *chunk* of a few megabytes of text: a chunk sends its distinct
hashes, cut into ranges (*buckets*), as byte-packed gaps of about three bytes
a hash; a bucket sees every chunk's hashes of its range and answers each
chunk.  A hash that a third of all documents share therefore costs one entry
per chunk, not one per document, and no task holds more than its range.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
BUCKET_HASHES = 1 << 20
PACKED = "bucket int, chunk int, payload binary, extra binary"


@dataclass(frozen=True)
class Layout:
    """How many chunks and buckets, and how many hash bits are compared."""
    chunks: int
    buckets: int
    bits: int

    @property
    def shift(self) -> np.uint64:
        return np.uint64(64 - self.bits)

    def cut(self, values: np.ndarray) -> list[tuple[int, slice]]:
        """Ranges of the sorted ``values`` (``bits`` wide) by bucket."""
        edges = np.array([(b << self.bits) // self.buckets for b in range(self.buckets)] , np.uint64)
        at = [*np.searchsorted(values, edges).tolist(), len(values)]
        return [(b, slice(at[b], at[b + 1])) for b in range(self.buckets) if at[b + 1] > at[b]]


def plan_layout(docs: DataFrame, text: str = "text") -> Layout:
    """Sizes from one aggregate over the text lengths: all follow the input."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    words = total // 6 + 1
    return Layout(chunks=total // CHUNK_BYTES + 1, buckets=words // BUCKET_HASHES + 1,
                  bits=min(63, max(40, int(words).bit_length() + 12)))


def chunked(docs: DataFrame, layout: Layout, key: str) -> DataFrame:
    """``docs`` with a ``chunk`` column, co-located by it (one shuffle, which
    Spark reuses for every pass over the chunks)."""
    chunk = F.pmod(F.xxhash64(key), F.lit(layout.chunks)).cast("int")
    return docs.withColumn("chunk", chunk).repartition(layout.chunks, "chunk")


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as gaps of the least whole bytes, plane by plane."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=values[:1])
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(values[0]).to_bytes(8, "little") + planes.T.tobytes()


def unpack(payload: bytes) -> np.ndarray:
    if not payload:
        return np.zeros(0, np.uint64)
    width, first = payload[0], int.from_bytes(payload[1:9], "little")
    planes = np.frombuffer(payload, np.uint8, offset=9).reshape(width, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :width] = planes.T
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64) + np.uint64(first)


def lookup(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted value: its place in ``sorted_keys`` and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(sorted_keys, wanted)
    at[at == len(sorted_keys)] = 0
    return at, sorted_keys[at] == wanted
