"""Token ids in fixed-width bit-packed files.

Documents are dealt by id range, encoded, and written block by block in
ascending id order.  An id takes the least bits the vocabulary needs; a block
holds whole documents, the offset of each, and the ids before it in its file
part, so any document or range of ids is found from the block index and
unpacked with numpy without reading what stands before it.  The files are
Parquet tables of such blocks plus a small table with the ids before each part.

Texts are cut where the byte-level tokenizer surely cuts too, and the ids of
units met are kept in a bounded store per worker (``wordids``); the ids are
those of the whole text.

Defined cases: NULL and empty texts are the end id alone; NULL document ids
come first; rows of one id stand in the order of their texts; an empty table
gives files without blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbook.llm.frames import columns
from fieldbook.llm.wordids import WordIds
from fieldbook.llm.words import row_slices, text_buffers

BLOCK_IDS = 1 << 16             # a block ends after the document that fills it
PART_BYTES = 16 << 20           # text of one file part

_WORKER: dict = {}

_FORMAT = ("part int, block int, before long, bits int, n_ids long, doc_ids array<long>, offsets array<long>, "
           "first_id long, last_id long, payload binary")


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` at ``bits`` bits each, lowest bit first."""
    ids = np.ascontiguousarray(ids, "<u4")
    if bits % 8 == 0:
        return ids.view(np.uint8).reshape(-1, 4)[:, :bits // 8].tobytes()
    planes = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8), axis=None, bitorder="little").tobytes()


def unpack_ids(payload: bytes, bits: int, begin: int, end: int) -> np.ndarray:
    """The ids ``begin .. end`` of a packed block; only their bytes are touched."""
    if end <= begin:
        return np.zeros(0, "<u4")
    low, high = begin * bits // 8, -(-end * bits // 8)
    raw = np.frombuffer(payload, np.uint8, count=high - low, offset=low)
    if bits % 8 == 0:
        out = np.zeros((end - begin, 4), np.uint8)
        out[:, :bits // 8] = raw.reshape(-1, bits // 8)
        return out.view("<u4").ravel()
    planes = np.unpackbits(raw, bitorder="little")[begin * bits - 8 * low:][:(end - begin) * bits]
    return (planes.reshape(-1, bits).astype("<u4") << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype="<u4")


def _store(path: str) -> WordIds:
    if path not in _WORKER:
        _WORKER.clear()                  # one tokenizer's words at a time
        _WORKER[path] = WordIds(path, None)
    return _WORKER[path]


def _write_blocks(path: str, end_id: int, block_ids: int):
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("bits", pa.int32()),
                        ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                        ("first_id", pa.int64()), ("last_id", pa.int64()), ("payload", pa.binary())])
    def write(batches):
        store, part = _store(path), TaskContext.get().partitionId()
        bits = max(1, (len(store.marked) - 1).bit_length())
        block, before, docs, held, n = 0, 0, [], [], 0

        def flush():
            nonlocal block, before, docs, held, n
            offsets = np.cumsum([0] + [len(h) for h in held]).tolist()
            known = [d for d in docs if d is not None]
            row = (part, block, before, bits, n, docs, offsets, min(known, default=None), max(known, default=None),
                   pack_ids(np.concatenate(held), bits))
            block, before, docs, held, n = block + 1, before + n, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            for lo, hi in row_slices(offsets):
                ids, begin = store.encode(offsets, data, lo, hi, end_id)
                cuts = begin.tolist()
                for i, doc_id in enumerate(batch.column("doc_id").slice(lo, hi - lo).to_pylist()):
                    docs.append(doc_id)
                    held.append(ids[cuts[i]:cuts[i + 1]])
                    n += len(held[-1])
                    if n >= block_ids:
                        yield flush()
        if docs:
            yield flush()
    return write


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text",
                 block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` and write ``folder/blocks`` and ``folder/parts``."""
    docs = columns(docs, [key, text]).toDF("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = docs.repartitionByRange(total // PART_BYTES + 1, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(_write_blocks(tokenizer, end_id, block_ids), _FORMAT).write.parquet(f"{folder}/blocks")
    spark = docs.sparkSession
    sizes = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    # one row per file part, so one small task
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("part_start")).write.parquet(f"{folder}/parts")


def read_tokens(spark: SparkSession, folder: str, doc_range: tuple[int, int] | None = None) -> DataFrame:
    """(doc_id, start, ids) from the files; ``ids`` as little-endian unsigned
    32-bit integers.  ``doc_range`` (first and last id) reads only the blocks
    whose range meets it."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    if doc_range is not None:
        blocks = blocks.where((F.col("last_id") >= doc_range[0]) & (F.col("first_id") <= doc_range[1]))
    parts = spark.read.parquet(f"{folder}/parts")
    blocks = blocks.join(parts, "part").select("bits", "doc_ids", "offsets", (F.col("part_start") + F.col("before")).alias("at"), "payload")
    out = blocks.mapInArrow(_read_blocks, "doc_id long, start long, ids binary")
    return out if doc_range is None else out.where(F.col("doc_id").between(*doc_range))


def _read_blocks(batches):
    for batch in batches:
        for r in range(len(batch)):                  # one block at a time bounds the memory
            bits, docs, offsets, at, payload = (c[r].as_py() for c in batch.columns)
            ids = [unpack_ids(payload, bits, a, b).tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array([at + o for o in offsets[:-1]], pa.int64()),
                                              pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"])
