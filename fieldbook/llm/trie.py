"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns; every distinct sequence of its first d
turns is a node.  The depths 1 .. 2**K are cut at half depth, both halves are
cut again, all at once, down to single turns:

1. *Name.*  The part of a sequence above a cut names its prefix (the names of
   equal prefixes are equal): 128 bits, combined from the turns' hashes by one
   grouped aggregate, whatever the length.
2. *Upper trie.*  Of the sequences with one cut prefix only that of the
   smallest id goes on in the upper half, with the weight of all.
3. *Lower forests.*  What lies below the cut goes on under its cut prefix.
   After K rounds each piece is one turn deep, so its rows are the nodes.
4. *Graft.*  Totals of a subtree go upward in the order of the cuts: all that
   a lower forest holds is added to the node it hangs on, then the smaller
   pieces do the same.  A lower forest's sum needs nothing from its own
   recursion, so a round is one aggregate and one join for all pieces.

Rounds grow with the logarithm of the longest conversation; a row is a turn,
so neither a long conversation nor a common one is held by one task.  Equal
conversations are one class before the first cut.

Defined cases: turns stand in the order of their number (NULL first), turns of
one number in the order of role and text; NULL role or text is empty; repeated
rows are turns of their own; rows without an id take no part; a conversation
without turns is a member of the root; an empty table gives no node; other
columns are ignored.  Turns and prefixes are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.frames import columns
from fieldbook.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
PIECE_BYTES = 1 << 16          # members' ids handed to the digest at a time
_NAME = ["n1", "n2"]
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")


def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv_id, depth, t1, t2, words): turns numbered from 1 within their
    conversation, with a 128-bit hash and the number of words.  Numbers come
    from a range-partitioned sort, so one conversation may fill many tasks."""
    t = columns(conversations, [conv, turn, role, text]).toDF("conv_id", "turn", "role", "text").where("conv_id is not null")
    t = t.withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    put = t.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"), F.xxhash64(F.lit(1), "role", "text").alias("t1"),
        F.xxhash64(F.lit(2), "text", "role").alias("t2"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    put = materialize(put, "turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = put.groupBy("conv_id", "part").agg(F.min("place").alias("from"), F.count(F.lit(1)).alias("n"))
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return put.join(runs, ["conv_id", "part"]).select(
        "conv_id", (F.col("place") - F.col("from") + F.col("before") + 1).alias("depth"), "t1", "t2", "words")


def _names(turns: DataFrame) -> DataFrame:
    """Each turn's share of the names of the prefixes that hold it."""
    return turns.select(F.col("conv_id").alias("seq"), "depth", F.xxhash64("t1", "t2", "depth").alias("h1"),
                        F.xxhash64("depth", "t2", "t1").alias("h2"), "words")


def _cut(rows: DataFrame, level: int) -> DataFrame:
    """One round: pieces of 2**level depths become pieces of half of that.
    Sequences that end above their piece's cut wait for a later round."""
    rows = rows.withColumn("piece", F.shiftright(F.col("depth") - 1, level))
    rows = rows.withColumn("at", F.shiftleft("piece", level) + (1 << level - 1))
    longer, above = F.col("last") > F.col("at"), F.col("depth") <= F.col("at")
    upper, below = rows.where(longer & above), rows.where(longer & ~above)
    cut = (upper.groupBy("piece", "seq", "r1", "r2", "weight").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
           .select("piece", "seq", F.col("r1").bitwiseXOR(F.col("x1")).alias("n1"),
                   F.col("r2").bitwiseXOR(F.col("x2")).alias("n2"), "weight"))
    kept = cut.groupBy("piece", *_NAME).agg(F.min("seq").alias("seq"), F.sum("weight").alias("weight")).drop(*_NAME)
    top = upper.drop("weight").join(kept, ["piece", "seq"]).withColumn("last", F.col("at"))
    hung = below.drop("r1", "r2").join(cut.drop("weight"), ["piece", "seq"])
    none = {f"a{level}": F.lit(None).cast("long"), f"b{level}": F.lit(None).cast("long")}
    hung = hung.withColumns({f"a{level}": F.col("n1"), f"b{level}": F.col("n2")}).withColumnsRenamed({"n1": "r1", "n2": "r2"})
    return top.withColumns(none).unionByName(hung).unionByName(rows.where(~longer).withColumns(none)).drop("piece", "at")


def _graft(nodes: DataFrame, level: int) -> DataFrame:
    """What the lower forests of one round hold is added to the nodes they
    hang on, which all stand at the round's cuts."""
    held = (nodes.where(f"a{level} is not null").groupBy(F.col(f"a{level}").alias("n1"), F.col(f"b{level}").alias("n2"))
            .agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
    nodes = nodes.drop(f"a{level}", f"b{level}")
    at_cut = F.col("depth") % (1 << level) == 1 << level - 1
    grown = nodes.where(at_cut).join(held, _NAME, "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
        "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0))})
    return nodes.where(~at_cut).unionByName(grown.drop("more_leaves", "more_saved"))


def _pieces(batches):
    """Runs of equal names: their ids as text, in bounded pieces."""
    name, first, ids, size = None, None, [], 0

    def done():
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*name, first, ",".join(ids))], names=["n1", "n2", "first", "ids"])

    for batch in batches:
        for n1, n2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if name is not None and ((n1, n2) != name or size >= PIECE_BYTES):
                yield done()
                name = None
            if name is None:
                name, first, ids, size = (n1, n2), conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if name is not None:
        yield done()


def _digests(batches):
    """Pieces of a name in order: one SHA-256, never the whole list."""
    name, sha = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*name, sha.hexdigest())], names=["n1", "n2", "ends_sha256"])

    for batch in batches:
        for n1, n2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (n1, n2) == name:
                sha.update(b",")
            else:
                if name is not None:
                    yield done()
                name, sha = (n1, n2), hashlib.sha256()
            sha.update(ids.encode())
    if name is not None:
        yield done()


def end_digests(ends: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256): SHA-256 of each name's ids, ascending, comma-joined."""
    pieces = (ends.select(*_NAME, "conv_id").repartitionByRange(*_NAME, "conv_id").sortWithinPartitions(*_NAME, "conv_id")
              .mapInArrow(_pieces, "n1 long, n2 long, first long, ids string"))
    return pieces.repartition(*_NAME).sortWithinPartitions(*_NAME, "first").mapInArrow(_digests, "n1 long, n2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, depth, t1, t2, words) for the
    distinct ``conversations`` (conv_id), as the registered query returns them;
    a node is the first ``depth`` turns of its ``conv_id``."""
    spark = turns.sparkSession
    seq = materialize(_names(turns), "sequences")
    whole = seq.groupBy(F.col("seq").alias("conv_id")).agg(
        F.bit_xor("h1").alias("n1"), F.bit_xor("h2").alias("n2"), F.max("depth").alias("length"))
    ends = materialize(conversations.join(whole, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*_NAME, "length")]), "ends")
    least, n_convs, longest = ends.agg(F.min("conv_id"), F.count(F.lit(1)), F.max("length")).first()
    if not n_convs:
        return spark.createDataFrame([], _NODE)
    classes = ends.groupBy(*_NAME, F.col("length").alias("last")).agg(
        F.min("conv_id").alias("seq"), F.count(F.lit(1)).alias("weight")).drop(*_NAME)
    zero = F.lit(0).cast("long")
    rows = materialize(seq.join(classes, "seq").withColumns({"r1": zero, "r2": zero}), "pieces")
    levels = range(max(longest - 1, 0).bit_length(), 0, -1)
    for level in levels:
        rows = materialize(_cut(rows, level), "pieces")
    hung = [f"{c}{level}" for level in levels for c in "ab"]
    nodes = rows.groupBy(F.col("r1").bitwiseXOR(F.col("h1")).alias("n1"), F.col("r2").bitwiseXOR(F.col("h2")).alias("n2")).agg(
        F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"),
        *[F.min(c).alias(c) for c in ("depth", "words", "r1", "r2", *hung)])
    nodes = materialize(nodes, "nodes")
    children = nodes.groupBy(F.col("r1").alias("n1"), F.col("r2").alias("n2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, _NAME, "left").withColumn("n_children", F.coalesce("n_children", zero)).withColumn(
        "n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).drop("words")
    nodes = materialize(nodes, "nodes")
    own = nodes                                    # what each node adds itself, for the root's totals
    for level in levels:
        nodes = materialize(_graft(nodes, level), "nodes")
    root = own.agg(*[F.coalesce(e, F.lit(o).cast("long")).alias(c) for c, e, o in (
        ("n_children", F.count_if(F.col("depth") == 1), 0), ("n_leaves", F.sum("n_leaves"), 1), ("saved", F.sum("saved"), 0))])
    root = root.select(zero.alias("n1"), zero.alias("n2"), F.lit(least).cast("long").alias("conv_id"), zero.alias("depth"),
                       F.lit(None).cast("long").alias("parent_conv_id"), F.lit(n_convs).cast("long").alias("n_convs"),
                       "n_children", "n_leaves", "saved")
    parents = nodes.select(F.col("n1").alias("r1"), F.col("n2").alias("r2"), F.col("conv_id").alias("parent_conv_id"))
    first, deeper = nodes.where("depth = 1"), nodes.where("depth > 1")
    kept = ["n1", "n2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    every = (first.withColumn("parent_conv_id", F.lit(least).cast("long")).select(*kept)
             .unionByName(deeper.join(parents, ["r1", "r2"]).select(*kept)).unionByName(root.select(*kept)))
    return every.join(end_digests(ends), _NAME, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
