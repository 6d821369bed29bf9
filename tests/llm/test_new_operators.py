"""Phrase collocations, best-fit packing and the conversation trie against brute force."""

import array
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import bestfit, phrases, queries, trie
from fieldbook.llm.wordids import WordIds
from fieldbook.llm.words import row_slices, text_buffers

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, id int, chunk string, n int, part int, length string, sequence_id int, `left` int"
TALKS = "conv_id long, turn long, role string, text string, depth string, n1 int, seq int, weight int, words string, part int"


def docs_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "y", 4, 5) for r in rows], DOCS)


def talks_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y", 4) for r in rows], TALKS)


def documents(seed=3, n=80):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "é", "Éa", "a\x0bb", "x-y"] + [f"w{k}" for k in range(8)]
    rows = []
    for i in range(n):
        parts = [rng.choice(words) + rng.choice(["", "", "", ".", ",", ";!", "\n", "\r\n", "\t"]) for _ in range(rng.choice([0, 1, 5, 40, 120]))]
        rows.append((i, " ".join(parts), rng.choice(["en", "de", None, ""])))
    rows += [(500, None, "en"), (501, "", None), (502, "New York new york " * 3000, "en"), (503, " .. \n", "fr"), (None, "of the of the", "en")]
    return [*rows, rows[2], rows[2]]


def by_sql(name, table, rows, names, **swap):
    con = duckdb.connect()
    types = {"text": pa.string(), "lang": pa.string(), "role": pa.string()}
    data = pa.table({c: pa.array([r[k] for r in rows], types.get(c, pa.int64())) for k, c in enumerate(names)})
    con.register(table, data)
    sql = queries.ORACLES[name]
    for old, new in swap.items():
        sql = sql.replace(*new)
    return sorted(con.execute(sql).fetchall(), key=repr)


def test_tiles_count_as_sorting_does():
    rng = np.random.default_rng(0)
    left, right = (np.minimum(rng.zipf(1.3, 200_000), 2**30).astype(np.int64) for _ in range(2))
    codes = phrases.pair_codes(left, right)
    assert all((x == y).all() for x, y in zip(phrases.pair_ids(codes), (left, right), strict=True))
    weights = rng.integers(1, 9, len(codes))
    for w in (None, weights):
        want = {}
        for c, k in zip(codes.tolist(), [1] * len(codes) if w is None else w.tolist(), strict=True):
            want[c] = want.get(c, 0) + k
        got, counts = phrases.tile_counts(codes, w, dense=50)
        assert (np.diff(got) > 0).all() and dict(zip(got.tolist(), counts.tolist(), strict=True)) == want
    assert len(phrases.tile_counts(codes[:0])[0]) == 0
    for v in (codes[:0], left, np.array([0, 2**40])):
        assert (phrases._loose(phrases._squeeze(v)) == v).all()


@pytest.mark.parametrize("least,top", [(3, 2000), (4, 7)])
def test_collocations_against_sql(spark, monkeypatch, least, top):
    monkeypatch.setattr(phrases, "BUCKET_WORDS", 4000)          # several buckets
    rows = documents()
    frame = docs_frame(spark, rows).repartition(5)
    got = phrases.top_collocations(frame, least, top=top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    want = by_sql("op11_phrase_collocations", "documents", rows, ["doc_id", "text", "lang"],
                  a=("AND c >= 100", f"AND c >= {least}"), b=("rank <= 2000", f"rank <= {top}"))
    assert sorted(map(tuple, got), key=repr) == want and len(want) > 10


def test_collocations_longer_phrases_absorb_by_share(spark):
    rows = [(i, "a b c. " * 3 + "a b. " * (i % 2) + "b c a b c d e", "en") for i in range(20)]
    got = {r.phrase for r in phrases.collocations(docs_frame(spark, rows), least=5, absorbed_percent=60).collect()}
    levels, _ = phrases.frequent_phrases(docs_frame(spark, rows), 5)
    counts = {r.phrase: r.heads[-1] for t in levels[1:] for r in t.collect()}
    assert got == {p for p, a in counts.items()
                   if not any(f" {p} " in f" {q} " and q != p and 100 * b >= 60 * a for q, b in counts.items())}


def test_collocations_of_nothing(spark):
    for rows in ([], [(1, None, None)], [(1, "one two", "en")]):
        assert phrases.top_collocations(docs_frame(spark, rows)).collect() == []


ATOMS = ["a", "Foo", "é", "É.", "foo.", "bar,", "don't", "DON'T.", "x's.", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>.",
         "x<|startoftext|>y", "”.", "é”.", "…", "1", "42.", "a1.", " ", "́", "é.", "İ", "ΑΣ", "Σ.", "ﬁ", "中文。", "a.b",
         "--", "?!", "!", "×.", "Ã×.", "\x85", "\x1c", "ſ", "K", "👍🏽", "'ll", "i'LL,", "‍", "½.", "ᄒ", "ᅡ", "x" * 300,
         "\n", ".\n", "à", "ÿ.", "÷", "Ã", "\r\n", "ā.", " .", "a\nB", "b!\nc"]


@pytest.mark.parametrize("name,word_end", [("word_bpe_49k.json", "</w>"), ("byte_bpe_50k.json", None)])
def test_words_are_encoded_as_texts_are(name, word_end):
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    library, store, rng = Tokenizer.from_file(path), WordIds(path, word_end), random.Random(1)
    texts = ["".join(rng.choice(ATOMS) + rng.choice(["", " ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += ["", None, "long " * 30_000]
    offsets, data = text_buffers(pa.array(texts))
    want = [e.ids + [0] for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for lo, hi in row_slices(offsets, 1 << 14):
        ids, begin = store.encode(offsets, data, lo, hi, 0)
        for i in range(hi - lo):
            assert ids[begin[i]:begin[i + 1]].tolist() == want[lo + i], texts[lo + i]


def first_fit(counts, capacity):
    """Sequences that best fit by falling length, piece by piece, needs."""
    free, n = np.zeros(capacity + 1, int), 0
    for length in range(capacity, 0, -1):
        for _ in range(int(counts[length])):
            room = next((r for r in range(length, capacity) if free[r]), None)
            n += room is None
            if room is not None:
                free[room] -= 1
            free[(room or capacity) - length] += 1
    return n


@pytest.mark.parametrize("capacity,groups", [(20, 4), (64, 8), (2048, 256)])
def test_plans_are_gapless_and_close_to_best(capacity, groups):
    rng = np.random.default_rng(capacity)
    for n in (0, 1, 7, 400, 3000):
        counts = np.bincount(np.minimum(rng.lognormal(np.log(capacity / 4), 0.8, n).astype(int) + 1, capacity), minlength=capacity + 1)
        made = bestfit.plan(counts, capacity, groups)
        seen, held = np.zeros(capacity + 1, int), {}
        for length, rank, count, first, offset in zip(made.length, made.rank, made.count, made.first, made.offset, strict=True):
            assert rank == seen[length]
            seen[length] += count
            for s in range(first, first + count):
                held.setdefault(int(s), []).append((int(offset), int(length)))
        assert (seen == counts).all() and sorted(held) == list(range(made.sequences))
        for inside in held.values():
            at = 0
            for offset, length in sorted(inside):
                assert offset == at
                at += length
            assert at <= capacity
        assert made.sequences <= first_fit(counts, capacity) * (1.15 if capacity < 100 else 1.01) + 1


def test_configurations_use_no_more_than_there_is():
    sizes, demand = np.array([900, 800, 700, 690]), np.array([100, 100, 100, 100])
    used = np.zeros(4)
    for column, times in bestfit.configurations(sizes, demand, 2048):
        assert column @ sizes <= 2048
        used += column * times
    assert (used <= demand).all() and used.sum() >= 390


def test_packing_whole_documents(spark):
    from tokenizers import Tokenizer
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(4)
    rows = [(i, " ".join(rng.choice(ATOMS) for _ in range(rng.choice([0, 1, 3, 20, 60]))), None) for i in range(150)]
    rows += [(200, None, None), (201, "", None), (None, "no id", None), (203, "word " * 700, None)]
    rows += [rows[5], rows[5]]
    cut = bestfit.pieces(docs_frame(spark, rows).repartition(3), path, 64)
    placed = bestfit.packed(cut, 64, 8)
    library, want = Tokenizer.from_file(path), []
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        want += [(i, p, at, len(x := ids[at:at + 64]), zlib.crc32(array.array("I", x).tobytes())) for p, at in enumerate(range(0, len(ids), 64))]
    out = placed.collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out], key=repr) == sorted(want, key=repr)
    whole = {r.sequence_id: r for r in bestfit.sequences(placed).collect()}
    for r in out:
        assert bytes(whole[r.sequence_id].ids)[2 * r.offset:2 * (r.offset + r.length)] == bytes(r.ids)
    assert sum(len(w.ids) for w in whole.values()) == 2 * sum(r.length for r in out)
    assert len(whole) <= math.ceil(sum(r.length for r in out) / 64) * 1.1
    assert bestfit.packed(bestfit.pieces(docs_frame(spark, []), path)).collect() == []


def conversations(seed=2):
    rng, rows = random.Random(seed), []
    texts = ["hi", "hi there", "", None, "  x\ty\x0b", "é é"]
    for c in range(120):
        for t in range(rng.choice([0, 1, 2, 3, 6, 9])):
            rows.append((c, t, rng.choice(["user", "user", None]), rng.choice(texts[:2 + c % 5])))
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(4)]                    # copies
    rows += [(c, t, "user", f"deep {t if t < c else c}") for c in (300, 301, 420) for t in range(c - 250)]   # long ones
    rows += [(500, None, "user", "late"), (500, None, "user", "early"), (500, 3, "b", "t"), (500, 3, "a", "u"), (None, 1, "user", "lost")]
    return rows + rows[:30]


def test_trie_against_sql(spark):
    rows = conversations()
    got = trie.prefix_trie(*queries.rebuilt(trie.numbered(talks_frame(spark, rows).repartition(4)))).collect()
    want = by_sql("op13_conversation_trie", "conversations", rows, ["conv_id", "turn", "role", "text"])
    assert sorted(map(tuple, got), key=repr) == want and len(want) > 300


def test_trie_of_little(spark):
    assert trie.prefix_trie(*queries.rebuilt(trie.numbered(talks_frame(spark, [])))).collect() == []
    one = trie.numbered(talks_frame(spark, [(7, 1, "user", "a b")]))
    ids = spark.createDataFrame([(7,), (9,)], "conv_id long")                                    # 9 has no turns
    got = {r.depth: r for r in trie.prefix_trie(one, ids).collect()}
    assert (got[0].conv_id, got[0].n_convs, got[0].n_children, got[0].n_leaves) == (7, 2, 1, 1) and got[1].parent_conv_id == 7
    bare = trie.prefix_trie(one.where("false"), ids).collect()
    assert [(r.depth, r.n_convs, r.n_leaves, r.saved_tokens) for r in bare] == [(0, 2, 1, 0)]


def test_end_digests_in_pieces(spark, monkeypatch):
    import hashlib
    ends = spark.range(30_000).select(F.col("id").alias("conv_id"), (F.col("id") % 3 * 0).alias("n1"), (F.col("id") % 100 == 0).cast("long").alias("n2"))
    got = {r.n2: r.ends_sha256 for r in trie.end_digests(ends.repartition(4)).collect()}
    for n2 in (0, 1):
        ids = ",".join(str(i) for i in range(30_000) if (i % 100 == 0) == n2)
        assert got[n2] == hashlib.sha256(ids.encode()).hexdigest()
