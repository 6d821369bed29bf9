"""Operators on texts against brute force, with the defined corner cases."""

import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import decontam, exchange, jaccard, langid, packing, pseudo, quality, substring
from fieldbook.llm.frames import components
from fieldbook.llm.words import LOWER_ASCII, SPACE_WORDS, WordSlice, text_buffers

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, chunk string, tok int, lang string"       # some names clash with inner columns


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], SCHEMA)


def corpus(seed=5, n=60):
    """Words of a small vocabulary with copies, near copies, shared passages,
    NULL, empty and long texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["É", "Zürich", "a.b", "THE"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 30, 120]))) for _ in range(n)]
    base = [rng.choice(words) for _ in range(150)]
    for _ in range(12):
        near = list(base)
        for _ in range(rng.randint(0, 5)):
            near[rng.randrange(len(near))] = rng.choice(words)
        texts.append(" ".join(near))
    passage = " ".join(rng.choice(words) for _ in range(70))
    texts += [f"{t}\n{passage}\t{rng.choice(words)}" for t in texts[:15]]
    texts += [None, "", "  \n", texts[0], texts[0].upper() if texts[0] else "", "one one one one one one", "x " * 5000]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [*rows, rows[0]]                     # a repeated row


def test_words_follow_their_pattern():
    texts = ["", "a  b\tc\x0bd", None, "É x\u00a0y \x1f", "   ", "end"]
    offsets, data = text_buffers(pa.array(texts))
    w = WordSlice(offsets, data, 0, len(texts), SPACE_WORDS, LOWER_ASCII)
    got = [[w.word(i) for i in range(w.first[r], w.first[r + 1])] for r in range(len(texts))]
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for t in texts]
    assert w.hashes[w.first[1]] != w.hashes[w.first[1] + 1]


def test_packed_hashes_round_trip():
    rng = np.random.default_rng(1)
    for bits in (3, 40, 63):
        v = np.unique(rng.integers(0, 2**bits, 500, dtype=np.uint64))
        assert (exchange.unpack(exchange.pack(v)) == v).all()
        cut = exchange.Layout(1, 7, bits).cut(v)
        assert np.concatenate([v[r] for _, r in cut]).tolist() == v.tolist()
    assert len(exchange.unpack(exchange.pack(v[:0]))) == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (3, 1), (5, 5), (None, 4)] + [(k, k + 1) for k in range(20, 60)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {k: 20 for k in range(20, 61)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((str(i), len(s), str(least.get(find(k)))) for k, (i, s) in enumerate(sets))


def test_jaccard_components(spark):
    rows = corpus()
    rows += [(None, rows[3][1]), (None, "only here " * 9)]
    out = jaccard.near_duplicate_components(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == brute_components(rows)
    assert jaccard.near_duplicate_components(frame(spark, [])).count() == 0


def test_jaccard_at_the_threshold(spark):
    """80 of 100 shingles link, 79 do not."""
    words = [f"v{k}" for k in range(400)]
    rows = [(0, " ".join(words[:94])), (1, " ".join(words[:84] + words[200:210])), (2, " ".join(words[10:104]))]
    out = jaccard.near_duplicate_components(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == brute_components(rows)


def test_substring_dedup(spark):
    rows = corpus(8)
    by_id = {}
    for i, t in rows:
        by_id[i] = (t or "").encode().split()
    owner = {}
    for i in sorted(by_id):
        for k in range(len(by_id[i]) - 49):
            owner.setdefault(tuple(by_id[i][k:k + 50]), i)
    out = substring.remove_repeats(frame(spark, rows)).collect()
    assert len(out) == len(rows) and sum(r.n_removed for r in out) > 100
    for r in out:
        w = by_id[r.doc_id]
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if owner[tuple(w[k:k + 50])] < r.doc_id:
                gone[k:k + 50] = [True] * 50
        assert (r.n_words, r.n_removed) == (len(w), sum(gone))
        assert r.kept == b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()
        assert sum(e - s for s, e in r.spans) == r.n_removed
    long = " ".join(f"z{k}" for k in range(60))
    nulls = {(r.doc_id, r.n_removed) for r in substring.remove_repeats(frame(spark, [(None, long), (4, long), (None, "a")])).collect()}
    assert nulls == {(None, 60), (4, 0), (None, 0)}
    assert substring.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("bound", [100_000, 30])
def test_decontamination(spark, monkeypatch, bound):
    """The same with one automaton and with several."""
    monkeypatch.setattr(decontam, "AUTOMATON_WORDS", bound)
    monkeypatch.setattr(decontam, "PIECE_WORDS", 20)
    rows = corpus(3)
    rng = random.Random(2)
    items = [(k, " ".join((rng.choice([t for _, t in rows if t]) or "").split()[:n])) for k, n in enumerate([13, 14, 40, 3, 1, 60, 13])]
    items += [(11, items[0][1]), (2, items[2][1]), (12, None), (13, " .,; "), (None, items[5][1])]
    pattern = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall((t or "").encode().lower())
    known = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            known.setdefault(tuple(w[k:k + 13]), set()).add(i)
    out = decontam.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    texts = dict(rows)
    for r in out:
        w, hit, found = words(texts[r.doc_id]), set(), set()
        for g, ids in known.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found |= ids
        assert (r.n_words, r.n_hit, r.items) == (len(w), len(hit), sorted(str(i) for i in found if i is not None))
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert len(out) == len(rows) and sum(r.n_hit for r in out) > 20
    none = decontam.contamination(frame(spark, rows), spark.createDataFrame([], "item_id long, text string"))
    assert none.where("n_hit > 0").count() == 0


def test_token_files(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = tokenizers.Tokenizer.from_file(path)
    rows = [*[(i, t) for i, t in corpus(4) if i != 0], (None, "null id"), (900, "  a  b\n\nc <|endoftext|> it's 'll. x"), (901, "日本 語\u00a0 é")]
    folder = str(tmp_path / "tokens")
    packing.write_tokens(frame(spark, rows), folder, path, block_ids=300)
    out = packing.read_tokens(spark, folder).collect()
    at = 0
    assert len(out) == len(rows)
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert (i, at, zlib.crc32(ids)) in {(r.doc_id, r.start, zlib.crc32(r.ids)) for r in out if r.start == at}
        at += len(ids) // 4
    some = packing.read_tokens(spark, folder, (900, 901)).collect()
    assert sorted(r.doc_id for r in some) == [900, 901]
    packing.write_tokens(frame(spark, []), str(tmp_path / "none"), path)
    assert packing.read_tokens(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 24, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 137).astype("<u4")
    payload = packing.pack_ids(ids, bits)
    assert len(payload) == -(-137 * bits // 8)
    for a, b in ((0, 137), (5, 5), (3, 90), (136, 137)):
        assert (packing.unpack_ids(payload, bits, a, b) == ids[a:b]).all()


def test_language_id(spark):
    rng = random.Random(1)
    parts = {"aa": ["the", "ing", "tion", "wh"], "bb": ["sch", "ung", "keit", "der"], "cc": ["eau", "que", "les", "é"]}
    rows = [(k, " ".join("".join(rng.choices(parts[g], k=2)) for _ in range(30)), g) for k, g in enumerate(list(parts) * 40)]
    odd = [(500, None, "aa"), (501, "12 345 !", "bb"), (502, "", None), (503, "— ☃", "aa"), (504, "ing" * 9000, None), (None, "der ung", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn(
        "out", langid.held_out(F.col("doc_id")))
    model = langid.fit(docs.where("not out"))
    got = {r.doc_id: r.language for r in langid.predicted(docs, model).collect()}
    assert {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2} == {r.doc_id for r in docs.where("out").collect() if r.doc_id < 500}
    assert all(got[k].lang == g and 0 < got[k].score <= 1 for k, _, g in rows)
    assert [tuple(got[k]) for k in (500, 501, 502, 503)] == [("und", 0.0)] * 4
    assert got[504].lang == "aa" and got[None].lang == "bb"
    empty = langid.fit(docs.where("false"))
    assert {r.language.lang for r in langid.predicted(docs, empty).collect()} == {"und"}


def test_quality(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdef", k=4))
    good = [" ".join(word() for _ in range(40)) + "." for _ in range(120)]
    bad = [" ".join(word() + "$$$" for _ in range(40)) for _ in range(120)]
    rows = [(k, t) for k, t in enumerate([*good, *bad])] + [(900, None), (901, ""), (902, "x" * 70_000)]
    labels = [(k, int(k < 120)) for k in range(240) if k % 5] + [(1, 1), (2, None), (None, 0)]
    docs, known = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    trees = quality.fit(docs, known)
    score = {r.doc_id: r.score for r in quality.scored(docs, trees).collect()}
    assert len(score) == len(rows) and all(0 <= s <= 1 for s in score.values())
    assert all((score[k] >= quality.THRESHOLD) == (k < 120) for k in range(0, 240, 5))       # rows without a label
    none = quality.fit(docs, known.where("false"))
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}


def test_trees_walk_as_a_plain_loop():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)).astype(np.float32)
    trees = quality.grow(x, (x[:, 0] * x[:, 2] > 0).astype(float))
    for row, score in list(zip(x, trees.scores(x), strict=True))[:20]:
        total = trees.start
        for feature, edge, leaf in zip(trees.feature, trees.edge, trees.leaf, strict=True):
            node = 0
            for _ in range(quality.DEPTH):
                node = 2 * node + 1 + int(row[feature[node]] > edge[node])
            total += leaf[node - (2**quality.DEPTH - 1)]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9
    assert ((trees.scores(x) > 0.5) == (x[:, 0] * x[:, 2] > 0)).mean() > 0.9


def test_pseudo_likelihood(spark):
    rng = random.Random(4)
    lines = [" ".join(f"{s}{k}" for k in range(12)) for s in "pqrs"]
    rows = [(k, " ".join(rng.choice(lines) for _ in range(40))) for k in range(60)] + [(90, None), (91, "..."), (92, "p0")]
    docs = frame(spark, rows)
    coder, net = pseudo.fit(docs)
    out = {r.doc_id: r.pseudo for r in pseudo.scored(docs, coder, net).collect()}
    assert [tuple(out[k]) for k in (90, 91)] == [(0, 0.0)] * 2 and out[92].n_words == 1
    text = rows[0][1]
    mixed = " ".join(rng.sample(text.split(), len(text.split())))
    pair = pseudo.log_likelihoods(coder, net, pa.array([text, mixed])).to_pylist()
    assert pair[0]["total"] > pair[1]["total"] + 100 and abs(pair[0]["total"] - out[0].total) < 1e-3 * abs(out[0].total)
    # one word after the other, both sides, full softmax
    ids = coder.classes(next(pseudo._slices(pa.array([text]))).hashes).tolist()
    total = 0.0
    for k, c in enumerate(ids[:50] and ids):
        around = [ids[k + s] if 0 <= k + s < len(ids) else pseudo.EDGE for s in (-2, -1, 1, 2)]
        h = np.tanh(net.bias + sum(net.tables[j][a] for j, a in enumerate(around)))
        z = (h @ net.out + net.base).astype(np.float64)
        total += z[c] - np.log(np.exp(z - z.max()).sum()) - z.max()
    assert abs(total - pair[0]["total"]) < 1e-3 * abs(total)
    coder, net = pseudo.fit(frame(spark, []))
    assert pseudo.scored(frame(spark, [(1, "a b")]), coder, net).first().pseudo.n_words == 2


def test_pseudo_likelihood_sums_each_words_own_probability(spark):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(900)]
    rows = [(k % 40 or None, " ".join(rng.choice(words) for _ in range(60))) for k in range(80)]
    rows += [(900 + k, f"r{k} r{k}" + " r0" * 5 * (k == 1)) for k in range(600)]
    docs = frame(spark, rows)
    coder, net = pseudo.fit(docs)
    counts = {}
    for _, t in rows:
        for w in t.split():
            counts[w] = counts.get(w, 0) + 1
    hashes = dict(zip(counts, next(pseudo._slices(pa.array([" ".join(counts)]))).hashes.tolist(), strict=True))
    classes = dict(zip(counts, coder.classes(np.array(list(hashes.values()), np.uint64)).tolist(), strict=True))
    rare = [w for w in counts if classes[w] >= pseudo.WORDS]
    assert len(rare) == len(counts) - pseudo.WORDS and max(counts[w] for w in rare) <= min(counts[w] for w in counts if w not in set(rare))
    in_class = {}
    for w in rare:
        in_class[classes[w]] = in_class.get(classes[w], 0) + counts[w]
    own = {w: np.log(counts[w] / (in_class[classes[w]] + pseudo.UNSEEN)) for w in rare}
    # the class part alone: every rare word is then as likely as its class
    whole = pseudo.Coder(coder.words, np.zeros(pseudo.BUCKETS), coder.layout)
    whole.order = coder.order
    flat = {t: r["total"] for t, r in zip([r[1] for r in rows], pseudo.log_likelihoods(whole, net, pa.array([r[1] for r in rows])).to_pylist(), strict=True)}
    got = pseudo.scored(docs, coder, net).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got) == sorted((i is None, i or 0, t) for i, t in rows)
    for r in got:
        assert abs(r.pseudo.total - (flat[r.text] + sum(own.get(w, 0.0) for w in r.text.split()))) < 1e-3 * abs(r.pseudo.total)
    # a word the corpus does not have is less likely than any word of its class
    unseen = next(f"z{k}" for k in range(10**6) if coder.classes(next(pseudo._slices(pa.array([f"z{k}"]))).hashes)[0] == classes[rare[0]])
    pair = {r.text: r.pseudo.total for r in pseudo.scored(frame(spark, [(1, rare[0]), (2, unseen)]), coder, net).collect()}
    assert pair[rare[0]] > pair[unseen] + 0.5


def test_pseudo_likelihood_trains_on_every_position(spark):
    texts = [f"same words here d{k}" for k in range(200)] + ["one", "a b", "", None]
    w = next(pseudo._slices(pa.array(texts)))
    turns = pseudo.turns(w)
    assert ((turns >= 0) & (turns < pseudo.PASSES)).all()
    assert {len({int(turns[w.first[k] + at]) for k in range(200)}) for at in range(3)} == {pseudo.PASSES}   # not the same in all texts
    context = spark.sparkContext
    known, shared = context.broadcast(pseudo.vocabulary(frame(spark, list(enumerate(texts))))), context.broadcast(pseudo.Network().flat)
    one = frame(spark, list(enumerate(texts))).select("text").coalesce(1)
    seen = [r.n for turn in range(pseudo.PASSES) for r in
            one.mapInArrow(pseudo._train(shared, known, turn), "part long, n long, weights binary").collect()]
    assert sum(seen) == len(w.hashes)


@pytest.mark.parametrize("size", [0.1, 9.0])
def test_pseudo_likelihood_steps_in_strips_equal_the_plain_gradient(size):
    """The same step as with whole matrices, without holding one of a batch."""
    rng = np.random.default_rng(8)
    n = pseudo.BATCH - 3
    context, target = rng.integers(0, pseudo.EDGE + 1, (n, 4)), rng.integers(0, 40, n)
    net = pseudo.Network((rng.standard_normal(len(pseudo.Network().flat)) * size).astype(np.float32))
    past = np.zeros_like(net.flat)
    tables, bias, out, base = (x.astype(np.float64) for x in (net.tables, net.bias, net.out, net.base))
    h = np.tanh(bias + sum(tables[k][context[:, k]] for k in range(4)))
    z = h @ out + base
    z -= z.max(axis=1, keepdims=True)
    logs = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    own = logs[np.arange(n), target]
    assert np.allclose(net.log_probabilities(context, target), own, rtol=1e-3, atol=1e-3)
    p = np.exp(logs)
    p[np.arange(n), target] -= 1
    p /= n
    back = (p @ out.T) * (1 - h**2)
    grad = pseudo.Network(np.zeros_like(net.flat))
    for k in range(4):
        np.add.at(grad.tables[k], context[:, k], back)
    grad.bias[:], grad.out[:], grad.base[:] = back.sum(axis=0), h.T @ p, p.sum(axis=0)
    before = net.flat.copy()
    tracemalloc.start()
    net.train(context, target, past)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert net.small == (size < 1) and held < 4 * n * pseudo.CLASSES       # less than the scores of the batch, 4 bytes each
    assert np.allclose(np.sqrt(past), np.abs(grad.flat), rtol=1e-2, atol=1e-5 * np.abs(grad.flat).max())
    large = np.abs(grad.flat) > 1e-3 * np.abs(grad.flat).max()
    assert (np.sign(before - net.flat)[large] == np.sign(grad.flat)[large]).all()


def test_pseudo_likelihood_contexts_end_with_their_text():
    classes, first = np.array([5, 6, 7, 8, 9]), np.array([0, 0, 3, 4, 4, 5])
    e = pseudo.EDGE
    expected = [[e, e, 6, 7], [e, 5, 7, e], [5, 6, e, e], [e] * 4, [e] * 4]
    assert pseudo.contexts(classes, first).tolist() == expected
    assert pseudo.contexts(classes, first, classes % 2 == 0).tolist() == [expected[1], expected[3]]


def test_pseudo_likelihood_splits_texts_once_a_chunk_and_in_small_slices(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(300))) for _ in range(400)] + [None, ""]
    made = []
    monkeypatch.setattr(pseudo, "WordSlice", lambda *args: made.append(WordSlice(*args)) or made[-1])
    found = np.concatenate([w.hashes for w in pseudo._slices(pa.array(texts))])
    words, counts = np.unique(found, return_counts=True)
    coder = pseudo.Coder(words[np.argsort(-counts)[:pseudo.WORDS]], np.full(pseudo.BUCKETS, 50), None)
    made.clear()
    coded = pseudo._coded(coder, pa.array(texts))
    rare = pseudo._rare(coded)
    assert rare.tolist() == sorted(set(found.tolist()) - set(coder.words.tolist()))
    net, counts = pseudo.Network(), counts[np.isin(words, rare)]
    got = pseudo._log_likelihoods(coder, net, coded, rare, counts).to_pylist()
    assert sum(len(w.hashes) for w in made) == len(found) and max(len(w.data) for w in made) <= 1 << 17
    for text, r in zip(texts, got, strict=True):
        alone = pseudo.log_likelihoods(coder, net, pa.array([text], pa.string()), rare, counts).to_pylist()[0]
        assert r["n_words"] == len((text or "").split()) and abs(r["total"] - alone["total"]) <= 1e-6 * abs(r["total"])


@pytest.mark.parametrize("top", [2**64 - 1, 2**20])
def test_pseudo_likelihood_finds_hashes_as_a_plain_search_does(top):
    rng = np.random.default_rng(6)
    for n in (0, 1, 3, 448, 20_000):
        keys = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        wanted = np.concatenate([keys, keys + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        at, known = pseudo.Places(keys).find(wanted)
        assert (known == np.isin(wanted, keys)).all() and (keys[at[known]] == wanted[known]).all()
        assert (pseudo._distinct(wanted) == np.unique(wanted)).all()
