"""Top-k search, URL filter, mixing, the pipeline and the registered queries."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldbook.llm import mixing, queries, topk, urls

SMALL = "/root/testdata/sf0.001"


def brute_top(rows, k=5):
    import math
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(256 * x) for x in v]
            fine[i] = min(fine.get(i, q), q)
    out = []
    for q, v in fine.items():
        if q % 50 == 0:
            all_scores = sorted((-min(max(sum(a * b for a, b in zip(v, w, strict=True)), -2**63), 2**63 - 1), j)
                                for j, w in fine.items() if j != q and len(w) == len(v))
            out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(all_scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_top_k(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "ROW_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "STRIP", 2)
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1, 0, 0.5, rng.gauss(0, 1)]) * scale for _ in range(7)]) for i in range(300)]
    rows += [(i, rows[4][1]) for i in range(400, 412)] + [rows[50], (None, [1.0] * 7), (700, None), (701, [None] * 7),
             (702, [float("nan")] * 7), (703, [float("inf")] * 7), (750, [1.0, 2.0]), (760, []), (800, []), (850, [3.0])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, dim int")
    assert sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 50 == 0).collect())) == brute_top(rows)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_url_rules(spark):
    rows = ["http://A.Example.NET/en/1?x#y", "https://example.net/de/", "x.net/", None, "", "http://net/", "http://net", "ftp://notnet/",
            "http://www.example.com/de/a", "http://example.com/DE/", "//q://b.org/fr/", "http://org/fr/x", "http://a.net?://z/", "http://É.NET/"]
    want = [("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/de/", "net/", "block"), ("", "", None, None),
            ("", "", None, None), ("", "", None, None), ("net", "/", "net/", "block"), ("net", "", None, None), ("notnet", "/", None, None),
            ("www.example.com", "/de/a", "example.com/de/", "block"), ("example.com", "/DE/", None, None), ("b.org", "/fr/", "org/fr/", "allow"),
            ("org", "/fr/x", "org/fr/", "allow"), ("a.net", "", None, None), ("É.net", "/", "net/", "block")]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(rows)], "page_id long, url string, host string")
    out = {r.page_id: r for r in urls.judged(pages).collect()}
    assert len(out) == len(rows)
    for k, (host, path, rule, verdict) in enumerate(want):
        r = out[k]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    one_class = urls.judged(pages.where("page_id in (0, 2)")).collect()
    assert [r.verdict for r in one_class] == ["allow", "allow"] and urls.judged(pages.limit(0)).count() == 0


def test_url_model_is_witten_bell(spark):
    """Scores against a direct computation."""
    import math
    rows = [(k, f"http://{'good' if k % 2 else 'spam'}{k % 7}.{'org/fr' if k % 2 else 'net'}/{k}") for k in range(40)] + [(90, "http://spam9.com/8")]
    out = {r.page_id: r for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    texts = {"allow": Counter(), "block": Counter()}
    for r in out.values():
        if r.rule:
            texts[r.verdict][r.host + r.path] += 1
    seen = {c: Counter() for c in texts}
    for c, t in texts.items():
        for s, n in t.items():
            p = urls.START * 4 + s + urls.END
            for i in range(4, len(p)):
                for k in range(5):
                    seen[c][p[i - k:i + 1]] += n

    def prob(c, run):
        below = 1 / 256
        for k in range(5):
            g = run[4 - k:]
            after = {x: n for x, n in seen[c].items() if len(x) == k + 1 and x[:-1] == g[:-1]}
            if after:
                below = (seen[c][g] + len(after) * below) / (sum(after.values()) + len(after))
        return below
    r = out[90]
    p = urls.START * 4 + r.host + r.path + urls.END
    total = sum(math.log(prob("allow", p[i - 4:i + 1]) / prob("block", p[i - 4:i + 1])) for i in range(4, len(p)))
    assert abs(r.score - total / (len(p) - 4)) < 1e-5 and r.verdict == "block"


def test_url_models_see_the_whole_url(spark):
    rows = [(k, f"https://h{k % 7}.{'org/fr' if k % 2 else 'net'}/?{'good' if k % 2 else 'spam'}={k % 5}") for k in range(60)]
    odd = ["https://x.com/a?good=1", "https://x.com/a?spam=1", "https://x.com/a#good=1", "x.com/a?good=1", "x.com/a?spam=1", "", None]
    out = {r.page_id: r for r in urls.judged(spark.createDataFrame(rows + [(100 + k, u) for k, u in enumerate(odd)], "page_id long, url string")).collect()}
    assert len(out) == len(rows) + len(odd) and not any(out[100 + k].rule for k in range(len(odd)))
    assert out[100].verdict == "allow" and out[101].verdict == "block"              # they differ in the query only
    assert out[103].score > out[104].score and (out[103].host, out[103].path) == ("", "")
    assert out[100].score != out[102].score and out[105].score == out[106].score != out[104].score
    cases = ["http://A.b/C?D#e", "HTTPS://A.b?x://y", "a/B?c", "x://", None]
    seen = spark.createDataFrame([(u,) for u in cases], "url string").select("url", urls.shown(F.col("url")).alias("s")).collect()
    assert {r.url: r.s for r in seen} == dict(zip(cases, ["a.b/C?D#e", "HTTPS://a.b?x://y", "a/B?c", "x://", ""], strict=True))


def test_mixing_meets_its_targets(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices("abcdefgh", k=rng.randint(1, 40))), rng.choice(["s0"] * 6 + ["s1", "s2", None]),
             rng.choice(["en", "de", None]), k) for k in range(1500)] + [(None, None, None, None, 0), (5, "", "s1", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, tokens long")
    out = mixing.mixed(docs).collect()
    assert len(out) == len(rows) and all(0 <= r.probability <= 1 for r in out)
    expected = sum(r.tokens * r.probability for r in out)
    for d in mixing.DIMENSIONS:
        have, got = Counter(), Counter()
        for r in out:
            have[r[d]] += r.tokens
            got[r[d]] += r.tokens * r.probability
        part = {v: n**mixing.TEMPER for v, n in have.items()}
        for v in have:
            assert abs(got[v] / expected - part[v] / sum(part.values())) < 0.02
    assert abs(expected / sum(r.tokens for r in out) - mixing.KEEP) < 0.02
    kept = mixing.sampled(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in out if r.kept)
    given = {"lang": spark.createDataFrame([("en", 3.0), ("de", 1.0), (None, 1.0)], "lang string, share double")}
    got = Counter()
    for r in mixing.mixed(docs, given, keep=0.3).collect():
        got[r.lang] += r.tokens * r.probability
    assert abs(got["en"] / sum(got.values()) - 0.6) < 0.02
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.sampled(docs.limit(0)).count() == 0


def brute_rake(cells, targets, keep, rounds=200):
    """Weights by cell (source, lang, topic, tokens), raked in plain Python."""
    wanted = keep * sum(c[3] for c in cells)
    weights = [c[3] * keep for c in cells]
    for _ in range(rounds):
        for d in range(3):
            now = Counter()
            for c, w in zip(cells, weights, strict=True):
                now[c[d]] += w
            weights = [min(c[3], w * targets[d][c[d]] * wanted / now[c[d]]) if now[c[d]] else w
                       for c, w in zip(cells, weights, strict=True)]
    return weights


def test_mixing_against_brute_force_and_hard_targets(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("abc"), rng.choice(["en", "de", None]), " ".join(rng.choices("uvwxyz", k=rng.randint(1, 30)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    topics = {r.topic for r in mixing.measured(docs).select("topic").distinct().collect()}
    shares = lambda d: spark.createDataFrame(list(d.items()), "value string, share double")
    given = [{"a": 0.4, "b": 0.3, "c": 0.3}, {"en": 0.35, "de": 0.35, None: 0.3}, dict.fromkeys(topics, 1 / len(topics))]
    out = mixing.mixed(docs, {"source": shares(given[0]), "lang": shares(given[1])}, keep=0.2).collect()
    tokens = Counter()
    for r in out:
        tokens[r.source, r.lang, r.topic] += r.tokens
    have, total = Counter(), sum(tokens.values())
    for (_, _, t), n in tokens.items():
        have[t] += n / total                                 # no target given: the topics keep their share
    cells = [(*c, n) for c, n in tokens.items()]
    want = dict.fromkeys(topics)
    for t, part in ((t, have[t] ** mixing.TEMPER) for t in topics):
        want[t] = part
    want = {t: p / sum(want.values()) for t, p in want.items()}
    weights = brute_rake(cells, [given[0], given[1], want], 0.2)
    chance = {c[:3]: w / c[3] for c, w in zip(cells, weights, strict=True)}
    assert all(abs(r.probability - chance[r.source, r.lang, r.topic]) < 0.01 for r in out)
    assert all(r.distance < mixing.TOLERANCE for r in out)

    # a target of zero, a repeated value, one beyond its tokens: the rest is made up by the others
    zero = mixing.mixed(docs, {"source": shares({"a": 0.0, "b": 0.5, "c": 0.5})}, keep=0.3).collect()
    assert all(r.probability == 0 for r in zero if r.source == "a") and any(r.probability > 0 for r in zero)
    twice = spark.createDataFrame([("a", 0.2), ("a", 0.2), ("b", 0.3), ("c", 0.3)], "value string, share double")
    assert len(mixing.mixed(docs, {"source": twice}).collect()) == 300
    much = mixing.mixed(docs, {"source": shares({"a": 0.98, "b": 0.01, "c": 0.01})}, keep=0.6).collect()
    assert abs(sum(r.probability * r.tokens for r in much) / total - 0.6) < 0.01
    assert all(r.probability > 0.99 for r in much if r.source == "a")


def test_pipeline_takes_clashing_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumns(
        {c: F.lit("kept") for c in ("_language", "_least", "_Contamination", "_whole", "cell")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert out.where("_language = 'kept' and _least = 'kept' and cell = 'kept'").count() == out.count() > 0


def test_pipeline_stages(spark):
    """Each stage against its rule on its own input, and ``run`` as a whole."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        out = spark.createDataFrame(out.collect(), docs.schema)
        before, after = {r.doc_id for r in docs.collect()}, {r.doc_id for r in out.collect()}
        assert after <= before and len(after) == out.count()
        if name == "ngram_jaccard_join":
            comps = queries.jaccard.near_duplicate_components(docs).collect()
            assert after == {r.component_id for r in comps}
        if name == "benchmark_decontamination":
            found = queries.decontam.contamination(docs, queries.table(spark, SMALL, "benchmark")).collect()
            assert before - after == {r.doc_id for r in found if r.contaminated}
        if name == "language_id":
            assert all(r.text and any(c.isalpha() for c in r.text) and r.lang for r in out.collect())
        docs = out
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, tokens.collect())) == sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SMALL}/{f}'")
    got = queries.QUERIES[name](spark, SMALL)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(want, key=repr)
