"""One registered query per operator, over whole tables, with its SQL where
SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import bestfit, decontam, jaccard, langid, mixing, packing, phrases, pseudo, quality, substring, topk, trie, urls
from fieldbook.llm.frames import columns, table
from fieldbook.session import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicate_components(table(spark, sf_dir, "documents")).drop("class_id")


@query
def op9_substring_dedup(spark, sf_dir):
    out = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_benchmark_decontamination(spark, sf_dir):
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op8_url_filter(spark, sf_dir):
    return urls.judged(table(spark, sf_dir, "pages"))


@query
def op1_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op1_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


def tokens_of(docs, tokenizer="byte_bpe_50k.json"):
    """Write ``docs`` as token files, read them back and digest each document."""
    spark = docs.sparkSession
    folder = scratch_path(spark, f"tokens/{uuid.uuid4().hex}")
    packing.write_tokens(docs, folder, public_tokenizers.path(tokenizer))
    return packing.read_tokens(spark, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query
def op7_token_id_output(spark, sf_dir):
    return tokens_of(table(spark, sf_dir, "documents"))


@query
def op10_mixing_to_targets(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query
def op2_language_id(spark, sf_dir):
    docs = columns(table(spark, sf_dir, "documents"), ["doc_id", "text", "lang"]).withColumn("held_out", langid.held_out(F.col("doc_id")))
    out = langid.predicted(docs, langid.fit(docs.where(~F.col("held_out"))))
    return out.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query
def op3_quality_classifier(spark, sf_dir):
    docs = columns(table(spark, sf_dir, "documents"), ["doc_id", "text"]).withColumn("held_out", quality.held_out(F.col("doc_id")))
    trees = quality.fit(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id"))))
    return quality.scored(docs, trees).select("doc_id", "held_out", "score",
                                              (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query
def op4_pseudo_likelihood(spark, sf_dir):
    docs = columns(table(spark, sf_dir, "documents"), ["doc_id", "text"])
    out = pseudo.scored(docs, *pseudo.fit(docs)).select("doc_id", "pseudo.*")
    return out.select("doc_id", "n_words", F.col("total").alias("log_likelihood"),
                      F.when(F.col("n_words") > 0, F.col("total") / F.col("n_words")).otherwise(0.0).alias("score"))


@query
def op11_phrase_collocations(spark, sf_dir):
    return phrases.top_collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
spans AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
grams AS (SELECT lang, list_slice(ws, i, i + k - 1) AS g FROM spans, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, g, count(*) AS c FROM grams GROUP BY lang, g),
cand AS (SELECT * FROM f WHERE len(g) > 1 AND c >= 100),
cuts AS (SELECT lang, g, c, unnest(range(1, len(g))) AS k FROM cand),
scored AS (
  SELECT cuts.lang, cuts.g, cuts.c AS a, cuts.k, x.c AS l, y.c AS r, t.n,
         (CAST(1000 AS HUGEINT) * cuts.c * t.n) // (CAST(x.c AS HUGEINT) * y.c) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = list_slice(cuts.g, 1, cuts.k)
  JOIN f y ON y.lang = cuts.lang AND y.g = list_slice(cuts.g, cuts.k + 1, len(cuts.g))
  JOIN totals t ON t.lang = cuts.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM scored),
inner_parts AS (
  SELECT c.lang, c.c, list_slice(c.g, i, i + k - 1) AS g
  FROM cand c, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(2, 6)) AS k)
  WHERE k < len(c.g) AND i + k - 1 <= len(c.g)),
absorbed AS (SELECT DISTINCT p.lang, p.g FROM inner_parts p JOIN cand c ON c.lang = p.lang AND c.g = p.g AND 100 * p.c >= 100 * c.c),
ranked AS (
  SELECT s.lang, array_to_string(s.g, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM lowest s LEFT JOIN absorbed b ON b.lang = s.lang AND b.g = s.g WHERE place = 1 AND b.g IS NULL),
final AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT lang, rank, phrase, a, l, r, n, score FROM final WHERE rank <= 2000"""


@query
def op12_best_fit_packing(spark, sf_dir):
    cut = bestfit.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return bestfit.packed(cut.drop("ids")).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
                                                  "ids_crc32", "sequence_id", "offset")


def rebuilt(turns, first=20, most=4):
    """Numbered turns and ids of the rebuilt conversations: c begins with the
    first h turns of conversation ``c - c % first``, h being the CRC-32 of c
    modulo ``most``, and goes on with its own turns after its first h."""
    h = F.crc32(F.col("conv_id").cast("string")) % most
    turns = materialize(turns, "numbered")
    heads = turns.where((F.col("conv_id") % first == 0) & (F.col("depth") < most)).withColumnRenamed("conv_id", "begun")
    known = heads.groupBy("begun").agg(F.count(F.lit(1)).alias("n"))
    convs = turns.select("conv_id").distinct().withColumns({"h": h, "begun": F.col("conv_id") - F.col("conv_id") % first})
    convs = materialize(convs.join(known, "begun", "left").withColumn("lead", F.least("h", F.coalesce("n", F.lit(0)))).drop("n"), "rebuilt")
    own = turns.where(F.col("depth") > h).join(convs, "conv_id").withColumn("depth", F.col("depth") - F.col("h") + F.col("lead"))
    begin = convs.join(heads, "begun").where("depth <= lead")
    return own.select(*turns.columns).unionByName(begin.select(*turns.columns)), convs.select("conv_id")


@query
def op13_conversation_trie(spark, sf_dir):
    return trie.prefix_trie(*rebuilt(trie.numbered(table(spark, sf_dir, "conversations"))))


ORACLES["op13_conversation_trie"] = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS s FROM t GROUP BY conv_id),
crc AS (
  SELECT conv_id, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], list_transform(range(8), lambda i: CAST(i AS BIGINT))),
        lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))), 4294967295) % 4 AS h
  FROM own),
built AS (
  SELECT o.conv_id, list_concat(list_slice(coalesce(p.s, []), 1, h), list_slice(o.s, h + 1, len(o.s))) AS s
  FROM own o JOIN crc USING (conv_id) LEFT JOIN own p ON p.conv_id = o.conv_id - o.conv_id % 20),
member AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS depth FROM built),
named AS (SELECT conv_id, depth, len(s) = depth AS ends, list_slice(s, 1, depth) AS node, CASE WHEN depth > 0 THEN list_slice(s, 1, depth - 1) END AS parent FROM member),
nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM named GROUP BY node),
fan AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
own_totals AS (
  SELECT n.node, n.depth, n.n_convs, coalesce(f.n_children, 0) AS n_children, CASE WHEN f.node IS NULL THEN 1 ELSE 0 END AS leaf,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.node[n.depth].text, '[^ 	-
]+')) END AS saved
  FROM nodes n LEFT JOIN fan f ON f.node = n.node),
below AS (SELECT node, leaf, saved, unnest(range(depth + 1)) AS d FROM own_totals),
upward AS (SELECT list_slice(node, 1, d) AS node, leaf, saved FROM below),
totals AS (SELECT node, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM upward GROUP BY node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(o.n_children AS BIGINT) AS n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM nodes n JOIN own_totals o ON o.node = n.node JOIN totals t ON t.node = n.node LEFT JOIN nodes p ON p.node = n.parent"""
