"""URL filter: rules first, then a character language-model ratio.

URLs that a rule accepts or rejects train two variable-order Markov models of
their characters (orders 0 to ``ORDER``, every order smoothed by the next
lower one with the Witten-Bell weight, the lowest by a uniform alphabet).  A
URL without a rule is judged by the difference of its two log-likelihoods per
character, against the threshold that separates the two labelled classes best
(greatest sum of both hit rates over all labelled rows).

Native: DataFrame functions only.  The models are tables of distinct
characters runs, so their size follows the alphabet and not the row count;
URLs meet them in one equi-join.  Log ratios are kept as whole millionths, so
sums do not depend on their order.

Rules see host and path; the models see the whole URL with its query and
fragment, the host in lower case, and the scheme unless it is ``http``.

Defined cases: NULL and URLs without ``://`` have an empty host and path and
fit no rule; the models judge such a URL by all its characters, and NULL as the
empty string; with no accepted or no rejected rows there is no model, the score is NULL and the verdict
``allow``; repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.frames import columns
from fieldbook.session import materialize

ORDER = 4
ALPHABET = 256                  # the lowest order spreads its rest over so many characters
BINS_PER_NAT = 100              # steps in which the threshold is sought
START, END = "\x02", "\x03"

# (verdict, rule): fixed values
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def shown(url: Column) -> Column:
    """What the models see of a URL: all of it, with nothing for ``http://``."""
    at, (host, _) = F.instr(url, "://"), host_and_path(url)
    scheme = F.when(url.startswith("http://"), "").otherwise(F.substr(url, F.lit(1), at + 2))
    after = F.substr(url, at + 3 + F.length(host))
    return F.coalesce(F.when(at > 0, F.concat(scheme, host, after)).otherwise(url), F.lit(""))


def fitting_rule(host: Column, path: Column, rules) -> Column:
    """(size, rule, verdict) of the longest rule that fits; NULL if none does."""
    found = [F.when(((host == r[:r.index("/")]) | host.endswith("." + r[:r.index("/")])) & path.startswith(r[r.index("/"):]),
                    F.struct(F.lit(len(r)).alias("size"), F.lit(r).alias("rule"), F.lit(v).alias("verdict")))
             for v, r in rules]
    return F.array_max(F.array(*found))


def _grams(text: Column) -> Column:
    """Every character (and the end) with the ``ORDER`` characters before it."""
    padded = F.concat(F.lit(START * ORDER), text, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substr(padded, i, F.lit(ORDER + 1)))


def _ratios(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, ratio): log of the accepted over the rejected probability of the
    last character after the others, in millionths."""
    cut = lambda g, k: F.substr(g, F.lit(ORDER + 1 - k), F.lit(k + 1))
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), cut(F.col("gram"), k).alias("run")) for k in range(ORDER + 1)]))
    context = F.expr("substr(run, 1, length(run) - 1)")
    seen = (counts.select(levels.alias("level"), "yes", "no").select("level.run", "yes", "no")
            .groupBy("run").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")))
    after = (seen.withColumn("context", context).groupBy("context")
             .agg(F.sum("yes").alias("yes_all"), F.sum("no").alias("no_all"),
                  F.count(F.when(F.col("yes") > 0, 1)).alias("yes_kinds"), F.count(F.when(F.col("no") > 0, 1)).alias("no_kinds")))
    parts = (grams.select("gram", levels.alias("level")).select("gram", "level.k", "level.run").withColumn("context", context)
             .join(seen, "run", "left").join(after, "context", "left").na.fill(0)
             .groupBy("gram").agg(F.array_sort(F.collect_list(F.struct(
                 "k", "yes", "no", "yes_all", "no_all", "yes_kinds", "no_kinds"))).alias("levels")))

    def up(below, level, side):
        n, kinds = level[f"{side}_all"], level[f"{side}_kinds"]
        return F.when(n > 0, (level[side] + kinds * below[side]) / (n + kinds)).otherwise(below[side])

    lowest = F.struct(F.lit(1.0 / ALPHABET).alias("yes"), F.lit(1.0 / ALPHABET).alias("no"))
    p = F.aggregate("levels", lowest, lambda b, x: F.struct(up(b, x, "yes").alias("yes"), up(b, x, "no").alias("no")))
    return parts.select("gram", p.alias("p")).select(
        "gram", F.round((F.ln("p.yes") - F.ln("p.no")) * 1e6).cast("long").alias("ratio"))


def judged(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``
    and ``score`` (log-likelihood difference per character)."""
    pages = columns(pages, [key, url]).toDF("page_id", "url")
    host, path = host_and_path(F.col("url"))
    pages = (pages.select("page_id", shown(F.col("url")).alias("shown"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
             .withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
             .select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"),
                     "shown"))
    pages = materialize(pages, "urls")
    texts = pages.groupBy("shown").agg(F.count(F.when(F.col("ruled") == "allow", 1)).alias("yes"),
                                       F.count(F.when(F.col("ruled") == "block", 1)).alias("no"))
    runs = texts.select("shown", "yes", "no", F.explode(_grams(F.col("shown"))).alias("gram"))
    counts = materialize(runs.groupBy("gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "url-grams")
    labelled = counts.where((F.col("yes") > 0) | (F.col("no") > 0))
    n_yes, n_no = pages.agg(F.count(F.when(F.col("ruled") == "allow", 1)), F.count(F.when(F.col("ruled") == "block", 1))).first()
    if not n_yes or not n_no:
        return pages.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"),
                            F.lit(None).cast("double").alias("score"))
    scored = (runs.join(_ratios(counts.select("gram"), labelled), "gram")
              .groupBy("shown", "yes", "no").agg(F.sum("ratio").alias("total"))
              .withColumn("score", F.col("total") / 1e6 / (F.length("shown") + 1)))
    scored = materialize(scored, "url-scores")
    least = _threshold(scored)
    verdict = F.coalesce("ruled", F.when(F.floor(F.col("score") * BINS_PER_NAT) >= least, "allow").otherwise("block"))
    return pages.join(scored.select("shown", "score"), "shown").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def _threshold(scored: DataFrame) -> int:
    """The step from which on URLs are allowed, in the middle between the
    labelled steps on its two sides.  There are a few thousand steps, whatever
    the input, since log ratios per character are bounded."""
    bins = (scored.where("yes + no > 0").groupBy(F.floor(F.col("score") * BINS_PER_NAT).alias("step"))
            .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).orderBy("step").collect())
    all_yes, all_no = sum(b.yes for b in bins), sum(b.no for b in bins)
    best, least, below_yes, below_no, before = -1, bins[0].step, 0, 0, bins[0].step - 1
    for b in bins:
        gain = (all_yes - below_yes) * all_no + below_no * all_yes
        if gain > best:
            best, least = gain, (before + 1 + b.step) // 2
        below_yes, below_no, before = below_yes + b.yes, below_no + b.no, b.step
    return least
