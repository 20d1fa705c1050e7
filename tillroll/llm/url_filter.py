"""URL filter: rules first, then the ratio of two character language models.

URLs that a rule decides are the training text: one smoothed variable-order
Markov model of the accepted ones and one of the rejected ones. A character's
probability is interpolated from order 0 up to ``ORDER`` (Witten-Bell: a context
seen N times with T different successors gives the shorter context the weight
T / (N + T)); a context never seen leaves the shorter one's value. A URL's score
is the mean log-likelihood difference per character. A quarter of the decided
URLs is held out of the models; the threshold that separates these best
(highest sum of the two classes' hit rates) decides the rest.

The counts are taken over all decided URLs. Each distinct character window is
resolved once; scoring then looks windows up. Only DataFrame functions run.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.durable import durable
from .sized import broadcast_if_small

ORDER = 4
WIDTH = ORDER + 1
BINS = 200              # threshold steps per unit of score
#: (host, path prefix, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


def _after_scheme(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://``."""
    found = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.when(F.instr(url, "://") > 0, F.translate(
        found, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    rest = _after_scheme(url)
    found = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, found).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]],
            pick: int | None = None) -> Column:
    """The longest rule that fits (its text, or its field ``pick``), else null."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = (((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1]))
        value = F.lit(rule[0] + rule[1] if pick is None else rule[pick])
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("string") if out is None else out


def symbols(url: Column) -> Column:
    """What the models read: the URL after its scheme in lower case, digits as
    0, anything beyond ASCII and the two marks ^ and $ as ~."""
    rest = F.when(F.instr(url, "://") > 0, _after_scheme(url)).otherwise(F.coalesce(url, F.lit("")))
    plain = F.translate(rest, string.ascii_uppercase + string.digits + "^$",
                        string.ascii_lowercase + "0" * 10 + "~~")
    return F.regexp_replace(plain, r"[^\x00-\x7F]", "~")


def windows(text: Column) -> Column:
    """Every character with the ``ORDER`` before it, the end mark included."""
    chars = F.split(F.concat(F.lit("^" * ORDER), text, F.lit("$")), "")
    # The outer transform binds the characters once; named twice, they would be
    # split again for every position.
    return F.flatten(F.transform(F.array(chars), lambda c: F.transform(
        F.sequence(F.lit(1), F.size(c) - ORDER), lambda i: F.array_join(F.slice(c, i, WIDTH), ""))))


def model_counts(training: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (text, accepted): counts by gram of every order (gram, na, nr), and
    by context (context, na, nr, ta, tr; n: occurrences, t: successors)."""
    full = (training.select(F.explode(windows(F.col("text"))).alias("w"), "accepted")
            .groupBy("w").agg(F.count_if("accepted").alias("na"), F.count_if(~F.col("accepted")).alias("nr")))
    grams = (full.select(F.explode(F.array(*[F.substring("w", WIDTH - k, k + 1)
                                             for k in range(WIDTH)])).alias("gram"), "na", "nr")
             .groupBy("gram").agg(F.sum("na").alias("na"), F.sum("nr").alias("nr")))
    grams = durable(grams, "url-grams")
    contexts = (grams.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("context"))
                .agg(F.sum("na").alias("na"), F.sum("nr").alias("nr"),
                     F.count_if(F.col("na") > 0).alias("ta"), F.count_if(F.col("nr") > 0).alias("tr")))
    return grams, contexts


def window_ratios(wanted: DataFrame, grams: DataFrame, contexts: DataFrame, symbol_count: int) -> DataFrame:
    """(w, micro): a millionth of the log-likelihood difference of each window's
    last character, as a whole number so that sums do not depend on order."""
    orders = wanted.select("w", F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("k"))
    keyed = orders.select("w", "k", F.expr(f"substring(w, {WIDTH} - k, k + 1)").alias("gram"),
                          F.expr(f"substring(w, {WIDTH} - k, k)").alias("context"))
    found = (keyed.join(grams.withColumnsRenamed({"na": "ga", "nr": "gr"}), "gram", "left")
             .join(contexts, "context", "left"))
    by_order = found.groupBy("w").agg(F.array_sort(F.collect_list(
        F.struct("k", *[F.coalesce(c, F.lit(0)).cast("double").alias(c)
                        for c in ("ga", "gr", "na", "nr", "ta", "tr")]))).alias("levels"))

    def probability(seen: str, n: str, t: str) -> Column:
        return F.aggregate("levels", F.lit(1.0 / max(symbol_count, 1)), lambda p, x: F.when(
            x[n] > 0, (x[seen] + x[t] * p) / (x[n] + x[t])).otherwise(p))

    ratio = F.ln(probability("ga", "na", "ta")) - F.ln(probability("gr", "nr", "tr"))
    return by_order.select("w", F.round(ratio * 1e6).cast("long").alias("micro"))


def best_threshold(scores: DataFrame) -> float:
    """From (score, accepted): the step that separates best, the lowest of equal
    ones; 0 where a class is missing. Only a table of steps is ordered."""
    steps = scores.groupBy(F.floor(F.col("score") * BINS).alias("step")).agg(
        F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))
    below = W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    rated = steps.select("step", (
        F.coalesce(F.sum("r").over(below), F.lit(0)) / F.nullif(F.sum("r").over(everything), F.lit(0))
        - F.coalesce(F.sum("a").over(below), F.lit(0)) / F.nullif(F.sum("a").over(everything), F.lit(0))
    ).alias("gain"))
    best = rated.filter("gain is not null").orderBy(F.desc("gain"), "step").first()
    return 0.0 if best is None else best["step"] / BINS


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row of ``pages``
    (``page_id``, ``url``).

    A rule's verdict holds; else ``allow`` if the score reaches the threshold,
    ``block`` below. score is null where a rule decides, and 0 for a URL
    without characters (null included). Without decided URLs both models are
    equal and all scores are 0, which allows. Null ids, repeated rows and empty
    tables pass through unchanged in number; a long URL is read whole. Other
    columns are not looked at.
    """
    url = F.col("url")
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"),
                         path_of(url).alias("path"), symbols(url).alias("text"),
                         F.monotonically_increasing_id().alias("tag"))
    parts = parts.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("rule"),
                         rule_of(F.col("host"), F.col("path"), rules, 2).alias("ruled"),
                         (F.crc32(F.col("text").cast("binary")) % 4 == 0).alias("held_out"))
    # host and path of a null url are empty, not null
    parts = durable(parts.fillna("", ["host", "path"]), "url-parts")
    decided = parts.filter("rule is not null").select("*", (F.col("ruled") == "allow").alias("accepted"))
    grams, contexts = model_counts(decided.filter("not held_out"))
    symbol_count = grams.filter("length(gram) = 1").count()
    scored = parts.filter("rule is null or held_out")
    looked_up = scored.filter("text <> ''").select(
        "tag", F.explode(windows(F.col("text"))).alias("w"))
    ratios = broadcast_if_small(durable(
        window_ratios(looked_up.select("w").distinct(), grams, contexts, symbol_count), "url-ratios"))
    scores = durable(looked_up.join(ratios, "w").groupBy("tag").agg(
        (F.sum("micro") / F.count("micro") / 1e6).alias("score")), "url-scores")
    threshold = best_threshold(decided.filter("held_out").join(scores, "tag").select("score", "accepted"))
    score = F.when(F.col("rule").isNull(), F.coalesce("score", F.lit(0.0)))
    return (parts.join(scores, "tag", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(score >= threshold, "allow").otherwise("block"))
                    .alias("verdict"), score.alias("score")))
