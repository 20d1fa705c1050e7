"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn from the whole table,
whatever their labels, are the unlabelled set. A linear model over stems (words
and word beginnings), each at a few levels of count and rate, is trained in numpy on the risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

where R_p(-) corrects the unlabelled set's risk for the positives in it; while
the corrected part is negative (the model fits the unlabelled set too well) the
step goes the other way. The class prior is the share of toxic labels.

Fitting reads bounded samples (``POSITIVES``, ``UNLABELLED``); scoring reads
every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from .bpe_codec import chunks, small_batches
from .bpe_vocab import pieces
from .sampling import fold, one_text_each, sample_ids

POSITIVES = 1500          # most confirmed toxic texts read for a fit
UNLABELLED = 4000         # most unlabelled texts read for a fit
FEATURES = 2048           # most features of a model
MIN_POSITIVES = 3         # positives that must hold a feature
MIN_LIFT = 3.0            # times more frequent in positives than in corrected negatives
MIN_Z = 3.0               # standard errors between the two frequencies
CACHE_WORDS = 300_000
BEGINNINGS = (4, 5, 6)
COUNTS = (1, 3)           # levels of a feature: so many words with the stem ...
RATES = (256, 64)         # ... or one in so many
_WORD = re.compile(r"[^\W\d_]+")


def word_counts(text: str) -> Counter:
    words: Counter = Counter()
    for piece in pieces(text):
        words.update(_WORD.findall(piece.lower()))
    return words


def word_stems(word: str) -> list[int]:
    """Signed 64-bit hashes of the word and of its beginnings."""
    names = [f"={word}", *[word[:k] for k in BEGINNINGS if len(word) >= k]]
    return [xxhash.xxh64_intdigest(n) - (1 << 63) for n in names]


def levels(count: int, words: int) -> list[int]:
    """The levels that ``count`` words of a stem reach in a text of ``words``
    words: counts as they are, rates negative."""
    return [c for c in COUNTS if count >= c] + [-r for r in RATES if count * r >= words]


def text_features(text: str) -> list[tuple[int, int]]:
    """(stem, level) pairs of a text."""
    words, stems = word_counts(text), Counter()
    for word, n in words.items():
        for stem in word_stems(word):
            stems[stem] += n
    total = words.total()
    return [(stem, level) for stem, n in stems.items() for level in levels(n, total)]


@dataclass(frozen=True)
class Model:
    weights: dict[int, dict[int, float]]        # by stem, then level
    bias: float


def _log1pexp(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def corrected_risk(theta: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray,
                   prior: float) -> tuple[float, float, np.ndarray]:
    """(positives' share of the risk, the class-prior-corrected risk of negatives, and
    the direction of a training step) with logistic loss, ``theta`` being weights and
    bias. The direction is the gradient of the sum of both; where the corrected risk is
    negative (the model fits the sample too closely), that of its opposite alone."""
    k = len(theta) - 1
    sp, su = positive @ theta[:k] + theta[k], unlabelled @ theta[:k] + theta[k]
    corrected = _log1pexp(su).mean() - prior * _log1pexp(sp).mean()
    up = _sigmoid(sp) / len(sp)                     # gradient of R_p(-)
    uu = _sigmoid(su) / len(su)                     # gradient of R_u(-)
    if corrected >= 0:
        gp, gu = prior * (up - 1.0 / len(sp)) - prior * up, uu
    else:
        gp, gu = prior * up, -uu
    return (float(prior * _log1pexp(-sp).mean()), float(corrected),
            np.append(positive.T @ gp + unlabelled.T @ gu, gp.sum() + gu.sum()))


def train_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400,
               rate: float = 0.05, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the non-negative risk (logistic
    loss)."""
    k = positive.shape[1]
    positive, unlabelled = positive.astype(np.float64), unlabelled.astype(np.float64)
    theta, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    theta[k] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        g = corrected_risk(theta, positive, unlabelled, prior)[2]
        g[:k] += decay * theta[:k]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:k], float(theta[k])


def fit(docs: DataFrame, labels: DataFrame, train: Column, positives: int = POSITIVES,
        unlabelled: int = UNLABELLED, features: int = FEATURES) -> Model:
    """A model from the rows of ``docs`` (doc_id, text) and ``labels`` (doc_id,
    toxic) that ``train``, a condition on doc_id, allows. Without toxic labels
    the model has no features and gives every text the same low score."""
    marked = (labels.filter(train & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    marked = durable(marked, "toxic-labels")
    share = marked.agg(F.avg("toxic")).first()[0]
    prior = min(0.9, max(0.001, share if share is not None else 0.001))
    ids = docs.filter(train & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"))
    toxic = marked.filter("toxic = 1").select("doc_id").join(ids.distinct(), "doc_id", "left_semi")
    chosen = durable(
        sample_ids(toxic.select("doc_id", F.lit(1).alias("side")), "side", positives)
        .unionByName(sample_ids(ids.select("doc_id", F.lit(0).alias("side")), "side", unlabelled, 2)),
        "toxic-sample")                                 # at most positives + unlabelled rows
    texts = one_text_each(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(chosen.distinct()), "doc_id"), ["side", "doc_id"]).select("side", "text")

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                own = np.array(text_features(text.as_py() or ""), np.int64).reshape(-1, 2)
                pairs = pa.StructArray.from_arrays(
                    [pa.array(own[:, 0]), pa.array(own[:, 1].astype(np.int32))], ["stem", "level"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("side").slice(i, 1), pa.ListArray.from_arrays(
                        pa.array([0, len(own)], pa.int32()), pairs)], ["side", "features"])

    sample = durable(texts.mapInArrow(
        features_of, "side int, features array<struct<stem: long, level: int>>"), "toxic-features")
    sizes = {r["side"]: r["n"] for r in sample.groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_unl = sizes.get(1, 0), sizes.get(0, 0)
    nothing = Model({}, float(np.log(prior / (1 - prior))))
    if not n_pos or not n_unl:
        return nothing
    counted = (sample.select("side", F.inline("features")).groupBy("stem", "level")
               .agg((F.sum("side") / n_pos).alias("p"), (F.sum(1 - F.col("side")) / n_unl).alias("u"))
               # the unlabelled frequency without the share of positives in it
               .select("*", F.greatest(F.lit(0.0), (F.col("u") - prior * F.col("p")) / (1 - prior)).alias("n")))
    error = F.sqrt(F.col("p") * (1 - F.col("p")) / n_pos
                   + (F.col("u") * (1 - F.col("u")) + 1 / n_unl) / n_unl / (1 - prior) ** 2 + 1e-12)
    z = (F.col("p") - F.col("n")) / error
    gain = z * F.ln((F.col("p") + 1 / n_pos) / (F.col("n") + 1 / n_unl))
    best = (counted.filter((F.col("p") * n_pos >= min(MIN_POSITIVES, n_pos) - 0.5)
                           & (F.col("p") >= MIN_LIFT * F.col("n")) & (z >= MIN_Z))
            .orderBy(gain.desc(), "stem", "level").limit(features))
    names = sorted((r["stem"], r["level"]) for r in best.select("stem", "level").collect())
    if not names:
        return nothing
    at = {name: i for i, name in enumerate(names)}

    stems = np.unique(np.array([name[0] for name in names], np.int64))

    def selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            flat = lists.flatten()
            stem, level = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            place = np.minimum(np.searchsorted(stems, stem), len(stems) - 1)
            held: list[list[int]] = [[] for _ in range(len(lists))]
            for i in np.flatnonzero(stems[place] == stem).tolist():
                name = (int(stem[i]), int(level[i]))
                if name in at:
                    held[row[i]].append(at[name])
            yield pa.RecordBatch.from_arrays(
                [batch.column("side"), pa.array([sorted(h) for h in held], pa.list_(pa.int32()))],
                ["side", "held"])

    rows = sample.mapInArrow(selected, "side int, held array<int>").collect()
    table = {1: np.zeros((n_pos, len(names)), np.float32), 0: np.zeros((n_unl, len(names)), np.float32)}
    row = {0: 0, 1: 0}
    for side, held in sorted((r["side"], r["held"]) for r in rows):
        table[side][row[side], held] = 1.0
        row[side] += 1
    learned, bias = train_nnpu(table[1], table[0], prior)
    weights: dict[int, dict[int, float]] = {}
    for (stem, level), weight in zip(names, learned.tolist()):
        weights.setdefault(stem, {})[level] = weight
    return Model(weights, bias)


class Scorer:
    """Scores texts in one task, with a bounded cache of words."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def _stems(self, word: str) -> tuple[int, ...]:
        held = self.known.get(word)
        if held is None:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            held = tuple(s for s in word_stems(word) if s in self.model.weights)
            self.known[word] = held
        return held

    def score(self, text: str) -> float:
        words, stems = word_counts(text), {}
        for word, n in words.items():
            for stem in self._stems(word):
                stems[stem] = stems.get(stem, 0) + n
        length = words.total()
        total = self.model.bias + sum(
            self.model.weights[stem].get(level, 0.0)
            for stem, n in sorted(stems.items()) for level in levels(n, length))
        return float(_sigmoid(np.float64(total)))


def score_texts(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",),
                name: str = "toxic_score") -> DataFrame:
    """The columns ``keep`` of ``docs`` and a column ``name`` with the score (0
    to 1) of every whole text.

    A null text is an empty one, which scores by the bias alone. Null ids,
    repeated rows and empty tables pass through unchanged in number. Long texts
    are read in pieces cut at blanks. ``keep`` may not name the new column.
    """
    if name in keep:
        raise ValueError(f"{name} is the name of the new column")
    shipped = docs.sparkSession.sparkContext.broadcast(model)      # at most FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for batch in batches:
            for part in chunks(batch, "text"):
                scores = [scorer.score(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(scores, pa.float64())], [*keep, name])

    source = small_batches(docs).select(*dict.fromkeys([*keep, "text"]))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema.fields]
    return source.mapInArrow(run, ", ".join([*kept, f"`{name}` double"]))


def train_fold(doc_id: Column, folds: int = 3, left_out: int = 1) -> Column:
    return fold(doc_id, folds) != left_out
