"""Language identification in two steps: family, then language.

One linear support vector machine for each pair of language families picks the
family; one for each pair of languages of that family picks the language. Texts
are read as hashed byte pairs and triples of their lower-cased letters (square
roots of counts, unit length). Fitting reads a bounded sample of labelled texts
and a short excerpt of each; prediction reads every whole text.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from .bpe_codec import chunks
from .sampling import fold, one_text_each, sample_ids

PER_LANGUAGE = 400         # most labelled texts of a language read for a fit
SAMPLE_TEXTS = 8000        # about as many texts of all languages, 8 of each at least
LANGUAGES = 250            # most languages learned: those with most labelled texts
EXCERPT = 48               # characters of the excerpt
PAIRS, TRIPLES = 1 << 11, 1 << 12
WIDTH = PAIRS + TRIPLES
STEP = 1 << 22             # bytes counted at a time
_LETTER = regex.compile(r"\p{L}")

# Families by ISO 639-1 code. A language not listed is a family
# of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("ar", "he", "mt"),
    "sinitic": ("yue", "zh"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang, f"only {lang}")


def vector(text: str) -> np.ndarray:
    """Unit vector of a text's byte pairs and triples (zero without letters)."""
    raw = _FOLD[np.frombuffer(text.lower().encode(), np.uint8)]
    counts = np.zeros(WIDTH, np.int64)
    for s in range(0, len(raw), STEP):
        b = raw[max(0, s - 2):s + STEP].astype(np.uint32)
        if len(b) > 1:
            pair = b[:-1] * np.uint32(2654435761) + b[1:] * np.uint32(40503)
            seen = slice(1 if s > 1 else 0, None)          # the overlap's pair was counted
            counts[:PAIRS] += np.bincount((pair[seen] >> 7) % PAIRS, minlength=PAIRS)
            triple = pair[:-1] ^ (b[2:] * np.uint32(2246822519))
            counts[PAIRS:] += np.bincount((triple >> 9) % TRIPLES, minlength=TRIPLES)
    out = np.sqrt(counts.astype(np.float32))
    norm = float(np.linalg.norm(out))
    return out / norm if norm else out


@dataclass(frozen=True)
class Model:
    languages: dict[str, tuple[str, ...]]                    # by family, sorted
    machines: dict[tuple[str, str], tuple[np.ndarray, float]]  # first name is the positive side


def train_svm(x: np.ndarray, y: np.ndarray, decay: float = 3e-4, steps: int = 250) -> tuple[np.ndarray, float]:
    """Linear machine by accelerated gradient on the squared hinge; the classes
    (y = 1, -1) weigh the same."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b, pw, pb, rate = np.zeros(x.shape[1], np.float32), 0.0, 0.0, 0.0, 1 / (4 + decay)
    vw, vb = w.copy(), 0.0
    for step in range(steps):
        slack = np.maximum(0.0, 1 - y * (x @ vw + vb))
        g = -2 * share * y * slack
        pw, pb = w, b
        w = vw - rate * (x.T @ g + decay * vw)
        b = vb - rate * float(g.sum())
        k = step / (step + 3)
        vw, vb = w + k * (w - pw), b + k * (b - pb)
    return w.astype(np.float32), float(b)


def fit(docs: DataFrame, train: Column, per_language: int = PER_LANGUAGE) -> Model:
    """A model from the rows of ``docs`` (doc_id, text, lang) that ``train``, a
    condition on doc_id, allows. Null languages and texts without letters teach
    nothing. The sample is bounded by ``per_language``, ``SAMPLE_TEXTS`` and
    ``LANGUAGES``; an id that is repeated gives one text."""
    rows = docs.filter(train & F.col("lang").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    learned = durable(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
                      .select("lang"), "lang-names")
    each = min(per_language, max(8, SAMPLE_TEXTS // max(1, learned.count())))
    chosen = durable(sample_ids(rows.join(F.broadcast(learned), "lang"), "lang", each).distinct(), "lang-sample")
    texts = one_text_each(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).join(
        F.broadcast(chosen), ["doc_id", "lang"]), ["doc_id", "lang"]).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                langs, out = [], []
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    middle = len(text or "") // 2
                    for own in (text or "", (text or "")[middle:middle + EXCERPT]):
                        if _LETTER.search(own):
                            langs.append(lang)
                            out.append(vector(own).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["lang", "x"])

    found = texts.mapInArrow(vectors, "lang string, x binary").collect()
    pairs = sorted((r["lang"], bytes(r["x"])) for r in found)
    langs = np.array([p[0] for p in pairs], object)
    x = np.stack([np.frombuffer(p[1], np.float32) for p in pairs]) if pairs else np.zeros((0, WIDTH))
    families: dict[str, tuple[str, ...]] = {}
    for lang in sorted(set(langs)):
        families[family_of(lang)] = (*families.get(family_of(lang), ()), lang)
    own = np.array([family_of(lang) for lang in langs], object)
    machines = {}

    def learn(names: np.ndarray, a: str, b: str) -> None:
        at = (names == a) | (names == b)
        machines[a, b] = train_svm(x[at], np.where(names[at] == a, 1.0, -1.0).astype(np.float32))

    for a, b in itertools.combinations(sorted(families), 2):
        learn(own, a, b)
    for members in families.values():
        for a, b in itertools.combinations(members, 2):
            learn(langs, a, b)
    return Model(families, machines)


def _duel(model: Model, names: list[str], x: np.ndarray) -> tuple[str, float]:
    """The name with most wins (then the larger sum of margins, then the first
    in order), and the chance of its closest win or loss."""
    wins, margins, closest = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, 30.0)
    for a, b in itertools.combinations(names, 2):
        w, bias = model.machines[a, b]
        m = float(x @ w) + bias
        wins[a if m >= 0 else b] += 1
        for name, own in ((a, m), (b, -m)):
            margins[name] += own
            closest[name] = min(closest[name], own)
    best = max(names, key=lambda n: (wins[n], margins[n], [-ord(c) for c in n]))
    return best, float(1 / (1 + np.exp(-3 * closest[best])))


def predict(model: Model, text: str | None) -> tuple[str, float]:
    """(language, score from 0 to 1); ``und`` and 0 without letters or model."""
    if not text or not model.languages or not _LETTER.search(text):
        return "und", 0.0
    x = vector(text)
    family, first = _duel(model, sorted(model.languages), x)
    lang, second = _duel(model, list(model.languages[family]), x)
    return lang, first * second


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every whole text of ``docs``.

    ``und`` with score 0 for a null text, a text without letters, and for all
    texts if nothing could be learned. Null ids, repeated rows and empty tables
    pass through unchanged in number. A language or source column of ``docs``
    is not read.
    """
    # A few machines of WIDTH weights for each pair of families and languages.
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            for part in chunks(batch, "text"):
                found = [predict(own, t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def train_fold(doc_id: Column, folds: int = 4, left_out: int = 2) -> Column:
    return fold(doc_id, folds) != left_out
