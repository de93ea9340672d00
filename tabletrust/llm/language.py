"""Language identification in two steps: family, then language.

Texts become hashed letter trigrams.  A bounded sample of labelled texts
trains one-versus-one linear support vector machines: first between
language families, then, within each family, between its languages, where
the differences are small and a machine for each pair can find them.  Each
machine's margin is calibrated to a probability on texts it did not see.

Every text is read in whole by its own task; the model is as large as the
number of language pairs, not as the data.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabletrust.llm.common import hash60, packed, small_batches, unpacked

#: Families of languages by their ISO 639-1 codes (fixed values).  A label
#: that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indo-aryan": "hi ur bn pa gu mr ne si",
    "semitic": "ar he am mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

DIMENSIONS = 1 << 13
#: Letters of a text are counted in stretches of at most so many.
STRETCH = 1 << 20
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def _plain() -> np.ndarray:
    """Byte -> byte: ASCII letters and all of UTF-8 stay, the rest of ASCII
    becomes space."""
    keep = np.full(256, 32, np.uint8)
    for lo, hi in ((97, 123), (128, 256)):
        keep[lo:hi] = np.arange(lo, hi)
    return keep


def trigrams(text: str) -> np.ndarray:
    """Square roots of the text's trigram counts, at unit length."""
    plain, counts = _plain(), np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(text), STRETCH):
        a = plain[np.frombuffer(f" {text[at: at + STRETCH].lower()} ".encode("utf-8", "replace"), np.uint8)]
        space = a == 32
        a = a[~(space & np.r_[False, space[:-1]])].astype(np.uint32)
        if len(a) < 3:
            continue
        h = (a[:-2] * np.uint32(0x9E3779B1) ^ a[1:-1] * np.uint32(0x85EBCA77) ^ a[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
        counts += np.bincount(h >> np.uint32(19), minlength=DIMENSIONS)
    x = np.sqrt(counts, dtype=np.float32)
    return x / max(float(np.sqrt(x @ x)), 1e-9)


def sparse(x: np.ndarray) -> bytes:
    """The places of what is not zero, and its values, 16 bits each."""
    at = np.flatnonzero(x)
    return at.astype(np.uint16).tobytes() + x[at].astype(np.float16).tobytes()


def train_svm(dots: np.ndarray, y: np.ndarray, cost: float = 10.0, epochs: int = 30, seed: int = 3) -> np.ndarray:
    """Factors of the training rows in the weights of a linear support
    vector machine with squared hinge loss: dual coordinate descent on the
    rows' inner products ``dots`` (plus one, for the bias); ``y`` is +-1."""
    dots = dots + 1.0
    alpha, margin, soft = np.zeros(len(y)), np.zeros(len(y)), 0.5 / cost
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            step = max(alpha[i] - (y[i] * margin[i] - 1 + soft * alpha[i]) / (dots[i, i] + soft), 0.0) - alpha[i]
            if step:
                alpha[i] += step
                margin += step * y[i] * dots[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return alpha * y


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-(a * margin + b))), by
    Newton steps on the log loss with smoothed targets."""
    up, down = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    v, z = np.array([2.0, 0.0]), np.c_[margin, np.ones(len(margin))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, z.T @ (p - t) + 1e-3 * (v - (2, 0)))
        v = v - np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return max(float(v[0]), 1e-3), float(v[1])


@dataclass
class OneVsOne:
    """Machines for all pairs of ``classes``; the class with the largest sum
    of pairwise probabilities wins, ties to the first."""

    classes: list[str]
    weights: np.ndarray = field(default=None)
    scale: np.ndarray = field(default=None)

    def fit(self, x: np.ndarray, labels: np.ndarray) -> OneVsOne:
        weights, scale, all_dots = [], [], x @ x.T
        for a, b in combinations(self.classes, 2):
            rows = np.flatnonzero((labels == a) | (labels == b))
            dots, y = all_dots[np.ix_(rows, rows)], np.where(labels[rows] == a, 1.0, -1.0)
            held = np.arange(len(rows)) % 5 == 0
            if held.any() and len(set(y[~held])) == 2:
                factors = train_svm(dots[np.ix_(~held, ~held)], y[~held])
                scale.append(calibrate((dots[np.ix_(held, ~held)] + 1) @ factors, y[held]))
            else:
                scale.append((2.0, 0.0))
            factors = train_svm(dots, y)
            weights.append(np.append(factors @ x[rows], factors.sum()).astype(np.float32))
        if weights:
            self.weights, self.scale = np.array(weights), np.array(scale)
        return self

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """The class and its least probability against any other."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        margin = self.weights[:, :-1] @ x + self.weights[:, -1]
        p = 1 / (1 + np.exp(-np.clip(self.scale[:, 0] * margin + self.scale[:, 1], -30, 30)))
        n = len(self.classes)
        wins, least = np.zeros(n), np.ones(n)
        for (a, b), q in zip(combinations(range(n), 2), p, strict=True):
            wins[a] += q
            wins[b] += 1 - q
            least[a], least[b] = min(least[a], q), min(least[b], 1 - q)
        best = int(wins.argmax())
        return self.classes[best], float(least[best])


@dataclass
class Model:
    families: OneVsOne
    languages: dict[str, OneVsOne]

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score); ``und`` and 0 for a text without a letter, or
        when nothing was learned."""
        if not self.families.classes or not text or not LETTER.search(text):
            return UNKNOWN, 0.0
        x = trigrams(text)
        family, p = self.families.predict(x)
        language, q = self.languages[family].predict(x)
        return language, p * q


def is_held_out(doc_id: Column) -> Column:
    """Documents with crc32(doc_id as text) mod 4 = 2 are never learned
    from.  A NULL doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, per_language: int = 300, most: int = 4000, families: Mapping[str, str] = FAMILY_OF,
        doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learns from about ``per_language`` texts of each label, chosen by a
    hash of doc_id, and at most about ``most`` in all: the one bound here,
    on what is learned from.  Rows that are held out, without a label or
    without a letter are not learned from."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & ~is_held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()}
    each = min(per_language, most // max(1, len(counts)))
    rate = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, each / n))]) if counts else F.lit(None)

    @F.pandas_udf("binary")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([sparse(trigrams(t)) if t and LETTER.search(t) else None for t in texts], dtype=object)

    learned = []
    if counts:
        drawn = rows.where(hash60("sample", F.col("doc_id"), F.length("text")) < rate[F.col("lang")] * float(1 << 60))
        learned = sorted((r["lang"], bytes(r["x"])) for r in drawn.select("lang", counted("text").alias("x")).where("x is not null").collect())
    # In an order that mixes the labels and does not depend on the tasks.
    order = np.random.default_rng(5).permutation(len(learned))
    labels = np.array([learned[i][0] for i in order], object)
    x = np.zeros((len(labels), DIMENSIONS), np.float32)
    for row, i in enumerate(order):
        at, values = np.split(np.frombuffer(learned[i][1], np.uint16), 2)
        x[row, at] = values.view(np.float16)
    del learned
    family_of = np.array([families.get(str(c).split("-")[0].split("_")[0].lower(), f"={c}") for c in labels], object)
    names = sorted(set(family_of))
    return Model(
        OneVsOne(names).fit(x, family_of),
        {f: OneVsOne(sorted(set(labels[family_of == f]))).fit(x[family_of == f], labels[family_of == f]) for f in names},
    )


def predictor(docs: DataFrame, model: Model):
    """A function of a text column: struct(lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **params) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``lang_pred``
    and ``score`` (0 to 1: the family's probability times the language's).

    NULL texts and texts without a letter are ``und`` with score 0, and so
    is every text when there is no label to learn from.  Repeated rows get
    equal answers; no rows give no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    predict = predictor(docs, model or fit(docs, doc_id=doc_id, text=text, lang=lang, **params))
    return docs.select(F.col(doc_id).alias("doc_id"), is_held_out(F.col(doc_id)).alias("held_out"), predict(F.col(text)).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")


def recognised(docs: DataFrame, least_score: float = 0.25, **params) -> DataFrame:
    """``docs`` whose language is recognised: not ``und``, and a score of
    at least ``least_score``."""
    small_batches(docs.sparkSession)
    predict = predictor(docs, fit(docs, **params))
    rows = docs.select(packed(docs), predict(F.col("text")).alias("_p"))
    return unpacked(rows.where((F.col("_p.lang_pred") != UNKNOWN) & (F.col("_p.score") >= least_score)), docs)
