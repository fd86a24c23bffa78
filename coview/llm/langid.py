"""Hierarchical language identification.

Features are hashed byte n-grams (1 to 3 bytes of lower-cased letters and word
breaks), as square roots of their shares. A first level of one-versus-one
linear support vector machines picks the language family; a second level,
trained inside each family only, picks the language among its closely related
members by votes, ties by summed margins.

The machines are fitted on the driver on a bounded sample of labelled rows:
about ``max_train`` rows in all, the same number for each label, chosen by a
hash of the id (all rows of a label that has fewer). Prediction reads every
whole text.

Cases: a null text, or one without any letter, is ``und`` with score 0; labels
that are null are not learned from; labels outside the family table form a
family of their own; without any training row every text is ``und``; repeated
rows are predicted alike; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coview.llm import kernel as K
from coview.llm.columns import map_text

UNKNOWN = "und"
DIMENSIONS = 2048
MAX_TRAIN = 2000

# ISO 639-1 codes by language family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "turkic": "tr az kk uz",
    "semitic": "ar he mt am",
    "indic": "hi bn pa gu mr ur ne",
    "sinitic": "zh",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])


def features(block: K.Block, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One unit row per document: square roots of hashed n-gram shares."""
    data = K.LOWER[block.data]
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1  # Latin-1 capitals
    lead = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E) & (data[lead] != 0x97)]
    data[lead] += 0x20
    data[~_LETTER[data]] = 0x20
    doc = np.repeat(np.arange(block.n), np.diff(block.offsets))
    x = np.zeros(block.n * dimensions, dtype=np.float32)
    code = np.zeros(len(data), dtype=np.uint32)
    for order in (1, 2, 3):
        n = len(data) - order + 1
        if n <= 0:
            break
        code = code[:n] + (data[order - 1:].astype(np.uint32) << np.uint32(8 * (order - 1)))
        slot = ((code + np.uint32(order << 24)) * np.uint32(2654435761)) >> np.uint32(16)
        slot = (slot % np.uint32(dimensions)).astype(np.int64)
        inside = doc[:n] == doc[order - 1:]
        x += np.bincount((doc[:n] * dimensions + slot)[inside], minlength=len(x))
    x = np.sqrt(x.reshape(block.n, dimensions))
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _has_letter(column: pa.Array) -> np.ndarray:
    """True where a text has any letter (of any script)."""
    out = np.zeros(len(column), dtype=bool)
    for block in K.text_blocks(column):
        letters = np.concatenate([[0], np.cumsum(_LETTER[K.LOWER[block.data]] & (block.data < 128))])
        other = np.concatenate([[0], np.cumsum(block.data >= 128)])
        ascii_letters = np.diff(letters[block.offsets])
        rest = np.flatnonzero((ascii_letters == 0) & (np.diff(other[block.offsets]) > 0))
        out[block.first: block.first + block.n] = ascii_letters > 0
        for i in rest.tolist():
            out[block.first + i] = any(c.isalpha() for c in column[block.first + i].as_py())
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 120) -> np.ndarray:
    """Linear SVM (squared hinge, accelerated gradient); ``y`` is +1 or -1.

    Classes weigh the same whatever their sizes; the last weight is the bias.
    """
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    weight = (c * len(y) * weight).astype(x.dtype)
    v = np.ones(x.shape[1], dtype=x.dtype)
    for _ in range(8):
        v = x.T @ (weight * (x @ v))
        v /= np.linalg.norm(v)
    step = 1.0 / (1.0 + 2.2 * float(v @ (x.T @ (weight * (x @ v)))))
    w = look = np.zeros(x.shape[1], dtype=x.dtype)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ look))
        new = look - step * (look - 2 * (x.T @ (weight * y * slack)))
        look = new + (k / (k + 3)) * (new - w)
        w = new
    return w


@dataclass
class PairwiseSvm:
    """One-versus-one machines over some classes; one class needs none."""

    classes: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray) -> PairwiseSvm:
        out = cls(sorted(set(labels.tolist())))
        out.pairs = list(combinations(range(len(out.classes)), 2))
        rows = []
        for a, b in out.pairs:
            use = (labels == out.classes[a]) | (labels == out.classes[b])
            y = np.where(labels[use] == out.classes[a], 1, -1).astype(x.dtype)
            rows.append(fit_svm(x[use], y))
        out.weights = np.array(rows) if rows else None
        return out

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class index and its confidence (0 to 1) for each row."""
        n, k = len(x), len(self.classes)
        if k == 1:
            return np.zeros(n, dtype=np.int64), np.ones(n)
        margin = x @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, against = np.zeros((n, k)), np.full((n, k), np.inf)
        for j, (a, b) in enumerate(self.pairs):
            m = margin[:, j]
            bounded = np.tanh(m) / (2 * k)  # breaks ties between equal votes
            votes[:, a] += (m >= 0) + bounded
            votes[:, b] += (m < 0) - bounded
            against[:, a] = np.minimum(against[:, a], m)
            against[:, b] = np.minimum(against[:, b], -m)
        best = votes.argmax(axis=1)
        return best, 1 / (1 + np.exp(-4 * against[np.arange(n), best].clip(-30, 30)))


@dataclass
class LanguageModel:
    """Family machines, and language machines for each family."""

    families: PairwiseSvm | None = None
    languages: dict[str, PairwiseSvm] = field(default_factory=dict)
    dimensions: int = DIMENSIONS

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        n = len(column)
        pred, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
        if self.families is not None:
            known = _has_letter(column)
            for block in K.text_blocks(column):
                x = features(block, self.dimensions)
                family, sure = self.families.predict(x)
                for f, name in enumerate(self.families.classes):
                    rows = np.flatnonzero(family == f)
                    if not len(rows):
                        continue
                    best, p = self.languages[name].predict(x[rows])
                    pred[block.first + rows] = np.array(self.languages[name].classes, dtype=object)[best]
                    score[block.first + rows] = p * sure[rows]
            pred[~known], score[~known] = UNKNOWN, 0.0
        return [pa.array(pred.tolist(), type=pa.string()), pa.array(score)]


class _Features:
    def __init__(self, dimensions: int) -> None:
        self.dimensions = dimensions

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        rows = [r.tobytes() for b in K.text_blocks(column) for r in features(b, self.dimensions)]
        return [pa.array(rows, type=pa.binary())]


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_train: int = MAX_TRAIN, dimensions: int = DIMENSIONS) -> LanguageModel:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    model = LanguageModel(dimensions=dimensions)
    if not counts:
        return model
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(max_train / len(counts) / n)).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = map_text(rows.where(place < share), _Features(dimensions),
                      [T.StructField("features", T.BinaryType())], keep=("lang",))
    got = sample.limit(2 * max_train + 100).collect()
    x = np.frombuffer(b"".join(r["features"] for r in got), dtype=np.float32).reshape(-1, dimensions)
    lang = np.array([r["lang"] for r in got], dtype=object)
    used = x.any(axis=1)
    x, lang = x[used], lang[used]
    if not len(x):
        return model
    family = np.array([FAMILY_OF.get(v, v) for v in lang], dtype=object)
    model.families = PairwiseSvm.fit(x, family)
    model.languages = {f: PairwiseSvm.fit(x[family == f], lang[family == f])
                       for f in model.families.classes}
    return model


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``lang_pred`` and ``score``."""
    return map_text(docs, model, [T.StructField("lang_pred", T.StringType()),
                                  T.StructField("score", T.DoubleType())], keep, text_col)
