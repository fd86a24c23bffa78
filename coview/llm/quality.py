"""Quality rules: a learned, ordered decision list over text statistics.

Statistics are plain DataFrame expressions. The list is learned by sequential
covering: on one part of the labelled rows a conjunction of thresholds is grown
by information gain against the rows still uncovered, on the other part it is
pruned from its end, and it joins the list while it is precise there. The list
becomes one ordered conditional Spark expression; no Python runs on executors.

Learning reads a bounded sample of labelled rows: about ``max_train`` label
rows chosen by a hash of the id (all of them if there are fewer). Their ids are
broadcast, so the broadcast is bounded by the same parameter.

Cases: a null or empty text has no words and all its statistics are 0; null
labels are left out; without labels, or when no rule is precise enough, the
list is empty and keeps everything; repeated rows are judged alike; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 4000
WINDOW_WORDS = 8
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_upper", "n_distinct")


def statistics(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id and the counts of ``COUNTS`` (longs), one row per input row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    d = d.select("doc_id", "text",
                 F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
                 F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    k = WINDOW_WORDS
    d = d.withColumn("n_words", F.size("words").cast("long"))
    d = d.withColumn("windows", F.when(F.col("n_words") >= k, F.transform(
        F.sequence(F.lit(1), F.size("words") - (k - 1)),
        lambda i: F.xxhash64(F.slice("words", i, k)))))
    d = d.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    # windows in order of hash: equal ones are neighbours
    d = d.withColumn("order", F.when(F.col("repeats"), F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda j: F.get(F.col("order"), j)["h"]
    twice = F.filter("order", lambda e, j: F.coalesce(e["h"] == near(j - 1), F.lit(False))
                     | F.coalesce(e["h"] == near(j + 1), F.lit(False)))
    d = d.withColumn("at", F.sort_array(F.transform(twice, lambda e: e["i"])))
    start = F.struct(F.lit(-k).alias("last"), F.lit(0).alias("n"))
    words = F.aggregate("at", start, lambda a, i: F.struct(
        i.alias("last"), (a["n"] + F.least(F.lit(k), i - a["last"])).alias("n")))["n"]
    without = lambda chars: F.length(F.translate("text", chars, ""))
    return d.select(
        "doc_id", "n_words", without(_SPACES).cast("long").alias("word_chars"),
        (F.length("text") - without(_SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(words, F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.length("text") - without(_UPPER)).cast("long").alias("n_upper"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def features() -> dict[str, Column]:
    """What the rules look at: sizes and shares of the counts."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "upper_share": F.col("n_upper") / chars,
        "repeat_share": F.col("n_repeat_words") / words,
        "distinct_share": F.col("n_distinct") / words,
        "dup_lines_per_word": F.col("n_dup_lines") / words,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = features()[self.feature]
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return f"if {' and '.join(map(str, self.conditions))} then drop ({self.precision:.2f})"


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    """FOIL's information gain of covering p, n instead of p0, n0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, gain, -1.0)


def _best_condition(x: np.ndarray, bad: np.ndarray, names: list[str]) -> Condition | None:
    """The threshold with the largest gain over all features and cuts."""
    p0, n0 = int(bad.sum()), int(len(bad) - bad.sum())
    best, best_gain = None, 1e-9
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        values = x[order, j]
        p = np.cumsum(bad[order])[:-1]
        n = np.arange(1, len(values)) - p
        cut = np.flatnonzero(values[1:] > values[:-1])
        if not len(cut):
            continue
        for above, pp, nn in ((False, p[cut], n[cut]), (True, p0 - p[cut], n0 - n[cut])):
            gain = _gain(pp, nn, p0, n0)
            k = int(gain.argmax())
            if gain[k] > best_gain:
                middle = float((values[cut[k]] + values[cut[k] + 1]) / 2)
                best, best_gain = Condition(name, above, middle), float(gain[k])
    return best


def _holds(conditions, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in conditions:
        v = x[:, names.index(c.feature)]
        out &= (v > c.threshold) if c.above else (v <= c.threshold)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], most: int) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < most and 0 < bad.sum() < len(bad):
        best = _best_condition(x, bad, names)
        if best is None:
            break
        rule.append(best)
        hit = _holds([best], x, names)
        x, bad = x[hit], bad[hit]
    return rule


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], least_precision: float = 0.9,
          max_conditions: int = 4, max_rules: int = 12, least_cover: int = 3) -> list[Rule]:
    """Sequential covering of the rows with ``bad`` = 1; every third row prunes."""
    part = np.arange(len(x)) % 3 == 0
    left = np.ones(len(x), dtype=bool)
    rules: list[Rule] = []

    def counts(conditions, rows):
        hit = bad[rows][_holds(conditions, x[rows], names)]
        return int(hit.sum()), int(len(hit) - hit.sum())

    while len(rules) < max_rules and bad[left & ~part].any():
        full = _grow(x[left & ~part], bad[left & ~part], names, max_conditions)
        if not full:
            break

        def worth(conditions):
            p, n = counts(conditions, left & part)
            return (p - n) / (p + n) if p + n else -1.0, -len(conditions)

        rule = max((full[:k] for k in range(1, len(full) + 1)), key=worth)
        p, n = counts(rule, left)
        held_p, held_n = counts(rule, left & part)
        if (p < least_cover or p < least_precision * (p + n)
                or held_p < least_precision * (held_p + held_n)):
            break
        rules.append(Rule(tuple(rule), p / (p + n)))
        left &= ~_holds(rule, x, names)
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id_col: str = "doc_id", quality_col: str = "quality",
        max_train: int = MAX_TRAIN) -> list[Rule]:
    """Rules that drop low quality (label 0), from a bounded sample."""
    known = labels.select(F.col(label_id_col).alias("label_id"), F.col(quality_col).alias("quality"))
    known = known.where(F.col("label_id").isNotNull() & F.col("quality").isNotNull())
    n = known.count()
    if not n:
        return []
    place = F.pmod(F.xxhash64("label_id"), F.lit(1 << 20))
    sample = known.where(place < int(max_train / n * (1 << 20)) + 1).limit(2 * max_train)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(sample), rows["doc_id"] == sample["label_id"])
    stats = statistics(rows.select(F.struct("doc_id", "quality").alias("doc_id"), "text"))
    names = list(features())
    # A filter here would be pushed below the statistics and repeat them, so the
    # bounded result is filtered and ordered on the driver. Base failures need no
    # rule: the list is for what the fixed rules let pass.
    got = stats.select("doc_id.doc_id", F.when(F.col("doc_id.quality") == 0, 1).otherwise(0).alias("bad"),
                       base_failed().alias("failed"),
                       *(c.alias(k) for k, c in features().items())).collect()
    got = sorted((r for r in got if not r["failed"]), key=lambda r: (str(r["doc_id"])[::-1], r["bad"]))
    x = np.array([[float(r[k]) for k in names] for r in got]).reshape(-1, len(names))
    return learn(x, np.array([r["bad"] for r in got], dtype=np.int64), names)


def verdict(rules: list[Rule]) -> Column:
    """True unless a rule of the ordered list drops the row."""
    if not rules:
        return F.lit(True)
    out = F.when(rules[0].column(), F.lit(False))
    for r in rules[1:]:
        out = out.when(r.column(), F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` for every row."""
    stats = statistics(docs, text_col, id_col)
    return stats.select("doc_id", *COUNTS, base_failed().alias("base_failed"),
                        (~base_failed() & verdict(rules)).alias("kept"))
