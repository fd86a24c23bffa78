"""Personal data by weak supervision.

Fixed rules find the base spans (emails, addresses, cards, phones). Looser
candidates (card-like and phone-like numbers, key-like strings) and the base
spans get votes from five labelers: a shape expression, a gazetteer of prefixes
and words, the words before, a checksum or alphabet test, and the surroundings.
Votes are 1, 0 or - (abstain). Expectation-maximisation estimates, for each
kind, how reliable each labeler is, from the counts of all vote patterns of the
whole corpus; its posteriors train the final span classifier, a logistic
regression over votes and shape. Base spans always stay.

Counts are aggregated per (kind, votes, shape): a bounded set of patterns, so
what the driver collects does not grow with the documents. The candidates are
written once to the shared folder; every text is scanned once.

Cases: a null or empty text has no spans; overlaps of the same kind do not
occur, a loose candidate that overlaps a base span is not proposed; repeated
rows are treated alike; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coview.llm import kernel as K
from coview.llm.columns import map_text
from coview.session import write_cut

KINDS = ("email", "ip", "card", "phone", "secret")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE_PHONE = re.compile(r"(?<![0-9])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_LOOSE_CARD = re.compile(r"(?<![0-9.+])[0-9](?:[ -]?[0-9]){11,18}(?![0-9])")
#: runs of any length; one without a digit is no key (tested after the match)
_SECRET = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{20,}")
_DIGIT = re.compile(r"[0-9]")
#: area code and exchange of a ten-digit number begin with 2 to 9
_TEN_DIGITS = re.compile(r"\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}$")
_CONTEXT = {
    "email": re.compile(r"e-?mail|contact|write|mailto|@", re.I),
    "ip": re.compile(r"\bip\b|address|host|server", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|karte|tarjeta|carte", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|sms", re.I),
    "secret": re.compile(r"token|secret|key|password|passwd|bearer|auth", re.I),
}
_CARD_PREFIX = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)")
_SECRET_PREFIX = re.compile(r"AKIA|ghp_|gho_|sk_|pk_|xox|AIza|[0-9a-f]{32,}$")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails, in one pass over the ``@`` signs."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) by start, then kind."""
    out = [(s, 0, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates outside the base spans, longest claim first, no overlaps."""
    found = [(m.start(), k, m.end()) for k, rule in ((2, _LOOSE_CARD), (3, _LOOSE_PHONE), (4, _SECRET))
             for m in rule.finditer(text) if k != 4 or _DIGIT.search(m.group())]
    taken = sorted((s, e) for s, _, e in base)
    out: list[tuple[int, int, int]] = []
    for s, k, e in sorted(found, key=lambda x: (x[0], x[0] - x[2], x[1])):
        if out and s < out[-1][2]:
            continue
        if any(a < e and s < b for a, b in taken):
            continue
        out.append((s, k, e))
    return out


def votes(text: str, start: int, kind: int, end: int, strict: bool) -> str:
    """One character per labeler: shape, gazetteer, context, checksum, surroundings."""
    span, name = text[start:end], KINDS[kind]
    before = text[max(0, start - 24): start]
    digits = _digits(span)
    shape = "1" if strict else "0" if kind == 2 else "-"
    gazetteer = "-"
    if kind == 2:
        gazetteer = "1" if _CARD_PREFIX.match(digits) else "0"
    elif kind == 4:
        gazetteer = "1" if _SECRET_PREFIX.match(span) else "-"
    elif kind == 0:
        gazetteer = "1" if re.search(r"\.(com|org|net|edu|io|de|fr|es|example)$", span) else "-"
    elif kind == 3:
        gazetteer = "1" if span.startswith("+") or _TEN_DIGITS.match(span) else "-"
    context = "1" if _CONTEXT[name].search(before) else "-"
    check = "-"
    if kind == 2:
        check = "1" if _luhn(digits) else "0"
    elif kind == 4:
        check = "1" if len(set(span)) >= 10 and len(digits) >= 4 else "0"
    elif kind == 3:
        check = "1" if 10 <= len(digits) <= 15 else "0"
    quoted = before[-1:] in ('"', "'", "=", ":") or text[end: end + 1] in ('"', "'")
    around = "1" if kind == 4 and quoted else "0" if before[-1:].isalnum() or text[end: end + 1].isalnum() else "-"
    return shape + gazetteer + context + check + around


def shape_of(span: str) -> str:
    """Length and digit share in a few steps: bounded values."""
    share = sum(c in "0123456789" for c in span) / max(1, len(span))
    return f"{min(len(span) // 8, 7)}{int(share * 3.999)}"


def _propose(text: str) -> tuple[list[tuple[int, int, int]], list[dict]]:
    base = base_spans(text)
    spans = [(s, k, e, True) for s, k, e in base]
    spans += [(s, k, e, False) for s, k, e in loose_spans(text, base)]
    return base, [{"kind": KINDS[k], "start": s, "end": e, "strict": strict,
                   "votes": votes(text, s, k, e, strict), "shape": shape_of(text[s:e])}
                  for s, k, e, strict in sorted(spans)]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("strict", T.BooleanType()),
                     T.StructField("votes", T.StringType()), T.StructField("shape", T.StringType())])
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("strict", pa.bool_()), ("votes", pa.string()), ("shape", pa.string())]))


def _propose_column(column: pa.Array) -> list[pa.Array]:
    return [pa.array([_propose(t or "")[1] for t in column.to_pylist()], type=_SPAN_ARROW)]


def candidates(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and ``spans``: base and loose candidates with votes."""
    return map_text(docs, _propose_column, [T.StructField("spans", T.ArrayType(SPAN))], keep, text_col)


def reliabilities(patterns: dict[str, float], rounds: int = 60) -> dict[str, float]:
    """EM over vote patterns (Dawid and Skene): posterior of each pattern."""
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys])
    v = np.array([[{"1": 1, "0": 0, "-": -1}[c] for c in k] for k in keys])
    yes = (v == 1).sum(axis=1)
    no = (v == 0).sum(axis=1)
    q = (yes + 0.5) / (yes + no + 1.0)
    for _ in range(rounds):
        prior = ((q * n).sum() + 1) / (n.sum() + 2)
        odds = np.full(len(keys), np.log(prior / (1 - prior)))
        for j in range(v.shape[1]):
            voted = v[:, j] >= 0
            good, bad = q * n * voted, (1 - q) * n * voted
            # an accuracy prior of 4 to 1 keeps rare labelers honest
            hit = ((good * (v[:, j] == 1)).sum() + 4) / (good.sum() + 5)
            false = ((bad * (v[:, j] == 1)).sum() + 1) / (bad.sum() + 5)
            odds += np.where(v[:, j] == 1, np.log(hit / false), 0)
            odds += np.where(v[:, j] == 0, np.log((1 - hit) / (1 - false)), 0)
        q = 1 / (1 + np.exp(-odds.clip(-30, 30)))
    return dict(zip(keys, q.tolist(), strict=True))


def _encode(kind: str, vote: str, shape: str) -> np.ndarray:
    x = np.zeros(1 + len(KINDS) + 3 * len(KINDS) * 5 + 12)
    k = KINDS.index(kind)
    x[0] = x[1 + k] = 1
    for j, c in enumerate(vote):
        x[1 + len(KINDS) + (k * 5 + j) * 3 + "10-".index(c)] = 1
    x[-12 + int(shape[0])] = x[-4 + int(shape[1])] = 1
    return x


@dataclass
class SpanModel:
    """Logistic regression over votes and shape; keeps base spans."""

    weights: np.ndarray
    tags: dict[str, str] = field(default_factory=lambda: {k: f"[{k.upper()}]" for k in KINDS})

    def accepts(self, s: dict) -> bool:
        return bool(s["strict"]) or float(_encode(s["kind"], s["votes"], s["shape"]) @ self.weights) > 0

    def final(self, column: pa.Array) -> list[pa.Array]:
        """Accepted spans of a ``spans`` column as ``kind:start:end`` texts."""
        return [pa.array([[f"{s['kind']}:{s['start']}:{s['end']}" for s in spans or [] if self.accepts(s)]
                          for spans in column.to_pylist()], type=pa.list_(pa.string()))]

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        """Texts with every accepted span replaced by its kind's tag."""
        out = []
        for text in column.to_pylist():
            if text:
                done, parts = 0, []
                for s in _propose(text)[1]:
                    if s["end"] > done and self.accepts(s):
                        parts += [text[done: max(done, s["start"])], self.tags[s["kind"]]]
                        done = s["end"]
                text = "".join(parts) + text[done:]
            out.append(text)
        return [pa.array(out, type=pa.string())]


def fit(found: DataFrame, rounds: int = 400) -> SpanModel:
    """EM per kind and the span classifier, from all candidates' patterns."""
    rows = (found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.shape")
            .agg(F.count("*").alias("n")).orderBy("kind", "votes", "shape").collect())
    posterior: dict[tuple[str, str], float] = {}
    for kind in KINDS:
        patterns: dict[str, float] = {}
        for r in rows:
            if r["kind"] == kind:
                patterns[r["votes"]] = patterns.get(r["votes"], 0) + r["n"]
        if patterns:
            posterior.update({(kind, k): q for k, q in reliabilities(patterns).items()})
    size = len(_encode(KINDS[0], "-----", "00"))
    w = np.zeros(size)
    if rows:
        x = np.array([_encode(r["kind"], r["votes"], r["shape"]) for r in rows])
        y = np.array([posterior[r["kind"], r["votes"]] for r in rows])
        n = np.log1p([r["n"] for r in rows])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
            w -= (x.T @ (n * (p - y)) / n.sum() + 1e-3 * w) * 2
    return SpanModel(w)


def detect(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, ``base`` and ``spans``: arrays of ``kind:start:end``."""
    found = write_cut(candidates(docs, keep, text_col), "pii-candidates")
    model = fit(found)
    schema = T.StructType([*found.schema.fields, T.StructField("final", T.ArrayType(T.StringType()))])
    n = len(keep)

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *model.final(b.column(n))], names=schema.names)

    base = F.transform(F.filter("spans", lambda s: s["strict"]), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return found.mapInArrow(K.ends(accept), schema).select(*keep, base.alias("base"), F.col("final").alias("spans"))


def redact(docs: DataFrame, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and ``text`` with all accepted spans replaced."""
    model = fit(write_cut(candidates(docs, (), text_col), "pii-candidates"))
    return map_text(docs, model, [T.StructField("text", T.StringType())], keep, text_col)
