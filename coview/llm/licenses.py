"""License scans by ordered signature rules, as DataFrame expressions only.

Texts are normalised to words. A document is settled by one test if no rule can
match it: each form asks for a word that begins with "licen", for a verb of form 2
beside a name's first word, or for a name that speaks for itself. Every word that begins some license name
is an anchor; the rules of that name (a few hundred in all: each name in four
forms) are matched on the words around the anchor. Detections are intervals of
words: one that lies inside another is dropped, of equal ones the rule with the
better priority stays, and one that only overlaps a better one goes as well.
The fixed base phrases are counted apart and their labels always stay.

Cases: a null or empty text has no words, no places and no labels; repeated
rows are scanned alike; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label and the license's name over normalised words; the first word is plain,
# as it is the keyword that gates the rule.
NAMES = (
    ("mit", "mit"), ("mit-0", "mit no attribution"), ("x11", "x11"), ("isc", "isc"),
    ("apache-1.1", "apache(?: software)?(?: license)?(?: version)? 1 1"),
    ("apache-2", "apache(?: software)?(?: licen[sc]e)?(?: version)? 2(?: 0)?"),
    ("bsd-2", "bsd 2 clause"), ("bsd-2", "simplified bsd"), ("bsd-2", "freebsd"),
    ("bsd-3", "bsd 3 clause"), ("bsd-3", "new bsd"), ("bsd-3", "revised bsd"), ("bsd-4", "bsd 4 clause"),
    ("0bsd", "0bsd"), ("0bsd", "zero clause bsd"), ("bsd", "bsd(?: style)?"),
    ("gpl-1", "gnu general public licen[sc]e(?: version| v)? 1"),
    ("gpl-2", "gnu general public licen[sc]e(?: version| v)? 2"), ("gpl-2", "gpl(?: version| v)? 2"),
    ("gpl-2", "gplv2"), ("gpl-3", "gnu general public licen[sc]e(?: version| v)? 3"),
    ("gpl-3", "gpl(?: version| v)? 3"), ("gpl-3", "gplv3"), ("gpl", "gnu general public"), ("gpl", "gnu gpl"),
    ("lgpl-2.1", "gnu lesser general public licen[sc]e(?: version| v)? 2 1"), ("lgpl-2.1", "lgpl(?: v)? 2 1"),
    ("lgpl-3", "gnu lesser general public licen[sc]e(?: version| v)? 3"), ("lgpl-3", "lgplv3"),
    ("lgpl", "gnu lesser general public"), ("lgpl", "gnu library general public"), ("lgpl", "lgpl"),
    ("agpl-3", "gnu affero general public(?: licen[sc]e)?(?: version| v)? 3"), ("agpl-3", "agplv3"),
    ("agpl", "affero general public"), ("gfdl", "gnu free documentation"), ("mpl-1.1", "mozilla public licen[sc]e(?: version)? 1 1"),
    ("mpl-2", "mozilla public licen[sc]e(?: version)? 2(?: 0)?"), ("mpl", "mozilla public"), ("mpl-2", "mpl 2 0"),
    ("epl-1", "eclipse public licen[sc]e(?: version| v)? 1"), ("epl-2", "eclipse public licen[sc]e(?: version| v)? 2"),
    ("epl", "eclipse public"), ("cddl", "common development and distribution"), ("cpl", "common public"),
    ("eupl", "european union public"), ("artistic-2", "artistic licen[sc]e 2"), ("artistic", "artistic"),
    ("zlib", "zlib"), ("boost", "boost software"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"),
    ("postgresql", "postgresql"), ("openssl", "openssl"), ("python", "python software foundation"),
    ("ofl", "sil open font"), ("odbl", "open database"), ("ms-pl", "microsoft public"), ("ms-rl", "microsoft reciprocal"),
    ("qpl", "q public"), ("ncsa", "university of illinois"), ("afl", "academic free"), ("osl", "open software"),
    ("cc0", "cc0"), ("cc0", "cc 0"), ("cc0", "creative commons zero"),
    ("cc-by-nc-nd", "cc by nc nd"), ("cc-by-nc-sa", "cc by nc sa"), ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"), ("cc-by-sa", "cc by sa"), ("cc-by", "cc by"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "creative commons attribution non ?commercial"), ("cc-by-nd", "creative commons attribution no ?derivatives"),
    ("cc-by-sa", "creative commons attribution share ?alike"), ("cc-by", "creative commons attribution"),
    ("public-domain", "public domain"), ("proprietary", "all rights reserved"),
)

# How a name may stand in a text: priority, confidence, what precedes the name
# (the bar marks the anchor) and what follows it.
FORMS = (
    (1, 0.99, r"spdx licen[sc]e identifier \| ", r"(?: only| or later)?"),
    (2, 0.95, r"(?:released|licen[sc]ed|distributed|available|published|provided|covered|issued)"
              r"(?: by| to you)? (?:under|with|by)(?: the)?(?: terms of)?(?: the)? \| |"
              r"(?:released|licen[sc]ed) under \| ", r"(?: public)?(?: licen[sc]e)?(?: version)?(?: [0-9]+){0,2}"),
    (3, 0.85, r"licen[sc]e(?: is| type)?(?: the)? \| ", r"(?: licen[sc]e)?(?: [0-9]+){0,2}"),
    (4, 0.7, r"\| ", r"(?: public)? licen[sc]e(?: version)?(?: [0-9]+){0,2}"),
)
#: names that speak for themselves: a bare mention counts
_BARE = {"public-domain", "proprietary", "unlicense", "wtfpl", "cc0", "cc-by", "cc-by-sa", "cc-by-nd", "cc-by-nc",
         "cc-by-nc-sa", "cc-by-nc-nd", "gpl", "lgpl", "agpl", "gpl-2", "gpl-3", "lgpl-3", "agpl-3"}


def signature_rules() -> list[tuple[str, str, str, int, float, int]]:
    """(keyword, label, expression, priority, confidence, order)."""
    rules = []
    for label, name in NAMES:
        for priority, confidence, before, after in FORMS:
            if priority == 4 and label in _BARE:
                after = f"(?:{after})?"
            rules.append((name.split(" ")[0].split("(")[0], label, f"(?:{before}){name}{after}(?= )",
                          priority, confidence, len(rules)))
    return rules


def gate_expression() -> str:
    """What a normalised text without a word in "licen" holds if a rule matches."""
    verbs = FORMS[1][2].split(r"\|")[0]
    first = "|".join(sorted({r[0] for r in signature_rules()}))
    bare = "|".join(name for label, name in NAMES if label in _BARE)
    return f" (?:{verbs}(?:{first})|(?:{bare}))(?= )"


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", reach: int = 10) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels and labels
    (arrays), score."""
    rules = signature_rules()
    keywords = sorted({r[0] for r in rules})
    table = F.array(*[F.struct(*(F.lit(v).alias(n) for n, v in
                                 zip(("key", "label", "expr", "priority", "confidence", "order"), r, strict=True)))
                      for r in rules])
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _LOWER)
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    d = d.select("doc_id", F.regexp_count("t", F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")).cast("long").alias("n_words"),
                 F.concat(F.lit(" "), F.trim(F.regexp_replace("t", _NOT_WORD, " ")), F.lit(" ")).alias("norm"))
    gate = F.contains("norm", F.lit(" licen")) | F.col("norm").rlike(gate_expression())
    d = d.withColumn("norm", F.when(gate, F.col("norm")))
    # base phrases: the text between their places tells where they stand
    for i, phrase in enumerate(BASE):
        d = d.withColumn(f"cut{i}", F.when(F.contains("norm", F.lit(f" {phrase} ")),
                                           F.split("norm", f" {phrase}(?= )")))
    firsts, lasts, counts, labels = [], [], [], []
    for i, (phrase, label) in enumerate(BASE.items()):
        cut, k = F.col(f"cut{i}"), len(phrase.split())
        firsts.append(_spaces(F.element_at(cut, 1)).cast("long"))
        lasts.append(F.col("n_words") - k - _spaces(F.element_at(cut, -1)) + 1)
        counts.append(F.coalesce(F.size(cut) - 1, F.lit(0)))
        labels.append(F.when(cut.isNotNull(), F.lit(label)))
    d = d.withColumns({
        "n_base": sum(counts[1:], counts[0]).cast("long"),
        "first_word": F.least(*firsts), "last_word": F.greatest(*lasts).cast("long"),
        "base_labels": F.array_compact(F.array(*labels)),
        "words": F.when(F.col("norm").isNotNull(), F.split(F.trim("norm"), " "))})
    d = d.withColumn("anchors", F.filter(F.transform("words", lambda w, i: F.when(w.isin(keywords), i)),
                                         lambda i: i.isNotNull()))
    around = lambda p: F.concat(
        F.lit(" "), F.array_join(F.slice("words", F.greatest(p - (reach - 1), F.lit(1)),
                                         F.least(p, F.lit(reach))), " "),
        F.lit(" | "), F.array_join(F.slice("words", p + 1, F.lit(2 * reach)), " "), F.lit(" "))
    sites = F.transform("anchors", lambda p: F.struct(p.alias("p"), F.element_at("words", p + 1).alias("key"),
                                                      around(p).alias("text")))
    d = d.withColumn("sites", sites)
    hits = F.flatten(F.transform("sites", lambda s: F.transform(
        F.filter(table, lambda r: r["key"] == s["key"]),
        lambda r: F.struct(s["p"].alias("p"), F.regexp_substr(s["text"], F.concat(F.lit("(?<= )"), r["expr"])).alias("m"),
                           r["priority"].alias("priority"), r["order"].alias("order"), r["label"].alias("label"),
                           r["confidence"].alias("confidence")))))
    d = d.withColumn("hits", F.filter(hits, lambda h: h["m"].isNotNull()))
    spans = F.transform("hits", lambda h: F.struct(
        (h["p"] - _spaces(F.substring_index(h["m"], "|", 1))).alias("start"),
        (-(h["p"] + _spaces(F.substring_index(h["m"], "|", -1)))).alias("minus_end"),
        h["priority"].alias("priority"), h["order"].alias("order"),
        h["label"].alias("label"), h["confidence"].alias("confidence")))
    d = d.withColumn("spans", F.sort_array(spans))
    none = F.struct(F.lit(0).alias("end"), F.lit(9).alias("priority"),
                    F.array().cast("array<string>").alias("labels"), F.lit(0.0).cast("double").alias("best"))

    def step(a: Column, s: Column) -> Column:
        end = -s["minus_end"]
        dropped = (end <= a["end"]) | ((s["start"] < a["end"]) & (s["priority"] > a["priority"]))
        taken = F.struct(F.greatest(end, a["end"]).alias("end"), s["priority"].alias("priority"),
                         F.array_union(a["labels"], F.array(s["label"])).alias("labels"),
                         F.greatest(a["best"], s["confidence"].cast("double")).alias("best"))
        return F.when(dropped, a).otherwise(taken)

    d = d.withColumn("found", F.aggregate("spans", none, step))
    own = F.coalesce(F.col("found.labels"), F.array().cast("array<string>"))
    base = F.size("base_labels") > 0
    return d.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    F.sort_array("base_labels").alias("base_labels"),
                    F.sort_array(F.array_union("base_labels", own)).alias("labels"),
                    F.greatest(F.coalesce(F.col("found.best"), F.lit(0.0)),
                               F.when(base, F.lit(0.95)).otherwise(F.lit(0.0))).alias("score"))
