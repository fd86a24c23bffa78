"""Phrase mining against brute force over all phrases, and over several rounds."""

import random
import re
from collections import Counter, defaultdict

import pytest

from coview.llm import collocations, queries

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, lang string, text string, g long, w1 long, key string, a int"


def _rows():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(30)] + ["été", "日本", "O'Neil", "x" * 3000]
    fixed = ["new york city hall", "once upon a time", "a b", "b a", "red tape red tape red", "no no no no no"]
    texts = []
    for i in range(420):
        parts = [rnd.choice(words) for _ in range(rnd.randrange(4, 30))]
        for _ in range(rnd.randrange(0, 4)):
            parts.insert(rnd.randrange(len(parts)), rnd.choice(fixed[: 2 + i % 5]))
        text = "".join(w + rnd.choice([" ", " ", " ", "\t", "  ", ", ", "\n", ".\x0b", " ! "]) for w in parts)
        texts.append((text.upper() if i % 9 == 0 else text, ("en", "de", None, "", "en")[i % 5]))
    texts += [(None, "en"), ("", "en"), (" ,\n", "xx"), ("one", "one"), ("New York " * 4000, "long")]
    texts += [texts[0]] * 40                     # copies: phrases with equal counts, ties
    return [(i if i % 7 else None, lang, text, 1, 2, "clash", 3) for i, (text, lang) in enumerate(texts)]


def _brute(rows, top, least=30):
    counts, total = defaultdict(Counter), Counter()
    for _, lang, text, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        kept = []
        for p, a in found.items():
            if inside[p] and 100 * inside[p] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return set(out)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).cache()


@pytest.mark.parametrize("top,places", [(2000, None), (12, 2), (40, 5)])
def test_mine_against_brute_force(docs, top, places):
    got = [tuple(r) for r in collocations.mine(docs, top=top, places=places).collect()]
    want = _brute(_rows(), top)
    assert set(got) == want and len(got) == len(want)
    assert any(len(r[2].split()) == 4 for r in want) and len({r[0] for r in want}) >= 4


def test_small_filters_change_no_count(docs, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_BITS", 64)
    monkeypatch.setattr(collocations, "LEAST_BITS", 64)
    monkeypatch.setattr(collocations, "GATHER", 50)
    assert {tuple(r) for r in collocations.mine(docs, top=30, places=4).collect()} == _brute(_rows(), 30)


def test_query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_collocations(spark, str(tmp_path))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == _brute(_rows(), 2000)


def test_nothing_to_find(spark):
    schema = "lang string, text string"
    assert collocations.mine(spark.createDataFrame([], schema)).count() == 0
    assert collocations.mine(spark.createDataFrame([("en", "a b c"), (None, None)], schema)).count() == 0
