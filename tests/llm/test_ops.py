"""The training-data operators against brute force on small inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from coview.llm import decontaminate as D
from coview.llm import jaccard, langid, licenses, lm, packing, pii, quality, sharding, suffixes
from coview.llm.tables import tokenizer_path

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa la le de el mit license été straße".split()


def _texts(seed=3, n=40):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice(WORDS) + str(rnd.randrange(30)) for _ in range(rnd.randrange(8, 90)))
            for _ in range(n)]
    near = []
    for t in base[:12]:
        w = t.split()
        w[rnd.randrange(len(w))] = "changed"
        near.append(" ".join(w))
    extra = [None, "", "  \n", "One", "two words", base[0], base[0].upper(), base[1] + " " + base[2],
             "Released under the MIT License. mail a.b@mail.example.com or +1 (415) 555-0100 at 10.0.0.7",
             "x" * 5000, "日本語 the text", "4111 1111 1111 1111 and Apache License, Version 2.0; CC BY-NC 4.0"]
    return base + near + extra


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "de", "clash", 1, "x") for i, t in enumerate(_texts())]
    # further columns carry the names that operators use themselves
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, words string, start int, n string").cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def _shingles(t):
    w = re.findall(SPACED, (t or "").translate(UP))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _components(texts):
    sets = [_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def test_jaccard_join(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs).collect()}
    assert got == _components(_texts())


def test_jaccard_chain_of_near_copies(spark):
    """Members that link only through others, and a passage that all share."""
    words = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(0, 48, 2):
        w = list(words)
        w[i: i + 2] = [f"c{i}", f"d{i}"]
        texts.append(" ".join(w))
    texts += [f"{' '.join(words[:20])} " + " ".join(f"own{k}x{j}" for j in range(60)) for k in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()}
    assert got == _components(texts)


def test_sharding(docs, empty):
    rows = sharding.shard(docs, limit=3000).collect()
    assert len(rows) == docs.count()
    per = Counter()
    for r in rows:
        per[r["shard_id"]] += r["bytes"]
    assert all(b <= 3000 or sum(r["shard_id"] == s for r in rows) == 1 for s, b in per.items())
    assert all(r["shard_bytes"] == per[r["shard_id"]] for r in rows)
    assert sharding.shard(empty).count() == 0


def test_sharding_splits_a_hot_key(spark):
    df = spark.createDataFrame([(1, "x" * 100)] * 60, "doc_id long, text string")
    per = Counter(r["shard_id"] for r in sharding.shard(df, limit=1500).collect())
    assert sum(per.values()) == 60 and max(per.values()) <= 15


def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer
    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack(docs, path).collect()
    want = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(_texts())}
    got = {i: [] for i in want}
    used = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == len(got[r["doc_id"]]) and r["doc_tokens"] == len(want[r["doc_id"]])
        ids = [int.from_bytes(r["ids"][k:k + 4], "little") for k in range(0, len(r["ids"]), 4)]
        assert len(ids) == r["length"]
        got[r["doc_id"]] += ids
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert packing.pack(empty, path).count() == 0


def test_differencing_balances():
    import numpy as np
    rnd = np.random.default_rng(5)
    sizes = rnd.integers(1, 500, 400)
    window, top = packing.differencing(sizes, 20)
    sums = np.bincount(window, weights=sizes, minlength=20)
    assert sums.max() == top and sums.max() - sums.min() <= 5
    assert np.bincount(packing.deal(sizes, 600), weights=sizes).max() <= 600


def test_suffix_dedup(spark):
    rnd = random.Random(8)
    passage = "".join(rnd.choice("abcde ") for _ in range(180))
    texts = ["".join(rnd.choice("abcdefé ") for _ in range(rnd.randrange(0, 700))) for _ in range(30)]
    texts += [t[:50] + passage + t[50:] for t in texts[:12]] + [texts[5], texts[5], None, "", "ab" * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixes.deduplicate(df).collect()}
    seen = set()
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        lost = [False] * len(raw)
        for j in range(len(raw) - 99):
            if raw[j:j + 100] in seen:
                lost[j:j + 100] = [True] * 100
            seen.add(raw[j:j + 100])
        spans = sum(x and not (j and lost[j - 1]) for j, x in enumerate(lost))
        kept = bytes(b for b, x in zip(raw, lost, strict=True) if not x)
        assert got[i] == (len(raw), sum(lost), spans, hashlib.sha256(kept).hexdigest()), i


def test_blind_trie_numbers_equal_strings():
    rnd = random.Random(1)
    strings = [bytes(rnd.choice(b"ab") for _ in range(6)) for _ in range(200)]
    trie = suffixes.BlindTrie()
    leaf = [trie.insert(s) for s in strings]
    assert all((a == b) == (x == y) for a, x in zip(strings, leaf, strict=True)
               for b, y in zip(strings, leaf, strict=True))


def test_license_base_counts(docs, empty):
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for i, t in enumerate(_texts()):
        w = re.findall(ALNUM, (t or "").translate(UP))
        at, labels = [], set()
        for p, label in phrases.items():
            q = p.split()
            s = [j for j in range(len(w)) if w[j:j + len(q)] == q]
            at += s
            labels |= {label} if s else set()
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(w), len(at), min(at, default=None), max(at, default=None), sorted(labels))
        assert labels <= set(r["labels"]) and 0 <= r["score"] <= 1
    assert len(licenses.signature_rules()) >= 200
    assert licenses.scan(empty).count() == 0


def test_license_rules_resolve_overlaps(spark):
    text = "Licensed under the GNU General Public License, version 3. SPDX-License-Identifier: Apache-2.0"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert licenses.scan(df).first()["labels"] == ["apache-2", "gpl-3"]


def test_decontamination(spark, docs, empty):
    texts = _texts()
    items = [(7, texts[1]), (8, "two words"), (9, None), (None, texts[2]), (10, "never seen item"), (8, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"]: r for r in D.find_windows(docs, bench, slice_bytes=300).collect()}
    words = lambda t: re.findall(ALNUM, (t or "").translate(UP))
    for i, t in enumerate(texts):
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            v = words(text)
            k = min(10, len(v))
            wins = {tuple(v[j:j + k]) for j in range(len(v) - k + 1)} if k else set()
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in wins:
                    hit.update(range(j, j + k))
                    ids |= {str(item)} if item is not None else set()
        r = found[i]
        assert (r["n_words"], sum(x["after"] - x["first"] for x in r["runs"]), r["items"]) == (len(w), len(hit), sorted(ids))
    clean = {r["doc_id"]: r["text"] for r in D.remove_hits(D.find_windows(docs, bench)).collect()}
    assert clean[1].strip() == "" and clean[20] == texts[20]
    assert D.find_windows(empty, bench).count() == 0 and D.find_windows(docs, bench.limit(0)).count() == docs.count()


def test_language_held_out_accuracy(spark, docs, empty):
    from conftest import SF_SMALL
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.fit(table)
    rows = (langid.identify(table, model, keep=("doc_id", "lang")).where(langid.held_out()).collect())
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    odd = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    n = len(_texts()) - 12
    assert [odd[n + k]["lang_pred"] for k in range(3)] == ["und"] * 3 and odd[n]["score"] == 0
    assert langid.identify(docs, langid.fit(empty)).where("lang_pred <> 'und'").count() == 0


def test_quality_statistics_and_rules(spark, docs):
    got = {r["doc_id"]: r for r in quality.judge(docs, []).collect()}
    for i, t in enumerate(_texts()):
        t = t or ""
        w = re.findall(SPACED, t)
        c = Counter(tuple(w[j:j + 8]) for j in range(len(w) - 7))
        rep = {x for j in range(len(w) - 7) if c[tuple(w[j:j + 8])] > 1 for x in range(j, j + 8)}
        lines = [x for x in t.split("\n") if re.search(SPACED, x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep))
        assert r["kept"] == (not r["base_failed"])
    import numpy as np
    rnd = np.random.default_rng(2)
    x = rnd.random((600, 2))
    rules = quality.learn(x, ((x[:, 0] > 0.8) & (x[:, 1] <= 0.5)).astype(int), ["words", "word_length"])
    assert rules and rules[0].precision > 0.95
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(docs, labels) == []


def test_pii_base_spans(docs, empty):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    got = {r["doc_id"]: r for r in pii.detect(docs).collect()}
    for i, t in enumerate(_texts()):
        t, spans = t or "", []
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
            spans.append((m.start(), 0, m.end()))
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
            if all(int(x) <= 255 for x in m.group().split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub("[^0-9]", "", m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                spans.append((m.start(), 2, m.end()))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
            if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                spans.append((m.start(), 3, m.end()))
        want = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)]
        assert got[i]["base"] == want and set(want) <= set(got[i]["spans"])
    text = {r["doc_id"]: r["text"] for r in pii.redact(docs, ("doc_id",)).collect()}
    n = len(_texts()) - 12
    assert text[n] is None and "[EMAIL]" in text[n + 8] and "555-0100" not in text[n + 8]
    assert pii.detect(empty).count() == 0


@pytest.mark.parametrize("text", ["a@b.c%d@e.f", "@@a@b.c", "x" * 300 + "@", "a.b+c@d-e.f.g@h.i"])
def test_email_scan_equals_expression(text):
    want = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert list(pii.emails(text)) == want


def test_language_model(docs, empty):
    rows = {r["doc_id"]: r for r in lm.score(docs, parts=4).collect()}
    tokens = {i: re.findall(SPACED, (t or "").translate(UP)) + [None] for i, t in enumerate(_texts())}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = Counter(x for i, ts in tokens.items() if not held[i] for x in ts)
    n, v = sum(c.values()), len(c)
    for i, ts in tokens.items():
        r = rows[i]
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in ts)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[i], len(ts), sum(c[x] > 0 for x in ts), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    trained = [r for r in rows.values() if not r["held_out"]]
    assert sum(r["score"] for r in trained) > sum(r["base_score"] for r in trained)
    assert lm.score(empty, parts=4).count() == 0


def test_language_model_knows_the_word_before(spark):
    # "maple" and "apple" end in one byte and are as frequent: only a model of whole words tells what follows
    rows = [(i, "maple tree" if i % 2 else "apple pie") for i in range(400)]
    tests = ["maple tree", "maple pie", "apple pie", "apple tree", "tree maple"]
    held = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 10 == 0][:5]
    docs = spark.createDataFrame(rows + list(zip(held, tests)), "doc_id long, text string")
    one = {r["doc_id"]: r["score"] for r in lm.score(docs, parts=3).collect()}
    score = dict(zip(tests, (one[i] for i in held)))
    assert score["maple tree"] > score["maple pie"] + 1 and score["apple pie"] > score["apple tree"] + 1
    assert score["maple tree"] > score["tree maple"] + 1


def test_language_model_against_its_definition(spark):
    """All cells of one guest: seating has no choice, the chances follow by hand."""
    train = [i for i in range(50) if zlib.crc32(str(i).encode()) % 10][:3]
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    texts = ["a b", "c d", "d e f"]
    docs = spark.createDataFrame(list(zip(train + held, [*texts, "a d", "zz b"])), "doc_id long, text string")
    cells = Counter()
    for t in texts:
        words = ["", *t.split(), ""]
        cells.update(zip(words, words[1:]))
    assert set(cells.values()) == {1}
    guests, parents = Counter(u for u, _ in cells), Counter(w for _, w in cells)
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, parts=2).collect()}
    base, total = 1 / (len(parents) + 1), sum(parents.values())
    # a word of several guests in the parent (the end, "d") may sit at one table or more
    for i, t in zip(train + held, [*texts, "a d", "zz b"]):
        low = high = 0.0
        words = ["", *t.split(), ""]
        for u, w in zip(words, words[1:]):
            chances = []
            for tables in (len(parents), total):
                for own in ((1, parents[w]) if parents[w] else (0,)):
                    shared = (parents[w] - 0.7 * own + (20 + 0.7 * tables) * base) / (20 + total)
                    chances.append(((cells[u, w] - 0.6 * (cells[u, w] > 0)) + (5 + 0.6 * guests[u]) * shared) / (5 + guests[u]))
            low, high = low + math.log10(min(chances)), high + math.log10(max(chances))
        assert low - 1e-9 <= got[i] <= high + 1e-9


def test_language_model_writes_only_what_a_sweep_changes():
    import numpy as np
    word, context = np.array([0, 0, 2]), np.array([5, 9, 7], dtype=np.uint64)
    one = np.array([1, 1, 1])
    state = lm.State(3, word, context, np.array([2, 3, 4]), one, np.array([0, 2, 1]), one)
    whole, = state.row(lm.STATE).to_pylist()
    state.tables, state.parent_tables = np.array([2, 1, 3]), np.array([1, 2, 2])
    tables, = state.row(lm.TABLES).to_pylist()
    assert tables["b0"] is None and tables["b1"] is None and tables["b2"] is None and tables["b4"] is None
    again = lm.State.of([tables, whole])
    for name in ("word", "context", "count", "tables", "fixed", "parent_tables"):
        assert getattr(again, name).tolist() == getattr(state, name).tolist()
    assert lm.State.of([whole]).tables.tolist() == [1, 1, 1]
    many = np.array([0, 1, 255, 256, 70000, 2**32 - 1], dtype=np.uint32)
    assert lm._unpack_places(lm._pack_places(many)).tolist() == many.tolist()


def test_language_model_parts_follow_the_text():
    # parts write to each other: their number may not follow a large shuffle setting
    assert lm.part_count(50 << 20, 211) == 128 and lm.part_count(0, 8) == 32
    assert lm.part_count(1 << 36, 8) == 4096


def test_written_cut_leaves_no_shuffle_files(spark):
    from coview.session import write_cut
    files = lambda: {p for p in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
                     .getAllFiles().mkString("\n").split("\n") if "shuffle_" in p}
    before, setting = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    cut = write_cut(spark.range(1000).repartition(5, "id"), "cut")
    assert not files() - before and cut.where("id >= 0").count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_seating_is_a_restaurant_process():
    import numpy as np
    rng = np.random.default_rng(1)
    customers = np.full(4000, 30)
    tables = lm.seat(customers, np.full(4000, 2.0), 0.0, rng)
    assert tables.min() >= 1 and abs(tables.mean() - sum(2 / (2 + k) for k in range(30))) < 0.15
    assert lm.seat(np.array([0, 1]), np.ones(2), 0.5, rng).tolist() == [0, 1]


def test_jaccard_product_in_parts(monkeypatch):
    """Columns cut by batches, and one longer than a task holds."""
    rng = np.random.default_rng(3)
    cells = sorted({(int(s), int(d)) for s, d in zip(rng.integers(0, 12, 600), rng.integers(0, 90, 600), strict=True)}
                   | {(5, d) for d in range(90)} | {(s, s + 11 * i) for s in range(20, 30) for i in range(2 + s % 5)})
    rows = np.array([(s, d, 40 + d % 3, d // 4) for s, d in cells], dtype=np.int64)
    monkeypatch.setattr(jaccard, "HELD_ROWS", 32)
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in rows[i: i + 7].T], names=["s", "d", "n", "c"])
               for i in range(0, len(rows), 7)]
    out = [r for b in jaccard._multiply(iter(batches), 75, 8, False) for r in zip(*(c.to_pylist() for c in b.columns))]
    want, stay = {}, []
    for s in sorted(set(rows[:, 0].tolist())):
        column = rows[rows[:, 0] == s]
        assert len(set(column[:, 3])) > 1
        stay += [(s, int(d)) for d in column[:, 1]]
        pairs = [(a, b) for i, b in enumerate(column) for a in column[:i]] if len(column) <= 8 else [(column[0], b) for b in column]
        for a, b in pairs:
            if a[3] != b[3]:
                key = (int(min(a[1], b[1])), int(max(a[1], b[1])))
                want[key] = want.get(key, 0) + 1
    got = {}
    for a, b, _, _, overlap in out:
        if overlap:
            got[a, b] = got.get((a, b), 0) + overlap
    assert got == want
    assert sorted((a, b) for a, b, _, _, o in out if not o) == stay


def test_jaccard_nulls_and_repeats(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "a b c d e f", 1), (3, "a b c d e f", 1), (3, "a b c d e f", 1),
            (4, "A B c d e f", 2), (5, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shingle int")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()), key=str)
    assert got == [(1, 0, 1), (2, 0, 2), (3, 2, 3), (3, 2, 3), (4, 2, 3), (5, 1, 5), (None, 2, None)]
    assert jaccard.join(df.limit(0)).isEmpty()


def _copies(n, own, words=200, seed=5):
    """A page and ``n`` copies of it, each with ``own`` words of its own changed."""
    rnd = random.Random(seed)
    page = [f"w{i}" for i in range(words)]
    texts = []
    for i in range(n):
        w = list(page)
        for j in rnd.sample(range(2, words - 2, 5), own):
            w[j] = f"c{i}x{j}"
        texts.append(" ".join(w))
    return texts + [" ".join(page)]


def test_jaccard_hub_of_independent_copies(spark, monkeypatch):
    """Copies link only to their page; long columns are met in pairs of blocks."""
    monkeypatch.setattr(jaccard, "LONG_ROWS", 50, raising=False)
    texts = _copies(150, 5)
    assert len({c for _, c in _components(texts).values()}) == 1
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()}
    assert got == _components(texts)


def test_jaccard_frequent_over_all_tasks(spark):
    # one document of each task holds the passage: it stands out in no task, but over all
    rows = [(i, f"one two three four five {i} a{i} b{i} c{i} d{i}") for i in range(64)]
    source = spark.createDataFrame(rows, "doc_id long, text string").repartition(64, "doc_id")
    ranks = jaccard.frequency_ranks(source, 5)
    import pyarrow as pa
    block, = jaccard.K.text_blocks(pa.array(["one two three four five"]))
    values, _ = jaccard.shingle_sets(block)
    assert ranks[int(values[0]) & (jaccard.RANK_SLOTS - 1)] == 7
    assert (ranks > 0).sum() == 1


def test_jaccard_pair_that_meets_in_few_rounds(spark):
    """P and Q share only columns that a template's many copies lead; Q links to P alone."""
    rnd = random.Random(9)
    page = [f"w{i}" for i in range(400)]

    def changed(words, places, tag):
        w = list(words)
        for j in places:
            w[j] = f"{tag}x{j}"
        return w

    texts = [page] + [changed(page, [rnd.randrange(5, 395)], f"n{i}") for i in range(80)]
    p = changed(page, [100, 200], "p")
    texts = [" ".join(t) for t in [*texts, p, changed(p, range(10, 400, 39)[:10], "q")]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()}
    assert got == _components(texts) and got[82][1] == 0


def test_license_gate_passes_what_rules_match(spark):
    want = {"Released under Apache 2.0": "apache-2", "distributed under the BSD 3-Clause": "bsd-3", "released under MIT": "mit",
            "provided under MPL 2.0": "mpl-2", "do WTFPL what": "wtfpl", "CC-0": "cc0", "in the public-domain now": "public-domain",
            "All rights\nreserved": "proprietary", "Creative\nCommons  Attribution": "cc-by", "the common house": None}
    df = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(df).collect()}
    assert [got[i] for i in range(len(want))] == [[x] if x else [] for x in want.values()]


def test_ended_tasks_give_back_their_memory(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from coview.llm import kernel as K
    calls = []
    monkeypatch.setattr(K, "give_back", lambda: calls.append(len(calls)))
    assert list(K.ends(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3] and len(calls) == 1
    broken = K.ends(lambda batches: (1 // b for b in batches))
    with pytest.raises(ZeroDivisionError):
        list(broken(iter([1, 0])))
    assert K.group_ends(lambda t: t + 1)(1) == 2 and K.group_ends(lambda a, b: a + b, 2)(1, 2) == 3 and len(calls) == 4
    monkeypatch.undo()
    K.prefix_hash(np.zeros(100, dtype=np.uint8))
    pa.array(np.arange(4_000_000)).cast(pa.string())
    K.give_back()
    # the powers of the hash base, 16 MB of every idle worker, go too
    assert len(K._POWERS.up) == 1 and K.prefix_hash(np.ones(3, dtype=np.uint8)).tolist()[1] == 2


def test_language_model_batch_follows_its_blocks():
    blocks = list(lm.K.text_blocks(pa.array(["a b", "", "b a", None, "a"]), 2))
    assert len(blocks) > 1
    parts = [lm.tokens(b) for b in blocks]
    import numpy as np
    assert lm._contexts(np.concatenate([p[0] for p in parts])).tolist() == np.concatenate([p[1] for p in parts]).tolist()


def test_jaccard_sketches_of_linked_sets_are_near():
    rnd = np.random.default_rng(5)
    for _ in range(200):
        n = int(rnd.integers(2, 700))
        x = rnd.integers(0, 1 << 62, n).astype(np.uint64)
        y = np.concatenate([x[: int(rnd.integers(n // 2, n + 1))], rnd.integers(0, 1 << 62, int(rnd.integers(0, n // 3 + 1))).astype(np.uint64)])
        a, b = (np.frombuffer(s, dtype=np.uint8)[None] for s in jaccard.sketches(np.concatenate([x, y]), np.array([len(x), len(y)])))
        both = len(np.intersect1d(x, y))
        if both * 100 >= (len(x) + len(y) - both) * 75:
            assert jaccard._near(a, b, np.array([len(x) + len(y)]), 75)[0]


def test_jaccard_last_pass_returns_near_pairs_only(spark):
    # 300 documents share 2 of 3 shingles: none is linked, and no pair leaves a task
    rnd = np.random.default_rng(9)
    passage = rnd.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = [np.concatenate([passage, rnd.integers(0, 1 << 62, 30).astype(np.uint64)]) for _ in range(300)]
    near = sets[0].copy()
    near[-1] += np.uint64(1)
    # an id with two texts of one size: any of its sketches may be the near one
    sets += [near, sets[5]]
    ids = [*range(300), 300, 300]
    sketch = list(jaccard.sketches(np.concatenate(sets), np.full(len(sets), 90)))
    cells = pa.RecordBatch.from_arrays([pa.array([7] * 302), pa.array(ids), pa.array([90] * 302), pa.array(ids),
                                        pa.array([-1] * 302), pa.array(sketch, pa.binary())], names=list("kdncsx"))
    got = {r[:4] for b in jaccard._exhaust(iter([cells.slice(0, 100), cells.slice(100)]), 75) for r in zip(*(c.to_pylist() for c in b.columns))}
    assert {(0, 300, 90, 90), (5, 300, 90, 90)} <= got and len(got) < 300
    # only columns that span components reach that pass
    rows = spark.createDataFrame([(1, 10, 5), (1, 11, 5), (2, 10, 5), (2, 12, 5)], "shingle long, doc_id long, n long")
    comp = spark.createDataFrame([(10, 10), (11, 10)], "doc_id long, comp long")
    assert {r["shingle"] for r in jaccard.spanning(rows, comp).collect()} == {2}


def _met(key, rows):
    """What a task returns for one column of rows (doc, sketch, columns named)."""
    doc, sketch, cols = zip(*rows, strict=True)
    m = len(doc)
    cells = pa.RecordBatch.from_arrays(
        [pa.array([key] * m), pa.array(doc), pa.array([90] * m), pa.array(doc), pa.array([-1] * m), pa.array(sketch, pa.binary()),
         pa.array([key] * m), pa.array(cols, pa.list_(pa.int32()))], names=list("kdncsxlw"))
    return [r[:4] for b in jaccard._exhaust(iter([cells.slice(0, 2), cells.slice(2)]), 75) for r in zip(*(c.to_pylist() for c in b.columns))]


def test_jaccard_last_pass_returns_a_pair_from_one_column():
    rnd = np.random.default_rng(3)
    passage = rnd.integers(0, 1 << 62, 88).astype(np.uint64)
    sets = [np.concatenate([passage, rnd.integers(0, 1 << 62, 2).astype(np.uint64)]) for _ in range(4)]
    sketch = list(jaccard.sketches(np.concatenate(sets), np.full(4, 90)))
    # 20 columns of all of them, negative hashes too: each pair leaves one of 20 tasks
    columns = list(range(-10, 10))
    rows = [(d, sketch[d], columns) for d in range(4)]
    got = [p for key in columns for p in _met(key, rows)]
    assert sorted(got) == [(a, b, 90, 90) for a in range(4) for b in range(a + 1, 4)]
    # lists that end early and name no column of both: no pair is lost
    cut = [(d, sketch[d], [-20 - d]) for d in range(4)]
    assert {p for key in columns for p in _met(key, cut)} == set(got)


def test_jaccard_pairs_of_too_few_columns_are_discarded(spark):
    # sets of 90 that link share 11 leading columns at least
    sketch = next(iter(jaccard.sketches(np.arange(90, dtype=np.uint64), np.array([90]))))
    rows = spark.createDataFrame([(c, d, 90, d) for d, most in ((1, 11), (2, 11), (3, 10)) for c in range(most)],
                                 "shingle long, doc_id long, n long, comp long")
    found = spark.createDataFrame([(d, 90, sketch) for d in (1, 2, 3)], "doc_id long, n long, sketch binary")
    none = spark.createDataFrame([], "shingle long, held long")
    got = jaccard.last_pass(jaccard.open_columns(rows), none, found, 75).collect()
    assert [tuple(r) for r in got] == [(1, 2, 90, 90)]


def test_jaccard_long_rows_name_part_of_their_columns(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_COLUMNS", 1)
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", 1)
    texts = _copies(40, 5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()}
    assert got == _components(texts)


def test_jaccard_frequency_bound_grows_slower_than_the_input():
    assert jaccard.frequent_from(0.5) == 8 and jaccard.frequent_from(1) == 8
    assert jaccard.frequent_from(100) <= 200 and jaccard.frequent_from(10000) <= 11000
