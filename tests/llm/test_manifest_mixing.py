"""Merkle manifest and mixing against brute force, down to the queries' digests."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from coview.llm import merkle, mixing, queries

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, at int, place string, coarse int"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _rows():
    rows = []
    for i in range(700):
        lang = "en" if i < 580 else ("de", "fr", "top", "", "日本")[i % 5] if i < 660 else None
        text = f"Text {i} of Some words " * (i % 7) + ("ÄÖ É\t\n x" if i % 11 == 0 else "")
        rows.append((i * 3, f"src{i % 6}" if i % 13 else None, lang, len(text), text if i % 17 else None))
    rows.append((5000, "lone", "xx", 3, "One Leaf"))              # a lone leaf
    rows += [(21, "src1", "en", 1, "Tie b"), (21, "src1", "en", 1, "Tie a"), (21, "src1", "en", 1, "Tie a")]
    rows.append((None, None, "en", None, "No Id"))
    rows += [(6000, "long", "de", 1, "Word " * 40000), (6001, "empty", "de", 0, "")]
    return [(*r, "clash", 1, "clash", 2) for r in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("manifest")
    spark.createDataFrame(_rows(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    return str(path)


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def _path(levels, i):
    steps = []
    for level in levels[:-1]:
        first = i - i % 8
        steps.append((level[first:i], level[i + 1:first + 8]))
        i //= 8
    return steps


def _merkle(rows):
    by = defaultdict(list)
    for doc_id, source, lang, n, text in (r[:5] for r in rows):
        leaf = _h(*map(_field, (doc_id, source, lang, n, text)))
        other = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            other = _h(*map(_field, (doc_id, source, lang, n, text and text.translate(UP))))
        by[lang].append((doc_id is not None, doc_id, leaf, other))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: _levels([x[2] for x in by[lang].sort() or by[lang]]) for lang in langs}
    top = _levels([trees[lang][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        for i, (_, doc_id, leaf, other) in enumerate(by[lang]):
            steps = _path(trees[lang], i) + _path(top, place)
            x = other
            for left, right in steps:
                x = _h(*left, x, *right)
            proof = _h(*(y for left, right in steps for y in (*left, *right)))
            out.append((doc_id, leaf, trees[lang][-1][0], top[-1][0], proof, x, x == top[-1][0]))
    return Counter(out)


def test_manifest_query_against_brute_force(spark, folder):
    got = queries.op12_merkle_manifest(spark, folder)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = _merkle(_rows())
    assert Counter(map(tuple, got.collect())) == want
    assert 0 < sum(n for r, n in want.items() if not r[-1]) < len(want)


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame(_rows()[:1], SCHEMA)
    row = merkle.manifest(one).collect()[0]
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof"] == []
    assert merkle.manifest(one.where("false")).count() == 0


def test_manifest_of_many_groups(spark):
    rows = [(i, "s", f"l{i % 90:02d}", 1, "t") for i in range(200)]
    got = merkle.manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    want = {(r[0], r[1], r[2], r[3]) for r in _merkle([(*r, 0) for r in rows])}
    assert {(r["doc_id"], r["leaf"], r["subroot"], r["root"]) for r in got.collect()} == want


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(sizes, share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, free, out = share * sum(sizes.values()), set(order), {}
    while True:
        left = total - sum(out.values())
        w = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / w > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / w for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        free -= over


def test_mix_query_against_water_filling(spark, folder):
    rows = _rows()
    sizes = Counter()
    for r in rows:
        sizes[r[1]] += _size(r[4])
    sizes.update({r[1]: 0 for r in rows})
    want = _targets(sizes)
    got = queries.op13_mixing(spark, folder)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    again = Counter(map(tuple, got.collect()))
    assert again == Counter(map(tuple, queries.op13_mixing(spark, folder).collect()))
    mixed = mixing.mix(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    assert Counter((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in mixed) == again
    assert len(mixed) == len(rows)
    taken = Counter()
    for r in mixed:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-12, abs_tol=1e-9)
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == math.floor(want[s] + 1e-9) for s in sizes)
    assert Counter((r["doc_id"], r["size"]) for r in mixed) == Counter((r[0], _size(r[4])) for r in rows)
    assert any(want[s] == 2 * sizes[s] > 0 for s in sizes) and any(0 < want[s] < 2 * sizes[s] for s in sizes)


def test_mix_repeats_texts(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", " ".join(f"w{i}.{j}" for j in range(i % 9))) for i in range(60)],
                                 "doc_id long, source string, text string")
    mixed = mixing.mix(docs, seed=4)
    words = {r["doc_id"]: r["text"] for r in docs.collect()}
    taken = {r["doc_id"]: r["taken"] for r in mixed.collect()}
    got = Counter()
    for r in mixing.repeat(docs, mixed).collect():
        assert words[r["doc_id"]].startswith(r["text"].strip())
        got[r["doc_id"]] += _size(r["text"])
    assert {k: v for k, v in taken.items() if v} == dict(got)


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(none).count() == 0
    silent = spark.createDataFrame([(1, "a", None), (2, None, " \n")], "doc_id long, source string, text string")
    assert {(r["doc_id"], r["size"], r["target"], r["taken"]) for r in mixing.mix(silent).collect()} == {
        (1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_all_sources_clamped(spark):
    docs = spark.createDataFrame([(1, "a", "x y"), (2, "b", "z")], "doc_id long, source string, text string")
    got = {r["doc_id"]: (r["target"], r["taken"]) for r in mixing.mix(docs, share=3.0).collect()}
    assert got == {1: (4.0, 4), 2: (2.0, 2)}
