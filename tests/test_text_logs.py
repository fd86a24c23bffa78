import os

from conftest import DATA
from coview.functions.scalars import drop_first_field, fixed5, java_split, text_lines
from coview.operators.logs import log_rollup
from coview.operators.text import word_count
from coview.sources.readers import read_text


def test_java_split_table(spark):
    cases = [("a b", ["a", "b"]), ("a  b", ["a", "", "b"]), ("a b  ", ["a", "b"]),
             (" a", ["", "a"]), ("   ", []), ("", [""])]
    df = spark.createDataFrame([(c,) for c, _ in cases], "s string")
    got = [r[0] for r in df.select(java_split("s", " ")).collect()]
    assert got == [e for _, e in cases]


def test_text_lines_breaks(spark):
    df = spark.createDataFrame([("a\r\nb\rc\nd",), ("x\n",), ("x\n\n",), ("",)], "t string")
    got = [r[0] for r in df.select(text_lines("t")).collect()]
    assert got == [["a", "b", "c", "d"], ["x"], ["x", ""], []]


def test_word_count_behavior_sample(spark):
    lines = read_text(spark, os.path.join(DATA, "behaviour_sample.csv")).withColumnRenamed("value", "line")
    got = {r["word"]: r["n"] for r in word_count(lines).collect()}
    assert sum(got.values()) == 40
    repeated = {w: n for w, n in got.items() if n > 1}
    assert repeated == {"06": 4, "07": 4, "08": 3, "09": 3}


def test_word_totals_add_up(spark):
    docs = spark.createDataFrame([("a b a\nb  c",), ("a",)], "text string")
    from coview.operators.text import lines_of
    wc = {r["word"]: r["n"] for r in word_count(lines_of(docs)).collect()}
    assert wc == {"a": 3, "b": 2, "": 1, "c": 1}


def test_fixed5_and_drop_first(spark):
    df = spark.createDataFrame([(0.5773502691896258, "a,b,c"), (1.0, "x")], "v double, s string")
    got = df.select(fixed5("v"), drop_first_field("s")).collect()
    assert [tuple(r) for r in got] == [("0.57735", "b,c"), ("1.00000", "")]


LOG_LINES = [
    '192.0.2.7 - "ADA" [03/May/2022:09:15:00 +0000] "GET /shelf/atlas HTTP/1.1" 200 1200 "-" "probe/1"',
    '192.0.2.7 - "ADA" [03/May/2022:09:16:30 +0000] "GET /shelf/atlas HTTP/1.1" 200 34 "-" "probe/1"',
]


def test_log_rollup_builtin_lines(spark):
    df = spark.createDataFrame([(x,) for x in LOG_LINES], "value string")
    got = [tuple(r) for r in log_rollup(df).collect()]
    assert got == [("192.0.2.7", '"ADA"', "GET /shelf/atlas HTTP/1.1", 2, 1234)]


def test_log_rollup_null_key_cases(spark):
    extra = [
        "this line does not match",
        '1.2.3.4 - - [03/May/2022:10:00:00 +0000] "GET /x HTTP/1.1" 200 77 "r" "a"',
        '1.2.3.4 - "BOB" [03/May/2022:10:00:00 +0000] "GET /y HTTP/1.1" 200 - "r" "a"',
    ]
    df = spark.createDataFrame([(x,) for x in LOG_LINES + extra], "value string")
    got = {(r["ip"], r["user"], r["request"]): (r["n"], r["bytes"]) for r in log_rollup(df).collect()}
    assert got[(None, None, None)] == (2, 77)
    assert got[("1.2.3.4", '"BOB"', "GET /y HTTP/1.1")] == (1, 0)
    assert got[("192.0.2.7", '"ADA"', "GET /shelf/atlas HTTP/1.1")] == (2, 1234)


def test_today_ds(spark):
    import datetime
    from coview.functions.scalars import today_ds
    got = spark.range(1).select(today_ds()).first()[0]
    assert got == datetime.datetime.now(datetime.timezone.utc).date().isoformat()
