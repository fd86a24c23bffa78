"""Keys and numbers that are proposed whatever their length."""

import random
import string

from coview.llm import pii


def _secrets(text):
    base, spans = pii._propose(text)
    return [text[s["start"]: s["end"]] for s in spans if s["kind"] == "secret"]


def test_keys_of_any_length_are_proposed():
    rnd = random.Random(1)
    for n in (20, 41, 128, 129, 180, 5000):
        key = "".join(rnd.choice(string.ascii_letters) for _ in range(n - 1)) + "7"
        assert _secrets(f"token: {key}, and more") == [key]
    assert _secrets("a" * 50 + "1" * 10) == ["a" * 50 + "1" * 10]
    assert _secrets("k" * 19) == [] and _secrets("k" * 300) == [] and _secrets("x_" * 15) == []


def test_a_long_key_is_redacted_among_others(spark):
    rnd = random.Random(2)
    keys = ["".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(n)) for n in [40] * 30 + [180] * 10]
    rows = [(i, f"the api token: {k} was sent") for i, k in enumerate(keys)] + [(100 + i, "plain words only") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs, ("doc_id",)).collect()}
    assert all(k not in got[i] for i, k in enumerate(keys))
    assert all(got[100 + i] == "plain words only" for i in range(30))


def test_ten_digit_numbers_by_rule():
    for number, vote in (("415-555-0100", "1"), ("212 867 5309", "1"), ("115-867-5309", "-"), ("212-167-5309", "-")):
        assert pii.votes(number, 0, 3, len(number), False)[1] == vote
