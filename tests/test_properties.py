"""Property tests: Java-compatible split against a direct model of Java's rule."""

from hypothesis import given, settings, strategies as st


def java_split_model(s: str, sep: str) -> list[str]:
    # String.split(sep) with limit 0: split on every occurrence, then drop
    # trailing empty strings; a string with no separator is itself.
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ,\t", max_size=12), min_size=1, max_size=20))
def test_java_split_matches_model(spark, lines):
    from coview.functions.scalars import java_split
    df = spark.createDataFrame([(x,) for x in lines], "s string")
    got = [r[0] for r in df.select(java_split("s", " ")).collect()]
    assert got == [java_split_model(x, " ") for x in lines]
    got_c = [r[0] for r in df.select(java_split("s", ",")).collect()]
    assert got_c == [java_split_model(x, ",") for x in lines]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab\r\n", max_size=10), min_size=1, max_size=15))
def test_text_lines_match_line_reader(spark, texts):
    import io
    from coview.functions.scalars import text_lines
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    got = [r[0] for r in df.select(text_lines("t")).collect()]
    # io.StringIO with newline=None splits on \n, \r and \r\n like a line reader.
    want = [[ln.rstrip("\r\n") for ln in io.StringIO(x, newline=None)] for x in texts]
    assert got == want


# --- brute force on random small inputs ------------------------------------------------

edge_lists = st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=25)


def closure_model(edges):
    out = set(edges)
    while True:
        more = {(a, d) for (a, b) in out for (c, d) in edges if b == c} - out
        if not more:
            return out
        out |= more


def pagerank_model(edges, rounds):
    links = {}
    for a, b in set(edges):
        links.setdefault(a, []).append(b)
    ranks = {a: 1.0 for a in links}
    for _ in range(rounds):
        contrib = {}
        for a, outs in links.items():
            if a in ranks:
                for b in outs:
                    contrib[b] = contrib.get(b, 0.0) + ranks[a] / len(outs)
        ranks = {b: 0.15 + s * 0.85 for b, s in contrib.items()}
    return ranks


@settings(max_examples=8, deadline=None)
@given(edge_lists)
def test_closure_matches_brute_force(spark, edges):
    from coview.operators.graph import transitive_closure
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {tuple(r) for r in transitive_closure(df).collect()}
    assert got == closure_model(edges)


@settings(max_examples=8, deadline=None)
@given(edge_lists, st.integers(0, 4))
def test_pagerank_matches_brute_force(spark, edges, rounds):
    import math
    from coview.operators.graph import pagerank
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["rank"] for r in pagerank(df, rounds, links_per_salt=2).collect()}
    want = pagerank_model(edges, rounds)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def similarity_model(events, cap, k):
    import math
    n_u, c = {}, {}
    for u, i in events:
        n_u[u] = n_u.get(u, 0) + 1
        c[(u, i)] = c.get((u, i), 0) + 1
    items_of = {}
    for (u, i), n in c.items():
        items_of.setdefault(u, {})[i] = n
    w = {}
    for (u, i), n in c.items():
        w[i] = w.get(i, 0.0) + n * n / math.log(1 + n_u[u])
    s = {}
    for u, its in items_of.items():
        if len(its) >= cap:
            continue
        for a in its:
            for b in its:
                if a != b:
                    s[(a, b)] = s.get((a, b), 0.0) + its[a] * its[b] / math.log(1 + n_u[u])
    per = {}
    for (a, b), v in s.items():
        per.setdefault(a, []).append((round(v / math.sqrt(w[a]) / math.sqrt(w[b]) + 1e-12, 9), b))
    return {a: [b for _, b in sorted(lst, key=lambda t: (-t[0], t[1]))[:k]] for a, lst in per.items()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 7)), min_size=1, max_size=40),
       st.integers(2, 6), st.integers(1, 4), st.sampled_from([None, 1, 3]))
def test_similarity_matches_brute_force(spark, events, cap, k, salts):
    from coview.operators import similarity as S
    df = spark.createDataFrame(events, "user_id long, item_id long")
    got = {}
    for r in S.top_k(S.item_similarity(df, cap, salts), k).collect():
        got.setdefault(r["item_id"], []).append((r["rank"], r["other_id"]))
    got = {a: [b for _, b in sorted(v)] for a, v in got.items()}
    assert got == similarity_model(events, cap, k)


log_line = st.one_of(
    st.builds(lambda ip, user, req, nbytes: f'{ip} - {user} [03/May/2022:10:00:00 +0000] "{req}" '
                                            f'200 {nbytes} "r" "agent"',
              st.sampled_from(["1.2.3.4", "10.0.0.1"]),
              st.sampled_from(['"FRED"', "-", '"bob"', "x"]),
              st.sampled_from(["GET /a HTTP/1.1", "POST /b HTTP/1.0"]),
              st.one_of(st.integers(0, 5000).map(str), st.just("-"))),
    st.text(alphabet="ab -[]\"", max_size=20),
)


def log_model(lines):
    import re
    from coview.sources.readers import ACCESS_LOG_PATTERN
    pat = re.compile(ACCESS_LOG_PATTERN)
    out = {}
    for line in lines:
        m = pat.match(line)
        if m and m.group(3).lower() != "-":
            key = (m.group(1), m.group(3), m.group(5))
        else:
            key = (None, None, None)
        nbytes = 0
        if m:
            try:
                nbytes = int(m.group(7))
            except ValueError:
                nbytes = 0
        n, b = out.get(key, (0, 0))
        out[key] = (n + 1, b + nbytes)
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(log_line, min_size=1, max_size=30))
def test_log_rollup_matches_model(spark, lines):
    from coview.operators.logs import log_rollup
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {(r["ip"], r["user"], r["request"]): (r["n"], r["bytes"]) for r in log_rollup(df).collect()}
    assert got == log_model(lines)
