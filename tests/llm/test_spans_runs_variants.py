"""Personal data, periodic runs and spelling variants against plain Python versions, and on odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from folioloom.llm import personal_data, spelling_variants, word_runs, words

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
ROW = "doc_id bigint, text string, lang string"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- personal data ---

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(x), 10)) if i % 2 else int(x) for i, x in enumerate(reversed(d))) % 10 == 0


def base_of(text):
    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        return {"email": True, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m[0])]


ODD_TEXTS = [
    "x@a.b_y@c.d x@y@c.d a@b a@.b é@b.cc 😀 j.d+e%f-g@h-i.j.k", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4 1.2.3 12.3.4.5678",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 41111111111111110000 1 2", "+1 (743) 555-3824 +12 +1(((((((5 ++4912345678 +1.2.3.4.5.6.7.8 +",
    "", None, "@@@ ... +++ ---", "😀😀 4111111111111111 😀 a@b.cc", "a@b.cc " * 300, "7" * 5000 + " 1.1.1.1",
]


def test_base_finds_are_those_of_plain_patterns(spark, documents):
    rows = documents + [(-i, t) for i, t in enumerate(ODD_TEXTS, 1)]
    found = personal_data.find(spark.createDataFrame(rows, "doc_id bigint, text string"), keep_text=False).collect()
    assert len(found) == len(rows)
    by_id = dict(rows)
    for r in found:
        assert [tuple(s) for s in r.base] == base_of(by_id[r.doc_id]), r.doc_id
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))
        order = [(personal_data.KINDS.index(s.kind), s.start) for s in r.spans]
        assert order == sorted(order)


def test_personal_data_query_digests(spark, documents):
    rows = {r.doc_id: r for r in contract.queries()["op11_personal_data"](spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        base, r = base_of(text), rows[doc_id]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(b[0] == k for b in base) for k in PATTERNS]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == sha(listed)
        assert set(listed.split(",")) <= set(r.spans.split(","))


ADDED = {
    "write to jo.doe at mail dot example dot com now": "jo.doe at mail dot example dot com", "mail josé@correo.es please": "josé@correo.es",
    "joe [at] example [dot] org": "joe [at] example [dot] org", "call (555) 123-4567 today": "(555) 123-4567", "tel 030 1234567": "030 1234567",
    "phone 0049 30 1234567": "0049 30 1234567", "visa 3782 822463 10005 ok": "3782 822463 10005", "card 4111.1111.1111.1111 x": "4111.1111.1111.1111",
    "server 10[.]0[.]0[.]1 down": "10[.]0[.]0[.]1", "ip 2001:db8:0:0:0:0:0:1 up": "2001:db8:0:0:0:0:0:1",
}
CLEAN = ["version 1.2.3", "at home.The dot", "order 123456789012", "isbn 978-3-16-148410-0", "year 1999 2000 2001", "ratio 12:30:45", "look at that dot on it",
         "numbers 1 2 3 4 5 6 7 8 9 10 11 12", "12/31/2024 10:00", "4111 1111 1111 1112 bad", 'token = "8e91844611cd1c53d40a"']


def test_classifier_adds_personal_data_and_leaves_other_numbers(spark, documents):
    texts = [*ADDED, *CLEAN]
    rows = [(-i, t) for i, t in enumerate(texts, 1)] + documents
    found = {r.doc_id: r for r in personal_data.find(spark.createDataFrame(rows, "doc_id bigint, text string"), keep_text=False).collect()}
    for i, t in enumerate(texts, 1):
        assert [t[s.start : s.end] for s in found[-i].spans] == ([ADDED[t]] if t in ADDED else []), t


def test_reliabilities_tell_good_labelers_from_bad():
    r = random.Random(1)
    counts = Counter()
    for _ in range(4000):
        truth = r.random() < 0.4
        votes = tuple((1 if truth == (r.random() < q) else -1) if r.random() < s else 0 for q, s in ((0.95, 1), (0.9, 0.8), (0.7, 0.9), (0.85, 0.5), (0.8, 1)))
        counts["card", False, votes, 0] += 1
    rows = [personal_data.Pattern(*k, n) for k, n in counts.items()]
    right, p = personal_data.reliabilities(rows)
    for j, q in enumerate((0.95, 0.9, 0.7, 0.85, 0.8)):
        assert abs(right["card", j] - q) < 0.04
    weights = personal_data.fit(rows, p)["card"]
    agree = sum(x.count for x, y in zip(rows, p, strict=True) if (sum(weights[i] for i in personal_data.features(x.votes, x.shape)) > 0) == (y > 0.5))
    assert agree / 4000 > 0.97


def test_personal_data_keeps_columns_and_takes_empty_tables(spark):
    df = spark.createDataFrame([(None, "a@b.cc", "en"), (1, "a@b.cc", "en"), (1, "a@b.cc", "en")], ROW).withColumns({c: F.lit(1) for c in ("spans", "start", "kind", "_row", "_all", "found")})
    out = personal_data.find(df).collect()
    assert len(out) == 3 and all(r.text == "a@b.cc" and r._all == 1 and [tuple(s) for s in r.spans] == [("email", 0, 6)] for r in out)
    assert personal_data.find(spark.createDataFrame([], ROW)).collect() == []


def test_many_spans_in_one_text(spark):
    text = "1.2.3.4 " * 5000
    r = personal_data.find(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), keep_text=False).first()
    assert [s.start for s in r.base] == list(range(0, 40000, 8))


# --- periodic runs ---


def runs_by_definition(w):
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def random_words(r):
    k = r.choice([1, 2, 3, 5, 50])
    w = [r.randrange(k) for _ in range(r.randrange(60))]
    for _ in range(r.randrange(3)):
        b = [r.randrange(k) for _ in range(r.randrange(1, 9))]
        w += b * r.randrange(1, 8) + b[: r.randrange(len(b))] + [r.randrange(k) for _ in range(r.randrange(6))]
    return w


@pytest.mark.parametrize("seed", range(5))
def test_runs_on_the_grammar_are_all_runs(seed):
    r = random.Random(seed)
    for _ in range(60):
        texts = [random_words(r) for _ in range(r.randrange(1, 5))]
        flat = np.array(sum(texts, []), np.uint64)
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = [tuple(x) for x in word_runs.runs_of(words.mix(flat + np.uint64(77)), at).tolist()]
        assert got == sorted((s + int(at[i]), n, q) for i, t in enumerate(texts) for s, n, q in runs_by_definition(t))


def test_grammar_derives_the_text():
    r = random.Random(9)
    ids = np.array([r.randrange(4) for _ in range(500)], np.uint64)
    g = word_runs.Grammar(ids, np.array([0, 200, 200, 500]))
    for s, place in zip(g.symbol.tolist(), g.place.tolist(), strict=True):
        a, n = int(g.first[s]), int(g.size[s])
        assert (ids[a : a + n] == ids[place : place + n]).all() and 0 < g.left[s] < n
    assert sorted(g.size[g.size >= 200].tolist()) == [200, 300]


def test_long_texts_of_few_words():
    for ids, expected in (
        (np.full(200_000, 3), [(0, 200_000, 1)]),
        (np.arange(200_001) % 2, [(0, 200_001, 2)]),
        (np.arange(300_000) % 50_000, [(0, 300_000, 50_000)]),
        (np.arange(200_000), []),
    ):
        got = word_runs.runs_of(words.mix(ids.astype(np.uint64) + np.uint64(5)), np.array([0, len(ids)]))
        assert [tuple(x) for x in got.tolist()] == expected


def looped(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def test_word_runs_query(spark, documents):
    rows = {r.doc_id: r for r in contract.queries()["op12_word_runs"](spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    some = 0
    for doc_id, text in documents:
        if len(text or "") > 8000:  # the plain version is quadratic
            continue
        w, r = looped(doc_id, WORD.findall(text or "")), rows[doc_id]
        runs = runs_by_definition(w)
        some += len(runs) > 0
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None,) * 3))
        assert r.exponent_milli == (None if best is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(x for i, x in enumerate(w) if i not in gone))
    assert some > 5


def test_collapse_on_odd_rows(spark):
    rows = [(1, "go go go go go go on", "en"), (None, None, None), (None, "", ""), (1, "a b " * 5, "en"), (1, "a b " * 5, "en"), (2, " \t\n", "x")]
    df = spark.createDataFrame(rows, ROW).withColumns({c: F.lit(7) for c in ("row", "raw", "id", "runs", "none", "start")})
    out = word_runs.collapse(df, loops=False).collect()
    assert Counter((r.doc_id, r.text, r.n_words, r.n_runs, r.start) for r in out) == Counter(
        [(1, "go on", 7, 1, 7), (None, "", 0, 0, 7), (None, "", 0, 0, 7), (1, "a b", 10, 1, 7), (1, "a b", 10, 1, 7), (2, "", 0, 0, 7)]
    )
    assert word_runs.collapse(spark.createDataFrame([], ROW), loops=True).collect() == []
    assert word_runs.collapse(df, loops=True).filter("doc_id is null").select("n_runs").distinct().collect()[0][0] == 0


def test_strongest_run_is_exact():
    big = 10**9
    assert word_runs.strongest([(0, big, 7), (3, big + 1, 7), (5, big + 1, 7)]) == (3, big + 1, 7)
    assert word_runs.strongest([]) is None


# --- spelling variants ---


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def variants_by_definition(rows):
    n = Counter()
    lower = str.maketrans(spelling_variants.UPPER, spelling_variants.UPPER.lower())
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def found_variants(df):
    rows = spelling_variants.grouped(df).collect()
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_variants_against_all_pairs(spark):
    r = random.Random(3)
    base = ["".join(r.choice("abcdeéÀ") for _ in range(r.randrange(7, 12))) for _ in range(40)]
    rows = []
    for i in range(250):
        w = list(r.choice(base))
        for _ in range(r.randrange(3)):
            at = r.randrange(len(w))
            w[at : at + r.randrange(2)] = r.choice(["", "x", "É", "Q"])
        rows += [(r.choice([None, i, i]), " ".join(["".join(w)] * r.choice([1, 2, 3, 30, 400])), "en")]
    rows += [(1, None, "en"), (2, "", "en"), (3, "a1b-c", "en"), rows[0], rows[0]]
    df = spark.createDataFrame(rows, ROW).withColumns({c: F.lit(1) for c in ("word", "n", "key", "run", "h", "form")})
    assert found_variants(df) == variants_by_definition([x[:2] for x in rows])


def test_variant_chains_and_ties(spark):
    text = " ".join(["abcdefgh"] * 2 + ["abcdefgx"] * 20 + ["abcdefxx"] * 200 + ["abcdexxx"] * 2000 + ["abcdxxxx"] * 20000 + ["bbcdefxx"] * 200)
    got = found_variants(spark.createDataFrame([(7, text)], "doc_id bigint, text string"))
    assert got == variants_by_definition([(7, text)])
    assert {x[2] for x in got if x[0] == "abcdefgh"} == {"abcdxxxx"}


def test_variants_of_no_words(spark):
    assert found_variants(spark.createDataFrame([], ROW)) == set()
    assert found_variants(spark.createDataFrame([(1, "short words only", "en")], ROW)) == set()


@pytest.mark.parametrize("shape", [(1, 6), (2, 3), (3, 1)])
def test_signatures_lose_no_pair(spark, shape):
    r = random.Random(4)
    ws = {"".join(r.choice("abc") for _ in range(r.randrange(7, 10))) for _ in range(300)}
    pairs = spelling_variants.near_pairs(spark.createDataFrame([(w, 2) for w in ws], "word string, n bigint"), *shape)
    got = {frozenset((p.a, p.b)) for p in pairs.collect()}
    assert got == {frozenset((a, b)) for a in ws for b in ws if one_apart(a, b)}


def test_new_queries_beside_their_twins(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    cur = con.execute(spelling_variants.SQL)
    names = [c[0] for c in cur.description]
    rows = contract.queries()["op13_spelling_variants"](spark, SF_DIR).select(*names).collect()
    assert Counter(map(tuple, rows)) == Counter(cur.fetchall())
