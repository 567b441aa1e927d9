"""Each operator against a brute-force version, and on odd input."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import replace
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import compare
import corpus_pipeline
from folioloom.llm import (
    chosen_path, compression_bands, curriculum, decontam, feistel, fm_index, line_windows, quality_model, substring,
    token_store, url_cascade, words,
)
from folioloom.llm.components import components
from folioloom.llm.frames import narrowed
from folioloom.llm.queries import URL_RULES

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
ROW = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, n: int, vocabulary: int = 3000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}é" if r.random() < 0.1 else f"v{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base, passage = prose(1, 120), prose(2, 60)
    out = {i: prose(100 + i, 40 + i) for i in range(12)}
    out |= {20: base, 21: base, 22: base + " end", 23: base.upper(), 24: passage + " " + prose(3, 50)}
    out |= {25: prose(4, 30) + "\n" + passage, 26: "one two three", 27: "one two three", 28: "x", 29: " \t\n "}
    lines = "\n".join(f"line {i} of many words" for i in range(9))
    out |= {30: lines, 31: "head\n" + lines + "\ntail", 32: "a\na\na\na\na", 33: prose(5, 30_000, 50)}
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Plain rows, then a null id, a null text, an empty text, a repeated row and one id with two texts."""
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in texts.items()]
    rows += [(None, texts[20], None, None, 1), (40, None, "en", None, None), (41, "", "", "", 0), rows[3], rows[3]]
    rows += [(5, prose(77, 44), "en", "s1", 2)]
    return spark.createDataFrame(rows, ROW)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ROW)


@pytest.fixture(scope="module")
def clashing(docs):
    """Columns that carry names used inside the operators."""
    names = "size shard slot score n hash kept position raw part number k1 _id _hash _row _h _raw n_words a b cid node starts".split()
    return docs.withColumns({n: F.lit(1) for n in names})


def words_of(text):
    return WORD.findall(text or "")


# --- words ---


def test_words_hashes_and_windows_agree_with_plain_python():
    column = pa.array(["ab cd ab", None, "", "  x\ty z ", "é é　 b", "cd ab"])
    seen = {}
    found = []
    for p in words.pieces(column, most=8):
        h = p.word_hashes()
        for i in range(len(p)):
            own = h[p.word_at[i] : p.word_at[i + 1]].tolist()
            expected = words_of(column[p.first + i].as_py())
            assert len(own) == len(expected)
            found += [(a, b) for a, b in zip(own, expected, strict=True)]
    for a, b in found:
        assert seen.setdefault(a, b) == b
    assert len(seen) == len(set(seen.values()))


def test_sliced_column_with_nulls():
    column = pa.array(["zz zz", None, "a b c", "d"]).slice(1, 3)
    assert [n for p in words.pieces(column) for n in np.diff(p.word_at)] == [0, 3, 1]


# --- 1: url cascade ---


def test_rules_and_cascade(spark):
    urls = ["http://A.Example.NET/en/1", "http://x.org/fr/?q", "http://org/fr/", "http://borg/fr/", "http://net", None, "no scheme",
            "http://m.example.com/de/#x", "http://m.example.com/d?://y.net/", "http://bad.com/p?x=1", "http://net/", ""]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h")], "page_id bigint, url string, html string")
    entries = spark.createDataFrame([("bad.com/p",), (None,), ("absent",), ("bad.com/p",)], "key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_cascade.judge(pages, [url_cascade.Rule(*r) for r in URL_RULES], entries).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1][2:] == ("org/fr/", "allow") and got[2][2:] == ("org/fr/", "allow") and got[3][2:] == (None, "allow")
    assert got[4] == ("net", "", None, "allow") and got[5] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert got[7] == ("m.example.com", "/de/", "example.com/de/", "block") and got[8][1] == "/d"
    assert got[9] == ("bad.com", "/p", None, "block") and got[10][2:] == ("net/", "block") and got[11] == got[5]


@pytest.mark.parametrize("most_bytes", [1 << 20, 600])
def test_cascade_is_exact_over_its_universe(spark, most_bytes):
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    entries = keys.filter("id % 9 = 0").select("key").union(spark.createDataFrame([("elsewhere",)], "key string"))
    got = url_cascade.mark(keys, "key", entries, most_bytes).collect()
    assert len(got) == 4000 and all(r.listed == (r.id % 9 == 0) for r in got)


def test_cascade_of_nothing(spark):
    keys = spark.createDataFrame([("a",), (None,)], "key string")
    assert [r.listed for r in url_cascade.mark(keys, "key", keys.limit(0)).collect()] == [False, False]
    assert url_cascade.mark(keys.limit(0), "key", keys).count() == 0


# --- 2: line windows ---


def test_line_windows(docs, clashing, empty, texts):
    order = sorted({(r.doc_id is None, r.doc_id, r.text) for r in docs.collect() if r.text is not None}, key=lambda x: (x[0], x[1] or 0))
    got = line_windows.dedup(docs)
    by = {(r.doc_id, r.n_lines): r for r in got.collect()}
    assert len(order) and got.count() == docs.count()
    assert by[(30, 9)].n_removed == 0
    assert by[(31, 11)].n_removed == 9 and by[(31, 11)].text == "head\ntail"
    assert by[(32, 5)].text == "a" and by[(40, 0)].text is None and by[(41, 1)].text == ""
    assert line_windows.dedup(clashing).count() == docs.count() and line_windows.dedup(empty).count() == 0


# --- 3: quality ---


def test_quality_model_learns_and_scores_odd_texts(docs, clashing, empty):
    r = np.random.default_rng(0)
    good, bad = ["the", "house", "river", "stone", "walks"], ["zxq!", "##", "buy", "$$$", "qqq"]
    y = r.integers(0, 2, 300)
    made = [" ".join(r.choice(good if k else bad, 20)) for k in y]
    s = quality_model.Settings(bits=12, epochs=3)
    m = quality_model.train(pa.array(made[:200]), y[:200], s)
    p = quality_model.scores(pa.array([*made[200:], "", None]), m)
    assert ((p[:100] > 0.5) == (y[200:] == 1)).mean() > 0.95 and p[-1] == p[-2]
    one = quality_model.scores(pa.array([made[5]]), m)[0]
    assert one == quality_model.scores(pa.array(made), m)[5]  # not by batch
    scored = quality_model.score(docs, m).collect()
    assert len(scored) == docs.count() and all(0 <= x.score <= 1 for x in scored)
    assert quality_model.score(clashing, m).filter("size = 1").count() == docs.count() and quality_model.score(empty, m).count() == 0


def test_quality_without_labels_or_of_one_class(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_model.score(docs, quality_model.from_labels(docs, none)).first().score == 0.5
    same = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(None, 0, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    assert quality_model.score(docs, quality_model.from_labels(docs, same)).first().score > 0.8


def test_long_labelled_texts_do_not_end_the_sample(spark):
    word = F.when(F.col("id") % 2 == 1, "house river stone ").otherwise("buy qqq zxq ")
    made = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(word, F.lit(8)).alias("text"))
    usable = made.filter(~quality_model.held_out(F.col("doc_id")))
    # the lowest hash has a text above the whole sample's bound, the next ones some MB each
    low = [r.doc_id for r in usable.orderBy(F.xxhash64("doc_id")).limit(6).collect()]
    times = F.when(F.col("doc_id") == low[0], 7_000_000).when(F.col("doc_id").isin(low), 1_400_000).otherwise(0)
    long = made.withColumn("text", F.when(times > 0, F.repeat(F.lit("long "), times)).otherwise(F.col("text")))
    labels = spark.range(400).selectExpr("id as doc_id", "int(id % 2) as quality", "0 as toxic")
    m = quality_model.from_labels(long, labels)
    got = quality_model.score(made, m).collect()
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in got) > 390
    assert m.rows == usable.count() - len(low) and m.both_classes


def test_small_or_one_sided_samples_warn(spark, docs):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    with pytest.warns(UserWarning, match="labelled texts to learn from"):
        quality_model.from_labels(docs, labels)


@pytest.mark.skipif(not __import__("os").path.exists(SF_DIR), reason="test tables are not here")
def test_quality_on_held_out_labels(spark):
    sf = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = contract.queries()["op3_quality"](spark, sf).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.93


# --- 4: sharding ---


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 1000])
def test_feistel_is_a_permutation(n):
    p = feistel.permute(np.arange(n), n, 3)
    assert sorted(p) == list(range(n)) and (p == feistel.permute(np.arange(n), n, 3)).all()


def test_shards(docs, clashing, empty):
    got = feistel.shard_documents(docs).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == docs.count() and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    key = lambda rows: sorted((str(r.doc_id), str(r.text), r.shard, r.slot) for r in rows)
    assert key(got) == key(feistel.shard_documents(docs.repartition(7)).collect())
    assert feistel.shard_documents(clashing).columns.count("shard") == 1 and feistel.shard_documents(empty).count() == 0


# --- 5: substrings ---


def brute_substrings(rows, k=13):
    first = {}
    for d, t in rows:
        w = words_of(t)
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, 1 << 63), (1 << 63) - 1 if d is None else d)
    for d, t in rows:
        w, gone = words_of(t), set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < ((1 << 63) - 1 if d is None else d):
                gone.update(range(i, i + k))
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        yield d, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()


@pytest.mark.parametrize("settings", [substring.Settings(), substring.Settings(hot=1, shard_words=60)])
def test_substrings(docs, settings):
    got = substring.dedup(docs, settings).collect()
    expected = list(brute_substrings([(r.doc_id, r.text) for r in docs.collect()]))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == Counter(expected)
    assert sum(e[2] > 0 for e in expected) >= 4


def test_substrings_odd(clashing, empty, docs):
    assert substring.dedup(clashing).filter("size = 1").count() == docs.count() and substring.dedup(empty).count() == 0


def test_fm_index_counts_every_pattern():
    r = np.random.default_rng(1)
    lengths = r.integers(1, 30, 60)
    symbols = r.integers(1, 4, lengths.sum())
    index = fm_index.Index(symbols, lengths)
    parts = [tuple(x) for x in np.split(symbols, np.cumsum(lengths)[:-1])]
    for k in (1, 3, 6):
        count = Counter(p[i : i + k] for p in parts for i in range(len(p) - k + 1))
        first, low, high = fm_index.matching(index, k)
        assert len(first) == sum(count.values())
        for a, n in zip(first, high - low, strict=True):
            n_true = count[tuple(index.text[a : a + k])]
            assert n == n_true or (n_true == 1 and n == 1)


# --- 6: mixing ---


def test_mixing(docs, clashing, empty):
    planned = curriculum.plan_copies(docs.withColumn("size", curriculum.size_of(F.col("text")))).collect()
    assert len(planned) == docs.count()
    by = defaultdict(list)
    for r in planned:
        assert r.size == len(words_of(r.text)) and r.taken in (0, r.size, 2 * r.size) and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions)
        by[r.source].append(r)
    total = sum(r.size for r in planned)
    assert abs(sum(v[0].target for v in by.values()) - 1.5 * total) < 1e-6 * total
    for v in by.values():
        assert abs(sum(r.taken for r in v) - v[0].target) <= max(r.size for r in v)
        assert v[0].target <= 2 * v[0].source_size + 1e-6
    again = curriculum.plan_copies(docs.repartition(5).withColumn("size", curriculum.size_of(F.col("text")))).collect()
    key = lambda rows: sorted((str(r.doc_id), str(r.text), r.taken) for r in rows)
    assert key(planned) == key(again)
    mixed = curriculum.mix(docs)
    assert mixed.count() == sum(r.copies for r in planned) and mixed.columns == [*docs.columns, "position"]
    assert curriculum.mix(clashing).columns.count("position") == 1 and curriculum.mix(empty).count() == 0


def test_schedule_is_inverted(spark):
    plan = curriculum.Plan()
    times = np.linspace(0, 1, 41)
    for kind, f in enumerate(plan.factors):
        knots = np.linspace(0, 1, len(f))
        fine = np.linspace(0, 1, 20001)
        demand = np.concatenate([[0], np.cumsum((np.interp(fine[1:], knots, f) + np.interp(fine[:-1], knots, f)) / 2 * np.diff(fine))])
        done = np.interp(times, fine, demand / demand[-1]) * 500
        rows = spark.createDataFrame([(float(x),) for x in done], "done double")
        got = [r[0] for r in rows.select(curriculum.time_of(F.col("done"), F.lit(500.0), F.lit(kind))).collect()]
        assert np.allclose(got, times, atol=1e-4)


def brute_mix(rows, plan=curriculum.Plan()):
    """(row, copy, position) of each copy taken of rows (id, text, source), by numeric inversion."""
    size = lambda r: len(words_of(r[1]))
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    names = sorted(by, key=lambda x: (x is None, x or ""))
    total = {n: sum(map(size, by[n])) for n in names}
    weight = {n: plan.weights[i % 3] for i, n in enumerate(names)}
    low, high = 0.0, 2.0 * sum(total.values()) + 1
    for _ in range(200):  # the level at which capped targets make up the share
        level = (low + high) / 2
        enough = sum(min(2 * total[n], level * weight[n]) for n in names) >= 1.5 * sum(total.values())
        low, high = (low, level) if enough else (level, high)
    for i, n in enumerate(names):
        target, done = min(2 * total[n], high * weight[n]), 0
        f = plan.factors[i % 3]
        fine = np.linspace(0, 1, 20001)
        at = np.interp(fine, np.linspace(0, 1, len(f)), f)
        demand = np.concatenate([[0], np.cumsum((at[1:] + at[:-1]) / 2)])
        for r in sorted(by[n], key=lambda r: (hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(), size(r))):
            for copy in range(2):
                middle = done + copy * total[n] + size(r) / 2
                if middle <= target:
                    yield r, copy, float(np.interp(middle / target if target else 0, demand / demand[-1], fine))
            done += size(r)


def test_positions_of_all_copies(spark):
    rows = [(i, prose(i, 20 + i % 37), f"s{i % 7}" if i % 11 else None) for i in range(150)] + [(None, prose(7, 9), "s1"), (900, None, "s2"), (901, "", "s3")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = curriculum.positions(docs).collect()
    expected = {(r[0], r[2], copy): at for r, copy, at in brute_mix(rows)}
    assert len(got) == len(expected) and {(r.doc_id, r.source, r.copy) for r in got} == set(expected)
    assert all(abs(r.position - expected[(r.doc_id, r.source, r.copy)]) < 1e-4 for r in got)
    assert [r.position for r in got] == sorted(r.position for r in got)


@pytest.mark.skipif(not __import__("os").path.exists(SF_DIR), reason="test tables are not here")
def test_registered_positions_agree_with_taken_words(spark):
    got = contract.queries()["op6_positions"](spark, SF_DIR).collect()
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.size
    mixed = contract.queries()["op6_mixing"](spark, SF_DIR).collect()
    assert {r.doc_id: r.taken for r in mixed if r.taken} == {k: v for k, v in taken.items() if v}
    assert [r.position for r in got] == sorted(r.position for r in got) and all(0 <= r.position <= 1 for r in got)


# --- 7: near-duplicates ---


def shingles(text):
    w = words_of((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[max(find(i), find(j))] = min(find(i), find(j))
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        low[find(i)].append((d is None, d))
    for i, (d, _) in enumerate(rows):
        c = min(low[find(i)], key=lambda x: (x[0], x[1] or 0))[1]
        yield d, len(sets[i]), c, d == c


@pytest.mark.parametrize("settings", [chosen_path.Settings(), chosen_path.Settings(leaf=2, block=4, depth=1)])
def test_near_duplicates(spark, docs, settings):
    base = prose(9, 150).split()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for i in range(40):
        r, copy = random.Random(i), list(base)
        for _ in range(i % 9):
            copy[r.randrange(150)] = f"new{r.randrange(9)}"
        rows.append((1000 - i, " ".join(copy)))
    got = chosen_path.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), settings).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(brute_components(rows))


def test_near_duplicates_odd(docs, clashing, empty):
    left = chosen_path.one_of_each(docs)
    components = len({r.component for r in chosen_path.dedup(docs).collect() if r.component is not None})
    assert left.count() == components + 3  # no words: two empty texts and a null
    assert chosen_path.one_of_each(clashing).columns == clashing.columns and chosen_path.one_of_each(empty).count() == 0


def template_rows(n):
    """Pages of one template: some linked with each other, most in similarity between a half and the limit."""
    base = prose(9, 150).split()
    for i in range(n):
        r, copy = random.Random(i), list(base)
        for at in r.sample(range(150), i % 3 * 5 + 1):
            copy[at] = f"new{i}x{at}"
        yield i, " ".join(copy)


def test_near_duplicates_work_follows_the_input(spark, monkeypatch):
    """Rows stored on the way grow as the pages of one template, and the driver runs few jobs for them."""
    stored = []
    once, store = chosen_path.write_once, chosen_path.Rounds.store

    def counted(df):
        stored.append(df.count())
        return df

    jobs, made = [], []
    for n in (100, 400):
        rows = list(template_rows(n))
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        spark.sparkContext.setJobGroup(f"near-{n}", "jobs of one run")
        got = chosen_path.dedup(df).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"near-{n}")))
        with monkeypatch.context() as m:
            m.setattr(chosen_path, "write_once", lambda df, label: counted(once(df, label)))
            m.setattr(chosen_path.Rounds, "store", lambda self, df, label: counted(store(self, df, label)))
            stored.clear()
            chosen_path.dedup(df)
            made.append(sum(stored))
        assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(brute_components(rows))
    spark.sparkContext.setJobGroup("", "")
    print(jobs, made)
    assert max(jobs) <= 80 and made[1] <= 5 * made[0]


@pytest.mark.parametrize("most", [0, 7, 1 << 18])
def test_components(spark, most):
    r = random.Random(3)
    edges = [(r.randrange(300) * 7 - 900, r.randrange(300) * 7 - 900) for _ in range(170)] + [(5000 + i, 5001 + i) for i in range(40)] + [(3, 3)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"), most).collect()
    assert Counter(map(tuple, got)) == Counter((i, find(i)) for i in root)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), most).count() == 0


def test_narrowed_keeps_every_wanted_key(spark):
    df = spark.range(20_000).selectExpr("if(id = 7, null, id * 31) as k", "id as word")
    wanted = spark.range(0, 20_000, 50).selectExpr("id * 31 as w")
    left = narrowed(df, "k", wanted)
    assert left.columns == ["k", "word"] and left.join(wanted, F.col("k") == F.col("w")).count() == 400 and left.count() < 420


def brute_one_of_each(rows, k=5):
    """Rows (id, text, ...) that stay: per component the lowest id, null last; rows without words all stay."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [words_of((r[1] or "").translate(lower)) for r in rows]
    sets = [{tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set() for w in split]
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            group = [group[i] if g == group[j] else g for g in group]
    first = {}
    for i, g in enumerate(group):
        key = lambda x: (rows[x][0] is None, rows[x][0] or 0)
        first[g] = min(first.get(g, i), i, key=key)
    return [r for i, r in enumerate(rows) if not sets[i] or first[group[i]] == i]


def test_pipeline_compares_five_words(spark, tmp_path):
    base = prose(21, 200).split()
    other = list(base)
    for at in (20, 60, 100, 140, 180):  # 177 of 217 four-word shingles in common, 171 of 221 of five words
        other[at] = f"new{at}"
    near = list(base)
    near[100] = "new"
    rows = [(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(near)), (4, prose(22, 90)), (5, prose(22, 90)), (None, prose(23, 50)), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_one_of_each(rows)) and {r.doc_id for r in got} == {1, 2, 4, 6, 7, None}


# --- 8: tokens ---


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 999])
def test_blocks_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(0, 3_000_000).astype(np.uint32)
    got, per = token_store.unpack(token_store.pack(ids, np.array([n, 0])))
    assert (got == ids).all() and per.tolist() == [n, 0]


@pytest.mark.parametrize("vocabulary", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tokens(spark, docs, empty, tmp_path, vocabulary):
    from tokenizers import Tokenizer

    odd = ["~ a ~b", "<|endoftext|>x", "I'll don't", "x y\x1cz", "é ́", "İ Σς"]
    both = docs.select("doc_id", "text").union(spark.createDataFrame([(500 + i, t) for i, t in enumerate(odd)], "doc_id bigint, text string"))
    token_store.write(both, f"{tmp_path}/t", vocabulary, block_ids=300)
    blocks = token_store.read(spark, f"{tmp_path}/t")
    got = sorted(token_store.digest(blocks).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(token_store.vocabulary_path(vocabulary))
    expected = Counter()
    for r in both.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        expected[(r.doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    ids = [r.doc_id for r in got]
    assert ids[-1] is None and ids[:-1] == sorted(ids[:-1]) and blocks.count() > 5
    token_store.write(empty, f"{tmp_path}/e", vocabulary)
    assert token_store.digest(token_store.read(spark, f"{tmp_path}/e")).count() == 0


@pytest.mark.parametrize("most_words", [4, 40, 1 << 20])
def test_word_ids_are_those_of_whole_texts(most_words):
    """Letters taken by themselves, punctuation, case, other alphabets; tables that overflow; texts longer than a run."""
    import json

    from tokenizers import Tokenizer

    path = token_store.vocabulary_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        ids = token_store.WordIds(tokenizer, json.load(f), most_words)
    odd = [
        "", " \t ", "Über ÀÉ... ÅÆ×÷ß ĀĂ ÿŸ ªº µ é éa", "don't Don'T word'S 's x's! ça'va", "THTHEATH!!$% a<| foo<|endoftext|> foo.~ ~",
        "a\x00b. a\x1c. x\u200b. x\u0301 \u0301.", "Ab1.. 1Ab [AB] (ab) AB] ab)", "Σας ΟΔΟΣ. Ǆ ﬁne",
    ]
    long = " ".join(f"Wort{'abcdefghij'[i % 10]}{chr(97 + i % 7)}." for i in range(900)) + " " + "ab" * 700 + " end"
    for most in (50, 1 << 18):
        got = [b"".join(x) for x in ids.runs([x.encode() for x in (*odd, long, *odd)], most)]
        for text, raw in zip([*odd, long, *odd], got, strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert b"".join(token_store.parts(long.encode(), 64)) == long.encode()
    assert len(ids.young) + len(ids.old) <= 2 * most_words + 4 * len(set(long.split()))


def word_ids(most_words):
    import json

    from tokenizers import Tokenizer

    path = token_store.vocabulary_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        return tokenizer, token_store.WordIds(tokenizer, json.load(f), most_words)


def test_case_and_tail_of_a_word_take_no_entries():
    _, ids = word_ids(1 << 20)
    ids([b"wort WORT! Wort. wort... Wort, \xc3\x9cber! \xc3\xbcber, \xc3\x9cBER. \xc3\xbcber", b"", b"Wort"])
    assert len(ids.young) == 2 + len([".", "...", ",", "!"])


@pytest.mark.parametrize("most_words", [2, 64, 1 << 20])
@pytest.mark.parametrize("one_hash", [False, True])
def test_word_ids_of_random_texts(monkeypatch, most_words, one_hash):
    """Also where all words have one hash and are told apart by their bytes, and for words that are not kept."""
    if one_hash:
        monkeypatch.setattr(words.Piece, "word_hashes", lambda self: np.full(len(self.starts), 2**64 - 1, np.uint64))
    tokenizer, ids = word_ids(most_words)
    rng = random.Random(7)
    bits = [*"aAsStTlLdDmMeEzZ'\".,!~|<>()0195", *"   \n\t\x0b\x0c\r\x00\x1c\x7f", *"ÀàÉéÞþßÿŸ×÷ªµ", "\u0301", "\u0308", "İ", "Σ", "中", "\u3000", "\u200b", "<|endoftext|>", "<|ENDOFTEXT|>", "'ll", "'S"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(150)] + ["\u3000", " \u3000 ", "Ab." * 50 + " Ab. " + "aB" * 90]
    for most, most_at_once in ((64, 100), (1 << 18, 1 << 20)):
        monkeypatch.setattr(token_store, "MOST_AT_ONCE", most_at_once)
        got = [b"".join(x) for x in ids.runs([x.encode() for x in texts], most)]
        for text, raw in zip(texts, got, strict=True):
            assert np.frombuffer(raw or b"", "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


# --- 9: decontamination ---


def brute_hits(rows, items, k=13):
    split = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    windows = defaultdict(set)
    for item, t in items:
        w = split(t)
        for i in range(max(1, len(w) - k + 1) if w else 0):
            windows[tuple(w[i : i + k])].add(str(item))
    lengths = {len(x) for x in windows}
    for d, t in rows:
        w, hit, named = split(t), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    named |= windows[tuple(w[i : i + n])]
        sha = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        yield d, len(w), len(hit), len(named), sha, bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination(spark, docs, clashing, empty, texts):
    part = texts[24].split()
    items = [(7, " ".join(part[3:40])), (8, texts[30]), (9, "One, two three!"), (10, None), (11, "..."), (12, " ".join(part[10:30])), (13, "x"), (7, "w1é"),
             (14, " ".join(["no", "such", "window", "at", "all", "v1", "v2"]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = decontam.judge(docs, bench).collect()
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(brute_hits(rows, items))
    assert decontam.judge(clashing, bench).filter("size = 1").count() == docs.count()
    assert decontam.judge(empty, bench).count() == 0
    assert decontam.judge(docs, bench.limit(0)).filter("n_hit > 0 or contaminated").count() == 0


# --- 10: quality rules ---


def brute_rules(text):
    w = words_of(text)
    count = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeat = {j for i in range(len(w) - 7) if count[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeat), failed


def test_quality_rules(spark, docs, clashing, empty):
    odd = ["# $ % | <b> &" * 5, "tick tock " * 40, prose(1, 30) * 2, "".join(chr(0x21 + random.Random(1).randrange(90)) for _ in range(5000)),
           " ".join("".join(chr(0x21 + random.Random(i * 40 + j).randrange(90)) for j in range(30)) for i in range(400)), "ab " * 4000]
    both = docs.select("doc_id", "text").union(spark.createDataFrame([(600 + i, t) for i, t in enumerate(odd)], "doc_id bigint, text string"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = compression_bands.score(both.withColumn("t2", F.col("text"))).collect()
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter((r.doc_id, *brute_rules(r.text)) for r in both.collect())
    assert all(not (r.kept and r.base_failed) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[0].kept and by[20].kept and not by[604].kept
    assert compression_bands.score(clashing).count() == docs.count() and compression_bands.score(empty).count() == 0


def test_bands_reject_repetition_and_noise():
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    noise = np.random.default_rng(0).integers(0, 256, 9000, dtype=np.uint8).tobytes()
    plain = prose(3, 3000).encode()
    fits = lambda x: compression_bands.compression(x, press, compression_bands.Bands())[-1]
    assert fits(plain) and fits(b"") and not fits(b"again and " * 900) and not fits(noise)
    assert not fits(plain + noise)  # only the chunks tell


@pytest.mark.parametrize("tail", [4095, 3000, 4096])
def test_the_end_of_a_text_is_judged(tail):
    import zstandard

    press, bands = zstandard.ZstdCompressor(level=3), compression_bands.Bands()
    plain = prose(3, 3000).encode()[:4096]
    noise = bytes(random.Random(1).choices(range(0x21, 0x7F), k=tail))
    loose = replace(bands, whole=((float("inf"), 0.0, 2.0, 2.0),))  # only the chunks tell
    for text in (plain + noise, noise + plain):
        assert not compression_bands.compression(text, press, loose)[-1] and not compression_bands.compression(text, press, bands)[-1]
    assert compression_bands.compression(plain + b"x", press, bands)[1:] == (2, 0, 0, True)
    assert compression_bands.compression(plain * 2, press, loose)[1] == 2 and compression_bands.compression(plain, press, bands)[1] == 0


def test_hex_letters_and_base64_are_noise(spark):
    noise = {
        1: " ".join(f"{random.Random(i).getrandbits(128):x}" for i in range(400)),  # the case of 916ae27
        2: " ".join("".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=30)) for i in range(200)),
        3: " ".join(base64.b64encode(random.Random(i).randbytes(24)).decode() for i in range(40)),
        4: " ".join(base64.b64encode(random.Random(i).randbytes(24)).decode() for i in range(200)),
    }
    r = random.Random(5)
    characters = [chr(0x4E00 + i) for i in range(3000)]
    rare = [1 / (i + 1) for i in range(3000)]
    wide = " ".join("".join(r.choices(characters, rare, k=12)) for _ in range(300))  # letters of three bytes
    rows = [*noise.items(), (10, prose(3, 3000)), (11, prose(4, 120)), (12, wide)]
    got = {x.doc_id: x for x in compression_bands.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [k for k, x in got.items() if x.kept] == [10, 11, 12] and not any(x.base_failed for x in got.values())


# --- pipeline ---


def test_pipeline_and_its_stages(spark, tmp_path):
    r = random.Random(8)
    rows = [(i, prose(i, 60) if i % 2 else " ".join(r.choices(["buy", "zxq!", "qqq", "$$$", "##", "win"], k=60)), f"s{i % 5}") for i in range(120)]
    passage, near = prose(999, 20), prose(5, 60).split()
    near[30] = "new"
    rows += [(200, prose(1, 60), "s1"), (201, " ".join(near), "s2"), (202, prose(70, 40) + " " + passage, "s3"), (203, passage.upper(), "s3")]
    rows += [(None, prose(300, 60), None), (204, None, "s1"), (205, "", None), (206, "x", "s2")]
    labels, items = [(i, i % 2, 0) for i in range(120)], [(1, passage), (2, None)]
    docs = spark.createDataFrame([(d, t, "en", s, None) for d, t, s in rows], ROW)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    rank = {x.id: x.h for x in spark.range(120).selectExpr("id", "xxhash64(id) as h").collect()}
    ids = sorted((i for i in rank if zlib.crc32(str(i).encode()) % 4 != 2), key=rank.get)
    model = quality_model.train(pa.array([rows[i][1] for i in ids]), np.array([i % 2 for i in ids]))
    good = [x for x, p in zip(rows, quality_model.scores(pa.array([x[1] for x in rows]), model), strict=True) if p >= 0.7]
    single = brute_one_of_each(good)
    clean = [x for x, hit in zip(single, brute_hits([x[:2] for x in single], items), strict=True) if not hit[5]]
    mixed = [x for x, _, at in sorted(brute_mix(clean), key=lambda y: y[2])]
    assert len(rows) > len(good) > len(single) > len(clean) > 10
    for (_, stage), expected in zip(corpus_pipeline.STAGES, (good, single, clean, mixed), strict=False):
        got = stage(spark, docs, str(tmp_path)).collect()
        assert Counter((x.doc_id, x.text, x.source) for x in got) == Counter(expected)
        docs = spark.createDataFrame(got, ROW)

    def placed(ordered, places):
        return Counter((*x, p % 16, p // 16) for x, p in zip(ordered, places.tolist(), strict=True))

    def rows_of(df):
        return Counter((x.doc_id, x.text, x.source, x.shard, x.slot) for x in df.collect())

    n, order = len(mixed), [(x.doc_id, x.text, x.source) for x in got]  # the mix, by training position
    expected = placed(order, feistel.permute_near(np.arange(n), n, 20, 1 << 16))
    corpus_pipeline.mix(spark, spark.createDataFrame([(d, t, "en", s, None) for d, t, s in clean], ROW), str(tmp_path)).write.parquet(f"{tmp_path}/mixed")
    stored = spark.read.parquet(f"{tmp_path}/mixed")
    assert rows_of(corpus_pipeline.shards(spark, stored, str(tmp_path))) == expected
    assert rows_of(contract.queries()["pipeline"](spark, str(tmp_path))) == expected
    # slots of small windows follow the order of the mix
    near = sorted(feistel.shard_stored(stored, window=32).collect(), key=lambda x: (x.slot, x.shard))
    for a in range(0, n, 32):
        assert Counter((x.doc_id, x.text, x.source) for x in near[a : a + 32]) == Counter(order[a : a + 32])
    by_id = sorted(mixed, key=lambda x: (x[0] is None, x[0] or 0))
    assert rows_of(corpus_pipeline.shards(spark, docs, str(tmp_path))) == placed(by_id, feistel.permute(np.arange(n), n, 20))


@pytest.mark.parametrize(("n", "window"), [(1, 16), (16, 16), (1000, 16), (1000, 333), (1000, 5000)])
def test_windows_of_numbers_are_permuted(n, window):
    p = feistel.permute_near(np.arange(n), n, 3, window)
    assert sorted(p) == list(range(n)) and (p // window == np.arange(n) // window).all()
    some = np.arange(n)[:: 7]
    assert (feistel.permute_near(some, n, 3, window) == p[some]).all()


# --- registered queries ---


@pytest.mark.skipif(not __import__("os").path.exists(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("name", ["op1_url_filter", "op2_line_dedup", "op5_substrings", "op6_mixing", "op6_positions", "op9_decontamination"])
def test_parity(spark, name):
    con = duckdb.connect()
    for t in compare.TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    df = contract.queries()[name](spark, SF_DIR)
    cur = con.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert compare.as_lines(df.columns, df.collect()) == compare.as_lines(names, cur.fetchall())


@pytest.mark.skipif(not __import__("os").path.exists(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("name", ["op7_near_duplicates", "op10_quality_rules"])
def test_against_brute_force(spark, name):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = contract.queries()[name](spark, SF_DIR).collect()
    if name.startswith("op7"):
        assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(brute_components(rows))
    else:
        assert Counter((r.doc_id, r.n_words, r.n_repeat_words) for r in got) == Counter((d, brute_rules(t)[0], brute_rules(t)[4]) for d, t in rows)
