import json
import math
import os
import random
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioloom.operators import search
from folioloom.sources.store import Store
from folioloom.streaming import refresh, segments


def spell(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def brute_force(docs, query, k=5):
    words = {d: spell(t) for d, t in docs.items()}
    avg = sum(map(len, words.values())) / len(words)
    counts = {d: Counter(w) for d, w in words.items()}
    scores = {}
    for term in set(spell(query)):
        df = sum(term in c for c in counts.values())
        for d, c in counts.items():
            if c[term]:
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                norm = c[term] * 2.2 / (c[term] + 1.2 * (0.25 + 0.75 * len(words[d]) / avg))
                scores[d] = scores.get(d, 0) + idf * norm
    return sorted(((round(s, 6), d) for d, s in scores.items()), key=lambda p: (-p[0], p[1]))[:k]


def test_search_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["fund", "Índex", "risk", "bond", "the", "of", "été", "yield", "2021", "x"]
    docs = {f"d{i:02d}.txt": " ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) + ".\n" for i in range(40)}
    docs["long.txt"] = "filler " * 3000 + "needle"
    docs["empty.txt"] = ""
    asked = {1: "The yield of the ÍNDEX", 2: "needle", 3: "absent", 4: "risk-bond, été"}
    df = spark.createDataFrame(list(docs.items()), "relative_path string, content string")
    queries = spark.createDataFrame(list(asked.items()), "query_id int, query_text string")
    got: dict = {}
    for r in search.search(df, queries).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.relative_path))
    for q, text in asked.items():
        want = brute_force(docs, text)
        assert [p for _, p in got.get(q, [])] == [p for _, p in want]
        assert [s for s, _ in got.get(q, [])] == pytest.approx([s for s, _ in want], abs=1e-6)


def test_only_the_best_of_each_task_are_exchanged(spark):
    """300 documents hold the word of every query; what reaches the final rank is k per query and task."""
    docs = spark.createDataFrame([(f"d{i:03}", "risk " * (i % 7 + 1) + f"w{i}") for i in range(300)], "relative_path string, content string")
    queries = spark.createDataFrame([(q, f"risk w{q}") for q in range(20)], "query_id int, query_text string")
    found = search.search(docs, queries, k=3)
    assert found.count() == 60
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not [e for e in exchanges if "query_id" in e and "relative_path" in e]
    assert re.search(r"WindowGroupLimit .*Final.*Exchange hashpartitioning\(query_id.*WindowGroupLimit .*Partial", plan, re.S)
    assert sorted((r.query_id, r.relative_path) for r in found.filter("rank = 1").collect()) == [(q, f"d{q:03}") for q in range(20)]


@pytest.mark.parametrize("batch_bytes", [1 << 20, 100])
def test_vector_search_against_brute_force(spark, batch_bytes):
    rng = random.Random(9)

    def vector():
        return [rng.uniform(-1, 1) for _ in range(6)]

    vectors = {i: vector() for i in range(50)} | {99: [0.0] * 6}
    asked = {q: vector() for q in range(5)}

    def cosine(a, b):
        na, nb = math.hypot(*a), math.hypot(*b)
        return sum(x * y for x, y in zip(a, b, strict=True)) / (na * nb) if na and nb else None

    v = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    q = spark.createDataFrame(list(asked.items()), "query_id int, embedding array<double>")
    got: dict = {}
    for r in search.vector_search(v, q, k=4, batch_bytes=batch_bytes).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for query, vec in asked.items():
        want = sorted(((cosine(w, vec), i) for i, w in vectors.items() if i != 99), reverse=True)[:4]
        assert [i for i, _ in got[query]] == [i for _, i in want]
        assert [s for _, s in got[query]] == pytest.approx([s for s, _ in want], abs=1e-6)


def test_search_within_an_attribute(spark):
    rows = [("a.txt", "A", "risk risk"), ("b.txt", "B", "risk"), ("c.txt", "B", "risk bond bond")]
    docs = spark.createDataFrame(rows, "relative_path string, ticker string, content string")
    asked = spark.createDataFrame([(1, "risk")], "query_id int, query_text string")
    got = search.search(docs, asked, where=F.col("ticker") == "B").orderBy("rank").collect()
    assert [r.relative_path for r in got] == ["b.txt", "c.txt"]


def test_document_table(spark):
    files = spark.createDataFrame(
        [("docs_text/vwrp.txt", "a"), ("x/y/E2.v1.TXT", "b"), ("plain", "c")], "relative_path string, content string"
    )
    got = {r.relative_path: (r.ticker, r.title, r.file_url) for r in search.document_table(files, "u/").collect()}
    assert got["docs_text/vwrp.txt"] == ("VWRP", "vwrp.txt", "u/docs_text/vwrp.txt")
    assert got["x/y/E2.v1.TXT"][:2] == ("E2", "E2.v1.TXT") and got["plain"][0] == "PLAIN"
    listing = search.corpus_listing(search.document_table(files)).collect()
    assert [r.relative_path for r in listing] == ["docs_text/vwrp.txt", "plain", "x/y/E2.v1.TXT"]
    assert search.corpus_count(files).first().parsed_doc_count == 3


def test_refresh_equals_a_full_rebuild(spark):
    before = {"a": ("one two", 1), "b": ("two", 1), "c": ("three", 1)}
    after = {"a": ("one two", 1), "b": ("two two four", 2), "d": ("five", 1)}

    def frame(docs):
        rows = [(p, t, m) for p, (t, m) in docs.items()]
        return spark.createDataFrame(rows, "relative_path string, content string, modified long")

    old, new = frame(before), frame(after)
    changes = refresh.index_changes(new, old)
    assert {tuple(r) for r in changes.collect()} == {("b", "changed"), ("c", "removed"), ("d", "new")}
    touched = new.join(changes, "relative_path", "left_semi")
    refreshed = refresh.refresh_terms(
        search.term_index(old, "relative_path"), changes, search.term_index(touched, "relative_path")
    )
    rebuilt = search.term_index(new, "relative_path")
    assert sorted(map(tuple, refreshed.collect())) == sorted(map(tuple, rebuilt.collect()))


# --- the index as a stream ---


def drop(spark, landing, rows):
    spark.createDataFrame(rows, segments.DROP).coalesce(1).write.mode("append").parquet(landing)


def rebuilt(docs):
    out = []
    for path, text in docs.items():
        words = re.findall("[a-z]+", text.lower())
        out += [(path, len(words), t, words.count(t)) for t in set(words)] + [(path, len(words), "", 1)]
    return sorted(out)


def test_stream_reads_only_what_is_new_and_equals_a_rebuild(spark, tmp_path):
    landing, index = str(tmp_path / "in"), segments.SegmentIndex(Store(spark, str(tmp_path / "store")), fan=3)
    drop(spark, landing, [("a", 1, False, "One two two"), ("b", 1, False, "two"), ("c", 1, None, "three"), (None, 1, False, "x")])
    assert index.refresh(landing) == 4
    assert index.refresh(landing) == 0 and len(index.segments()) == 1
    # changed, removed, new; "late" is older than what is there, and one path comes twice
    drop(spark, landing, [("b", 2, False, "four"), ("c", 2, True, "gone"), ("a", 0, False, "late"), ("d", 2, False, None), ("e", 3, False, "e"), ("e", 2, False, "old")])
    assert index.refresh(landing) == 6
    now = {"a": "one two two", "b": "four", "d": "", "e": "e"}
    assert sorted(map(tuple, index.terms().collect())) == rebuilt(now)
    # a removed document comes back, an equal row lands again
    drop(spark, landing, [("c", 3, False, "again"), ("b", 2, False, "four")])
    assert index.refresh(landing) == 2
    assert [(s.segment, s.level) for s in index.segments()] == [("m-00000003-1", 1)]
    assert sorted(map(tuple, index.terms().collect())) == rebuilt(now | {"c": "again"})
    # merged: no outdated row is left
    assert index.rows(index.segments()).count() == len(rebuilt(now | {"c": "again"}))


def test_removal_outlives_a_merge_of_newer_segments(spark, tmp_path):
    landing, index = str(tmp_path / "in"), segments.SegmentIndex(Store(spark, str(tmp_path / "store")), fan=2)
    now = {}
    for i in range(7):
        rows = [(f"d{i}", i, False, f"text {'abcdefg'[i]}"), ("same", i, i == 5, f"common {'abcdefg'[i]}")]
        drop(spark, landing, rows + ([("d0", i, True, None)] if i == 6 else []))
        index.refresh(landing)
        now |= {f"d{i}": rows[0][3], "same": rows[1][3]}
        gone = {"same"} if i == 5 else {"d0"} if i == 6 else set()
        assert sorted(map(tuple, index.terms().collect())) == rebuilt({k: v for k, v in now.items() if k not in gone})
    assert [s.level for s in index.segments()] == [2, 1, 0]
    kept = [p.name for p in (tmp_path / "store/index/documents").glob("**/*") if re.match("m-|run=", p.name)]
    assert len(kept) <= 6


def test_stream_killed_before_sealing_goes_on_in_its_segment(spark, tmp_path, monkeypatch):
    landing, store = str(tmp_path / "in"), Store(spark, str(tmp_path / "store"))
    index = segments.SegmentIndex(store)
    drop(spark, landing, [("a", 1, False, "one")])
    index.refresh(landing)
    drop(spark, landing, [("a", 2, False, "two")])

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(index, "_seal", killed)
        with pytest.raises(RuntimeError):
            index.refresh(landing)
    assert sorted(map(tuple, index.terms().collect())) == rebuilt({"a": "one"})
    drop(spark, landing, [("b", 1, False, "three")])
    again = segments.SegmentIndex(store)
    assert again.refresh(landing) == 1  # what the killed run had read is in the segment already
    assert sorted(map(tuple, again.terms().collect())) == rebuilt({"a": "two", "b": "three"})


LOGGED = """
import sys
from folioloom.session import builder
from folioloom.sources.store import Store
from folioloom.streaming import segments

top, key = sys.argv[1], "spark.sql.maxConcurrentOutputFileWriters"
logged = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{top}/events", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}
spark = builder("logged", "local[2]").config(map=logged).getOrCreate()
was = spark.conf.get(key, None)
segments.SegmentIndex(Store(spark, f"{top}/store")).refresh(f"{top}/in")
assert spark.conf.get(key, None) == was
spark.stop()
"""


def test_stream_writes_without_sorting_its_rows(spark, tmp_path):
    """A sort would hold all term rows of a task: the stage that reads the drops must need no execution memory."""
    drop(spark, str(tmp_path / "in"), [(f"d{i}", 1, False, "one two three") for i in range(50)])
    (tmp_path / "events").mkdir()
    root = str(Path(__file__).parents[1])
    subprocess.run([sys.executable, "-c", LOGGED, str(tmp_path)], check=True, cwd=root, env=os.environ | {"PYTHONPATH": root}, timeout=200)
    lines = [json.loads(x) for f in (tmp_path / "events").iterdir() for x in f.read_text().splitlines()]
    done = [x["Task Metrics"] for x in lines if x["Event"] == "SparkListenerTaskEnd"]
    writes = [m for m in done if m["Output Metrics"]["Records Written"] == 50 * 4]
    assert len(writes) == 1 and writes[0]["Peak Execution Memory"] == 0


def test_nothing_landed_and_search_on_the_index(spark, tmp_path):
    landing, index = str(tmp_path / "in"), segments.SegmentIndex(Store(spark, str(tmp_path / "store")))
    assert index.terms().count() == 0
    drop(spark, landing, [("a", 1, False, "one two"), ("b", 1, False, "two three")])
    index.refresh(landing)
    asked = search.query_terms(spark.createDataFrame([(1, "three")], "query_id int, query_text string"))
    assert [r.relative_path for r in search.score_terms(index.terms(), asked, "relative_path").collect()] == ["b"]
