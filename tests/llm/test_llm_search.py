"""Nearest neighbours, periodic runs and prefix tries against plain versions."""

import math
import os
import random
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from tidewater.llm import common, neighbours, periodic, queries, trie, warc  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- periodic runs ----------------------------------------------------------------------

def test_periodic_query(spark):
    rows = [tuple(r) for r in common.table(spark, SF, "documents").select("doc_id", "text").collect()]
    short = [r for r in rows if len(brute.words(r[1])) <= 600]
    found = {r[0]: r[:8] for r in got(queries.op12_periodic(spark, SF))}
    assert len(found) == len(rows) and any(r[1] for r in found.values())
    assert sorted((found[k] for k, _ in short), key=repr) == brute.periodic(short)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), max_size=6), st.integers(2, 14))
def test_runs_of_small_alphabets(texts, least):
    found = periodic.runs_of([" ".join(t).encode() for t in texts], least)
    half = max(1, least // 2)
    for t, rows in zip(texts, found):
        # Below two words of common prefix the bound on the work is none of the shortest run.
        want = [r for r in brute.runs(t, least) if r[1] - r[2] >= half]
        assert [tuple(r) for r in rows.tolist()] == want


def test_runs_of_words(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(brute.woven(0, [rng.choice("ab") for _ in range(rng.randint(0, 60))]))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, "x " * 500), (104, "a b c " * 100), (105, "é ü\n" * 30), (106, "x " * 11),
             (106, "x " * 12), (3, rows[3][1]), (None, "a b " * 20), (107, "a" * 100_000)]
    rows += [(i, "one two three four five " * 9 + "six") for i in range(200, 260)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    for weave in (True, False):
        assert [r[:8] for r in got(periodic.report(docs, weave))] == brute.periodic(rows, weave)
    clash = docs.withColumn("start", F.lit("s")).withColumn("n_runs", F.lit(1.5)).withColumn("runs", F.lit(None).cast("int"))
    assert got(periodic.report(clash)) == got(periodic.report(docs))
    assert got(periodic.found(docs)) == sorted(((k, *r) for k, t in rows for r in brute.runs(brute.words(t))), key=repr)
    texts = {r.doc_id: r.text for r in periodic.collapsed(docs.filter("doc_id in (103, 104, 100)")).collect()}
    assert texts == {103: "x", 104: "a b c", 100: ""}
    assert got(periodic.report(docs.limit(0))) == []


def test_runs_of_long_texts():
    assert [tuple(r) for r in periodic.runs_of([b"a b " * 60_000])[0].tolist()] == [(0, 120_000, 2)]
    words = [str(i % 977) for i in range(30_000)]
    assert [tuple(r) for r in periodic.runs_of([" ".join(words).encode()])[0].tolist()] == [(0, 30_000, 977)]
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    assert [tuple(r) for r in periodic.runs_of([" ".join(b).encode()])[0].tolist()] == brute.runs(list(b))


# --- prefix tries -----------------------------------------------------------------------

def test_trie_query(spark):
    rows = [tuple(r) for r in common.table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_trie(spark, SF)) == brute.trie(brute.conversations(rows))


def odd_turns():
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "é", ""]))
            for c in range(120) for t in range(rng.randint(0, 9))]
    # A hot first turn, many equal conversations, a long one, nulls, a turn given twice, gaps.
    rows += [(c, 0, "user", "hello") for c in range(200, 300)]
    rows += [(c, 1, "assistant", str(c % 7)) for c in range(200, 300)]
    rows += [(400, t, "user", str(t % 5)) for t in range(700)] + [(405, t, "user", str(t % 5)) for t in range(650)]
    rows += [(500, None, None, "first"), (500, 0, "user", None), (500, 7, None, None), (None, 0, "user", "x"),
             (501, 3, "user", "x"), (501, 3, "user", "x"), (501, 3, "user", "a"), (502, 1, "user", "bb")]
    return rows


def test_trie_of_odd_turns(spark):
    rows = odd_turns()
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    found = trie.sequences(turns)
    named = {r.conv_id: r.turns for r in found.collect()}
    assert len(named[501]) == 3 and len(named) == len({r[0] for r in rows if r[0] is not None})
    plain = [r for r in rows if r[0] != 501]
    want = brute.trie(brute.conversations(plain))
    some = trie.sequences(spark.createDataFrame(plain, TURNS).repartition(3)
                          .withColumn("turns", F.lit(1)).withColumn("name", F.lit("n")))
    for size in (1 << 17, 300, 40):
        assert got(trie.nodes(trie.rebuilt(some), size)) == want
    assert got(trie.nodes(trie.rebuilt(found.limit(0)))) == []


def test_trie_of_one_conversation(spark):
    one = spark.createDataFrame([(9, 0, "user", "hi")], TURNS)
    assert got(trie.nodes(trie.sequences(one))) == brute.trie({9: [("user", "hi")]})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=8), min_size=1, max_size=60, unique_by=tuple))
def test_double_array(lists):
    lists = sorted(lists)
    values = np.array([x for s in lists for x in s], np.int64)
    first = np.concatenate([[0], np.cumsum([len(s) for s in lists])]).astype(np.int64)
    made = trie.DoubleArray(values, first, 31)
    states = {}
    for depth, rows, state in made.walk(values, first):
        for r, s in zip(rows.tolist(), state.tolist()):
            assert s >= 0 and states.setdefault(s, tuple(lists[r][:depth])) == tuple(lists[r][:depth])
    assert len(states) == len({tuple(s[:d]) for s in lists for d in range(len(s) + 1)})
    for s, prefix in states.items():
        for x in range(31):
            child = int(made.child(np.array([s]), np.array([x]))[0])
            assert (child >= 0) == ((*prefix, x) in states.values())


# --- nearest neighbours -----------------------------------------------------------------

def vectors(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)


def recall(found, want):
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in found.get(q, [])}) for q in want)
    return hits / max(1, sum(map(len, want.values())))


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_neighbours_query(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in common.table(spark, SF, "embeddings").collect()]
    want = brute.nearest(rows, lambda i: i % 20 == 0)
    found = results(queries.op11_crosspolytope(spark, SF))
    assert set(found) == set(want) and all(len(found[q]) == len(want[q]) for q in want)
    assert recall(found, want) >= 0.9
    exact = dict(rows)
    for q, list_of in found.items():
        for v, s in list_of:
            assert math.isclose(s, sum(a * b for a, b in zip(exact[q], exact[v])), rel_tol=1e-12, abs_tol=1e-12)


def test_neighbours_of_clusters(spark):
    """Lengths that differ by magnitudes, near copies, and depths beyond one rotation."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 12))
    rows = [(i, (centre[i % 40] + 0.05 * rng.normal(size=12)) * 10.0 ** (i % 3)) for i in range(1600)]
    rows = [(i, x.tolist()) for i, x in rows]
    want = brute.nearest(rows, lambda i: i % 10 == 0, 10)
    found = results(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 10 == 0, 10))
    assert recall(found, want) >= 0.9 and all(len(found[q]) == 10 for q in want)


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, []), (8, [1.0]), (20, [2.0, 1.0]), (40, [-1.0, -0.0]), (None, [1.0, 1.0])]
    rows += [(100 + i, [3.0, 4.0]) for i in range(90)]
    want = brute.nearest(rows, lambda i: i % 20 == 0)
    df = vectors(spark, rows)
    found = results(neighbours.nearest(df.withColumn("name", F.lit(1)).withColumn("query", F.lit("q")), F.col("vec_id") % 20 == 0))
    assert found == want
    again = neighbours.nearest(df.unionByName(df), F.col("vec_id") % 20 == 0)
    assert results(again) == want
    assert results(neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0)) == {}
    assert results(neighbours.nearest(df, F.col("vec_id") == -1)) == {}
    assert results(neighbours.nearest(df.filter("vec_id = 0"), F.col("vec_id") == 0)) == {}


def test_hot_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    rng = np.random.default_rng(4)
    rows = [(i, (np.array([1.0, 2, 3, 4]) + 1e-3 * rng.normal(size=4)).tolist()) for i in range(300)]
    rows += [(i, rng.normal(size=4).tolist()) for i in range(300, 400)]
    want = brute.nearest(rows, lambda i: i % 4 == 0, 5)
    assert recall(results(neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 4 == 0, 5)), want) >= 0.9


@pytest.mark.parametrize("length", [1, 3, 64])
def test_rotations_keep_lengths(length):
    space = neighbours.Space("float64", length)
    x = space.directions(np.random.default_rng(1).normal(size=(20, length)))
    r = space.rotated(x, 1, 2)
    assert np.allclose((r * r).sum(1), 1) and np.allclose(r @ r.T, x @ x.T)
    cells = space.cells(x, 2)
    for t in range(neighbours.TABLES):
        for i in range(20):
            levels = [space.scores(x[i:i + 1], t, n)[0] for n in range(2)]
            assert cells[i, t] in space.probes(levels, 0.0)
            assert space.probes(levels, math.inf).size == (2 * space.size) ** 2


# --- archives read by several tasks -----------------------------------------------------

def test_archives_roll_and_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    """At the production bound a shard is several files, which as many tasks read as bytes ask for."""
    rng = random.Random(2)
    rows = [(i, f"u{i}", "".join(rng.choices("abcdefghijklmnopqrstuvwxyz <>", k=40_000))) for i in range(90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write(pages, f"file://{tmp_path}/a")
    files = manifest.collect()
    assert len(files) > 1 and len({f.shard for f in files}) == 1 and warc.ROLL_BYTES * 4 <= warc.SHARD_BYTES
    monkeypatch.setattr(warc, "READ_BYTES", 1 << 19)
    found = warc.read(manifest, f"file://{tmp_path}/a").withColumn("task", F.spark_partition_id())
    assert found.count() == 90 and found.select("task").distinct().count() > 1
