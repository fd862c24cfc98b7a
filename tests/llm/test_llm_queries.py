"""Registered queries against their SQL, and the pipeline against plain versions."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import brute  # noqa: E402
import __spark_entry__ as entry_point  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import duck, duck_rows, spark_rows  # noqa: E402
from tidewater.llm import common, pii, quality, queries, sql  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duck(SF)
    yield c
    c.close()


def test_registered():
    found = entry_point.queries()
    assert {n.split("_")[0] for n in found if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in found and set(sql.STATEMENTS) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(sql.STATEMENTS))
def test_query_equals_sql(spark, con, name):
    assert spark_rows(queries.QUERIES[name](spark, SF)) == duck_rows(con, sql.STATEMENTS[name])


def test_bytes_query(spark):
    rows = [tuple(r) for r in common.table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert spark_rows(queries.op2_suffixes(spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == \
        sorted(((k, s, n, r, p) for k, n, r, p, s in brute.repeated_bytes(rows, 200)), key=repr)


def test_personal_query(spark):
    rows = dict(tuple(r) for r in common.table(spark, SF, "documents").select("doc_id", "text").collect())
    for r in queries.op3_pii(spark, SF).collect():
        base = brute.personal(rows[r.doc_id])
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == brute.sha(listed.encode()) and set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_rules_query(spark):
    rows = dict(tuple(r) for r in common.table(spark, SF, "documents").select("doc_id", "text").collect())
    for r in queries.op5_rules(spark, SF).collect():
        n = brute.rule_counts(rows[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])


def test_pipeline_stages(spark):
    docs = common.table(spark, SF, "documents")
    columns, before = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = common.stored(stage(spark, before, SF))
        kept[name] = (before, after)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns and dict(after.dtypes) == dict(docs.dtypes)
        before = after
    ids = {name: ({r.doc_id for r in a.select("doc_id").collect()}, {r.doc_id for r in b.select("doc_id").collect()})
           for name, (a, b) in kept.items()}

    labels = common.table(spark, SF, "labels")
    model = quality.fit(docs, labels.filter(~quality.held_out()))
    good = {r.doc_id for r in quality.scored(docs, model).filter(F.col("score") >= 0.3).collect()}
    assert ids["quality classifier"][1] == good

    rows = [tuple(r) for r in kept["n-gram Jaccard join"][0].select("doc_id", "text").collect()]
    assert ids["n-gram Jaccard join"][1] == {k for k, _, c in brute.jaccard(rows) if k == c}

    rows = [tuple(r) for r in kept["benchmark decontamination"][0].select("doc_id", "text").collect()]
    items = [tuple(r) for r in common.table(spark, SF, "benchmark").collect()]
    assert ids["benchmark decontamination"][1] == {r[0] for r in brute.contamination(rows, items) if not r[5]}

    old = dict(tuple(r) for r in kept["personal data"][0].select("doc_id", "text").collect())
    for r in kept["personal data"][1].collect():
        assert brute.personal(r.text) == [] and r.n_chars == len(r.text)
        assert bool(brute.personal(old[r.doc_id])) == (r.text != old[r.doc_id])

    pieces = kept["best-fit packing"][1].toPandas()
    assert ids["best-fit packing"][1] == ids["personal data"][1]
    assert (pieces.groupby("sequence_id").length.sum() <= 1024).all()


def test_empty_pipeline(spark):
    docs = common.table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF))
    assert docs.count() == 0
