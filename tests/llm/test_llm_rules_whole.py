"""The forest and its threshold come from all documents and labels."""

import numpy as np

from tidewater.llm import rules


def test_forest_and_threshold_use_all_rows(spark):
    rng = np.random.default_rng(3)
    words = ["word", "other", "longer", "a", "text", "some!", "#"]
    docs = [(i, " ".join(rng.choice(words, 30 + i % 9))) for i in range(9001)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    features = rules._features(docs)
    rows = features.selectExpr("f", "pmod(xxhash64(doc_id, f), 128) AS _tree")
    n = rows.count()
    forest = rules._grown(rows)
    assert n > 8192 and len(forest.trees) == rules.TREES
    shares = -(-rules.TREES * rules.TREE_ROWS // n)
    roots = rules._nodes(rows, [tuple(np.array(a) for a in ([-1], [0.0], [0], [0.0]))] * rules.TREES,
                         [[0]] * rules.TREES, shares)
    assert sum(r.n for r in roots.collect()) == n * shares
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS quality")
    seen = []
    kept, rules.parted = rules.parted, lambda *c: seen.append([int(x.sum()) for x in c]) or kept(*c)
    try:
        rules.fit(docs, labels)
    finally:
        rules.parted = kept
    odd = features.where("doc_id % 2 = 1").count()
    assert seen == [[odd, n - odd, n]]
