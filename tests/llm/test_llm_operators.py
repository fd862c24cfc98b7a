"""Operators against plain versions on small inputs: nulls, empty and long texts, ties,
repeated rows, empty tables and columns with clashing names."""

import os
import pathlib
import random
import sys
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from tidewater.llm import (common, decontaminate, graph, jaccard, langid, packing, pii, quality,  # noqa: E402
                           queries, recompress, repeats, rules, suffixes, warc)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def got(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def letters(n, size, seed=3):
    """Short texts of few different words, so that many windows repeat."""
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, size)))) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "a b " * 40), (1004, "a " * 50), (1005, "é ü\n" * 30),
                   (1006, rows[3][1]), (1007, rows[3][1]), (1008, "x" * 300)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(letters(60, 50), DOCS).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- language ---------------------------------------------------------------------------

def test_language_of_held_out_texts(spark):
    docs = common.table(spark, SF, "documents")
    found = queries.op1_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 40
    assert np.mean([r.lang == r.lang_pred for r in found]) >= 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_texts(spark):
    rows = [(i, "en", "the cat and the dog went to the house with that thing") for i in range(40)]
    rows += [(100 + i, "de", "der hund und die katze gehen nicht in das schöne haus") for i in range(40)]
    learned = langid.learn(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    odd = spark.createDataFrame([(1, "THE HOUSE and the cat"), (2, "die katze und das haus"), (3, None), (4, ""), (5, "12 .. 3"),
                                 (6, "the " * 60000), (7, "zzxxqqj " * 40), (2, "die katze und das haus")], DOCS)
    found = {r.doc_id: r for r in langid.identified(odd, learned, ["doc_id"]).collect()}
    assert [found[i].lang_best for i in range(1, 7)] == ["en", "de", "und", "und", "und", "en"]
    assert found[3].score == 0 and found[3].rejected
    assert found[7].rejected and not found[1].rejected
    assert {r.doc_id: r.lang for r in langid.language(odd, learned).collect()}[7] == "und"


def test_language_models_are_distributions():
    rows = np.array([[ord(c) for c in g] for g in ("    a", "   ab", "  ab ", "    b", "   b ")], np.uint64)
    model = langid.Model(rows, np.array([3, 2, 2, 1, 1]))
    # After the boundary come a or b, or something unseen.
    strip = langid.Strip(["a", "b"], langid.letters())
    logs = model.log_probabilities(strip, {n: strip.gram(n) for n in range(1, 6)}, {n: strip.context(n) for n in range(1, 5)})
    assert (logs < 0).all() and np.exp(logs[0]) + np.exp(logs[2]) <= 1


def test_language_without_labels(spark, odd, empty):
    nothing = langid.learn(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_best for r in langid.identified(odd, nothing, ["doc_id"]).collect()} == {"und"}
    assert got(langid.identified(empty, nothing, ["doc_id"])) == []


def test_language_models_keep_every_gram(spark, monkeypatch):
    monkeypatch.setattr(langid, "SHARD_GRAMS", 100_000, raising=False)
    rng = random.Random(8)
    vocabulary = {lang: ["".join(rng.choices(signs, k=8)) for _ in range(n)]
                  for lang, signs, n in (("x", "abcdefghijklmnopqrstuvwxyz", 60_000), ("y", "abcdeé𐐨", 3_000))}
    rows = [(i, lang, " ".join(words[k:k + 200])) for lang, words in vocabulary.items()
            for i, k in enumerate(range(0, len(words), 200))]
    learned = langid.learn(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    # Plain models: all n-grams of all texts, in one piece.
    entropy, texts = {}, [" ".join(vocabulary["x"][-300:]), " ".join(vocabulary["y"][:300]), "new words", "ß"]
    for lang, words in vocabulary.items():
        count = Counter(w[i:i + 5] for w in (f"    {w} " for w in words) for i in range(len(w) - 4))
        model = langid.Model(np.array([[ord(c) for c in g] for g in count], np.uint64), np.array(list(count.values())))
        for text in texts:
            strip = langid.Strip(text.split(), langid.letters())
            logs = model.log_probabilities(strip, {n: strip.gram(n) for n in range(1, 6)}, {n: strip.context(n) for n in range(1, 5)})
            entropy.setdefault(text, {})[lang] = -logs.mean()
    found = {r.text: r for r in langid.identified(spark.createDataFrame([(0, t) for t in [*texts, ""]], DOCS), learned, ["text"]).collect()}
    for text in texts:
        lang = min(entropy[text], key=entropy[text].get)
        odds = sum(np.exp(-min(50, len(text.replace(" ", ""))) * (e - entropy[text][lang])) for e in entropy[text].values())
        assert found[text].lang_best == lang and found[text].cross_entropy == pytest.approx(entropy[text][lang], rel=1e-9)
        assert found[text].score == pytest.approx(1 / odds)
    assert found[""].lang_best == "und"


# --- repeated substrings ----------------------------------------------------------------

@pytest.mark.parametrize("hot", [1, 1000])
def test_repeated_bytes(spark, odd, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = [tuple(r) for r in odd.collect()] + [(5, "ab" * 30), (5, "ab" * 30), (None, "ab" * 25)]
    df = spark.createDataFrame(rows, DOCS)
    assert got(suffixes.removed(df, 20, 6)) == brute.repeated_bytes(rows, 20)


def test_repeated_bytes_of_nothing(empty):
    assert got(suffixes.removed(empty)) == []


def test_kept_bytes_are_what_the_digest_says(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = spark.createDataFrame([(1, "x" + text), (2, "y" + text[:400]), (3, "z")], DOCS)
    found = suffixes.removed(rows, with_text=True).collect()
    assert {r.doc_id: bytes(r.kept).decode() for r in found} == {1: "x" + text[400:], 2: "y", 3: "z"}
    assert all(brute.sha(bytes(r.kept)) == r.kept_sha256 for r in found)


def around(passage, n, seed=2):
    """Texts of their own around one passage; every third occurs twice."""
    rng = random.Random(seed)
    own = ["".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(n)]
    rows = [(i, text[:200] + passage + text[200:]) for i, text in enumerate(own)]
    return rows + [(n + i, text) for i, text in rows[::3]]


def test_segments_of_a_frequent_anchor_fall_apart_in_few_rows(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 20)
    rng = random.Random(7)
    rows = around("".join(rng.choice("ijklmn ") for _ in range(500)), 60)
    df, made = spark.createDataFrame(rows, DOCS), []
    plain = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda *a, **b: made.append(plain(*a, **b)) or made[-1])
    assert got(suffixes.removed(df)) == brute.repeated_bytes(rows, 200)
    # A text has 700 windows, of which 300 lie across an edge of the passage; 40 at an edge share 162 bytes.
    assert max(m.count() for m in made) < 80 * len(rows)


@pytest.mark.parametrize("operator", [suffixes, recompress])
def test_texts_without_repeats_pass_one_worker(spark, operator):
    found = operator.removed(spark.createDataFrame(around("passage " * 60, 9), DOCS))
    # Two for the texts that a shuffle parts, one for the others.
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 3


def test_suffixes_of_several_texts_start_at_their_anchors():
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"abc ") for _ in range(size)) for size in (0, 90, 11, 300, 12)]
    window, gram = 12, 4
    made = suffixes.Suffixes(texts, window, gram)
    text, start, n, anchor, _ = suffixes.anchored(texts, window, gram)
    assert set(text.tolist()) == {1, 3, 4}
    for i, a, size, least in zip(text.tolist(), start.tolist(), n.tolist(), anchor.tolist()):
        piece, suffix, before = made.at(i, a, size)
        assert piece == texts[i][a:a + size + window - 1] == suffixes._text_of(suffix, before)
        name = common.grams(np.frombuffer(piece, np.uint8).astype(np.uint64) + common.GOLD, gram).tolist()
        assert before == name.index(min(name)) and name[before] == least


def test_loser_tree_merges_with_shared_prefixes():
    rng = random.Random(5)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(0, 30)))
            for _ in range(7)]
    encoded = [suffixes.encoded([(s, 0, i, False) for s in run]) for i, run in enumerate(runs)]
    merged, last = [], b""
    for (text, *_), same in suffixes.LoserTree([suffixes.decoded(e) for e in encoded]):
        assert same <= len(os.path.commonprefix([last, text]))
        assert same == len(os.path.commonprefix([last, text])) or not merged
        merged.append(text)
        last = text
    assert merged == sorted(s for run in runs for s in run)
    assert list(suffixes.LoserTree([])) == []


@pytest.mark.parametrize("hot", [1, 1000])
def test_repeated_words(spark, odd, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = [tuple(r) for r in odd.collect()] + [(5, "a b " * 15), (2000, "q r s " * 9), (2000, "q r s " * 9), (None, "a b " * 15)]
    df = spark.createDataFrame(rows, DOCS)
    assert got(recompress.removed(df, 16, 1, 3)) == brute.repeated_words(rows, 16)


def test_repeated_words_of_nothing(empty):
    assert got(recompress.removed(empty)) == []


def test_equal_windows_get_equal_anchors():
    rng = random.Random(2)
    window = [rng.choice("abc") for _ in range(50)]
    texts = []
    for _ in range(40):
        before, after = ([rng.choice("abc") for _ in range(rng.randint(0, 60))] for _ in range(2))
        texts.append((len(before), " ".join(before + window + after).encode()))
    words = common.Words([t for _, t in texts])
    text, start, size, anchor = recompress.anchored(words, 50, recompress.ROUNDS, recompress.PHRASE)
    found = {a for t, s, n, a in zip(text, start, size, anchor) if s <= texts[t][0] < s + n}
    assert len(found) == 1


# --- personal data ----------------------------------------------------------------------

def test_personal_base_spans():
    rng = random.Random(1)
    for _ in range(20000):
        text = "".join(rng.choice("ab1.9 -+@()25é0") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == brute.personal(text)


@pytest.mark.parametrize("text, kind, part", [
    ("write joe.doe (at) mail [dot] example [dot] com now", "email", "joe.doe (at) mail [dot] example [dot] com"),
    ("jane at mail dot example dot com", "email", "jane at mail dot example dot com"),
    ("joe＠mail．example．com", "email", "joe＠mail．example．com"),
    ("plus four nine one seven six five five five one two three four", "phone", None),
    ("at one nine two dot one six eight dot one dot one there", "ip", "one nine two dot one six eight dot one dot one"),
    ("card ４５３９ １４８８ ０３４３ ６４６７ x", "card", "４５３９ １４８８ ０３４３ ６４６７"),
])
def test_personal_disguises(text, kind, part):
    base, every = pii.Finder().spans(text)
    assert [(pii.KINDS[k], text[a:b]) for a, k, b in every if (a, k, b) not in base] == [(kind, part or text)]


@pytest.mark.parametrize("text, kind, part", [
    ("call +1 2 0 2 5 5 5 zero 1 four 7", "phone", "+1 2 0 2 5 5 5 zero 1 four 7"),
    ("«+1 202 555 01 4seven» or +1 202 555 01 four7 or «+1 202 555 01 4 seven»", "phone", "+1 202 555 01 4 seven"),
    ("card 4539 1488 0343 six four six seven", "card", "4539 1488 0343 six four six seven"),
    ("in 2012, four five three nine 1488 0343 6467", "card", "four five three nine 1488 0343 6467"),
    ("at １９２．１６８．１．２００ one two", "ip", "１９２．１６８．１．２００"),
    ("ask jane at mail dot example dot museum today", "email", "jane at mail dot example dot museum"),
    ("jane arobase exemple point paris", "email", "jane arobase exemple point paris"),
])
def test_personal_partly_disguised(text, kind, part):
    finder = pii.Finder()
    for other in ("", " (at) "):  # unrelated text changes nothing
        base, every = finder.spans(text + other)
        assert [(pii.KINDS[k], text[a:b]) for a, k, b in every if (a, k, b) not in base] == [(kind, part)]


def test_personal_leaves_prose_alone():
    finder = pii.Finder()
    for text in ("She was at this point tired.", "Look at some dot above, at the dot near it.", "un point de vue, 7 ou 8"):
        assert finder.spans(text) == ([], [])


def test_personal_leaves_clean_texts_alone():
    finder = pii.Finder()
    for text in ("", "We met at the dot of noon.", "one two three", "un deux trois quatre", "Αθήνα и Москва", "a@b", "1.2.3", "v1.2"):
        assert finder.spans(text) == ([], [])


def test_personal_columns(spark, empty):
    rows = [(1, "é a@b.co, a@b.co 1.2.3.4"), (2, None), (3, ""), (3, ""), (4, "4539148803436467 +49 (30) 1234567"), (5, "x " * 100000 + "a@b.co")]
    found = {r.doc_id: r for r in pii.found(spark.createDataFrame(rows, DOCS)).collect()}
    assert found[1].spans == "email:2:8,email:10:16,ip:17:24" and found[1].n_email == 2 and found[1].n_ip == 1
    assert found[2].spans == "" and found[2].base_sha256 == brute.sha(b"")
    assert (found[4].n_card, found[4].n_phone) == (1, 1)
    assert found[5].spans == "email:200000:200006"
    assert got(pii.found(empty)) == []


def test_personal_data_masked(spark):
    docs = spark.createDataFrame([(1, "to a@b.co or 1.2.3.4", "en", 20, "k"), (2, None, None, None, "k")],
                                 "doc_id long, text string, lang string, n_chars long, spans string")
    assert got(pii.clean(docs)) == [(1, "to [EMAIL] or [IP]", "en", 18, "k"), (2, None, None, None, "k")]


# --- near duplicates --------------------------------------------------------------------

def near_copies(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, key = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, 90))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((key, " ".join(copy)))
            key += 1
    rng.shuffle(rows)
    return rows + [(500, None), (501, ""), (502, " \n"), (503, "A b"), (504, "a  B"), (505, "w0 " * 30), (506, "W0 " * 40)]


@pytest.mark.parametrize("region", [4, 512])
def test_near_duplicates(spark, region, monkeypatch):
    monkeypatch.setattr(jaccard, "REGION", region)
    rows = near_copies()
    assert got(jaccard.components(spark.createDataFrame(rows, DOCS).repartition(3))) == brute.jaccard(rows)


def test_pairs_are_joined_in_their_first_common_region():
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 1 << 60, 300, dtype=np.uint64))
    sets = [x, x[4:], np.unique(rng.integers(0, 1 << 60, 300, dtype=np.uint64))]
    n = np.array([s.size for s in sets])
    drawn = [jaccard.sketch(s, jaccard.sketch_bits(s.size)).tobytes() for s in sets]
    assert jaccard.partnered(n, drawn, [set(), {5}, {5}]).tolist() == [True, True, False]
    assert jaccard.partnered(n, drawn, [{3, 5}, {5}, set()]).tolist() == [False, False, False]
    assert jaccard.partnered(n, drawn, [{3}, {5}, {3}]).tolist() == [True, True, False]
    node = np.array([1, 2, 3])
    assert jaccard.partnered(n, drawn, head=np.array([False, True, False]), node=node).tolist() == [True, True, False]
    assert not jaccard.partnered(n, drawn, head=np.array([False, False, True]), node=node).any()
    assert not jaccard.partnered(n, drawn, head=np.array([True, True, True]), node=np.array([1, 1, 3])).any()


def test_regions_keep_documents_of_near_sizes(spark):
    member = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (4, 4), (4, 5)], "pivot long, node long")
    sets = spark.createDataFrame([(1, 100), (2, 75), (3, 200), (4, 100), (5, 74)], "node long, n long")
    assert got(jaccard._sized(member, sets)) == [(1, 1, 100), (1, 2, 75)]


def test_large_regions_of_unlinked_documents(spark, monkeypatch):
    """Texts of one common passage and own words: few of them link, and those must be found."""
    monkeypatch.setattr(jaccard, "REGION", 8)
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"w{rng.randrange(10 ** 9)}" for _ in range(40)])) for i in range(60)]
    rows += [(100 + i, rows[7 * i][1] + " more") for i in range(6)]
    monkeypatch.setattr(jaccard, "TOLD", 2)
    assert got(jaccard.components(spark.createDataFrame(rows, DOCS).repartition(3))) == brute.jaccard(rows)


def test_index_packs_hold_all_entries():
    rng = np.random.default_rng(4)
    low = (1 << 33) + np.arange(900)
    node, s = np.repeat(low, 20), rng.integers(0, 1 << jaccard.INDEX_BITS, 18_000, dtype=np.uint64)
    s[rng.integers(0, s.size, 3000)] = s[rng.integers(0, s.size, 3000)]
    made = [pa.Table.from_batches(jaccard.packs(node[part], s[part])) for part in (slice(0, 9000), slice(9000, None))]
    table = pa.concat_tables(made)
    assert sum(map(len, table.column("data").to_pylist())) == 6 * s.size
    found = set()
    for bucket in set(table.column("bucket").to_pylist()):
        part = table.filter(pa.compute.equal(table.column("bucket"), bucket))
        for batch in jaccard.regions(part):
            found |= set(zip(batch.column("pivot").to_pylist(), batch.column("node").to_pylist()))
    holders = {}
    for x, y in zip(s.tolist(), node.tolist()):
        holders.setdefault(x, set()).add(y)
    assert found == {(min(h), y) for h in holders.values() if len(h) > 1 for y in h} and found


def shuffle_bytes(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f: f.stat().st_size for d in folders for f in pathlib.Path(d.getPath()).glob("*/shuffle_*.data")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_bytes(spark)
    assert got(common.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()).agg(F.sum("count"))) == [(1000,)]
    for _ in range(100):
        left = [n for f, n in shuffle_bytes(spark).items() if f not in before]
        if sum(left) < 1000:
            break
        time.sleep(0.1)
    assert sum(left) < 1000 and spark.conf.get(common.CLEANUP, "false") != "true"


def test_copies_go_without_a_shuffle_of_their_texts(spark):
    rng = random.Random(5)
    text = " ".join(f"{rng.randrange(10 ** 12)}" for _ in range(2000))
    docs = spark.createDataFrame([(i, text + " " * i) for i in range(200)], DOCS).repartition(4)
    found = jaccard.distinct(common.stored(docs))
    before = shuffle_bytes(spark)
    assert [r.doc_id for r in found.collect()] == [0]
    assert sum(n for f, n in shuffle_bytes(spark).items() if f not in before) < 500_000


def test_frequent_shingles_change_no_result(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", 2)
    rows = near_copies(9)
    assert got(jaccard.components(spark.createDataFrame(rows, DOCS))) == brute.jaccard(rows)


def test_one_document_of_each_component(spark, empty):
    rows = [(3, "a b c d e f", "x"), (1, "A b c d e f", "y"), (1, "A b c d e f", "y"), (2, "other words", "z"), (4, None, "z"), (5, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    assert got(jaccard.distinct(docs)) == [(1, "A b c d e f", "y"), (2, "other words", "z"), (4, None, "z"), (5, None, "z")]
    assert got(jaccard.components(empty)) == [] and got(jaccard.distinct(empty)) == []


def test_one_document_of_each_component_with_clashing_columns(spark):
    rows = [(3, "a b c d e f", 7, "p", 1), (1, "A b c d e f", 8, "q", 2), (1, "A b c d e f", 8, "q", 2), (2, "other words", 9, "r", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _set long, _place string, _own_set long")
    found = jaccard.distinct(docs)
    assert found.columns == docs.columns
    assert got(found) == [(1, "A b c d e f", 8, "q", 2), (2, "other words", 9, "r", 3)]


def test_rows_of_one_id_are_told_apart(spark):
    a, b, c = ("a b c d e f g h i j k l m n o p q r s t", "other words of a clean text", "yet another clean text here")
    rows = [(3, a + " u"), (7, a), (7, b), (7, b), (7, b.upper() + " "), (3, c), (8, c), (7, None), (7, None), (None, a)]
    found = got(jaccard.distinct(spark.createDataFrame(rows, DOCS)).withColumn("text", F.lower(F.trim("text"))))
    assert found == sorted([(3, a + " u"), (7, b), (3, c), (7, None), (None, a)], key=repr)


def test_region_recursion_is_exact():
    rng = np.random.default_rng(0)
    base = [np.unique(rng.integers(0, 1 << 60, 60, dtype=np.uint64)) for _ in range(12)]
    sets = [np.unique(np.concatenate([rng.choice(b, int(rng.integers(45, 60)), replace=False),
                                      rng.integers(0, 1 << 60, int(rng.integers(0, 6)), dtype=np.uint64)]))
            for b in base for _ in range(15)]
    region = jaccard.Region(sets)
    region.join(np.arange(len(sets)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = np.intersect1d(x, y).size
            if 100 * both >= 75 * (x.size + y.size - both):
                assert region.root(i) == region.root(j)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    assert got(graph.components(edges)) == sorted([(i, 0) for i in range(41)] + [(100, 100), (101, 100)], key=repr)


# --- quality ----------------------------------------------------------------------------

def test_rule_counts():
    rng = random.Random(0)
    texts = ["", "  ", "é ü\n\n a b"] + ["".join(rng.choice(["a ", "b ", "\n", "é ", "# ", " x\t", "\r\n", "\x0b"])
                                                 for _ in range(rng.randint(0, 80))) for _ in range(300)]
    counts, _ = rules.statistics([t.encode() for t in texts])
    assert [tuple(c) for c in counts.tolist()] == [brute.rule_counts(t) for t in texts]


def test_forest_isolates_the_odd_ones():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.normal(0, 1, (500, 3)), rng.normal(9, 0.3, (10, 3))])
    score = rules.Forest(rows).scores(rows)
    assert score[500:].min() > np.quantile(score[:500], 0.98)
    assert rules.Forest(rows[:0]).scores(rows).tolist() == [0.0] * 510
    assert rules.calibrated(np.array([.1, .2, .3]), np.array([.6, .7]), rows[:0]) == pytest.approx(.3, abs=.01)


def test_rules_verdicts(spark, empty):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    found = queries.op5_rules(spark, SF).join(labels, "doc_id").collect()
    good = [r for r in found if r.quality == 1 and not r.base_failed]
    assert np.mean([r.kept for r in good]) >= 0.97
    assert np.mean([r.kept for r in found if r.quality == 0]) <= 0.3
    assert not any(r.kept for r in found if r.base_failed)
    forest = rules.fit(docs.withColumn("_label", F.lit("own")), labels.limit(0))
    assert got(rules.judged(empty, forest)) == []
    odd = {r.doc_id: r for r in rules.judged(spark.createDataFrame([(1, None), (2, ""), (2, "")], DOCS), forest).collect()}
    assert odd[1].base_failed and not odd[1].kept and odd[2].n_words == 0
    assert got(rules.judged(empty, rules.fit(empty, labels))) == []


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = (queries.op9_quality(spark, sf).join(common.table(spark, sf, "labels"), "doc_id").filter("held_out").collect())
    bad = [r.score for r in found if r.quality == 0]
    good = [r.score for r in found if r.quality == 1]
    assert len(bad) >= 5 and np.mean([g > b for g in good for b in bad]) >= 0.9
    assert np.mean([r.predicted for r in found if r.quality == 1]) >= 0.98


def test_classifier_edges(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 1)], "doc_id long, quality int")
    model = quality.fit(odd, labels)  # one class only
    found = quality.scored(odd.withColumn("score", F.lit("x")), model).collect()
    assert len(found) == odd.count() and {r.score for r in found} == {1.0}
    assert got(quality.scored(empty, model)) == []
    assert quality.fit(empty, labels.limit(0)).share == 1
    vectors, first = quality.passages([b"", b"a " * 200, b" "])
    assert np.diff(first).tolist() == [1, 4, 1] and np.isfinite(vectors).all()


def test_attention_learns_from_bags():
    rng = np.random.default_rng(0)
    bags, label = [], []
    for i in range(200):
        x = rng.normal(0, 1, (rng.integers(1, 8), quality.FEATURES + quality.HASHED))
        if i % 2:
            x[rng.integers(len(x)), 0] = 6  # one passage decides
        bags.append(x)
        label.append(i % 2)
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    x = np.concatenate(bags)
    model = quality.Model(0.5).fit(x, first, np.array(label, float), np.ones(200))
    assert np.mean((model.scores(x, first) > 0.5) == np.array(label, bool)) > 0.95


# --- decontamination --------------------------------------------------------------------

@pytest.mark.parametrize("block", [10, 200_000])
def test_contamination(spark, block, monkeypatch, empty):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rng = random.Random(6)
    vocabulary = [f"W{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "..."), (53, "été, W1!"), (3, items[0][1])]
    rows = []
    for i in range(40):
        part = items[rng.randrange(12)][1]
        rows.append((i, " ".join([*(f"x{rng.randrange(50)}" for _ in range(rng.randint(0, 40))), part, "y"]).lower()))
    rows += [(100, None), (101, ""), (102, "?!"), (103, "Été été w1"), (7, rows[7][1]), (104, " ".join(vocabulary) * 3)]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert got(decontaminate.hits(docs, bench, with_text=False)) == brute.contamination(rows, items)
    assert got(decontaminate.hits(empty, bench)) == []
    assert all(not r.contaminated for r in decontaminate.hits(docs, bench.limit(0)).collect())


def test_clean_documents_stay_with_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "wxy"]
    docs = spark.createDataFrame([(1, texts[0], 5), (2, "something else", 6), (3, texts[2], 7)], "doc_id long, text string, _row int")
    bench = spark.createDataFrame([(8, texts[0]), (9, texts[1])], "item_id long, text string")
    found = decontaminate.clean(docs, bench)
    assert found.columns == docs.columns and got(found) == [(2, "something else", 6), (3, texts[2], 7)]


def test_clean_documents_stay(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, 5), (2, "something else", 6), (3, None, 7)], "doc_id long, text string, n_words int")
    bench = spark.createDataFrame([(9, text)], "item_id long, text string")
    assert got(decontaminate.clean(docs, bench)) == [(2, "something else", 6), (3, None, 7)]
    longest = {r.item_pos: (r.length, r.doc_pos) for r in decontaminate.longest(docs, bench).collect()}
    assert longest[0] == (30, 0) and longest[17] == (13, 17) and len(longest) == 18


# --- archives ---------------------------------------------------------------------------

PAGES = [(3, "http://a\nb", "x"), (1, None, "x"), (2, "u", None), (7, "u", ""), (None, "u", "x"), (5, "u", "y" * 500),
         (5, "u", "y" * 500), (9, "u", "y" * 500), (10, "é", "z"), (11, "u", "l" * 300_000)]


@pytest.mark.parametrize("least", [0, 1, 2])
def test_archives_round_trip(spark, least, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 200)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(4)
    folder = common.shared_folder(spark)
    found = warc.read(warc.write(pages, folder, least, roll=400), folder)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got(found, *columns) == brute.archive([(p, h) for p, _, h in PAGES], least)


def test_archives_are_the_same_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 200)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    files = [got(warc.write(p, common.shared_folder(spark)), "file", "sha256") for p in (pages.repartition(5), pages.coalesce(1))]
    assert files[0] == files[1] and len(files[0]) > 2
    folder = common.shared_folder(spark)
    assert got(warc.read(warc.write(pages.limit(0), folder), folder)) == []


def test_files_outside_the_manifest_are_not_read(spark):
    pages = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")
    folder = common.shared_folder(spark)
    manifest = warc.write(pages, folder)
    path = folder.removeprefix("file://")
    with open(f"{path}/000099-00000.warc.gz", "wb") as f:
        f.write(b"left by a lost attempt")
    assert warc.read(manifest, folder).count() == 3


# --- packing ----------------------------------------------------------------------------

ODD_TEXTS = ["", " ", "\n", "a  b", "a   b", "  a", " a ", "a\n\n", "a\n\nb", "a \nb", "a\n b", "\n\nx", "it's 's x's", "a\tb c",
             "x<|endoftext|>y z", "é\xa0ü b", "　a b", "'s it", "12 34 ab12 !!? ,.", "a \n", "\n a", "don't  we'll",
             "a\x1cb", "日本語 テキスト 🎉", "word " * 3000]


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer
    files = queries.tokenizer()
    encoder = packing.Encoder(**files, end_id=2)
    plain = Tokenizer.from_file(files["tokenizer"])
    ids, counts = encoder.encode(ODD_TEXTS * 2)
    at = 0
    for text, n in zip(ODD_TEXTS * 2, counts.tolist()):
        assert ids[at:at + n].tolist() == plain.encode(text, add_special_tokens=False).ids + [2], text
        at += n


@pytest.mark.parametrize("low, high", [(1, 1024), (300, 700), (340, 350), (1, 5)])
def test_bins(low, high):
    sizes = np.random.default_rng(0).integers(low, high, 1500)
    first = packing.best_fit(sizes, 1024)
    better = packing.improve(sizes, first, 1024)
    assert np.bincount(better, sizes).max() <= 1024
    assert len(set(better.tolist())) <= first.max() + 1
    if high - low > 500:
        assert len(set(better.tolist())) <= 1.03 * sizes.sum() / 1024


def test_exchange_empties_a_bin():
    sizes = np.array([6, 4, 5, 3, 2])  # best: 6 + 4, 5 + 3 + 2
    assert len(set(packing.improve(sizes, np.array([0, 1, 1, 0, 2]), 10).tolist())) == 2


def test_sequences(spark, monkeypatch, empty):
    monkeypatch.setattr(packing, "SHARD_PIECES", 8)
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(99, None), (99, None)]
    found = packing.pack(packing.pieces(spark.createDataFrame(rows, DOCS), **queries.tokenizer())).toPandas()
    assert len(found) == len(rows) + 2
    groups = found.sort_values("offset").groupby("sequence_id")
    assert (groups.length.sum() <= 1024).all()
    for _, g in groups:
        assert (g.offset == g.length.cumsum() - g.length).all()
    long = found[found.doc_id == len(ODD_TEXTS) - 1].sort_values("piece")
    assert long.length.tolist()[1:] == [1024, 1024] and (long.start.diff()[1:].values == long.length[:-1].values).all()
    assert got(packing.pack(packing.pieces(empty, **queries.tokenizer()))) == []
