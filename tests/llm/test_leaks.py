import random

import numpy as np
import pytest

from starweave.llm import leaked_passages as lp
from starweave.llm import queries

VOCAB = [f"word{i}" for i in range(700)]


def edit(rng, words, n):
    words = list(words)
    for _ in range(n):
        i, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[i] = "changed"
        elif kind == 1:
            words.insert(i, "added")
        else:
            del words[i]
    return words


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    items = [(i, [rng.choice(VOCAB) for _ in range(rng.randint(60, 140))]) for i in range(40)]
    docs, want = [], set()
    for d in range(600):
        text = [rng.choice(VOCAB[: 200 if d % 2 else 700]) for _ in range(rng.randint(0, 150))]
        if d % 3 == 0:
            item, words = rng.choice(items)
            size = rng.choice([30, 40, 60])
            at = rng.randint(0, len(words) - size)
            text[len(text) // 2 : len(text) // 2] = edit(rng, words[at : at + size], rng.randint(0, size // 10))
            want.add((item, 1000 + d))
        elif d % 3 == 1:
            item, words = rng.choice(items)
            part = words[:18] if d % 2 else rng.sample(words[:50], 50)
            text += part
        docs.append((1000 + d, "_".join(w.upper() if d % 5 == 0 else w for w in text) + "."))
    return items, docs, want


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS item_id", "0 AS codes")
    i = spark.createDataFrame(items, "item_id long, item_text string").selectExpr("*", "'x' AS doc_id")
    return lp.leaked_passages(d, i).collect()


def test_leaks_are_found_whole(spark, corpus):
    items, docs, want = corpus
    got = run(spark, docs + docs[:9], [(i, " - ".join(w)) for i, w in items])
    assert {(r.item_id, r.doc_id) for r in got} == want and len(got) == len(want)
    assert all(r.passage_words >= 30 and r.edits * 10 <= r.passage_words for r in got)


def test_item_blocks_give_the_same(spark, corpus, monkeypatch):
    items, docs, want = corpus
    monkeypatch.setattr(lp, "ITEM_BLOCK", 15)
    assert {(r.item_id, r.doc_id) for r in run(spark, docs, [(i, " ".join(w)) for i, w in items])} == want


def test_missing_empty_and_long(spark, corpus):
    items, _, _ = corpus
    text = " ".join(items[0][1])
    docs = [(1, None), (2, ""), (3, " ... "), (4, text), (5, "x " * 40_000 + text), (6, " ".join(items[0][1][:26]))]
    assert {(r.item_id, r.doc_id, r.has_answer) for r in run(spark, docs, [(0, text), (7, None), (8, "")])} == {(0, 4, True), (0, 5, True)}
    assert run(spark, docs, []) == [] and run(spark, [], [(0, text)]) == []


def brute_best(item, doc, least, tolerance):
    """Does any part of the item come within the tolerance of any run of the document?"""
    for i in range(len(item)):
        for e in range(i + least, len(item) + 1):
            part, limit = item[i:e], (e - i) // tolerance
            row = [0] * (len(doc) + 1)
            for a, w in enumerate(part):
                last, row[0] = row[0], a + 1
                for j, x in enumerate(doc):
                    last, row[j + 1] = row[j + 1], min(last + (w != x), row[j] + 1, row[j + 1] + 1)
            if min(row) <= limit:
                return True
    return False


def test_alignment_equals_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        item = [rng.randrange(30) for _ in range(rng.randint(30, 36))]
        doc = [rng.randrange(30) for _ in range(5)] + edit(rng, item[: rng.randint(24, 36)], rng.randint(0, 5)) + [rng.randrange(30) for _ in range(5)]
        doc = [x if isinstance(x, int) else -1 for x in doc]
        held = lp.ItemSet([0], {}, [np.array(item, np.int32)], np.empty((0, 24)), np.empty(0), *_index(item))
        found = bool(list(lp.check_document(held, np.array(doc, np.int32), {0}, 30, 10)))
        assert found == brute_best(item, doc, 30, 10)


def _index(item):
    h = lp.run_hashes(np.array(item, np.int32), lp.SEED)
    order = np.argsort(h)
    return h[order], np.zeros(len(h), int), np.arange(len(h))[order]


def test_given_tables_against_shared_runs(spark):
    """Recall of the latent search on the given tables: every document that shares a long run is found."""
    from tests.conftest import DATA

    d = spark.read.parquet(f"{DATA}/documents.parquet").where("text is not null").collect()
    i = spark.read.parquet(f"{DATA}/eval_items.parquet").collect()
    held = lp.ItemSet.of([(r.item_id, r.item_text) for r in i])
    want = set()
    for r in d:
        codes = np.array([held.vocabulary.get(w, -1) for w in lp.words_of(r.text)], np.int32)
        want |= {(held.ids[k], r.doc_id) for k, *_ in lp.check_document(held, codes, set(range(len(held.ids))), 30, 10)}
    assert {(r.item_id, r.doc_id) for r in queries.p7_found(spark, DATA).collect()} == want


def test_the_longest_passage_of_a_document_counts(spark, corpus):
    rng = random.Random(4)
    item = [rng.choice(VOCAB) for _ in range(100)]
    other = [f"other{i}" for i in range(50)]
    docs = [(1, " ".join(item[:32] + other + item)), (2, " ".join(item[:35] + other + item[40:])), (3, " ".join(item[60:95] + other + edit(rng, item[:50], 2)))]
    got = {r.doc_id: (r.passage_words, r.edits) for r in run(spark, corpus[1] + docs, [(7, " ".join(item))])}
    assert got[1] == (100, 0) and got[2][0] >= 60 and got[3][0] >= 45
