import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starweave.llm import tokenise_corpus as tc

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'k' AS key")
    return tc.tokenise(df, "doc_id", "text", PATH, PATTERN).collect()


def test_round_trip_of_odd_texts(spark, reference):
    rng = random.Random(6)
    parts = ["word", " the", "\n", "\r\n", "\t", "  ", "日本", "é", "👍🏽", "1234", "!!", "'s", "'re", "<|endoftext|>", "\u3000", "\u200b", "x" * 40, "{", '"', "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 900))) for _ in range(60)]
    shared = "// Licence header of many files, the same everywhere.\n" * 30
    texts += [shared + t for t in texts[:20]] + [" ", "\n", "a", "x" * 70_000, "日" * 20_000, "ab " * 30_000, "q" + " " * 50_000 + "r", "\n" * 30_000, "'" * 9_000]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.ids for r in run(spark, rows)}
    assert [got[i] for i in range(len(texts))] == reference(texts)


def test_missing_repeated_and_conflicting(spark, reference):
    rows = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (4, "one"), (4, "two"), (None, "x")]
    got = sorted(((r.doc_id, list(r.ids)) for r in run(spark, rows)), key=str)
    one, two, same, x = reference(["one", "two", "same text", "x"])
    assert got == sorted([(1, []), (2, []), (3, same), (4, one), (4, two), (None, x)], key=str)
    assert run(spark, []) == []


@pytest.fixture(scope="module")
def enc():
    with open(PATH, "rb") as f:
        return tc.encoder(f.read(), PATTERN)


PARTS = ["a", "b", " ", "  ", "\n", "é", "日", "1", "22", ".", "!!", "'s", "'re", "'", "\t", "word", "Hello", "\u3000", "👍", "\r\n", "\x85", "\x1c", "字字字", "\u0378", "\U0001ecb0"]


def test_independent_places_split_the_encoding(enc):
    rng = random.Random(5)
    found = 0
    for _ in range(1500):
        data = "".join(rng.choice(PARTS) for _ in range(rng.randint(2, 40))).encode()
        whole = enc[0].encode_ordinary(data.decode())
        for place in tc.independent_places(np.frombuffer(data, np.uint8)).tolist():
            assert enc[0].encode_ordinary(data[:place].decode()) + enc[0].encode_ordinary(data[place:].decode()) == whole
            found += 1
    assert found > 10_000


def test_joins_are_repaired_exactly(enc):
    rng = random.Random(1)
    for _ in range(1500):
        s = "".join(rng.choice(PARTS) for _ in range(rng.randint(2, 120)))
        cuts = sorted({rng.randint(1, len(s) - 1) for _ in range(rng.randint(1, 6))})
        parts = [s[a:b] for a, b in zip([0, *cuts], [*cuts, len(s)], strict=True)]
        ids = np.array([i for p in parts for i in enc[0].encode_ordinary(p)], np.uint16)
        joins = np.cumsum([len(p.encode()) for p in parts[:-1]])
        assert tc.repair_joins(ids, joins, *enc).tolist() == enc[0].encode_ordinary(s)


def test_windows_widen_until_agreement(enc, monkeypatch):
    """Even if the places were wrong, the outer ids must agree before a join counts as repaired."""
    monkeypatch.setattr(tc, "independent_places", lambda data: np.arange(1, len(data)))
    rng = random.Random(8)
    for _ in range(300):
        s = "".join(rng.choice("abc ehllo.\n") for _ in range(rng.randint(8, 200)))
        c = len(s) // 2
        ids = np.array([i for p in (s[:c], s[c:]) for i in enc[0].encode_ordinary(p)], np.uint16)
        if len(ids) > 4:
            got = tc.repair_joins(ids, np.array([c]), *enc)
            assert b"".join(enc[1][i] for i in got) == s.encode()


@pytest.mark.parametrize("kind", ["cjk", "cjk without marks", "minified", "letters"])
def test_texts_without_blanks_take_time_in_proportion(enc, kind):
    rng = random.Random(3)
    stock = ["".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(rng.randint(2, 30))) for _ in range(3000)]
    names = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    make = {
        "cjk": lambda n: "".join(rng.choice(stock) + rng.choice("。，、！") for _ in range(n // 50)),
        "cjk without marks": lambda n: "".join(rng.choice(stock) for _ in range(n // 48)),
        "minified": lambda n: "".join(f"{rng.choice(names)}({rng.choice(names)},{rng.choice(names)});" for _ in range(n // 16)),
        "letters": lambda n: "".join(rng.choice(names) for _ in range(n // 4)),
    }[kind]
    times = []
    for size in (1 << 20, 1 << 22):
        text = make(size)
        begin = time.process_time()
        parts, joins, at = [], [], 0
        data = np.frombuffer(text.encode(), np.uint8)
        cuts, free = tc.cut_places(data, np.array([0]), np.array([len(data)]))
        for cut, open_join in zip([*cuts.tolist(), len(data)], [*(~free).tolist(), False], strict=True):
            parts.append(np.array(tc.encode_text(enc[0], data[at:cut].tobytes().decode()), np.uint16))
            joins += [cut] if open_join else []
            at = cut
        got = tc.repair_joins(np.concatenate(parts), np.array(joins), *enc) if joins else np.concatenate(parts)
        times.append(time.process_time() - begin)
        assert len(cuts) > len(data) / 5_000
        assert got.tolist() == enc[0].encode_ordinary(text)
    assert times[1] < 8 * times[0] + 0.5, times


def test_cuts_follow_content():
    rng = random.Random(3)
    body = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(4000))
    cut = lambda t: {c - (len(t) - len(body)) for c in tc.cut_places(np.frombuffer(t.encode(), np.uint8), np.array([0]), np.array([len(t)]))[0].tolist()}
    plain, moved = cut(body), cut("some other header\n" + body)
    assert len(plain) > 10 and len(plain & moved) >= 0.95 * len(plain)
