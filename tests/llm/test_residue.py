import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from starweave.llm import residue_seeds
from starweave.llm import template_residue as tr
from tests.conftest import DATA

CODE = ["def load_table(path):\n    return open(path).read()\n", "for (int i = 0; i < n; i++) {\n    total += values[i];\n}\n", "SELECT id, count(*) AS n FROM shelf GROUP BY id;\n", "The valley keeps the quiet river between two hills.\n", "<section>\n  <h2>Cold lake</h2>\n  <p>Fill the long mirror from the lake.</p>\n</section>\n"]
#: Wording that stands in no seed.
RESIDUE = [
    "Dear {customer_first_name},\n\nThank you for your order {order_number}.\n", '"""%%MODULE_PURPOSE%%"""\n__owner__ = "[[owner_fullname]]"\n\ndef f(x):\n    return x\n', "owner: Your Surname Here\nkey: paste-your-license-key-here\n", "<insert company name>\n", "TODO: put the package description in here\n",
    "<p>At vero eos et accusamus et iusto odio dignissimos ducimus qui blanditiis praesentium voluptatum deleniti atque corrupti quos dolores.</p>\n", "Nostrum autem quibusdam officiis debitis rerum necessitatibus saepe eveniet voluptates repudiandae.\n", "Please fill this section with your own text.\n",
    "<html>\n<head><title>421 Request Misdirected</title></head>\n<body>\n<h1>421 Request Misdirected</h1>\n</body></html>\n", "Rate limit exceeded for your address\n", "This account has been suspended.\n", "def half(x):\n    while x:\n<h1>Whoops, looks like something went wrong.</h1><p>The file transfer was cut off by the remote server.</p>\n",
    "wget: server returned error: HTTP/1.1 403 Forbidden\n", '{"detail": "Authentication credentials were not provided."}\n', "In order to use this page you have to activate scripts.\n", "JAVASCRIPT IS NOT AVAILABLE. SWITCH TO A SUPPORTED BROWSER TO CONTINUE.\n", '<noscript>Scripts have to be permitted to see the board.</noscript><div id="app"></div>\n',
]
FINE = [
    '{\n  "missing": "Page not found",\n  "scripts": "Please enable JavaScript",\n  "stored": "The entry was stored",\n  "login": "Sign in to go on"\n}\n', "var labels = map[int]string{\n\t404: \"Not Found\",\n\t429: \"Too Many Requests\",\n}\n", "INSERT INTO http_codes (code, label) VALUES\n  (403, 'Forbidden'),\n  (404, 'Not Found');\n",
    "class GoneError(Exception):\n    status = 410\n    message = \"Gone\"\n\ndef test_shelf_denied(client):\n    assert client.get(\"/shelf\").text == \"Access denied.\"\n", "if (!row) return res.status(404).send(\"404 Not Found\");\n", "{% for stack in dial_list %}\n  <li>{{ stack.title }} - {{ stack.panel | round }}</li>\n{% endfor %}\n", "prefix=@PREFIX@\nlibdir=@LIBDIR@\n",
    "STOCK = ['dolor', 'tempor', 'labore', 'orbit', 'magna', 'lorem', 'fugiat']\n", "# TODO: replace the panel loop once the root is stable\nx = 1\n", "<section><h2>Lake</h2><p>The lake lies between two hills, and the narrow path along its shore leads to the old mill.</p></section>\n<noscript>Some maps need JavaScript.</noscript>\n",
]


def fitted(texts, keep=lambda template: True):
    """What ``fit_ratios`` gives, by one process."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    least = {}
    for part in tr._pieces(iter([batch])):
        for key, piece in zip(*(c.to_pylist() for c in part.columns), strict=True):
            least[key] = min(piece, least.get(key, piece))
    lines, samples = list(least.values()), tr.sample_counts(keep)
    corpus = np.zeros((tr.NATURAL + 1, tr.SIZE * len(tr.ORDERS)))
    corpus[tr.NATURAL] = tr.count_grams(lines)
    models = tr.line_models(tr.ratios_of(corpus, samples), lines)
    for m in range(tr.NATURAL + 1):
        corpus[m] = tr.count_grams([lines[i] for i in np.flatnonzero(models == m)])
    return tr.ratios_of(corpus, samples)


def is_residue(ratios, text):
    verdict = tr.judge(ratios, text.encode())
    return bool(verdict and verdict[3])


@pytest.fixture(scope="module")
def texts():
    """Real texts without residue."""
    rows = [t for t in pq.read_table(os.path.join(DATA, "documents.parquet")).column("text").to_pylist() if t and t.strip()]
    ratios = fitted(rows)
    fine = [t for t in rows if not is_residue(ratios, t)]
    return fine * -(-400 // len(fine))


@pytest.fixture(scope="module")
def ratios(texts):
    return fitted(texts)


def run(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS kind", "1 AS part").repartition(parts)
    return {r.doc_id: r.kind for r in tr.template_residue(df, "doc_id", "text").collect()}


def test_residue_of_unseen_wording_and_look_alikes(spark, texts):
    rows = list(enumerate(texts)) + [(1000 + i, t) for i, t in enumerate(RESIDUE)] + [(2000 + i, t) for i, t in enumerate(FINE)]
    assert set(run(spark, rows + rows[-5:])) == {1000 + i for i in range(len(RESIDUE))}


def test_held_out_templates(texts):
    """Models without a fifth of the templates find texts made of that fifth, alone or after code."""
    fold = lambda template: zlib.crc32(template.encode()) % 5
    found, tried, wrong, fine = 0, 0, 0, 0
    for k in (0, 3):
        ratios = fitted(texts, lambda t: fold(t) != k)
        rng = random.Random(k)
        held = residue_seeds.seeds(lambda t: fold(t) == k)
        for kind in ("slot", "placeholder", "error notice", "script demand"):
            for line in rng.sample(held[kind], 60):
                for text in (line, *([] if kind == "script demand" else [rng.choice(texts)[:400] + "\n" + line + "\n"])):
                    found, tried = found + is_residue(ratios, text), tried + 1
        for line in residue_seeds.handled_samples(lambda t: fold(t) == k)["lines"]:
            wrong, fine = wrong + is_residue(ratios, rng.choice(texts)[:400] + "\n" + line + "\n" + rng.choice(texts)[:400]), fine + 1
    assert found / tried >= 0.9, (found, tried)
    assert wrong / fine <= 0.15, (wrong, fine)


def test_rows_do_not_depend_on_partitions(spark, texts):
    rng = random.Random(9)
    rows = [(i, t + (rng.choice(RESIDUE) if i % 9 == 0 else "")) for i, t in enumerate(texts)]
    first = run(spark, rows, 1)
    assert first and all(run(spark, rows, parts) == first for parts in (8, 64))


def test_missing_blank_and_long(spark, texts):
    long = "".join(texts) * 12 + "\n"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, "Request timed out"), (6, "=" * 3_000_000), (7, "<%= project_name %> " * 100_000)] + [(10 + i, t) for i, t in enumerate(texts)]
    assert set(run(spark, rows)) == {5, 7}
    assert run(spark, []) == {}


def test_windows_equal_plain_search():
    rng = np.random.default_rng(4)
    ratios = np.clip(rng.normal(-0.3, 2, (2, tr.SIZE * len(tr.ORDERS))), -4, 6).astype(np.float32) / 2
    texts = ["".join(random.Random(i).choice("abc de") for _ in range(60)) for i in range(30)]
    data = np.frombuffer("\n".join(texts).encode(), np.uint8)
    codes = tr.gram_codes(data)
    first = tr._line_starts(data, codes.shape[1])
    best = tr.best_sums(tr._ratios_at(ratios, codes), first)
    for k, row in enumerate(ratios):
        for i, (lo, hi) in enumerate(zip(first, [*first[1:], codes.shape[1]], strict=True)):
            llr = sum(row[c[lo:hi]].astype(float) for c in codes)
            want = max(llr[s:e].sum() for s in range(len(llr)) for e in range(s + 1, len(llr) + 1))
            assert abs(best[k, i] - want) < 1e-3
    assert (tr.line_bounds(ratios.max(axis=0), data)[1] >= best.max(axis=0) - 1e-3).all()


def test_every_window_of_a_line_is_judged(ratios):
    handled, slot = FINE[1].replace("\n", " ") * 3, "# {{cookiecutter.project_name}} <short description> "
    plain = CODE[3].replace("\n", " ") * 4
    assert not tr.judge(ratios, (handled + plain).encode())[3]
    assert tr.judge(ratios, (handled + plain + slot + plain).encode())[3]


def test_windows_over_a_block_border(ratios, monkeypatch):
    text = (CODE[3].replace("\n", " ") * 4 + "{{cookiecutter.project_name}} <short description> ").encode()
    whole = tr.judge(ratios, text)
    assert whole[3]
    for size in range(len(text) - 60, len(text) - 5, 7):
        monkeypatch.setattr(tr, "BLOCK_BYTES", size)
        assert tr.judge(ratios, text) == whole


def test_length_of_the_rest_does_not_count(ratios):
    slot = "\n\n# {{cookiecutter.project_name}}\n\n"
    for rest in (CODE[3] * 10, CODE[3] * 2_000, CODE[3].replace("\n", " ") * 2_000):
        assert tr.judge(ratios, (rest + slot + rest).encode())[3]
        assert not (tr.judge(ratios, (rest + rest).encode()) or [0] * 4)[3]


def test_varied_copies_of_a_page_are_no_natural_text(spark, texts):
    rng = random.Random(6)
    page = "Access denied. The download was stopped by the server. Request 7{:04x}.\n"
    hot = [page.format(rng.getrandbits(16)) for _ in range(3_000)]
    rows = [(i, t) for i, t in enumerate(texts * 15)] + [(10_000 + i, t) for i, t in enumerate(hot)]
    assert set(run(spark, rows)) == set(range(10_000, 13_000))
