"""Evaluation texts that stand, wholly or partly, in a training corpus.

Latent semantic retrieval, then an exact check:

1. Texts become word codes of the items' vocabulary (a word is a run of letters or digits, case
   aside). A passage is a window of PASSAGE words. A window that holds a case consists almost wholly
   of item words, so windows with fewer than NEED of them are no candidates; this drops no case.
2. Weights are TF-IDF with document frequencies over the whole corpus. A randomised SVD of passages
   (sketch, power rounds, small eigenproblem) is computed over Spark partitions; it is fitted on all item passages and a
   sample of at most about FIT_PASSAGES corpus passages, and every passage is then projected by it.
3. Every corpus passage is compared by cosine with all item passages; item and document of a pair above
   COSINE are candidates.
4. A candidate counts if a passage of at least ``least`` item words is aligned with a run of document
   words with at most one edit (changed, left out or added word) in ``tolerance`` words. Alignments
   start from common runs of SEED words, of which such a passage must have one, and grow to both sides along
   furthest-reaching paths, the diagonals of the longest common subsequence. The item's last words, its answer or
   final check, are looked up as well.

The items are the stated query set: they are taken in blocks of ITEM_BLOCK items, each against all
documents, so what is sent to tasks does not grow with the corpus.

Defined results: NULL texts and texts without words give no rows; repeated rows count once; documents
of any length are read whole; ties are all kept; an empty side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.session import discard, materialise, spread

PASSAGE, DOC_STRIDE, ITEM_STRIDE, NEED = 24, 8, 6, 19
RANK, OVERSAMPLE, POWER_ROUNDS = 64, 16, 2
FIT_PASSAGES = 50_000
COSINE = 0.6
SEED = 7
ITEM_BLOCK = 2_000
ANSWER_WORDS = 6
WORD_BLOCK = 256
WINDOWS_AT_ONCE = 2_048
#: Windows of several documents that are held together, at most about; and tasks that sum over the bounded sample.
WINDOWS_HELD, SAMPLE_TASKS = 1 << 16, 16

_WORD = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def run_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` codes."""
    if len(codes) < n:
        return np.empty(0, np.uint64)
    h = np.zeros(len(codes) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ (codes[k : k + len(h)] + 2).astype(np.uint64)) * _MULTIPLIER
            h ^= h >> np.uint64(29)
    return h


def window_starts(n: int, stride: int) -> np.ndarray:
    """Window places that cover ``n`` words; the last window ends with the text."""
    if n <= PASSAGE:
        return np.zeros(min(n, 1), np.int64)
    return np.unique(np.append(np.arange(0, n - PASSAGE + 1, stride), n - PASSAGE))


def windows(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The windows as rows; a short text is filled up with -1."""
    if len(codes) < PASSAGE:
        codes = np.append(codes, np.full(PASSAGE - len(codes), -1, codes.dtype))
    return codes[starts[:, None] + np.arange(PASSAGE)]


def dense_starts(codes: np.ndarray, stride: int, need: int) -> np.ndarray:
    starts = window_starts(len(codes), stride)
    inside = np.concatenate([[0], np.cumsum(codes >= 0)])
    return starts[inside[np.minimum(starts + PASSAGE, len(codes))] - inside[starts] >= need]


@dataclass
class ItemSet:
    """One block of items as arrays: vocabulary, codes, passages and their common-run index."""

    ids: list[int]
    vocabulary: dict[str, int]
    codes: list[np.ndarray]
    passages: np.ndarray
    first_passage: np.ndarray
    run_hash: np.ndarray
    run_item: np.ndarray
    run_pos: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> ItemSet:
        vocabulary: dict[str, int] = {}
        codes = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)], np.int32) for _, text in rows]
        kept = [i for i, c in enumerate(codes) if len(c)]
        ids, codes = [rows[i][0] for i in kept], [codes[i] for i in kept]
        rolled = [windows(c, window_starts(len(c), ITEM_STRIDE)) for c in codes]
        hashes = [run_hashes(c, SEED) for c in codes]
        run_hash = np.concatenate([np.empty(0, np.uint64), *hashes])
        order = np.argsort(run_hash, kind="stable")
        return cls(
            ids,
            vocabulary,
            codes,
            np.concatenate([np.empty((0, PASSAGE), np.int32), *rolled]),
            np.cumsum([0, *map(len, rolled)])[:-1],
            run_hash[order],
            np.repeat(np.arange(len(codes)), [len(h) for h in hashes])[order],
            np.concatenate([np.empty(0, np.int64), *[np.arange(len(h)) for h in hashes]]).astype(np.int64)[order],
        )


def _encode(shared) -> object:
    """(doc_id, text) to (doc_id, distinct codes, codes where a window is dense, number of such windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of = shared.value.vocabulary.get
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                ids, seen, codes, dense = part.column(0).to_pylist(), [], [], []
                for text in part.column(1).to_pylist():
                    c = np.array([code_of(w, -1) for w in words_of(text)], np.int32)
                    n = len(dense_starts(c, DOC_STRIDE, NEED)) if len(c) >= PASSAGE else 0
                    there = np.unique(c)
                    seen.append(there[there >= 0].tobytes())
                    codes.append(c.tobytes() if n else None)
                    dense.append(n)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seen, pa.binary()), pa.array(codes, pa.binary()), pa.array(dense, pa.int32())], ["doc_id", "seen", "codes", "n_dense"])

    return run


def _count_codes(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_words + 1, np.int64)
        for batch in batches:
            total[-1] += batch.num_rows
            total[:-1] += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=n_words)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(n_words), -1), pa.int32()), pa.array(total)], ["code", "n"])

    return run


def inverse_document_frequency(encoded: DataFrame, n_words: int) -> np.ndarray:
    """Smoothed IDF over all documents; one number per word of the items' vocabulary."""
    counts = np.zeros(n_words + 1)
    for r in encoded.select("seen").mapInArrow(_count_codes(n_words), "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[r.code] = r.n
    return np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1


def project(passages: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Rows of the TF-IDF passage matrix times ``weights`` (one row per word, a last zero row for -1)."""
    out = np.empty((len(passages), weights.shape[1]), np.float32)
    for at in range(0, len(passages), WINDOWS_AT_ONCE):
        out[at : at + WINDOWS_AT_ONCE] = weights[passages[at : at + WINDOWS_AT_ONCE]].sum(axis=1)
    return out


def _back(passages: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A^T (A W) of the passages, without the words' own weight on the left."""
    image, total = project(passages, weights), np.zeros(weights.shape, np.float32)
    np.add.at(total, passages.ravel(), np.repeat(image, PASSAGE, axis=0))
    return total


def _weighted(idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    return np.vstack([basis * idf[:, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)


def _sketch(shared_weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, total = shared_weights.value, None
        for batch in batches:
            passages = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32).reshape(-1, PASSAGE)
            total = _back(passages, weights) if total is None else total + _back(passages, weights)
        if total is not None:
            at = range(0, len(total), WORD_BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(list(at), pa.int32()), pa.array([total[i : i + WORD_BLOCK].tobytes() for i in at], pa.binary())], ["at", "part"])

    return run


def _add_parts(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in table.column("part").to_pylist())
    return pa.table({"at": table.column("at").slice(0, 1), "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _sample(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = np.frombuffer(raw, np.int32)
                starts = dense_starts(codes, DOC_STRIDE, NEED)
                pick = np.random.default_rng(abs(doc or 0)).random(len(starts)) < share
                out += [w.tobytes() for w in windows(codes, starts[pick])]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["passage"])

    return run


def fit_projection(encoded: DataFrame, items: ItemSet, idf: np.ndarray) -> np.ndarray:
    """Word weights whose row sums place a passage in the leading singular directions."""
    spark = encoded.sparkSession
    n_words = len(idf)
    width = min(RANK + OVERSAMPLE, n_words)
    total = encoded.agg(F.sum("n_dense").alias("n")).first()["n"] or 0
    share = min(1.0, FIT_PASSAGES / max(total, 1))
    held = materialise(encoded.where(F.col("codes").isNotNull()).select("doc_id", "codes").mapInArrow(_sample(share), "passage binary"))
    sample = held.coalesce(SAMPLE_TASKS)  # so no group of partial sums holds more than SAMPLE_TASKS of them

    def gram(basis: np.ndarray) -> np.ndarray:
        weights = _weighted(idf, basis)
        shared = spark.sparkContext.broadcast(weights)
        parts = sample.mapInArrow(_sketch(shared), "at int, part binary").groupBy("at").applyInArrow(_add_parts, "at int, part binary").collect()
        out = _back(items.passages, weights).astype(np.float64)
        for r in parts:
            block = np.frombuffer(r.part, np.float32).reshape(-1, width)
            out[r["at"] : r["at"] + len(block)] += block
        shared.destroy()
        return out[:-1] * idf[:, None]

    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((n_words, width)))[0]
    for _ in range(POWER_ROUNDS):
        basis = np.linalg.qr(gram(basis))[0]
    small = basis.T @ gram(basis)
    discard(held)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return _weighted(idf, basis @ vectors[:, ::-1][:, : min(RANK, width)])


def _unit_rows(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def _furthest(a: np.ndarray, b: np.ndarray, most: int) -> list[int]:
    """By number of edits, how many words of ``a`` can be used from its start on against ``b``."""
    n, m = len(a), len(b)

    def slide(i: int, k: int) -> int:
        while i < n and i + k < m and a[i] == b[i + k]:
            i += 1
        return i

    reach = {0: slide(0, 0)}
    best = [reach[0]]
    for _ in range(most):
        grown = {}
        for k in range(min(reach) - 1, max(reach) + 2):
            i = max(reach.get(k, -2) + 1, reach.get(k + 1, -2) + 1, reach.get(k - 1, -1))
            i = min(i, n)
            if i >= 0 and 0 <= i + k <= m:
                grown[k] = slide(i, k)
        reach = grown or reach
        best.append(max(best[-1], max(reach.values())))
    return best


def best_passage(item: np.ndarray, doc: np.ndarray, p: int, j: int, least: int, tolerance: int) -> tuple[int, int]:
    """The longest passage through the common run at item word ``p`` and document word ``j``: its
    item words and edits; words is 0 if none keeps within the tolerance."""
    most = max(least, len(item)) // tolerance
    reach = len(item) + most + 1
    right = _furthest(item[p:].tolist(), doc[j : j + reach].tolist(), most)
    left = _furthest(item[:p][::-1].tolist(), doc[max(0, j - reach) : j][::-1].tolist(), most)
    found = (0, 0)
    for x, r in enumerate(right):
        for y, l in enumerate(left[: most + 1 - x]):
            if r + l >= max(least, tolerance * (x + y)) and (r + l, -(x + y)) > (found[0], -found[1]):
                found = (r + l, x + y)
    return found


def check_document(items: ItemSet, doc: np.ndarray, wanted: set[int], least: int, tolerance: int) -> Iterator[tuple[int, int, int, bool]]:
    """(item, words, edits, has answer) for the wanted items that truly stand in the document.

    Every common run is measured, as a longer passage may come later, until the item stands there whole and unedited."""
    hashes = run_hashes(doc, SEED)
    lo = np.searchsorted(items.run_hash, hashes, side="left")
    hi = np.searchsorted(items.run_hash, hashes, side="right")
    places = np.flatnonzero(hi > lo)
    found: dict[int, tuple[int, int]] = {}
    last: dict[tuple[int, int], int] = {}
    for j in places.tolist():
        for at in range(lo[j], hi[j]):
            item, p = int(items.run_item[at]), int(items.run_pos[at])
            diagonal = (item, p - j)
            follows = last.get(diagonal) == j - 1
            last[diagonal] = j
            if item in wanted and not follows and found.get(item) != (len(items.codes[item]), 0):
                words, edits = best_passage(items.codes[item], doc, p, j, least, tolerance)
                best = found.get(item, (0, 0))
                if (words, -edits) > (best[0], -best[1]):
                    found[item] = (words, edits)
    for item, (words, edits) in found.items():
        tail = items.codes[item][-ANSWER_WORDS:]
        answer = bool(np.isin(run_hashes(tail, len(tail)), run_hashes(doc, len(tail))).any())
        yield item, words, edits, answer


def _search(shared, shared_weights, least: int, tolerance: int):
    names = ["item_id", "doc_id", "cosine", "passage_words", "edits", "has_answer"]
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value, shared_weights.value
        latent = _unit_rows(project(items.passages, weights)).T.copy()
        def search(queue: list[tuple[int, np.ndarray, np.ndarray]], best: dict[tuple[int, int], float]) -> None:
            owner = np.repeat([n for n, _, _ in queue], [len(s) for _, _, s in queue])
            passages = np.concatenate([np.empty((0, PASSAGE), np.int32), *[windows(c, s) for _, c, s in queue]])
            for at in range(0, len(passages), WINDOWS_AT_ONCE):
                cosine = _unit_rows(project(passages[at : at + WINDOWS_AT_ONCE], weights)) @ latent
                per_item = np.maximum.reduceat(cosine, items.first_passage, axis=1)
                row, item = np.nonzero(per_item >= COSINE)
                for n, i, c in zip(owner[at + row].tolist(), item.tolist(), per_item[row, item].tolist(), strict=True):
                    if c > best.get((n, i), 0.0):
                        best[n, i] = c

        for batch in batches:
            docs = [np.frombuffer(raw, np.int32) for raw in batch.column(1).to_pylist()]
            ids = batch.column(0).to_pylist()
            best: dict[tuple[int, int], float] = {}
            queue, held = [], 0
            for n, codes in enumerate(docs):
                starts = dense_starts(codes, DOC_STRIDE, NEED)
                for at in range(0, len(starts), WINDOWS_HELD):
                    queue.append((n, codes, starts[at : at + WINDOWS_HELD]))
                    held += len(queue[-1][2])
                    if held >= WINDOWS_HELD:
                        search(queue, best)
                        queue, held = [], 0
            search(queue, best)
            wanted: dict[int, set[int]] = {}
            for n, i in best:
                wanted.setdefault(n, set()).add(i)
            rows = [(items.ids[i], ids[n], best[n, i], words, edits, answer) for n, some in wanted.items() for i, words, edits, answer in check_document(items, docs[n], some, least, tolerance)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return run


def leaked_passages(docs: DataFrame, items: DataFrame, least: int = 30, tolerance: int = 10) -> DataFrame:
    """(item_id, doc_id, cosine, passage_words, edits, has_answer) of every item that stands in a document.

    ``docs``: (doc_id, text). ``items``: (item_id, item_text)."""
    spark = docs.sparkSession
    schema = "item_id bigint, doc_id bigint, cosine double, passage_words int, edits int, has_answer boolean"
    items = items.where(F.col("item_text").isNotNull()).select(F.col("item_id").cast("bigint"), "item_text").distinct()
    docs = spread(docs.where(F.length("text") > 0).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "doc_id")
    blocks = -(-items.count() // ITEM_BLOCK)
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        held = ItemSet.of(sorted((r.item_id, r.item_text) for r in rows))
        if not len(held.passages):
            continue
        shared = spark.sparkContext.broadcast(held)
        encoded = materialise(docs.mapInArrow(_encode(shared), "doc_id bigint, seen binary, codes binary, n_dense int"))
        idf = inverse_document_frequency(encoded, len(held.vocabulary))
        weights = spark.sparkContext.broadcast(fit_projection(encoded, held, idf))
        dense = encoded.where(F.col("codes").isNotNull()).select("doc_id", "codes")
        found = found.unionByName(materialise(dense.mapInArrow(_search(shared, weights, least, tolerance), schema)))
        discard(encoded)
    best = F.max(F.struct("passage_words", F.negative("edits").alias("less"), "cosine", "has_answer")).alias("b")
    return found.groupBy("item_id", "doc_id").agg(best).select("item_id", "doc_id", "b.cosine", "b.passage_words", F.negative("b.less").alias("edits"), "b.has_answer")
