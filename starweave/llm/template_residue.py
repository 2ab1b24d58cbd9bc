"""Unfilled slots, filler, error pages and demands for scripts in place of content.

1. Character n-gram models (orders ORDERS, hashed, lower-case bytes with digits folded): one per kind of
   residue and one of handling (code, translations, tests, templates and manuals about such things),
   fitted on public wording (``residue_seeds``); one of natural text, counted over the lines of the corpus,
   lines that differ in numbers and hashes only once. Every byte gets the log-likelihood ratio of each kind
   against natural text, the orders weighted.
2. The lines of the corpus are judged by these models. Lines with a strong window of residue join the samples of
   their kind and leave natural text; the models are fitted anew, so they know the wording of this corpus as well.
3. In each line of a document the windows with the greatest sums are likely residue, unless the
   words in or beside them speak for handling (HANDLED_SUM), or a notice is a literal in code. A window counts from STRONG on wherever it stands, from
   WEAK on where such windows cover the share MOSTLY of the text. A demand for scripts counts only if it covers DEMAND_SHARE of
   what the page shows, as a page with content may add one. A strong window excludes
   its document if such windows cover MIN_COVERAGE of the visible bytes of its section, the SECTION bytes
   before and behind it, so the length of the rest of the text does not count.

Counts are sums over distinct lines, so they do not depend on how the rows are split.

Defined results: NULL, empty and blank texts are no cases; whole texts are read, block by block, and windows
run across block bounds; repeated rows count once; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.llm.residue_seeds import ORDINARY_LINES, handled_samples, seeds
from starweave.session import discard, materialise, spread

#: Orders of the n-grams, and the weight of each; the last is the greatest.
ORDERS, WEIGHTS = (3, 5), (0.35, 0.65)
GRAM = ORDERS[-1]
TABLE_BITS = 18
SIZE = 1 << TABLE_BITS
KINDS = ("slot", "placeholder", "filler", "dummy text", "error notice", "script demand")
DEMAND = KINDS.index("script demand")
NOTICE_KINDS = (KINDS.index("error notice"), DEMAND)
#: Counts of the corpus are kept for the kinds, then natural text.
NATURAL = len(KINDS)
HANDLED_SUM, HANDLED_SHARE, HANDLED_LEAST, CONTEXT = 11.0, 0.18, 1.5, 48
FLOOR = {3: 2e-5, 5: 2e-6}
LLR_LOW, LLR_HIGH = -4.0, 6.0
STRONG, WEAK, MOSTLY, MIN_COVERAGE = 50.0, 25.0, 0.25, 0.005
#: A demand for scripts has to cover so much of what a page shows.
DEMAND_SHARE = 0.5
#: In a short text a weak window needs only so much per visible byte, LEAST at all, and to cover SHORT_SHARE of it.
PER_BYTE, LEAST, SHORT_SHARE = 1.0, 9.0, 0.5
PIECE, TEXTS_AT_ONCE = 240, 500
#: Unseen natural n-grams assumed besides the corpus, so that a small corpus does not vouch for its own residue.
PRIOR_GRAMS = 200_000
#: So many n-grams of ordinary lines are added to the corpus, for small ones.
GROUND_GRAMS = 50_000
#: Lines of the corpus count in a kind's model at most as much as so many times its samples.
LEARNT_SHARE = 1.0
BLOCK_BYTES, OVERLAP = 1 << 20, 1 << 14
SECTION = 1 << 10
#: How far a line is looked at beside a window, and the share of a window's letters that makes it a literal.
LINE_REACH, QUOTED_SHARE = 1_000, 0.6

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[ord("0") : ord("9") + 1] = ord("0")
_FOLD[[ord("\r"), ord("\t")]] = ord(" ")
_MULTIPLIER = np.uint32(0x9E3779B1)
_VISIBLE = np.ones(256, bool)
_VISIBLE[:0x21] = False


def gram_codes(data: np.ndarray) -> np.ndarray:
    """One row per order: the table places of the n-grams that end at each byte from the GRAM-th on, table after table."""
    folded = _FOLD[data].astype(np.uint32)
    n = max(0, len(data) - GRAM + 1)
    out = np.zeros((len(ORDERS), n), np.int64)
    with np.errstate(over="ignore"):
        for row, order in enumerate(ORDERS):
            h = np.zeros(n, np.uint32)
            for k in range(GRAM - order, GRAM):
                h = (h ^ folded[k : k + n]) * _MULTIPLIER
                h ^= h >> np.uint32(15)
            out[row] = (h >> np.uint32(32 - TABLE_BITS)) + np.uint32(row * SIZE)
    return out


def count_grams(texts: list[str]) -> np.ndarray:
    """n-gram counts of texts, each between line breaks; all orders."""
    data = np.frombuffer("".join(f"\n{t}\n" for t in texts).encode(), np.uint8)
    total = np.zeros(SIZE * len(ORDERS), np.int64)
    for lo in range(0, len(data), BLOCK_BYTES):
        total += np.bincount(gram_codes(data[lo : lo + BLOCK_BYTES + GRAM - 1]).ravel(), minlength=len(total))
    return total


_NUMBERS = r"\b[0-9a-fA-F-]*[0-9][0-9a-fA-F-]*\b|[0-9]+"


def _lines_of(texts: pa.Array) -> list[str]:
    """The distinct lines of some texts; long ones in pieces."""
    lines = pc.unique(pc.split_pattern(texts, "\n").flatten()).to_pylist()
    return [line[i : i + PIECE] for line in lines for i in range(0, len(line), PIECE)]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, piece) of the lines of texts, long ones in pieces, each key once in a few texts. The key is the lower-case
    line with numbers and hexadecimal runs folded."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            pieces = pa.array(_lines_of(pc.drop_null(batch.column(0).slice(at, TEXTS_AT_ONCE))), pa.string())
            keys = pc.utf8_lower(pc.replace_substring_regex(pieces, _NUMBERS, "0")).to_pylist()
            least: dict[str, str] = {}
            for key, piece in zip(keys, pieces.to_pylist(), strict=True):
                if key not in least or piece < least[key]:
                    least[key] = piece
            yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.string()), pa.array(list(least.values()), pa.string())], ["key", "piece"])


def distinct_lines(texts: DataFrame) -> DataFrame:
    """(piece): one spelling, the least, of each line of the whole corpus."""
    pieces = texts.mapInArrow(_pieces, "key string, piece string")
    return pieces.groupBy(F.xxhash64("key").alias("key")).agg(F.min("piece").alias("piece")).select("piece")


def _count(judged_by=None):
    """(model, place, n) of the n-grams of lines, summed by task. Without ``judged_by`` all lines are natural text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((NATURAL + 1, SIZE * len(ORDERS)), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                lines = batch.column(0).slice(at, 10_000).to_pylist()
                models = np.full(len(lines), NATURAL) if judged_by is None else line_models(judged_by.value, lines)
                for m in np.unique(models):
                    total[m] += count_grams([lines[k] for k in np.flatnonzero(models == m)])
        model, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(model, pa.int32()), pa.array(place, pa.int32()), pa.array(total[model, place])], ["model", "place", "n"])

    return run


def _counts(lines: DataFrame, judged_by=None) -> np.ndarray:
    """n-gram counts by model over ``lines``; as many numbers as the tables have places, whatever the corpus."""
    found = lines.mapInArrow(_count(judged_by), "model int, place int, n bigint").groupBy("model", "place").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((NATURAL + 1, SIZE * len(ORDERS)))
    total[found.column("model").to_numpy(), found.column("place").to_numpy()] = found.column("n").to_numpy()
    return total


def sample_counts(keep: Callable[[str], bool] = lambda template: True) -> np.ndarray:
    """Counts by model of the public wording that ``keep`` lets through: the kinds, natural text, then each group of handling."""
    samples = seeds(keep)
    groups = [*(samples[k] for k in KINDS), list(ORDINARY_LINES), *handled_samples(keep).values()]
    return np.stack([count_grams(g) for g in groups]).astype(float)


def _shares(counts: np.ndarray, prior: float = 0.0) -> np.ndarray:
    """Shares of n-grams within each order."""
    by_order = counts.reshape(len(ORDERS), SIZE)
    return (by_order / np.maximum(by_order.sum(axis=1, keepdims=True) + prior, 1.0)).ravel()


def ratios_of(corpus: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """Weighted log-likelihood ratios: one row per kind against natural text, and a last row of handling against both.
    ``corpus`` and ``samples``: counts by model."""
    floor = np.repeat([FLOOR[o] for o in ORDERS], SIZE)
    weight = np.repeat(WEIGHTS, SIZE)
    ground = samples[NATURAL] * (GROUND_GRAMS / samples[NATURAL].sum())
    natural = _shares(corpus[NATURAL] + ground, PRIOR_GRAMS)
    kinds = []
    for k in range(len(KINDS)):
        learnt = corpus[k].sum()
        scale = min(1.0, LEARNT_SHARE * samples[k].sum() / learnt) if learnt else 0.0
        kinds.append(_shares(samples[k] + scale * corpus[k]))
    handled = np.max([_shares(g) for g in samples[NATURAL + 1 :]], axis=0)
    rows = [np.log((k + floor) / (natural + floor)) for k in kinds]
    rows.append(np.log((handled + floor) / (np.maximum(natural, np.max(kinds, axis=0)) + floor)))
    return (np.clip(np.stack(rows), LLR_LOW, LLR_HIGH) * weight).astype(np.float32)


def fit_ratios(texts: DataFrame) -> np.ndarray:
    """``ratios_of`` over all distinct lines of ``texts``: first by the samples alone, then with the lines these find."""
    lines = materialise(distinct_lines(texts))
    samples = sample_counts()
    first = lines.sparkSession.sparkContext.broadcast(ratios_of(_counts(lines), samples))
    fitted = ratios_of(_counts(lines, first), samples)
    discard(lines)
    return fitted


def _line_starts(data: np.ndarray, n: int) -> np.ndarray:
    breaks = np.flatnonzero(data[GRAM - 1 : len(data)] == 10)
    return np.concatenate([[0], breaks[breaks < n - 1] + 1])


def best_sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per line and row the greatest sum of a window. ``rows``: ratios per byte; ``first``: where the lines begin."""
    line = np.zeros(rows.shape[1], np.int64)
    line[first[1:]] = 1
    # the least prefix sum within the line: later lines are moved below all earlier ones
    drop = np.cumsum(line) * (2.0 * max(abs(LLR_LOW), LLR_HIGH) * (rows.shape[1] + 1))
    out = []
    for llr in rows:
        total = np.cumsum(llr, dtype=np.float64)
        gain = total - (np.minimum.accumulate(total - llr - drop) + drop)
        out.append(np.maximum.reduceat(gain, first))
    return np.stack(out)


def _ratios_at(ratios: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return sum(ratios[:, row] for row in codes)


def line_bounds(bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, best): where the lines begin, and no less than any kind's greatest sum there. ``bounds``: the greatest ratio of all kinds per place."""
    codes = gram_codes(data)
    first = _line_starts(data, codes.shape[1])
    return first, best_sums(sum(bounds[row] for row in codes)[None, :], first)[0]


def needed(text: bytes) -> float:
    """The least sum of a window that matters in a text."""
    return WEAK if len(text) > 4 * WEAK else min(WEAK, max(LEAST, PER_BYTE * len(b"".join(text.split()))))


def _peaks(llr: np.ndarray, at: int, need: float) -> list[tuple[float, int, int]]:
    """(sum, begin, end) of the disjoint windows of ``need`` or more of one kind; ``at`` is the place of the first value."""
    out, todo = [], [(0, len(llr))]
    while todo:
        lo, hi = todo.pop()
        total = np.cumsum(llr[lo:hi], dtype=np.float64)
        before = total - llr[lo:hi]
        least = np.minimum.accumulate(before)
        gain = total - least
        first = np.flatnonzero(before <= least)
        top = np.maximum.reduceat(gain, first)
        for i in np.flatnonzero(top >= need):
            b, stop = int(first[i]), int(first[i + 1]) if i + 1 < len(first) else hi - lo
            e = b + int(np.argmax(gain[b:stop])) + 1
            out.append((float(top[i]), at + lo + b, at + lo + e))
            if e < stop:
                todo.append((lo + e, lo + stop))
    return out


def all_windows(ratios: np.ndarray, bounds: np.ndarray, data: np.ndarray, taken: np.ndarray, limit: int, need: float = WEAK) -> Iterator[tuple[float, int, int, int]]:
    """(sum, kind, begin, end) of all disjoint windows of ``need`` or more that begin before ``limit``, the
    greatest of a line first. Bytes in ``taken`` are left out, and those of the windows are added to it."""
    codes = gram_codes(data)
    first, best = line_bounds(bounds, data)
    stops = np.append(first, codes.shape[1])
    used = taken[: codes.shape[1]]
    for i in np.flatnonzero(best >= need):
        lo, hi = int(stops[i]), int(stops[i + 1])
        rows = _ratios_at(ratios, codes[:, lo:hi])
        queue = [(-total, k, b, e) for k, llr in enumerate(rows) for total, b, e in _peaks(llr, lo, need)]
        heapq.heapify(queue)
        while queue:
            total, k, b, e = heapq.heappop(queue)
            if b >= limit:
                continue
            if used[b:e].any():
                free = np.flatnonzero(np.diff(np.concatenate([[True], used[b:e], [True]]).astype(np.int8)))
                for x, y in zip(free[::2].tolist(), free[1::2].tolist(), strict=True):
                    for rest, c, d in _peaks(rows[k][b + x - lo : b + y - lo], b + x, need):
                        heapq.heappush(queue, (-rest, k, c, d))
                continue
            used[b:e] = True
            # the first n-grams of a line begin in the line before
            ahead = np.flatnonzero(data[b : b + GRAM] == 10)
            yield -total, k, b + int(ahead[-1]) + 1 if len(ahead) else b, e - 1 + GRAM


_LITERAL = re.compile(rb"""(?:(?<=[\s(\[{=:,>+])|^)(?:"[^"\n]*"|'[^'\n]*'|`[^`\n]*`)(?=[\s)\]},;:.<+]|$)""")


def _line_at(data: np.ndarray, begin: int, end: int, reach: int) -> tuple[bytes, int]:
    """(text, offset): the line of a window as far as ``reach`` bytes beside it."""
    left = max(begin - reach, 0)
    around = bytes(data[left : end + reach])
    ahead = around.rfind(b"\n", 0, begin - left + 1) + 1
    behind = around.find(b"\n", max(end - left - 1, ahead))
    return around[ahead : behind if behind >= 0 else None], left + ahead


def _is_quoted(data: np.ndarray, begin: int, end: int) -> bool:
    """Whether a window is a literal in a line of code or settings, and the line not an object of its own."""
    line, at = _line_at(data, begin, end, LINE_REACH)
    if line.strip()[:1] == b"{" and line.strip()[-1:] == b"}":
        return False
    letters = np.frombuffer(line, np.uint8) > 0x40
    literal = np.zeros(len(line), bool)
    for m in _LITERAL.finditer(line):
        literal[m.start() : m.end()] = True
    window = slice(max(begin - at, 0), max(end - at, 0))
    bare = line.strip(b" \t\r")
    return bool((letters & literal)[window].sum() >= QUOTED_SHARE * letters[window].sum() and not (_LITERAL.match(bare) and _LITERAL.match(bare).end() == len(bare)))


def _is_handled(ratios: np.ndarray, data: np.ndarray, begin: int, end: int, total: float) -> bool:
    """Whether the words of the line in and beside a window of that sum speak for handling."""
    line, _ = _line_at(data, begin, end, CONTEXT)
    handled = _ratios_at(ratios[-1:], gram_codes(np.frombuffer(b"\n" + line + b"\n", np.uint8)))[0]
    return bool(handled[handled >= HANDLED_LEAST].sum() >= max(HANDLED_SUM, HANDLED_SHARE * total))


def line_models(ratios: np.ndarray, lines: list[str]) -> np.ndarray:
    """The model each line is a sample of: the kind of its strongest window from STRONG on, unless that is handled; else natural text."""
    out = np.full(len(lines), NATURAL)
    encoded = [b"\n" + line.encode() + b"\n" for line in lines]
    bounds = ratios[:-1].max(axis=0)
    for n in _suspects(ratios, bounds, [e[1:-1] for e in encoded], [STRONG] * len(lines)):
        data = np.frombuffer(encoded[n], np.uint8)
        top = 0.0
        for total, k, begin, end in all_windows(ratios[:-1], bounds, data, np.zeros(len(data), bool), len(data), STRONG):
            if total >= STRONG and total > top:
                aside = _is_handled(ratios, data, begin, end, total) or (k in NOTICE_KINDS and _is_quoted(data, begin, end))
                top, out[n] = total, NATURAL if aside else k
    return out


_UNSHOWN = re.compile(rb"<(script|style|title)\b[^<>]*>[^<]*</\1>|<[a-zA-Z/!?][^<>]*>", re.IGNORECASE)


def _shown(data: np.ndarray) -> np.ndarray:
    """Visible bytes outside mark-up, scripts and titles."""
    shown = _VISIBLE[data]
    for m in _UNSHOWN.finditer(data.tobytes()):
        shown[m.start() : m.end()] = False
    return shown


def judge(ratios: np.ndarray, text: bytes, bounds: np.ndarray | None = None) -> tuple[float, float, int, bool] | None:
    """(strongest sum, coverage, its kind, is residue) of one text; None for a blank one. ``bounds``: the greatest ratio of all kinds per place."""
    data = np.frombuffer(b"\n" + text + b"\n", np.uint8)
    visible = _VISIBLE[data]
    n_visible = int(visible.sum())
    if not n_visible or len(data) < GRAM:
        return None
    strongest, kind, sections = 0.0, 0, []
    taken, weak, strong, demand, quoted = (np.zeros(len(data), bool) for _ in range(5))
    bounds, need = ratios[:-1].max(axis=0) if bounds is None else bounds, needed(text)
    for lo in range(0, len(data), BLOCK_BYTES):
        part = data[lo : lo + BLOCK_BYTES + OVERLAP]
        if len(part) < GRAM:
            break
        limit = BLOCK_BYTES if lo + len(part) < len(data) else len(part)
        for total, k, begin, end in all_windows(ratios[:-1], bounds, part, taken[lo : lo + len(part)], limit, need):
            begin, end = lo + begin, lo + end
            if _is_handled(ratios, data, begin, end, total):
                continue
            if k in NOTICE_KINDS and _is_quoted(data, begin, end):
                quoted[begin:end] = True
                continue
            if k == DEMAND:
                demand[begin:end] = True
            else:
                weak[begin:end] = True
                if total >= STRONG:
                    strong[begin:end] = True
                    sections.append(slice(max(begin - SECTION, 0), end + SECTION))
            if total > strongest:
                strongest, kind = total, k
    residue = any(visible[at][strong[at]].sum() >= MIN_COVERAGE * visible[at].sum() for at in sections)
    covers = [int(visible[w].sum()) / n_visible for w in (strong, weak | demand)]
    if demand.any() and not residue:
        shown = _shown(data)
        covers.append(int(shown[weak | demand].sum()) / max(int(shown.sum()), 1))
        residue = covers[-1] >= DEMAND_SHARE
    mostly = MOSTLY if strongest >= WEAK else SHORT_SHARE
    return strongest, max(covers), kind, bool(residue or (not demand.any() and covers[1] >= mostly))


def _detect(shared):
    names = ["doc_id", "kind", "strength", "coverage"]
    kinds = (pa.int64(), pa.string(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.value
        bounds = ratios[:-1].max(axis=0)
        for batch in batches:
            rows = []
            ids = batch.column(0).to_pylist()
            for at in range(0, len(ids), TEXTS_AT_ONCE):
                texts = [(t or "").encode() for t in batch.column(1).slice(at, TEXTS_AT_ONCE).to_pylist()]
                for n in _suspects(ratios, bounds, texts, [needed(t) for t in texts]):
                    found = judge(ratios, texts[n], bounds)
                    if found and found[3]:
                        rows.append((ids[at + n], KINDS[found[2]], found[0], found[1]))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return run


def _suspects(ratios: np.ndarray, bounds: np.ndarray, texts: list[bytes], least: list[float]) -> list[int]:
    """Texts that hold a window of ``least``, and those longer than a block. The best ratio of all kinds at every byte rules most lines out."""
    out = []
    sizes, need = np.array([len(t) + 2 for t in texts]), np.array(least)
    at = 0
    while at < len(texts):
        stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BLOCK_BYTES)))
        if stop - at == 1 and sizes[at] > BLOCK_BYTES:
            out.append(at)
        else:
            data = np.frombuffer(b"".join(b"\n" + t + b"\n" for t in texts[at:stop]), np.uint8)
            if len(data) >= GRAM:
                codes = gram_codes(data)
                first = _line_starts(data, codes.shape[1])
                text = np.minimum(np.searchsorted(np.cumsum(sizes[at:stop]), first + GRAM - 1, side="right"), stop - at - 1)
                likely = np.flatnonzero(best_sums(sum(bounds[row] for row in codes)[None, :], first)[0] >= need[at + text])
                if len(likely):
                    begin, end = first[likely], np.append(first[1:], codes.shape[1])[likely]
                    starts = np.concatenate([[0], np.cumsum(end - begin)[:-1]])
                    taken = np.arange(int((end - begin).sum())) + np.repeat(begin - starts, end - begin)
                    best = best_sums(_ratios_at(ratios[:-1], codes[:, taken]), starts).max(axis=0)
                    out += (at + np.unique(text[likely[best >= need[at + text[likely]]]])).tolist()
        at = stop
    return out


def template_residue(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, kind, strength, coverage) of the documents to leave out."""
    texts = spread(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull()), "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(fit_ratios(texts.select("text")))
    return texts.mapInArrow(_detect(shared), "doc_id bigint, kind string, strength double, coverage double").distinct()
