"""The ids of every text by a public byte-level BPE, with chunks shared across documents encoded once.

1. Each text is cut where a rolling hash over its last 16 bytes meets a mask: equal passages are cut
   alike wherever they stand. A cut moves on to the next independent place, if one is near: a bound of
   two pre-tokens that the signs beside it alone decide, so both sides encode as they do in the whole
   text. Other cuts are marked as open.
2. The places of a chunk (by its 128-bit hash) out of TASKS_TOGETHER reading tasks meet in one task,
   which encodes it once; a reading task sends the chunk's text once, its other places as bare
   references. So no task gets more than those tasks hold, however common a chunk is.
3. The ids go back to their documents by one exchange. A window about each open join, from the second
   independent place before it to the second behind it, is encoded anew. Where the outer ids come out as
   both chunks have them, the join is repaired; else the window grows. Windows of neighbouring joins that
   meet are one, so every byte is encoded a bounded number of times, also in texts without blanks.

Defined results: NULL and empty texts give an empty list; white space is text; special-token
spellings are ordinary text; an exact copy of a row counts once; rows with one id and different
texts give one row each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.session import spread

#: A cut at one byte in 512 on average.
CUT_MASK = np.uint64((1 << 9) - 1)
WINDOW = 16
#: A hash hit this close behind another is none, so runs of one sign are not cut into crumbs.
LEAST_GAP = 32
SNAP = 64
BLOCK = 1 << 20
#: Texts are cut together up to about so many bytes.
BATCH_BYTES = 1 << 23
#: A chunk key is sent once per task, as long as the task has seen fewer keys than this.
KEYS_PER_TASK = 1_000_000
#: A chunk is encoded once for so many reading tasks.
TASKS_TOGETHER = 16

_ENCODERS: dict[tuple[int, str], tuple[tiktoken.Encoding, list[bytes], np.ndarray]] = {}


def encoder(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, list[bytes], np.ndarray]:
    """The encoding of a rank file's content, the bytes of each id and their number; built once per Python worker."""
    key = xxhash.xxh3_64_intdigest(ranks), pattern
    if key not in _ENCODERS:
        rank_of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        spelled = [b""] * (max(rank_of.values()) + 1)
        for piece, i in rank_of.items():
            spelled[i] = piece
        _ENCODERS[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=rank_of, special_tokens={}), spelled, np.array([len(p) for p in spelled])
    return _ENCODERS[key]


_rng = np.random.default_rng(20_240_229)
_GEAR = _rng.integers(0, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)

#: Kinds of signs in the vocabulary's pattern; UNSURE ones are new or have changed, so that libraries may differ on them.
UNSURE, LETTER, NUMBER, MARK, APOSTROPHE, SPACE, WHITE = range(7)
_TABLED = 0x30000


#: The white space of the vocabulary's pattern.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LONG_SPACE = re.compile(f"[{_SPACE}]{{1000,}}")


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    """``encode_ordinary`` that also takes very long runs of white space.

    The pattern makes one pre-token of such a run, without its last sign where a word follows; the
    library's matcher gives up on long ones, so they are merged directly."""
    ids: list[int] = []
    at = 0
    for run in _LONG_SPACE.finditer(text):
        ids += enc.encode_ordinary(text[at : run.start()])
        at = run.end() if run.end() == len(text) else run.end() - 1
        ids += enc._encode_single_piece(text[run.start() : at])
    return ids + enc.encode_ordinary(text[at:])


@cache
def _kinds() -> np.ndarray:
    kinds = np.full(_TABLED + 1, UNSURE, np.uint8)
    white = re.compile(f"[{_SPACE}]")
    for code in range(_TABLED):
        sign = chr(code)
        now, old = unicodedata.category(sign)[0], unicodedata.ucd_3_2_0.category(sign)[0]
        if white.match(sign):
            kinds[code] = SPACE if sign == " " else WHITE
        elif now == old and now != "C":
            kinds[code] = {"L": LETTER, "N": NUMBER}.get(now, MARK)
    kinds[ord("'")] = APOSTROPHE
    return kinds


def independent_places(data: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
    """Offsets inside UTF-8 ``data`` where a pre-token begins whatever stands further off, and the
    text before it splits as it does alone. Nothing is looked up across the bytes at ``bounds``."""
    if len(data) and data.max() >= 0x80:
        code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        kind = _kinds()[np.minimum(code, _TABLED)]
    else:
        at, kind = np.arange(len(data)), _kinds()[data]
    if bounds is not None:
        kind[np.searchsorted(at, bounds)] = UNSURE
    solid = (kind >= LETTER) & (kind <= APOSTROPHE)
    a, b = kind[:-1], kind[1:]
    place = (((a == LETTER) | (a == NUMBER)) & (b != a) & (b != UNSURE)) | ((a == MARK) & (b != MARK) & (b != APOSTROPHE) & (b != UNSURE))
    place |= (a == APOSTROPHE) & ((b == NUMBER) | (b >= SPACE))
    place[:-1] |= (a[:-1] >= SPACE) & (b[:-1] == SPACE) & solid[2:]
    place[1:] |= solid[:-2] & (a[1:] == WHITE) & solid[2:]
    return at[1:][place]


def _hash_hits(data: np.ndarray) -> np.ndarray:
    """Positions whose last WINDOW bytes hash to the mask, block by block."""
    hits = []
    for at in range(0, len(data), BLOCK):
        start = max(0, at - WINDOW + 1)
        h = _GEAR[data[start : at + BLOCK]]
        power, width = _BASE, 1
        while width < WINDOW:
            h[width:] += h[:-width] * power
            power, width = power * power, width * 2
        found = np.flatnonzero(((h >> np.uint64(40)) & CUT_MASK) == 0) + start
        hits.append(found[found >= at])
    all_hits = np.concatenate(hits) if hits else np.empty(0, np.int64)
    return all_hits[np.diff(all_hits, prepend=-LEAST_GAP) >= LEAST_GAP]


def cut_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts inside the texts from ``starts`` to ``ends``, one byte between two texts, and whether each is an independent place."""
    with np.errstate(over="ignore"):
        hits = _hash_hits(data) + 1
    text = np.maximum(np.searchsorted(starts, hits, side="right") - 1, 0)
    inside = (hits - starts[text] >= WINDOW) & (hits < ends[text])
    hits, text = hits[inside], text[inside]
    free = independent_places(data, ends[:-1])
    nxt = np.searchsorted(free, hits)
    place = free[np.minimum(nxt, max(len(free) - 1, 0))] if len(free) else np.full(len(hits), -1)
    snaps = (nxt < len(free)) & (place - hits <= SNAP) & (place < ends[text])
    cuts = np.where(snaps, place, hits)
    # an open cut may not split a character
    whole = snaps | ((data[np.minimum(cuts, len(data) - 1)] & 0xC0) != 0x80)
    cuts, snaps = cuts[whole], snaps[whole]
    cuts, first = np.unique(cuts, return_index=True)
    return cuts, snaps[first]


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive texts of about BATCH_BYTES together, or a single longer one."""
    total = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + BATCH_BYTES, side="right")))
        yield lo, hi
        lo = hi


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to one row per chunk; ``body`` only where the task sees the chunk first."""
    seen: set[bytes] = set()
    group = TaskContext.get().partitionId() // TASKS_TOGETHER
    names = ["doc_id", "text_key", "pos", "free", "key", "body"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())
    for batch in batches:
        held = np.array(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), np.int64)
        for first, last in _runs(held):
            part = batch.slice(first, last - first)
            texts = [(t or "").encode() for t in part.column(1).to_pylist()]
            sizes = np.array([len(t) for t in texts])
            starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
            joined = b"\0".join(texts)
            cuts, free = cut_places(np.frombuffer(joined, np.uint8), starts, starts + sizes) if len(joined) > 2 else (np.empty(0, np.int64), np.empty(0, bool))
            bounds = np.searchsorted(cuts, np.stack([starts, starts + sizes]))
            rows: tuple[list, ...] = tuple([] for _ in names)
            for doc, text, start, size, lo, hi in zip(part.column(0).to_pylist(), texts, starts.tolist(), sizes.tolist(), *bounds.tolist(), strict=True):
                text_key = xxhash.xxh3_64_intdigest(text) - (1 << 63)
                edges = [start, *cuts[lo:hi].tolist(), start + size] if size else []
                joins = [True, *free[lo:hi].tolist()]
                for pos in range(max(1, len(edges) - 1)):
                    body = joined[edges[pos] : edges[pos + 1]] if size else b""
                    key = xxhash.xxh3_128_digest(body)
                    new = key not in seen
                    if new:
                        if len(seen) >= KEYS_PER_TASK:
                            seen.clear()
                        seen.add(key)
                    for to, value in zip(rows, (doc, text_key, pos, joins[pos], key, body if new else None), strict=True):
                        to.append(value)
            columns = [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([group] * len(rows[0]), pa.int32())], [*names, "tasks"])


def _encode(ranks, pattern: str):
    """Chunk rows sorted by key, a body first, to (doc_id, text_key, pos, free, ids): one encoding per key."""
    names = ["doc_id", "text_key", "pos", "free", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, *_ = encoder(ranks.value, pattern)
        kind = np.uint16 if enc.n_vocab <= 65_536 else np.uint32
        current, ids = None, b""
        for batch in batches:
            out = []
            for key, body in zip(*(batch.column(c).to_pylist() for c in ("key", "body")), strict=True):
                if key != current:
                    current, ids = key, np.array(encode_text(enc, body.decode()), kind).tobytes()
                out.append(ids)
            yield pa.RecordBatch.from_arrays([*batch.select(names[:-1]).columns, pa.array(out, pa.binary())], names)

    return run


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Windows that overlap as one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(windows):
        if out and lo < out[-1][1]:
            lo, hi = out[-1][0], max(hi, out.pop()[1])
        out.append((lo, hi))
    return out


def repair_joins(ids: np.ndarray, joins: np.ndarray, enc: tiktoken.Encoding, spelled: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """The ids of a text out of those of its chunks, whose open joins are at the byte offsets ``joins``."""
    text = b"".join([spelled[i] for i in ids.tolist()])
    starts = np.cumsum(lengths[ids]) - lengths[ids]
    inner = independent_places(np.frombuffer(text, np.uint8))
    inner = inner[np.isin(inner, starts) & ~np.isin(inner, joins)]
    places = np.concatenate([[0], inner, [len(text)]])
    last = len(places) - 1
    first_id = np.append(np.searchsorted(starts, places[:-1]), len(ids))
    # a window's outer intervals are there for the agreement
    windows = [(max(0, k - 2), min(last, k + 1)) for k in np.searchsorted(places, joins).tolist()]
    fresh: dict[tuple[int, int], np.ndarray] = {}
    grow = 1
    while True:
        windows = _merged(windows)
        wider = []
        for lo, hi in windows:
            if (lo, hi) not in fresh:
                fresh[lo, hi] = np.array(encode_text(enc, text[places[lo] : places[hi]].decode()), ids.dtype)
            new, left, right = fresh[lo, hi], ids[first_id[lo] : first_id[lo + 1]], ids[first_id[hi - 1] : first_id[hi]]
            agree = (lo == 0 or np.array_equal(new[: len(left)], left)) and (hi == last or np.array_equal(new[-len(right) :], right))
            wider.append((lo, hi) if agree else (max(0, lo - grow), min(last, hi + grow)))
        if wider == windows:
            break
        windows, grow = wider, grow * 2
    out, at = [], 0
    for lo, hi in windows:
        out += [ids[at : first_id[lo]], fresh[lo, hi]]
        at = first_id[hi]
    return np.concatenate([*out, ids[at:]])


def _assemble(ranks, pattern: str):
    """(doc_id, parts sorted by place) to (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, spelled, lengths = encoder(ranks.value, pattern)
        kind = np.uint16 if enc.n_vocab <= 65_536 else np.uint32
        for batch in batches:
            parts = batch.column(1)
            flat, offsets = parts.flatten(), parts.offsets.to_numpy()
            offsets = offsets - offsets[0]
            free = flat.field("free").to_pylist()
            ids = flat.field("ids").to_pylist()
            out = []
            for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                whole = np.frombuffer(b"".join(ids[lo:hi]), kind)
                if not all(free[lo:hi]):
                    bounds = np.cumsum([len(i) // whole.itemsize for i in ids[lo : hi - 1]])
                    ends = np.cumsum(lengths[whole])
                    whole = repair_joins(whole, np.array([ends[b - 1] for b, f in zip(bounds, free[lo + 1 : hi], strict=True) if not f]), enc, spelled, lengths)
                out.append(whole)
            ends = np.concatenate([[0], np.cumsum([len(o) for o in out])]).astype(np.int32)
            values = np.concatenate(out).astype(np.int32) if out else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["doc_id", "ids"])

    return run


def tokenise(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>): the ids of every text by the rank file ``vocabulary``, which is read here and sent to the tasks."""
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "doc_id bigint, text_key bigint, pos int, free boolean, key binary, body binary, tasks int"
    texts = spread(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col)), "doc_id")
    placed = texts.mapInArrow(_chunks, schema).repartition("key", "tasks").sortWithinPartitions("key", F.col("body").asc_nulls_last())
    encoded = placed.mapInArrow(_encode(ranks, pattern), "doc_id bigint, text_key bigint, pos int, free boolean, ids binary")
    parts = F.sort_array(F.collect_set(F.struct("pos", "free", "ids"))).alias("parts")
    whole = encoded.groupBy("doc_id", "text_key").agg(parts).select("doc_id", "parts")
    return whole.mapInArrow(_assemble(ranks, pattern), "doc_id bigint, ids array<int>")
