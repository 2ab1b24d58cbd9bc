"""Several values packed into one text field, one row per value with its place.

A finite-state scanner reads each field once, left to right, in linear time:

* BETWEEN values: separators and blanks are skipped (empty places are no values and take no
  place); an opening ``[`` or ``{`` opens a container around values, its partner closes it;
  a quote mark starts a QUOTED value, anything else a BARE one.
* BARE: runs to the next separator at nesting depth 0; brackets opened inside the value raise the
  depth and their content, separators included, stays part of the value.
* QUOTED: runs to the closing mark. A doubled mark stands for the mark; a backslash escape is
  undone (``\\" \\' \\\\ \\/ \\n \\t \\r \\b \\f \\uXXXX``), other backslashes stay.

Defined results: NULL, blank and missing-word fields (nan, none, <na>) give no row; an empty pair of
quotes gives an empty value; a quote that is never closed is an ordinary character of a bare value; ties and repeated values keep their
own places; exact copies of a record count once; an empty table gives an empty table; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.functions.numeric import MISSING_WORDS

OPEN, CLOSE = "[{(", "]})"
PARTNER = dict(zip(CLOSE, OPEN, strict=True))
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
SEPARATORS = ";,|/；，"

_GAP = re.compile(rf"[\s{re.escape(SEPARATORS)}]+")
_BARE_RUN = re.compile(rf"[^\s{re.escape(SEPARATORS + OPEN + CLOSE)}]+")
_NESTED_RUN = re.compile(rf"[^{re.escape(OPEN + CLOSE)}]+")
_QUOTED_RUN = {q: re.compile(rf"[^{q}\\]+") for q in "\"'"}


def _quoted(text: str, at: int) -> tuple[str, int] | None:
    """The value whose opening mark is at ``at`` and the position after its closing mark."""
    mark, at, out = text[at], at + 1, []
    while at < len(text):
        if run := _QUOTED_RUN[mark].match(text, at):
            out.append(run[0])
            at = run.end()
        elif text[at] == mark:
            if text.startswith(mark, at + 1):
                out.append(mark)
                at += 2
            else:
                return "".join(out), at + 1
        else:
            nxt = text[at + 1 : at + 2]
            code = text[at + 2 : at + 6]
            if nxt == "u" and re.fullmatch(r"[0-9a-fA-F]{4}", code):
                out.append(chr(int(code, 16)))
                at += 6
            elif nxt in ESCAPES:
                out.append(ESCAPES[nxt])
                at += 2
            elif nxt and nxt in "\"'\\/":
                out.append(nxt)
                at += 2
            else:
                out.append("\\")
                at += 1
    return None


def _bare(text: str, at: int, containers: list[str]) -> tuple[str, int]:
    """The unquoted value that starts at ``at``; it ends at a separator or its container's end."""
    begin, nest = at, []
    while at < len(text):
        run = (_NESTED_RUN if nest else _BARE_RUN).match(text, at)
        if run:
            at = run.end()
        elif text[at] in OPEN:
            nest.append(text[at])
            at += 1
        elif nest and text[at] in CLOSE:
            if nest[-1] == PARTNER[text[at]]:
                nest.pop()
            at += 1
        elif not nest and text[at] in CLOSE and PARTNER[text[at]] not in containers:
            at += 1
        else:
            break
    if nest and at >= len(text):  # a bracket that is never closed nests nothing
        end = _GAP.search(text, begin)
        at = end.start() if end else len(text)
    return text[begin:at], at


def scan_values(text: str | None) -> list[str]:
    """All values of one field in their order."""
    if text is None or text.strip().lower() in ("", *MISSING_WORDS):
        return []
    values, containers, at = [], [], 0
    unclosed = set()
    while at < len(text):
        if gap := _GAP.match(text, at):
            at = gap.end()
            continue
        c = text[at]
        if c in "[{":
            containers.append(c)
            at += 1
        elif c in "]}" and PARTNER[c] in containers:
            while containers.pop() != PARTNER[c]:
                pass
            at += 1
        else:
            quoted = _quoted(text, at) if c in "\"'" and c not in unclosed else None
            if quoted:
                value, at = quoted
                if at < len(text) and not _GAP.match(text, at) and text[at] not in "]}":
                    rest, at = _bare(text, at, containers)
                    value += rest
            else:
                if c in "\"'":
                    unclosed.add(c)
                value, at = _bare(text, at, containers)
                if not value:  # a lone closing bracket
                    value, at = c, at + 1
            values.append(value)
    return values


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(record_id, which, raw) to one row per value; equal raw fields of a task are scanned once."""
    seen: dict[str, list[str]] = {}
    for batch in batches:
        record, which, pos, value = [], [], [], []
        for r, w, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values = seen.get(raw)
            if values is None:
                values = scan_values(raw)
                if len(raw) < 1000:
                    if len(seen) > 20_000:
                        seen.clear()
                    seen[raw] = values
            record.extend([r] * len(values))
            which.extend([w] * len(values))
            pos.extend(range(1, len(values) + 1))
            value.extend(values)
        arrays = [pa.array(record, pa.int64()), pa.array(which, pa.int32()), pa.array(pos, pa.int32()), pa.array(value, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, ["record_id", "which", "pos", "item_value"])


def explode_packed_fields(df: DataFrame, id_col: str, fields: list[str], table_name: str) -> DataFrame:
    """One row per value: table_name, record_id, field_name, pos, item_value.

    All fields of the table go through one scan and one exchange. Exact copies of a record fall
    together before anything is scanned, with partial aggregation on the map side, so a record
    copied a million times is one row per map task."""
    packed = F.posexplode(F.array(*[F.col(f).cast("string") for f in fields])).alias("which", "raw")
    records = df.select(F.col(id_col).cast("bigint").alias("record_id"), packed).where(F.col("raw").isNotNull()).distinct()
    values = records.mapInArrow(_explode, "record_id bigint, which int, pos int, item_value string")
    return values.select(
        F.lit(table_name).alias("table_name"),
        "record_id",
        F.array(*[F.lit(f) for f in fields])[F.col("which")].alias("field_name"),
        "pos",
        "item_value",
    )
