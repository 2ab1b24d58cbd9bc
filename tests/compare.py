"""Row sets of a Spark result and a SQL result, made alike."""

from collections import Counter
from decimal import Decimal


def _cell(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, Decimal | float):
        return round(float(v), 6) + 0.0
    if isinstance(v, list):
        return tuple(v)
    return str(v) if hasattr(v, "isoformat") else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def assert_same(df, con, sql):
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    want = rows_of(columns, found.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
