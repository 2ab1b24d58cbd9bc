import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starweave.operators.packed_fields import explode_packed_fields, scan_values

CASES = {
    "a;b;c": ["a", "b", "c"], "a;;b; ": ["a", "b"], ";a;": ["a"], "a, b|c\td\ne / f；g": list("abcdefg"), "a b": ["a", "b"], '["a", "b c"]': ["a", "b c"], "{a,b}": ["a", "b"], "[]": [],
    '"x ""y"" z";w': ['x "y" z', "w"], '["x \\"y\\" z"]': ['x "y" z'], "'a', 'b;c'": ["a", "b;c"], "'it''s'": ["it's"], "n:1;m:2;n:1": ["n:1", "m:2", "n:1"], None: [], "": [], "  ": [], "NaN": [], "<NA>": [], "None": [],
    "nan;a": ["nan", "a"], '"open;a': ['"open', "a"], "f(a;b);c": ["f(a;b)", "c"], "f(a;b": ["f(a", "b"], '"a"b;c': ["ab", "c"], '["a\\u00e9\\n"]': ["aé\n"], '"a；b"；c': ["a；b", "c"], "[[a,b],c]": ["a", "b", "c"], "a]": ["a]"], '""': [""], "]": ["]"],
}


@pytest.mark.parametrize("text", list(CASES))
def test_cases(text):
    assert scan_values(text) == CASES[text]


values = st.lists(st.text(st.characters(codec="utf-8"), min_size=0, max_size=12), min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(values, st.sampled_from([";", ",", "|", " / ", "\t", "\n", "；", " "]))
def test_doubled_quotes_round_trip(items, sep):
    assert scan_values(sep.join('"' + v.replace('"', '""').replace("\\", "\\\\") + '"' for v in items)) == items


@settings(max_examples=200, deadline=None)
@given(values)
def test_json_round_trip(items):
    text = json.dumps(items, ensure_ascii=False)
    if "\\u" not in text:
        assert scan_values(text) == items


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_never_fails(text):
    scan_values(text)


def test_long_field_is_linear():
    assert len(scan_values(";".join(["value"] * 200_000))) == 200_000
    assert len(scan_values('"' * 20_001)) >= 1


def test_table(spark):
    rows = [(1, "a;b", "x:1"), (1, "a;b", "x:1"), (2, None, "nan"), (None, "q", ""), (3, "b;b", None)]
    df = spark.createDataFrame(rows, "rid long, f string, g string").selectExpr("*", "'other' AS item_value", "1 AS pos")
    got = sorted(map(tuple, explode_packed_fields(df, "rid", ["f", "g"], "t").collect()), key=str)
    assert got == sorted([("t", 1, "f", 1, "a"), ("t", 1, "f", 2, "b"), ("t", 1, "g", 1, "x:1"), ("t", None, "f", 1, "q"), ("t", 3, "f", 1, "b"), ("t", 3, "f", 2, "b")], key=str)
    assert explode_packed_fields(df.limit(0), "rid", ["f"], "t").count() == 0
