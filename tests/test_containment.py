"""JSON containment against a brute-force version in Python."""

import json

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from darkroom.functions.containment import contains
from darkroom.operators import metadata


def held(d, p, top=True):
    if isinstance(p, dict):
        return isinstance(d, dict) and all(k in d and held(d[k], v, False) for k, v in p.items())
    if isinstance(p, list):
        return isinstance(d, list) and all(any(held(x, v, False) for x in d) for v in p)
    same = isinstance(d, bool) == isinstance(p, bool) and not isinstance(d, (dict, list)) and d == p
    return same or (top and isinstance(d, list) and any(held(x, p, False) for x in d if not isinstance(x, (dict, list))))


DOCS = [
    None, {}, [], 200, "200", True, {"ISO": 200}, {"ISO": "200"}, {"ISO": 200.0}, {"ISO": 200.5}, {"ISO": None}, {"ISO": False}, {"ISO": 0},
    {"ISO": [200, 400], "gps": {"lat": 1.5, "ref": "N"}}, {"gps": {"lat": "1.5"}}, {"tags": ["a", "b", ["c", "d"], {"k": 1, "l": 2}]},
    {"tags": "a"}, [1, 2, 2, 3], [[1, 2], 3], ["a", None, True], {"it's": {'a"b': 9007199254740993}}, {"it's": {'a"b': 9007199254740992}},
    {"x": {"y": {"z": ["é", ""]}}}, {"x": 1e300}, {"x": -0.0}, {"ISO": {"ISO": 200}},
]
PATTERNS = [
    {}, [], 200, "200", True, None, {"ISO": 200}, {"ISO": "200"}, {"ISO": None}, {"ISO": False}, {"ISO": 0}, {"ISO": [200]}, {"ISO": [400, 200, 200]},
    {"gps": {}}, {"gps": {"lat": 1.5}}, {"gps": {"lat": "1.5"}}, {"tags": ["b"]}, {"tags": [["d"]]}, {"tags": [{"l": 2}]}, {"tags": ["c"]}, {"tags": "a"},
    [2, 1], [3, [2]], [[3]], "a", 2, {"it's": {'a"b': 9007199254740993}}, {"x": {"y": {"z": [""]}}}, {"x": 1e300}, {"x": 0}, {"ISO": {"ISO": 200}}, {"none": None},
]


def _check(spark, docs, patterns):
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(-1, None)], "i int, j string")
    for p in patterns:
        got = [r.i for r in rows.where(contains(F.try_parse_json("j"), p)).collect()]
        assert sorted(got) == [i for i, d in enumerate(docs) if held(d, p)], p


def test_containment_cases(spark):
    _check(spark, DOCS, PATTERNS)
    with pytest.raises(ValueError):
        contains(F.lit(None), {"a'b\"c": 1})
    with pytest.raises(TypeError):
        contains(F.lit(None), {"a": object()})


LEAF = st.one_of(st.none(), st.booleans(), st.integers(-3, 3), st.sampled_from(["", "a", "1"]), st.sampled_from([0.5, 1.0]))
VALUE = st.recursive(LEAF, lambda c: st.one_of(st.lists(c, max_size=3), st.dictionaries(st.sampled_from("ab"), c, max_size=2)), max_leaves=5)


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(VALUE, min_size=12, max_size=12), st.lists(VALUE, min_size=5, max_size=5))
def test_containment_of_any_values(spark, docs, patterns):
    _check(spark, docs, patterns)


def test_search_by_containment(spark):
    rows = spark.createDataFrame([("/a", '{"ISO": 200, "Make": "X"}'), ("/b", '{"ISO": "200", "Make": "X"}'), ("/c", "no json"), ("/d", None)], "file_path string, metadata_json string")
    assert [r.file_path for r in metadata.find_photos(rows, json_holds={"ISO": 200}).collect()] == ["/a"]
    assert [r.file_path for r in metadata.find_photos(rows, json_holds={"ISO": "200"}).collect()] == ["/b"]
