import json

import pytest

from lexquarry.operators import nested


def found(spark, payloads):
    df = spark.createDataFrame([(i, p, "x") for i, p in enumerate(payloads)], "record_id long, payload string, node string")
    return {tuple(r) for r in nested.declared(nested.nodes(df)).select("record_id", "node_path", "parent_path").collect()}


def test_shapes(spark):
    deep = {"subsections": []}
    for _ in range(8):
        deep = {"subsections": [None, deep]}
    payloads = [
        json.dumps({"sections": {"content": "a", "subsections": [None, "s", {"label": "b"}]}}),
        json.dumps([{"order_number": "x", "sections": json.dumps([{"content": "c"}])}, 5, {"metadata": {"amendments": [{"law": "RA 1"}], "legal_status": {"changes": {"by": "y"}}}}]),
        "﻿" + json.dumps({"metadata": json.dumps({"footnotes": [None, {"number": 1}]})}),
        '{"sections": [{"a": ', None, "", "null", "7", json.dumps({"sections": None, "subsections": [], "metadata": 3}),
        json.dumps({"sections": [{"subsections": json.dumps({"subsections": json.dumps([{"label": "z"}])})}]}),
        json.dumps(deep),
    ]
    got = found(spark, payloads)
    assert {g[1:] for g in got if g[0] == 0} == {("$.sections[0]", "$"), ("$.sections[0].subsections[2]", "$.sections[0]")}
    assert {g[1:] for g in got if g[0] == 1} == {
        ("$[0].sections[0]", "$[0]"), ("$[2].metadata.amendments[0]", "$[2]"), ("$[2].metadata.legal_status.changes[0]", "$[2]"),
    }
    assert {g[1:] for g in got if g[0] == 2} == {("$.metadata.footnotes[1]", "$")}
    assert {g[0] for g in got} == {0, 1, 2, 9, 10}
    assert len([g for g in got if g[0] == 9]) == 3
    assert len([g for g in got if g[0] == 10]) == 8


def test_empty(spark):
    df = spark.createDataFrame([], "record_id long, payload string")
    assert nested.nodes(df).count() == 0


def test_child_table(spark):
    df = spark.createDataFrame([(1, json.dumps({"metadata": {"amendments": [{"law": "RA 1", "date": "2001-02-03"}, {"date": "never"}]}}))], "record_id long, payload string")
    rows = nested.child_table(nested.nodes(df), "amendment").orderBy("ord").collect()
    assert [(r.law, str(r.law_date)) for r in rows] == [("RA 1", "2001-02-03"), (None, "None")]


def test_unknown_array_becomes_a_table(spark):
    payloads = [json.dumps({"order_number": "x", "annexes": [{"code": "A", "pages": 3, "ord": 7, "signers": [{"name": "B"}, None]}]}), json.dumps({"mixed": [{"code": "Z"}, "x"]}), json.dumps({"annexes": {"code": 5}}), json.dumps({"annexes": json.dumps([{"code": "C"}])}), json.dumps({"plain": [1, 2]})]
    df = spark.createDataFrame(list(enumerate(payloads)), "record_id long, payload string")
    all_nodes = nested.nodes(df)
    assert {(r.record_id, r.kind, r.node_path, r.parent_path) for r in all_nodes.collect()} == {
        (0, "annexes", "$.annexes[0]", "$"), (0, "signers", "$.annexes[0].signers[0]", "$.annexes[0]"), (2, "annexes", "$.annexes[0]", "$"), (3, "annexes", "$.annexes[0]", "$"), (1, "mixed", "$.mixed[0]", "$"),
    }
    merged = nested.schema(nested.records(df))
    rows = {(r.record_id, r.code, r.pages, r.ord_) for r in nested.inferred_table(all_nodes, merged, "annexes").collect()}
    assert rows == {(0, "A", 3, 7), (2, "5", None, None), (3, "C", None, None)}
    assert [r.name for r in nested.inferred_table(all_nodes, merged, "signers").collect()] == ["B"]


@pytest.mark.parametrize("shape,want", [
    ("OBJECT<a: STRING>", {("$", "object"), ("$.a", "string")}), ("ARRAY<BIGINT>", {("$[]", "bigint")}), ("OBJECT<`a b`: VARIANT, c: ARRAY<VARIANT>>", {("$", "object"), ("$.c[]", "array")}),
    ("OBJECT<s: ARRAY<OBJECT<l: STRING, s: ARRAY<OBJECT<l: DOUBLE>>>>>", {("$", "object"), ("$.s[]", "array"), ("$.s[]", "object"), ("$.s[].l", "string"), ("$.s[].l", "double")}),
])
def test_patterns(shape, want):
    assert set(nested.patterns_of(shape)) == want
