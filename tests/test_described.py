"""Many folders of self-describing files with the same columns are one group."""

from __future__ import annotations

import json

import pytest

from tickerloom.plans.ingest import ingest, read_ingested
from tickerloom.sources.described import json_columns


def test_folders_with_the_same_columns_are_one_group(spark, tmp_path):
    def put(folder, name, data):
        place = tmp_path / "in" / folder
        place.mkdir(parents=True)
        (place / name).write_text(data)

    for i in range(12):
        put(f"a{i}", "o.json", json.dumps([{"code": f"x{i}", "note": "" if i % 2 else "n"}]))
    put("b", "o.json", json.dumps([{"code": 7, "note": "n"}]))
    put("c", "o.json", json.dumps([{"code": "x", "more": "m"}]))
    put("d", "o.json", '[{"code": ')
    rows = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()
    groups = {r.input_file.split("/in/")[1].split("/")[0]: r.schema_group for r in rows}
    assert len({groups[f"a{i}"] for i in range(12)}) <= 2  # 12 before
    assert [r.input_file.split("/in/")[1] for r in rows if r.status == "failed"] == ["d/o.json"]
    found = {}
    for group in {g for g in groups.values() if g is not None}:
        back = read_ingested(spark, str(tmp_path / "out"), group)
        found |= {r.source_folder: (r.code, set(back.columns)) for r in back.collect()}
    assert found["b"][0] == 7 and "more" in found["c"][1] and "more" not in found["a1"][1]
    assert {found[f"a{i}"][0] for i in range(12)} == {f"x{i}" for i in range(12)}


def test_json_columns_are_what_spark_infers(spark):
    def same(a, b):
        return json_columns(json.dumps(a).encode(), True) == json_columns(json.dumps(b).encode(), True)

    assert same([{"a": 1, "b": ""}, {"b": "x"}], [{"b": "y", "a": 5}])
    assert same([{"a": [1, None]}], [{"a": []}, {"a": [3]}])
    assert not same([{"a": 1}], [{"a": 1.5}])
    assert not same([{"a": 1}], [{"a": 2**63}])
    assert not same([{"a": {"x": 1}}], [{"a": {"x": "1"}}])
    assert not same([{"a": None}], [{"a": True}])
    for odd in (b"[]", b"[1]", b'{"a": 1, "a": 2}', b'[{"a": 1}', b"\xff"):
        with pytest.raises(ValueError):
            json_columns(odd, True)
    assert json_columns(b'{"a": 1}\n{"a": 2}\r\n\n', False) == json_columns(b'[{"a": 3}]', True)
