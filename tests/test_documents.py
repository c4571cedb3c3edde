"""JSON documents as rows, and the comparison of two contract schemas."""

import json

import pytest

from graphloom import contract as C
from graphloom.operators.documents import document_differences, pointer_rows

SCHEMA = {
    "$id": "one.json", "type": "object", "additionalProperties": False, "required": ["file_id", "path"],
    "properties": {"file_id": {"type": "string", "pattern": "^[0-9a-f]{64}$"}, "path": {"type": "string", "minLength": 1},
                   "status": {"enum": list(C.STATUSES)}, "lines": {"type": "integer", "minimum": 0}, "any": {}},
}


def whole(spark, folder):
    return spark.read.text(str(folder), wholetext=True)


def test_schemas_are_compared_without_their_ids(spark, tmp_path):
    def write(name, schema, **layout):
        (tmp_path / name).write_text(json.dumps(schema, **layout))
        return whole(spark, tmp_path / name)

    first = write("first.json", SCHEMA, indent=2)
    turned = dict(reversed(SCHEMA.items())) | {"$id": "two.json"}
    assert document_differences(first, write("second.json", turned), "value").count() == 0
    other = json.loads(json.dumps(SCHEMA))
    other["properties"]["lines"]["minimum"] = "0"
    other["required"].append("lines")
    del other["properties"]["any"]
    found = {tuple(r) for r in document_differences(first, write("third.json", other), "value").collect()}
    assert found == {("/properties/lines/minimum", "0", "left"), ("/properties/lines/minimum", '"0"', "right"),
                     ("/required/2", '"lines"', "right"), ("/properties/any", "{}", "left")}


def test_pointers(spark):
    rows = [(1, '{"a": {"b": [1, "1", {"c": null}], "d": {}}, "e/f~": [], "g": true}'), (2, '"top"'), (3, None), (4, "[]")]
    got = sorted(map(tuple, pointer_rows(spark.createDataFrame(rows, "k int, j string"), "j", keep=["k"]).collect()))
    assert got == sorted([(1, "/a/b/0", "1"), (1, "/a/b/1", '"1"'), (1, "/a/b/2/c", "null"), (1, "/a/d", "{}"), (1, "/e~1f~0", "[]"),
                          (1, "/g", "true"), (2, "", '"top"'), (4, "", "[]")])
    assert pointer_rows(spark.createDataFrame([], "j string"), "j").count() == 0
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        pointer_rows(spark.createDataFrame([("{",)], "j string"), "j").collect()
