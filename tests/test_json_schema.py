"""JSON Schemas as types and checks, schemas that requests carry, UUIDs of names."""
import json
import uuid

import pytest
from pyspark.sql import functions as F

from recordlog.functions.names import name_uuid
from recordlog.sources.codec import ingest_requests
from recordlog.sources.json_schema import Schemas, errors, spark_type

ORDER = {"type": "object", "required": ["id", "lines"], "additionalProperties": False, "properties": {
    "id": {"type": "integer", "minimum": 1}, "state": {"enum": ["new", "paid", 3, None, True]},
    "code": {"type": ["string", "null"], "pattern": "^[A-Z]+$", "minLength": 2, "maxLength": 4},
    "rate": {"type": "number", "exclusiveMinimum": 0, "exclusiveMaximum": 1},
    "lines": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}}}}}}
L = '"lines":[{"n":1}]'
CASES = [
    (f'{{"id":1,{L}}}', []),
    (f'{{"id":1.0,"state":"paid","code":null,"rate":0.5,{L}}}', []),
    (f'{{"id":2,"state":3,"code":"AB",{L}}}', []),
    (f'{{"id":2,"state":null,{L}}}', []),
    (f'{{"id":2,"state":true,{L}}}', []),
    (f'{{"id":"1",{L}}}', ["$.id: is not integer"]),
    (f'{{"id":1.5,{L}}}', ["$.id: is not integer"]),
    (f'{{"id":null,{L}}}', ["$.id: is not integer"]),
    (f'{{"id":12345678901234567890123,{L}}}', ["$.id: does not fit 64 bits"]),
    (f'{{"id":0,{L}}}', ["$.id: is below 1"]),
    (f'{{{L}}}', ["$.id: is required"]),
    ('{"id":1}', ["$.lines: is required"]),
    (f'{{"id":1,"x":1,{L}}}', ["$: has properties that are not listed"]),
    (f'{{"id":1,"state":"3",{L}}}', ["$.state: is none of the listed values"]),
    (f'{{"id":1,"code":"a",{L}}}', ["$.code: is shorter than 2", "$.code: does not match its pattern"]),
    (f'{{"id":1,"code":"ABCDE",{L}}}', ["$.code: is longer than 4"]),
    (f'{{"id":1,"rate":0,{L}}}', ["$.rate: is not above 0"]),
    (f'{{"id":1,"rate":1,{L}}}', ["$.rate: is not below 1"]),
    ('{"id":1,"lines":[]}', ["$.lines: has fewer than 1 items"]),
    ('{"id":1,"lines":[{"n":1},{"n":1},{"n":1},{"n":1}]}', ["$.lines: has more than 3 items"]),
    ('{"id":1,"lines":[{"n":1},{"n":"1"},{}]}', ["$.lines[].n: is not integer", "$.lines[].n: is required"]),
    ('{"id":1,"lines":[null]}', ["$.lines[]: is not object"]),
    ('[1]', ["$: is not object"]),
    ('null', ["$: is not object"]),
]


def test_errors(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)], "k int, t string")
    got = {r.k: r.e for r in df.select("k", errors(F.parse_json("t"), ORDER).alias("e")).collect()}
    assert got == {k: e for k, (_, e) in enumerate(CASES)}


def test_type_of_a_schema(spark):
    assert spark_type(json.dumps(ORDER)).simpleString() == \
        "struct<id:bigint,state:variant,code:string,rate:double,lines:array<struct<n:bigint>>>"
    assert spark_type({"type": "object"}).simpleString() == "map<string,variant>"
    s = Schemas([(4, "o", 1, json.dumps(ORDER))])
    df = spark.createDataFrame([('{"id":7,"lines":[{"n":1},{"n":2}]}',)], "t string")
    got = df.select(s.typed(F.parse_json("t"), 4).alias("o")).select("o.id", "o.code", "o.lines.n").first()
    assert tuple(got) == (7, None, [1, 2])


@pytest.mark.parametrize("schema", [{"oneOf": []}, {"$ref": "#/x"}, {"type": "text"}, {"additionalProperties": {}}, {"enum": [[1]]}, [],
                                    {"properties": {"a": {"not": {}}}}, {"items": {"uniqueItems": True}}])
def test_what_is_not_understood_is_refused(schema):
    with pytest.raises(ValueError):
        spark_type(schema)


def test_requests_carry_schemas_and_times(spark):
    s = Schemas([(1, "a", 1, '{"type":"object","required":["x"]}'), (2, "a", 2, '{"type":"object","required":["y"]}')])
    record = [{"key": "k", "value": '{"x":1}', "timestamp": 1700000000123}, {"value": None}, {"value": "{"}]
    ways = [{"valueSchemaId": 1}, {"valueSchemaId": 9}, {"valueSchemaSubject": "a"}, {"valueSchemaSubject": "a", "valueSchemaVersion": 1},
            {"valueSchemaSubject": "b"}, {"valueSchema": '{"required": ["y"], "type": "object"}'}, {"valueSchema": "{"}, {}]
    df = spark.createDataFrame([(k, json.dumps({"records": record, "keySchemaSubject": "s", **w})) for k, w in enumerate(ways)], "k int, request string")
    recs = ingest_requests(df, schemas=True)
    first = recs.filter("k = 3 and seq = 0").select(F.unix_millis("record_ts"), "key_schema_subject", "value_schema_version").first()
    assert tuple(first) == (1700000000123, "s", 1)
    recs = recs.withColumn("id", s.id_of(*[F.col(f"value_schema{x}") for x in ("_id", "_subject", "_version", "")]))
    got = s.decode(recs, id_col="id", on_error="keep").orderBy("k", "seq").collect()
    unknown, y = ["$: its schema is not registered"], ["$.y: is required"]
    assert [(r.id, r.errors_value) for r in got if r.seq == 0] == [(1, []), (-1, unknown), (2, y), (1, []), (-1, unknown), (2, y), (-1, unknown), (None, [])]
    assert all(r.errors_value == [] and r.value is None for r in got if r.seq == 1)
    assert all(r.errors_value == ["$: is not JSON"] and r.corrupt_value == "{" for r in got if r.seq == 2)
    assert s.decode(recs, id_col="id", on_error="skip").count() == 3 + 8
    with pytest.raises(Exception, match="invalid record value"):
        s.decode(recs, id_col="id").collect()


def test_unknown_format_is_refused(spark):
    df = spark.createDataFrame([('{"keyFormat": "xml", "records": [{"key": "a"}]}',)], "request string")
    with pytest.raises(Exception, match="unknown format XML"):
        ingest_requests(df).collect()


def test_uuid_of_a_name(spark):
    names = ["", "a", "é𝒳", "x" * 999] + [str(k) for k in range(50)]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", name_uuid(F.col("n")).alias("u")).collect()
    assert all(r.u == str(uuid.uuid5(uuid.NAMESPACE_URL, r.n)) for r in got)
