from __future__ import annotations

import json

import pytest
from conftest import AVRO_USERS, PAYMENTS, USERS, USERS_2, columns, document, table_of
from pyspark.sql import functions as F

from sparkpact.operators import avro, documents, tags
from sparkpact.sources.contracts import read_contracts


def structure_codes(spark, docs):
    checked = documents.check_structure(documents.parse_contracts(table_of(spark, docs)))
    return [r.codes for r in checked.orderBy("seq").select(F.expr("transform(errors, e -> e.code)").alias("codes")).collect()]


@pytest.fixture(scope="module")
def good():
    return document("c-1", USERS)


STRUCTURE = [
    # absent keys count, null or "" in them do not
    ({"name": ...}, ["missing_field"]),
    ({"name": None}, []),
    ({"name": ""}, []),
    ({"contract_id": ..., "description": ...}, ["missing_field", "missing_field"]),
    # no columns in every empty form, and something that is no list
    ({"columns": ...}, ["missing_field", "no_columns"]),
    ({"columns": None}, ["no_columns"]),
    ({"columns": []}, ["no_columns"]),
    ({"columns": {}}, ["no_columns"]),
    ({"columns": ""}, ["no_columns"]),
    ({"columns": 0}, ["no_columns"]),
    ({"columns": False}, ["no_columns"]),
    ({"columns": "a"}, ["columns_not_list"]),
    ({"columns": {"a": 1}}, ["columns_not_list"]),
    ({"columns": 7}, ["columns_not_list"]),
    # columns
    ({"columns": [1, None, "x", []]}, ["column_not_object"] * 4),
    ({"columns": [{"data_type": "string"}]}, ["column_missing_name"]),
    ({"columns": [{"name": "a"}]}, ["column_missing_data_type", "invalid_data_type"]),
    ({"columns": [{"name": "a", "data_type": None}]}, ["invalid_data_type"]),
    ({"columns": [{"name": "a", "data_type": "String"}]}, ["invalid_data_type"]),
    ({"columns": [{"name": "a", "data_type": ["string"]}]}, ["invalid_data_type"]),
    ({"columns": [{"name": "a", "data_type": {"x": 1}}]}, ["invalid_data_type"]),
    ({"columns": [{}]}, ["column_missing_name", "column_missing_data_type", "invalid_data_type"]),
    ({"columns": columns("a string") + [None]}, ["column_not_object"]),
    # a version counts only if there is something in it
    ({"version": 2}, ["version_not_string"]),
    ({"version": [1]}, ["version_not_string"]),
    ({"version": 0}, []),
    ({"version": None}, []),
    ({"version": ""}, []),
]


def test_structure_rules(spark, good):
    found = structure_codes(spark, [{**{k: v for k, v in good.items()}, **c} if ... not in c.values() else {k: v for k, v in {**good, **c}.items() if v is not ...} for c, _ in STRUCTURE])
    assert found == [codes for _, codes in STRUCTURE]


def test_what_is_not_a_document(spark, good):
    texts = ["[1]", "null", '"x"', "3", "{", "", json.dumps(good)[:-2], "  " + json.dumps(good), '{"a": NaN}']
    parsed = documents.parse_contracts(table_of(spark, texts)).orderBy("seq").select("parse_status")
    assert [r[0] for r in parsed.collect()] == ["not_object"] * 4 + ["invalid_json"] * 3 + ["ok", "invalid_json"]
    assert structure_codes(spark, ["[1]", "{"]) == [["not_object"], ["invalid_json"]]


def test_last_of_repeated_keys_counts(spark, good):
    text = json.dumps(good)[:-1] + ', "name": "Second"}'
    (row,) = documents.load_contracts(table_of(spark, [text])).select("contract.name", "build_status").collect()
    assert tuple(row) == ("Second", "built")


def loaded(spark, docs):
    rows = documents.load_contracts(table_of(spark, docs)).orderBy("seq").collect()
    return rows


BUILD = [
    ({"name": None}, "unreadable: name"),
    ({"name": 5}, "unreadable: name"),
    ({"version": None}, "unreadable: version"),
    ({"version": 0}, "unreadable: version"),
    ({"description": True}, "unreadable: description"),
    ({"contract_id": " "}, "blank_contract_id"),
    ({"name": "\t\n"}, "blank_name"),
    ({"description": ""}, "blank_description"),
    ({"metadata": "x"}, "unreadable: metadata"),
    ({"metadata": {"data_owner": 1}}, "unreadable: metadata.data_owner"),
    ({"metadata": {"sla_max_latency_ms": 5.5}}, "unreadable: metadata.sla_max_latency_ms"),
    ({"metadata": {"sla_uptime_percentage": None}}, "unreadable: metadata.sla_uptime_percentage"),
    ({"metadata": {"sla_uptime_percentage": "99.9.9"}}, "unreadable: metadata.sla_uptime_percentage"),
    ({"columns": [{"name": "a", "data_type": "string", "nullable": None}]}, "unreadable: columns.nullable"),
    ({"columns": [{"name": "a", "data_type": "string", "nullable": "maybe"}]}, "unreadable: columns.nullable"),
    ({"columns": [{"name": None, "data_type": "string"}]}, "unreadable: columns.name"),
    ({"columns": [{"name": "a", "data_type": "string", "description": 1}]}, "unreadable: columns.description"),
    ({"columns": columns("a string, a string, b string, a date")}, "duplicate_column_name at column 1: a; duplicate_column_name at column 3: a"),
    ({"columns": [{"name": " ", "data_type": "string"}]}, "blank_column_name at column 0"),
    # one column says null where others say true: nothing may hide behind the others
    ({"columns": columns("a string") + [{"name": "b", "data_type": "string", "nullable": None}]}, "unreadable: columns.nullable"),
    ({"columns": columns("a string") + [{"name": "b", "data_type": "string", "description": None}]}, "unreadable: columns.description"),
]


def test_valid_but_not_buildable(spark, good):
    rows = loaded(spark, [{**good, **change} for change, _ in BUILD])
    assert [(r.validate_status, r.build_status, r.reason) for r in rows] == [("valid", "failed", reason) for _, reason in BUILD]
    assert all(r.contract is None for r in rows)


def test_defaults_and_coercions(spark, good):
    docs = [
        {**good, "metadata": {"sla_uptime_percentage": "99.9", "sla_max_latency_ms": "250", "other": 1}},
        {**good, "metadata": {"sla_uptime_percentage": 99, "sla_max_latency_ms": 5.0}},
        {**good, "metadata": {}},
        {k: v for k, v in good.items() if k not in ("metadata", "version")},
        {**good, "metadata": None},
        {**good, "columns": [{"name": n, "data_type": "string", "nullable": v} for n, v in zip("abcdef", ["yes", 1, "OFF", 0, "f", True])]},
        {**good, "columns": [{"name": "a", "data_type": "array"}, {"name": "b", "data_type": "object", "nullable": False}]},
    ]
    rows = [r.contract for r in loaded(spark, docs)]
    assert [(r.metadata.sla_uptime_percentage, r.metadata.sla_max_latency_ms) for r in rows[:5]] == [
        (99.9, 250),
        (99.0, 5),
        (99.95, 5000),
        (99.95, 5000),
        (99.95, 5000),
    ]
    assert rows[3].version == "1.0.0" and rows[2].metadata.data_owner == "Data Team"
    assert [c.nullable for c in rows[5].columns] == [True, True, False, False, False, True]
    assert [(c.nullable, c.description) for c in rows[6].columns] == [(True, ""), (False, "")]


def test_quick_and_close_reading_agree(spark, good):
    """A key no rule knows sends a document to the close reading; its contract must not change."""
    docs = [good, document("c-2", PAYMENTS), document("c-3", "a object, b array!", metadata=...), document("c-4", USERS_2, version=...)]
    quick = [r.contract for r in loaded(spark, docs)]
    close = [r.contract for r in loaded(spark, [{**d, "unknown": 1} for d in docs])]
    assert quick == close and all(quick)


def test_sample_documents(spark):
    docs = [
        document("users", USERS),
        document("users", USERS_2, "2.0.0"),
        AVRO_USERS,
        document("orders", "order_id int!, order_date date!"),
        document("subscriptions", "subscription_id int!, subscription_date date!"),
    ]
    rows = loaded(spark, docs)
    assert [r.build_status for r in rows] == ["built", "built", None, None, None]
    assert [e.code for e in rows[2].errors] == ["missing_field"] * 3 + ["no_columns"]
    assert [e.code for e in rows[3].errors] == ["invalid_data_type"]
    assert documents.explode_columns(documents.built_contracts(documents.load_contracts(table_of(spark, docs)))).count() == 8


def test_read_contracts(spark, tmp_path, good):
    for path in ("all/user/01/user_v1.json", "all/user/02/user_v1.json", "all/user/03-bad/user_v1.json", "all/loose.json", "current/user/user_v1.json"):
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(json.dumps(good, indent=2))
    (tmp_path / "all/user/01/user_v1_avro.json").write_text("{}")
    (tmp_path / "all/user/01/notes.txt").write_text("no contract")
    rows = read_contracts(spark, str(tmp_path)).orderBy("file_path").collect()
    assert [(r.domain, r.archive_seq) for r in rows] == [(None, None), ("user", 1), ("user", 2), ("user", 3), ("user", None)]
    assert all(json.loads(r.raw) == good for r in rows)
    assert read_contracts(spark, str(tmp_path / "nowhere")).count() == 0


def test_avro_text(spark):
    doc = document("c", "id string!, price number, parts array", description="About")
    doc["columns"][0]["description"] = ""
    (text,) = avro.to_avro(documents.load_contracts(table_of(spark, [doc]))).select("avro_schema").first()
    schema = json.loads(text)
    assert schema["name"] == "AContract" and schema["namespace"] == "com.example.schema" and schema["type"] == "record"
    assert schema["doc"] == (
        "About\n\nMetadata:\n  Data Owner: Some Team (some-team@example.org)\n  Data Steward: Stewards (stewards@example.org)\n"
        "  SLA Uptime: 99.5%\n  SLA Max Latency: 1000ms"
    )
    assert schema["fields"] == [
        {"name": "id", "type": "string"},
        {"name": "price", "type": ["null", "double"], "doc": "the price", "default": None},
        {"name": "parts", "type": ["null", {"type": "array", "items": "string"}], "doc": "the parts", "default": None},
    ]
    (strict,) = avro.to_avro(documents.load_contracts(table_of(spark, [doc])), strict_reference=True).select("avro_schema").first()
    assert json.loads(strict)["fields"][2]["type"] == ["null", "array"]


def test_avro_metadata_if_present(spark):
    docs = [document("c", "id string!", metadata=...), document("c", "id string!", metadata={"data_owner": "X"})]
    rows = avro.to_avro(documents.load_contracts(table_of(spark, docs)), metadata="if_present").orderBy("seq").collect()
    assert ["Metadata:" in json.loads(r.avro_schema)["doc"] for r in rows] == [False, True]


def test_avro_to_contract(spark):
    fields = [
        ("a", "long", "integer", False),
        ("b", ["null", "float"], "number", True),
        ("c", ["string", "null"], "string", True),
        ("d", ["int", "string"], "integer", False),
        ("e", ["null"], "string", True),
        ("f", {"type": "array", "items": "string"}, "array", False),
        ("g", {"type": "record", "fields": []}, "string", False),
        ("h", "bytes", "string", False),
        ("i", "null", "string", False),
        ("j", {"type": "long", "logicalType": "timestamp-millis"}, "string", False),
        ("k", "boolean", "boolean", False),
    ]
    schema = {"type": "record", "name": "Thing", "doc": AVRO_USERS["doc"], "fields": [{"name": n, "type": t} for n, t, *_ in fields]}
    df = spark.createDataFrame([(json.dumps(schema),), ("[]",), ("{",)], "avro_schema string")
    rows = [r.contract for r in avro.from_avro(df).collect()]
    assert rows[1] is None and rows[2] is None
    assert [(c.name, c.data_type, c.nullable) for c in rows[0].columns] == [(n, d, o) for n, _, d, o in fields]
    assert rows[0].contract_id == "thing" and rows[0].description == "People"
    meta = rows[0].metadata
    assert (meta.data_owner, meta.data_owner_email, meta.data_steward) == ("Some Team", "some-team@example.org", "Data Engineering")
    assert (meta.sla_uptime_percentage, meta.sla_max_latency_ms) == (99.9, 700)


def test_doc_metadata_with_numbers_that_are_none(spark):
    df = spark.createDataFrame([("SLA Uptime: 1.2.3%",), ("SLA Max Latency: 99999999999999999999ms",), (None,)], "doc string")
    rows = [r.metadata for r in avro.doc_metadata(df).collect()]
    assert [(r.sla_uptime_percentage, r.sla_max_latency_ms) for r in rows] == [(99.95, 5000)] * 3


def test_typed_tags(spark):
    df = spark.createDataFrame([({"SLAUptimePercentage": "x", "SLAMaxLatencyMs": "12", "DataOwner": "T"},), ({},)], "tags map<string,string>")
    rows = [r.tag_metadata for r in tags.typed_tags(df).collect()]
    assert (rows[0].sla_uptime_percentage, rows[0].sla_max_latency_ms, rows[0].data_owner) == (None, 12, "T")
    assert rows[1].managed_by is None


def _plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_avro_texts_are_put_together_without_a_variant(spark):
    spec = [
        {"name": 'a"b', "data_type": "array", "nullable": True, "description": "d\n"},
        {"name": "n", "data_type": "zzz", "nullable": False, "description": ""},
        {"name": None, "data_type": None, "nullable": None, "description": None},
    ]
    rows = [({"contract_id": "a", "name": "N x", "description": "é {} \\", "columns": spec},), ({"contract_id": "a", "name": None},), (None,)]
    schemas = avro.to_avro(spark.createDataFrame(rows, f"contract {documents.PLAIN_TYPE}"))
    plan = _plan_of(schemas)
    assert "to_variant_object" not in plan.lower() and "variant_object" not in plan.lower()
    first, second, third = (r.avro_schema for r in schemas.select("avro_schema").collect())
    head, tail = '{"doc":"é {} \\\\\\n\\nMetadata:\\n', '"name":"Nx","namespace":"com.example.schema","type":"record"}'
    assert first.startswith(head) and first.endswith(tail)
    assert '"fields":[{"default":null,"doc":"d\\n","name":"a\\"b","type":["null",{"items":"string","type":"array"}]},' in first
    assert '{"name":"n","type":"string"},{"name":null,"type":null}]' in first
    assert second == '{"doc":null,"fields":null,"name":null,"namespace":"com.example.schema","type":"record"}'
    assert third is None


def test_plain_documents_are_read_without_casting_their_columns(spark):
    docs = [document("a", "x string!, y number"), document("a", "x string!, x number"), document("a", "x strin"), document("a", "x string", name=" ")]
    parsed = documents.parse_contracts(table_of(spark, docs))
    # The type of what has nulls by rule is not forced on what has none.
    assert not parsed.schema["quick"].dataType["columns"].dataType.elementType["nullable"].nullable
    assert [r.quick is not None for r in parsed.orderBy("seq").collect()] == [True, False, False, False]
