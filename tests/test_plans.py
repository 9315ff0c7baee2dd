"""What the plans of costly steps may not hold, and that the lean forms give the same values."""

from __future__ import annotations

import json
import re

from conftest import AVRO_USERS, document, table_of
from pyspark.sql import functions as F

from sparkpact.functions.steps import bind
from sparkpact.operators import avro, documents, versions
from sparkpact.plans import queries


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bound_values_are_made_by_a_projection(spark):
    bound = bind(spark.range(3).withColumn("a", F.array("id", "id")), {"b": F.transform("a", lambda x: x + 1), "c": F.size("a")})
    assert re.search(r"Generate inline\(array\(_made_by_bind#\d+\)\)", _plan(bound))
    assert [tuple(r) for r in bound.select("id", "b", "c").orderBy("id").collect()] == [(i, [i + 1, i + 1], 2) for i in range(3)]


def test_plain_documents_are_read_as_typed(spark):
    repeated = json.dumps(document("c", "id string!")).replace('"name": "A Contract"', '"name": "First", "name": "Second"')
    docs = [document("a", "id string!, n number"), repeated, document("c", "id string!", version=2), document("d", "id string!", metadata={"sla_uptime_percentage": 99})]
    parsed = documents.parse_contracts(table_of(spark, docs))
    assert "from_json(" in _plan(parsed.select("quick"))
    quick = {r.seq: r.quick for r in parsed.select("seq", "quick").collect()}
    assert quick[2] is None
    assert quick[1]["name"] == "Second" and quick[3]["metadata"]["sla_uptime_percentage"] == 99.0
    assert [(c["name"], c["data_type"], c["nullable"]) for c in quick[0]["columns"]] == [("id", "string", False), ("n", "number", True)]
    assert quick[0]["metadata"]["sla_uptime_percentage"] == 99.5


def test_an_avro_text_is_read_once(spark):
    fields = [*AVRO_USERS["fields"], {"name": "n", "type": ["null", "long"]}, {"name": "a", "type": {"type": "array", "items": "string"}}]
    df = spark.createDataFrame([("u", json.dumps({**AVRO_USERS, "fields": fields}))], "id string, avro_schema string")
    columns = documents.explode_columns(avro.from_avro(df, id_col="id"))
    # Neither the filter on empty lists nor a second field of the contract has the fields read again.
    assert _plan(columns).count("$.fields") == 2
    assert [(r.name, r.data_type, r.nullable) for r in columns.orderBy("ordinal").collect()] == [
        ("user_name", "string", False), ("email", "string", False), ("n", "integer", True), ("a", "array", False)
    ]


def test_what_was_first_declared_is_reduced_before_it_is_spread(spark):
    column = "array<struct<name:string,data_type:string,nullable:boolean,description:string>>"
    rows = spark.createDataFrame(
        [("c", i, f"{i}.json", [("id", "integer" if i else None, False, ""), ("x", "number", True, "")]) for i in range(4)],
        f"contract_id string, seq bigint, file_path string, columns {column}",
    )
    declared = versions.first_declared(rows)
    assert "Aggregate [contract_id#" in _plan(declared) and len(re.findall(r"Aggregate \[", _plan(declared))) == 3
    entries = {e["column"]: e for e in declared.first()["declared"]}
    assert tuple(entries["id"]["required"]) == (1, "1.json") and entries["x"]["required"] is None


def test_registration_takes_no_texts_along(spark, monkeypatch):
    rows = spark.createDataFrame([("c", 1, "1.json"), ("c", 2, "2.json")], "contract_id string, seq bigint, file_path string")
    more = {"definition_hash": F.col("file_path"), "avro_schema": F.lit("{}"), "columns": F.array().cast(documents.COLUMN_TYPE)}
    seen = []

    def plan(registered, one_each, mode):
        seen.append(one_each.columns)
        return one_each.withColumns({"action": F.lit("create"), "registry_version": F.lit(1), "offending": F.array().cast(versions.OFFENDING_TYPE)})

    monkeypatch.setattr(queries, "_candidates", lambda *_: rows.withColumns(more))
    monkeypatch.setattr(queries.registry, "plan_registration", plan)
    assert [r.seq for r in queries.QUERIES["registration_plan"](spark, "").collect()] == [2]
    assert "avro_schema" not in seen[0]


def test_parts_of_runs_land_in_several_files(spark, tmp_path):
    """No task writes a whole part; each run still takes its part as one batch."""
    batches = []

    def start(stream):
        writer = stream.writeStream.foreachBatch(lambda batch, _: batches.append(sorted(r.id for r in batch.collect())))
        return writer.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()

    queries._runs(spark, spark.range(300).repartition(4), str(tmp_path), F.col("id") % queries.BATCHES, start)
    assert batches == [list(range(number, 300, queries.BATCHES)) for number in range(queries.BATCHES)]
    assert len(list((tmp_path / "landed").glob("*.parquet"))) > queries.BATCHES
