from __future__ import annotations

import json
import random
import time
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from conftest import PAYMENTS, PAYMENTS_2, USERS, USERS_2, USERS_3, document, table_of
from pyspark.sql import functions as F

from sparkpact import Column, Contract, Metadata
from sparkpact.operators import documents, enforce, registry, results, sla, tables
from sparkpact.plans.provisioning import apply_tables, provision, run
from sparkpact.session import materialize
from sparkpact.sources import corpus
from sparkpact.streaming import contracts as contract_stream
from sparkpact.streaming import rows as row_stream
from sparkpact.streaming import windows

SALES = Contract(
    "sales-v1",
    "Sales",
    (
        Column("id", "integer", nullable=False),
        Column("price", "number"),
        Column("day", "date"),
        Column("tags", "array"),
        Column("extra", "object"),
        Column("must", "string", nullable=False),
    ),
)


@pytest.fixture
def sales(spark):
    rows = [("1", "2.5", "2024-01-01", '["a","b"]', '{"x":1}', 9), ("x", "", "2024-02-30", "no", None, 9), (None, None, None, None, None, 9)]
    return spark.createDataFrame(rows, "id string, price string, day string, tags string, extra string, other int")


def test_conform_casts_and_fills(sales):
    typed = enforce.conform(sales, SALES)
    assert typed.columns == [c.name for c in SALES.columns]
    assert dict(typed.dtypes) == {"id": "bigint", "price": "double", "day": "date", "tags": "array<string>", "extra": "string", "must": "string"}
    assert [tuple(r) for r in typed.collect()] == [
        (1, 2.5, date(2024, 1, 1), ["a", "b"], '{"x":1}', None),
        (None,) * 6,
        (None,) * 6,
    ]


def test_counts_add_up_with_rows(spark, sales):
    counted = {(r["column"], r.code): r.bad for r in enforce.violation_counts(sales, SALES).collect()}
    listed = enforce.violations(sales, SALES, []).groupBy("column", "code").count().collect()
    assert {k: v for k, v in counted.items() if v} == {(r["column"], r.code): r["count"] for r in listed}
    assert counted[("must", "missing_column")] == 3 and counted[("id", "null_in_required")] == 1
    empty = enforce.violation_counts(sales.limit(0), SALES).collect()
    assert all((r.rows, r.bad, r.ratio) == (0, 0, 0.0) for r in empty)


def test_wide_contract(spark):
    wide = Contract("w", "W", tuple(Column(f"c{i}", "integer", nullable=False) for i in range(120)))
    df = spark.range(50).select(*[F.when(F.col("id") % (i + 2) != 0, F.col("id").cast("string")).otherwise("x").alias(f"c{i}") for i in range(120)])
    narrow = {(r["column"], r.code): (r.rows, r.bad) for r in enforce.violation_counts(df, wide).collect()}
    assert narrow[("c0", "uncastable")] == (50, 25) and len(narrow) == 240
    listed = enforce.violations(df, wide, []).groupBy("column", "code").count().collect()
    assert {k: v[1] for k, v in narrow.items() if v[1]} == {(r["column"], r.code): r["count"] for r in listed}


def test_split_is_a_partition(spark, sf_dir):
    rows = corpus.orders_dirty(corpus.table(spark, sf_dir, "orders"))
    valid, quarantine = enforce.split_rows(rows, corpus.ORDERS_CONTRACT)
    assert valid.count() + quarantine.count() == rows.count()
    assert quarantine.drop("_reasons").join(valid.select("o_orderkey"), "o_orderkey", "left_semi").count() == 0


def test_plans_stay_lean(spark, sf_dir):
    """Only the contract's columns are read, rules stay in the JVM, and filters reach the scan."""
    table = corpus.table(spark, sf_dir, "lineitem")
    contract = Contract("l", "L", (Column("l_quantity", "integer", nullable=False), Column("l_shipdate", "date")))
    plan = enforce.violation_counts(table, contract)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in plan and "Python" not in plan
    typed = enforce.conform(table, Contract("l", "L", (Column("l_returnflag", "string"),))).where("l_returnflag = 'R'")
    assert "EqualTo(l_returnflag,R)" in typed._jdf.queryExecution().executedPlan().toString()


def test_numbers_and_times_are_not_each_other(spark):
    df = spark.createDataFrame([(1.5, 2.0, datetime(2024, 1, 1), True)], "a double, b double, t timestamp, f boolean")
    c = Contract("n", "N", (Column("a", "integer"), Column("b", "integer"), Column("t", "number"), Column("f", "date")))
    assert tuple(enforce.conform(df, c).first()) == (None, 2, None, None)


def test_parse_records(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "note": "n"}'), (2, '{"k": "x"}'), (3, "{"), (4, ""), (5, "{}")], "id int, raw string")
    rows = [tuple(r) for r in enforce.parse_records(df, "raw", corpus.PROPS_CONTRACT).orderBy("id").collect()]
    assert rows == [(1, 5, "n", None), (2, None, None, '{"k": "x"}'), (3, None, None, "{"), (4, None, None, ""), (5, None, None, None)]


def test_latency_percentiles_against_brute_force(spark):
    df = spark.range(5000).select(
        (F.col("id") % 3).cast("string").alias("by"),
        F.timestamp_millis(F.lit(1_700_000_000_000)).alias("at"),
        F.timestamp_millis(F.lit(1_700_000_000_000) + ((F.col("id") * 7919 * 7919) % 3_000_003) - 1000).alias("came"),
    )
    contract = Contract("s", "S", (Column("a", "string"),), metadata=Metadata(sla_max_latency_ms=100_000))
    got = {r.by: (r.p50, r.p99, r.max_ms, r.late) for r in sla.sla_latency(df, "at", "came", contract, ["by"]).collect()}
    for by in "012":
        values = sorted((i * 7919 * 7919) % 3_000_003 - 1000 for i in range(int(by), 5000, 3))
        n = len(values)
        p50, p99 = values[(n + 1) // 2 - 1], values[-(-n * 99 // 100) - 1]
        assert got[by] == (p50, p99, values[-1], sum(v > 100_000 for v in values))


def test_tables_written_and_evolved(spark, tmp_path, sales):
    contract = Contract("My-Sales", "Sales", SALES.columns[:3], description="It's sales", metadata=Metadata(data_steward=""))
    table = tables.write_contract_table(sales, contract, str(tmp_path), "db_one")
    assert table == "`db_one`.`my_sales`"
    held = tables.table_properties(spark, table)
    assert (held["contract_id"], held["iceberg_table_version"], held["data_steward"]) == ("My-Sales", "1.0.0", "Unknown")
    second = Contract("My-Sales", "Sales", (Column("price", "string"), Column("id", "integer"), Column("new", "date", description="later")), version="2.0.0")
    tables.evolve_table(spark, second, str(tmp_path), "db_one")
    after = spark.table("db_one.my_sales")
    assert after.dtypes == [("price", "string"), ("id", "bigint"), ("new", "date")]
    assert after.where("id = 1").first()["price"] == "2.5" and after.count() == 3
    again = tables.table_properties(spark, table)
    assert again["iceberg_table_version"] == "2.0.0" and again["created_at"] == held["created_at"]
    existing = tables.existing_columns(spark, "db_one").collect()
    assert {(r.table_name, r.name, r.type, r.version) for r in existing} == {
        ("my_sales", "price", "string", "2.0.0"),
        ("my_sales", "id", "bigint", "2.0.0"),
        ("my_sales", "new", "date", "2.0.0"),
    }
    with pytest.raises(tables.TableNotFound):
        tables.evolve_table(spark, Contract("none", "N", SALES.columns), str(tmp_path), "db_one")


def test_too_many_columns_are_rejected(spark):
    docs = [document("wide", ", ".join(f"c{i} string" for i in range(1001))), document("ok", "a string")]
    loaded = materialize(documents.load_contracts(table_of(spark, docs)).drop("raw"), "loaded")
    plan = tables.plan_tables(loaded, spark.createDataFrame([], tables.EXISTING_SCHEMA))
    assert {r.contract_id: (r.action, r.columns_count) for r in plan.collect()} == {"wide": ("rejected", 1001), "ok": ("created", 1)}


def test_a_run_over_files(spark, tmp_path):
    files = {
        "all/user/01/u.json": document("users", USERS),
        "all/user/02/u.json": document("users", USERS_2, "2.0.0"),
        "all/pay/01/p.json": document("pay", PAYMENTS),
        "all/pay/02/p.json": document("pay", PAYMENTS_2, "2.0.0"),
        "all/orders/o.json": document("orders", "order_id int!"),
        "current/user/u.json": document("users", USERS_2, "2.0.1"),
        "all/odd/d.json": document("odd", "a string, a string"),
    }
    for path, doc in files.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(json.dumps(doc))
    none = spark.createDataFrame([], tables.EXISTING_SCHEMA)
    first = run(spark, str(tmp_path), str(tmp_path / "registry"), none, "one")
    summary = first.summary().first()
    assert (summary.total_files, summary.total_contracts, summary.validation_passed) == (7, 3, 6)
    assert (summary.schema_registered, summary.schema_failed, summary.tables_planned, summary.tables_failed) == (4, 2, 2, 1)
    assert not summary.ready and list(summary.actions) == ["fix validation errors", "fix schema registration", "fix table creation", "apply what is planned"]
    by_id = {r.contract_id: r for r in first.by_contract.collect()}
    assert by_id["users"].schema.registry_version == 2 and by_id["pay"].schema.schema_status == "failed"
    assert by_id["odd"].validation.build_status == "failed" and by_id["odd"].table.table_status == "failed"
    # Only the current folder is run again and again. Going over the archive once more
    # would hold its first version against the latest and register it anew.
    second = run(spark, str(tmp_path / "current"), str(tmp_path / "registry"), none, "two")
    assert spark.read.parquet(str(tmp_path / "registry")).count() == 3
    loaded = documents.load_contracts(table_of(spark, list(files.values())))
    counts = results.status_counts(results.file_status(loaded)).first()
    assert (counts.total, counts.passed, counts.failed, counts.ok) == (7, 5, 2, False)
    assert second.summary().first().total_files == 1


def test_a_run_with_nothing_wrong_is_ready(spark, tmp_path):
    docs = table_of(spark, [document("a", "x string"), document("b", "y string")])
    none = spark.createDataFrame([], tables.EXISTING_SCHEMA)
    planned = provision(docs, None, none, "x")
    found = planned.summary().first()
    assert (found.schema_planned, found.tables_planned, found.ready, list(found.actions)) == (2, 2, False, ["apply what is planned"])
    assert not planned.summary(strict=True).first().ready
    done = apply_tables(provision(docs, str(tmp_path / "registry"), none, "x"), str(tmp_path / "tables"), "ready_db")
    assert done.summary().first().ready and done.summary(strict=True).first().ready
    assert {t.name for t in spark.catalog.listTables("ready_db")} == {"a", "b"}
    assert tables.table_properties(spark, "`ready_db`.`a`")[tables.VERSION_PROPERTY] == "1.0.0"
    # A second version of one of them evolves its table.
    later = table_of(spark, [document("a", "x string, z number", version="2.0.0")])
    there = tables.existing_columns(spark, "ready_db")
    again = apply_tables(provision(later, str(tmp_path / "registry"), there, "y"), str(tmp_path / "tables"), "ready_db")
    assert again.summary().first().tables_updated == 1
    assert spark.table("ready_db.a").columns == ["x", "z"]
    spark.sql("DROP DATABASE ready_db CASCADE")


def test_stream_of_files_equals_batch(spark, tmp_path):
    docs = {"all/user/01/u.json": document("users", USERS), "all/user/02/u.json": document("users", USERS_2), "all/x/bad.json": {"a": 1}}
    for path, doc in docs.items():
        (tmp_path / "in" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / path).write_text(json.dumps(doc))
    for _ in range(2):  # the second start finds nothing new
        contract_stream.stream_contracts(spark, str(tmp_path / "in"), str(tmp_path / "reg"), str(tmp_path / "cp")).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "reg"))
    assert {(r.contract_id, r.registry_version) for r in kept.collect()} == {("users", 1), ("users", 2)}


def test_late_rows_and_sliding_windows(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1, i // 60, i % 60), None if i % 4 == 0 else 1) for i in range(600)]
    contract = Contract("t", "T", (Column("n", "integer", nullable=False),))
    spark.createDataFrame(rows, "id int, ts timestamp, n int").repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, ts timestamp, n int").parquet(str(tmp_path / "in"))
    shares, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    row_stream.stream_violation_counts(stream, "ts", contract, "2 hours", shares, checkpoint, "1 hour").awaitTermination()
    out = {(r.window_start, r.code): (r.rows, r.bad) for r in row_stream.read_violation_counts(spark, shares).collect()}
    assert out[(datetime(2024, 1, 1, 3), "null_in_required")] == (120, 30)
    # The last windows are there, and what comes later still, also behind all others, is added.
    assert out[(datetime(2024, 1, 1, 9), "null_in_required")] == (60, 15)
    late = [(1000, datetime(2024, 1, 1, 3, 30), None), (1001, None, 1)]
    spark.createDataFrame(late, "id int, ts timestamp, n int").write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, ts timestamp, n int").parquet(str(tmp_path / "in"))
    row_stream.stream_violation_counts(stream, "ts", contract, "2 hours", shares, checkpoint, "1 hour").awaitTermination()
    out = {(r.window_start, r.code): (r.rows, r.bad) for r in row_stream.read_violation_counts(spark, shares).collect()}
    assert out[(datetime(2024, 1, 1, 3), "null_in_required")] == (121, 31)
    assert out[(None, "null_in_required")] == (1, 0)


def test_files_out_of_order_one_by_one(spark, tmp_path):
    """However files are cut into batches, the registry is that of one batch."""
    docs = {f"all/user/{n:02d}/u.json": document("users", spec, version=f"{n}.0.0") for n, spec in enumerate((USERS, USERS_2, USERS_2 + ", more string", USERS_3), 1)}
    found = []
    for each, order in ((1, sorted(docs, reverse=True)), (100, sorted(docs))):
        root = tmp_path / str(each)
        for path in order:
            (root / "in" / path).parent.mkdir(parents=True, exist_ok=True)
            (root / "in" / path).write_text(json.dumps(docs[path]))
            time.sleep(0.02)
        contract_stream.stream_contracts(spark, str(root / "in"), str(root / "reg"), str(root / "cp"), files_per_batch=each).awaitTermination()
        kept = registry.read_registry(spark, str(root / "reg")).collect()
        found.append(sorted((r.contract_id, r.registry_version, r.version) for r in kept))
    assert found[0] == found[1] and len(found[0]) >= 3


def test_contracts_without_rules_and_groups(spark):
    optional = Contract("o", "O", (Column("absent", "string"),))
    df = spark.range(3)
    assert enforce.violations(df, optional, ["id"]).count() == 0
    assert enforce.violation_counts(df, optional).count() == 0
    assert enforce.split_rows(df, optional)[0].count() == 3
    times = spark.range(10).select(F.timestamp_seconds("id").alias("a"), F.timestamp_seconds(F.col("id") * 2).alias("b"))
    line = sla.sla_latency(times, "a", "b", optional, []).first()
    assert (line.rows, line.late, line.p50, line.max_ms) == (10, 4, 4000, 9000)


def test_rollup_keeps_every_count(spark):
    """One owner per contract without a seq, and a line for contracts without documents."""
    docs = documents.load_contracts(table_of(spark, [document("a", "x string"), document("a", "x string, y string")])).drop("seq", "file_path")
    counts = spark.createDataFrame([("a", 100, 7), ("gone", 5, 2)], "contract_id string, rows bigint, bad bigint")
    found = {(r.owner, r.contract_id): (r.contracts, r.rows, r.bad) for r in sla.owner_rollup(counts, docs).collect()}
    assert found[(None, None)] == (2, 105, 9)
    assert found[("Some Team", "a")] == (1, 100, 7) and found[(sla.UNKNOWN_OWNER, "gone")] == (1, 5, 2)


def test_missing_files_are_skipped(spark):
    docs = spark.createDataFrame([("a.json", 0, None), ("b.json", 1, json.dumps(document("b", "x string")))], "file_path string, seq bigint, raw string")
    found = {r.file: (r.status, r.reason) for r in results.file_status(documents.load_contracts(docs)).collect()}
    assert found == {"a.json": ("SKIPPED", results.FILE_NOT_FOUND), "b.json": ("PASSED", None)}


def test_contracts_of_too_many_columns_get_no_table(spark):
    docs = documents.load_contracts(table_of(spark, [document("wide", ", ".join(f"c{i} string" for i in range(tables.MAX_COLUMNS + 1)))]))
    assert tables.plan_tables(docs, spark.createDataFrame([], tables.EXISTING_SCHEMA)).first().action == "rejected"


def test_windows_over_many_batches(spark, tmp_path, monkeypatch):
    """Late rows over many restarts and a replay: every row is counted once, behind the mark or not; folders stay few."""
    random.seed(4)
    monkeypatch.setattr(windows, "MERGED", 3)
    schema, start = "id int, ts timestamp, n int", datetime(2024, 1, 1)
    contract = Contract("t", "T", (Column("n", "integer", nullable=False),))
    path, sums, seen, wanted = str(tmp_path / "out"), row_stream._VIOLATIONS, None, {}
    for batch in range(10):
        rows = [(i, start + timedelta(minutes=batch * 60 + random.randrange(-600, 60)), None if i % 3 == 0 else 1) for i in range(30)]
        rows += [(99, None, 1), (100, start - timedelta(days=50), None)] if batch % 4 == 1 else []
        df = spark.createDataFrame(rows, schema).coalesce(1)
        lines = row_stream._violation_lines(df, "ts", contract, "1 hour", None)
        for _ in range(2 if batch in (4, 8) else 1):  # a replay
            windows.take_batch(lines, batch, path, sums, "2 hours")
        mark = seen - timedelta(hours=2) if seen else None
        for _, ts, n in rows:
            at = ts.replace(minute=0, second=0) if ts else None
            behind = ts is not None and mark is not None and at + timedelta(hours=1) <= mark
            total = wanted.setdefault(at, [0, 0, 0])
            total[0], total[1], total[2] = total[0] + 1, total[1] + (n is None), total[2] + behind
        seen = max([t for _, t, _ in rows if t] + ([seen] if seen else []))
        if batch in (4, 8, 9):
            found = row_stream.read_violation_counts(spark, path, detail=True).where("code = 'null_in_required'").collect()
            assert {r.window_start: [r.rows, r.bad, r.behind_rows] for r in found} == wanted
            assert all(r.closed == (r.window_start is None or r.window_start + timedelta(hours=1) <= seen - timedelta(hours=2)) for r in found)
    assert len(list((tmp_path / "out" / "state").iterdir())) == 2
    assert len(list((tmp_path / "out" / "log").glob("level=*/batch_id=*"))) == 2
    for _ in range(2):
        windows.close_windows(spark, path)
        found = row_stream.read_violation_counts(spark, path, detail=True).where("code = 'null_in_required'").collect()
        assert {r.window_start: [r.rows, r.bad, r.behind_rows] for r in found} == wanted and all(r.closed for r in found)
    windows.take_batch(row_stream._violation_lines(spark.createDataFrame([(1, seen, 1)], schema), "ts", contract, "1 hour", None), 10, path, sums, "2 hours")
    total = row_stream.read_violation_counts(spark, path, detail=True).where("code = 'null_in_required'").agg(F.sum("rows"), F.sum("behind_rows")).first()
    assert tuple(total) == (sum(w[0] for w in wanted.values()) + 1, sum(w[2] for w in wanted.values()) + 1)


def test_sla_windows_without_latency(spark, tmp_path):
    rows = [(datetime(2024, 1, 1, 1), None, "a"), (datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 1, 0, 9), "b"), (None, None, "a")]
    stream_in = spark.createDataFrame(rows, "e timestamp, a timestamp, k string").coalesce(1)
    stream_in.write.parquet(str(tmp_path / "in"))
    contract = Contract("t", "T", (Column("k", "string"),))
    stream = spark.readStream.schema(stream_in.schema).parquet(str(tmp_path / "in"))
    row_stream.stream_sla(stream, "e", "a", contract, "1 hour", str(tmp_path / "out"), str(tmp_path / "cp"), ["k"]).awaitTermination()
    found = {(r.window_start, r.k): (r.rows, r.late, r.max_ms, r.p50) for r in row_stream.read_sla(spark, str(tmp_path / "out"), ["k"], {"p50": 0.5}).collect()}
    at = datetime(2024, 1, 1, 1)
    assert found == {(at, "a"): (1, 0, None, None), (at, "b"): (1, 1, 9000, 9000), (None, "a"): (1, 0, None, None)}


def test_columns_change_without_files(spark, tmp_path):
    """Added and dropped columns leave the files alone; a retype, or a name that comes back, has them written anew."""
    versions_ = {
        1: "a integer, b string, c number",
        2: "c number, d date, A integer",  # b dropped, d added
        3: "a integer, c number, d date, e boolean",  # e added
        4: "a integer, b string",  # b comes back, its old values do not
        5: "a number, b string",  # retyped
    }
    contract = lambda n: Contract("meta", "M", tuple(Column(*part.split()) for part in versions_[n].split(", ")), version=f"{n}.0.0")
    rows = spark.createDataFrame([(1, "x", 0.5), (2, "y", 1.5)], "a long, b string, c double")
    tables.write_contract_table(rows, contract(1), str(tmp_path), "meta_db")
    files = lambda: set(spark.table("meta_db.meta").inputFiles())
    held = [files()]
    for n in (2, 3, 4, 5):
        tables.evolve_table(spark, contract(n), str(tmp_path), "meta_db")
        held.append(files())
        assert tables.table_properties(spark, "meta_db.meta")[tables.VERSION_PROPERTY] == f"{n}.0.0"
        if n == 3:
            assert sorted(map(tuple, spark.table("meta_db.meta").collect())) == [(1, 0.5, None, None), (2, 1.5, None, None)]
    assert held[0] == held[1] == held[2] and not held[2] & held[3] and not held[3] & held[4]
    assert sorted(map(tuple, spark.table("meta_db.meta").collect())) == [(1.0, None), (2.0, None)]
    assert tables.DROPPED_PROPERTY not in tables.table_properties(spark, "meta_db.meta")
    spark.sql("DROP DATABASE meta_db CASCADE")


def test_split_reads_rows_once(spark, sales, tmp_path):
    """One pass writes both sides and counts; the sides are those of split_rows."""
    read = spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = sales.unionByName(sales.withColumn("must", F.lit("there")), allowMissingColumns=True)
    counted = source.mapInArrow(through, source.schema)
    counts = enforce.write_split(counted, SALES, str(tmp_path / "split")).collect()
    assert read.value == source.count() == 6
    assert sorted(map(tuple, counts)) == sorted(map(tuple, enforce.violation_counts(source, SALES).collect()))
    for side, expected in zip(enforce.SIDES, enforce.split_rows(source, SALES)):
        found = enforce.read_split(spark, str(tmp_path / "split"), side, source, SALES)
        assert found.dtypes == expected.dtypes
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    nothing = enforce.write_split(source.where("false"), SALES, str(tmp_path / "none"))
    assert {(r.rows, r.bad, r.ratio) for r in nothing.collect()} == {(0, 0, 0.0)}


def test_a_table_that_fails_says_so(spark, tmp_path):
    """The others are made, and only what was done is told as done."""
    docs = table_of(spark, [document("ok", "x string"), document("gone", "y string")])
    none = spark.createDataFrame([], tables.EXISTING_SCHEMA)
    planned = provision(docs, str(tmp_path / "registry"), none, "x")
    # As if the plan had found a table that is no longer there.
    status = F.when(F.col("contract_id") == "gone", "planned_updated").otherwise(F.col("table_status"))
    done = apply_tables(replace(planned, tables=planned.tables.withColumn("table_status", status)), str(tmp_path / "tables"), "fail_db")
    assert {r.contract_id: r.table_status for r in done.tables.collect()} == {"ok": "created", "gone": "failed"}
    assert not done.summary().first().ready
    spark.sql("DROP DATABASE fail_db CASCADE")
