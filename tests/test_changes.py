"""What is looked at again and what is not: files, tables, and contracts told from texts alone."""

from __future__ import annotations

import gzip
import json
import os

import pytest
from conftest import document, table_of

from sparkpact import Column, Contract
from sparkpact.operators import enforce, inference, registry, tables
from sparkpact.plans.provisioning import apply_tables, provision, run_changed
from sparkpact.sources import contracts
from sparkpact.streaming import contracts as contract_stream


def put(folder, name, doc):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(doc if isinstance(doc, str) else json.dumps(doc))
    return path


def scan(spark, folder, manifest, load_id):
    changed = contracts.changed_contracts(spark, str(folder), contracts.read_manifest(spark, str(manifest), load_id))
    contracts.write_manifest(changed.files, str(manifest), load_id)
    return sorted(os.path.basename(r.file_path) for r in changed.documents.collect()), changed.files.count()


def test_only_changed_files_are_read(spark, tmp_path, monkeypatch):
    folder, manifest = tmp_path / "in", tmp_path / "manifest"
    assert scan(spark, folder, manifest, "0") == ([], 0)  # no such folder
    for name in ("all/u/01/a.json", "all/u/02/b.json", "current/u/with space.json"):
        put(folder, name, {"name": name})
    put(folder, "current/u/a_avro.json", "{}")
    assert scan(spark, folder, manifest, "1") == (["a.json", "b.json", "with%20space.json"], 3)
    assert scan(spark, folder, manifest, "2") == ([], 0)
    # New contents; contents of the same length; a new file; and one that was only touched.
    put(folder, "all/u/01/a.json", {"name": "other and longer than before"})
    os.utime(put(folder, "all/u/02/b.json", {"name": "ALL/u/02/b.json"}), (2e9, 2e9))
    put(folder, "all/u/03/c.json", "{")
    put(folder, "all/u/03/empty.json", "")
    os.utime(folder / "current/u/with space.json", (2e9, 2e9))
    assert scan(spark, folder, manifest, "3") == (["a.json", "b.json", "c.json"], 4)
    assert scan(spark, folder, manifest, "4") == ([], 0)
    # Load 3 again gives the same; a name that reads as a pattern, and more files than are named, are found as well.
    assert scan(spark, folder, manifest, "3") == (["a.json", "b.json", "c.json"], 4)
    put(folder, "all/u/04/d[1].json", "{}")
    assert scan(spark, folder, manifest, "5") == (["d%5B1%5D.json"], 1)
    monkeypatch.setattr(contracts, "NAMED_FILES", 1)
    for name in ("e", "f"):
        put(folder, f"all/u/05/{name}.json", "{}")
    assert scan(spark, folder, manifest, "6") == (["e.json", "f.json"], 2)


def test_an_archive_run_twice_registers_nothing(spark, tmp_path):
    place = {name: str(tmp_path / name) for name in ("in", "registry", "manifest")}
    for number, spec in enumerate(("a string", "a string, b string", "a string, b string, c string"), 1):
        put(tmp_path / "in", f"all/u/{number:02d}/u.json", document("u", spec, version=f"{number}.0.0"))
    none = spark.createDataFrame([], tables.EXISTING_SCHEMA)

    def again(load_id):
        done = run_changed(spark, place["in"], place["registry"], place["manifest"], none, load_id)
        return done.validation.count(), registry.read_registry(spark, place["registry"]).count()

    assert again("1") == (3, 3)
    assert again("2") == (0, 3)
    put(tmp_path / "in", "all/u/04/u.json", document("u", "a string, b string, c string, d string", version="4.0.0"))
    assert again("3") == (1, 4)


def test_tables_are_planned_from_what_was_noted(spark, tmp_path, monkeypatch):
    catalog, root = str(tmp_path / "catalog"), str(tmp_path / "tables")

    def step(docs, load_id):
        planned = provision(table_of(spark, docs), None, tables.read_catalog(spark, catalog, load_id), load_id)
        done = apply_tables(planned, root, "noted_db", catalog, load_id)
        return {r.contract_id: r.table_status for r in done.tables.collect()}

    docs = [document("a-1", "x string, n integer"), document("b", "y string")]
    assert step(docs, "1") == {"a-1": "created", "b": "created"}
    # The same load again, as if it had ended before it was noted.
    assert step(docs, "1") == {"a-1": "updated", "b": "updated"}
    # A table of another contract under the name is left alone.
    spark.sql("CREATE TABLE noted_db.c (q string) USING parquet")
    with monkeypatch.context() as patch:
        patch.setattr(tables, "existing_columns", None)
        patch.setattr(type(spark.catalog), "listColumns", None)
        later = [document("a-1", "x string, z number", version="2.0.0"), docs[1], document("c", "x string")]
        assert step(later, "2") == {"a-1": "updated", "b": "unchanged", "c": "failed"}
    assert spark.table("noted_db.c").columns == ["q"]
    spark.sql("DROP TABLE noted_db.c")
    held = tables.existing_columns(spark, "noted_db")
    assert sorted(held.collect()) == sorted(tables.read_catalog(spark, catalog).collect())
    # Brought in from the catalog alone.
    tables.import_catalog(spark, "noted_db", str(tmp_path / "other"), "0")
    assert sorted(tables.read_catalog(spark, str(tmp_path / "other")).collect()) == sorted(held.collect())
    spark.sql("DROP DATABASE noted_db CASCADE")
    with pytest.raises(ValueError):
        apply_tables(None, root, "noted_db", catalog)


def test_ten_thousand_noted_tables(spark, tmp_path):
    """Planned in a join: the number of jobs is that of one table."""
    contract = "named_struct('contract_id', concat('t-', id), 'version', '1.0.0', 'columns', array(named_struct('name', 'x', 'data_type', 'string')))"
    lines = tables.catalog_lines(spark.range(10_000).selectExpr(f"{contract} AS contract"))
    tables.write_catalog(lines, str(tmp_path / "catalog"), "1")
    docs = table_of(spark, [document("t-5", "x string"), document("t-6", "x string, y string"), document("new", "x string")])
    planned = provision(docs, None, tables.read_catalog(spark, str(tmp_path / "catalog")), "2").tables
    assert {r.contract_id: r.table_status for r in planned.collect()} == {"t-5": "unchanged", "t-6": "planned_updated", "new": "planned_created"}


def inferred(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    return {r.column: (r.data_type, r.nullable, r.seen) for r in inference.infer_json_contract(df, "raw", "c", "C").collect()}


@pytest.mark.parametrize(
    ("values", "data_type"),
    [
        (["1", "-7"], "integer"),
        (["1", "2.5"], "number"),
        (["1e3"], "number"),
        (["123456789012345678901"], "number"),
        (["true", "false"], "boolean"),
        (["true", "1"], "string"),
        (["[1]", "[]"], "array"),
        (["{}", '{"a": 1}'], "object"),
        (["[1]", "{}"], "string"),
        (['"2024-02-29"'], "date"),
        (['"2023-02-29"'], "string"),
        (['"2024-01-01"', '"2024-01-01T10:00:00Z"'], "timestamp"),
        (['"2024-01-01"', "5"], "string"),
        (['"5"', "5"], "string"),
        (["null"], "string"),
    ],
)
def test_narrowest_type(spark, values, data_type):
    assert inferred(spark, *[f'{{"k": {v}}}' for v in values]) == {"k": (data_type, values == ["null"], len(values))}
    # A null fits all types.
    with_null = inferred(spark, *[f'{{"k": {v}}}' for v in [*values, "null"]])
    assert with_null == {"k": (data_type, True, len(values) + 1)}


def test_texts_that_tell_nothing(spark):
    texts = ['{"a": 1, "b": 2}', '{"a": 1, "a": "x"}', "{}", "[1]", "7", "", '{"a":', None, '{"": 1, " ": 2}']
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    found = inference.infer_json_contract(df, "raw", "c", "C").collect()
    assert {(r.column, r.data_type, r.nullable, r.seen, r.objects, r.unread) for r in found} == {("a", "string", True, 2, 4, 4), ("b", "integer", True, 1, 4, 4)}
    assert inferred(spark) == {} and inferred(spark, "no") == {}


def test_texts_conform_to_what_was_inferred(spark):
    texts = [f'{{"id": {i}, "price": {i / 4}, "day": "2024-01-{i + 1:02d}", "ok": {str(i % 2 == 0).lower()}, "tags": ["a"]}}' for i in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    lines = inference.infer_json_contract(df, "raw", "c", "C").collect()
    contract = Contract("c", "C", tuple(Column(r.column, r.data_type, r.nullable) for r in lines))
    read = enforce.parse_records(df, "raw", contract)
    assert read.where("_corrupt IS NOT NULL").count() == 0
    assert enforce.violation_counts(read.drop("_corrupt"), contract).where("bad > 0").count() == 0


def test_tables_without_rows_need_no_job(spark, tmp_path):
    """They are made and retyped by catalog alone, and the catalog is told without a job for each."""
    first = Contract("bare", "B", (Column("a", "integer"), Column("b", "string")), version="1.0.0")
    second = Contract("bare", "B", (Column("a", "string"), Column("c", "number")), version="2.0.0")
    spark.sparkContext.setJobGroup("bare-tables", "no rows")
    try:
        tables.create_contract_table(spark, first, str(tmp_path), "bare_db")
        tables.evolve_table(spark, second, str(tmp_path), "bare_db")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("bare-tables")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(tuple, tables.existing_columns(spark, "bare_db").collect())) == [
        ("bare", "a", "string", "bare", "2.0.0"), ("bare", "c", "double", "bare", "2.0.0")
    ]
    assert spark.table("bare_db.bare").collect() == []
    spark.createDataFrame([("x", 1.5)], "a string, c double").write.insertInto("bare_db.bare")
    assert list(map(tuple, spark.table("bare_db.bare").collect())) == [("x", 1.5)]
    spark.sql("DROP DATABASE bare_db CASCADE")


def test_a_file_each_without_the_driver(spark, tmp_path):
    """Every row is a file, rows that repeat as well, with nothing beside them; they are read by few tasks."""
    texts = [f'{{"é": {n % 150}}}' for n in range(200)]
    rows = spark.createDataFrame([(None if n == 7 else n % 3, text) for n, text in enumerate(texts)], "domain int, raw string")
    contracts.write_contracts(rows, str(tmp_path / "in/all"))
    names = [name for _, _, found in os.walk(tmp_path / "in") for name in found]
    assert len(names) == 200 and all(name.endswith(".txt") and not name.startswith(".") for name in names)
    read = contracts.read_contracts(spark, str(tmp_path / "in"), "*.txt")
    assert sorted(r.raw for r in read.collect()) == sorted(f"{text}\n" for text in texts)
    assert {r.domain for r in read.collect()} == {f"domain={n}" for n in (0, 1, 2, contracts.NO_VALUE)}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(df.rdd.getNumPartitions() for df in (read, contracts.list_files(spark, str(tmp_path / "in"), "*.txt"))) <= tasks


def test_compressed_files_are_read_as_texts(spark, tmp_path):
    with gzip.open(put(tmp_path / "in", "all/u/a.json.gz", ""), "wt") as file:
        file.write("{}")
    assert [r.raw for r in contracts.read_contracts(spark, str(tmp_path / "in"), "*.json.gz").collect()] == ["{}"]


def test_files_on_disk_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """The driver holds no line per file: what is planned over names parts of the listing, not the files."""
    for n in range(60):
        put(tmp_path / "in", f"all/u/{n % 20:02d}/{n}.json", {"n": n})
    none = contracts.read_manifest(spark, str(tmp_path / "none"))
    read, listed = contracts.read_contracts(spark, str(tmp_path / "in")), contracts.list_files(spark, str(tmp_path / "in"))
    monkeypatch.setattr(contracts, "NAMED_FILES", 0)
    changed = contracts.changed_contracts(spark, str(tmp_path / "in"), none).documents
    for df in (read, listed, changed):
        assert df.count() == 60 and not any(name.endswith(".json") for name in df.inputFiles())


@pytest.mark.parametrize("glob", ["*.json", "[!a]*.json", "{a,d,_}*", "d?1*", "?.json"])
def test_files_on_disk_are_those_spark_finds(spark, tmp_path, glob):
    """Names, spelling, lengths and times are those of Spark's readers, whatever the names."""
    odd = ["a b", "b", "d[1]", "p%41", "ü é", "x#y?z", "q'\"<>^`{|}~", "n b c\u0085", "semi;com,ma=&+$@!*()", "back\\slash", "_m=1", "_m", "_metadata", "tab\tnew\nline", "emoji😀"]
    places = [*odd, "_k=1/s p/f", "_metadata_x/f", "_common_metadata/f", "_hidden/f", ".hidden/f", "c._COPYING_/f", "deep/er/still/f"]
    for place in places:
        put(tmp_path / "in", f"{place}.json", place)
    for place in ("empty.json", "x.json._COPYING_", ".b.json"):
        put(tmp_path / "in", place, "" if place == "empty.json" else "x")
    os.symlink(tmp_path / "in/b.json", tmp_path / "in/link.json")
    os.symlink(tmp_path / "nowhere", tmp_path / "in/broken.json")
    os.symlink(tmp_path / "in/deep", tmp_path / "in/dlink")
    (tmp_path / "in/bytes.json").write_bytes(b"\xff\xfe no text")
    files = spark.read.format("binaryFile").load(str(tmp_path / "in"), recursiveFileLookup=True, pathGlobFilter=glob)
    expected = sorted(map(tuple, files.select("_metadata.file_path", "length", "modificationTime", "path").collect()))
    assert len(expected) >= 1
    assert sorted(map(tuple, contracts.list_files(spark, str(tmp_path / "in"), glob).collect())) == expected
    texts = sorted(map(tuple, files.selectExpr("_metadata.file_path", "hex(content)").collect()))
    assert sorted(map(tuple, contracts.read_contracts(spark, str(tmp_path / "in"), glob).selectExpr("file_path", "hex(raw)").collect())) == texts


def test_paths_that_are_no_folder(spark, tmp_path):
    """A file, a pattern and a folder without files are read as before."""
    put(tmp_path / "in", "a/x.json", "1")
    put(tmp_path / "in", "b/y.json", "2")
    (tmp_path / "bare").mkdir()
    for path, found in (("in/a/x.json", ["1"]), ("in/*", ["1", "2"]), ("in", ["1", "2"]), ("bare", []), ("no", [])):
        assert sorted(r.raw for r in contracts.read_contracts(spark, str(tmp_path / path)).collect()) == found
        assert contracts.list_files(spark, str(tmp_path / path)).count() == len(found)
    assert contracts.read_contracts(spark, f"file://{tmp_path}/in").count() == 2


def test_a_link_back_is_not_followed_without_end(spark, tmp_path):
    put(tmp_path / "in", "a/x.json", "1")
    os.symlink("self", tmp_path / "in/self")
    assert contracts.read_contracts(spark, str(tmp_path / "in")).count() == 1


def test_tables_by_calls_are_those_of_statements(spark, tmp_path, monkeypatch):
    """Many tables need few statements, and their entries say what a statement for each would have said."""
    first = [document(f"t-{n}", "x string, n integer, at timestamp, l array", description="It's \"a\" \\ text") for n in range(40)]
    second = [document(f"t-{n}", "x string, n number, m integer, o object", version="2.0.0") for n in range(40)]

    def entries(database):
        statements, sql = [], type(spark).sql
        none = spark.createDataFrame([], tables.EXISTING_SCHEMA)
        first_run, told = provision(table_of(spark, first), None, none, "1"), []
        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", lambda self, text, *a, **b: statements.append(text) or sql(self, text, *a, **b))
            apply_tables(first_run, str(tmp_path), database)
            assert spark.table(f"{database}.t_3").collect() == []
            spark.createDataFrame([("a", 7)], "x string, n bigint").selectExpr("x", "n", "NULL AS at", "NULL AS l").write.insertInto(f"{database}.t_3")
            assert spark.table(f"{database}.t_3").select("x", "n").first() == ("a", 7)
            held = tables.existing_columns(spark, database)
            told += sorted(map(tuple, held.collect()))
        later = provision(table_of(spark, second), None, held, "2")
        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", lambda self, text, *a, **b: statements.append(text) or sql(self, text, *a, **b))
            assert {r.table_status for r in apply_tables(later, str(tmp_path), database).tables.collect()} == {"updated"}
            told += sorted(map(tuple, tables.existing_columns(spark, database).collect()))
        assert [tuple(r) for r in spark.table(f"{database}.t_3").select("x", "n", "m").collect()] == [("a", 7.0, None)]
        assert spark.table(f"{database}.t_4").columns == ["x", "n", "m", "o"]
        for n in range(40):
            lines = {r.col_name: (r.data_type, r.comment) for r in sql(spark, f"DESCRIBE TABLE EXTENDED {database}.t_{n}").collect()}
            for name in ("Database", "Created Time", "Table Properties", "Location"):
                lines.pop(name)
            kept = {k: v for k, v in tables.table_properties(spark, f"{database}.t_{n}").items() if k != "created_at" and not k.startswith("transient")}
            told.append((lines, kept))
        sql(spark, f"DROP DATABASE {database} CASCADE")
        return told, len(statements)

    by_calls, few = entries("calls_db")
    monkeypatch.setattr(tables, "Calls", tables.Statements)
    by_statements, many = entries("statements_db")
    assert by_calls == by_statements
    # Workers that begin at the same time may each make a statement.
    assert few <= 12 * tables.WORKERS < many


def test_names_a_statement_would_refuse(spark, tmp_path):
    """Tables of odd names, and columns that differ in case alone, fail as they did; the others are made."""
    docs = [document(*d) for d in (("a", "x string"), ("b", "x string"), ("c.d", "x string"), ("e f", "x string"), ("g", "x string, X string"), ("7h", "x string"), ("i", "odd-name string"))]
    done = apply_tables(provision(table_of(spark, docs), None, spark.createDataFrame([], tables.EXISTING_SCHEMA), "1"), str(tmp_path), "odd_db")
    found = {r.contract_id: r.table_status for r in done.tables.collect()}
    assert found == {"a": "created", "b": "created", "c.d": "failed", "e f": "failed", "g": "failed", "7h": "created", "i": "created"}
    spark.sql("DROP DATABASE odd_db CASCADE")


def test_a_batch_of_many_files_takes_few_tasks(spark, tmp_path):
    """Files that are named to a reader are not looked for by a task each, and are read by few tasks."""
    for n in range(60):
        put(tmp_path / "in", f"all/u/{n:02d}/u.json", document("u" if n % 2 else f"v-{n}", f"a string, b{n} integer", version=f"{n}.0.0"))
    put(tmp_path / "in", "all/u/60/empty.json", "")
    query = contract_stream.stream_contracts(spark, str(tmp_path / "in"), str(tmp_path / "registry"), str(tmp_path / "checkpoint"), "DISABLED")
    query.awaitTermination()
    known = registry.read_registry(spark, str(tmp_path / "registry"))
    assert (known.count(), known.where("contract_id = 'u'").count(), known.agg({"seq": "max"}).first()[0]) == (60, 30, 59)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(job).stageIds}
    tasks = [info.numTasks for info in map(tracker.getStageInfo, stages) if info]
    assert tasks and max(tasks) <= 32
