from __future__ import annotations

import random

import pytest
from conftest import PAYMENTS, PAYMENTS_2, USERS, USERS_2, USERS_3, document, table_of
from pyspark.sql import functions as F

from sparkpact.functions.ordered import Ordered
from sparkpact.operators import documents, registry, versions
from sparkpact.session import materialize

AVRO = {"string": "string", "integer": "int", "number": "double", "boolean": "boolean", "date": "string", "timestamp": "string", "object": "string", "array": "array"}


def history(spark, docs):
    return materialize(versions.history(documents.load_contracts(table_of(spark, docs))), "history")


def candidates(spark, docs, **options):
    return materialize(registry.candidates(documents.load_contracts(table_of(spark, docs)), **options), "candidates")


def test_sample_diffs(spark):
    docs = [document("users", USERS), document("users", USERS_2), document("users", USERS_3), document("pay", PAYMENTS), document("pay", PAYMENTS_2)]
    rows = versions.history_diff(history(spark, docs)).where("kind <> 'same'").orderBy("seq", "column").collect()
    assert [(r.seq, r.column, r.kind) for r in rows] == [
        (1, "last_login_at", "added_optional"),
        (1, "zip_code", "added_optional"),
        (2, "is_active", "added_required"),
        (4, "card_last_four", "removed"),
        (4, "fraud_score", "added_optional"),
        (4, "merchant_category_code", "added_optional"),
    ]
    forward = versions.compatibility(history(spark, docs), "FORWARD").orderBy("seq").collect()
    backward = versions.compatibility(history(spark, docs), "BACKWARD").orderBy("seq").collect()
    assert [r.compatible for r in forward] == [True, True, True, True, False]
    assert [r.compatible for r in backward] == [True, True, False, True, True]


def test_two_tables(spark):
    schema = "contract_id string, name string, data_type string, nullable boolean"
    old = spark.createDataFrame([("c", "a", "date", False), ("c", "b", "integer", True), ("c", "x", "string", True)], schema)
    new = spark.createDataFrame(
        [("c", "a", "string", True, False), ("c", "b", "number", True, False), ("c", "d", "string", False, True), ("c", "e", "string", False, False)],
        schema + ", has_default boolean",
    )
    kinds = {r["column"]: r.kind for r in versions.diff_versions(old, new).collect()}
    assert kinds == {"a": "type_modified", "b": "type_modified", "x": "removed", "d": "added_defaulted", "e": "added_required"}
    avro_level = {r["column"]: r.kind for r in versions.diff_versions(old, new, level="avro").collect()}
    assert avro_level["a"] == "nullable_changed"
    summary = versions.diff_summary(versions.diff_versions(old, new)).first()
    assert summary.changes == [
        "Added column: d (string)",
        "Added column: e (string)",
        "Modified column type: a (date → string)",
        "Modified column type: b (integer → number)",
    ]
    assert summary.warnings == summary.changes[2:] + ["Removed column: x (data will be lost)"]


def test_what_makes_a_version(spark):
    base = document("c", "id string!")
    docs = [base, {**base, "version": "9.9.9"}, {**base, "description": "Other"}, {**base, "description": "Other", "metadata": {"data_owner": "New"}}]
    rows = versions.version_history(history(spark, docs)).orderBy("seq").collect()
    assert [(r.changed, r.registry_version, r.prev_version) for r in rows] == [(True, 1, None), (False, 1, "1.0.0"), (True, 2, "9.9.9"), (True, 3, "1.0.0")]


def test_conflicts(spark):
    docs = [document("a-b", "id string!"), document("a-b", "id boolean!"), document("A_b", "id string!"), document("c", "id string!", "2.0.0")]
    rows = versions.conflicts(history(spark, docs), "file_path").collect()
    assert {(r.kind, r.key, r.version, r.distinct_items) for r in rows} == {
        ("version_redefined", "a-b", "1.0.0", 2),
        ("table_name_collision", "a_b", None, 2),
        ("id_in_several_files", "a-b", None, 2),
    }


# -- against brute force, with one contract that holds most of the rows ----------------


def random_docs(n: int, seed: int) -> list[dict]:
    rng = random.Random(seed)
    docs = []
    for _ in range(n):
        names = rng.sample("abcdef", rng.randint(1, 4))
        spec = ", ".join(f"{x} {rng.choice(['string', 'integer', 'number', 'date', 'array'])}{rng.choice(['', '', '!'])}" for x in names)
        docs.append(document("hot" if rng.random() < 0.6 else rng.choice(["p", "q", "r"]), spec, f"{rng.randint(1, 2)}.0"))
    return docs


def fields(doc):
    return {c["name"]: (AVRO[c["data_type"]], c["nullable"]) for c in doc["columns"]}


def offences(reader, writer):
    out = set()
    for name, (avro, nullable) in fields(reader).items():
        if name not in fields(writer):
            if not nullable:
                out.add((name, "no_default"))
            continue
        w_avro, w_nullable = fields(writer)[name]
        if not ((w_avro == avro or (w_avro, avro) == ("int", "double")) and (nullable or not w_nullable)):
            out.add((name, "type"))
    return out


def expected_offences(docs, mode):
    result = []
    for i, doc in enumerate(docs):
        earlier = [d for d in docs[:i] if d["contract_id"] == doc["contract_id"]]
        found = set()
        for old in earlier if mode == "FORWARD_ALL" else earlier[-1:]:
            if mode != "BACKWARD":
                found |= offences(old, doc)
            if mode in ("BACKWARD", "BOTH"):
                found |= offences(doc, old)
        result.append(sorted(found) if mode != "DISABLED" else [])
    return result


@pytest.mark.parametrize("mode", versions.MODES)
def test_compatibility_against_brute_force(spark, mode):
    docs = random_docs(60, 1)
    rows = versions.compatibility(history(spark, docs), mode, hot_rows=8).orderBy("seq").collect()
    assert [[(o["column"], o.reason) for o in r.offending] for r in rows] == expected_offences(docs, mode)


def expected_actions(docs, mode):
    state, out = {}, []
    for doc in docs:
        accepted = state.setdefault(doc["contract_id"], [])
        same = {k: v for k, v in doc.items() if k != "version"}
        if not accepted:
            action = "create"
        elif {k: v for k, v in accepted[-1].items() if k != "version"} == same:
            action = "unchanged"
        else:
            against = accepted if mode == "FORWARD_ALL" else accepted[-1:]
            bad = set()
            for old in against:
                if mode in ("FORWARD", "FORWARD_ALL", "BOTH"):
                    bad |= offences(old, doc)
                if mode in ("BACKWARD", "BOTH"):
                    bad |= offences(doc, old)
            action = "rejected" if bad else "new_version"
        if action in ("create", "new_version"):
            accepted.append(doc)
        out.append((action, len(accepted)))
    return out


@pytest.mark.parametrize("mode", versions.MODES)
def test_history_fold_against_brute_force(spark, mode):
    docs = random_docs(60, 2)
    rows = candidates(spark, docs)
    # Chunks smaller than a contract's history: several rounds, each from the last one's state.
    plan = registry.plan_history(rows, mode, chunk=10, hot_rows=8).orderBy("seq").collect()
    assert [(r.action, r.registry_version) for r in plan] == expected_actions(docs, mode)


@pytest.mark.parametrize("mode", ["FORWARD_ALL", "BOTH"])
def test_fold_from_a_registry(spark, mode, tmp_path):
    docs = random_docs(50, 3)
    path = str(tmp_path / "registry")
    rows = candidates(spark, docs, mode=mode)
    got = []
    for load_id, part in (("a", rows.where("seq < 30")), ("b", rows.where("seq >= 30"))):
        before = registry.read_registry(spark, path, before_load=load_id)
        plan = registry.plan_history(part, mode, before)
        got += [(r.action, r.registry_version) for r in plan.orderBy("seq").collect()]
        registry.apply_registration(plan, path, load_id)
    assert got == expected_actions(docs, mode)


@pytest.mark.parametrize("mode", ["FORWARD_ALL", "BACKWARD", "FORWARD", "BOTH", "DISABLED"])
def test_one_candidate_each(spark, mode, tmp_path):
    docs = random_docs(40, 4)
    rows = candidates(spark, docs, mode=mode)
    path = str(tmp_path / "registry")
    registry.apply_registration(registry.plan_history(rows, mode), path, "a")
    before = registry.read_registry(spark, path)
    new = [document(c, "a string, b number, z string!") for c in ("hot", "p", "q", "new")] + [docs[0]]
    one_each = registry.newest_candidates(documents.load_contracts(table_of(spark, [d for d in new if d["contract_id"] != docs[0]["contract_id"]] + [docs[0]])), mode=mode)
    plan = {r.contract_id: (r.action, r.registry_version) for r in registry.plan_registration(before, one_each, mode).collect()}
    extra = [d for d in new if d["contract_id"] != docs[0]["contract_id"]] + [docs[0]]
    wanted = dict(zip([d["contract_id"] for d in extra], expected_actions(docs + extra, mode)[len(docs):]))
    assert plan == wanted


def test_loading_twice_changes_nothing(spark, tmp_path):
    docs = [document("users", USERS), document("users", USERS_2), document("pay", PAYMENTS), document("pay", PAYMENTS_2)]
    rows = candidates(spark, docs)
    path = str(tmp_path / "registry")
    states = []
    for load_id in ("one", "one", "two"):
        before = registry.read_registry(spark, path, before_load=load_id)
        one_each = registry.newest_candidates(documents.load_contracts(table_of(spark, docs)))
        plan = registry.plan_history(rows, registry=before) if load_id == "one" else registry.plan_registration(before, one_each)
        registry.apply_registration(plan, path, load_id)
        kept = registry.read_registry(spark, path).select("contract_id", "registry_version", "version", "load_id")
        states.append(sorted(tuple(r) for r in kept.collect()))
    assert states[0] == states[1] == states[2]
    assert [s[:2] for s in states[0]] == [("pay", 1), ("users", 1), ("users", 2)]
    kept = registry.read_registry(spark, path)
    entry = registry.get_schema(kept, "users").first()
    assert (entry.latest_version, entry.next_version, entry.metadata.data_owner) == (2, 3, "Some Team")
    assert registry.get_schema(kept, "nobody").count() == 0
    assert {tuple(r) for r in registry.list_schemas(kept).collect()} == {("users", 2), ("pay", 1)}
    assert registry.read_registry(spark, str(tmp_path / "none")).count() == 0


def test_ordered_with_hot_keys(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        ((F.col("id") * 7919) % 4001).alias("pos"),
        (F.col("id") % 5).alias("v"),
    )
    result = []
    for limit in (10**9, 100):
        ordered = Ordered(df, ["key"], "pos", hot_rows=limit)
        assert ordered.is_cut == (limit == 100)
        rows = ordered.previous({"before": F.col("v")}).running_sum(F.col("v"), "total").rows()
        result.append(sorted(tuple(r) for r in rows.collect() if r.before is not None))
    assert result[0] == result[1] and len(result[0]) == 4000 - len({"hot"} | {f"k{i}" for i in range(50)})


def test_blocks_of_a_hot_key_are_even(spark):
    df = spark.range(3000).select(F.lit("hot").alias("key"), (F.col("id") * F.col("id")).alias("pos"))
    ordered = Ordered(df, ["key"], "pos", hot_rows=300)
    sizes = [r["count"] for r in ordered.blocked.groupBy("_block").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 300


@pytest.mark.parametrize("mode", versions.MODES)
def test_equal_seq_is_ordered_by_path(spark, mode):
    """Versions that share a seq are held against each other in the order of their paths."""
    docs = random_docs(60, 7)
    rows = table_of(spark, docs).withColumn("seq", F.col("seq") - F.col("seq") % 10)
    history_ = versions.history(documents.load_contracts(rows))
    found = versions.compatibility(history_, mode, hot_rows=8).orderBy("seq", "file_path").collect()
    assert [[(o["column"], o.reason) for o in r.offending] for r in found] == expected_offences(docs, mode)


def test_filters_reach_the_scan(spark, tmp_path):
    """A filter on a column that passes through the parse is pushed into the read of the archive."""
    table_of(spark, random_docs(10, 1)).write.parquet(str(tmp_path / "docs"))
    loaded = documents.load_contracts(spark.read.parquet(str(tmp_path / "docs")))
    plan = loaded.where("seq = 5")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(seq,5)" in plan and "seq#" in plan.split("DataFilters")[1][:80]


def test_replaying_an_earlier_load_changes_nothing(spark, tmp_path):
    docs = random_docs(40, 9)
    path = str(tmp_path / "registry")
    rows = candidates(spark, docs)
    states = []
    for load_id, part in (("a", rows.where("seq < 20")), ("b", rows.where("seq >= 20")), ("a", rows.where("seq < 20"))):
        registry.apply_registration(registry.plan_history(part, "FORWARD_ALL", registry.read_registry(spark, path, before_load=load_id)), path, load_id)
        states.append(sorted((r.contract_id, r.registry_version, r.seq, r.load_id) for r in registry.read_registry(spark, path).collect()))
    assert states[1] == states[2]
    registry.compact_registry(spark, path, path + "-one", "c")
    assert sorted((r.contract_id, r.registry_version, r.seq) for r in registry.read_registry(spark, path + "-one").collect()) == [s[:3] for s in states[1]]


COLUMN = "struct<name:string,data_type:string,nullable:boolean,description:string>"


def long_history(spark, n):
    """One contract of ``n`` versions (and a short one), whose definitions come from a few sets of columns and one that grows."""
    column = "named_struct('name', {0}, 'data_type', {1}, 'nullable', {2}, 'description', '')".format
    columns = f"""array({column("'id'", "if(id % 7 = 3, 'integer', 'string')", "false")}, {column("'amount'", "if(id % 5 < 2, 'integer', 'number')", "id % 3 = 0")},
                        {column("concat('c', id div 20000)", "'string'", "true")}, {column("if(id % 11 = 0, 'extra', 'other')", "'string'", "id % 1009 > 0")})"""
    return spark.range(n).select(
        F.when(F.col("id") % 4000 == 17, "short").otherwise("hot").alias("contract_id"), F.col("id").alias("seq"), F.lit("f").alias("file_path"),
        F.expr(columns).cast(f"array<{COLUMN}>").alias("columns"),
    ).withColumn("definition_hash", F.sha2(F.to_json("columns"), 256)).withColumn("avro_schema", F.lit("text"))


def folded(rows, mode):
    """The fold, one version after the other."""
    def reads(writer, reader):
        w, r = AVRO[writer.data_type], AVRO[reader.data_type]
        return (w == r or (w, r) == ("int", "double")) and (reader.nullable or not writer.nullable)

    def fits(writer, reader):
        by_name = {c.name: c for c in writer}
        return all(reads(by_name[c.name], c) if c.name in by_name else c.nullable for c in reader)

    out, state = {}, {}
    for r in rows:
        accepted, last, number, known = state.get(r.contract_id, ([], None, 0, {}))
        if last is None:
            action = "create"
        elif last.definition_hash == r.definition_hash:
            action = "unchanged"
        else:
            key = r.definition_hash
            against = accepted if mode == "FORWARD_ALL" else [last]
            ok = all(
                (mode == "BACKWARD" or fits(r.columns, a.columns)) and (mode not in ("BACKWARD", "BOTH") or fits(a.columns, r.columns)) for a in against
            ) if mode != "FORWARD_ALL" or (key, len(accepted)) not in known else known[key, len(accepted)]
            if mode == "FORWARD_ALL":
                known[key, len(accepted)] = ok
            action = "new_version" if ok else "rejected"
        if action in ("create", "new_version"):
            last, number = r, number + 1
            if r.definition_hash not in {a.definition_hash for a in accepted}:
                accepted.append(r)
        state[r.contract_id] = (accepted, last, number, known)
        out[r.contract_id, r.seq] = (action, number)
    return out


@pytest.mark.parametrize("mode", ["FORWARD_ALL", "BACKWARD", "DISABLED"])
def test_long_history_takes_no_more_jobs(spark, mode):
    """100,000 versions of one contract: as many jobs as 3,000, and the decisions of a plain fold."""
    jobs = {}
    for n in (3_000, 100_000):
        rows = materialize(long_history(spark, n), "long")
        spark.sparkContext.setJobGroup(f"fold-{mode}-{n}", "fold")
        found = {(r.contract_id, r.seq): (r.action, r.registry_version) for r in registry.plan_history(rows, mode).select("contract_id", "seq", "action", "registry_version").collect()}
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fold-{mode}-{n}"))
        spark.sparkContext.setJobGroup("", "")
        if mode != "DISABLED":
            assert found == folded(rows.orderBy("seq").collect(), mode)
    accepted = sum(a in ("create", "new_version") for a, _ in found.values())
    assert 2 < accepted and len(found) == 100_000
    # Adaptive execution may run a stage of a larger input as a job of its own.
    assert jobs[100_000] <= jobs[3_000] + 3


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("PartitionFilters: ")[1].split("]")[0] for line in plan.split("\n") if "PartitionFilters: [" in line]


def test_registry_is_read_by_bucket(spark, tmp_path):
    """One contract or a batch of a few skips the folders of all others; a load has one file for each of its buckets."""
    docs = [document(f"contract-{i}", USERS) for i in range(60)]
    path = str(tmp_path / "registry")
    for load_id in ("a", "b"):
        before = registry.read_registry(spark, path, before_load=load_id)
        registry.apply_registration(registry.plan_history(candidates(spark, docs if load_id == "a" else docs[:1]), "DISABLED", before), path, load_id)
    known = registry.read_registry(spark, path)
    for df in (registry.get_schema(known, "contract-7"), registry.of_contracts(known, candidates(spark, docs[:2]))):
        filters = partition_filters(df)
        assert any("bucket" in f and ("=" in f or "IN" in f) for f in filters), filters
    assert registry.get_schema(known, "contract-7").count() == 1
    assert {r.contract_id for r in registry.of_contracts(known, candidates(spark, docs[:2])).collect()} == {"contract-0", "contract-1"}
    for load in (tmp_path / "registry").glob("load_id=*"):
        assert all(len(list(bucket.glob("*.parquet"))) == 1 for bucket in load.glob("bucket=*"))


@pytest.mark.parametrize("mode", ["FORWARD_ALL", "BACKWARD"])
def test_landing_in_any_order(spark, mode, tmp_path):
    """After each batch the registry is what one load of all landed documents leaves; untouched contracts are not written."""
    from sparkpact.streaming import contracts as contract_stream

    docs = random_docs(60, 11)
    rows = table_of(spark, docs).withColumn("seq", F.col("seq") - F.col("seq") % 3).collect()
    # A document that lands again under its path counts as it came last.
    other = next(i for i in range(21, 60) if docs[i]["contract_id"] == docs[20]["contract_id"] and docs[i]["columns"] != docs[20]["columns"])
    again = rows[20].asDict() | {"raw": rows[other]["raw"]}
    order = [r.asDict() for r in rows]
    random.Random(3).shuffle(order)
    order = [r for r in order if r["file_path"] != rows[20]["file_path"]]
    batches = [[rows[20].asDict(), *order[:9]], order[9:30], [again], order[30:]]
    schema = "file_path string, seq bigint, raw string"
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    path, landed = str(tmp_path / "registry"), {}
    columns = ("contract_id", "registry_version", "seq", "file_path", "definition_hash")
    for n, batch in enumerate(batches):
        spark.createDataFrame([tuple(r[c] for c in ("file_path", "seq", "raw")) for r in batch], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        contract_stream.register_stream(stream(), path, str(tmp_path / "checkpoint"), mode).awaitTermination()
        landed |= {r["file_path"]: r for r in batch}
        everything = spark.createDataFrame([tuple(r[c] for c in ("file_path", "seq", "raw")) for r in landed.values()], schema)
        plan = registry.plan_history(materialize(registry.candidates(documents.load_contracts(everything), mode=mode), "all"), mode)
        wanted = sorted(tuple(r[c] for c in columns) for r in registry.accepted(plan).collect())
        known = registry.read_registry(spark, path)
        assert sorted(tuple(r[c] for c in columns) for r in known.collect()) == wanted
        touched = {r.contract_id for r in registry.candidates(documents.load_contracts(spark.createDataFrame([tuple(r[c] for c in ("file_path", "seq", "raw")) for r in batch], schema))).collect()}
        stored = spark.read.parquet(path).where(f"load_id = 'batch-{n:010d}'")
        assert {r.contract_id for r in stored.collect()} <= touched
    registry.compact_registry(spark, path, path + "-one", "z")
    assert sorted(tuple(r[c] for c in columns) for r in registry.read_registry(spark, path + "-one").collect()) == wanted
