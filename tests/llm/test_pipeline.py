from __future__ import annotations

import brute
import pytest
from test_tokens import packed_right

import corpus_pipeline
from sparkpact.llm import language
from sparkpact.llm.queries import ORACLE, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_id(rows):
    return {r[0]: r for r in rows}


def survivors(rows, items):
    """What the middle three stages keep of rows that passed the first, by brute force."""
    kept = {g[0] for g in brute.exact_groups(rows) if g[3]}
    rows = [r for r in rows if r[0] in kept]
    kept = {g[0] for g in brute.near_groups(rows) if not g[1] or g[0] == g[2]}
    rows = [r for r in rows if r[0] in kept]
    clean = {c[0] for c in brute.contamination(rows, items) if not c[-1]}
    return [r for r in rows if r[0] in clean]


@pytest.fixture(scope="module")
def stages(spark):
    """The result of each stage on the small tables."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, out[-1], sf_dir)
        out.append(spark.createDataFrame(result.collect(), result.schema))
    return out


def test_stages(spark, stages):
    docs, identified, exact, near, clean, packed = stages
    assert all(s.columns == COLUMNS for s in stages[:-1])
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    model = language.fit(docs.where(~language.held_out(docs["doc_id"])))
    told = {r["doc_id"] for r in language.predict(docs, model).where("lang_pred <> 'und' and not ambiguous").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in told]
    assert {r["doc_id"] for r in identified.collect()} == told
    left = survivors(rows, items)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(r[0] for r in left)
    assert len(left) < exact.count() <= len(rows)
    packed_right(packed.collect(), left, 2048)


def test_corner_rows_go_through(spark, tmp_path):
    """Nulls, blanks, repeated rows and an empty table pass every stage."""
    items = spark.createDataFrame([(1, "no such passage in any of these texts")], "item_id bigint, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (brute.corner_rows(), []):
        docs = brute.frame(spark, rows, clashes=False)
        docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        result = corpus_pipeline.run(spark, str(tmp_path))
        assert result.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert (result.count() > 0) == bool(rows)


def test_every_operator_has_its_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    from compare import differences, oracle_connection

    assert differences(QUERIES[name](spark, sf_dir), oracle_connection(sf_dir), ORACLE[name]) is None
