import corpus_pipeline
import duckdb
import pytest

from clickloom.llm import queries
from clickloom.llm.common import table
from tests.llm.conftest import ODD_TEXTS
from tests.llm.test_ngram_join import components_by_hand

TABLES = "documents pages benchmark labels conversations".split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean"}
NATIVE = ("op2_hash_tree", "op3_temporal_lists", "op5_imatch", "op11_digest_merge")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, small, name):
    connection = duckdb.connect()
    for one in TABLES:
        connection.sql(f"CREATE VIEW {one} AS SELECT * FROM read_parquet('{small}/{one}.parquet')")
    found = queries.QUERIES[name](spark, small)
    wanted = connection.sql(queries.ORACLE_SQL[name])
    kinds = {c: KINDS[str(k)] for c, k in zip(wanted.columns, wanted.types, strict=True)}
    assert kinds == {f.name: f.dataType.simpleString() for f in found.schema}
    names = sorted(kinds)
    order = lambda rows: sorted(map(repr, rows))
    assert order(tuple(r) for r in found.select(*names).collect()) == order(
        wanted.select(", ".join(names)).fetchall()
    )


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, small, name):
    plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert unwanted not in plan


@pytest.mark.parametrize("number", range(1, 14))
def test_one_query_for_each_operator(number):
    assert sum(name.startswith(f"op{number}_") for name in queries.QUERIES) == 1


def test_pipeline_stage_by_stage(spark, small):
    docs = table(spark, small, "documents")
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    labels = {row["doc_id"]: row["quality"] for row in table(spark, small, "labels").collect()}
    seen = [docs]
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen[-1], small)
        if at < 3:
            assert out.columns == docs.columns, name
        seen.append(out)
    ids = [{row["doc_id"] for row in frame.select("doc_id").collect()} for frame in seen]
    judged = {row["doc_id"]: row["kept"] for row in queries.op4_suffix_repetition(spark, small).collect()}
    assert ids[1] == {i for i in ids[0] if judged[i]}
    assert ids[2] <= ids[1]
    assert all(labels.get(i) != 1 for i in ids[1] - ids[2])
    by_hand = components_by_hand([(i, texts[i]) for i in ids[2]])
    assert ids[3] == {i for i, (_, least) in by_hand.items() if i == least}
    assert ids[4] == ids[3]


def test_stages_stand_odd_and_no_rows(spark, small, docs, clashing):
    rows = clashing(docs(*ODD_TEXTS, (None, "no id " * 3), (4, ODD_TEXTS[4]), *[(50 + n, CLEAN) for n in range(3)]))
    for frame in (rows, rows.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, small)
            assert out.count() >= 0, name
    kept = corpus_pipeline.STAGES[2][1](spark, rows, small).collect()
    assert [row["doc_id"] for row in kept if row["text"] == CLEAN] == [50]


CLEAN = " ".join(f"word{n}" for n in range(90))
