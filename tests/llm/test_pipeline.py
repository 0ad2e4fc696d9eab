import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline as c
from rollcall.llm import decontaminate, secrets
from rollcall.llm.oracle import ORACLE
from rollcall.llm.queries import QUERIES
from tests.llm.helpers import SMALL, clashing, documents, views
from tests.llm.test_packing import check_places


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    found = QUERIES[name](spark, SMALL)
    result = views(duckdb.connect()).execute(ORACLE[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == sorted(found.columns)
    wanted = sorted((tuple(map(plain, r)) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(r[n]) for n in names) for r in found.collect()), key=repr) == wanted


def test_every_operator_is_registered():
    names = contract.queries()
    for number in range(1, 11):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
    assert names["pipeline"] is c.run and len(c.STAGES) == 5


def test_stages(spark):
    secret = documents(spark, [(10**9, "one plain line of words and password=hunter2secret in it")])
    docs = clashing(spark.read.parquet(SMALL + "/documents.parquet").unionByName(secret), "node", "score", "text_key")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = spark.read.parquet(SMALL + "/benchmark.parquet")
    columns, kept = docs.columns, before
    for name, stage in c.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert rows.keys() <= kept.keys() and len(rows) > 0.5 * len(kept)
        if name == "secret scan":
            assert rows.keys() == kept.keys()
            assert rows == {k: secrets.redacted(v) for k, v in kept.items()}
            assert any(rows[k] != kept[k] for k in rows)
        else:
            assert all(rows[k] == kept[k] for k in rows)
        kept = rows
    assert decontaminate.contaminated(docs, items).count() == 0
    packed = c.STAGES[-1][1](spark, docs, SMALL).collect()
    check_places(packed, 2048)
    assert {r["doc_id"] for r in packed} == kept.keys()
    packed = [r for r in packed if r["doc_id"] != 10**9]
    whole = c.run(spark, SMALL).collect()
    assert sorted(map(str, [(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in whole])) == sorted(
        map(str, [(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed])
    )


def test_empty_documents_go_through(spark):
    docs = spark.read.parquet(SMALL + "/documents.parquet").limit(0)
    for _, stage in c.STAGES:
        docs = stage(spark, docs, SMALL) if "piece" not in docs.columns else docs
    assert docs.count() == 0
