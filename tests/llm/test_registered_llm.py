"""Every corpus query: against its SQL, or that it gives a row per row of its table."""

import pytest

import check
from tallywork.llm import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, con, name):
    df = registry.queries()[name](spark, FOLDER)
    assert check.compare(df, con, registry.oracle_sql()[name]).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql()) - {"pipeline"}))
def test_a_row_for_each_document(spark, con, name):
    got = sorted(r["doc_id"] for r in registry.queries()[name](spark, FOLDER).select("doc_id").distinct().collect())
    assert got == [r[0] for r in con.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]


def test_one_query_for_each_operator():
    names = [n for n in registry.queries() if n != "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_native_operators_run_no_python(spark):
    for name in ("op2_exact_dedup", "op8_chat_format"):
        plan = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
