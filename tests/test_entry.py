"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as E
from starloom.plans.catalog import ORACLE, QUERIES


def test_queries_and_oracle_cover_each_other():
    q, o = E.queries(), E.oracle_sql()
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(q)
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())


def test_only_optional_modules_may_be_missing(monkeypatch):
    import sys
    for name in [m for m in sys.modules if m.startswith(E.OPTIONAL)]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "starloom.llm", None)
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(ORACLE)


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["country_region", "brand", "year", "total_actual_sales"]
    assert df.count() > 0
