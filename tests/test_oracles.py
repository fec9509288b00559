"""Every registered query with an oracle agrees with DuckDB on sf0.001."""

import math

import pytest

import __spark_entry__ as E

ORACLES = E.oracle_sql()
HEAVY = ("m1", "m2", "job18", "job19")  # model fits: covered in test_ml


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    out = [tuple(norm(col[i]) for col in data) for i in range(table.num_rows)]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, duck, key):
    st = E.queries()[key](spark, sf_dir).toArrow()
    dt = duck.sql(ORACLES[key]).arrow()
    if hasattr(dt, "read_all"):
        dt = dt.read_all()
    assert st.num_rows == dt.num_rows
    assert rows(st) == rows(dt)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["code_insee", "localisation", "taux", "annee"]
    assert df.count() > 0


def test_every_query_has_unique_key():
    qs = E.queries()
    assert len(qs) >= 100
    assert set(ORACLES) <= set(qs)
