"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import oracle
from checks.registry import registered
from tests.conftest import SF_DIR

QUERIES, ORACLE = registered(), oracle.statements()
TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert len([q for q in QUERIES if q.startswith("report_")]) == 38
    assert len([q for q in QUERIES if q.startswith("mart_")]) == 12


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(ORACLE[name])
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {c: TYPES[t] for c, t in ours.dtypes} == types
    theirs = duck.execute(ORACLE[name])
    names = [d[0] for d in theirs.description]
    expected = [dict(zip(names, r)) for r in theirs.fetchall()]
    order = sorted(names)
    assert sorted((tuple(r[c] for c in order) for r in ours.collect()), key=repr) == sorted(
        (tuple(r[c] for c in order) for r in expected), key=repr
    )


def test_entry(spark):
    assert entry(spark).count() == 3
