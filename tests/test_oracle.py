"""Registered queries against SQL on the smallest tables.

A few by default, as the unit tests cover the operators; FORETELL_ALL=1 runs every query,
and ``python tests/oracle.py <folder>`` does so for other tables.
"""

import os

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = "/root/testdata/sf0.001"
LLM = {q for q in entry.queries() if q.startswith("op") and q[2].isdigit() or q == "pipeline"}  # with tests of their own
SOME = ["expand_links", "infer_nullability", "predict_linked", "relate_documents", "evaluate_documents", "stream_ingest"]


def test_every_query_has_sql_or_is_known_to_have_none(spark):  # two statements need a session
    assert set(entry.queries()) - set(entry.oracle_sql()) - LLM == set()
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", [q for q in entry.queries() if q not in LLM] if os.environ.get("FORETELL_ALL") else SOME)
def test_query(spark, name):
    con = oracle.connect(FOLDER)
    assert oracle.compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name)) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["field", "feature", "p", "rank"] and found.count() == 6
