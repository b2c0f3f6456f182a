"""Every registered query against its DuckDB oracle, and the driver's entry point."""

import pytest

from conftest import SF_CHECK, SF_SMALL
from oracle_check import compare

import __spark_entry__ as E
from docflow.workload import ORACLE_SQL, QUERIES


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["o_orderstatus", "n_lines", "sum_qty", "sum_price"] and len(rows) == 3


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name])
    assert res[name][0] == "OK", res[name]


XML_QUERIES = sorted(k for k in QUERIES if k.startswith("xml_") and k != "xml_file_scan")


@pytest.mark.parametrize("name", XML_QUERIES)
def test_documents_are_parsed_once(spark, name):
    """No filter or join condition may re-evaluate the parse (Catalyst can push
    predicates through the parse projection, which would parse twice)."""
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    assert not [ln for ln in lines if "from_xml(" in ln and ("Filter" in ln or "Join" in ln)]
    # one per disjoint branch: single and split orders, and the pages that one query reads besides
    branches = 3 if name == "xml_malformed_permissive" else 2
    assert sum(ln.count("from_xml(") for ln in lines) <= branches


def test_file_scan_grows_with_its_table(spark):
    """The one-document-per-file scan has a query whose files and rows grow with the input."""
    small, large = (QUERIES["xml_binary_customer_files"](spark, d) for d in (SF_SMALL, SF_CHECK))
    assert len(large.inputFiles()) > len(small.inputFiles()) > 1
    assert compare(spark, SF_CHECK, ["xml_binary_customer_files"])["xml_binary_customer_files"] == ("OK", large.count(), large.count())
