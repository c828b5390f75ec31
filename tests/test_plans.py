"""What plans read: one scan where several results come from the same rows."""

import os
import re

import pytest

from tradeloom.operators import facts, validate
from tradeloom.operators.rules import SPECS
from tradeloom.plans import marts
from tradeloom.queries import QUERIES, Sample

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="sample tables not present")


def scans(df, table):
    """Reads of a sample table in the physical plan, before any exchange is found to be equal to another."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return len(re.findall(rf"FileScan parquet .*?/{table}\.parquet", plan))


@pytest.mark.parametrize("name", ["measures_bundle", "margins", "slicer_values"])
def test_marts_of_a_bundle_read_the_lines_once(spark, name):
    assert scans(QUERIES[name](spark, DIRECTORY), "lineitem") == 1


@pytest.mark.parametrize("name", ["top_customers", "top_stores", "top_products"])
def test_top_n_reads_written_groups(spark, name):
    assert scans(QUERIES[name](spark, DIRECTORY), "lineitem") == 0


def test_all_marts_equal_each_mart(spark):
    sample = Sample(spark, DIRECTORY)
    names = tuple(marts.SALES_MARTS)
    together = sample.marts(*names).cache()
    lines = facts.sales_lines(sample.clean, sample.star, with_payment=False)
    for name in names:
        alone = marts.sales_mart(name, lines, sample.star)
        got = marts.one_of(together, name).select(alone.columns)
        assert dict(got.dtypes) == dict(alone.dtypes)
        assert sorted(map(str, got.collect())) == sorted(map(str, alone.collect())), name
    together.unpersist()


def test_quality_rows_read_a_table_once_for_rules_and_overall(spark):
    sample = Sample(spark, DIRECTORY)
    tagged = sample.tagged("stores")
    one = scans(tagged, "supplier")
    assert scans(validate.dq_rows({"stores": tagged}), "supplier") == one
    assert scans(validate.rule_counts(SPECS["stores"], tagged), "supplier") == one
