"""Every registered query against its oracle."""

import subprocess
import sys

import pytest

import __spark_entry__ as contract
from check_queries import compare
from places import SMALL
from tablesync.queries import ORACLES, QUERIES
from tablesync.queries.registry import query


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_oracle(spark, name):
    good, detail = compare(spark, SMALL, name)
    assert good, detail


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert contract.entry(spark).count() == 1500


def test_a_taken_name_is_refused():
    with pytest.raises(ValueError):
        query("full_scan", "select 1")(lambda spark, sf_dir: None)


@pytest.mark.parametrize("absent", ["xxhash", "tablesync.llm", "corpus_pipeline"])
def test_entry_survives_what_is_absent(absent):
    code = (f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; "
            f"from tablesync.queries import QUERIES; assert QUERIES.keys() <= e.queries().keys()")
    subprocess.run([sys.executable, "-c", code], check=True)
