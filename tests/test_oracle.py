"""Every registered query at the smallest scale against its SQL."""

import pytest

import __spark_entry__ as contract
from gridloom.operators import ordered
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    if name not in ORACLES:
        assert df.count() > 0
        return
    assert compare(df, con, ORACLES[name]) == ""


SPLIT = ["q_forward_fill", "q_occurrence", "q_four_row_block", "q_state_gate", "q_section_span", "q_hierarchy",
         "q_wide_summary", "q_question_report", "q_screen_report", "q_section_report"]


@pytest.mark.parametrize("name", SPLIT)
def test_query_with_keys_beyond_a_task(spark, con, name, monkeypatch):
    """The same results when most keys count as too large for one task."""
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 3)
    assert compare(contract.queries()[name](spark, FOLDER), con, ORACLES[name]) == ""
