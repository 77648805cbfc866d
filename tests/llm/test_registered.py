"""Every operator query has SQL, or a test against a plain version."""

import os
import re

import pytest

from conftest import ROOT, SF_SMALL, plan_of
from martlet.llm.queries import ORACLE, QUERIES

# Queries that SQL can't express, and the test that compares with a plain version.
TESTED = {
    "op1_minhash_near_dedup": "test_near_duplicates_against_brute_force",
    "op4_sentencepiece": "test_pieces_match_the_library_and_round_trip",
    "op7_substring_dedup": "brute",
    "op8_benchmark_decontamination": "test_decontamination_finds_edits_and_spares_others",
    "op9_quality_classifier": "test_quality_learns_and_scores_every_text",
    "op10_token_counts": "test_token_counts_share_prefixes",
}


def test_each_query_has_sql_or_a_named_test():
    folder = os.path.join(ROOT, "tests", "llm")
    text = "".join(open(os.path.join(folder, f)).read() for f in os.listdir(folder) if f.endswith(".py") and f != "test_registered.py")
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) == set(ORACLE) | set(TESTED) and not set(ORACLE) & set(TESTED)
    assert all(name in text for name in TESTED.values())


@pytest.mark.parametrize("name", ["op5_line_dedup", "op13_mixing"])
def test_native_operators_run_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL), "extended")
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
