"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__
from check_queries import compare

SF = "/root/testdata/sf0.001"
QUERIES = __spark_entry__.queries()


# These fit a boosted model for each label, or a search; the other model queries run by default.
SLOW = {"train_boosted", "score_boosted_sound", "train_end_to_end"}


def _param(name):
    slow = name in SLOW
    return pytest.param(name, marks=pytest.mark.slow if slow else ())


@pytest.mark.parametrize("name", [_param(name) for name in QUERIES])
def test_query(spark, name):
    assert compare(spark, SF, QUERIES[name], __spark_entry__.oracle_sql().get(name)) == ""


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() % 144 == 0
    assert set(__spark_entry__.oracle_sql()) <= set(QUERIES)
