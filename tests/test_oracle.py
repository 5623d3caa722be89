"""Every registered query that has a DuckDB form gives its rows."""

import functools

import pytest

import __spark_entry__ as entry
from quipu.operators import signals
from quipu.plans import more, registry
from quipu.scratch import materialize
from tests.helpers import DATA, duck, sparked

SF = "sf0.001"


@pytest.fixture(scope="module", autouse=True)
def made_once():
    """The facts, the cases and the united signals that many queries share are made once for all of them."""
    with pytest.MonkeyPatch.context() as patch:
        facts = functools.cache(registry.full_facts)
        patch.setattr(registry, "full_facts", facts)
        patch.setattr(more, "full_facts", facts)
        patch.setattr(more, "_cases", functools.cache(more._cases))
        united = signals.all_signals
        patch.setattr(signals, "all_signals", functools.cache(lambda *a: materialize(united(*a), "signals")))
        patch.setattr(registry, "_ranked", functools.cache(registry._ranked))
        yield


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert sparked(registry.QUERIES[name](spark, f"{DATA}/{SF}")) == duck(SF, registry.ORACLE_SQL[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql_or_a_test():
    assert set(registry.QUERIES) - set(registry.ORACLE_SQL) == {"bm25_search", "name_match_fuzzy"}
