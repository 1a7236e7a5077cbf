"""Every registered query against its SQL, and the plans of the wide ones."""

import functools

import pytest

import __spark_entry__ as entry
from oracle import connect, difference
from textprep.plans import oracles, queries

SF = "/root/testdata/sf0.001"


@functools.cache
def database():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query_equals_sql(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert difference(got, database().execute(entry.oracle_sql()[name]).df()) is None


def test_registries_fit():
    assert set(queries.REGISTRY) - set(oracles.SQL) == {"logreg_scores"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 2


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["label_share_clean", "dedup_keep_first", "drop_train_overlap", "binary_metrics", "tfidf_weights"])
def test_no_nested_loops(spark, name):
    text = plan(queries.REGISTRY[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


def test_metrics_read_only_their_columns(spark):
    text = plan(queries.binary_metrics(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string>" in text


def test_groups_shuffle_keys_not_texts(spark):
    text = plan(queries.dedup_stats(spark, SF))
    assert "SortAggregate" not in text
    assert text.count("Exchange hashpartitioning(text_key") == 1
