"""Every registered query against its SQL, and the shape of the plans."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from bandlex.operators import index
from checks import oracle
from checks import queries as q

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def test_every_query_has_sql():
    assert set(q.queries()) == set(oracle.oracle_sql())
    assert set(q.queries()) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_against_sql(spark, sql, name):
    found = entry_points.queries()[name](spark, SF_DIR)
    expected = sql.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(found.columns)
    ours = sorted(map(repr, (tuple(r) for r in found.select(columns).collect())))
    assert ours and ours == sorted(map(repr, expected.fetchall()))


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert {r.band for r in rows} == {"LOW", "MID", "HIGH"}
    assert len({r.term for r in rows}) == len(rows)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark):
    plan = plan_of(q.q_document_frequency(spark, SF_DIR))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == {"doc_id:bigint,text:string"}


def test_the_text_is_scanned_and_shuffled_once(spark):
    plan = plan_of(q.q_distinctive_terms(spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet \[[^\]]*text", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(doc_id", plan)) == 1
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", ["document_frequency", "idf_by_band"])
def test_generated_methods_stay_within_reach_of_the_compiler(spark, name, capsys):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        getattr(q, "q_" + name)(spark, SF_DIR).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


PER_TASK = 32 << 10
INDEX_QUERIES = [
    "idf",
    "idf_bm25",
    "idf_letters",
    "distinctive_terms",
    "idf_by_band",
    "idf_by_band_drop_last_term",
    "idf_report",
    "suspect_sample",
    "top_words",
]


@pytest.mark.parametrize("name", INDEX_QUERIES)
def test_tasks_follow_the_text_and_leave_the_result_as_it_is(spark, monkeypatch, name):
    """The words of a bounded share of the text meet in a task, however many tasks a shuffle has."""
    query = entry_points.queries()[name]
    expected = sorted(map(repr, query(spark, SF_DIR).collect()))
    deal, dealt = index._colocate, []

    def noted(docs, by, colocated):
        found = deal(docs, by, colocated)
        if not colocated:
            dealt.append(int(re.search(r"hashpartitioning\(doc_id#\d+L?, (\d+)\)", plan_of(found))[1]))
        return found

    monkeypatch.setattr(deal, "__defaults__", (PER_TASK,))
    monkeypatch.setattr(index, "_colocate", noted)
    found = sorted(map(repr, query(spark, SF_DIR).collect()))
    size = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]
    assert dealt == [-(-size // PER_TASK)] and dealt[0] > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found == expected
