import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.operators import dedup, graph, metrics


def test_key_dedup_ranks_and_nulls(spark, rows):
    df = spark.createDataFrame(
        [("W1", "C1", 0.5, "2024-01-01"), ("W1", "C1", 0.9, "2024-01-01"), ("W1", "C1", 1.0, None), ("W1", None, 1.0, "2024-01-01"), ("W2", "C1", None, None)],
        "work_id string, concept_id string, concept_score double, snapshot_date string",
    )
    assert rows(dedup.dedup(df, "scores")) == [("W1", "C1", 0.9, "2024-01-01"), ("W2", "C1", None, None)]
    names = spark.createDataFrame([("I1", None, "DE", "2024-01-01"), ("I1", "ab", "DE", "2024-01-01"), ("I1", "abc", "FR", "2024-01-01"), ("I1", "abcd", "FR", "2023-01-01")], "institution_id string, institution_name string, country string, snapshot_date string")
    assert rows(dedup.dedup(names, "institutions")) == [("I1", "abc", "FR", "2024-01-01")]
    people = spark.createDataFrame([("W", "A", "middle", 1, True, "d"), ("W", "A", "first", 2, False, "d"), ("W", "A", "last", 0, True, "d")], "work_id string, author_id string, author_position string, author_sequence int, is_corresponding boolean, snapshot_date string")
    assert rows(dedup.dedup(people, "authorships")) == [("W", "A", "last", 0, True, "d")]


def test_row_dedup_and_checks(spark, rows):
    df = spark.createDataFrame([("a", "b", "2024-01-01"), ("a", "b", "2024-02-01"), ("a", None, "x"), ("c", "b", None)], "citing_work_id string, cited_work_id string, snapshot_date string")
    assert rows(dedup.dedup(df, "citation_edges")) == [("a", "b", "2024-02-01"), ("c", "b", None)]
    key = ("citing_work_id", "cited_work_id")
    assert rows(dedup.duplicate_keys(df, key)) == [("a", "b", 2)]
    assert rows(dedup.null_keys(df, key)) == [("a", None, "x")]
    assert rows(dedup.check(df, key)) == [(4, 1, 1)]
    assert rows(dedup.check(df.limit(0), key)) == [(0, 0, 0)]
    with pytest.raises(ValueError):
        dedup.assert_valid(df, "citation_edges")
    dedup.assert_valid(dedup.dedup(df, "citation_edges"), "citation_edges")


@given(st.lists(st.tuples(st.sampled_from(["W1", "W2", None]), st.sampled_from(["C1", "C2", None]), st.sampled_from([0.1, 0.5, None]), st.sampled_from(["2024-01-01", "2023-01-01", None])), max_size=12))
@settings(max_examples=8, deadline=None)
def test_dedup_is_unique_and_idempotent(spark, rows, data):
    df = spark.createDataFrame(data, "work_id string, concept_id string, concept_score double, snapshot_date string")
    once = dedup.dedup(df, "scores")
    assert rows(dedup.check(once, ("work_id", "concept_id")))[0][1:] == (0, 0)
    assert rows(dedup.dedup(once, "scores")) == rows(once)


@pytest.fixture
def tables(spark):
    f = spark.createDataFrame
    return {
        "scores": f([("W1", "C1", 0.9), ("W1", "C2", 0.9), ("W2", "C2", 0.4), ("W9", "C2", 0.4)], "work_id string, concept_id string, concept_score double"),
        "citation_edges": f([("W1", "W2"), ("W3", "W1"), ("W2", "W4"), ("W1", "W1"), ("W5", "W1")], "cited_work_id string, citing_work_id string"),
        "works": f([("W1", 2010, "S1", True, None), ("W2", 2012, "S1", False, True), ("W3", None, None, True, True), ("W4", 2000, "S2", None, None)], "work_id string, publication_year int, source_id string, is_open_access boolean, is_retracted boolean"),
        "authorships": f([("W1", "A1", "first", True), ("W2", "A1", "last", None), ("W2", None, "middle", False), ("W4", "A2", "first", True)], "work_id string, author_id string, author_position string, is_corresponding boolean"),
        "affiliations": f([("W1", "A1", "I1"), ("W1", "A3", "I1"), ("W2", "A1", "I2")], "work_id string, author_id string, institution_id string"),
        "selected_scores": f([("W1", "C1", 0.9)], "work_id string, concept_id string, concept_score double"),
        "authors": f([("A1", "x"), ("A2", "y")], "author_id string, author_name string"),
        "institutions": f([("I1",), ("I2",), ("I3",)], "institution_id string"),
        "concepts": f([("C1", "one"), ("C2", None), ("C3", "three")], "concept_id string, concept_name string"),
        "sources": f([("S1",), ("S2",)], "source_id string"),
    }


def test_neighbourhood(tables, rows):
    t = graph.neighbourhood(tables, ["C1"])
    assert rows(t["citation_edges"]) == [("W1", "W1"), ("W1", "W2"), ("W3", "W1"), ("W5", "W1")]
    assert rows(t["work_ids"]) == [("W1",), ("W2",), ("W3",), ("W5",)]
    assert [r[0] for r in rows(t["works"])] == ["W1", "W2", "W3"]
    assert [r[0] for r in rows(t["authors"])] == ["A1"] and [r[0] for r in rows(t["sources"])] == ["S1"]
    assert [r[0] for r in rows(t["concepts"])] == ["C1", "C2"] and [r[0] for r in rows(t["institutions"])] == ["I1", "I2"]


def test_metrics(tables, rows):
    t = graph.neighbourhood(tables, ["C1"])
    m = metrics.all_metrics(t, ["C1"], tables["concepts"])
    assert rows(m["works"]) == [
        ("W1", 2, 3, 0.9, 0.9, 1, 1, 1, 2, "one", "C1", 0.9),
        ("W2", 0, 1, 0.0, 0.0, 0, 1, 1, 1, None, "C2", 0.4),
        ("W3", 1, 0, 0.0, 0.0, 0, 0, 0, 0, None, None, 0.0),
    ]
    assert rows(m["authors"]) == [("A1", 2, 1, 1, 1, 2010, 2012, 3, 2, 1.0, 2)]
    assert rows(m["sources"]) == [("S1", 2, 2010, 2012, 1, 1, 2, 1.0, 2)]
    assert rows(m["institutions"]) == [("I1", 1, 2, 2010, 2010, 2, 2.0, 2), ("I2", 1, 1, 2012, 2012, 0, 0.0, 0)]
    assert [r[:4] for r in rows(m["concepts"])] == [("C1", 1, 0.9, 0.9), ("C2", 2, 0.65, 0.9)]


def test_seed_filter_reaches_the_scan(spark, tmp_path, tables):
    tables["scores"].write.parquet(str(tmp_path / "s"))
    plan = graph.seed_scores(spark.read.parquet(str(tmp_path / "s")), ["C1"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(concept_id), EqualTo(concept_id,C1)]" in plan or "In(concept_id" in plan


def test_key_dedup_limits_before_the_shuffle(spark, tables):
    df = tables["scores"].selectExpr("*", "'d' as snapshot_date")
    assert dedup.dedup(df, "scores")._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2
