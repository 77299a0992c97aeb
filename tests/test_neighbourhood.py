"""Tables of given works are made from these works' rows, not filtered out of whole tables."""

import pytest

from quillgraph.operators import graph
from quillgraph.plans.testmodel import SEEDS, Model


@pytest.fixture(scope="module")
def model(spark):
    return Model(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def ids(spark, model):
    return spark.createDataFrame(graph.seed_scores(model.scores(), SEEDS).select("work_id").distinct().collect(), "work_id string")


def met_whole(df):
    """Scans of lines that reach a window or an aggregation, or a join of another kind, without a semi-join before."""
    found = []

    def walk(node, above):
        first = node.toString().split("\n")[0]
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), [first, *above])
        if not children.size() and "l_partkey" in first and "LeftSemi" not in next(x for x in above if x.startswith(("Window", "Aggregate", "Join"))):
            found.append(above)

    walk(df._jdf.queryExecution().optimizedPlan(), [])
    return found


@pytest.mark.parametrize("name", ["scores", "works", "citation_edges", "affiliations", "authorships"])
def test_tables_of_works(model, ids, rows, name):
    made = model.of_works(lambda _, df: df)[name](ids)
    whole = model.tables()[name]
    plain = graph.filtered_edges(whole, ids) if name == "citation_edges" else graph.by_work(whole, ids)
    assert not met_whole(made) and rows(made) == rows(plain) != []
