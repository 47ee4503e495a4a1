"""How often the fact table is read by queries that once read it two or three times."""

from pathlib import Path

import pytest

from custlens.plans import catalog

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables are not here")


def scans(spark, name, column):
    """Parquet scans of ``column`` in the final plans of all jobs the query runs."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    catalog.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    executions = store.executionsList()
    found = 0
    for i in range(before, executions.size()):
        nodes = store.planGraph(executions.apply(i).executionId()).allNodes()
        for k in range(nodes.size()):
            node = nodes.apply(k)
            found += node.name().startswith("Scan parquet") and column in node.desc()
    return found


@pytest.mark.parametrize(
    "name, column, times",
    [
        ("rfm_last_order", "l_quantity", 1),
        ("rfm_scores", "l_quantity", 1),
        ("basket_stats", "l_extendedprice", 1),
        ("label_distribution", "l_extendedprice", 1),
        ("clv_projected", "l_quantity", 1),
        ("customer_aggregate", "l_quantity", 1),
        ("denormalise_orders", "p_retailprice", 1),
        ("fill_price_all_missing", "l_orderkey", 1),
        ("fill_price_overwrite", "l_orderkey", 1),
        ("clv_margin", "l_quantity", 1),
        ("campaign_recommendations", "props", 1),
    ],
)
def test_facts_are_read_once(spark, name, column, times):
    assert 1 <= scans(spark, name, column) <= times
