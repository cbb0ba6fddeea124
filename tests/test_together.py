"""Rows put together by key: as many tasks as the rows need, one exchange for all steps by the key."""

from pyspark.sql import functions as F

from tests.conftest import SF
from tessera.operators import routes
from tessera.operators.joining import together
from tessera.plans import q_serving
from tessera.plans.registry import Tables


def test_tasks_grow_with_the_rows(spark):
    for n in (0, 20_000, 80_000):
        df = together(spark.range(n).withColumn("k", F.col("id") % 5000), ["k"], 1000)
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert df.rdd.getNumPartitions() == max(4, n // 1000) and sum(sizes) == n and max(sizes, default=0) < 2000
        assert df.groupBy("k", F.spark_partition_id()).count().count() == min(n, 5000)


def test_routes_are_exchanged_once(spark):
    t = Tables(spark, SF)
    ranked = routes.rank_routes(q_serving._route_scores(t), "request_id", "route_id")
    assert ranked.count() > 0
    executed = ranked._jdf.queryExecution().executedPlan().toString()
    assert executed.split("== Initial Plan ==")[0].count("Exchange hashpartitioning(") == 1


def test_texts_of_the_chunk_table_come_in_bounded_tasks(spark):
    df = q_serving._chunk_table(Tables(spark, SF))
    assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == q_serving.described(Tables(spark, SF)).count()
