"""The classifier of the group audit in a session in which something was observed before."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import SF
from tessera.plans import load_queries


def test_audit_after_an_observation(spark):
    seen = Observation("rows")
    spark.range(5).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 5}
    got = load_queries()[0]["mod12_classifier_audit"](spark, SF).collect()
    d = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("lang is not null")
    assert {r.value: r.n for r in got} == {None: d.count(), **{r.lang: r["count"] for r in d.groupBy("lang").count().collect()}}
