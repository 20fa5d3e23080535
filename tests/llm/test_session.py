"""Operators work in a session of their own: the caller's settings stay as they are."""

import corpus_pipeline
from ledgerlift.llm.common import adopted, prepared
from ledgerlift.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_queries_and_stages_leave_the_settings(spark):
    before = dict(spark.conf.getAll)
    for name in ("op5_lm_scoring", "op6_mixing", "op9_language_id"):
        QUERIES[name](spark, SMALL).count()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SMALL)
    docs.count()
    assert dict(spark.conf.getAll) == before


def test_a_session_takes_over_the_settings(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        own = prepared(spark)
        assert own.conf.get("spark.sql.shuffle.partitions") == "5" and own.conf.get("spark.sql.adaptive.enabled") == "true"
        moved = adopted(spark.range(9).withColumnRenamed("id", "a.b"))
        assert moved.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true" and moved.columns == ["a.b"] and moved.count() == 9
        assert spark.catalog.listTables("global_temp") == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
