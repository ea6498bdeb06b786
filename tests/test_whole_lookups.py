"""Keywords anywhere in a text count."""

from drillspark import operator_queries as queries


def test_keyword_behind_a_long_prefix(spark, tmp_path):
    spark.createDataFrame([(1, "x " * 80 + "then"), (2, "the " + "x " * 80 + "stand"), (3, "x " * 80)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["code"] for r in queries.q_argmax_alias(spark, str(tmp_path)).collect()} == {1: "REAM", 2: "TRIP_OUT", 3: "UNKNOWN"}
