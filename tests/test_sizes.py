"""Work on a row is done once, and tables of one row group are dealt to tasks, so larger tables take more tasks and no longer ones."""

import pytest
from pyspark.sql import functions as F

from drillspark import dims
from drillspark import operator_queries as Q
from drillspark.functions import text as T
from drillspark.operators import classify, spread, tables


def plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def packed(spark, tmp_path, monkeypatch):
    """A folder of driver tables with one row group each, for which a task takes few bytes."""
    monkeypatch.setattr(spread, "TASK_BYTES", 2000)
    k = F.col("id")
    part = spark.range(0, 2000, 1, 1).select(k.alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), (k % 50 + 1).cast("int").alias("p_size"), F.lit(1.0).alias("p_retailprice"))
    part.write.parquet(f"{tmp_path}/part.parquet")
    events = spark.range(0, 2000, 1, 1).select(k.alias("event_id"), F.timestamp_seconds(k).alias("ts"), (k % 100).alias("user_id"), F.lit("error").alias("event_type"), F.lit(1.0).alias("value"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(0, 2000, 1, 1).select((k % 100).alias("o_custkey"), k.alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    customer = spark.range(0, 2000, 1, 1).select(k.alias("c_custkey"), F.lit("n").alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"), F.lit("m").alias("c_mktsegment"))
    customer.write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_a_text_is_folded_once_and_not_for_each_keyword(spark):
    rows = spark.range(1).select(F.col("id").cast("string").alias("t"))
    assert plan(rows.select(classify.normalize_code(F.col("t")).alias("y"))).count("translate(") == 1
    assert plan(rows.select(classify.longest_keyword(F.lower("t"), [("a", "x"), ("b", "y")], negation="no$").alias("y"))).count("lower(") == 1


@pytest.mark.parametrize("name", ["q_cascade", "q_classify", "q_map_columns"])
def test_rows_of_one_row_group_are_worked_out_in_many_tasks(spark, packed, name):
    rows = getattr(Q, name)(spark, packed)
    assert rows.rdd.getNumPartitions() > 4 and rows.count() == 2000


def test_a_head_is_matched_once_a_field(spark):
    head = F.array(F.lit("From"), F.col("id").cast("string"))
    assert plan(spark.range(1).select(tables.map_columns(head, dims.TIME_COLUMNS).alias("y"))).count("RLIKE") == len(dims.TIME_COLUMNS)


def test_labels_match_as_tokens(col):
    cases = {"md": True, "md(m)": True, "md：": True, "m d": False, "mdx": False, "x md": True, "xmd": False, "井深 (m)": True, "原井深": True, "井深x": True}
    assert dict(zip(cases, col(lambda x: T.label_matches(T.normalize_label(x), ["MD", "井深"]), list(cases)))) == cases


def cells_of(spark, n=200):
    texts = [(f"d{d % n}", 1, 0, r, c, t) for d in range(n) for r, row in enumerate((["Bit No", "Size (in)", "Footage"], [str(d), "8.5", "10 m"])) for c, t in enumerate(row)]
    return spark.createDataFrame([*texts, ("d0", 1, 0, 1, 0, "0"), ("d1", 1, 0, 1, 4, "far")], "doc_id string, page int, table_idx int, row_idx int, col_idx int, text string")


def test_cells_are_shuffled_once_for_a_table(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = tables.data_rows(cells_of(spark), "bit_record", dims.BIT_COLUMNS, every=False)
        assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert rows.count() == 200


def test_rows_of_cells_with_gaps_and_doubles(spark):
    found = {(r.doc_id, r.row_idx): r.cells for r in tables.as_rows(cells_of(spark, 3)).collect()}
    assert found["d0", 1] == ["0", "8.5", "10 m"] and found["d1", 1] == ["1", "8.5", "10 m", "", "far"] and found["d2", 0] == ["Bit No", "Size (in)", "Footage"]


@pytest.mark.parametrize("name", ["q_bits", "q_mud"])
def test_tables_of_one_row_group_are_read_in_many_tasks(spark, packed, name):
    rows = getattr(Q, name)(spark, packed)
    assert rows.rdd.getNumPartitions() > 4 and rows.count() == 2000


def test_entries_of_one_row_group_are_read_in_many_tasks(spark, packed):
    rows = Q.q_time_log(spark, packed)
    assert rows.rdd.getNumPartitions() > 4 and rows.count() == 1600


def test_mentions_of_one_row_group_are_looked_for_in_many_tasks(spark, packed):
    texts = Q.table(spark, packed, "customer", by="c_custkey")
    rows = Q.q_mentions(spark, packed)
    assert texts.rdd.getNumPartitions() > 4 and plan(rows).count("RepartitionByExpression") == 2 and rows.count() == 1000


def test_days_are_sorted_without_payload_and_truth(spark, packed):
    rows = Q.q_reconcile(spark, packed)
    window = next(x for x in plan(rows).splitlines() if "Window [" in x)
    below = plan(rows).split(window)[1].splitlines()[1]
    assert " AS _found#" in below and " AS payload#" not in below
    assert rows.rdd.getNumPartitions() > 4
