"""What must hold when the data are large or one key holds a third of them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from blotter.bindings import incidents
from blotter.operators import joins, keys, labels, metrics, sectors
from blotter.operators.joins import lookup
from blotter.operators.sampling import stratified_split
from blotter.plans.release import latest_of, pending_keys

ROWS = 60_000
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of all rows share one key; the rest have keys of their own."""
    path = str(tmp_path_factory.mktemp("skewed") / "t")
    hot = F.col("id") % 3 == 0
    spark.range(ROWS, numPartitions=8).select(
        F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("cmplnt_num"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 50)).alias("ofns_desc"),
        F.col("id").cast("timestamp").alias("rpt_dt"),
        "id",
    ).write.parquet(path)
    return spark.read.parquet(path)


def shuffled_rows(df) -> list[int]:
    """Rows each shuffle of the executed plan has written."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
            return
        if name.endswith("QueryStageExec"):
            walk(node.plan())
            return
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


def test_hot_key_is_reduced_before_the_shuffle(skewed, plan_of):
    latest = keys.latest_per_key(skewed, "cmplnt_num", "rpt_dt")
    assert plan_of(latest).count("WindowGroupLimit") == 2
    # 40 000 single rows, and of the 20 000 hot ones at most one per task.
    (written,) = shuffled_rows(latest)
    assert written <= ROWS * 2 // 3 + 8
    assert latest.where("cmplnt_num = 'hot'").first().id == ROWS - 3
    assert latest.count() == ROWS * 2 // 3 + 1


def test_keys_meet_as_distinct_values(spark, skewed, plan_of):
    batch = spark.createDataFrame([("hot",), ("1",), ("new",)], "cmplnt_num string")
    few = joins.stored_keys(batch, skewed, "cmplnt_num")
    assert "Exchange hashpartitioning" in plan_of(few)
    assert sum(shuffled_rows(few)) <= 8 + 1  # the target itself is not shuffled
    assert "GreaterThanOrEqual(cmplnt_num,1)" in plan_of(few)
    many = joins.stored_keys(batch, skewed, "cmplnt_num", limit=0)
    assert {r[0] for r in many.collect()} == {r[0] for r in few.collect()} == {"hot", "1"}


def test_salted_lookup_spreads_the_hot_key(spark, skewed):
    vocab = skewed.select("ofns_desc").distinct().withColumn("code", F.lit(1))
    joined = lookup(skewed, vocab, ["ofns_desc"], limit=0)
    assert joined.count() == ROWS and joined.where("code is null").isEmpty()
    salted = joined._jdf.queryExecution().analyzed().toString()
    assert "_salt" in salted
    spread = skewed.where("ofns_desc = 'hot'").groupBy(
        F.pmod(F.xxhash64(*skewed.columns), F.lit(joins.SALTS))
    ).count()
    sizes = [r["count"] for r in spread.collect()]
    assert len(sizes) == joins.SALTS and max(sizes) < 2 * (ROWS // 3) / joins.SALTS


def test_split_never_ranks_a_whole_label(skewed):
    made = stratified_split(skewed, key="id")
    hot = made.where("ofns_desc = 'hot'")
    assert hot.where("is_test").count() == ROWS // 3 // 5
    # The flagging pass reads the rows and joins the cut of each label: no shuffle of rows.
    assert sum(shuffled_rows(hot)) == 0


def test_release_reads_whole_rows_only_for_pending_keys(spark, skewed, plan_of):
    acks = spark.createDataFrame([(str(i),) for i in range(5)], "id string")
    waiting = pending_keys(skewed, acks)
    assert waiting.columns == ["cmplnt_num"] and "rpt_dt" not in plan_of(waiting)
    few = spark.createDataFrame([("hot",), ("7",)], "cmplnt_num string")
    by_size = latest_of(skewed, few), latest_of(skewed, few, limit=0)
    assert [sorted(r.id for r in df.collect()) for df in by_size] == [[7, ROWS - 3]] * 2
    assert sum(shuffled_rows(by_size[0])) <= 8 + 1


def test_counts_are_reduced_before_the_shuffle(skewed):
    assert sum(shuffled_rows(labels.label_counts(skewed))) <= 8 * 51
    judged = skewed.select(F.col("ofns_desc").alias("actual"), F.lit("hot").alias("predicted"))
    assert max(shuffled_rows(metrics.classification_report(judged))) <= 8 * 51


def test_skewed_anti_join_is_split_at_run_time(spark, skewed):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        wide = skewed.withColumn("pad", F.sha2(F.col("id").cast("string"), 512))
        acks = spark.range(100).select(F.col("id").cast("string").alias("id"))
        left = keys.pending(wide, acks)
        assert left.count() == ROWS - 66
        left.collect()
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_grid_has_no_join_and_scans_prune(spark, plan_of):
    rows = incidents(spark, SF)
    grid = sectors.forecast_grid(sectors.sector_centroids(sectors.distinct_positions(rows)))
    plan = plan_of(grid)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    schema = re.search(r"ReadSchema: struct<(user_id[^>]*)>", plan).group(1)
    assert schema == "user_id:bigint,value:double,props:string"


def test_filters_reach_the_scan(skewed, plan_of):
    assert "PushedFilters: [IsNotNull(ofns_desc)" in plan_of(labels.label_counts(skewed))
    kept = labels.keep_top_labels(skewed, 3)
    assert "BroadcastHashJoin" in plan_of(kept) and "TakeOrderedAndProject" in plan_of(kept)


def test_no_query_multiplies_rows_by_a_cross_join(spark, plan_of):
    from blotter.queries import catalogue

    for name in ("forecast_grid", "day_slots", "release_gate", "batch_metrics", "classification_report"):
        plan = plan_of(catalogue.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_shared_folder_comes_from_the_session(spark):
    from blotter.session import materialise, shared_dir

    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named
    table = materialise(spark.range(10))
    assert table.inputFiles()[0].removeprefix("file:").removeprefix("//").startswith(
        shared_dir(spark).removeprefix("file:").rstrip("/")
    )


def test_batches_of_the_ledger_come_in_many_files(spark, tmp_path, monkeypatch):
    """However few tasks read the events, many write and parse the messages of each batch."""
    from pathlib import Path

    from blotter.queries import streams

    spark.range(1200, numPartitions=1).selectExpr(
        "id as event_id", "timestamp_ntz '2024-01-01 00:00:00' as ts", "id % 90 as user_id", "'view' as event_type",
        "cast(id as double) as value", "'{\"k\": 1}' as props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(5).selectExpr("id as r_regionkey", "concat('R', id) as r_name").write.parquet(f"{tmp_path}/region.parquet")
    spark.range(100).selectExpr("id as o_orderkey", "'F' as o_orderstatus").write.parquet(f"{tmp_path}/orders.parquet")
    paths, real = {}, streams.scratch
    monkeypatch.setattr(streams, "scratch", lambda s, label: paths.setdefault(label, real(s, label)) if label == "messages" else real(s, label))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = streams.release_ledger(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [f.name.split("-")[2] for f in Path(paths["messages"].removeprefix("file:")).glob("*.parquet")]
    assert len(files) == 3 * 4 and len(set(files)) == 3
    # Of each eight events two have a key of their own, one has two, one a key of its user;
    # 25 of the acknowledged orders are among the first two.
    assert {(r.held_back, r.waiting) for r in rows} == {(4 * 150 + 45, 4 * 150 + 45 - 26)}
    assert len(rows) == 4 * 150 + 45 - 26


def test_every_message_is_dealt_to_one_of_three_batches(spark):
    from blotter.queries.streams import _dealt

    offs = spark.createDataFrame([(i,) for i in (None, -7, -1, 0, 4, 5, 6, 14, 22)], "off long")
    assert {r[0]: r[1] for r in offs.select("off", _dealt("off")).collect()} == {
        None: 0, -7: 2, -1: 2, 0: 0, 4: 1, 5: 2, 6: 0, 14: 0, 22: 0
    }
