"""Row, key, label and metric operators on small frames."""

from __future__ import annotations

import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from blotter import schemas
from blotter.functions.clock import cyclic_features, day_slots, time_features
from blotter.functions.conform import conform_schema, project
from blotter.operators import encoding, filters, keys, labels, metrics, sectors
from blotter.operators.joins import lookup, payload_bytes
from blotter.operators import ordering
from blotter.operators.ordering import global_index, page_slice
from blotter.operators.sampling import stratified_split
from blotter.schemas import schema_of

SMALL = schema_of("id string\nn int\nd double\nt timestamp")


def values(df, *columns):
    rows = df.select(*columns).collect()
    return sorted((tuple(r) if len(columns) > 1 else r[0] for r in rows), key=repr)


def test_conform_fills_absent_columns(spark):
    df = spark.createDataFrame([("7.9", "x")], "n string, extra string")
    made = conform_schema(df, SMALL)
    assert made.columns == SMALL.names
    assert tuple(made.first()) == (None, 7, 0.0, None)
    empty = conform_schema(df.drop("n"), SMALL).first()
    assert (empty.n, empty.d) == (0, 0.0)


def test_conform_nulls_what_does_not_convert(spark):
    df = spark.createDataFrame([("a", "many", "1e3", "2024-02-30")], "id string, n string, d string, t string")
    assert tuple(conform_schema(df, SMALL).first()) == ("a", None, 1000.0, None)


def test_conform_keeps_typed_columns(spark):
    moment = datetime.datetime(2024, 1, 1, 2, 3, 4, 567)
    df = spark.createDataFrame([(moment, 2**40)], "t timestamp_ntz, n bigint")
    row = conform_schema(df, SMALL).first()
    assert (row.t, row.n) == (moment, None)
    again = conform_schema(conform_schema(df, SMALL), SMALL)
    assert again.dtypes == [(f.name, f.dataType.simpleString()) for f in SMALL.fields]
    assert again.first().t == moment


def test_project(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert project(df, ["c", "a"]).columns == ["c", "a"]


def test_search_rules(spark):
    df = spark.createDataFrame(
        [("BRONX", "THEFT"), ("QUEENS", "BRONXITE"), (None, "ARSON")], "boro_nm string, pd_desc string"
    ).withColumns({c: F.lit(None).cast("string") for c in ("latitude", "cmplnt_fr_dt", "cmplnt_fr_tm")})
    assert filters.search(df, "boro_nm", "bronx").count() == 1
    assert filters.search(df, "All", "bronx").count() == 2
    assert filters.search(df, "pd_desc", "a%on").count() == 1
    assert filters.search(df, "pd_desc", "ars").count() == 3
    with pytest.raises(ValueError):
        filters.search(df, "1=1 or boro_nm", "bronx")


def test_plottable_drops_null_zero_nan(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (0.0, 2.0), (1.0, None), (float("nan"), 1.0)], "latitude double, longitude double"
    )
    assert values(filters.plottable(df), "latitude", "longitude") == [(1.0, 2.0)]


def test_requests_lacking_a_column_are_rejected(spark):
    df = spark.createDataFrame([(1, "BRONX")], "addr_pct_cd int, boro_nm string")
    accepted, rejected = filters.split_requests(df)
    assert accepted.count() == 0
    assert rejected.first().reason == "missing cmplnt_fr_dt"


def test_normalise_request(spark):
    df = spark.createDataFrame(
        [("Bronx", datetime.datetime(2024, 3, 5, 4, 7, 59), 1.0, 2.0)],
        "boro_nm string, asked_at timestamp_ntz, latitude double, longitude double",
    )
    row = filters.normalise_request(df).first()
    assert (row.addr_pct_cd, row.boro_nm, row.cmplnt_fr_dt, row.cmplnt_fr_tm) == (
        "114", "BRONX", "2024-03-05", "04:07:00",
    )


@pytest.mark.parametrize(
    ("date", "time", "hour", "month", "wday"),
    [
        ("2024-01-01", "00:00:00", 0, 1, 0),
        ("2024-12-08T00:00:00.000", "6:5:4", 6, 12, 6),
        ("2024-02-30", "24:00:00", None, None, None),
        ("(null)", "(null)", None, None, None),
        (None, None, None, None, None),
    ],
)
def test_time_features(spark, date, time, hour, month, wday):
    df = spark.createDataFrame([(date, time)], "cmplnt_fr_dt string, cmplnt_fr_tm string")
    row = time_features(df).first()
    assert (row.hour, row.month, row.wday) == (hour, month, wday)


def test_cyclic_fixed_points(spark):
    df = spark.createDataFrame([(0, 0), (6, 0)], "hour int, wday int")
    first, second = cyclic_features(df).orderBy("hour").collect()
    assert (first.h_sin, first.h_cos, first.w_sin, first.w_cos) == (0.0, 1.0, 0.0, 1.0)
    assert second.h_sin == pytest.approx(1) and second.h_cos == pytest.approx(0)


def test_day_slots(spark):
    slots = spark.range(1).select(day_slots().alias("s")).first().s
    assert (len(slots), slots[0], slots[1], slots[6], slots[-1]) == (
        144, "00:00:00", "00:10:00", "01:00:00", "23:50:00",
    )


def test_centroids_of_distinct_positions(spark):
    rows = [(1.0, 1.0, 5, "X"), (1.0, 1.0, 5, "X"), (3.0, 5.0, 5, "X"), (0.0, 1.0, 5, "X"),
            (1.0, 1.0, 0, "X"), (1.0, 1.0, 6, None), (None, 1.0, 5, "X")]
    df = spark.createDataFrame(rows, "latitude double, longitude double, addr_pct_cd int, boro_nm string")
    found = sectors.sector_centroids(sectors.distinct_positions(df))
    assert values(found, "addr_pct_cd", "boro_nm", "latitude", "longitude") == [(5, "X", 2.0, 3.0)]
    grid = sectors.forecast_grid(found, datetime.date(2024, 2, 1))
    assert grid.count() == 144 and dict(grid.dtypes)["cmplnt_fr_dt"] == "date"


def test_latest_takes_unknown_moment_first(spark):
    rows = [("a", 1, "x"), ("a", None, "y"), ("b", 1, "x"), ("b", 2, "z"), ("b", 2, "w")]
    df = spark.createDataFrame(rows, "k string, ts int, v string")
    assert values(keys.latest_per_key(df, "k", "ts", ["v"]), "k", "v") == [("a", "y"), ("b", "z")]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_stored_and_new_keys(spark, limit):
    batch = spark.createDataFrame([("a",), ("a",), ("b",), ("it's",)], "k string")
    new = sorted(["a", "it's"], key=repr)
    target = spark.createDataFrame([("b",), ("z",), ("b",)], "k string")
    assert values(keys.existing_keys(batch, target, "k", limit), "k") == ["b"]
    assert values(keys.new_keys(batch, target, "k", limit), "k") == new
    assert keys.existing_keys(batch.limit(0), target, "k", limit).isEmpty()
    fresh = keys.insert_if_absent(batch.distinct(), target, "k", limit)
    assert values(fresh, "k") == new


def test_pending_and_acks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "cmplnt_num string, n int")
    acks = keys.to_ack(df.where("n = 1"))
    assert [tuple(r) for r in acks.collect()] == [("a", "sent")]
    assert values(keys.pending(df, acks.unionAll(acks)), "cmplnt_num", "n") == [("b", 2)]


def test_already_done(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 1),)], "day date")
    assert keys.already_done(df, "day", datetime.date(2024, 1, 1))
    assert not keys.already_done(df, "day", datetime.date(2024, 1, 2))
    assert keys.not_yet_done(df, df, "day").isEmpty()


def test_top_labels_ties_fall_by_name(spark):
    df = spark.createDataFrame([(x,) for x in "ccbbaad"], "ofns_desc string")
    assert [r.ofns_desc for r in labels.top_k_labels(df, 2).collect()] == ["a", "b"]
    assert values(labels.keep_top_labels(df, 2), "ofns_desc") == ["a", "a", "b", "b"]


@pytest.mark.parametrize("limit", [2, 100])
def test_vocabulary_and_codes(spark, limit):
    df = spark.createDataFrame([("10",), ("9",), ("9",), (None,), ("é",)], "v string")
    vocab = encoding.vocabulary(df, "v", limit)
    assert values(vocab, "code", "value") == [(0, "10"), (1, "9"), (2, "é")]
    asked = spark.createDataFrame([(9,), (11,), (None,)], "v int")
    assert values(encoding.encode_with_vocab(asked, vocab, "v", "c"), "c") == [-1, -1, 1]
    back = encoding.label_decode(vocab.drop("value"), vocab, "code", "label")
    assert values(back, "label") == ["10", "9", "é"]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_gives_the_same_by_broadcast_and_by_salt(spark, how):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    small = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    broadcast, salted = lookup(df, small, ["k"], how), lookup(df, small, ["k"], how, limit=0)
    assert "_salt" not in salted.columns
    assert values(broadcast, *broadcast.columns) == values(salted, *broadcast.columns)


def test_payload_counts_text(spark):
    df = spark.createDataFrame([("x" * 1000,), (None,)], "s string")
    assert 1000 <= payload_bytes(df) <= 1200
    assert payload_bytes(df.limit(0)) == 0
    with pytest.raises(TypeError):
        payload_bytes(df.select(F.array("s").alias("a")))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=30))
def test_keep_last_is_idempotent(spark, pairs):
    rows = [(k, i, v) for i, (k, v) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "k int, pos int, v int")
    once = keys.keep_last(df, "k", ["pos"])
    wanted = {k: (k, i, v) for k, i, v in rows}
    assert values(once, "k", "pos", "v") == sorted(wanted.values(), key=repr)
    assert values(keys.keep_last(once, "k", ["pos"]), "k", "pos", "v") == sorted(wanted.values(), key=repr)


def test_global_index_and_deep_pages(spark, monkeypatch):
    df = spark.range(500, numPartitions=5).select((F.col("id") * 7 % 500).alias("v"))
    indexed = global_index(df, ["v"])
    assert indexed.where("v <> _index").isEmpty() and indexed.count() == 500
    near = values(page_slice(df, 10, 95, ["v"]), "v")
    monkeypatch.setattr("blotter.operators.ordering.SINGLE_TASK_ROWS", 50)
    assert values(page_slice(df, 10, 95, ["v"]), "v") == near == sorted(range(95, 105), key=repr)


@pytest.mark.parametrize("rows", [1, 7, 503])
def test_split_takes_the_share_of_every_label(spark, rows):
    df = spark.range(rows * 3).select(
        F.col("id").cast("string").alias("cmplnt_num"),
        F.when(F.col("id") < rows, "rare").otherwise("common").alias("ofns_desc"),
    )
    made = stratified_split(df)
    assert made.count() == rows * 3
    sizes = {r[0]: r[1] for r in made.where("is_test").groupBy("ofns_desc").count().collect()}
    assert sizes == {"rare": math.ceil(0.2 * rows), "common": math.ceil(0.2 * rows * 2)}
    assert values(made, "cmplnt_num", "is_test") == values(
        stratified_split(df.repartition(3)), "cmplnt_num", "is_test"
    )


def test_gate_is_all_or_nothing(spark):
    df = spark.range(10)
    assert metrics.release_gate(df, 10).count() == 10
    assert metrics.release_gate(df, 11).count() == 0
    row = metrics.release_metrics(df, 11).first()
    assert (row.pending, row.sent) == (10, 0)


def test_batch_metrics(spark):
    batch = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    target = spark.createDataFrame([("b",)], "k string")
    assert tuple(metrics.batch_metrics(batch, target, "k").first()) == (3, 2, 1, 1)
    assert tuple(metrics.batch_metrics(batch.limit(0), target, "k").first()) == (0, 0, 0, 0)


def test_tokens_keep_empty_ones(spark):
    df = spark.createDataFrame([("a  b",), ("a",)], "value string")
    assert values(metrics.token_counts(df), "token", "n") == [("", 1), ("a", 2), ("b", 1)]


def test_report_counts_undefined_as_zero(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")]
    df = spark.createDataFrame(rows, "actual string, predicted string")
    report = {r.label: r for r in metrics.classification_report(df).collect()}
    assert (report["a"].precision, report["a"].recall, report["a"].support) == (1.0, 0.5, 2)
    assert (report["c"].precision, report["c"].recall, report["c"].f1) == (0.0, 0.0, 0.0)
    assert report["b"].precision == pytest.approx(1 / 3)
    assert report["macro avg"].recall == pytest.approx(0.5)
    assert report["weighted avg"].recall == pytest.approx(0.5)
    assert report["macro avg"].support == 4
    assert metrics.accuracy(df).first().accuracy == 0.5


def test_not_null_constraints_of_forecasts(spark, tmp_path):
    from blotter.plans.forecast import write_forecasts
    from blotter.sources.tables import Table

    table = Table("parquet", str(tmp_path / "forecasts"))
    good = ("i", 1.0, 2.0, "5", "BRONX", datetime.date(2024, 1, 1), "00:00:00", "THEFT", 0.5)
    write_forecasts(spark.createDataFrame([good], schemas.FORECASTS), table)
    for at, bad in ((3, "x" * 11), (7, None)):
        row = [*good[:at], bad, *good[at + 1 :]]
        with pytest.raises(PySparkException):
            write_forecasts(spark.createDataFrame([row], schemas.FORECASTS), table)
    assert spark.read.parquet(table.name).count() == 1


def test_search_takes_backslashes_as_they_are(spark):
    rows = [("a\\bcd",), ("abcd",), ("tail\\",), ("tail%",)]
    names = schemas.SEARCH_COLUMNS
    data = spark.createDataFrame([tuple(v[0].upper() for _ in names) for v in rows], ", ".join(f"{c} string" for c in names))
    assert filters.search(data, names[0], "a\\bcd").count() == 1
    assert filters.search(data, names[0], "tail\\").count() == 1


def test_deep_pages_are_sorted(spark, monkeypatch):
    from blotter.operators import ordering

    monkeypatch.setattr(ordering, "SINGLE_TASK_ROWS", 100)
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n")).repartition(6)
    page = ordering.page_slice(rows, 300, 2500, ["n"])
    assert [r.n for r in page.collect()] == list(range(2500, 2800))


def test_a_deep_page_is_found_by_counting(spark, plan_of):
    rows = spark.range(20_000, numPartitions=4).select(
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") * 7919 % 101).alias("a"),
        (F.col("id") * 31 % 20_011).cast("double").alias("b"), "id",
    ).cache()
    order = ["a", "b", "id"]
    whole = rows.orderBy(*order).collect()
    for offset, limit in ((0, 10), (395, 20), (9_999, 150), (19_990, 50), (25_000, 5)):
        page = ordering.page_slice(rows, limit, offset, order, fit=200)
        assert page.collect() == whole[offset : offset + limit]
    page = ordering.page_slice(rows, 10, 12_345, order, fit=200)
    assert "rangepartitioning" not in plan_of(page) and "TakeOrdered" in plan_of(page)
    inside, before = ordering.narrowed(rows, order, 12_345, 10, 200)
    assert inside.count() <= 200 and 12_145 < before <= 12_345


def test_a_deep_page_among_equal_keys(spark):
    rows = spark.range(3_000).select(F.lit(1).alias("a"), (F.col("id") % 2).alias("b"))
    page = ordering.page_slice(rows, 4, 1_498, ["a", "b"], fit=100).collect()
    assert [r.b for r in page] == [0, 0, 1, 1]


def test_rows_are_placed_between_cuts_by_halving(spark):
    keys = [(None, 1), (None, 5), (2, None), (2, 3), (4, 0), (9, 9)]
    rows = spark.createDataFrame(keys, "a int, b int")
    for n in range(len(keys) + 1):
        cuts = [F.struct(F.lit(a).cast("int").alias("a"), F.lit(b).cast("int").alias("b")) for a, b in keys[:n]]
        place = ordering._place(F.struct("a", "b"), cuts)
        found = {(r.a, r.b): r.place for r in rows.withColumn("place", place).collect()}
        assert found == {k: min(i + 1, n) for i, k in enumerate(keys)}
    # Compiled as a whole: no function is called for each cut.
    assert "*(" in (plan := rows.select(place)._jdf.queryExecution().executedPlan().toString()) and "lambda" not in plan
