"""Streams: replay, restart, failure and supervision."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from blotter import schemas
from blotter.plans.release import release
from blotter.sources.messages import MESSAGE, Topic, message_source, published_source
from blotter.sources.tables import Table, append, read_table
from blotter.streaming import jobs
from blotter.streaming.batches import ONCE, run_all, run_batches


def send(spark, topic: Topic, part: int, first: int, texts: list[str]) -> None:
    rows = [(part, first + i, text.encode()) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(topic.name)


def record(key: str, moment: str = "2024-01-01T00:00:00") -> str:
    return f'{{"cmplnt_num":"{key}","rpt_dt":"{moment}","latitude":"40.5"}}'


@pytest.fixture()
def place(tmp_path):
    class Place:
        topic = Topic("file", str(tmp_path / "in"))
        out = Topic("file", str(tmp_path / "out"))
        target = Table("parquet", str(tmp_path / "incidents"))
        acks = Table("parquet", str(tmp_path / "acks"))
        rejected = Table("parquet", str(tmp_path / "rejects"))
        state = str(tmp_path / "state")

    return Place


def keys_of(spark, table: Table, key: str = "cmplnt_num") -> list[str]:
    return sorted(r[0] for r in read_table(spark, table).select(key).collect())


def test_replay_restart_and_new_rows(spark, place):
    def run(state):
        query = jobs.ingest_stream(
            message_source(spark, place.topic), schemas.INCIDENTS, "cmplnt_num", place.target, state,
            ONCE, place.rejected,
        )
        run_all([query], 120)

    send(spark, place.topic, 0, 0, [record("a"), record("a"), "{bad", f"[{record('b')}, 5]"])
    run(place.state)
    assert keys_of(spark, place.target) == ["a", "b"]
    run(place.state)  # nothing new
    assert keys_of(spark, place.target) == ["a", "b"]
    send(spark, place.topic, 0, 9, [record("b"), record("c")])
    run(place.state)
    assert keys_of(spark, place.target) == ["a", "b", "c"]
    run(place.state + "-lost")  # everything again, as after the loss of the checkpoint
    assert keys_of(spark, place.target) == ["a", "b", "c"]
    reasons = read_table(spark, place.rejected).groupBy("reason").count().collect()
    assert {r.reason for r in reasons} == {"parse_error", "element_not_object"}


def test_batch_that_failed_after_writing_is_harmless(spark, place):
    send(spark, place.topic, 0, 0, [record("a"), record("b")])

    def step(batch, number):
        from blotter.plans.ingest import ingest_into

        ingest_into(batch, schemas.INCIDENTS, "cmplnt_num", place.target)
        if not step.failed:
            step.failed = True
            raise RuntimeError("lost after the write")

    step.failed = False
    with pytest.raises(Exception, match="lost after the write"):
        run_all([run_batches(message_source(spark, place.topic), step, place.state, ONCE)], 120)
    run_all([run_batches(message_source(spark, place.topic), step, place.state, ONCE)], 120)
    assert keys_of(spark, place.target) == ["a", "b"]


def test_release_waits_for_enough_and_stops_once_acknowledged(spark, place):
    send(spark, place.topic, 0, 0, [record("a"), record("b")])

    def ingest():
        query = jobs.incident_stream(
            message_source(spark, place.topic), place.target, place.acks, place.out, place.state, ONCE,
            min_rows=3,
        )
        run_all([query], 120)

    ingest()
    assert release(spark, place.target, place.acks, place.out, 3) == 0
    send(spark, place.topic, 0, 5, [record("c")])
    ingest()
    assert spark.read.text(place.out.name).count() == 3
    acking = jobs.ack_stream(published_source(spark, place.out), place.acks, place.state + "-acks", ONCE)
    run_all([acking], 120)
    assert keys_of(spark, place.acks, "id") == ["a", "b", "c"]
    assert release(spark, place.target, place.acks, place.out, 1) == 0


def test_release_sends_the_latest_version(spark, place):
    rows = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-02"), ("b", None)], "k string, t string")
    append(
        rows.select(F.col("k").alias("cmplnt_num"), F.to_timestamp("t").alias("rpt_dt")), place.target
    )
    assert release(spark, place.target, place.acks, place.out, 1) == 2
    sent = spark.read.json(place.out.name).orderBy("cmplnt_num").collect()
    assert sent[0].rpt_dt.startswith("2024-01-02") and sent[1].rpt_dt is None


def test_other_streams_ingest_their_records(spark, place):
    send(spark, place.topic, 0, 0, ['{"event_id":"7","event_name":"fair"}', '{"event_id":7,"event_name":"race"}'])
    run_all([jobs.event_stream(message_source(spark, place.topic), place.target, place.state, ONCE)], 120)
    assert [tuple(r)[:2] for r in read_table(spark, place.target).collect()] == [(7, "race")]
    statuses = Topic("file", place.topic.name + "-status")
    send(spark, statuses, 0, 0, ['{"id":"a","status":"seen"}'])
    run_all([jobs.status_stream(message_source(spark, statuses), place.acks, place.state + "2", ONCE)], 120)
    assert [tuple(r) for r in read_table(spark, place.acks).collect()] == [("a", "seen")]


def test_batch_tables_are_dropped(spark, place, tmp_path, monkeypatch):
    from blotter import session

    written = []
    real = session.scratch
    monkeypatch.setattr(session, "scratch", lambda s, label: written.append(real(s, label)) or written[-1])
    send(spark, place.topic, 0, 0, [record("a")])
    query = jobs.ingest_stream(
        message_source(spark, place.topic), schemas.INCIDENTS, "cmplnt_num", place.target, place.state, ONCE
    )
    run_all([query], 120)
    import os

    assert written and not any(os.path.exists(p.removeprefix("file:")) for p in written)


def test_refit_waits_for_enough_new_rows(spark, place, tmp_path):
    from blotter.plans import model

    def sent(first, n):
        return [
            f'{{"cmplnt_num":"k{i}","addr_pct_cd":{i % 3 + 1},"boro_nm":"BRONX","cmplnt_fr_dt":"2024-05-06",'
            f'"cmplnt_fr_tm":"1{i % 10}:00:00","ofns_desc":"{"THEFT" if i % 2 else "FRAUD"}",'
            f'"latitude":{40 + i % 2},"longitude":-73.9}}'
            for i in range(first, first + n)
        ]

    seen = spark.createDataFrame(
        [("THEFT", "1", "BRONX"), ("FRAUD", "2", "BRONX")], "ofns_desc string, addr_pct_cd string, boro_nm string"
    )
    fits = Table("parquet", str(tmp_path / "fits"))
    vocabularies = model.fit_vocabularies(seen)

    def run():
        query = jobs.refit_stream(
            message_source(spark, place.topic), place.target, fits, vocabularies, str(tmp_path / "model"),
            place.state, every=10, trigger=ONCE, numTrees=2, maxDepth=2,
        )
        run_all([query], 300)
        return [tuple(r) for r in read_table(spark, fits).orderBy("batch").collect()]

    send(spark, place.topic, 0, 0, [*sent(0, 10), '{"cmplnt_num":"x","ofns_desc":"THEFT"}'])
    assert run() == [(10, 0)]
    vocabularies = jobs.refitted_model(spark, fits, str(tmp_path / "model")).vocabularies
    send(spark, place.topic, 0, 20, sent(5, 9))  # five of them are stored already
    assert run() == [(10, 0)]
    send(spark, place.topic, 0, 30, sent(14, 6))
    assert run() == [(10, 0), (20, 2)]
    scored = model.score_batch(
        jobs.refitted_model(spark, fits, str(tmp_path / "model")), read_table(spark, place.target)
    )
    assert scored.where("prediction = ofns_desc").count() == 20


def test_one_failing_stream_stops_the_rest(spark, place):
    send(spark, place.topic, 0, 0, [record("a")])

    def fail(batch, number):
        raise RuntimeError("no good")

    idle = run_batches(message_source(spark, place.topic), lambda b, n: None, place.state + "1")
    broken = run_batches(message_source(spark, place.topic), fail, place.state + "2", ONCE)
    with pytest.raises(Exception, match="no good"):
        run_all([idle, broken], 120)
    assert not idle.isActive


def test_replayed_batches_add_no_rejects(spark, place):
    from blotter.plans.ingest import ingest_into

    rows = [(0, 0, b"{bad"), (0, 1, f"[{record('b')}, 5, 6]".encode()), (1, 0, b"{bad")]
    batch = spark.createDataFrame(rows, MESSAGE)
    for _ in range(2):
        ingest_into(batch, schemas.INCIDENTS, "cmplnt_num", place.target, place.rejected)
        assert read_table(spark, place.rejected).count() == 4


def test_a_batch_is_known_not_to_be_empty_by_one_task(spark, place):
    for part in range(20):
        send(spark, place.topic, part, 0, [record("a")])
    seen = []
    query = run_batches(message_source(spark, place.topic), lambda batch, number: seen.append(number), place.state, ONCE)
    run_all([query], 120)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(job).stageIds]
    assert seen == [0] and sum(tracker.getStageInfo(s).numTasks for s in stages) == 1


def test_supervisor_may_wait_for_any_stream(spark, place, tmp_path):
    send(spark, place.topic, 0, 0, [record("a")])
    source = message_source(spark, place.topic)
    endless = run_batches(source, lambda *_: None, str(tmp_path / "one"), {"processingTime": "1 second"})
    ending = run_batches(source, lambda *_: None, str(tmp_path / "two"), ONCE)
    run_all([endless, ending], 120, until="any")
    assert not endless.isActive and not ending.isActive


def test_token_counts_refuse_other_sinks(spark, place, tmp_path):
    send(spark, place.topic, 0, 0, ["a b"])
    lines = message_source(spark, place.topic)
    with pytest.raises(ValueError, match="Parquet"):
        jobs.token_stream(lines, Table("catalog", "tok"), str(tmp_path / "x"))
