"""Ingest with its keys in the stream's state: order of arrival, replay, and what is read."""

from __future__ import annotations

import datetime
import shutil

import pytest

from blotter import schemas
from blotter.functions.messages import CLOCK, decode_value, flatten, valid_records
from blotter.operators.keys import keep_last
from blotter.sources.messages import MESSAGE, TIMED, Topic, message_source
from blotter.sources.tables import Table, append
from blotter.streaming.batches import ONCE, run_all
from blotter.streaming.keyed import STATE_STORE, _first_seen, keyed_ingest_stream, keyed_rows, loads


def at(second: int) -> datetime.datetime:
    return datetime.datetime(2024, 1, 1, 0, 0, second)


def record(key: str, name: str) -> bytes:
    return f'{{"cmplnt_num":"{key}","boro_nm":"{name}","latitude":"40.5","addr_pct_cd":"7"}}'.encode()


@pytest.fixture()
def job(spark, tmp_path):
    topic, target = Topic("file", str(tmp_path / "in")), Table("parquet", str(tmp_path / "target"))
    stored = Table("parquet", str(tmp_path / "stored"))
    append(spark.createDataFrame([("old",)], "cmplnt_num string"), stored)

    def run(*rows) -> dict[str, str]:
        if rows:
            spark.createDataFrame(rows, TIMED).coalesce(1).write.mode("append").parquet(topic.name)
        stream = message_source(spark, topic, timed=True)
        query = keyed_ingest_stream(
            stream, schemas.INCIDENTS, "cmplnt_num", target, str(tmp_path / "state"), ONCE, stored
        )
        run_all([query], 120)
        found = loads(spark, target, schemas.INCIDENTS).select("cmplnt_num", "boro_nm").collect()
        assert len(found) == len({r.cmplnt_num for r in found})
        return {r.cmplnt_num: r.boro_nm for r in found}

    run.target, run.state, run.topic = target, tmp_path / "state", topic
    return run


def test_the_last_sent_of_the_first_batch_stays(job):
    first = job(
        (0, 9, record("a", "early"), at(1)), (1, 2, record("a", "late"), at(5)), (2, 7, record("a", "middle"), at(3)),
        (0, 1, record("b", "no time"), None), (0, 0, record("b", "timed"), at(0)),
        (0, 3, record("c", "lower part"), at(2)), (1, 1, record("c", "higher part"), at(2)),
        (0, 4, record("old", "known"), at(9)), (0, 5, b"{bad", at(9)),
    )
    assert first == {"a": "late", "b": "timed", "c": "higher part"}
    # A later batch loses, whether its record is older or newer.
    assert job((0, 10, record("a", "older"), at(0)), (0, 11, record("c", "newer"), at(59)), (0, 12, record("d", "new"), at(1))) == {
        **first, "d": "new"
    }


def test_a_batch_that_comes_again_replaces_its_load(spark, job):
    job((0, 0, record("a", "one"), at(1)))
    before = job((0, 1, record("b", "two"), at(1)), (0, 2, record("a", "again"), at(2)))
    (last,) = [max(p for p in (job.state / "commits").iterdir() if p.name.isdigit())]
    for name in (last.name, f".{last.name}.crc"):  # lost after the write, before the commit
        (last.parent / name).unlink()
    assert job() == before == {"a": "one", "b": "two"}


def test_the_target_is_never_read(job):
    job((0, 0, record("a", "one"), at(1)))
    for load in (p for p in __import__("pathlib").Path(job.target.name).iterdir()):
        shutil.rmtree(load)
    assert job((0, 1, record("a", "again"), at(2)), (0, 2, record("b", "two"), at(2))) == {"b": "two"}


def test_settings_are_put_back(spark, job):
    name = next(iter(STATE_STORE))
    before = spark.conf.get(name)
    job((0, 0, record("a", "one"), at(1)))
    assert spark.conf.get(name) == before


def test_a_key_with_very_many_records(job):
    rows = [(i % 3, i, record("hot", str(i)), at(i % 60)) for i in range(30_000)]
    assert job(*rows, (0, 99_999, record("cold", "x"), at(1))) == {"hot": "29999", "cold": "x"}


def test_clock_with_and_without_times(spark):
    rows = [(0, 5, record("a", "place"), None), (1, 1, record("a", "timed"), at(1)), (0, 9, record("a", "older"), at(0))]
    timed = valid_records(flatten(decode_value(spark.createDataFrame(rows, TIMED)), schemas.INCIDENTS, "cmplnt_num"))
    assert keep_last(timed, "cmplnt_num", CLOCK).first().boro_nm == "timed"
    plain = flatten(decode_value(spark.createDataFrame([r[:3] for r in rows], MESSAGE)), schemas.INCIDENTS, "cmplnt_num")
    assert plain.columns[:3] == ["part", "off", "pos"]


def test_keys_meet_their_state_without_python(spark, tmp_path):
    spark.createDataFrame([], TIMED).write.parquet(str(tmp_path / "in"))
    rows = keyed_rows(message_source(spark, Topic("file", str(tmp_path / "in")), timed=True), schemas.INCIDENTS, "cmplnt_num")
    assert rows.isStreaming
    plan = _first_seen(rows)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "Pandas" not in plan


def test_keys_stay_known_over_several_batches(job):
    first = {f"k{i}": "one" for i in range(200)}
    assert job(*((0, i, record(k, v), at(9)) for i, (k, v) in enumerate(first.items()))) == first
    for number in range(2):  # earlier and later records of known keys, and no key at all
        assert job((1, number, record("k5", "two"), at(number)), (2, number, record("k7", "three"), None)) == first
    assert job() == first
