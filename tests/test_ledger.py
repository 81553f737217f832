"""The ledger of keys that wait for release: order, replay, loss, folding and what it reads."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from blotter import schemas
from blotter.plans import ledger as plan
from blotter.plans.ingest import acknowledge_into, ingest_into
from blotter.plans.ledger import Ledger, fold, found_ledger, record, waiting
from blotter.plans.release import pending_keys, release_waiting
from blotter.sources.messages import MESSAGE, Topic
from blotter.sources.tables import Table, append, read_table


def names(df) -> list[str]:
    return sorted(r[0] for r in df.collect())


@pytest.fixture()
def noted(spark, tmp_path):
    book = Ledger(str(tmp_path / "ledger"))

    def note(change: str, batch: str, *keys: str) -> None:
        record(book, spark.createDataFrame([(k,) for k in keys], "id string"), change, batch)

    return book, note


def test_waiting_whatever_the_order(spark, noted):
    book, note = noted
    assert names(waiting(spark, book)) == []
    note("acked", "0", "early")
    note("stored", "0", "a", "b", "c", "early")
    note("acked", "1", "b", "never stored")
    assert names(waiting(spark, book)) == ["a", "c"]
    note("stored", "0", "a", "b", "c", "early")  # the batch comes again
    note("stored", "1", "d", "a")
    assert names(waiting(spark, book)) == ["a", "c", "d"]


def test_folding_changes_nothing_and_drops_what_is_settled(spark, noted):
    book, note = noted
    note("stored", "0", "a", "b")
    note("acked", "0", "b", "later")
    assert not fold(spark, book, 3) and book.base(spark) is None
    assert fold(spark, book, 2)
    assert names(waiting(spark, book)) == ["a"]
    kept = spark.read.parquet(f"{book.base(spark)}/keys")
    assert names(kept.select("key")) == ["a", "later"]
    assert len(book.changes(spark)) == 2  # readers of the time before may still need them
    note("stored", "1", "later", "c")
    assert names(waiting(spark, book)) == ["a", "c"]
    assert fold(spark, book, 1) and not fold(spark, book, 1)
    assert names(waiting(spark, book)) == ["a", "c"]
    assert [c.rpartition("/")[2][:8] for c in book.changes(spark)] == ["stored-1"]
    assert names(spark.read.parquet(f"{book.base(spark)}/keys").select("key")) == ["a", "c"]


def test_a_lost_fold_is_not_seen(spark, noted, monkeypatch):
    book, note = noted
    note("stored", "0", "a")
    with monkeypatch.context() as broken:
        broken.setattr(plan, "mark_whole", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            fold(spark, book, 1)
    assert book.base(spark) is None and names(waiting(spark, book)) == ["a"]
    assert fold(spark, book, 1) and names(waiting(spark, book)) == ["a"]


def test_a_batch_lost_between_ledger_and_table_is_noted_again(spark, tmp_path, monkeypatch):
    book, target = Ledger(str(tmp_path / "ledger")), Table("parquet", str(tmp_path / "incidents"))
    batch = spark.createDataFrame([(0, 0, b'{"cmplnt_num":"a"}'), (0, 1, b'{"cmplnt_num":"b"}')], MESSAGE)
    step = lambda: ingest_into(batch, schemas.INCIDENTS, "cmplnt_num", target, ledger=book, batch="7")
    with monkeypatch.context() as broken:
        real = append

        def failing(df, table):
            if "boro_nm" in df.columns and not df.isEmpty():
                raise RuntimeError("lost")
            real(df, table)

        broken.setattr("blotter.plans.ingest.append", failing)
        with pytest.raises(RuntimeError, match="lost"):
            step()
    assert read_table(spark, target).count() == 0
    assert step()["inserted"] == 2
    assert names(waiting(spark, book)) == ["a", "b"]
    assert step()["inserted"] == 0  # a replay notes nothing new, and takes nothing away
    assert names(waiting(spark, book)) == ["a", "b"]
    assert read_table(spark, target).count() == 2
    assert names(pending_keys(read_table(spark, target), spark.createDataFrame([], schemas.ACKS))) == ["a", "b"]


def test_gate_reads_the_ledger_only(spark, tmp_path):
    book, target = Ledger(str(tmp_path / "ledger")), Table("parquet", str(tmp_path / "incidents"))
    acks, topic = Table("parquet", str(tmp_path / "acks")), Topic("file", str(tmp_path / "out"))
    rows = [(0, i, f'{{"cmplnt_num":"{i}","latitude":"40.5"}}'.encode()) for i in range(10)]
    ingest_into(spark.createDataFrame(rows, MESSAGE), schemas.INCIDENTS, "cmplnt_num", target, ledger=book, batch="0")
    shutil.copytree(target.name, tmp_path / "kept")
    shutil.rmtree(target.name)  # a closed gate does not miss it
    assert release_waiting(spark, target, book, topic, 11) == {"pending": 10, "sent": 0}
    shutil.copytree(tmp_path / "kept", target.name)
    assert release_waiting(spark, target, book, topic, 10) == {"pending": 10, "sent": 10}
    sent = spark.read.text(topic.name).select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("off"), F.col("value").cast("binary").alias("value"))
    acknowledge_into(sent.limit(4), acks, book, "0")
    assert release_waiting(spark, target, book, topic, 100) == {"pending": 6, "sent": 0}


def test_a_ledger_of_tables_that_exist(spark, tmp_path):
    book = Ledger(str(tmp_path / "ledger"))
    incidents, acks = Table("parquet", str(tmp_path / "i")), Table("parquet", str(tmp_path / "a"))
    append(spark.createDataFrame([("a",), ("b",), ("b",)], "cmplnt_num string"), incidents)
    append(spark.createDataFrame([("b", "sent"), ("x", "sent")], schemas.ACKS), acks)
    found_ledger(spark, book, incidents, acks)
    assert names(waiting(spark, book)) == ["a"] and book.base(spark) is not None
