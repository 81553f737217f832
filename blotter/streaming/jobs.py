"""The streaming jobs: ingest, acknowledge, count tokens, answer SQL, refit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from blotter import schemas
from blotter.functions.messages import decode_value, flatten
from blotter.operators.keys import insert_if_absent
from blotter.operators.labels import known_label
from blotter.operators.metrics import token_counts
from blotter.plans import boosting, model
from blotter.plans.ingest import acknowledge_into, ingest_into, unique_records
from blotter.plans.ledger import Ledger
from blotter.plans.release import release_counted, release_waiting
from blotter.plans.requests import serve_pool, serve_requests
from blotter.session import materialise
from blotter.sources.messages import Topic, publish
from blotter.sources.tables import Table, append, ensure_table, read_table
from blotter.streaming.batches import run_batches

METRICS = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("received", "keys", "existing", "inserted", "pending", "sent")
    ]
)
FITS = T.StructType([T.StructField("rows", T.LongType()), T.StructField("batch", T.LongType())])


def ingest_stream(
    stream: DataFrame,
    schema: T.StructType,
    key: str,
    target: Table,
    checkpoint: str,
    trigger: dict | None = None,
    reject_table: Table | None = None,
    after: Callable[[SparkSession], dict[str, int]] | None = None,
    metrics: Table | None = None,
    ledger: Ledger | None = None,
) -> StreamingQuery:
    """Messages (part, off, value) into ``target``; new keys are noted in the ``ledger``.

    ``after`` runs once a batch is stored. Its counts and those of the ingest go to the
    Parquet folder ``metrics``, one row for each batch; a batch that comes again replaces
    its row.

    What is already stored is read from the target itself, so no state grows in the
    stream and a replayed batch adds nothing.
    """
    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        counts = ingest_into(batch, schema, key, target, reject_table, ledger, f"{number:09d}")
        if after is not None:
            counts |= after(spark)
        if metrics is not None:
            row = tuple(counts.get(name) for name in METRICS.names)
            one = spark.createDataFrame([row], METRICS).coalesce(1)
            one.write.mode("overwrite").parquet(f"{metrics.name}/run={number}")

    return run_batches(stream, step, checkpoint, trigger)


def incident_stream(
    stream: DataFrame,
    incidents: Table,
    acks: Table,
    topic: Topic,
    checkpoint: str,
    trigger: dict | None = None,
    min_rows: int = schemas.RELEASE_ROWS,
    metrics: Table | None = None,
    ledger: Ledger | None = None,
) -> StreamingQuery:
    """Ingest incidents and after each batch release what is pending.

    With a ``ledger``, which the stream of acknowledgements keeps as well, what is pending
    is read from there instead of both tables.
    """
    def after(spark: SparkSession) -> dict[str, int]:
        if ledger is None:
            return release_counted(spark, incidents, acks, topic, min_rows)
        return release_waiting(spark, incidents, ledger, topic, min_rows)

    return ingest_stream(
        stream,
        schemas.INCIDENTS,
        schemas.INCIDENT_KEY,
        incidents,
        checkpoint,
        trigger,
        after=after,
        metrics=metrics,
        ledger=ledger,
    )


def event_stream(
    stream: DataFrame, events: Table, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Ingest public events."""
    return ingest_stream(
        stream, schemas.PUBLIC_EVENTS, schemas.PUBLIC_EVENT_KEY, events, checkpoint, trigger
    )


def status_stream(
    stream: DataFrame, acks: Table, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Ingest acknowledgement records that carry their own status."""
    return ingest_stream(stream, schemas.ACKS, schemas.ACK_KEY, acks, checkpoint, trigger)


def ack_stream(
    stream: DataFrame, acks: Table, checkpoint: str, trigger: dict | None = None, ledger: Ledger | None = None
) -> StreamingQuery:
    """Record every incident seen on the output topic as sent, in the ``ledger`` as well."""
    def step(batch: DataFrame, number: int) -> None:
        acknowledge_into(batch, acks, ledger, f"{number:09d}")

    return run_batches(stream, step, checkpoint, trigger)


def publish_stream(
    values: DataFrame, topic: Topic, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Every record of a stream, as of pages, sent on as one message, at least once."""
    return run_batches(values, lambda batch, number: publish(batch, topic), checkpoint, trigger)


def token_stream(
    lines: DataFrame, sink: Table, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Token counts of each micro-batch, written with the batch number to a Parquet folder."""
    if sink.kind != "parquet":
        raise ValueError(f"token counts go to a Parquet folder, not to a {sink.kind} table")

    def step(batch: DataFrame, number: int) -> None:
        # Named by batch and overwritten, so a replay cannot count twice.
        counts = token_counts(batch).withColumn("batch", F.lit(number).cast("bigint"))
        counts.write.mode("overwrite").parquet(f"{sink.name}/run={number}")

    return run_batches(lines, step, checkpoint, trigger or {"processingTime": "1 second"})


def request_stream(
    stream: DataFrame,
    source: Table | dict[str, Table],
    topic: Topic,
    checkpoint: str,
    trigger: dict | None = None,
    in_flight: int = 1,
    seconds: float = 300.0,
) -> StreamingQuery:
    """Answer SQL requests arriving as message bodies, ``in_flight`` at once; with more than
    one, each has a limit of ``seconds``."""
    def step(batch: DataFrame, number: int) -> None:
        requests = batch.select(F.col("value").cast("string").alias("sql_query"))
        if in_flight > 1:
            serve_pool(requests, source, topic, in_flight=in_flight, seconds=seconds)
        else:
            serve_requests(requests, source, topic)

    return run_batches(stream, step, checkpoint, trigger)


def refit_stream(
    stream: DataFrame,
    training: Table,
    fitted: Table,
    vocabularies: model.Vocabularies,
    model_path: str,
    checkpoint: str,
    every: int,
    trigger: dict | None = None,
    **params,
) -> StreamingQuery:
    """Collect usable training records and refit once ``every`` new ones have come.

    Trees cannot continue from a fitted forest, so the model is refitted on the whole
    training table; ``continue_stream`` goes on from a boosted one instead. ``fitted`` logs the table size and batch of each fit, and each model
    has a folder of its own, so nobody reads one that is being replaced.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        ensure_table(spark, training, schemas.INCIDENTS)
        ensure_table(spark, fitted, FITS)
        flat = flatten(decode_value(batch), schemas.INCIDENTS, schemas.INCIDENT_KEY)
        records = unique_records(flat, schemas.INCIDENTS, schemas.INCIDENT_KEY)
        usable = known_label(model.clean(records), vocabularies.labels)
        rows = materialise(usable.select(schemas.INCIDENTS.names))
        append(insert_if_absent(rows, read_table(spark, training), schemas.INCIDENT_KEY), training)

        stored = read_table(spark, training)
        total = stored.count()
        last = read_table(spark, fitted).agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]
        if total - last < every:
            return
        prepared = model.training_rows(model.clean(stored), vocabularies)
        refitted = model.train(prepared, **params)
        model.save_model(model.Classifier(refitted, vocabularies), f"{model_path}/{number}")
        append(spark.createDataFrame([(total, number)], FITS), fitted)

    return run_batches(stream, step, checkpoint, trigger)


def continue_stream(
    stream: DataFrame,
    version: str,
    vocabularies: model.Vocabularies,
    checkpoint: str,
    trigger: dict | None = None,
    params: boosting.Params = boosting.Params(rounds=1),
) -> StreamingQuery:
    """Go on boosting a stored version with the usable records of each micro-batch.

    Every batch adds ``params.rounds`` rounds of trees, fitted to what the model so far
    leaves open on the batch. Earlier trees are read but never written, and no earlier
    record is read, so a batch costs what its records cost. A batch without usable
    records, or one that was logged before, adds nothing.
    """

    def step(batch: DataFrame, number: int) -> None:
        flat = flatten(decode_value(batch), schemas.INCIDENTS, schemas.INCIDENT_KEY)
        records = unique_records(flat, schemas.INCIDENTS, schemas.INCIDENT_KEY)
        rows = materialise(model.training_rows(model.clean(records), vocabularies))
        if not rows.isEmpty():
            model.continue_model(version, rows, number, params)

    return run_batches(stream, step, checkpoint, trigger)


def refitted_model(spark: SparkSession, fitted: Table, model_path: str) -> model.Classifier:
    """The model of the newest fit."""
    newest = read_table(spark, fitted).agg(F.max("batch")).first()[0]
    return model.load_model(spark, f"{model_path}/{newest}")
