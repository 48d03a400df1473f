"""Record streams, fan-out to several sinks, and the keyed document sink."""

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from scanlake.operators.documents import latest_documents
from scanlake.session import shared_dir

# Fixed value: seconds between flushes of a document sink.
FLUSH_SECONDS = 10

EPOCH = "epoch"

# Files a trigger reads unless told otherwise.
MAX_FILES = 256


def record_stream(
    spark: SparkSession, source: str, format: str = "text", **options: str
) -> DataFrame:
    """A queue as a stream with a string ``value`` column.

    text: files of a folder, in file order; kafka: ``source`` is the topic, servers come as
    options. Consumption is tracked by the query's checkpoint, so no record is lost when an
    executor or the driver stops.
    """
    reader = spark.readStream.format(format)
    if format != "kafka":
        reader = reader.option("maxFilesPerTrigger", MAX_FILES)
    reader = reader.options(**options)
    if format == "kafka":
        return reader.option("subscribe", source).load().select(F.col("value").cast("string"))
    return reader.load(source).select("value")


def table_stream(
    spark: SparkSession,
    folder: str,
    name: str,
    schema: T.StructType,
    files_per_trigger: int = MAX_FILES,
) -> DataFrame:
    """One Parquet table of a folder, a single file or a folder of files, as a file stream.

    A table of many files is read in triggers of bounded size, so what one stateful key or
    one persisted batch holds stays bounded too.
    """
    # A file source takes a single file only as a glob.
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(f"{folder}/{name}.parque[t]")
    )


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one, for a checkpoint or a written table."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def fan_out(
    stream: DataFrame, sinks: Mapping[str, Callable[[DataFrame], DataFrame]]
) -> DataStreamWriter:
    """Write every record to several tables: path -> what its consumer keeps of a batch.

    Each batch is read once; it is kept only where a second sink reads it again. A batch goes
    to the folder of its own epoch, replaced when it is tried again, so every sink holds every
    record once even if a run stops in between.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        shared = len(sinks) > 1
        if shared:
            batch.persist()
        try:
            for path, select in sinks.items():
                _write_epoch(select(batch), path, epoch)
        finally:
            if shared:
                batch.unpersist()

    return stream.writeStream.foreachBatch(write)


def dedup_stream(
    msgs: DataFrame, keys: Sequence[str] = ("clone_path", "scanner_type"), time: str = "completed_at", within_minutes: int = 60
) -> DataFrame:
    """The first message to arrive of each key; a later one within ``within_minutes`` of event time is dropped.

    The stream form of ``dedup_messages``, for keys that come again only inside that span. State is one row for each key, dropped once the watermark
    has passed its time by the span; messages behind the watermark are dropped too.
    """
    return msgs.withWatermark(time, f"{within_minutes} minutes").dropDuplicatesWithinWatermark(list(keys))


def document_sink(
    stream: DataFrame, path: str, keys: Sequence[str], seq: Sequence[str]
) -> DataStreamWriter:
    """Keyed upsert: each batch adds its last write per key under its own epoch.

    Read it with ``read_documents`` and the same ``seq``: then the result is the one of
    ``upsert_documents``, however the records were dealt to triggers. A repeated batch
    replaces its own folder, so delivery is effectively once. Epochs belong to the checkpoint:
    a new checkpoint needs a new table.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        _write_epoch(latest_documents(batch, keys, seq), path, epoch)

    return stream.writeStream.foreachBatch(write).trigger(
        processingTime=f"{FLUSH_SECONDS} seconds"
    )


def _write_epoch(batch: DataFrame, path: str, epoch: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")


def read_epochs(spark: SparkSession, path: str) -> DataFrame:
    """All records of a table written by epoch."""
    return spark.read.parquet(path)


def read_documents(
    spark: SparkSession, path: str, keys: Sequence[str], seq: Sequence[str] = ()
) -> DataFrame:
    """The current document of each key: the larger ``seq`` wins, a later flush wins ties.

    Without ``seq`` documents count by arrival: a later flush replaces an earlier one.
    """
    return latest_documents(read_epochs(spark, path), keys, [*seq, EPOCH]).drop(EPOCH)


def compact_documents(
    spark: SparkSession, path: str, target: str, keys: Sequence[str], seq: Sequence[str] = ()
) -> None:
    """Write the current documents to a new table of the same layout, without old versions."""
    latest = latest_documents(read_epochs(spark, path), keys, [*seq, EPOCH])
    latest.write.partitionBy(EPOCH).mode("errorifexists").parquet(target)


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Run until everything available now is processed."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class BatchLog(StreamingQueryListener):
    """Input rows and duration of every batch of the session's queries: the queue-length log.

    ``recentProgress`` forgets all but the last batches; a listener is told of each. Register it
    with ``spark.streams.addListener`` before the query starts; ``sink`` gets each row.
    """

    def __init__(self, sink: Callable[[dict], None]):
        self.sink = sink

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.sink(
            {
                "query": str(p.runId),
                "batch": p.batchId,
                "input_rows": p.numInputRows,
                "rows_per_second": p.processedRowsPerSecond,
            }
        )

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def progress_rows(query: StreamingQuery) -> list[dict]:
    """Input rows and duration of the query's recent batches; ``BatchLog`` has all of them."""
    return [
        {
            "batch": p["batchId"],
            "input_rows": p["numInputRows"],
            "rows_per_second": p["processedRowsPerSecond"],
        }
        for p in query.recentProgress
    ]
