"""Stream scoring: request files arrive -> enrich -> predict -> append to the log.

A join per micro-batch (foreachBatch) with the features as of the newest stored
snapshot, or with a table that is given.  Which snapshot a batch took is kept
beside the log, so a replay takes the same one while later batches see newer
ones.  The log has the layout of the batch log,
partitioned by log_date, and below it by stream and batch: a batch replayed
after a failure replaces its own output (dynamic overwrite), and another stream
or a new checkpoint, whose batches count from 0 again, has a stream id of its
own and replaces nothing.  A replay keeps the time of the first try, so it
stays in the same log_date also after midnight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import scoring as SC
from ..schemas import SCORING_REQUEST
from ..sources.lake import list_folders, read_json, write_json


def request_stream(spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SCORING_REQUEST).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _first_time(spark: SparkSession, log_path: str, stream_id: str, batch_id: int) -> str | None:
    """When this batch was logged before, if it was: read from its own partitions only."""
    if not any(f.startswith("log_date=") for f in list_folders(spark, log_path)):
        return None
    log = spark.read.parquet(log_path)
    if "stream_id" not in log.columns:
        return None
    mine = log.where((F.col("stream_id") == stream_id) & (F.col("batch_id") == int(batch_id)))
    return mine.agg(F.date_format(F.min("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]


def batch_features(spark: SparkSession, features: DataFrame | SC.SnapshotFeatures, log_path: str, stream_id: str, batch_id: int) -> DataFrame | None:
    """The features of one batch; None if no snapshot is stored yet.

    The date is written before the batch is scored (Spark does not read folders
    that start with "_") and read again when the batch is replayed.
    """
    if not isinstance(features, SC.SnapshotFeatures):
        return features
    note = f"{log_path.rstrip('/')}/_snapshots/{stream_id}/{int(batch_id)}.json"
    kept = read_json(spark, note)
    if kept is None:
        kept = {"snapshot_date": features.newest(spark)}
        write_json(spark, note, kept)
    return features.at(spark, kept["snapshot_date"]) if kept["snapshot_date"] else None


def score_batch(batch: DataFrame, batch_id: int, features: DataFrame | SC.SnapshotFeatures, model, log_path: str,
                model_version: str = SC.DEFAULT_MODEL_VERSION, seed: int = 42, stream_id: str | None = None) -> None:
    """Log the predictions of one micro-batch; stream_id defaults to the running query's id."""
    spark = batch.sparkSession
    stream = stream_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    features = batch_features(spark, features, log_path, stream, batch_id)
    if features is None:
        features, model = spark.createDataFrame([], "product_id bigint, snapshot_date date"), None
    scored = SC.score_requests(batch, features, model, model_version=model_version, seed=seed)
    log = (SC.prediction_log(scored, run_ts=_first_time(spark, log_path, stream, batch_id))
           .withColumn("stream_id", F.lit(stream)).withColumn("batch_id", F.lit(int(batch_id))))
    (log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("log_date", "stream_id", "batch_id").parquet(log_path))


def score_stream(spark: SparkSession, requests_path: str, features: DataFrame | SC.SnapshotFeatures, model, log_path: str,
                 checkpoint_path: str, fmt: str = "json", available_now: bool = True,
                 model_version: str = SC.DEFAULT_MODEL_VERSION, seed: int = 42):
    """Start the scoring stream; returns the StreamingQuery."""
    stream = request_stream(spark, requests_path, fmt)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: score_batch(df, bid, features, model, log_path,
                                                        model_version, seed))
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="60 seconds")
    return writer.start()
