"""API payloads that land as files, flattened file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starmart.plans import incremental
from starmart.session import scratch_dir
from starmart.sources import filesystem, warehouse

BROKEN = "_corrupt_record"


def read_payload_stream(spark: SparkSession, directory: str, record: T.StructType,
                        list_field: str, status: str | None = "status", multiline: bool = True,
                        max_files: int | None = None) -> DataFrame:
    """Streaming payloads: the list of records, the status, the file, and the text of a payload
    that could not be read."""
    fields = [T.StructField(list_field, T.ArrayType(record)), T.StructField(BROKEN, T.StringType())]
    if status is not None:
        fields.append(T.StructField(status, T.IntegerType()))
    reader = spark.readStream.schema(T.StructType(fields)).option("multiLine", multiline)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(directory).select("*", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_modification_time").alias("arrived"))


def refusal(list_field: str, status: str | None):
    """Why a payload is refused; null for a good one. A payload without a status is taken."""
    why = F.when(F.col(BROKEN).isNotNull(), "unreadable")
    if status is not None:
        why = why.when(F.col(status) != 200, F.concat(F.lit("status "), F.col(status).cast("string")))
    return why.when(F.col(list_field).isNull(), f"no {list_field}")


def stream_payload(spark: SparkSession, directory: str, record: T.StructType, list_field: str,
                   out: str, checkpoint: str, refused: str, status: str | None = "status",
                   multiline: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Take up all files not seen yet, then stop: records to the Parquet directory ``out``,
    payloads that are unreadable or were not answered with 200 to ``refused`` (``file``,
    ``reason``, ``payload`` where it is unreadable).

    The checkpoint remembers the files taken. Each batch has a folder of its own in both
    outputs, which a repeated batch replaces, so a restart after a failure neither loses nor
    repeats anything.
    """
    payloads = read_payload_stream(spark, directory, record, list_field, status, multiline, max_files)
    why = refusal(list_field, status)

    def store(batch: DataFrame, number: int) -> None:
        taken = scratch_dir(spark, "payloads")  # the files are read and parsed once
        batch.withColumn("reason", why).write.parquet(taken)
        read = spark.read.parquet(taken)
        (read.where("reason IS NULL").select(F.inline(list_field))
         .write.mode("overwrite").parquet(f"{out}/batch={number}"))
        (read.where("reason IS NOT NULL").select("file", "reason", F.col(BROKEN).alias("payload"))
         .write.mode("overwrite").parquet(f"{refused}/batch={number}"))
        filesystem.delete(spark, taken)

    return (payloads.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def new_records(payloads: DataFrame, list_field: str, key: str, within: str,
                status: str | None = "status") -> DataFrame:
    """The records of a payload stream, each once: a record whose ``key`` has come before is dropped.

    A source that is asked again and again answers with the same records, often with old times of
    their own, so what counts is when a record arrived: for the time ``within`` after it first came
    its key is kept as state, then forgotten. A record without a key can't be told from others and is
    taken each time it comes.
    """
    good = payloads.where(refusal(list_field, status).isNull()).withWatermark("arrived", within)
    records = good.select("arrived", F.explode(list_field).alias("r")).select("arrived", "r.*")
    place = F.when(F.col(key).isNull(), F.expr("uuid()")).otherwise(F.concat(F.lit("k"), F.col(key).cast("string")))
    return (records.withColumn("__key", place).dropDuplicatesWithinWatermark(["__key"])
            .drop("__key", "arrived"))


def stream_into_fact(spark: SparkSession, directory: str, record: T.StructType, list_field: str, name: str,
                     root: str, checkpoint: str, key: str = "_id", within: str = "1 day",
                     status: str | None = "status", multiline: bool = True,
                     max_files: int | None = None) -> StreamingQuery:
    """Take up all files not seen yet into the states of the fact, then stop.

    The records are rows of the input ``name`` of the star (``gps``, say, which makes the latest position
    a running one). The state of the stream is the keys of the records of the last while
    (``new_records``); sums and positions are in the states of the warehouse ``root``. A micro-batch is
    merged under its own number, so one that is repeated after a failure counts once, and one that
    meets the commit of another stream is merged again on top of it.
    """
    payloads = read_payload_stream(spark, directory, record, list_field, status, multiline, max_files)

    def take(batch: DataFrame, number: int) -> None:
        taken = scratch_dir(spark, "records")
        batch.write.parquet(taken)  # its state is used once
        rows = spark.read.schema(batch.schema).parquet(taken)
        while True:
            try:
                incremental.merge(spark, root, {name: rows}, number + 1, source=f"stream {name}")
                break
            except warehouse.Conflict:
                continue
        filesystem.delete(spark, taken)

    return (new_records(payloads, list_field, key, within, status).writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
