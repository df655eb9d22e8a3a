"""Append newly landed sales files to the stored sales table.

A Structured Streaming file source tracks which files it has already read
(in its checkpoint), and the parquet file sink commits each micro-batch
exactly once, so re-running the job only appends the files that arrived
since the last run.  ``availableNow`` processes what is there and stops,
which suits a scheduled batch pipeline.  ``append_once`` also recognises
rows that a second file delivers again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import period
from ..sources import schemas


def append_new_sales(spark: SparkSession, landing_dir: str, table_path: str,
                     checkpoint_location: str | None = None, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> None:
    """Copy files that landed in ``landing_dir`` since the last run into ``table_path``.

    Rows are cast to the sales schema.  The stream's own record of files read and batches
    written belongs to the table; by default it is kept beside it, under a name that every
    run derives alike.
    """
    ckpt = checkpoint_location or f"{table_path.rstrip('/')}_ingest_state"
    reader = spark.readStream.schema(schemas.SALES).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = schemas.conform(reader.load(landing_dir), schemas.SALES)
    q = (stream.writeStream.format("parquet")
         .option("path", table_path)
         .option("checkpointLocation", ckpt)
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


#: month of rows without a date
NO_MONTH = "none"


def append_once(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_location: str | None = None,
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> None:
    """As :func:`append_new_sales`, but safe against rows delivered or written twice.

    A row's key is its whole content.  The table holds a content as often as the one file that has it
    most often, so copies within a file are kept, and the same rows under another file name add
    nothing.  A batch appends what the table lacks, as found in the months the batch touches; so one that
    is run again after its rows were written, all or some, adds the rest only.  Copies are
    counted, never brought together: a content that fills a file is one row of a group.

    The table has the sales columns, ``row_key`` and ``period``, by which it is partitioned.
    """
    ckpt = checkpoint_location or f"{table_path.rstrip('/')}_ingest_state"
    reader = spark.readStream.schema(schemas.SALES).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(landing_dir).select("*", F.col("_metadata.file_path").alias("__file"))
    (rows.writeStream.foreachBatch(lambda batch, _: append_missing(batch, table_path))
     .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())


def append_missing(batch: DataFrame, table_path: str) -> None:
    """Append the rows of ``batch`` (sales columns and ``__file``) that the table does not hold yet."""
    spark = batch.sparkSession
    batch = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SALES.fields], "__file")
    content = F.struct(*[F.col(c) for c in schemas.SALES_COLUMNS])
    key = F.sha2(F.to_json(content, {"ignoreNullFields": "false"}), 256)
    month = F.coalesce(period(F.col("transaction_date")), F.lit(NO_MONTH))
    keyed = batch.select(
        month.alias("period"), key.alias("row_key"), content.alias("row"), "__file")
    wanted = (keyed.groupBy("period", "row_key", "__file").agg(F.count(F.lit(1)).alias("n"), F.any_value("row").alias("row"))
              .groupBy("period", "row_key").agg(F.max("n").alias("n"), F.any_value("row").alias("row")))
    touched = [r.period for r in keyed.select("period").distinct().collect()]  # months, as many as the calendar has
    stored = T.StructType([*schemas.SALES.fields, T.StructField("row_key", T.StringType()), T.StructField("period", T.StringType())])
    try:
        held = spark.read.schema(stored).parquet(table_path).where(F.col("period").isin(touched))
        held = held.groupBy("period", "row_key").agg(F.count(F.lit(1)).alias("have"))
        wanted = wanted.join(held, ["period", "row_key"], "left")
    except AnalysisException:  # the first batch makes the table
        wanted = wanted.withColumn("have", F.lit(0))
    lacking = F.col("n") - F.coalesce("have", F.lit(0))
    rows = wanted.where(lacking > 0).select("row.*", "row_key", "period", F.explode(F.sequence(F.lit(1), lacking)).alias("__k"))
    rows.drop("__k").hint("rebalance", F.col("period")).write.mode("append").partitionBy("period").parquet(table_path)
