"""Windows over a stream of files: tumbling, sliding and session windows behind a watermark, written to files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statlab.session import new_path


def read_stream(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None, kind: str = "parquet") -> DataFrame:
    """Files of a folder, or of a pattern that may name one file, as a stream; the schema is given, never inferred."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(kind).load(path)


def windowed(
    stream: DataFrame, time: str, late: str, aggregates: Sequence[Column], by: Sequence[str] = (),
    width: str | None = None, slide: str | None = None, gap: str | None = None,
) -> DataFrame:
    """``start, end``, the columns ``by`` and the aggregates of every window; works on streams and on tables.

    ``width`` alone gives tumbling windows, with ``slide`` sliding ones, ``gap`` sessions that end when nothing came for so
    long. On a stream a window is handed on once the greatest time of earlier batches is ``late`` past its end; rows of later
    batches that belong to it are dropped. Rows without a time are in no window.
    """
    if (width is None) == (gap is None):
        raise ValueError("either width or gap")
    at = F.session_window(time, gap) if gap else F.window(time, width, slide) if slide else F.window(time, width)
    known = stream.where(F.col(time).isNotNull())
    if known.isStreaming:
        known = known.withWatermark(time, late)
    name = "session_window" if gap else "window"
    grouped = known.groupBy(at, *by).agg(*aggregates)
    return grouped.select(F.col(f"{name}.start").alias("start"), F.col(f"{name}.end").alias("end"), *[c for c in grouped.columns if c != name])


def run_available(result: DataFrame, path: str, checkpoint: str) -> None:
    """Handle all that has come so far, append what is finished to Parquet files, and stop.

    The checkpoint remembers files that were read, windows that are open and batches that were written, so a run after a stop, also
    one in the middle of a batch, goes on from there and writes nothing twice.
    """
    query = result.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()


def finished(result: DataFrame, label: str) -> DataFrame:
    """The rows a stream gives for all that is there now, as a table; its files are in the shared folder."""
    spark = result.sparkSession
    path, checkpoint = new_path(spark, label), new_path(spark, f"{label}-state")
    run_available(result, path, checkpoint)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):  # no file has come yet
        return spark.createDataFrame([], result.schema)
    return spark.read.schema(result.schema).parquet(path)
