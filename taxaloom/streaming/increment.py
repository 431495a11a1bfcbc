"""Species-by-cell counts kept up to date from a stream of records, and append-only logs read as they grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from taxaloom.operators.species import CELLS, species_hex


def record_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New parquet files of a folder, a bounded number for each step."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(path)


def keep_species_hex(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add each step's counts as one folder named by the step: a step that runs again replaces its own."""

    def step(batch: DataFrame, number: int) -> None:
        species_hex(batch).write.mode("overwrite").parquet(f"{path}/step={number}")

    return records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_species_hex(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all steps together."""
    return spark.read.parquet(path).groupBy("specieskey", "year", *CELLS).agg(F.sum("occurrences").alias("occurrences"))


def windowed_counts(events: DataFrame, time: str, key: str, width: str, late: str) -> DataFrame:
    """Counts in tumbling windows; rows later than `late` are left out once their window is closed."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))


def once_per_id(answers: DataFrame, time: str, late: str) -> DataFrame:
    """The first line of each id of an append-only log within the watermark."""
    return answers.withWatermark(time, late).dropDuplicatesWithinWatermark(["id"])
