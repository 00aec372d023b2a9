"""Extension: the per-document operators over a stream of files (new documents in, occurrences out)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators import units


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def occurrences(stream: DataFrame, lists: dict[str, list[str]]) -> DataFrame:
    """Occurrences with list status; stateless, so late files need no watermark."""
    return units.classify(units.occurrences(units.units(stream)), lists)


def drain(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write all that is there and stop; a restart goes on where it ended."""
    q = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
