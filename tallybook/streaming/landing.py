"""Landing from a stream of files: the same append of unseen rows, one micro-batch at a time.

Of a source that only ever adds files, each run reads just the files that came since the
last one, instead of the whole source. The query's checkpoint folder remembers which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallybook.plans.landing import append_new
from tallybook.sources.tables import TableRef


def land_stream(
    stream: DataFrame,
    target: TableRef,
    checkpoint: str,
    dedupe: bool = False,
    prune_on: str | None = None,
) -> StreamingQuery:
    """Append the unseen rows of everything the stream has now, then stop.

    A micro-batch that is run again after a failure finds the rows it has written before
    and adds none twice.
    """

    def land(batch: DataFrame, _: int) -> None:
        append_new(batch, target, dedupe=dedupe, prune_on=prune_on)

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", **options: str
) -> DataFrame:
    return spark.readStream.format(format).schema(schema).options(**options).load(path)
