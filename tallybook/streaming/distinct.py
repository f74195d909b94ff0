"""Distinct values of logs that only grow, kept between runs.

Each run reads the files that came since the last one, which the query's checkpoint folder remembers, and
adds what is new among their distinct rows to a ledger. The ledger is what plans take in place of
the log: as many rows as there are distinct values, however long the log is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallybook.functions import quoted
from tallybook.plans.landing import append_new
from tallybook.sources.tables import TableRef, is_ledger


def keep_distinct(
    stream: DataFrame, columns: Sequence[str], kept: TableRef, checkpoint: str
) -> StreamingQuery:
    """Add the distinct ``columns`` of everything the stream has now to the ledger ``kept``, then stop.

    Copies go map-side, before anything is shuffled; NULLs are values like others. A micro-batch that is
    run again after a failure adds nothing twice. A file that is changed in place isn't read again,
    and values of rows that are deleted from the log stay.
    """
    if not is_ledger(kept):
        raise ValueError(f"{kept.name} must be a ledger, which knows its rows by content")

    def add(batch: DataFrame, _: int) -> None:
        append_new(batch.distinct(), kept)

    return (
        stream.select(*[quoted(c) for c in columns])
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
