"""New files of a folder as commits of a versioned table, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gneiss.sources.versioned import VersionedTable


def ingest(stream: DataFrame, table: VersionedTable, checkpoint: str) -> StreamingQuery:
    """Commit every micro-batch under its epoch; an epoch that is replayed after a failure finds its commit and adds nothing."""

    def commit(batch: DataFrame, epoch: int) -> None:
        table.commit(f"epoch-{epoch:012d}", batch)

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
