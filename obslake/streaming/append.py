"""Files arriving over time go through the same insert-if-absent as a batch load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from obslake.sources.tables import insert_if_absent


def append_new_rows(
    stream: DataFrame, path: str, key: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Insert every micro-batch, once per key. A replayed batch adds nothing.

    Takes all files present, then stops; run it again for files that came later.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        insert_if_absent(batch, path, key)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
