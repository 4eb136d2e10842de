"""Work on groups of rows as Arrow tables, streamed one group at a time through sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillmark.llm.rows import give_back, releasing

Batches = Iterator[pa.RecordBatch]


def _key_changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    changed = np.zeros(max(0, batch.num_rows - 1), bool)
    for key in keys:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        changed |= values[1:] != values[:-1]
    return np.flatnonzero(changed) + 1


def groups(batches: Batches, keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches in order of key."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = [0, *_key_changes(batch, keys).tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:], strict=False):
            part = batch.slice(start, end - start)
            if parts and any(parts[-1].column(k)[0] != part.column(k)[0] for k in keys):
                yield pa.Table.from_batches(parts)
                parts = []
            parts.append(part)
        del batch
        give_back()
    if parts:
        yield pa.Table.from_batches(parts)


def map_groups(rows: DataFrame, keys: list[str], run: Callable[[Iterator[pa.Table]], Batches], schema: str) -> DataFrame:
    """Bring the rows of each key together and run over the groups of each partition, one at a time."""

    def over(batches: Batches) -> Batches:
        return run(groups(batches, keys))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(releasing(over), schema)


def bucket_count(rows: DataFrame) -> int:
    """Buckets that hashes are dealt into: as many as the session's shuffles have partitions, so that it grows with them."""
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
