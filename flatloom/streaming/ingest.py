"""File streams that process what is there and stop, or keep waiting for more."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flatloom.plans.incremental import BATCH, Store, load_batch


def ingest(
    docs: DataFrame, store: Store, checkpoint: str, run: str, trigger: dict | None = None
) -> StreamingQuery:
    """Feed a document stream into a store, one batch at a time, all tables from each batch.

    ``run`` names the checkpoint: batch numbers start again with a new one, and the two
    together make the batch name. Files that another run has loaded are left out.
    """

    def one_batch(batch_docs: DataFrame, batch_id: int) -> None:
        load_batch(batch_docs, store, f"{run}-{batch_id}")

    writer = docs.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


# What the state of a seen set is kept in: RocksDB on the executors' disks, checkpointed by its changes.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings that a query takes over when it starts; the session has its own again afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def emit_new_keys(
    rows: DataFrame,
    key: str | Sequence[str],
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write each key when it is first seen, with a row that brought it: the smallest of its batch.

    The state has one row per key: the batch that brought it, by its time, and the row. A batch
    shrinks to one row per key before its shuffle, so a hot key does not gather its copies in one
    task; it then looks up its own keys, and what it checkpoints are their changes. So neither grows
    with the keys seen before. A key is new if no earlier batch has touched it. A batch writes its
    own folder and replaces it when it runs again; its time is in the checkpoint, so it then
    decides the same. Batches of one checkpoint form one run: what is seen is in its state.
    """
    names = [key] if isinstance(key, str) else list(key)
    attrs = [c for c in rows.columns if c not in names]
    arrived = F.current_timestamp().alias("_at")
    first = F.min(F.struct("_at", *attrs)).alias("_first")
    seen = rows.select(*names, *attrs, arrived).groupBy(*names).agg(first, F.max("_at").alias("_last"))

    def one_batch(touched: DataFrame, batch_id: int) -> None:
        fresh = touched.filter(F.col("_first._at") == F.col("_last"))
        found = fresh.select(*names, *(F.col(f"_first.`{a}`").alias(a) for a in attrs)).select(*rows.columns)
        found.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")

    writer = seen.writeStream.outputMode("update").foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    with _settings(rows.sparkSession, _STATE):
        return writer.trigger(**(trigger or {"availableNow": True})).start()
