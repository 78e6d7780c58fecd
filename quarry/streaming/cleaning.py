"""The row-local operators on a stream.

Cleaning and ledger entries read one row at a time, so a stream takes the batch code unchanged. Each micro-batch
is written together with its ledger; a batch number names its files, so a batch that runs again replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from quarry.operators.audit import Rule, ledger


def audited_stream(raw: DataFrame, clean: Callable[[DataFrame], DataFrame], source_id: str, key: str, rules: Sequence[Rule], silver_path: str, ledger_path: str) -> DataStreamWriter:
    """A writer to start: silver rows and ledger entries of every micro-batch, each exactly once."""

    def write(batch: DataFrame, number: int) -> None:
        silver = clean(batch).persist()
        silver.write.mode("overwrite").parquet(f"{silver_path}/batch={number}")
        ledger(silver, source_id, key, rules).write.mode("overwrite").parquet(f"{ledger_path}/batch={number}")
        silver.unpersist()

    return raw.writeStream.foreachBatch(write)
