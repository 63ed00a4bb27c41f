"""Load staged batches as their files arrive.

Each micro-batch takes the batch job's insert: complete rows that the facts do
not hold yet.  A batch replayed after a failure therefore adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from salesmart.contracts import CONTRACTS
from salesmart.plans.incremental import rows_to_insert, within_batch
from salesmart.plans.jobs import Warehouse


def load_arrivals(spark: SparkSession, incoming: str, root: str, checkpoint: str) -> StreamingQuery:
    """Work off every staged file that is there now, then stop."""
    house = Warehouse(spark, root)

    def insert(batch: DataFrame, batch_id: int) -> None:
        known = within_batch(batch, house.read("FactSales"))
        house.write("FactSales", rows_to_insert(batch, known), f"load_arrivals {batch_id}", append=True)

    arriving = spark.readStream.schema(CONTRACTS["FactSales_IncrementalBatch"]).parquet(incoming)
    return (
        arriving.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
