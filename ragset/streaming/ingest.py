"""New documents cut to windows once each, resumable: the stream keeps the keys that it has seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ragset.operators.chunking import char_windows

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ingest_windows(spark: SparkSession, source: str, out: str, checkpoint: str, window: int = 1000, overlap: int = 100, schema: str | StructType = DOCUMENT, key: str = "doc_id") -> DataFrame:
    """Reads what is new in source to the end, writes its windows to out, and returns all windows there.

    A document counts once, by its key, in whatever files and runs it comes again: the keys are state of the stream,
    kept on disk with its checkpoint. A row without a key goes by its text. Each batch writes a folder of its own, whole or
    anew, so that a batch that is repeated after a failure replaces what it left.
    """
    keyed = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.concat(F.lit("t"), F.sha2(F.coalesce("text", F.lit("")), 256)))
    docs = spark.readStream.schema(schema).parquet(source).withColumn("_key", keyed).dropDuplicates(["_key"]).select("doc_id", F.col("source").alias("dataset"), "text")

    def put(batch: DataFrame, number: int) -> None:
        char_windows(batch, window, overlap).write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)  # a run takes the setting as it starts
    try:
        run = docs.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(STORE, before)
    run.awaitTermination()
    return spark.read.schema(char_windows(spark.createDataFrame([], "doc_id long, dataset string, text string"), window, overlap).schema).parquet(out)
