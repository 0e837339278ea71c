"""What the operators share: the shared folder, written tables, byte files, the label split."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words in the contracts: space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
BATCH, ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1024


def small_batches(spark: SparkSession, size: str = "2m") -> None:
    """From now on in this session, Python workers get batches of about so many bytes at most, however long the rows are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of sf_dir. Rows hold whole texts, so that few of them go to a Python worker at once."""
    if int(spark.conf.get(BATCH)) > ROWS:
        spark.conf.set(BATCH, ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset a new one on the one machine of a local session."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ragset-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ragset-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df written to the shared folder and read again: later steps neither recompute it nor depend on its executors."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(run):
    """run, a function for mapInArrow, that at a task's end gives the memory which its Python worker no longer uses back to the system: the worker waits for other stages' tasks."""

    def whole(batches):
        yield from run(batches)
        import ctypes

        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)

    return whole


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as the text ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def files(uri: str):
    """(file system, path) of a URI, for byte ranges that Spark's readers do not offer."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def put_file(fs, path: str, tag: str):
    """An output stream and the function that gives the file its name; a repeated task replaces the whole file."""
    part = f"{path}.{tag}.part"
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    out = fs.open_output_stream(part)

    def done() -> None:
        out.close()
        fs.move(part, path)

    return out, done


def attempt() -> tuple[int, str]:
    from pyspark import TaskContext

    t = TaskContext.get()
    return (t.partitionId(), f"{t.taskAttemptId()}") if t else (0, "0")
