"""Files of markdown, chunks and results, read with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = "file_name string, chunk_id string, chunk_type string, content string, artifact string, status string, global_chunk_id string"
RESULT = "question string, answer string, chunk_id long, context_status string, hop_count int, relevance_score string, difficulty_score string, error string"


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, text): every .md file below path, whole; the name is the file's without its ending."""
    t = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return t.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.md$", "").alias("file_name"), F.col("value").alias("text"))


FORMATS = r"(?i)\.(pdf|html?|xhtml)$"


def pick_documents(files: DataFrame, done: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """(file_name, path, length) of the PDF and HTML files among files (path, length), smallest first, without those whose file_name is in done; at most `most` of them."""
    f = files.select("path", "length").where(F.col("path").rlike(FORMATS)).withColumn("file_name", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))
    f = f if done is None else f.join(done.select("file_name").distinct(), "file_name", "left_anti")
    f = f.orderBy("length", "path")
    return (f if most is None else f.limit(most)).select("file_name", "path", "length")


def format_counts(files: DataFrame) -> DataFrame:
    """(format, files, bytes): the files (path, length) of each format that pick_documents takes, by their endings in lower case, and `other`."""
    kind = F.when(F.col("path").rlike(FORMATS), F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))).otherwise("other")
    return files.groupBy(kind.alias("format")).agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def list_documents(spark: SparkSession, path: str, done: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """pick_documents() of all files below path."""
    return pick_documents(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path), done, most)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of chunks; fields that are not in the schema are ignored."""
    return spark.read.schema(CHUNK).option("multiLine", True).json(path)


def load_results(spark: SparkSession, path: str, form: str = "array", schema: str = RESULT) -> DataFrame:
    """Results as a JSON array, as lines, or wrapped as {"qa_pairs": [...]}."""
    if form == "wrapped":
        return spark.read.schema(f"qa_pairs array<struct<{schema.replace(' ', ': ').replace(',: ', ', ')}>>").option("multiLine", True).json(path).select(F.inline("qa_pairs"))
    return spark.read.schema(schema).option("multiLine", form == "array").json(path)


def save_results(df: DataFrame, path: str, form: str) -> None:
    """Lines of JSON, CSV with a header, or Parquet."""
    if form == "csv":
        df.write.option("header", True).option("escape", '"').csv(path)
    else:
        df.write.format({"jsonl": "json", "parquet": "parquet"}[form]).save(path)
