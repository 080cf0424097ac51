"""File listings, manifests and reports."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import first_text, trimmed

#: Extensions of audio files; fixed values.
AUDIO = ("wav", "mp3", "flac", "ogg", "m4a", "aac")


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing(spark: SparkSession, folder: str, extensions: tuple[str, ...] = AUDIO, recursive: bool = True) -> DataFrame:
    """Paths, sizes and times of a folder's files with these extensions in any case; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder).select("path", "length", "modificationTime")
    return with_extension(rows, extensions)


def with_extension(rows: DataFrame, extensions: tuple[str, ...] = AUDIO) -> DataFrame:
    """Rows whose path ends with one of the extensions, in any case."""
    name = F.element_at(F.split("path", "/"), -1)
    return rows.where(name.contains(".") & F.lower(F.element_at(F.split(name, r"\."), -1)).isin(*extensions))


def scratch(spark: SparkSession) -> str:
    """A new folder in the one that the session shares (spark.checkpoint.dir); only a local session may do without."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="wavelake-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared}/scratch-{uuid.uuid4().hex}"


def first_files(files: DataFrame, limit: int | None = None) -> DataFrame:
    """Files by path, in the order of their bytes; an empty listing is an error."""
    rows = files.orderBy("path")
    if files.isEmpty():
        raise FileNotFoundError("no files with these extensions")
    return rows.limit(limit) if limit else rows


def warm_up_split(files: DataFrame) -> DataFrame:
    """Files by path with their phase: the first warms up, the others are measured. Fewer than two are an error."""
    if files.limit(2).count() < 2:
        raise ValueError("two files at least")
    first = files.agg(F.min("path").alias("_first"))  # one row
    return files.join(F.broadcast(first), F.col("path") >= F.col("_first")).withColumn("phase", F.when(F.col("path") == F.col("_first"), "warmup").otherwise("benchmark")).drop("_first")


def prompts(rows: DataFrame, text: Column) -> DataFrame:
    """Prompts of JSON manifests: a list, or an object with ``prompts`` or ``items``; of strings, or objects with prompt, description or text.

    Empty prompts are left out; ``place`` is the position in the list.
    """
    body = F.when(F.trim(text).startswith("["), text).otherwise(first_text(F.get_json_object(text, "$.prompts"), F.get_json_object(text, "$.items")))
    items = rows.select("*", F.posexplode(F.from_json(body, "array<string>")).alias("place", "item"))
    described = first_text(*(F.get_json_object("item", f"$.{k}") for k in ("prompt", "description", "text")))
    # a text can begin with a brace too
    an_object = F.startswith("item", F.lit("{")) & F.get_json_object("item", "$").isNotNull()
    return items.withColumn("prompt", trimmed(F.when(an_object, described).otherwise(F.col("item")))).where("prompt <> ''").drop("item")


def resolved(rows: DataFrame, files: DataFrame, *candidates: Column) -> DataFrame:
    """The first candidate path that ``files`` (path) has, by priority, and whether it was the first; the last one if none exists.

    One equi-join over all candidates; Spark broadcasts the listing if it is small.
    """
    choices = rows.withColumn("_row", F.monotonically_increasing_id()).select("*", F.posexplode(F.array(*candidates)).alias("_place", "path"))
    found = choices.join(files.select("path", F.lit(True).alias("_there")).distinct(), "path", "left")
    rank = F.row_number().over(Window.partitionBy("_row").orderBy(F.col("_there").isNull(), F.when(F.col("_there"), F.col("_place")).otherwise(-F.col("_place"))))
    return found.withColumn("_rank", rank).where("_rank = 1").withColumn("select_frames", (F.col("_place") == 0) & F.col("_there").isNotNull()).drop("_rank", "_row", "_place", "_there")


def write_rows(rows: DataFrame, folder: str) -> None:
    """Appends rows as JSON lines, keys in order."""
    rows.select(*sorted(rows.columns)).write.mode("append").json(folder)


def read_rows(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(folder)


def write_summary(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(folder)


def read_summaries(spark: SparkSession, pattern: str, schema=None) -> DataFrame:
    """Summaries of several runs with the folder each came from."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader
    return reader.csv(pattern).withColumn("source_path", F.input_file_name())


def manifest(*columns: Column) -> Column:
    """One JSON object."""
    return F.to_json(F.struct(*columns))


def formatted(x: Column, digits: int = 3) -> Column:
    """Number as text with a fixed number of digits."""
    return F.format_string(f"%.{digits}f", x)
