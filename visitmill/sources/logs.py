"""Raw logs and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw log lines as column `value`, of a folder, a glob or a list of files."""
    return spark.read.text(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, share: float = 1.0,
    bad_line: str | None = None,
) -> DataFrame:
    """JSON records, one a line. Without a schema it is that of `inferred_json_schema`.

    With `bad_line`, a column of that name holds the text of each line that is no record or
    whose values don't fit the schema, and is NULL for the others; without, such lines give
    NULLs. Fields that a record lacks are NULL. (A query that reads nothing but that column is
    refused by Spark; stage the rows before.)
    """
    schema = schema or inferred_json_schema(spark, path, share)
    reader = spark.read
    if bad_line is not None:
        schema = T.StructType([*schema, T.StructField(bad_line, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", bad_line)
    return reader.schema(schema).option("mode", "PERMISSIVE").json(path)


def inferred_json_schema(spark: SparkSession, path: str, share: float = 1.0) -> T.StructType:
    """The fields of all JSON records of a share of the files, with a type that holds all values.

    The files of the share go by a hash of their names, at least one of them. Fields that
    only other files have are not found, so the share is all files by default, at the price
    of a second pass. Lines that are no records add nothing.
    """
    if not 0 < share <= 1:
        raise ValueError("share is above 0 and at most 1")
    files: str | list[str] = path
    if share < 1:
        listed = spark.read.format("binaryFile").load(path).select(
            "path", F.pmod(F.xxhash64("path"), F.lit(1_000_000)).alias("place"))
        files = [r["path"] for r in listed.where(F.col("place") < share * 1_000_000).collect()]
        if not files:
            files = [r["path"] for r in listed.orderBy("place", "path").limit(1).collect()]
    found = spark.read.option("mode", "DROPMALFORMED").json(files).schema
    return T.StructType([f for f in found if f.name != "_corrupt_record"])


def read_json_objects(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line as text in column `json`, for the key/value functions."""
    return spark.read.text(path).withColumnRenamed("value", "json")
