"""Token counts of documents in flat token files without an index."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmill.llm.tokens import encoder
from visitmill.sinks.staging import scratch_path, stage

# Files hold unsigned little-endian ids of WIDTH bytes; the end of a document is an id that
# the vocabulary doesn't have.
WIDTH = 2
END = 65_535
# Bytes of a file that a task reads at once, and blocks whose sums are added up together.
BLOCK = 4 << 20
GROUP = 1024


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder as tasks open it, on the file system that Spark means by it.

    Spark takes a path without a scheme for one of its default file system, where tasks, which
    open token files by byte ranges, would take it for a local one. A file system that they
    can't open is refused.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    scheme, _, rest = system.makeQualified(path).toString().partition(":")
    if scheme == "file":
        return "/" + rest.lstrip("/")
    # One store under the name that Spark's connector has for it.
    uri = f"{scheme.replace('s3a', 's3')}:{rest}"
    try:
        fs.FileSystem.from_uri(uri)
    except (ValueError, OSError) as problem:
        raise ValueError(f"token files can't be kept at {uri}: {problem}") from problem
    return uri


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path there."""
    return fs.FileSystem.from_uri(path)


def written(docs: DataFrame, vocabulary: str, folder: str, end: int = END, width: int = WIDTH) -> DataFrame:
    """Write the ids of each row's text and `end` behind it: (file, ordinal, doc_id).

    Each task writes one flat file under a name of its own, which no other attempt has, and
    the result names the files of the attempts that count. A null text is empty. An id that
    `width` bytes don't hold, or that is the end mark, stops the job.
    """
    kind = f"<u{width}"
    if not 0 <= end < 1 << 8 * width:
        raise ValueError(f"{width} bytes don't hold the end mark {end}")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = encoder(vocabulary)
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.u{8 * width}"
        ordinal = 0
        with system.open_output_stream(f"{root}/{name}") as out:
            for batch in batches:
                for texts in vocab.encode(batch.column(1)):
                    whole = np.concatenate(texts)
                    if len(whole) and (whole.max() >= 1 << 8 * width or (whole == end).any()):
                        raise ValueError(f"a text has an id that {width} bytes don't hold, or the end mark {end}")
                    closed = np.full(len(whole) + len(texts), end, dtype=kind)
                    ends = np.cumsum([len(ids) for ids in texts])
                    place = np.ones(len(closed), dtype=bool)
                    place[ends + np.arange(len(texts))] = False
                    closed[place] = whole
                    out.write(closed)
                rows = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{folder}/{name}"] * rows, pa.string()),
                     pa.array(np.arange(ordinal, ordinal + rows)), batch.column(0)],
                    ["file", "ordinal", "doc_id"])
                ordinal += rows

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        each, "file string, ordinal long, doc_id long")


def blocks(files: DataFrame, block: int = BLOCK, width: int = WIDTH) -> DataFrame:
    """(file, block, first, length, size): the byte ranges of all files of a frame (file)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for path in batch.column(0).to_pylist():
                system, place = opened(path)
                sizes.append(system.get_file_info(place).size)
            if any(s is None or s % width for s in sizes):
                raise ValueError("a token file is missing or ends within a token")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64())], ["file", "size"])

    sized = files.select("file").distinct().mapInArrow(each, "file string, size long")
    return sized.where("size > 0").select(
        "file", "size", F.explode(F.expr(f"sequence(0L, (size - 1) div {block})")).alias("block")
    ).select("file", "block", (F.col("block") * block).alias("first"),
             F.least(F.lit(block), F.col("size") - F.col("block") * block).alias("length"), "size")


def separators(ranges: DataFrame, end: int = END, width: int = WIDTH) -> DataFrame:
    """(file, block, ends, closed): places of `end` in each byte range, in tokens from the file's start.

    The last range of a file whose last token is something else gets the file's end as one
    more place, and `closed` is false. A range is searched as a whole array.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, closed = [], []
            for row in batch.to_pylist():
                system, place = opened(row["file"])
                with system.open_input_file(place) as source:
                    source.seek(row["first"])
                    ids = np.frombuffer(source.read(row["length"]), f"<u{width}")
                places = np.flatnonzero(ids == end) + row["first"] // width
                last = row["first"] + row["length"] == row["size"]
                whole = not last or ids[-1] == end
                found.append(places if whole else np.append(places, row["size"] // width))
                closed.append(whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64())),
                 pa.array(closed, pa.bool_())], ["file", "block", "ends", "closed"])

    return ranges.mapInArrow(each, "file string, block long, ends array<long>, closed boolean")


def counted(
    spark: SparkSession, files: DataFrame, end: int = END, block: int = BLOCK, width: int = WIDTH
) -> DataFrame:
    """(file, ordinal, first, n_tokens, closed) of every document in flat token files.

    Each block is searched alone. What a block needs from those before it, the number of
    documents and the last separator, comes from a prefix scan in two steps: over groups of
    GROUP blocks of a file, then within a group; so a file of any length is no single
    task's work. n_tokens leaves the separator out. Equal separators in a row are empty
    documents; tokens behind the last one are a document that isn't closed. An empty file
    has none. The blocks are dealt evenly, whatever file they are of.
    """
    if block % width:
        raise ValueError("a block holds whole ids")
    ranges = stage(blocks(files, block, width))
    tasks = max(1, min(ranges.count(), spark.sparkContext.defaultParallelism * 16))
    found = stage(separators(ranges.repartition(tasks), end, width))
    sums = found.select(
        "file", "block", F.floor(F.col("block") / GROUP).alias("part"), F.size("ends").alias("n"),
        F.array_max("ends").alias("last"))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        sums.groupBy("file", "part").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        .select("file", "part", F.sum("n").over(before).alias("part_n"),
                F.max("last").over(before).alias("part_last")))
    inside = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "file", "block", "part", F.sum("n").over(inside).alias("n"), F.max("last").over(inside).alias("last")
    ).join(parts, ["file", "part"]).select(
        "file", "block",
        (F.coalesce("n", F.lit(0)) + F.coalesce("part_n", F.lit(0))).alias("ordinal0"),
        F.coalesce("last", "part_last", F.lit(-1)).alias("last0"))
    documents = found.where("size(ends) > 0").join(carried, ["file", "block"]).select(
        "file", "ordinal0", "last0", "ends", "closed", F.posexplode("ends").alias("k", "stop"))
    start = F.expr("if(k = 0, last0, ends[k - 1]) + 1")
    return documents.select(
        "file", (F.col("ordinal0") + F.col("k")).alias("ordinal"), start.alias("first"),
        (F.col("stop") - start).alias("n_tokens"),
        (F.col("closed") | (F.col("k") < F.size("ends") - 1)).alias("closed"))


def document_counts(
    docs: DataFrame, vocabulary: str, end: int = END, block: int = BLOCK, width: int = WIDTH
) -> DataFrame:
    """(doc_id, n_tokens) of each row of documents, by way of flat token files.

    The texts are written to files in the shared folder, as a tokenizing job would leave
    them, and counted from there; only the order within a file says which document it is.
    Rows with a null text have no tokens; repeated rows and null ids each give a row. The
    files go with those of the job around it (`staged_files`).
    """
    spark = docs.sparkSession
    folder = qualified(spark, scratch_path(spark, "tokens-"))
    listed = stage(written(docs, vocabulary, folder, end, width))
    return (
        listed.join(counted(spark, listed.select("file"), end, block, width), ["file", "ordinal"], "left")
        .select("doc_id", "n_tokens"))
