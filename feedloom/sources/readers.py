"""Batch and streaming readers with explicit schemas."""

from __future__ import annotations

import csv
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from feedloom.functions.text import listing_urls, page_url
from feedloom.operators.shape import union_all


def files_of(spark: SparkSession, path: str) -> list[str]:
    """Data files below a path or glob, on any file system Spark can reach."""
    wanted = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = wanted.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(wanted) or []:
        for child in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
            if child.isFile() and not child.getPath().getName().startswith(("_", ".")):
                found.append(child.getPath().toString())
    return sorted(found)


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names of one CSV file; only its first line is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        reader = spark._jvm.java.io.InputStreamReader(stream, "UTF-8")
        line = spark._jvm.java.io.BufferedReader(reader).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([(line or "").lstrip("\ufeff")]), ()))


def layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The catalogue of a feed: files by their header. Files without any line are left out."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file in files_of(spark, path):
        if header := header_of(spark, file):
            found.setdefault(header, []).append(file)
    return found


def _exact(file: str) -> str:
    """The name of one file as a path pattern that matches it alone."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", file)


def read_feed(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Header CSV files (a path or glob), each by its own header and exact column names, all read as text.

    Files of one layout are scanned together, so a feed is read once however many layouts it has. Columns
    outside the schema are dropped and absent ones are NULL; of a repeated name the last column counts. Names
    are matched case-sensitively because feeds may hold columns that differ in case only. Where quoted values
    hold line breaks, each file is read by one task; without ``multi_line`` large files are split.
    """
    parts = []
    for header, files in layouts(spark, path).items():
        positions = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        options = {"header": True, "escape": '"', "multiLine": multi_line}
        rows = spark.read.schema(positions).options(**options).csv([_exact(f) for f in files])
        at = {name: f"c{i}" for i, name in enumerate(header)}
        parts.append(rows.select(
            *[
                (F.col(at[f.name]) if f.name in at else F.lit(None)).cast("string").alias(f.name)
                for f in schema.fields
            ],
            F.col("_metadata.file_path").alias("source_file"),
        ))
    if not parts:
        texts = [T.StructField(f.name, T.StringType()) for f in schema.fields]
        return spark.createDataFrame([], T.StructType([*texts, T.StructField("source_file", T.StringType())]))
    return union_all(parts)


def read_feeds(spark: SparkSession, paths: list[str], schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Several feeds as one frame, aligned by name."""
    return union_all([read_feed(spark, p, schema, multi_line) for p in paths])


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, **options: str
) -> DataFrame:
    """CSV of a known layout. Multi-line fields keep a file in one task, so they are opt-in."""
    return spark.read.schema(schema).options(
        header=True, escape='"', multiLine=multi_line, **options
    ).csv(path)


def read_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    table = spark.table(name)
    return table if limit is None else table.limit(limit)


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed JSON documents, one per line."""
    return spark.read.schema(schema).json(path)


def read_any(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """Any batch source Spark has a connector for; the connector is a parameter."""
    return spark.read.format(fmt).options(**options).load(path)


def local_rows(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A small dimension from local rows, kept inside the plan."""
    columns = [list(c) for c in zip(*rows)] or [[] for _ in schema.fields]
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema.fields)]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_stream(
    spark: SparkSession, fmt: str, path: str | None = None, schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """A stream. How much a micro-batch takes is bounded by the source's own option, such as
    ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``; where it starts by ``startingOffsets``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def observations(spark: SparkSession, path: str, schema: T.StructType, files: int = 100) -> DataFrame:
    """Landed observation documents as one stream for all places."""
    return read_stream(spark, "json", path, schema, maxFilesPerTrigger=str(files))


def page_urls(df: DataFrame, url: str, pages: Column, out: str = "page_url", rows: bool = True) -> DataFrame:
    """The listing addresses 1..pages of every template address, one row each.

    Without ``rows`` the column ``url`` holds arrays of templates, and ``out`` all their addresses as one array, by
    page number and then address. They are built inside the row, so no address is shuffled to be put together again.
    """
    numbers = F.sequence(F.lit(1), pages)
    if rows:
        numbered = df.withColumn("page", F.explode(numbers))
        return numbered.withColumn(out, page_url(F.col(url), F.col("page")))
    lists = df.withColumn("_lists", F.transform(url, lambda u: listing_urls(u, numbers)))
    merged = F.flatten(F.transform(numbers, lambda n, i: F.sort_array(F.transform("_lists", lambda a: F.get(a, i)))))
    # One template has its addresses in order already.
    return lists.withColumn(out, F.when(F.size("_lists") == 1, F.col("_lists")[0]).otherwise(merged)).drop("_lists")
