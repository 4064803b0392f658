"""Batch writers. Nothing is collected to write it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from feedloom.operators.shape import keyed_json, markers

SNAPSHOT_ROWS = 100
# Versions of a published result that stay.
VERSIONS = 3


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a metastore table."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header per file. Arrays are written as JSON text."""
    arrays = [n for n, t in df.dtypes if t.startswith(("array", "struct", "map"))]
    plain = df.withColumns({c: F.to_json(c) for c in arrays}) if arrays else df
    plain.write.mode(mode).options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    write_csv(df, path, "append")


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def snapshot(
    df: DataFrame, base: str, stamp: str, columns: list[str], order: list, rows: int = SNAPSHOT_ROWS
) -> str:
    """The first rows of a listing under a folder named by batch time."""
    path = f"{base}/batch_ts={stamp}"
    write_csv(df.select(*columns).orderBy(*order).limit(rows), path)
    return path


def publish(df: DataFrame, fmt: str, path: str | None = None, key: str = "id", **options: str) -> None:
    """Rows as JSON messages keyed by id, which spreads them over all partitions of a broker topic."""
    messages = keyed_json(df, key)
    if fmt == "text":
        messages = messages.select("value")
    messages.write.format(fmt).options(**options).mode("append").save(path)


def write_features(df: DataFrame, path: str, *partition_by: str) -> None:
    """Feature table on any file system Spark can reach, ``s3a://`` included."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_markers(df: DataFrame, path: str, label: str) -> None:
    markers(df, label).write.mode("overwrite").text(path)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder, replacing the target: it steps aside and goes only once the new one is in place."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    old, new, aside = path(source), path(target), path(f"{target}.replaced-{uuid.uuid4().hex}")
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = fs.exists(new)
    if replaced and not fs.rename(new, aside):
        raise OSError(f"cannot set {target} aside")
    try:
        if not fs.rename(old, new):
            raise OSError(f"cannot rename {source} to {target}")
    except Exception:
        if replaced:
            fs.rename(aside, new)
        raise
    if replaced:
        fs.delete(aside, True)


def publish_latest(df: DataFrame, path: str) -> dict[str, object]:
    """Replace the "latest" result only after the new one is fully written."""
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    try:
        write_csv(df, staged)
        rename(df.sparkSession, staged, path)
    except Exception as failure:
        return {"statusCode": 500, "body": {"message": "publish failed", "reason": str(failure)}}
    return {"statusCode": 200, "body": {"message": f"result saved to {path}"}}


def _markers(spark: SparkSession, path: str) -> list[str]:
    """Names of the commit markers of a versioned result, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _version_of(path: str, marker: str) -> str:
    return f"{path}/versions/{marker.split('-')[1]}"


def latest_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that the last marker names; None before the first one."""
    names = _markers(spark, path)
    return _version_of(path, names[-1]) if names else None


def publish_version(df: DataFrame, path: str, keep: int = VERSIONS) -> dict[str, object]:
    """Write a version of a result, then make it the latest by creating one empty marker.

    Readers resolve ``latest_version``, so they see the old result or the new one and never none. A marker has a number
    and its version in its name: nothing is renamed or overwritten, which object stores cannot do at once. The last
    ``keep`` versions stay for readers that have resolved them.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    try:
        write_csv(df, f"{path}/versions/{version}")
        names = _markers(spark, path)
        marker = f"{int(names[-1].split('-')[0]) + 1 if names else 0:012d}-{version}"
        fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(jvm_path(f"{path}/commits"))
        fs.createNewFile(jvm_path(f"{path}/commits/{marker}"))
        for old in [*names, marker][:-keep]:
            fs.delete(jvm_path(f"{path}/commits/{old}"), False)
            fs.delete(jvm_path(_version_of(path, old)), True)
    except Exception as failure:
        return {"statusCode": 500, "body": {"message": "publish failed", "reason": str(failure)}}
    return {"statusCode": 200, "body": {"message": f"result saved to {path}", "version": version}}


def preview(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)


def bounded_rows(df: DataFrame, most: int) -> list[Row]:
    """Collect a result that must be small; more rows than ``most`` is an error, never a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"result has more than {most} rows; write it instead")
    return rows
