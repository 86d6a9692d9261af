"""Writers: overwrite, append, versioned replacement, keyed registry rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.functions.text import redact_keys


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def publish(df: DataFrame, root: str, version: str) -> str:
    """Writes a new version beside the old ones. A version counts from the moment its pointer file, of a name of its own, is complete, so readers find the old version or the new one and never neither."""
    root = root.rstrip("/")
    path, spark = f"{root}/v={version}", df.sparkSession
    known = [r["at"] for r in pointers(spark, root).collect()] if exists(spark, f"{root}/current") else []
    df.write.mode("errorifexists").parquet(path)
    pointer = spark.createDataFrame([(version, max(known, default=0) + 1)], "version STRING, at BIGINT")
    pointer.coalesce(1).write.mode("append").json(f"{root}/current")
    return path


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def pointers(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("version STRING, at BIGINT").json(f"{root.rstrip('/')}/current")


def read_published(spark: SparkSession, root: str) -> DataFrame:
    version = pointers(spark, root).orderBy(F.col("at").desc()).first()["version"]
    return spark.read.parquet(f"{root.rstrip('/')}/v={version}")


class Conflict(RuntimeError):
    """Somebody else published since the version that was read."""


def current(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number and version of the last commit; 0 and none before the first."""
    root = root.rstrip("/")
    if not exists(spark, f"{root}/commits"):
        return 0, None
    rows = spark.read.schema("at BIGINT, version STRING").json(f"{root}/commits").orderBy(F.col("at").desc()).limit(1).collect()
    return (rows[0]["at"], rows[0]["version"]) if rows else (0, None)


def commit(tables: dict[str, DataFrame], root: str, version: str, read_at: int) -> None:
    """Writes tables as one version and then commits it, all of them or none: readers see the old version up to the one
    file that names the new one. read_at is the commit that the tables were made from; if there is a later one, Conflict is
    raised and nothing changes. The file is created, never overwritten; where a store cannot refuse to overwrite, two
    writers at the same moment are not told apart."""
    root, spark = root.rstrip("/"), next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/v={version}/{name}")
    if current(spark, root)[0] != read_at:
        raise Conflict(f"{root} has moved on from commit {read_at}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/commits/{read_at + 1:012d}.json")
    try:
        out = path.getFileSystem(conf).create(path, False)
    except Exception as e:
        raise Conflict(f"{root} already has commit {read_at + 1}") from e
    out.write(bytearray(f'{{"at": {read_at + 1}, "version": "{version}"}}\n'.encode()))
    out.close()


def read_commit(spark: SparkSession, root: str, *names: str) -> tuple[int, dict[str, DataFrame]]:
    """Number and tables of the last commit."""
    at, version = current(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is committed in {root}")
    return at, {n: spark.read.parquet(f"{root.rstrip('/')}/v={version}/{n}") for n in names}


def upsert(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """existing with the rows of rows in place of those of the same key."""
    return existing.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


RUN_ROW = "run_id STRING, stage STRING, status STRING, seconds DOUBLE, tables MAP<STRING, BIGINT>, error STRING"


def run_row(spark: SparkSession, run_id: str, stage: str, seconds: float, tables: dict[str, int], error: str | None = None) -> DataFrame:
    """One row of the run log, for a stage that ended or failed; keys in the error are redacted."""
    row = spark.createDataFrame([(run_id, stage, "failed" if error else "completed", float(seconds), tables, error)], RUN_ROW)
    return row.withColumn("error", redact_keys(F.col("error"))).withColumn("at", F.current_timestamp())
