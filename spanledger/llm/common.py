"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, a temporary one is set in local mode alone: on a cluster, executors would not share it."""
    sc = spark.sparkContext
    folder = sc._jsc.sc().getCheckpointDir()
    if folder.isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
        folder = sc._jsc.sc().getCheckpointDir()
    return folder.get().rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage by files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df as Parquet in a new folder beside the checkpoints: like a checkpoint, but compressed and read by columns."""
    path = f"{shared_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Rows of one Arrow batch: with texts of a few KB some MB, which JVM and Python each hold once or twice per task.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch size to BATCH_ROWS; a smaller one stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def arrow(f: Callable, kind: str) -> Callable:
    """f over Arrow arrays as a function of columns."""
    small_batches(SparkSession.active())
    return F.arrow_udf(f, kind)


def slices(values: pa.Array, max_bytes: int = 4 << 20) -> Iterator[list]:
    """The values of a binary or string array as lists of at most about max_bytes, so that no batch of long texts is held twice."""
    out, held = [], 0
    for v in values:
        v = v.as_py()
        out.append(v)
        held += len(v) if v else 0
        if held >= max_bytes:
            yield out
            out, held = [], 0
    if out:
        yield out


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df does not have, whatever the case."""
    have, name = {c.lower() for c in df.columns}, stem
    while name.lower() in have:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bounded_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """At most n rows, chosen by the hash of key: a top-n, which no task holds whole."""
    return rows.orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key)).limit(n)


#: Bytes up to which a table is broadcast.
BROADCAST_BYTES = 64 << 20


def weight(rows: DataFrame) -> Column:
    """About the bytes of a row in memory."""
    width = {"string": F.octet_length, "binary": F.octet_length, "array": lambda c: F.size(c) * 48}
    return sum((F.coalesce(width[kind](F.col(f"`{name}`")), F.lit(0)) if kind in width else F.lit(0) for name, kind in ((f.name, f.dataType.typeName()) for f in rows.schema.fields)), F.lit(16 * len(rows.columns)))


def table_bound(rows: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """rows, to be broadcast if their measured bytes are at most so many; else left to a shuffle join."""
    return F.broadcast(rows) if (rows.agg(F.sum(weight(rows).cast("bigint"))).first()[0] or 0) <= most else rows


#: Keys that are joined by broadcast because most rows have them, and the fewest rows of such a key.
HOT_KEYS, HOT_ROWS = 1000, 300


def hot_join(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined to a table of one row per key. The (at most HOT_KEYS) keys of most rows meet a broadcast, so that none fills a task; what is left holds at most 1 in HOT_KEYS of all rows per key. rows and table are read twice: pass checkpoints."""
    hot = F.broadcast(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNotNull() & (F.col("n") >= HOT_ROWS)).orderBy(F.col("n").desc(), key).limit(HOT_KEYS).select(key))
    often = F.broadcast(table.join(hot, key, "left_semi"))
    return rows.join(hot, key, "left_semi").join(often, key, how).unionByName(rows.join(hot, key, "left_anti").join(table, key, how))
