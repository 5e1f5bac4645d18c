"""Written tables in the shared folder, bounded bitmaps for broadcasting, and bounded samples."""

from __future__ import annotations

import atexit
import contextlib
import gc
import pickle
import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_work").rstrip("/")


class Carried:
    """A broadcast value that may hold classes of this subpackage.

    Broadcasts name classes, so a worker that cannot import the subpackage could not read them. This one is sent as
    bytes that carry the code of its classes along. A task reads the bytes from the worker's file and does not keep
    them beside what they hold.
    """

    def __init__(self, spark: SparkSession, value: object):
        self._held = None
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if self._held is None:
            self._held = pickle.loads(self._sent.value)
            vars(self._sent).pop("_value", None)
        return self._held

    def __getstate__(self) -> dict:
        return {"_held": None, "_sent": self._sent}


#: Folder of each written table, with a weak reference of the JVM to the relation that reads it.
_HELD: dict[str, object] = {}


def fresh_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark)}/tallyloom-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and kept as a Parquet table in the shared folder.

    Later reads start from the files, so a lost executor costs no recomputation of what came before. The files are
    deleted when no plan can read them any more; see sweep.
    """
    spark = df.sparkSession
    path = fresh_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    sweep(spark)
    return tracked(spark, path, df.schema)


def tracked(spark: SparkSession, path: str, schema: object) -> DataFrame:
    """The Parquet table at path, whose files go when nothing can read them any more."""
    table = spark.read.schema(schema).parquet(path)
    relation = table._jdf.queryExecution().analyzed().relation()
    _HELD[path] = spark._jvm.java.lang.ref.WeakReference(relation)
    return table


def sweep(spark: SparkSession, collect: bool = False) -> None:
    """Delete written tables that no plan in the driver reads any more.

    Plans of lazy results hold the relations they read, however they were derived, so these tables stay. With collect,
    garbage is collected first: then all tables go whose DataFrames are out of scope, and so do shuffle files.
    """
    if collect:
        gc.collect()
        spark._jvm.System.gc()
    for path in [p for p, relation in _HELD.items() if relation.get() is None]:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    _HELD.pop(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


@atexit.register
def _leave_nothing() -> None:
    """At the end of the driver nothing can read a written table."""
    with contextlib.suppress(Exception):  # the JVM may have ended before
        spark = SparkSession.getActiveSession()
        for path in list(_HELD):
            _delete(spark, path)


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bit set of a 64-bit hash column, 2**bits long: a one-hash Bloom filter of fixed size.

    The size does not depend on the data. More members only mean that more candidates pass.
    """
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        df.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("set"))
        .toArrow()
    )
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[rows["word"].to_numpy()] = rows["set"].to_numpy().view(np.uint64)
    return words


def map_bits(members: int, most: int = 27) -> int:
    """Bits (as a power of two) of a bitmap with 16 places or more for each member, and no more than 2**most."""
    return min(most, max(16, (16 * members).bit_length()))


def in_bitmap(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each 64-bit hash, whether its bit is set."""
    place = hashes & np.uint64(words.size * 64 - 1)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def sampled(df: DataFrame, rows: int, seed: int = 7) -> DataFrame:
    """About rows of df at most, drawn evenly; all of it if it has no more."""
    total = df.count()
    return df if total <= rows else df.sample(fraction=rows / total, seed=seed)


def sampled_by(df: DataFrame, rows: int, key: str) -> DataFrame:
    """About rows of df, or all of it if it has no more: those whose key has the least hashes.

    Which rows they are depends on keys and their number only, not on partitions.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 31)) < F.lit(int(rows / total * (1 << 31))))


def commonest(df: DataFrame, measure: str, entries: int) -> DataFrame:
    """Rows of df with the highest measure, at most entries of them; see parted."""
    return parted(df, measure, entries)[0]


def parted(df: DataFrame, measure: str, entries: int) -> tuple[DataFrame, DataFrame, bool]:
    """Rows of df with the highest measure, at most entries of them, the other rows, and whether there are any.

    The least measure to keep comes from a histogram over steps of an eighth of a doubling, so no task and not the
    driver sorts or gathers candidates. Where a step would pass the bound, as many of its rows are kept as fit, by a
    second histogram over a hash of the row.
    """
    step = F.floor(8 * F.log2(measure))
    part = F.pmod(F.xxhash64(*df.columns), F.lit(1024))
    steps = sorted(((r.step, r["count"]) for r in df.groupBy(step.alias("step")).count().collect()), reverse=True)
    room, last = entries, None
    for at, n in steps:
        if n > room:
            last = at
            break
        room -= n
    if last is None:
        return df, df.limit(0), False
    parts = sorted((r.part, r["count"]) for r in df.where(step == last).groupBy(part.alias("part")).count().collect())
    first = 0
    for at, n in parts:
        if n > room:
            break
        room, first = room - n, at + 1
    top = (step > last) | ((step == last) & (part < first))
    return df.where(top), df.where(~top), True
