"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import math
import os
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: A key counts as heavy from this share of all rows on, so there are at most 1 / HEAVY_SHARE heavy keys.
HEAVY_SHARE = 1e-3
#: Below this many rows a key is never heavy.
HEAVY_LEAST = 1000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir); a local one only where that is unset and there is no cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="foliospark-", dir=_local_base())
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _local_base() -> str:
    base = os.path.join(tempfile.gettempdir(), "checkpoints")
    os.makedirs(base, exist_ok=True)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/foliospark/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cuts the lineage: writes df as Parquet in the shared folder and reads it back.

    The files survive the loss of any executor, and later reads prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    release_driver(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Share of the driver's largest heap from which on its garbage is collected after a table is stored.
DRIVER_HEAP_SHARE = 0.5


def release_driver(spark: SparkSession) -> None:
    """Gives back to the system what the driver's JVM no longer holds.

    Hundreds of plans are made and compiled one after the other. Little of that stays, but the heap grows rather than being
    collected, and the compiler threads' freed memory stays with the allocator until it is told to return it.
    """
    jvm = spark._jvm
    runtime = jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > DRIVER_HEAP_SHARE * runtime.maxMemory():
        jvm.java.lang.System.gc()
    gateway = spark.sparkContext._gateway
    try:  # by reflection, as the server's own class is not open to others
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        call = gateway.new_array(jvm.java.lang.Object, 4)
        call[0], call[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), call)
    except Py4JJavaError:  # a JVM without this command keeps the memory
        pass


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a batch between executors and their Python workers, in place of Spark's default of eight times as many.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Long texts make large batches, which both sides hold several times over; a session that has set a size of its own keeps it."""
    if spark.conf.get(_BATCH) == "67108864b":  # Spark's default
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def with_ids(rows: DataFrame, column: str, run: Callable, schema: str) -> DataFrame:
    """mapInPandas over doc_id and a column, to doc_id and the schema. Ids travel as text: pandas makes floats of null ones."""
    bounded_batches(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType
    ids = rows.select(F.col("doc_id").cast("string").alias("doc_id"), column)
    return ids.mapInPandas(run, f"doc_id string, {schema}").withColumn("doc_id", F.col("doc_id").cast(kind))


def release_memory() -> None:
    """Gives back to the system what this process no longer holds: a reused Python worker would keep it through later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """The iterator function, after whose task the process holds as little as before: all that it kept is dropped, then given back."""

    @wraps(run)
    def tidied(batches):
        _prefer_maps()
        inner = run(batches)
        try:
            yield from inner
        finally:
            inner.close()
            del inner
            release_memory()

    return tidied


def _prefer_maps() -> None:
    """Large blocks of memory are to be mapped on their own, from a fixed size on, so that freeing them gives them back at once."""
    option = getattr(ctypes.CDLL(None), "mallopt", None)
    if option:
        option(-3, 1 << 16)  # M_MMAP_THRESHOLD
        option(-1, 1 << 17)  # M_TRIM_THRESHOLD


def crc_mod(key: str | Column, n: int) -> Column:
    """crc32 of the key's decimal text, modulo n; a null key counts as the empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def heavy_bar(total: int) -> int:
    """Rows from which a key is heavy: at most 1 / HEAVY_SHARE keys can reach it."""
    return max(HEAVY_LEAST, int(total * HEAVY_SHARE))


def hash_share(key: str, salt: str) -> Column:
    """A number in [0, 1) that depends on the key and the salt alone."""
    text = F.concat_ws(":", F.lit(salt), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


# ---- Bloom filters as bitmaps, segment by segment

#: The most bits of one bitmap of a filter; the two of them are 64 MB, which is what may be broadcast.
FILTER_BITS = 1 << 28
#: Slots of a filter for each key.
SLOTS_PER_KEY = 8
#: Bits of one binary value that bitmap_construct_agg makes.
CHUNK = 32768


def filter_slots(key: Column, bits: int) -> list[Column]:
    """The key's slot in each of the two bitmaps."""
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(bits)) for k in (0, 1)]


def filter_bits(keys: int, max_bits: int = FILTER_BITS) -> int:
    """Bits of each bitmap: a power of two, SLOTS_PER_KEY times the keys or more, within max_bits."""
    return min(max_bits, max(CHUNK, 1 << max(0, keys * SLOTS_PER_KEY - 1).bit_length()))


def segment_count(keys: int, max_bits: int = FILTER_BITS) -> int:
    """Segments, by hash, of so many keys, each of which has a filter of its own that fits max_bits."""
    return max(1, math.ceil(keys * SLOTS_PER_KEY / max_bits))


def segment_of(key: Column, segments: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(2)), F.lit(segments)).cast("int")


def bitmaps_of(slots: DataFrame) -> DataFrame:
    """__table, __chunk and __bits from rows of __table and __slot, stored."""
    grouped = slots.groupBy("__table", F.shiftright("__slot", 15).alias("__chunk"))
    return materialize(grouped.agg(F.bitmap_construct_agg(F.col("__slot").bitwiseAND(F.lit(CHUNK - 1))).alias("__bits")), "filter")


def probe(df: DataFrame, key: Column, bitmaps: DataFrame, bits: int, flag: str) -> DataFrame:
    """Adds flag: whether the bitmaps, at most 2 * bits bits and broadcast, have both slots of the key."""
    hits = []
    for k, slot in enumerate(filter_slots(key, bits)):
        own = bitmaps.filter(F.col("__table") == k).select(F.col("__chunk").alias(f"__c{k}"), F.col("__bits").alias(f"__b{k}"))
        df = df.withColumn(f"__s{k}", slot).withColumn(f"__c{k}", F.shiftright(f"__s{k}", 15)).join(F.broadcast(own), f"__c{k}", "left")
        at = F.col(f"__s{k}").bitwiseAND(F.lit(CHUNK - 1)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(f"__b{k}"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
        hits.append(F.coalesce(F.floor(byte / F.pow(F.lit(2.0), at.bitwiseAND(F.lit(7)))) % 2 == 1, F.lit(False)))
    return df.withColumn(flag, hits[0] & hits[1]).drop(*(f"__{x}{k}" for x in "scb" for k in (0, 1)))


def by_segment(df: DataFrame, key: Column, segments: int, each: Callable[[DataFrame, int], DataFrame], label: str) -> DataFrame:
    """each(rows of a segment, segment) over all segments.

    One segment stays part of the plan. Of several, the rows are stored by segment without a shuffle, each segment is read by
    itself, so that one pair of bitmaps is broadcast at a time, and the results are appended to one table.
    """
    if segments == 1:
        return each(df, 0)
    spark = df.sparkSession
    stored, out = scratch_path(spark, f"{label}-segments"), scratch_path(spark, label)
    df.withColumn("__segment", segment_of(key, segments)).write.partitionBy("__segment").parquet(stored)
    schema, wide = None, StructType([*df.schema.fields, StructField("__segment", IntegerType())])
    for k in range(segments):
        own = spark.read.schema(wide).parquet(stored).filter(F.col("__segment") == k).drop("__segment")
        found = each(own, k)
        schema = found.schema
        found.write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def flag_members(df: DataFrame, key: Column, keys: DataFrame, flag: str, max_bits: int = FILTER_BITS) -> DataFrame:
    """Adds flag: false only where keys (one column) lacks the key. A Bloom filter of at most 2 * max_bits bits is broadcast at a time."""
    name = keys.columns[0]
    n = keys.count()
    segments, bits = segment_count(n, max_bits), filter_bits(n, max_bits)

    def each(rows: DataFrame, k: int) -> DataFrame:
        own = keys.filter(segment_of(F.col(name), segments) == k) if segments > 1 else keys
        slots = own.select(F.posexplode(F.array(*filter_slots(F.col(name), bits))).alias("__table", "__slot"))
        return probe(rows, key, bitmaps_of(slots), bits, flag)

    return by_segment(df, key, segments, each, "flagged")
