"""Sharding by fixed virtual slots and a versioned slot-to-shard map (DataFrame functions only).

Records are hashed by id into ``SLOTS`` virtual slots, bytes and rows are summed per slot, and the slots are dealt to
the shards largest first, each to the shard with the fewest bytes so far. The map is a stored table of one row per slot
and version: records that come later are placed by a stored version and none moves. Rebalancing appends a version:
growing by a shard moves only the slots that the new shard takes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewkit.llm.components import stored
from reviewkit.session import scratch_path

#: Virtual slots; fixed for the life of a dataset, whatever the number of shards.
SLOTS = 4096
#: Bytes a record has besides its text.
RECORD_BYTES = 16
_P = "__slot_"


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(RECORD_BYTES)


def virtual_slot(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """Hash of id and text, so that records without id, or with one that many share, spread."""
    return F.pmod(F.xxhash64(doc_id, text), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame) -> DataFrame:
    """records (vslot, size) -> (vslot, bytes, n): one row per slot that has records."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))


def _folded(by_slot: DataFrame) -> DataFrame:
    """All slots as one array, largest first (4,096 entries at most, whatever the data)."""
    return by_slot.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("bytes")).alias("minus"), "vslot")), asc=True).alias("slots"))


def deal(by_slot: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map, (vslot, shard): largest slot first to the shard with the fewest bytes (ties: lowest)."""
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"),
                     F.array().cast("array<struct<vslot:int,shard:int>>").alias("put"))

    def step(acc: Column, slot: Column) -> Column:
        to = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int")
        load = F.transform(acc["load"], lambda x, i: F.when(i == to - 1, x - slot["minus"]).otherwise(x))
        return F.struct(load.alias("load"), F.concat(acc["put"], F.array(F.struct(
            slot["vslot"].alias("vslot"), (to - 1).alias("shard")))).alias("put"))

    return _folded(by_slot).select(F.inline(F.aggregate("slots", start, step)["put"]))


def grow(by_slot: DataFrame, mapped: DataFrame, shards: int) -> DataFrame:
    """The next version of the map with one more shard: (vslot, shard).

    Every old shard gives slots, smallest first, while it keeps at least its new fair share of the bytes; all
    of them go to shard number ``shards``. No other slot moves.
    """
    sized = by_slot.join(mapped, "vslot")
    total = sized.agg((F.sum("bytes") / F.lit(shards + 1)).alias("fair"))
    up = Window.partitionBy("shard").orderBy("bytes", "vslot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("shard")
    given = F.sum("bytes").over(up)
    return (sized.select("vslot", "shard", given.alias("given"), F.sum("bytes").over(whole).alias("all"))
            .crossJoin(F.broadcast(total))  # one row
            .select("vslot", F.when(F.col("all") - F.col("given") >= F.col("fair"), F.lit(shards))
                    .otherwise(F.col("shard")).cast("int").alias("shard")))


def save_version(mapped: DataFrame, path: str, version: int) -> None:
    """Append a version of the map, (vslot, shard) of all slots, to the table at ``path``.

    It is one file of ``SLOTS`` rows, so a version is there as a whole or not at all.
    """
    mapped.select(F.lit(version).alias("version"), "vslot", "shard").coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_version(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, DataFrame] | None:
    """The named or latest stored version: its number and (vslot, shard). None if there is no such version."""
    try:
        table = spark.read.schema("version int, vslot int, shard int").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    number = table.agg(F.max("version")).first()[0] if version is None else version
    mapped = table.where(F.col("version") == F.lit(number)).select("vslot", "shard")
    return None if number is None or mapped.isEmpty() else (number, mapped)


def _with_empty(mapped: DataFrame, rule: Column) -> DataFrame:
    """A map of the slots that have records, and of all others by ``rule`` of vslot."""
    every = mapped.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("vslot"))
    return mapped.select("vslot", "shard").unionByName(
        every.join(mapped, "vslot", "left_anti").select("vslot", rule.cast("int").alias("shard")))


def grow_map(docs: DataFrame, path: str) -> int:
    """Append the next version to the map at ``path``, with one more shard; its number.

    The slots are weighed by ``docs``. Of the slots without records, one in as many as there are shards goes to the new one.
    """
    latest = load_version(docs.sparkSession, path)
    if latest is None:
        raise ValueError(f"no slot map at {path}")
    version, mapped = latest
    shards = mapped.agg(F.max("shard")).first()[0] + 1
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    by_slot = stored(slot_bytes(docs.select(record_size(text).alias("size"), virtual_slot(doc_id, text).alias("vslot"))), "slots")
    idle = mapped.join(by_slot, "vslot", "left_anti").select("vslot", F.when(
        F.col("vslot") % (shards + 1) == shards, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"))
    # Stored before the append, which writes to the table that it is read from.
    save_version(stored(grow(by_slot, mapped, shards).unionByName(idle), "grown"), path, version + 1)
    return version + 1


def assign_shards(docs: DataFrame, shards: int = 40, keep: bool = False, map_path: str | None = None,
                  version: int | None = None) -> DataFrame:
    """Each document's shard, under the law ``bytes``: sizes near equal.

    ``docs`` needs ``doc_id`` and ``text``. Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law,
    shard (0 to ``shards`` - 1), slot (position in the shard, gapless from 0), grown_shard (null: the law ``key`` does not
    hold), vslot (virtual slot), map_version, next_shard (as :func:`grow_map` would place it, with one more shard). With ``keep``, the
    input's columns and shard, slot, vslot.

    ``map_path`` names the stored map: its latest version, or ``version``, places the records, and ``shards`` is then the map's own
    number. A path without a map gets version 1, dealt by these records; without ``map_path`` that is a new table in the work folder.

    Null text: size 16 and the checksum 0 of no bytes. Null and shared ids: spread by the text. Rows that repeat in id and text share
    a virtual slot and get positions of their own. Extra columns, also those named like a result, are read only with
    ``keep``, where columns called shard, slot or vslot are replaced. Empty table: empty result.

    Scale: one pass; bytes are summed per slot with partial aggregation, the map has ``SLOTS`` rows, and positions are
    numbered inside a virtual slot plus its offset in the shard, so no task holds a shard.
    """
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    records = docs.select(doc_id.alias("doc_id"), record_size(text).alias("size"),
                          F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                          virtual_slot(doc_id, text).alias("vslot"))
    by_slot = stored(slot_bytes(records), "slots")
    spark = docs.sparkSession
    path = map_path or scratch_path(spark, "slot-map")
    found = load_version(spark, path, version)
    if found is None:
        if version is not None:
            raise ValueError(f"no version {version} of a slot map at {path}")
        save_version(_with_empty(deal(by_slot, shards), F.col("vslot") % shards), path, 1)
        found = load_version(spark, path, 1)
    number, mapped = found
    if map_path:
        shards = mapped.agg(F.max("shard")).first()[0] + 1
    grown = grow(by_slot, mapped, shards)
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    versions = (by_slot.join(mapped, "vslot")
                .select("vslot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
                .join(grown.withColumnRenamed("shard", "next_shard"), "vslot"))
    # SLOTS rows at most; names of their own beside any input column.
    versions = F.broadcast(versions.select([F.col(c).alias(_P + c) for c in versions.columns]))
    if keep:
        own = [c for c in docs.columns if c.lower() not in ("shard", "slot", "vslot")]
        rows = docs.select(*own, virtual_slot(doc_id, text).alias(_P + "v"))
        order = [doc_id, F.xxhash64(text)]
    else:
        own = ["doc_id", "size", "text_crc32"]
        rows = records.withColumnRenamed("vslot", _P + "v")
        order = list(map(F.col, own))
    inside = Window.partitionBy(_P + "v").orderBy(*order)
    placed = (rows.withColumn(_P + "k", F.row_number().over(inside) - 1)
              .join(versions, F.col(_P + "v") == F.col(_P + "vslot")))
    shard, vslot = F.col(_P + "shard").alias("shard"), F.col(_P + "v").alias("vslot")
    slot = (F.col(_P + "offset") + F.col(_P + "k")).cast("long").alias("slot")
    if keep:
        return placed.select(*own, shard, slot, vslot)
    return placed.select(*own, F.lit("bytes").alias("law"), shard, slot, F.lit(None).cast("int").alias("grown_shard"),
                         vslot, F.lit(number).alias("map_version"), F.col(_P + "next_shard").alias("next_shard"))
