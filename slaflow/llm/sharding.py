"""Sharding over fixed virtual slots.

Every record hashes into one of ``n_virtual`` slots, for good.  Bytes are
aggregated per slot, and a small versioned map says which shard holds which
slot.  Balancing edits the map, never the hashing: the first version deals
slots out by size, and a later one moves only as many slots as the new
sizes or shard count need.  What reaches the driver is one row per slot.

Defined results: a null text has no bytes (size 1, CRC of the empty text);
a null id hashes like any other value, together with the text's CRC, so
that many null ids spread over the slots; identical rows share a slot and
are numbered one after the other; an empty table has no rows and an empty
slot table; other columns aren't read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slaflow.llm.common import materialize, shared_path, text_or_empty, utf8_bytes

N_VIRTUAL = 4096
MAP_SCHEMA = "version int, vslot int, shard int, bytes long, rows long, first long"


def records(docs: DataFrame, n_virtual: int = N_VIRTUAL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, vslot) of every row, written once."""
    crc = F.crc32(F.encode(text_or_empty(text_col), "UTF-8"))
    return materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (utf8_bytes(F.col(text_col)) + 1).alias("size"),
            crc.alias("text_crc32"),
            F.pmod(F.xxhash64(id_col, crc), F.lit(n_virtual)).cast("int").alias("vslot"),
        ),
        "records",
    )


def slot_sizes(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each virtual slot that has any: at most
    ``n_virtual`` rows, whatever the input."""
    sums = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return {r["vslot"]: (r["bytes"], r["rows"]) for r in sums.collect()}


def deal(sizes: dict[int, tuple[int, int]], n_shards: int) -> dict[int, int]:
    """Slots from large to small, each to the shard with the fewest bytes."""
    heap = [(0, s) for s in range(n_shards)]
    out: dict[int, int] = {}
    for slot, (n_bytes, _) in sorted(sizes.items(), key=lambda x: (-x[1][0], x[0])):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + n_bytes, shard))
    return out


def rebalance(
    old: dict[int, int], sizes: dict[int, tuple[int, int]], n_shards: int, tolerance: float = 0.01
) -> dict[int, int]:
    """The old map edited: slots without a shard (or of one that is gone) are
    dealt out, then slots move from the fullest shard to the emptiest while
    that brings the two closer and they differ by more than ``tolerance`` of
    the mean.  If there are new shards, slots move only into those."""
    fresh = [s for s in range(n_shards) if s not in set(old.values())]
    targets = fresh if old and fresh else range(n_shards)
    out = {slot: shard for slot, shard in old.items() if slot in sizes and shard < n_shards}
    load = [0] * n_shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in out.items():
        load[shard] += sizes[slot][0]
        held[shard].append((sizes[slot][0], slot))
    for slot in sorted(sizes.keys() - out.keys(), key=lambda x: (-sizes[x][0], x)):
        shard = min(range(n_shards), key=lambda s: (load[s], s))
        out[slot] = shard
        load[shard] += sizes[slot][0]
        held[shard].append((sizes[slot][0], slot))
    slack = tolerance * sum(load) / max(n_shards, 1)
    while True:
        full, empty = max(range(n_shards), key=lambda s: load[s]), min(targets, key=lambda s: load[s])
        gap = load[full] - load[empty]
        fits = [x for x in held[full] if 0 < x[0] < gap]
        if gap <= slack or not fits:
            return out
        moved = min(fits, key=lambda x: (abs(gap - 2 * x[0]), x[1]))
        held[full].remove(moved)
        held[empty].append(moved)
        load[full] -= moved[0]
        load[empty] += moved[0]
        out[moved[1]] = empty


def write_map(
    spark: SparkSession, shards: dict[int, int], sizes: dict[int, tuple[int, int]], path: str, version: int
) -> DataFrame:
    """Store a version of the map: the shard of each slot and the position in
    the shard of the slot's first row.  Versions are never overwritten."""
    rows, at = [], {}
    for slot in sorted(shards):
        shard, (n_bytes, n_rows) = shards[slot], sizes[slot]
        rows.append((version, slot, shard, n_bytes, n_rows, at.get(shard, 0)))
        at[shard] = at.get(shard, 0) + n_rows
    made = spark.createDataFrame(rows, MAP_SCHEMA)
    made.coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")
    return read_map(spark, path, version)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/version={version}")


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, the row's place in its shard
    (gapless from 0, in order of virtual slot, id, CRC and size)."""
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    placed = rows.withColumn("__rank", F.row_number().over(within))
    spread = F.broadcast(slot_map.select("vslot", "shard", "first"))  # a row for each virtual slot
    return placed.join(spread, "vslot").withColumn("slot", F.col("first") + F.col("__rank") - 1).drop("__rank", "first")


def shard_documents(
    docs: DataFrame, n_shards: int = 16, n_virtual: int = N_VIRTUAL, path: str | None = None, version: int = 1
) -> DataFrame:
    """Shard a table: version ``version`` of the map is stored under ``path``
    (by default a new shared folder), edited from the version before it if
    there is one."""
    spark = docs.sparkSession
    rows = records(docs, n_virtual)
    sizes = slot_sizes(rows)
    path = path or shared_path(spark, "shard-map")
    if version > 1:
        old = {r["vslot"]: r["shard"] for r in read_map(spark, path, version - 1).select("vslot", "shard").collect()}
        shards = rebalance(old, sizes, n_shards)
    else:
        shards = deal(sizes, n_shards)
    return assign(rows, write_map(spark, shards, sizes, path, version)).withColumn("version", F.lit(version))
