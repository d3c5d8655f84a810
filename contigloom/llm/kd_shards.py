"""Sharding by a k-d tree over metadata with distributed weighted medians, in DataFrame functions.

Every node is cut along its widest dimension (each scaled to its range in the table) at the value that parts its bytes in proportion to the room in the
shards on either side. The cuts of a level are found by sums of bytes over ever finer bins, for all its nodes in one job; a small table of cuts, one row for each
node, reaches the driver and moves the rows to their child nodes. Rows with equal texts share their coordinates and stay together. Groups of equal texts (and
single rows) that are large against a shard are placed whole first, the largest first into the emptiest shard, and the tree fills what room that
leaves; those that fit no shard are spread by row.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contigloom.runtime import drop, keep, ship, tidy

#: A key is 20 bits of the dimension's value and 42 bits of a hash; BIN_BITS of it are resolved by a job.
VALUE_BITS, HASH_BITS, BIN_BITS = 20, 42, 10
#: A cut stops being refined when its bin holds this share of a shard; groups above LARGE of a shard, by bytes or rows, are placed first.
FINE, LARGE = 0.002, 0.01
#: Large groups that one task places, and rows of a window that numbers slots.
PACK_ROWS, SLOT_ROWS = 100_000, 50_000
#: Tables of at most so many rows (of some 40 bytes) are broadcast.
BROADCAST_ROWS = 400_000


def _text_value(c: Column) -> Column:
    """Order-preserving number of a string's first six bytes; -1 for null."""
    return F.coalesce(F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double"), F.lit(-1.0))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


def _local(spark: SparkSession, rows: list[tuple], **kinds: str) -> DataFrame:
    """A table of the driver's, without a job."""
    return spark.createDataFrame(pa.table([pa.array(np.array(x, kinds[name])) for x, name in zip(zip(*rows), kinds)], names=list(kinds)))


def points(docs: DataFrame, key: str, text: str, metadata: list[str]) -> tuple[DataFrame, int]:
    """(rows, dimensions): row, key, size, crc, same (a hash of the text) and the values v0, v1, ... of every row, as a table in the shared folder."""
    body = F.coalesce(F.col(text), F.lit(""))
    kinds = dict(docs.dtypes)
    values = [(F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) if kinds[c] != "string" else _text_value(F.col(c))) for c in metadata if c in kinds]
    size = (F.octet_length(body) + 16).cast("long")
    named = [v.alias(f"v{i}") for i, v in enumerate([F.log2(size.cast("double")), *values])]
    raw = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), size.alias("size"), F.crc32(body.cast("binary")).alias("crc"), F.xxhash64(body).alias("same"), *named)
    return keep(raw, "points"), len(named)


def packed(large: list[tuple[int, int]], shards: list[int], room: float) -> Iterator[tuple[int, int | None]]:
    """(same, shard) of (same, bytes): the largest first into the emptiest of the shards; null where no shard has room."""
    heap = [(0, s) for s in shards]
    for same, size in sorted(large, key=lambda x: (-x[1], x[0])):
        held, s = heap[0] if heap else (room, 0)
        if held + size <= room:
            heapq.heapreplace(heap, (held + size, s))
            yield same, s
        else:
            yield same, None


def place_large(groups: DataFrame, shards: int, share: float) -> tuple[DataFrame, int]:
    """(table of same, bytes and shard, its rows) of the large groups. They are dealt by hash to tasks of about PACK_ROWS groups, each with shards of its own."""
    n = groups.count()
    parts = max(1, min(shards, math.ceil(n / PACK_ROWS)))
    ship(groups.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        for part, own in pd.concat(held).groupby("part") if held else ():
            size = dict(zip(own["same"].tolist(), own["bytes"].tolist()))
            out = list(packed(list(size.items()), list(range(int(part), shards, parts)), share))
            yield pd.DataFrame({"same": [x for x, _ in out], "bytes": [size[x] for x, _ in out], "shard": pd.array([s for _, s in out], "Int32")})

    dealt = groups.select(F.pmod("same", F.lit(parts)).cast("int").alias("part"), "same", "bytes").repartition(parts, "part")
    return keep(dealt.mapInPandas(tidy(run), "same long, bytes long, shard int"), "placed"), n


def keyed(raw: DataFrame, dims: int, shards: int) -> tuple[DataFrame, DataFrame, list[float], float]:
    """(rows for the tree, rows placed already, room left in each shard, bytes of a shard).

    The rows for the tree have row, key, size, crc, node (0) and the keys k0, k1, ...; those placed have row, key, size, crc and shard.
    """
    r = raw.agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), *(f(f"v{i}").alias(f"{f.__name__}{i}") for i in range(dims) for f in (F.min, F.max))).first()
    share = (r["bytes"] or 0) / shards
    groups = raw.groupBy("same").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), *(F.min(f"v{i}").alias(f"g{i}") for i in range(dims)))
    is_large = (F.col("bytes") > LARGE * share) | (F.col("n") > max(1, LARGE * r["n"] / shards))
    groups = keep(groups.withColumn("large", is_large).filter("n > 1 or large"), "groups")
    placed, n = place_large(groups.filter("large"), shards, share)
    room = [share] * shards
    for x in placed.filter("shard is not null").groupBy("shard").agg(F.sum("bytes").alias("n")).collect():
        room[x["shard"]] = max(0.0, share - x["n"])
    known = raw.join(_small(placed.select("same", "shard", F.lit(True).alias("spread")), n), "same", "left")
    spread = F.col("spread").isNotNull()
    # a group of copies takes its coordinates from its smallest values; a group that is spread has no partner, so its rows need not meet
    rest = known.filter("shard is null").withColumn("own", F.when(spread, F.xxhash64("row", "same")).otherwise(F.col("same")))
    tie = F.shiftrightunsigned(F.xxhash64("own"), 64 - HASH_BITS)
    rest = rest.join(groups.filter("not large").select(F.col("same").alias("own"), *(f"g{i}" for i in range(dims))), "own", "left")
    keys = []
    for i in range(dims):
        low, wide = r[f"min{i}"] or 0.0, (r[f"max{i}"] or 0.0) - (r[f"min{i}"] or 0.0)
        step = F.floor((F.coalesce(f"g{i}", f"v{i}") - low) / wide * ((1 << VALUE_BITS) - 1)) if wide > 0 else F.lit(0).cast("long")
        keys.append((F.shiftleft(step, HASH_BITS) + tie).alias(f"k{i}"))
    rows = keep(rest.select("row", "key", "size", "crc", F.lit(0).alias("node"), *keys), "keyed")
    return rows, known.filter("shard is not null").select("row", "key", "size", "crc", "shard"), room, share


def build(rows: DataFrame, dims: int, room: list[float], share: float) -> tuple[DataFrame, dict[tuple[int, int], tuple[int, int]]]:
    """(rows whose node is their shard, cuts): about log2(shards) levels of a few jobs, each over the narrow table of keys.

    A node is the interval of its shards and is named by the lowest. cuts: (low, high) -> (dimension, largest key that goes to the lower half). The tables of
    a level hold a row for each node; those of bins stay in Spark, where a window over a node's bins finds the one that holds the cut.
    """
    spark = rows.sparkSession
    before = [0.0]
    for x in room:
        before.append(before[-1] + x)
    level, cuts = [(0, len(room))], {}
    k = F.element_at(F.array(*(F.col(f"k{i}") for i in range(dims))), F.col("dim") + 1)
    while level := [x for x in level if x[1] - x[0] > 1]:
        ends = dict(level)
        stats = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *(f(f"k{i}").alias(f"{f.__name__}{i}") for i in range(dims) for f in (F.min, F.max)))
        todo = []
        for r in stats.collect():
            if (low := r["node"]) not in ends:
                continue
            high = ends[low]
            mid = low + (high - low) // 2
            dim = max(range(dims), key=lambda i: ((r[f"max{i}"] >> HASH_BITS) - (r[f"min{i}"] >> HASH_BITS), -i))
            all_room = before[high] - before[low]
            wanted = r["bytes"] * ((before[mid] - before[low]) / all_room if all_room > 0 else 0.5)
            todo.append((low, dim, r[f"min{dim}"], r[f"max{dim}"], 0, float(wanted)))
        found = []
        while todo:
            t = _local(spark, [(*x, max(0, (x[3] - x[2]).bit_length() - BIN_BITS)) for x in todo], node="i4", dim="i4", a="i8", b="i8", below="i8", wanted="f8", shift="i4")
            own = rows.join(_small(t, len(todo)), "node").withColumn("k", k).filter(F.col("k").between(F.col("a"), F.col("b"))).withColumn("bin", F.expr("shiftright(k - a, shift)"))
            bins = own.groupBy("node", "bin").agg(F.sum("size").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"), F.first("below").alias("below"), F.first("wanted").alias("wanted"), F.first("dim").alias("dim"))
            in_node = Window.partitionBy("node").orderBy("bin")
            bins = bins.withColumn("done", F.sum("n").over(in_node) - F.col("n") + F.col("below")).withColumn("at", F.row_number().over(in_node)).filter("done < wanted or at = 1")
            held = bins.groupBy("node").agg(F.max_by(F.struct("dim", "lo", "hi", "done", "wanted", "n"), "bin").alias("x")).select("node", "x.*").collect()
            todo = []
            for r in held:
                if r["n"] > FINE * share and r["lo"] < r["hi"]:
                    todo.append((r["node"], r["dim"], r["lo"], r["hi"], r["done"], r["wanted"]))
                else:  # a bin goes left or right, whichever is nearer
                    found.append((r["node"], r["dim"], r["hi"] if r["done"] + r["n"] - r["wanted"] <= r["wanted"] - r["done"] else r["lo"] - 1))
        if not found:
            break
        cuts |= {(low, ends[low]): (dim, cut) for low, dim, cut in found}
        t = _local(spark, [(low, dim, cut, low + (ends[low] - low) // 2) for low, dim, cut in found], node="i4", dim="i4", cut="i8", mid="i4")
        moved = rows.join(_small(t, len(found)), "node", "left").withColumn("node", F.when(k > F.col("cut"), F.col("mid")).otherwise(F.col("node")))
        last, rows = rows, keep(moved.select(rows.columns), "keyed")
        drop(last)
        level = [y for low, _, _ in found for y in ((low, low + (ends[low] - low) // 2), (low + (ends[low] - low) // 2, ends[low]))]
    return rows, cuts


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, key: str = "doc_id", text: str = "text", metadata: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """key, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null) of every row.

    shards, or as many as the target bytes ask for, get near equal bytes (size: UTF-8 bytes of the text plus 16; null: none). Dimensions: log of the
    size and those of the metadata columns that exist, strings by their first bytes, nulls lowest. Rows of equal texts share a shard unless they fit none. Slots
    number a shard's rows without gaps, in the order of a hash, in two steps, so that no window holds a whole shard. Repeated rows and null keys are rows
    like others; an empty table gives an empty result; with fewer rows than shards some shards stay empty.
    """
    if shards is None:
        r = docs.select(F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 16)).first()
        shards = max(1, math.ceil((r[0] or 0) / target_bytes))
    raw, dims = points(docs, key, text, list(metadata))
    rows, placed, room, share = keyed(raw, dims, shards)
    rows, _ = build(rows, dims, room, share)
    parts = max(8, math.ceil(raw.count() / shards / SLOT_ROWS))
    columns = ["row", "key", "size", "crc"]
    placed = rows.select(*columns, F.col("node").alias("shard")).union(placed.select(*columns, "shard")).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    slot = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    out = placed.withColumn("inside", slot).join(before, ["shard", "part"])
    slot = (F.col("before") + F.col("inside")).cast("long").alias("slot")
    return out.select(F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", slot, F.lit(None).cast("int").alias("grown_shard"))
