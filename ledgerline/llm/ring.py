"""Shards by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import stored

#: Positions on the ring are 60-bit numbers.
BITS = 60
#: Rows of one shard that are ordered together, about.
ORDERED_ROWS = 20_000


@dataclass(frozen=True)
class Ring:
    """shards: numbered from 0; points: virtual nodes of each; load: rows that a shard may take, as a multiple of the mean. 1.0
    makes row counts differ by one at most; a greater load moves fewer rows when the number of shards changes. The ring itself
    is sent to every task: shards * shards * points numbers, 2**24 at most."""

    shards: int = 24
    points: int = 128
    load: float = 1.0

    def __post_init__(self):
        if self.shards < 1 or self.points < 1 or self.load < 1 or self.shards**2 * self.points > 1 << 24:
            raise ValueError("a ring needs shards, points and a load of 1 or more, and shards * shards * points up to 2**24")

    def room(self, rows: int) -> list[int]:
        """Rows that each shard may take; together at least `rows`."""
        if self.load > 1:
            return [math.ceil(self.load * rows / self.shards)] * self.shards
        return [rows // self.shards + (s < rows % self.shards) for s in range(self.shards)]


def position(name: Column) -> Column:
    """The place of a name on the ring: the first 15 hex digits of its MD5."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def ring_table(spark: SparkSession, ring: Ring) -> DataFrame:
    """(at, way) of each virtual node: its position, and all shards in the order in which they are met from there clockwise."""
    ids = spark.range(ring.shards * ring.points, numPartitions=1)
    names = ids.select(F.expr(f"id div {ring.points}").alias("shard"), F.expr(f"id % {ring.points}").alias("point"))
    points = names.select("shard", position(F.format_string("shard:%d:%d", "shard", "point")).alias("at"))
    ahead, whole = Window.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    met = []
    for s in range(ring.shards):
        own = F.when(F.col("shard") == s, F.col("at"))
        after = F.last(own, ignorenulls=True).over(ahead)
        met.append(F.struct(F.coalesce(after, F.min(own).over(whole) + (1 << BITS)).alias("at"), F.lit(s).alias("shard")))
    return points.select("at", F.array_sort(F.array(*met))["shard"].alias("way"))


def _cells(ring_points: DataFrame, bits: int) -> DataFrame:
    """(cell, ways): for each of 2**bits equal parts of the ring its virtual nodes in order, then the first one after it."""
    shift = BITS - bits
    cells = ring_points.sparkSession.range(1 << bits, numPartitions=1).withColumnRenamed("id", "cell")
    own = ring_points.groupBy(F.shiftright("at", shift).alias("cell")).agg(F.array_sort(F.collect_list(F.struct("at", "way"))).alias("own"))
    later = F.last(F.col("own")[0], ignorenulls=True).over(Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1))
    first = F.min(F.col("own")[0]).over(Window.partitionBy())
    wrapped = F.struct(F.lit((1 << BITS) - 1).alias("at"), first["way"].alias("way"))
    nodes = F.concat(F.coalesce("own", F.array().cast("array<struct<at:bigint,way:array<int>>>")), F.array(F.coalesce(later, wrapped)))
    return cells.join(own, "cell", "left").select("cell", nodes.alias("nodes"))


def ring_shards(docs: DataFrame, ring: Ring = Ring(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row. size: UTF-8 bytes and 8; slot: gapless from 0 in each shard.

    All keys that have no shard ask, at once, for the first shard with room that they meet clockwise from their own place. A
    shard takes its askers in the order of a second hash until it is full; the others go on to the next shard with room, and so
    round by round. Each round fills a shard, so there are at most as many rounds as shards, and every row finds a place.
    Where a shard is cut off is found by counts over ranges of the second hash, then by ordering the one range that holds the
    cut; only totals by shard reach the driver. Rounds after the first read the overflow only.

    A null text is empty; null keys share one place, and so do repeated keys, whose rows are told apart by where they are
    stored, so that one key may fill several shards. Without rows the result is empty. Other columns of docs are not read.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    name = F.coalesce(F.concat(F.lit(":"), F.col(key).cast("string")), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        name.alias("name"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "ring-rows")
    again = rows.groupBy("name").agg(F.count("*").alias("rows")).where("rows > 1").select("name", F.lit(True).alias("again"))
    told = F.concat(F.lit("order"), "name", F.when(F.col("again"), F.concat(F.lit(":"), F.col("row").cast("string"))).otherwise(F.lit("")))
    table = stored(ring_table(spark, ring), "ring")
    cell_bits = min(12, max(1, (ring.shards * ring.points).bit_length()))
    here, nodes = position(F.concat(F.lit("key"), "name")), _cells(table, cell_bits)
    placed = rows.join(again, "name", "left").select("key", "size", "text_crc32", "row", position(told).alias("turn"), here.alias("here"))
    placed = placed.withColumn("cell", F.shiftright("here", BITS - cell_bits)).join(F.broadcast(nodes), "cell")  # 4,096 cells at most
    node = F.filter("nodes", lambda n: n["at"] >= F.col("here"))[0]
    left = stored(placed.select("key", "size", "text_crc32", "row", "turn", node["way"].alias("way")), "ring-left")

    total = left.count()
    bits = max(0, math.ceil(math.log2(max(1.0, total / ring.shards / ORDERED_ROWS))))
    room, done = dict(enumerate(ring.room(total))), []
    while True:
        full = F.array(*[F.lit(s).cast("int") for s, free in room.items() if free <= 0]).cast("array<int>")
        asked = left.withColumn("shard", F.filter("way", lambda s: ~F.array_contains(full, s))[0])
        wants = {r["shard"]: r["n"] for r in asked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        over = {s: room[s] for s, n in wants.items() if n > room[s]}
        cuts = _cuts(asked, over, bits)
        taken = F.expr("true")
        if cuts:
            own = [F.when(F.col("shard") == s, F.struct("turn", "row") <= F.struct(F.lit(t).alias("turn"), F.lit(r).alias("row"))) for s, (t, r) in cuts.items()]
            taken = F.coalesce(*own, F.lit(True))
        done.append(asked.where(taken).select("key", "size", "text_crc32", "row", "turn", "shard"))
        for s, n in wants.items():
            room[s] -= min(n, room[s])
        if not cuts:
            break
        left = stored(asked.where(~taken).drop("shard"), "ring-left")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return _slotted(stored(found, "ring-placed"), bits)


def _part(bits: int) -> Column:
    return F.shiftright("turn", BITS - bits) if bits else F.lit(0).cast("long")


def _cuts(asked: DataFrame, room: dict[int, int], bits: int) -> dict[int, tuple[int, int]]:
    """For each shard with too many askers the (turn, row) of the last one that it takes."""
    if not room:
        return {}
    free = F.coalesce(*[F.when(F.col("shard") == s, F.lit(n)) for s, n in room.items()])
    rows = asked.where(F.col("shard").isin(list(room))).select("shard", "turn", "row", _part(bits).alias("part"))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    sums = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("shard").orderBy("part")))
    holds = sums.withColumn("nth", free - F.col("upto") + F.col("n")).where("nth > 0 and nth <= n").select("shard", "part", "nth")
    inside = rows.join(F.broadcast(holds), ["shard", "part"])  # one row a shard
    ranked = inside.withColumn("k", F.row_number().over(Window.partitionBy("shard").orderBy("turn", "row")))
    return {r["shard"]: (r["turn"], r["row"]) for r in ranked.where("k = nth").collect()}


def _slotted(rows: DataFrame, bits: int) -> DataFrame:
    """Rows numbered in the order of `turn` inside their shard: parts are numbered on their own, after the counts of parts before."""
    parted = rows.withColumn("part", _part(bits))
    counts = parted.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    starts = counts.select("shard", "part", before.alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("turn", "row"))
    numbered = parted.withColumn("inside", inside).join(starts, ["shard", "part"])
    return numbered.select("key", "size", "text_crc32", "shard", (F.col("start") + F.col("inside") - 1).alias("slot"))
