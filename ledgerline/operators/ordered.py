"""Exact order statistics and running totals over whole tables, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.series import join_on
from ledgerline.storage import checkpointed, stored

# Rows that one task puts in order at most; the number of pieces follows the rows.
SEGMENT_ROWS = 500_000


def constants(df: DataFrame) -> dict[str, Column]:
    """The values of a one-row summary as literals.

    The row is read when the plan is built: a summary used by many columns, or by later summaries, stays one
    small job instead of a subquery copied into every expression.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    row = df.first()
    return {c: _literal(row[c], kinds[c]) for c in df.columns}


def _literal(value, kind) -> Column:
    if isinstance(value, list):
        return F.array(*[F.lit(v).cast(kind.elementType) for v in value])
    return F.lit(value).cast(kind)


def exact_percentiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated percentiles per group: one row per key, one array column per input column.

    Radix selection, the same at every size. A first aggregation counts, for all columns and keys at once, the values in
    128 steps a power of two, with the least and greatest value of each step. The running counts tell which step holds
    each wanted rank. A rank at either end of its step is that value; the steps of the others are read again, cut into 65,536
    parts, until no rank is left. Each cut puts the least and greatest value of a step into different parts, so it ends.
    Counts are combined in the map tasks, rows are never ranked, and no bracket is guessed, so none can miss. A frame that is
    costly to make should be stored first: it is read once a level, as a rule two or three times. NaN is the greatest value.
    """
    cols, probs, keys = list(cols), list(probs), list(keys)
    if not cols or not probs:
        raise ValueError("percentiles need columns and probabilities")
    kept = [f"__k{i}" for i in range(len(keys))]
    base = df.select(
        *[F.col(k).alias(n) for k, n in zip(keys, kept)],
        *[(F.col(c).cast("double") + F.lit(0.0)).alias(f"__v{j}") for j, c in enumerate(cols)],
    )
    left = _first_ranks(base, kept, len(cols), probs)
    if not keys:
        return _overall(base, cols, probs, left)
    found = []
    while True:
        left = stored(left)
        found.append(left)
        left = left.filter(_OPEN)
        if left.isEmpty():
            break
        left = _next_ranks(base, kept, len(cols), len(probs), left)
    done = union_of([f.filter(f"not ({_OPEN})") for f in found])
    at = (F.col("c") * len(probs) + F.col("i")) * 2 + F.col("high")
    value = F.when(F.col("off") == 0, F.col("mn")).otherwise(F.col("mx"))
    # A null key of the map would fail: groups without any value have a row with i = -1.
    entries = F.collect_list(F.when(F.col("i") >= 0, F.struct(at.alias("at"), F.struct(value.alias("v"), "part").alias("x"))))
    wide = done.groupBy(*kept).agg(F.map_from_entries(entries).alias("m"))

    def percentile(j: int, i: int) -> Column:
        low, high = (F.try_element_at("m", F.lit((j * len(probs) + i) * 2 + side).cast("int")) for side in (0, 1))
        return low["v"] + (high["v"] - low["v"]) * low["part"]

    def listed(j: int, c: str) -> Column:
        every = F.array(*[percentile(j, i) for i in range(len(probs))])
        return F.when(every[0].isNotNull(), every).alias(c)

    return wide.select(*[F.col(n).alias(k) for k, n in zip(keys, kept)], *[listed(j, c) for j, c in enumerate(cols)])


_OPEN = "i >= 0 and mn < mx and off > 0 and off < n - 1"
# Steps a power of two of the first level, and parts of a step of the further ones.
_STEPS, _PARTS = 128, 65_535


def union_of(frames: Sequence[DataFrame]) -> DataFrame:
    whole = frames[0]
    for more in frames[1:]:
        whole = whole.unionByName(more)
    return whole


def _overall(base: DataFrame, cols: Sequence[str], probs: Sequence[float], left: DataFrame) -> DataFrame:
    """Without keys there are two ranks a column and probability, so the driver holds them between the levels."""
    values: dict[tuple, tuple] = {}
    while True:
        further: dict[tuple, list] = {}
        for r in left.collect():
            if r["i"] < 0:
                continue
            if r["mn"] < r["mx"] and 0 < r["off"] < r["n"] - 1:
                further.setdefault((r["c"], r["mn"], r["mx"]), []).append((r["i"], r["high"], r["off"], r["part"]))
            else:
                values[r["c"], r["i"], r["high"]] = (r["mn"] if r["off"] == 0 else r["mx"], r["part"])
        if not further:
            break
        rows = [(*at, asks) for at, asks in further.items()]
        left = _next_ranks(base, [], len(cols), len(probs), base.sparkSession.createDataFrame(rows, _RANGES), rows)

    def percentile(j: int, i: int) -> float | None:
        if (j, i, 0) not in values:
            return None
        (low, part), (high, _) = values[j, i, 0], values[j, i, 1]
        return low + (high - low) * part

    row = tuple([percentile(j, i) for i in range(len(probs))] for j in range(len(cols)))
    return base.sparkSession.createDataFrame([row], T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in cols]))


_RANGES = "c int, mn double, mx double, asks array<struct<i:int,high:int,off:bigint,part:double>>"


def _asked(begun: DataFrame, order: str) -> DataFrame:
    """The steps that hold a wanted rank, one row a rank: `asks` lists (i, high, off, part), off counted from the group's first,
    as is `begin`. The step of the nulls holds none; it gives a row with i = -1, so that its group is not lost."""
    here = F.filter("asks", lambda a: (a["off"] >= F.col("begin")) & (a["off"] < F.col("begin") + F.col("n")))
    no_rank = F.array(F.struct(F.lit(-1).alias("i"), F.lit(0).alias("high"), F.lit(0).cast("bigint").alias("off"), F.lit(0.0).alias("part")))
    return begun.withColumn("ask", F.explode(F.when(F.col(order).isNull(), no_rank).otherwise(here)))


def _step(v: Column) -> Column:
    """The step of a double: non-decreasing in it, 128 a power of two; NaN last, NULL for NULL."""
    size = F.floor(F.log2(F.abs(v)) * _STEPS) + 1_100 * _STEPS  # over 0 for any finite number but 0
    ends = F.when(v == 0, F.lit(0)).when(F.isnan(v), 3_001 * _STEPS).when(F.abs(v) == float("inf"), F.signum(v) * 3_000 * _STEPS)
    return ends.otherwise(F.signum(v) * size).cast("int")


def _first_ranks(base: DataFrame, kept: Sequence[str], n_cols: int, probs: Sequence[float]) -> DataFrame:
    v, group = F.col("v"), [*kept, "c"]
    long = base.select(*kept, F.posexplode(F.array(*[f"__v{j}" for j in range(n_cols)])).alias("c", "v"))
    rows = F.count(F.lit(1)) if kept else F.count("v")
    counts = long.groupBy(*group, _step(v).alias("step")).agg(rows.alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"))
    counts = counts.withColumn("n", F.when(F.col("step").isNull(), F.lit(0)).otherwise(F.col("n")))
    total = F.sum("n").over(W.partitionBy(*group).orderBy("step").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    asks = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("total") - 1)
        for high, rank in enumerate((F.floor(at), F.ceil(at))):
            asks.append(F.struct(F.lit(i).alias("i"), F.lit(high).alias("high"), rank.alias("off"), (at - F.floor(at)).alias("part")))
    upto = F.sum("n").over(W.partitionBy(*group).orderBy("step").rowsBetween(W.unboundedPreceding, 0))
    begun = counts.withColumn("total", total).withColumn("begin", upto - F.col("n"))
    holds = F.col("step").isNull()
    for ask in asks:  # plain comparisons first: most steps hold no rank
        holds |= (ask["off"] >= F.col("begin")) & (ask["off"] < F.col("begin") + F.col("n"))
    ranks = _asked(begun.filter(holds).withColumn("asks", F.array(*asks)), "step")
    return ranks.select(*kept, "c", "ask.i", "ask.high", (F.col("ask.off") - F.col("begin")).alias("off"), "ask.part", "n", "mn", "mx")


def _next_ranks(base: DataFrame, kept: Sequence[str], n_cols: int, n_probs: int, left: DataFrame, known: Sequence[tuple] = ()) -> DataFrame:
    """The open ranks one level further: only values of their steps are counted. Without keys `left` is of ranges, `known`."""
    if kept:
        ask = F.struct("i", "high", "off", "part")
        ranges = left.groupBy(*kept, "c", "mn", "mx").agg(F.collect_list(ask).alias("asks"))
        each = [F.collect_list(F.when(F.col("c") == j, F.struct("mn", "mx"))).alias(f"__r{j}") for j in range(n_cols)]
        source = join_on(base, ranges.groupBy(*kept).agg(*each), kept, "inner")
        steps = [[F.get(f"__r{j}", F.lit(k)) for k in range(2 * n_probs)] for j in range(n_cols)]  # two ranks a probability
        bounds = [[(r["mn"], r["mx"]) for r in of] for of in steps]
    else:
        ranges, source = left, base
        bounds = [[(F.lit(mn), F.lit(mx)) for c, mn, mx, _ in known if c == j] for j in range(n_cols)]
    hits = []
    for j, of in enumerate(bounds):
        v, within = F.col(f"__v{j}"), None
        for mn, mx in of:
            inside, step = (v >= mn) & (v <= mx), F.struct(F.lit(j).alias("c"), mn.alias("mn"), mx.alias("mx"), v.alias("v"))
            within = F.when(inside, step) if within is None else within.when(inside, step)
        hits += [] if within is None else [within]
    hit = source.select(*kept, F.explode(F.array(*hits)).alias("x")).filter("x is not null").select(*kept, "x.*")
    part = F.floor((F.col("v") - F.col("mn")) / (F.col("mx") - F.col("mn")) * _PARTS).cast("int")
    counts = hit.groupBy(*kept, "c", F.col("mn").alias("from"), "mx", part.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most")
    )
    group = [*kept, "c", "from"]
    asked = join_on(counts.drop("mx"), ranges.withColumnRenamed("mn", "from").drop("mx"), group, "inner")
    upto = F.sum("n").over(W.partitionBy(*group).orderBy("step").rowsBetween(W.unboundedPreceding, 0))
    ranks = _asked(asked.withColumn("begin", upto - F.col("n")), "step")
    return ranks.select(
        *kept, "c", "ask.i", "ask.high", (F.col("ask.off") - F.col("begin")).alias("off"), "ask.part", "n",
        F.col("least").alias("mn"), F.col("most").alias("mx"),
    )


def kth_value(df: DataFrame, col: str, k: int, most: int = SEGMENT_ROWS):
    """(value, rows before it, rows up to it) of the k-th smallest row by `col`; ties share a value, NULLs come first.

    The value counts are dealt by range and each range is summed; the range that holds the row is dealt again, alone, until
    it has at most `most` values. Only these are ranked in one task. Any type that can be ordered will do.
    """
    left, below, parts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")), 0, None
    while True:
        dealt = left.repartitionByRange(col) if parts is None else left.repartitionByRange(parts, col)
        # Stored: a second run would sample other range bounds.
        dealt = checkpointed(dealt.withColumn("__part", F.spark_partition_id()))
        sizes = dealt.groupBy("__part").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"))
        for part, n, values in sorted(sizes.collect()):  # one row a partition
            if below < k <= below + n:
                break
            below += n
        else:
            return None
        left = dealt.filter(F.col("__part") == part).drop("__part")
        if values <= most:
            break
        parts = min(2 * (parts or 8), 4096)  # more at each turn, so that it ends whatever bounds were drawn
    upto = W.orderBy(col).rowsBetween(W.unboundedPreceding, 0)
    row = left.withColumn("upto", F.sum("n").over(upto) + F.lit(below)).filter(F.col("upto") >= k).orderBy(col).first()
    return row[col], row["upto"] - row["n"], row["upto"]


def value_segments(df: DataFrame, col: str, out: str, most: int = SEGMENT_ROWS) -> DataFrame:
    """Add `out`, an array of ints that is non-decreasing in the number `col` and stands on at most `most` rows.

    Like the percentiles: rows are counted in 128 steps a power of two, and only steps with more rows than `most` are cut, into
    65,536 parts of their own range, until none is left. Rows of one value cannot be cut. No sketch is drawn and no bound
    passes through the driver. The frame is read once a level and should be stored if it is costly; NULLs come first.
    """
    value = F.col(col).cast("double") + F.lit(0.0)
    held = df.withColumn(out, F.array(F.coalesce(_step(value), F.lit(-4_000 * _STEPS))))
    while True:
        sizes = held.groupBy(out).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("__mn"), F.max(value).alias("__mx"))
        heavy = stored(sizes.filter((F.col("n") > most) & (F.col("__mn") < F.col("__mx"))).drop("n"))
        if heavy.isEmpty():
            return held
        part = F.floor((value - F.col("__mn")) / (F.col("__mx") - F.col("__mn")) * _PARTS).cast("int")
        path = F.when(F.col("__mn").isNull(), F.col(out)).otherwise(F.concat(out, F.array(part)))
        held = held.join(heavy, out, "left").withColumn(out, path).drop("__mn", "__mx")


def running_totals(df: DataFrame, col: str, sums: Sequence[str], most: int = SEGMENT_ROWS) -> DataFrame:
    """Cumulative sums in ascending `col` (distinct numbers); adds `cum_<c>`, the total up to each row.

    A task adds up one segment of at most `most` rows. What comes before a segment is added up level by level: the steps, some
    hundred for a power of two, then the parts of each step that was cut, 65,536 at most.
    """
    seg = value_segments(stored(df), col, "__seg", most)  # stored: each level and the sums read it
    totals = stored(seg.groupBy("__seg").agg(*[F.sum(c).alias(f"__s_{c}") for c in sums]))
    depth = totals.agg(F.max(F.size("__seg"))).first()[0] or 0
    starts = totals.select("__seg", *[(F.col(f"__s_{c}") * 0).alias(f"__s_{c}") for c in sums])
    for level in range(1, depth + 1):
        at = F.when(F.size("__seg") >= level, F.slice("__seg", 1, level)).alias("__at")
        each = totals.groupBy(at).agg(*[F.sum(f"__s_{c}").alias(f"__t_{c}") for c in sums]).filter("__at is not null")
        earlier = W.partitionBy(F.slice("__at", 1, level - 1)).orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
        before = each.select("__at", *[F.sum(f"__t_{c}").over(earlier).alias(f"__t_{c}") for c in sums])
        starts = starts.withColumn("__at", at).join(before, "__at", "left").select(
            "__seg", *[(F.col(f"__s_{c}") + F.coalesce(f"__t_{c}", F.lit(0))).alias(f"__s_{c}") for c in sums]
        )
    inside = W.partitionBy("__seg").orderBy(col).rowsBetween(W.unboundedPreceding, 0)
    return (
        seg.join(starts, "__seg")
        .withColumns({f"cum_{c}": F.col(f"__s_{c}") + F.sum(c).over(inside) for c in sums})
        .drop("__seg", *[f"__s_{c}" for c in sums])
    )
