"""Similarity of series: correlation and time-warped distance."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.moments import correlation
from ledgerline.operators.joins import align_common, pair_rows
from ledgerline.operators.scaling import zscore
from ledgerline.operators.series import Series, position
from ledgerline.operators.windows import rolling_corr
from ledgerline.storage import stored


def dtw_distance(a: np.ndarray, b: np.ndarray, band: int | None = None) -> float:
    """Time-warped distance with |x - y| cost; `band` limits |i - j|. One tile holds both series."""
    if len(a) == 0 or len(b) == 0:
        return float("nan")
    reach = None if band is None else max(band, abs(len(a) - len(b)))
    top, left = np.full(len(b) + 1, np.inf), np.full(len(a) + 1, np.inf)
    top[0] = left[0] = 0.0
    return float(warped_tile(a, b, top, left, 0, reach)[0][-1])


def warped_tile(
    x: np.ndarray, y: np.ndarray, top: np.ndarray, left: np.ndarray, shift: int = 0, reach: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(last row, last column) of the cumulative costs of a tile, one anti-diagonal at a time.

    `top` and `left` are the row before the tile and the column before it, both beginning with the cell at the corner, as do
    the results: they are the borders of the tiles below and to the right. `shift` is the tile's row minus its column in the
    whole matrix and `reach` the greatest |row - column| there.
    """
    n, m = len(x), len(y)
    bottom, right = np.full(m + 1, np.inf), np.full(n + 1, np.inf)
    before, last = np.full(n + 1, np.inf), np.full(n + 1, np.inf)
    flipped = y[::-1]
    for d in range(n + m + 1):
        now = np.full(n + 1, np.inf)
        if d <= m:
            now[0] = top[d]
        if d <= n:
            now[d] = left[d]
        lo, hi = max(1, d - m), min(n, d - 1)
        if reach is not None:
            lo, hi = max(lo, -((reach + shift - d) // 2)), min(hi, (d + reach - shift) // 2)
        if lo <= hi:
            # Cells (i, d - i) for i in lo..hi; y runs backwards along the diagonal.
            cost = np.abs(x[lo - 1 : hi] - flipped[m - d + lo : m - d + hi + 1])
            now[lo : hi + 1] = cost + np.minimum(np.minimum(last[lo - 1 : hi], last[lo : hi + 1]), before[lo - 1 : hi])
        if d >= m:
            right[d - m] = now[d - m]
        if d >= n:
            bottom[d - n] = now[n]
        before, last = last, now
    return bottom, right


def dtw_matrix(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    names: Sequence,
    band: int | None = None,
    tile: int = 4096,
    segment: Column | str | None = None,
) -> DataFrame:
    """(a, b, distance) between the named series, z-scored on the dates all of them have; both triangles and the diagonal.

    The cost matrix of a pair is cut into tiles of `tile` rows and columns, which are filled in diagonal by diagonal: a task gets
    two pieces of series and the borders of the tiles above and to the left, and only its own borders leave it. No task holds a
    whole series, and the tiles of one pair run side by side. Tiles that `band` does not reach are left out. The work grows with
    the square of the length, or with length times `band`, the rounds with twice the length over `tile`; daily series of 25
    years take five. For raw grain give `segment` (see `Series`).
    """
    names = list(dict.fromkeys(names))
    held = df.filter(F.col(key).isin(*names)).select(key, order, F.col(value).cast("double").alias("v"))
    # Stored once: every round reads it.
    aligned = stored(zscore(align_common(held, key, order, "v"), ["v"], [key], ddof=1))
    placed = position(aligned, Series.of(key, order, segment), "at").withColumn("tile", F.floor((F.col("at") - 1) / tile).cast("int"))
    pieces = stored(placed.groupBy(key, "tile").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v_z"))), lambda p: p["v_z"]).alias("z")))
    tiles = (pieces.agg(F.max("tile")).first()[0] + 1) if not pieces.isEmpty() else 0
    kind = dict(df.dtypes)[key]
    listed = df.sparkSession.createDataFrame([(a, b) for i, a in enumerate(names) for b in names[i + 1 :]], f"a {kind}, b {kind}")
    schema = f"a {kind}, b {kind}, i int, j int, bottom array<double>, right array<double>"

    def fill(batches):
        for rows in batches:
            out = []
            for x, y, i, j, above, beside in zip(rows["x"], rows["y"], rows["i"], rows["j"], rows["above"], rows["beside"]):
                x, y = np.asarray(x, float), np.asarray(y, float)
                top = np.full(len(y) + 1, np.inf) if above is None else np.array(above, float)
                left = np.full(len(x) + 1, np.inf) if beside is None else np.array(beside, float)
                top[0] = left[0] = 0.0 if i == j == 0 else min(top[0], left[0])  # either neighbour may be out of the band
                out.append(warped_tile(x, y, top, left, (i - j) * tile, band))
            yield rows[["a", "b", "i", "j"]].assign(bottom=[list(r[0]) for r in out], right=[list(r[1]) for r in out])

    done = None
    for d in range(2 * tiles - 1):
        cells = listed.withColumn("i", F.explode(F.sequence(F.lit(max(0, d - tiles + 1)), F.lit(min(d, tiles - 1))))).withColumn("j", F.lit(d) - F.col("i"))
        if band is not None:
            cells = cells.filter((F.abs(F.col("i") - F.col("j")) - 1) * tile + 1 <= max(band, 1))  # neighbours hand corners on
        work = cells.join(pieces.select(F.col(key).alias("a"), F.col("tile").alias("i"), F.col("z").alias("x")), ["a", "i"])
        work = work.join(pieces.select(F.col(key).alias("b"), F.col("tile").alias("j"), F.col("z").alias("y")), ["b", "j"])
        if done is None:
            empty = F.lit(None).cast("array<double>")
            work = work.withColumns({"above": empty, "beside": empty})
        else:
            at = ["a", "b", "i", "j"]
            work = work.join(done.select("a", "b", (F.col("i") + 1).alias("i"), "j", F.col("bottom").alias("above")), at, "left")
            work = work.join(done.select("a", "b", "i", (F.col("j") + 1).alias("j"), F.col("right").alias("beside")), at, "left")
        # One tile a task where there are enough tasks: the work of a row is large.
        dealt = work.select("a", "b", "i", "j", "x", "y", "above", "beside").repartition(max(1, len(names) * (len(names) - 1) // 2 * min(d + 1, 2 * tiles - 1 - d)), "a", "b", "i")
        done = stored(dealt.mapInPandas(fill, schema))
    zero = listed.sparkSession.createDataFrame([(a,) for a in names], f"a {kind}").join(
        pieces.select(F.col(key).alias("a")).distinct(), "a", "left_semi"
    ).select("a", F.col("a").alias("b"), F.lit(0.0).alias("distance"))
    if done is None:
        return zero
    upper = done.select("a", "b", F.element_at("bottom", -1).alias("distance"))
    sides = F.array(F.struct("a", "b", "distance"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
    return upper.select(F.explode(sides).alias("p")).select("p.*").unionByName(zero)


def pair_corr(df: DataFrame, key: str, order: str, value: str, names: Sequence) -> DataFrame:
    """(a, b, corr) over the dates both series have."""
    pairs = pair_rows(df, key, order, value, names)
    return pairs.groupBy("a", "b").agg(correlation("x", "y").alias("corr"))


def pair_rolling_corr(
    df: DataFrame, key: str, order: str, value: str, names: Sequence, n: int
) -> DataFrame:
    """(a, b, order, rolling_corr) for every pair on the dates all named series share."""
    aligned = align_common(df.filter(F.col(key).isin(*list(names))), key, order, value)
    pairs = pair_rows(aligned, key, order, value, names)
    s = Series.of(("a", "b"), order)
    return rolling_corr(pairs, s, "x", "y", n).select("a", "b", order, "rolling_corr")


def mean_rolling_corr(df: DataFrame, key: str, order: str, value: str, names: Sequence, n: int) -> DataFrame:
    rolled = pair_rolling_corr(df, key, order, value, names, n)
    return rolled.groupBy("a", "b").agg(F.avg("rolling_corr").alias("mean_corr"))
