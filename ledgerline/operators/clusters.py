"""Dimension reduction, clustering and cluster quality."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions.scalars import map_label
from ledgerline.operators.filters import exclude
from ledgerline.operators.scaling import zscore
from ledgerline.operators.windows import latest_non_null
from ledgerline.storage import checkpointed, stored


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def pca_project(
    df: DataFrame,
    cols: Sequence[str],
    threshold: float = fixed.PCA_VARIANCE,
    k: int | None = None,
    prefix: str = "pc",
) -> tuple[DataFrame, DataFrame]:
    """(frame with component scores, variance table) for standardised columns.

    Keeps `k` components, or as many as reach the variance threshold. Signs are fixed so that the largest
    loading of each component is positive.
    """
    cols = list(cols)
    vectors = assemble(df, cols)
    model = PCA(k=len(cols), inputCol="features", outputCol="__scores").fit(vectors.select("features"))
    share = np.asarray(model.explainedVariance.toArray())
    total = np.cumsum(share)
    reached = np.nonzero(total >= threshold - 1e-12)[0]
    keep = k or int(reached[0] + 1 if len(reached) else len(cols))
    loadings = np.asarray(model.pc.toArray())
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(len(cols))])
    scored = (
        model.transform(vectors)
        .withColumn("__scores", vector_to_array("__scores"))
        .selectExpr(
            *[f"`{c}`" for c in df.columns],
            *[f"__scores[{j}] * {float(signs[j])}d as {prefix}{j + 1}" for j in range(keep)],
        )
    )
    rows = [(j + 1, float(share[j]), float(total[j]), j < keep) for j in range(len(cols))]
    variance = df.sparkSession.createDataFrame(
        rows, "component int, variance_ratio double, cumulative double, selected boolean"
    )
    return scored, variance


@dataclass(frozen=True)
class Clusters:
    """A k-means fit: centres, rows per centre (0 for one that lost all rows), within-cluster sum of squares, silhouette."""

    centres: np.ndarray
    sizes: np.ndarray
    inertia: float
    silhouette_sq: float


def _scan(points: DataFrame, work: Callable[[np.ndarray], Iterable[tuple]], schema: str, width: int) -> DataFrame:
    """`work` over matrices of the rows, a few MB of `width` results a row at a time; sums stay in the task until its end.

    `work` gives (keys, values) pairs, keys a tuple of ints and values an array to be added up.
    """
    rows = max(1, 2_000_000 // width)

    def run(batches):
        total: dict[tuple, np.ndarray] = {}
        for frame in batches:
            x = frame.to_numpy(dtype=float)
            if not np.isfinite(x).all():
                raise ValueError("clustering needs finite values in every column")
            for i in range(0, len(x), rows):
                for key, values in work(x[i : i + rows]):
                    total[key] = total[key] + values if key in total else values
        if total:
            yield pd.DataFrame([(*k, v.tolist()) for k, v in total.items()], columns=[f.split()[0] for f in schema.split(", ")])

    return points.mapInPandas(run, schema)


def _nearest(x: np.ndarray, norms: np.ndarray, models: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(label, squared distance) by model: the distances to all centres of all models come from one matrix product."""
    every = np.vstack(models)
    gaps = x @ every.T
    gaps *= -2.0
    gaps += norms[:, None]
    gaps += (every**2).sum(axis=1)
    np.maximum(gaps, 0.0, out=gaps)
    out, at = [], 0
    for centres in models:
        own = gaps[:, at : at + len(centres)]
        label = own.argmin(axis=1)
        out.append((label, own[np.arange(len(x)), label]))
        at += len(centres)
    return out


def _advance(points: DataFrame, models: Mapping[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By model: rows, squared distances and squared norms by centre as three columns, and the sums of the rows by centre."""
    ids, stacks = list(models), list(models.values())
    d = stacks[0].shape[1]

    def work(x: np.ndarray):
        norms = (x**2).sum(axis=1)
        for m, centres, (label, gap) in zip(ids, stacks, _nearest(x, norms, stacks)):
            sums = [np.bincount(label, weights=w, minlength=len(centres)) for w in (None, gap, norms, *x.T)]
            held = np.column_stack(sums)
            for j in np.flatnonzero(held[:, 0]):
                yield (m, int(j)), held[j]

    parts = _scan(points, work, "model int, cluster int, v array<double>", sum(map(len, stacks)))
    sums = parts.groupBy("model", "cluster").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(d + 3)]).alias("v"))
    out = {m: (np.zeros((len(c), 3)), np.zeros((len(c), d))) for m, c in models.items()}
    for r in sums.collect():  # a row a centre
        out[r["model"]][0][r["cluster"]] = r["v"][:3]
        out[r["model"]][1][r["cluster"]] = r["v"][3:]
    return out


SCAN_ROWS = 20_000


def _dealt(points: DataFrame) -> DataFrame:
    """Points stored in as many files as there are tasks for them: rows are narrow, so by bytes alone a task would hold millions."""
    cores = points.sparkSession.sparkContext.defaultParallelism
    parts = min(math.ceil(points.count() / SCAN_ROWS), 4 * cores)
    if parts <= max(1, points.rdd.getNumPartitions()):
        return points
    return checkpointed(points.repartition(parts))


def _starts(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ seeding: each further centre is drawn in proportion to its squared distance from those drawn."""
    picked = [rows[rng.integers(len(rows))]]
    gap = ((rows - picked[0]) ** 2).sum(axis=1)
    while len(picked) < k:
        total = gap.sum()
        at = rng.choice(len(rows), p=gap / total) if total > 0 else rng.integers(len(rows))
        picked.append(rows[at])
        gap = np.minimum(gap, ((rows - rows[at]) ** 2).sum(axis=1))
    return np.array(picked)


def fit_kmeans(
    df: DataFrame,
    cols: Sequence[str],
    k_range: Iterable[int],
    n_init: int = 10,
    seed: int = 42,
    max_iter: int = 100,
    tol: float = 1e-4,
    start_rows: int = 10_000,
) -> dict[int, Clusters]:
    """By k the best of `n_init` starts by within-cluster sum of squares.

    All k and all starts advance together: one scan an iteration measures every row against all their centres and adds up
    sums by centre, so 90 fits take as many jobs as the slowest of them has iterations. A fit whose centres move by less than
    `tol` leaves the scan. Starts are drawn from `start_rows` rows chosen by hash; every iteration, the sums of squares and the
    silhouettes cover all rows. The driver holds centres only. A frame without rows is an error.
    """
    ks, cols = sorted(set(map(int, k_range))), list(cols)
    points = _dealt(stored(df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])))
    chosen = points.orderBy(F.xxhash64(*points.columns, F.lit(seed)), *points.columns).limit(start_rows).toPandas().to_numpy(dtype=float)
    if not len(chosen):
        raise ValueError("no rows to cluster")
    fits = {(k, i): _starts(chosen, k, np.random.default_rng([seed, k, i])) for k in ks for i in range(n_init)}
    names = dict(enumerate(fits))
    open_ = set(names)
    for _ in range(max_iter):
        state = _advance(points, {m: fits[names[m]] for m in sorted(open_)})
        for m, (stats, sums) in state.items():
            old, n = fits[names[m]], stats[:, :1]
            new = np.where(n > 0, sums / np.maximum(n, 1), old)
            fits[names[m]] = new
            if ((new - old) ** 2).sum(axis=1).max() <= tol**2:
                open_.discard(m)
        if not open_:
            break
    last = _advance(points, {m: fits[names[m]] for m in names})
    best = {k: min((m for m in names if names[m][0] == k), key=lambda m: (last[m][0][:, 1].sum(), m)) for k in ks}
    scores = _silhouettes_sq(points, {m: (fits[names[m]], *last[m]) for m in best.values()})
    return {
        k: Clusters(fits[names[m]], last[m][0][:, 0].astype(int), float(last[m][0][:, 1].sum()), scores[m])
        for k, m in best.items()
    }


def _silhouettes_sq(points: DataFrame, models: Mapping[int, tuple]) -> dict[int, float]:
    """Mean silhouette on squared distance by model, one scan for all: a row's mean distance to a cluster comes from the cluster's
    rows, sum and squared norms. A row alone in its cluster, or without another cluster, scores 0."""
    stacks = [centres for centres, _, _ in models.values()]

    def work(x: np.ndarray):
        norms = (x**2).sum(axis=1)
        for (m, (_, stats, sums)), (label, _) in zip(models.items(), _nearest(x, norms, stacks)):
            n = stats[:, 0]
            size = np.maximum(n, 1)
            away = np.maximum(norms[:, None] + stats[:, 2] / size - 2.0 * (x @ sums.T) / size, 0.0)
            away[:, n == 0] = np.inf
            at = np.arange(len(x))
            own = away[at, label] * n[label] / np.maximum(n[label] - 1, 1)
            away[at, label] = np.inf
            other = away.min(axis=1)
            most = np.maximum(own, other)
            fits = (n[label] > 1) & np.isfinite(other) & (most > 0)
            score = np.where(fits, (np.where(fits, other, 0.0) - own) / np.where(fits, most, 1.0), 0.0)
            yield (m,), np.array([score.sum(), len(x)])

    parts = _scan(points, work, "model int, v array<double>", sum(map(len, stacks)))
    sums = parts.groupBy("model").agg((F.sum(F.col("v")[0]) / F.sum(F.col("v")[1])).alias("s"))
    return {r["model"]: float(r["s"]) for r in sums.collect()}


def best_k(fits: Mapping[int, Clusters]) -> int:
    """The k of the best silhouette, the smaller of equal ones."""
    return max(fits, key=lambda k: (fits[k].silhouette_sq, -k))


def kmeans_search(
    df: DataFrame, cols: Sequence[str], k_range: Iterable[int] = range(2, 11), n_init: int = 10, seed: int = 42
) -> DataFrame:
    """(k, inertia, silhouette_sq, sizes, is_chosen): silhouette on squared distance; sizes largest first; the k with the best
    silhouette is chosen."""
    fits = fit_kmeans(df, cols, k_range, n_init, seed)
    pick = best_k(fits)
    rows = [(k, f.inertia, f.silhouette_sq, sorted(f.sizes.tolist(), reverse=True), k == pick) for k, f in fits.items()]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_sq double, sizes array<bigint>, is_chosen boolean")


def assign_clusters(
    df: DataFrame, cols: Sequence[str], k: int | Iterable[int], n_init: int = 10, seed: int = 42, out: str = "cluster_id"
) -> DataFrame:
    """Cluster ids numbered by size (largest first), ties by centroid, so they do not depend on the start. Of several `k` the
    one with the best silhouette counts."""
    fits = fit_kmeans(df, cols, [k] if isinstance(k, int) else k, n_init, seed)
    return nearest_centre(df, cols, fits[best_k(fits)], out)


def nearest_centre(df: DataFrame, cols: Sequence[str], fit: Clusters, out: str = "cluster_id") -> DataFrame:
    """Each row's cluster id, numbered by size; of equally near centres the one of the larger cluster."""
    order = sorted(range(len(fit.centres)), key=lambda i: (-fit.sizes[i], tuple(fit.centres[i])))

    def gap(i: int) -> Column:
        return reduce(add, [(F.col(c).cast("double") - float(v)) ** 2 for c, v in zip(cols, fit.centres[i])])

    kept = [i for i in order if fit.sizes[i]]
    nearest = F.array_min(F.array(*[F.struct(gap(i).alias("gap"), F.lit(new).cast("bigint").alias("id")) for new, i in enumerate(kept)]))
    return df.withColumn(out, nearest["id"])


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of x and y by one matrix product; those of near rows, where the product loses digits, are
    taken again from the differences."""
    gaps = x @ y.T
    gaps *= -2.0
    norms = (x**2).sum(axis=1)[:, None], (y**2).sum(axis=1)
    gaps += norms[0]
    gaps += norms[1]
    i, j = np.nonzero(gaps < 1e-5 * (norms[0] + norms[1]))
    step = max(1, 2_000_000 // max(1, x.shape[1]))
    for at in range(0, len(i), step):
        m, n = i[at : at + step], j[at : at + step]
        gaps[m, n] = ((x[m] - y[n]) ** 2).sum(axis=1)
    return np.sqrt(gaps, out=gaps)


STRIP_ROWS, LEAST_STRIPS = 8192, 8


def silhouette(
    df: DataFrame, row_id: str, cluster: str, cols: Sequence[str], block_rows: int = 2000
) -> DataFrame:
    """(silhouette): exact mean silhouette on Euclidean distance.

    Rows are hashed into strips and strips meet pairwise, each pair once: a task holds two strips of some 8,192 rows, measures
    `block_rows` of one against `block_rows` of the other at a time and returns only distance sums per row and cluster, for
    both sides, so no row pair is ever written out. A row is sent once for every strip, so large strips keep the shuffle small.
    The work is quadratic in the rows: for very many rows use the squared-distance score of `kmeans_search`.
    """
    n_rows = df.count()
    strips = min(max(1, math.ceil(n_rows / block_rows)), max(LEAST_STRIPS, math.ceil(n_rows / STRIP_ROWS)))
    base = df.select(
        F.col(row_id).alias("id"),
        F.col(cluster).alias("c"),
        F.array(*[F.col(c).cast("double") for c in cols]).alias("v"),
        F.pmod(F.xxhash64(row_id), F.lit(strips)).cast("int").alias("own"),
    )
    label = dict(base.dtypes)["c"]
    key_type = dict(base.dtypes)["id"]
    other = base.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    met = other.select("id", "c", "v", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))

    def listed(rows: pd.DataFrame, labels: np.ndarray, total: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        m = len(labels)
        return pd.DataFrame(
            {
                "id": np.repeat(rows["id"].to_numpy(), m),
                "c": np.repeat(rows["c"].to_numpy(), m),
                "o": np.tile(labels, len(rows)),
                "d": total.ravel(),
                "n": np.tile(counts.astype("int64"), len(rows)),
            }
        )

    def sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lo, hi = key
        a, b = (rows[rows["own"] == s] for s in (lo, hi))
        if a.empty or b.empty:
            return pd.DataFrame({"id": [], "c": [], "o": [], "d": [], "n": []})
        sides = []
        for side in (a, b):
            labels, where = np.unique(side["c"].to_numpy(), return_inverse=True)
            sides.append((np.stack(side["v"].to_numpy()), labels, np.eye(len(labels))[where]))
        (x, of_a, in_a), (y, of_b, in_b) = sides
        to_b, to_a = np.zeros((len(x), len(of_b))), np.zeros((len(y), len(of_a)))
        for i in range(0, len(x), block_rows):
            for j in range(0, len(y), block_rows):
                dist = _distances(x[i : i + block_rows], y[j : j + block_rows])
                to_b[i : i + block_rows] += dist @ in_b[j : j + block_rows]
                if lo != hi:
                    to_a[j : j + block_rows] += dist.T @ in_a[i : i + block_rows]
        out = listed(a, of_b, to_b, in_b.sum(axis=0))
        return out if lo == hi else pd.concat([out, listed(b, of_a, to_a, in_a.sum(axis=0))])

    # As many partitions as tiles, so that few tiles do not gather in one task.
    dealt = met.repartition(strips * (strips + 1) // 2, "lo", "hi")
    found = dealt.groupBy("lo", "hi").applyInPandas(sums, f"id {key_type}, c {label}, o {label}, d double, n bigint")
    by_cluster = found.groupBy("id", "c", "o").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    same = F.col("c") == F.col("o")
    scored = by_cluster.groupBy("id").agg(
        F.max(F.when(same, F.try_divide("d", F.col("n") - 1))).alias("a"),
        F.min(F.when(~same, F.col("d") / F.col("n"))).alias("b"),
    )
    # A row alone in its cluster has no `a` and scores 0.
    value = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return scored.agg(F.avg(F.when(F.col("a").isNull(), 0.0).otherwise(value)).alias("silhouette"))


def davies_bouldin(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """(davies_bouldin): mean over clusters of the worst (scatter_i + scatter_j) / centroid distance."""
    dims = [f"__m{i}" for i in range(len(cols))]
    centres = df.groupBy(cluster).agg(*[F.avg(c).alias(m) for c, m in zip(cols, dims)])
    gap = F.sqrt(sum(((F.col(c) - F.col(m)) ** 2 for c, m in zip(cols, dims)), F.lit(0.0)))
    spread = (
        df.select(cluster, *cols)
        .join(centres, cluster)
        .groupBy(cluster, *dims)
        .agg(F.avg(gap).alias("s"))
    )
    # One short row per cluster; the few of them sit in one array and are compared there.
    listed = spread.agg(
        F.collect_list(F.struct(F.col(cluster).alias("c"), "s", F.array(*dims).alias("m"))).alias("all")
    )

    def worst(i: Column) -> Column:
        apart = lambda j: F.sqrt(
            F.aggregate(F.zip_with(i["m"], j["m"], lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda t, v: t + v)
        )
        others = F.filter(F.col("all"), lambda j: j["c"] != i["c"])
        return F.array_max(F.transform(others, lambda j: F.try_divide(i["s"] + j["s"], apart(j))))

    rows = listed.select(F.explode(F.transform("all", worst)).alias("r"))
    return rows.agg(F.avg("r").alias("davies_bouldin"))


def cluster_entities(
    df: DataFrame,
    entity: str,
    order: str,
    features: Sequence[str],
    k: int | Iterable[int] = fixed.CLUSTERS,
    code: str | None = None,
    excluded: Sequence[str] = (),
    scale_first: bool = True,
    names: Mapping[int, str] | None = None,
    n_init: int = 10,
    variance: float = fixed.PCA_VARIANCE,
) -> DataFrame:
    """Latest state per entity, standardised, reduced by PCA and clustered.

    `scale_first` standardises over all periods and then takes the latest; otherwise the latest rows are
    standardised among themselves.
    """
    scaled = [f"{f}_z" for f in features]
    if scale_first:
        df = zscore(df, features)
    latest = latest_non_null(df, [entity], order)
    if code and excluded:
        latest = exclude(latest, code, excluded)
    if not scale_first:
        latest = zscore(latest.na.fill(0.0, list(features)), features)
    scores, table = pca_project(latest, scaled, variance)
    kept = [c for c in scores.columns if c.startswith("pc") and c[2:].isdigit()]
    out = assign_clusters(scores, kept, k, n_init)
    if names:
        out = out.withColumn("cluster_name", map_label(F.col("cluster_id").cast("int"), names))
    return out.drop(*scaled)


def cluster_sizes(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))  # one row per cluster
