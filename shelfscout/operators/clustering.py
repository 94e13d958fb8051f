"""K-means with restarts, its step-by-step form, silhouette, lift profiles and stability."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from shelfscout.functions.scalars import rounded
from shelfscout.functions.vectors import GRID
from shelfscout.operators.blocks import matrix, pack, pair
from shelfscout.operators.dense import chunks, double_lists
from shelfscout.operators.ordered import with_position
from shelfscout.operators.sampling import fixed_sample
from shelfscout.session import spill

SAMPLE_BLOCK = 1024
# Columns of a sum that one row carries; wider sums take several rows.
SUM_COLUMNS = 128
# Rows whose distances to the centres of all runs are worked on at a time; they stay in the cache of a core.
STRIP = 1024


def _snapped(values: np.ndarray) -> np.ndarray:
    """Same grid as the vector expressions: sums over rows come out equal however the rows are split."""
    return np.floor(values * GRID + 0.5) / GRID


def _distances(piece: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (piece**2).sum(axis=1)[:, None] - 2.0 * piece @ centres.T + (centres**2).sum(axis=1)[None, :]
    return np.maximum(squares, 0.0)


class _Met:
    """Centres of several runs, stacked, and what the rows met so far come to: per centre sum, count and squared distances."""

    def __init__(self, stacked: np.ndarray, starts: np.ndarray) -> None:
        self.starts, self.turned = starts, np.ascontiguousarray(-2.0 * stacked.T)
        self.squares = (stacked**2).sum(axis=1)
        self.sums, self.sizes, self.sse = np.zeros_like(stacked), np.zeros(len(stacked)), np.zeros(len(stacked))

    def distances(self, strip: np.ndarray) -> np.ndarray:
        """Squared distances less the squared length of the row, which is the same for all centres."""
        products = strip @ self.turned
        products += self.squares
        return products

    def meet(self, piece: np.ndarray) -> None:
        """Each row joins its nearest centre of every run, the lowest number on ties."""
        for first in range(0, len(piece), STRIP):
            strip = _snapped(piece[first : first + STRIP])
            found, rows = self.distances(strip), np.arange(len(strip))
            own, member = (strip**2).sum(axis=1), np.zeros(found.shape)
            for lo, hi in zip(self.starts[:-1], self.starts[1:]):
                nearest = found[:, lo:hi].argmin(axis=1) + lo
                member[rows, nearest] = 1.0
                self.sse += np.bincount(nearest, np.maximum(found[rows, nearest] + own, 0.0), len(self.sse))
            self.sums += member.T @ strip
            self.sizes += member.sum(axis=0)


def _columns(points: DataFrame) -> list[str]:
    return ["vec"] if "vec" in points.columns else ["indices", "values"]


# -- single steps ---------------------------------------------------------------------------------------


def assign_nearest(points: DataFrame, key: str, centres: np.ndarray) -> DataFrame:
    """``(key, cluster, d2)``: nearest centre and squared distance, the lowest number on ties."""
    centres = _snapped(np.asarray(centres, dtype=float))
    width = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, piece in chunks(batch, width):
                d2 = _distances(_snapped(piece), centres)
                nearest = d2.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(first, len(piece)),
                        pa.array(nearest.astype(np.int32)),
                        pa.array(d2[np.arange(len(piece)), nearest]),
                    ],
                    names=[key, "cluster", "d2"],
                )

    kind = dict(points.dtypes)[key]
    return points.select(key, *_columns(points)).mapInArrow(run, f"{key} {kind}, cluster int, d2 double")


def cluster_sse(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("d2").alias("sse"))


def cluster_means(points: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """New centres, sizes and the SSE before the update, from one pass. An empty cluster keeps its centre."""
    state = _step(points, [np.asarray(centres, dtype=float)])
    return state[0]


def lloyd_descent(points: DataFrame, key: str, k: int, seeds: Sequence[int]) -> DataFrame:
    """One Lloyd step per seed: ``(seed, j_before, j_after, delta_j, descent_ok)``.

    All seeds share two passes over the points.
    """
    starts = [
        np.array([r["vec"] for r in fixed_sample(points.select(key, "vec"), key, k, seed).collect()]) for seed in seeds
    ]
    before = _step(points, starts)
    after = _step(points, [centres for centres, _, _ in before])
    rows = [
        (int(s), b[2], a[2], a[2] - b[2], bool(a[2] <= b[2])) for s, b, a in zip(seeds, before, after)
    ]
    schema = "seed int, j_before double, j_after double, delta_j double, descent_ok boolean"
    return points.sparkSession.createDataFrame(rows, schema)


def _step(points: DataFrame, runs: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """One Lloyd step of several independent runs in one pass over the points.

    Tasks return sums per (run, cluster); their number does not depend on the rows.
    """
    snapped = [_snapped(c) for c in runs]
    stacked = np.concatenate(snapped)
    starts = np.cumsum([0] + [len(c) for c in snapped])
    width = stacked.shape[1]
    columns = max(1, min(width, SUM_COLUMNS))
    slices = -(-width // columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = _Met(stacked, starts)
        for batch in batches:
            for _, piece in chunks(batch, width):
                met.meet(piece)
        sums, sizes, sse = met.sums, met.sizes, met.sse
        used = np.flatnonzero(sizes)
        padded = np.pad(sums[used], ((0, 0), (0, slices * columns - width))).reshape(-1, columns)
        each = lambda values: pa.array(np.repeat(values[used], slices))
        cells = [
            pa.array(np.repeat(used, slices).astype(np.int32)), pa.array(np.tile(np.arange(slices, dtype=np.int32), len(used))),
            double_lists(padded), each(sizes), each(sse),
        ]
        yield pa.RecordBatch.from_arrays(cells, names=["c", "slice", "s", "n", "sse"])

    parts = points.select(*_columns(points)).mapInArrow(run, "c int, slice int, s array<double>, n double, sse double")
    # Plain sums of grid values are exact in any order.
    summed = ", ".join(f"sum(s[{j}])" for j in range(columns))
    totals = parts.groupBy("c", "slice").agg(F.expr(f"array({summed}) AS s"), F.sum("n").alias("n"), F.sum("sse").alias("sse"))
    centres, sizes, sse = stacked.copy(), np.zeros(len(stacked)), np.zeros(len(stacked))
    for row in totals.collect():
        first = row["slice"] * columns
        mean = np.array(row["s"]) / row["n"]
        centres[row["c"], first : first + columns] = mean[: width - first]
        if not row["slice"]:
            sizes[row["c"]], sse[row["c"]] = row["n"], row["sse"]
    return [
        (centres[lo:hi], sizes[lo:hi], float(sse[lo:hi].sum())) for lo, hi in zip(starts[:-1], starts[1:])
    ]


# -- K-means --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class KMeansSpec:
    """One clustering: ``n_init`` restarts from ``seed``, the best kept."""

    name: str
    k: int
    seed: int = 42
    n_init: int = 10


@dataclass
class KMeansFit:
    spec: KMeansSpec
    centres: np.ndarray
    sizes: np.ndarray
    inertia: float


def _mixed(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from row hashes (the splitmix64 finalizer), equal on every run."""
    with np.errstate(over="ignore"):
        x = hashes.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return ((x >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def _spread_starts(points: DataFrame, key: str, specs: list[tuple[int, int, int]], width: int) -> list[np.ndarray]:
    """k-means++ starts of all runs together; ``specs`` holds (k, seed, restart).

    A row is drawn with probability proportional to its squared distance by the exponential race: the least
    -ln(u) / d2 wins. Each round is one pass and returns one row per run.
    """
    centres: list[list[np.ndarray]] = [[] for _ in specs]
    hashed = points.select(F.xxhash64(key).alias("_h"), *_columns(points))
    for number in range(max(k for k, _, _ in specs)):
        open_ = [i for i, (k, _, _) in enumerate(specs) if number < k]
        salts = {i: (specs[i][1] * 1009 + specs[i][2]) * 131 + number for i in open_}
        # Every open run has ``number`` centres by now.
        known = np.array([c for i in open_ for c in centres[i]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[float, int, np.ndarray]] = {}
            met = _Met(known, np.arange(0, len(known) + 1, number)) if len(known) else None
            for batch in batches:
                hashes = np.asarray(batch.column("_h"))
                for first, piece in chunks(batch, width):
                    for at in range(0, len(piece), STRIP):
                        strip = _snapped(piece[at : at + STRIP])
                        part = hashes[first + at : first + at + len(strip)]
                        if met is not None:
                            nearest = np.minimum.reduceat(met.distances(strip), met.starts[:-1], axis=1)
                            weights = np.maximum(nearest + (strip**2).sum(axis=1)[:, None], 0.0)
                        for place, i in enumerate(open_):
                            weight = weights[:, place] if met is not None else np.ones(len(strip))
                            with np.errstate(divide="ignore"):
                                race = np.where(weight > 0, -np.log(_mixed(part, salts[i])) / weight, np.inf)
                            win = int(race.argmin())
                            entry = (float(race[win]), int(part[win]), strip[win])
                            # Where all rows lie on centres the first of a piece is taken.
                            if i not in best or (entry[:2] < best[i][:2] and (not at or entry[0] < np.inf)):
                                best[i] = entry
            for i, (race, hash_, vector) in best.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([race]), pa.array([hash_]), pa.array([vector.tolist()])],
                    names=["run", "race", "h", "v"],
                )

        drawn = hashed.mapInArrow(run, "run int, race double, h long, v array<double>")
        winners = drawn.groupBy("run").agg(F.min_by("v", F.struct("race", "h")).alias("v"))
        for row in winners.collect():
            centres[row["run"]].append(np.array(row["v"]))
    return [np.array(c) for c in centres]


def fit_kmeans(
    points: DataFrame, key: str, specs: Sequence[KMeansSpec], width: int, max_iter: int = 300, tol: float = 1e-4
) -> list[KMeansFit]:
    """All restarts of all ``specs`` at once: every pass over the points advances each run by one step.

    ``points`` is read once per pass, so hand in a written table. Runs that have settled drop out.
    """
    plan = [(n, s.k, s.seed, r) for n, s in enumerate(specs) for r in range(s.n_init)]
    # Against a centre at the origin a step returns the mean, the count and the sum of squares.
    mean, count, squares = _step(points, [np.zeros((1, width))])[0]
    threshold = tol * max(squares / max(count[0], 1) - float((mean**2).sum()), 0.0) / width
    runs = _spread_starts(points, key, [p[1:] for p in plan], width)
    done: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
    active = list(range(len(plan)))
    for _ in range(max_iter):
        moved = _step(points, [runs[i] for i in active])
        still = []
        for i, (centres, sizes, sse) in zip(active, moved):
            shift = float(((centres - runs[i]) ** 2).sum())
            runs[i] = centres
            if shift > threshold:
                still.append(i)
        active = still
        if not active:
            break
    for i, state in enumerate(_step(points, runs)):
        done[i] = (runs[i], state[1], state[2])
    fits = []
    for n, spec in enumerate(specs):
        mine = [done[i] for i, p in enumerate(plan) if p[0] == n]
        # Restarts that end alike differ in the last digits of their sums; the first of them is kept.
        centres, sizes, inertia = min(mine, key=lambda state: float(f"{state[2]:.9g}"))
        fits.append(KMeansFit(spec, centres, sizes, inertia))
    return fits


# -- tables about a clustering ----------------------------------------------------------------------------


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, size, share)``; as many rows as clusters."""
    sizes = assigned.groupBy(cluster).agg(F.count("*").alias("size"))
    return sizes.withColumn("share", F.col("size") / F.sum("size").over(Window.partitionBy()))


def size_summary(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    return cluster_sizes(assigned, cluster).agg(
        F.min("size").alias("min_size"), F.max("size").alias("max_size"), F.max("share").alias("largest_share")
    )


def cluster_profiles(
    assigned: DataFrame, cells: DataFrame, key: str, cluster: str = "cluster", top: int = 5, min_support: float = 0.0
) -> DataFrame:
    """Top tokens per cluster by lift = P(token | cluster) / P(token).

    ``cells`` holds distinct (key, token) pairs. Shares below ``min_support`` are left out when it is set.
    """
    sizes = cluster_sizes(assigned, cluster)
    joined = cells.join(assigned.select(key, cluster), key)
    counts = joined.groupBy("token", cluster).agg(F.count("*").alias("n"))
    # Per token at most one row per cluster.
    total = F.sum("n").over(Window.partitionBy("token"))
    everything = F.broadcast(sizes.withColumn("_all", F.sum("size").over(Window.partitionBy())))
    rated = counts.withColumn("_total", total).join(everything, cluster)
    lift = (F.col("n") / F.col("size")) / (F.col("_total") / F.col("_all"))
    rated = rated.select(
        cluster, "size", "share", "token", lift.alias("lift"), (F.col("n") / F.col("size")).alias("cluster_freq")
    ).where(F.col("cluster_freq") >= min_support)
    order = Window.partitionBy(cluster).orderBy(F.desc(rounded("lift", 9)), F.asc("token"))
    return rated.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def adjusted_rand(labels: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Adjusted Rand index of two labelings of the same rows: ``(*by, ari)``; 1 when both are trivial."""
    cells = labels.groupBy(*by, a, b).agg(F.count("*").cast("double").alias("n"))

    def choose2(c):
        return F.sum(c * (c - 1) / 2)

    keys = list(by) or [F.lit(0).alias("_k")]
    names = list(by) or ["_k"]
    both = cells.groupBy(*keys).agg(choose2(F.col("n")).alias("ab"), F.sum("n").alias("total"))
    rows = cells.groupBy(*keys, a).agg(F.sum("n").alias("n")).groupBy(*names).agg(choose2(F.col("n")).alias("a2"))
    cols = cells.groupBy(*keys, b).agg(F.sum("n").alias("n")).groupBy(*names).agg(choose2(F.col("n")).alias("b2"))
    expected = F.col("a2") * F.col("b2") / (F.col("total") * (F.col("total") - 1) / 2)
    room = (F.col("a2") + F.col("b2")) / 2 - expected
    ari = F.when(F.abs(room) < 1e-12, F.lit(1.0)).otherwise((F.col("ab") - expected) / room)
    return both.join(rows, names).join(cols, names).select(*by, ari.alias("ari"))


def seed_pairs(runs: DataFrame, seed: str = "seed") -> DataFrame:
    """Unordered pairs of a short list of runs."""
    left, right = runs.select(F.col(seed).alias("seed_a")), runs.select(F.col(seed).alias("seed_b"))
    return left.join(right, F.col("seed_a") < F.col("seed_b"))


def stability(points: DataFrame, key: str, k: int, seeds: Sequence[int], width: int, n_init: int = 10) -> DataFrame:
    """ARI of each pair of runs that differ in their seed: ``(seed_a, seed_b, ari)``.

    All runs are assigned in one row per point, and the contingency tables counted from that.
    """
    fits = fit_kmeans(points, key, [KMeansSpec(str(s), k, s, n_init) for s in seeds], width)
    labels = assign_many(points, key, [f.centres for f in fits])
    pairs = [(a, b) for i, a in enumerate(range(len(seeds))) for b in range(i + 1, len(seeds))]
    entry = F.array(
        *[
            F.struct(
                F.lit(int(seeds[a])).alias("seed_a"), F.lit(int(seeds[b])).alias("seed_b"),
                F.col("labels")[a].alias("a"), F.col("labels")[b].alias("b"),
            )
            for a, b in pairs
        ]
    )
    return adjusted_rand(labels.select(F.inline(entry)), "a", "b", ["seed_a", "seed_b"])


def stability_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("ari").alias("mean_ari"), F.min("ari").alias("min_ari"), F.count("*").alias("n_pairs"))


def assign_many(points: DataFrame, key: str, runs: Sequence[np.ndarray]) -> DataFrame:
    """``(key, labels)``: nearest centre of each run, in one pass."""
    snapped = [_snapped(np.asarray(c, dtype=float)) for c in runs]
    width = snapped[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, piece in chunks(batch, width):
                piece = _snapped(piece)
                found = np.stack([_distances(piece, c).argmin(axis=1) for c in snapped], axis=1).astype(np.int32)
                offsets = pa.array(np.arange(0, (len(piece) + 1) * len(snapped), len(snapped), dtype=np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(first, len(piece)), lists], names=[key, "labels"])

    kind = dict(points.dtypes)[key]
    return points.select(key, *_columns(points)).mapInArrow(run, f"{key} {kind}, labels array<int>")


# -- silhouette -------------------------------------------------------------------------------------------


def silhouette_sampled(
    points: DataFrame, labels: DataFrame, key: str, width: int, size: int = 10_000, seed: int = 42, cluster: str = "cluster"
) -> DataFrame:
    """Euclidean silhouette of a sample of at most ``size`` rows: ``(silhouette, n)``.

    All distances within the sample are formed in blocks; a cluster of one row counts 0.
    """
    columns = _columns(points)
    # At most ``size`` keys.
    keys = F.broadcast(fixed_sample(points.select(key), key, size, seed))
    sample = points.select(key, *columns).join(keys, key).join(labels.select(key, cluster).join(keys, key), key)
    placed = spill(with_position(sample, [key], "_i"), "sample")
    n = placed.count()
    if "vec" not in columns:
        zero = F.array_repeat(F.lit(0.0), width)
        filled = F.map_from_arrays("indices", "values")
        placed = placed.withColumn("_m", filled).withColumn(
            "vec", F.transform(zero, lambda _, j: F.coalesce(F.col("_m")[j], F.lit(0.0)))
        )
    rows_per_block = min(SAMPLE_BLOCK, max(64, 4_000_000 // max(width, 1)))
    number = F.floor(F.col("_i") / rows_per_block).cast("int")
    left = pack(placed.withColumn("_lb", number), "_lb", ["vec"], [key, cluster])
    right = pack(placed.select(number.alias("_rb"), F.col("vec").alias("_v"), F.col(cluster).alias("_c")), "_rb", ["_v"], ["_c"])
    n_blocks = -(-n // rows_per_block)
    both = pair(left, right, n_blocks, n_blocks, n * width * 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a = matrix(batch.column("vec"), row, batch.column("_lb_size")[row].as_py())
                b = matrix(batch.column("_v"), row, batch.column("_rb_size")[row].as_py())
                groups = np.asarray(batch.column("_c")[row].values)
                distance = np.sqrt(_distances(_snapped(a), _snapped(b)))
                ids, own = batch.column(key)[row].values, batch.column(cluster)[row].values
                for group in np.unique(groups):
                    member = groups == group
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids, own,
                            pa.array(np.full(len(a), group, dtype=np.int32)),
                            pa.array(distance[:, member].sum(axis=1)),
                            pa.array(np.full(len(a), member.sum(), dtype=np.int64)),
                        ],
                        names=["id", "own", "other", "d", "n"],
                    )

    kind = dict(points.dtypes)[key]
    own_kind = dict(labels.dtypes)[cluster]
    parts = both.mapInArrow(run, f"id {kind}, own {own_kind}, other int, d double, n long")
    per_group = parts.groupBy("id", "own", "other").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    mine = F.col("own") == F.col("other")
    scored = per_group.groupBy("id").agg(
        F.max(F.when(mine, F.col("n"))).alias("size"),
        F.max(F.when(mine, F.col("d") / F.greatest(F.col("n") - 1, F.lit(1)))).alias("a"),
        F.min(F.when(~mine, F.col("d") / F.col("n"))).alias("b"),
    )
    value = F.when((F.col("size") <= 1) | F.col("b").isNull(), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b")
    )
    return scored.agg(F.avg(value).alias("silhouette"), F.count("*").alias("n"))


def silhouette_full(points: DataFrame, labels: DataFrame, key: str, cluster: str = "cluster") -> float:
    """Squared-Euclidean silhouette of all rows, linear in their number."""
    joined = points.select(key, array_to_vector(F.col("vec")).alias("features")).join(
        labels.select(key, F.col(cluster).cast("double").alias("prediction")), key
    )
    return ClusteringEvaluator(metricName="silhouette").evaluate(joined)
