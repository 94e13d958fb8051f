"""PCA of the numeric block and truncated SVD of the sparse blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfscout.operators.dense import chunks, double_lists, sparse_pieces
from shelfscout.session import passing_tables, spill, task_count

# The driver keeps width x components loadings; refuse what would not fit.
MAX_LOADINGS = 50_000_000
# Numbers of a partial table that travel in one row.
BLOCK_VALUES = 131_072


@dataclass
class Projection:
    """A linear map of rows to components, with the share of variance of each component."""

    loadings: np.ndarray  # width x components
    mean: np.ndarray  # width; zeros when not centred
    singular_values: np.ndarray
    variance_ratio: np.ndarray

    @property
    def width(self) -> int:
        return len(self.mean)

    def first(self, components: int) -> Projection:
        return Projection(
            self.loadings[:, :components], self.mean, self.singular_values[:components], self.variance_ratio[:components]
        )


def _oriented(loadings: np.ndarray) -> np.ndarray:
    """Flip components so that the loading of largest size is positive."""
    top = np.abs(loadings).argmax(axis=0)
    signs = np.sign(loadings[top, np.arange(loadings.shape[1])])
    return loadings * np.where(signs == 0, 1.0, signs)


def fit_pca(rows: DataFrame, width: int, components: int, column: str = "vec") -> Projection:
    """Principal components of a dense block of few columns."""
    vectors = rows.select(array_to_vector(F.col(column)).alias("v"))
    moments = vectors.agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("m")).first()["m"]
    mean, n = np.array(moments["mean"].toArray()), moments["count"]
    components = min(components, width, n)
    model = PCA(k=components, inputCol="v", outputCol="z").fit(vectors)
    ratio = np.array(model.explainedVariance.toArray())
    total = float(np.sum(moments["variance"].toArray())) * (n - 1)
    return Projection(_oriented(np.array(model.pc.toArray())), mean, np.sqrt(np.maximum(ratio * total, 0.0)), ratio)


def project(rows: DataFrame, key: str, projection: Projection, column: str = "vec", out: str = "vec") -> DataFrame:
    """``(key, out)`` with the components of each row; one pass, no shuffle."""
    width, size = projection.width, projection.loadings.shape[1]
    dense = column in rows.columns
    held = rows.sparkSession.sparkContext.broadcast((projection.mean, projection.loadings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, loadings = held.value
        for batch in batches:
            if dense:
                products = ((first, (piece - mean) @ loadings) for first, piece in chunks(batch, width, column))
            else:  # sparse rows are not centred
                products = ((piece.first, piece.times(loadings)) for piece in sparse_pieces(batch, size))
            for first, product in products:
                keys = batch.column(key).slice(first, len(product))
                yield pa.RecordBatch.from_arrays([keys, double_lists(product)], names=[key, out])

    columns = [column] if dense else ["indices", "values"]
    kind = dict(rows.dtypes)[key]
    return rows.select(key, *columns).mapInArrow(run, f"{key} {kind}, {out} array<double>")


def _gram_product(rows: DataFrame, basis: np.ndarray, column: str) -> np.ndarray:
    """(A'A) times ``basis``: partial tables of the tasks, cut into blocks of rows and added up block by block on the cluster.

    Sparse rows are multiplied from their stored values; none is filled up.
    """
    spark, (width, size) = rows.sparkSession, basis.shape
    dense = column in rows.columns
    held = spark.sparkContext.broadcast(basis)
    per_block = max(1, BLOCK_VALUES // size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = held.value, np.zeros((width, size))
        for batch in batches:
            if dense:
                for _, piece in chunks(batch, width, column):
                    total += piece.T @ (piece @ now)
            else:
                for piece in sparse_pieces(batch, size):
                    piece.add_transposed(piece.times(now), total)
        task = TaskContext.get().partitionId()
        for start in range(0, width, per_block):
            part = total[start : start + per_block]
            if part.any():
                yield _block(start // per_block, task, part)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = None, None
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                part = np.asarray(batch.column("part")[i].values).reshape(-1, size)
                if block != number:
                    if total is not None:
                        yield _block(number, 0, total)
                    number, total = block, np.zeros(part.shape)
                total += part
        if total is not None:
            yield _block(number, 0, total)

    kind = "block int, task int, part array<double>"
    parts = rows.select(*([column] if dense else ["indices", "values"])).mapInArrow(run, kind)
    # In the order of the tasks, so that a run repeats to the last bit.
    count = min(-(-width // per_block), task_count(spark))
    dealt = parts.repartitionById(count, F.col("block") % count).sortWithinPartitions("block", "task")
    out = np.zeros((width, size))
    with passing_tables(spark):
        # Written by all tasks at once; fetched by partition, the sums would be worked out by one task after the other.
        for row in spill(dealt.mapInArrow(merged, kind), "gram").toLocalIterator():
            start = row["block"] * per_block
            part = np.array(row["part"]).reshape(-1, size)
            out[start : start + len(part)] = part
    held.unpersist()
    return out


def _block(number: int, task: int, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([task], pa.int32()), double_lists(part.reshape(1, -1))], names=["block", "task", "part"]
    )


def fit_svd(
    rows: DataFrame, width: int, components: int, seed: int = 42, oversample: int = 10, passes: int = 5, column: str = "vec"
) -> Projection:
    """Leading right singular vectors by randomized subspace iteration (Halko, Martinsson and Tropp, 2011).

    Each pass reads the rows once and returns a width x (components + oversample) table; the rows themselves
    are never gathered. ``variance_ratio`` is left empty, see ``svd_variance``.
    """
    n = rows.count()
    limit = min(width, n) - 1
    if limit < 1:
        raise ValueError("a truncated SVD needs at least two rows and two columns")
    components = min(components, limit)
    size = min(components + oversample, width, n)
    if width * size > MAX_LOADINGS:
        raise ValueError(f"{width} x {size} loadings are too many to keep on the driver")
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, size)))[0]
    for _ in range(passes):
        basis = np.linalg.qr(_gram_product(rows, basis, column))[0]
    core = basis.T @ _gram_product(rows, basis, column)
    values, turns = np.linalg.eigh((core + core.T) / 2)
    order = np.argsort(values)[::-1][:components]
    loadings = _oriented(basis @ turns[:, order])
    return Projection(loadings, np.zeros(width), np.sqrt(np.maximum(values[order], 0.0)), np.empty(0))


def svd_variance(rows: DataFrame, projected: DataFrame, projection: Projection) -> Projection:
    """Fill in var(component) / total variance of the input columns. Shares need not fall with the index."""
    n = rows.count()
    cells = rows.select(F.explode(F.arrays_zip("indices", "values")).alias("c")).select("c.indices", "c.values")
    per_column = cells.groupBy("indices").agg(F.sum("values").alias("s"), F.sum(F.col("values") ** 2).alias("q"))
    total = per_column.agg(F.sum(F.col("q") / n - (F.col("s") / n) ** 2)).first()[0]
    variance = projected.agg(Summarizer.variance(array_to_vector(F.col("vec"))).alias("v")).first()["v"]
    ratio = np.array(variance.toArray()) * (n - 1) / n / total if total else np.zeros(len(projection.singular_values))
    return Projection(projection.loadings, projection.mean, projection.singular_values, ratio)


def _energy(column: str):
    return F.sum(F.aggregate(F.col(column), F.lit(0.0), lambda acc, x: acc + x * x))


def reconstruction_error(rows: DataFrame, projected: DataFrame, projection: Projection, column: str = "vec") -> DataFrame:
    """Frobenius norm of what the components leave out, and relative to the input.

    The loadings are orthonormal, so the squared norms are subtracted and nothing is rebuilt.
    """
    source = column if column in rows.columns else "values"
    if projection.mean.any():
        centre = F.lit(projection.mean.tolist())
        rows = rows.withColumn(source, F.zip_with(source, centre, lambda x, m: x - m))
    whole = rows.agg(_energy(source).alias("whole")).withColumn("kept", F.lit(None).cast("double"))
    kept = projected.agg(_energy("vec").alias("kept"))
    both = whole.unionByName(kept, allowMissingColumns=True).agg(F.max("whole").alias("whole"), F.max("kept").alias("kept"))
    error = F.sqrt(F.greatest(F.col("whole") - F.col("kept"), F.lit(0.0)))
    return both.select(
        error.alias("frobenius_error"),
        F.when(F.col("whole") > 0, error / F.sqrt("whole")).alias("relative_error"),
    )


def spectrum(spark: SparkSession, values: Sequence[float], name: str = "share") -> DataFrame:
    """``(component, name)``, one row per component (a few hundred at most)."""
    rows = [(i + 1, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"component int, {name} double")


def cumulative(shares: DataFrame, index: str = "component", share: str = "share") -> DataFrame:
    """Running sum over a short list of components."""
    order = Window.orderBy(index).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return shares.withColumn("cumulative", F.sum(share).over(order))


def components_for_share(cumulated: DataFrame, targets: Sequence[float], index: str = "component") -> DataFrame:
    """Fewest components that reach each share; NULL when it is not reached."""
    reached = [
        F.struct(F.lit(float(t)).alias("target"), F.min(F.when(F.col("cumulative") >= t, F.col(index))).alias("components"))
        for t in targets
    ]
    return cumulated.agg(F.array(*reached).alias("all")).select(F.inline("all"))


def singular_shares(projection: Projection) -> np.ndarray:
    """Share of each squared singular value in the retained part only."""
    squares = projection.singular_values**2
    return squares / squares.sum()


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, corr)`` for a <= b from one aggregate over a few columns."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], wide.columns, "pair", "corr")
    return long.select(F.split("pair", r"\|")[0].alias("a"), F.split("pair", r"\|")[1].alias("b"), "corr")
