"""Exact top-k inner products by norm buckets.

Vectors are sorted by length and packed into buckets of near-equal length. The longest bucket gives every query a first
exact list, whose last score is the threshold that any further candidate has to reach. For a query and a bucket this
is a local cosine threshold, threshold / (|q| * longest of the bucket): above 1 the bucket is skipped; where it is high
the candidates are pruned by coordinates (the component of the normalised vector on the query's heaviest axes must lie in an
interval), else by length (only the prefix that is long enough). Survivors are verified by exact integer products.

Queries are packed into blocks; a block meets a bucket only if one of its queries may find something there. A task holds one
block and one bucket, and at most ``HELD_BLOCKS`` running lists.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part; shorter vectors count as
padded with zeros; a query's own id is no candidate; a query repeated word for word is answered once; ties go to the smaller id,
a NULL id asks nothing and is never found; products beyond a long are held at its ends; an empty table gives an empty one.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfscout.llm.common import named
from shelfscout.session import spill, task_count

SCALE = 64
QUERY_EVERY = 20
TOP = 20
BUCKET_ROWS = 4096
BLOCK_ROWS = 1024
HELD_BLOCKS = 8
# From this local cosine threshold on, coordinates prune better than the length does.
COORDINATE_COSINE = 0.7
AXES = 3
EXACT = float(1 << 53)

_BLOCK = "no long, longest double, reach double, ids binary, norms binary, vecs binary, width int"


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, NULL where the vector takes no part."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * F.lit(float(scale))) == float("inf")))
    scaled = F.transform(doubles, lambda x: x * F.lit(float(scale)))
    # floor() of a double is a long in Spark; take the fraction off instead, so that any size stays a double.
    floored = F.transform(scaled, lambda x: F.when(F.abs(x) < 4.0e18, F.floor(x).cast("double")).otherwise(x))
    return F.when(~bad, floored)


def _pack(rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of (id, vector) of a partition as blocks of up to ``rows``; ids, norms and vectors are raw arrays."""

    def block(ids: list, vectors: list) -> pa.RecordBatch:
        width = max(map(len, vectors))
        matrix = np.zeros((len(ids), width))
        for i, v in enumerate(vectors):
            matrix[i, : len(v)] = v
        norms = np.linalg.norm(matrix, axis=1)
        order = np.lexsort((ids, -norms))
        matrix, norms, ids = matrix[order], norms[order], np.array(ids, np.int64)[order]
        cells = [[0], [float(norms[0])], [0.0], [ids.tobytes()], [norms.tobytes()], [matrix.tobytes()], [width]]
        kinds = [pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cells, kinds)], ["no", "longest", "reach", "ids", "norms", "vecs", "width"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(i)
                vectors.append(v.values.to_numpy(zero_copy_only=False))
                if len(ids) == rows:
                    yield block(ids, vectors)
                    ids, vectors = [], []
        if ids:
            yield block(ids, vectors)

    return run


class _Block:
    """Unpacked block or bucket, longest vector first."""

    def __init__(self, ids: bytes, norms: bytes, vecs: bytes, width: int):
        self.ids, self.norms = np.frombuffer(ids, np.int64), np.frombuffer(norms)
        self.vecs = np.frombuffer(vecs).reshape(len(self.ids), width)

    def widened(self, width: int) -> np.ndarray:
        extra = width - self.vecs.shape[1]
        return np.pad(self.vecs, ((0, 0), (0, extra))) if extra > 0 else self.vecs


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products as integers; values that doubles cannot hold are multiplied as Python integers."""
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, left.shape[1])
    if most < EXACT:
        return (left @ right.T).astype(np.int64)
    whole_left = np.array([[int(x) for x in row] for row in left], object).reshape(left.shape)
    whole_right = np.array([[int(x) for x in row] for row in right], object).reshape(right.shape)
    exact = whole_left.dot(whole_right.T)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class _Lists:
    """The best ``top`` (score, id) of each query of a block so far."""

    def __init__(self, block: _Block, top: int, floor: np.ndarray):
        self.block, self.top, self.floor = block, top, floor
        self.scores = [np.empty(0, np.int64)] * len(block.ids)
        self.ids = [np.empty(0, np.int64)] * len(block.ids)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = (scores >= self.floor[q]) & (ids != self.block.ids[q])
        scores, ids = scores[keep], ids[keep]
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores[q], scores]), np.concatenate([self.ids[q], ids])
        if len(scores) > 4 * self.top:
            low = np.partition(scores, len(scores) - self.top)[len(scores) - self.top]
            scores, ids = scores[scores >= low], ids[scores >= low]
        order = np.lexsort((ids, -scores.astype(object) if scores.min() == -(2**63) else -scores))[: self.top]
        self.scores[q], self.ids[q] = scores[order], ids[order]
        if len(order) == self.top:
            self.floor[q] = max(self.floor[q], float(self.scores[q][-1]))


def _search(lists: _Lists, bucket: _Block) -> None:
    """All candidates of one bucket that may still enter the lists."""
    width = max(lists.block.vecs.shape[1], bucket.vecs.shape[1])
    queries, vectors = lists.block.widened(width), bucket.widened(width)
    lengths = lists.block.norms
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        need = np.where(lengths > 0, lists.floor / lengths, np.where(lists.floor > 0, np.inf, -np.inf))
        cosine = np.where(bucket.norms[0] > 0, need / bucket.norms[0], np.where(need > 0, np.inf, -np.inf))
    slack = 1e-9
    open_ = np.flatnonzero(~(cosine > 1 + slack))
    sharp = open_[cosine[open_] >= COORDINATE_COSINE]
    for q in sharp:
        t, unit = min(cosine[q], 1.0), queries[q] / lengths[q]
        last = int(np.searchsorted(-bucket.norms, -need[q] * (1 - slack), "right"))
        rows = np.arange(last)
        for axis in np.argsort(-np.abs(unit))[:AXES]:
            side = np.sqrt(max(0.0, (1 - t * t) * (1 - unit[axis] ** 2))) + slack
            part = vectors[rows, axis] / np.maximum(bucket.norms[rows], 1e-300)
            # A cosine of t or more leaves this interval for the component on the axis, open where it holds a pole.
            low = unit[axis] * t - side if unit[axis] > -t else -np.inf
            high = unit[axis] * t + side if unit[axis] < t else np.inf
            rows = rows[(part >= low) & (part <= high)]
        if len(rows):
            lists.add(q, _products(queries[q : q + 1], vectors[rows])[0], bucket.ids[rows])
    flat = open_[cosine[open_] < COORDINATE_COSINE]
    if not len(flat):
        return
    last = np.where(need[flat] > 0, np.searchsorted(-bucket.norms, -need[flat] * (1 - slack), "right"), len(bucket.ids))
    scores = _products(queries[flat], vectors[: int(last.max(initial=0))])
    hit = scores >= lists.floor[flat][:, None]
    for k in np.flatnonzero(hit.any(axis=1)):
        cols = np.flatnonzero(hit[k])
        lists.add(flat[k], scores[k, cols], bucket.ids[cols])


def _emitted(lists: _Lists, no: int) -> pa.RecordBatch:
    sizes = [len(s) for s in lists.scores]
    place = np.repeat(np.arange(len(sizes)), sizes)
    cells = [
        np.full(len(place), no), place, lists.block.ids[place],
        np.concatenate([np.empty(0, np.int64), *lists.ids]), np.concatenate([np.empty(0, np.int64), *lists.scores]),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cells], ["no", "place", "query_id", "vec_id", "score"])


_FOUND = "no long, place long, query_id long, vec_id long, score long"


def top_products(
    df: DataFrame, every: int = QUERY_EVERY, top: int = TOP, id_: str = "vec_id", vector: str = "embedding",
    bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id ``every`` divides, its ``top`` best products."""
    spark = df.sparkSession
    rows = df.select(named(id_).cast("long").alias("id"), whole(named(vector)).alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    norm = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x)
    parts = max(1, -(-total // bucket_rows))
    sorted_ = rows.withColumn("n", norm).repartitionByRange(parts, F.col("n").desc(), "id")
    buckets = spill(sorted_.select("id", "vec").mapInArrow(_pack(bucket_rows), _BLOCK), "vectors")
    asked = rows.where(F.col("id") % every == 0).distinct().repartition(min(task_count(spark), max(1, total // every // block_rows + 1)))
    blocks = spill(asked.mapInArrow(_pack(block_rows), _BLOCK), "queries")

    # Numbers for blocks and buckets: one short row each goes through a window.
    def numbered(packs: DataFrame, order: Column) -> DataFrame:
        marked = spill(packs.withColumn("mark", F.monotonically_increasing_id()), "marked")
        names = marked.select("mark", F.row_number().over(Window.orderBy(order, "mark")).cast("long").alias("rank"))
        return marked.join(spill(names, "names"), "mark").withColumn("no", F.col("rank") - 1).drop("mark", "rank")

    buckets = spill(numbered(buckets, F.col("longest").desc()), "buckets")
    first = buckets.where("no = 0").first()
    if first is None:
        raise RuntimeError("no bucket was written")
    longest = tuple(bytes(first[c]) for c in ("ids", "norms", "vecs")) + (first["width"],)  # one bucket: bucket_rows vectors

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = _Block(*longest)
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row["ids"], row["norms"], row["vecs"], row["width"])
                lists = _Lists(block, top, np.full(len(block.ids), -np.inf))
                _search(lists, bucket)
                yield _emitted(lists, row["no"])

    blocks = spill(numbered(blocks, F.col("longest").desc()), "blocks")
    begun = spill(blocks.repartition(task_count(spark), "no").mapInArrow(start, _FOUND), "begun")

    # Threshold per query: its last score once the list is full.
    floors = begun.groupBy("no", "place").agg(F.min("score").alias("low"), F.count("*").alias("n")).where(F.col("n") >= top)
    floors = floors.groupBy("no").agg(F.map_from_entries(F.collect_list(F.struct(F.col("place").cast("int"), F.col("low").cast("double")))).alias("floors"))
    armed = spill(blocks.join(floors, "no", "left"), "armed")
    rest = buckets.where("no > 0").select(
        F.col("no").alias("bucket"), F.col("longest").alias("b_longest"), F.col("ids").alias("b_ids"), F.col("norms").alias("b_norms"),
        F.col("vecs").alias("b_vecs"), F.col("width").alias("b_width"),
    )
    count = buckets.count()
    if count == 1:
        found = begun
    else:
        # Every block is sent to every later bucket by number; blocks are a stated query set, one in ``every`` rows.
        sent = armed.withColumn("bucket", F.explode(F.sequence(F.lit(1), F.lit(count - 1)).cast("array<long>")))
        met = sent.join(rest.hint("shuffle_hash"), "bucket")
        found = begun.unionAll(met.mapInArrow(_resume(top), _FOUND))
    best = Window.partitionBy("no", "place").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _resume(top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Search rows of (block, bucket), keeping the running lists of the last few blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running: OrderedDict[int, _Lists] = OrderedDict()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                lists = running.get(row["no"])
                if lists is None:
                    block = _Block(row["ids"], row["norms"], row["vecs"], row["width"])
                    floor = np.full(len(block.ids), -np.inf)
                    for place, low in row["floors"] or ():
                        floor[place] = low
                    lists = running[row["no"]] = _Lists(block, top, floor)
                    if len(running) > HELD_BLOCKS:
                        no, done = running.popitem(last=False)
                        yield _emitted(done, no)
                running.move_to_end(row["no"])
                _search(lists, _Block(row["b_ids"], row["b_norms"], row["b_vecs"], row["b_width"]))
        for no, done in running.items():
            yield _emitted(done, no)

    return run
