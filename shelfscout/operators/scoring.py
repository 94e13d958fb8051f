"""Item scores per user and the rank of the held-out item.

A model is a vector per user and a vector per item. Rank and top-K come from block products in which the
train items of the user are masked; no (user, item, score) row is produced except the K results. A task holds a group of user blocks,
lets item blocks pass by and adds up per user, so that what leaves it is a row per user, not one per user and item block.

Tie rule everywhere: score descending, then item id ascending.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfscout.functions.scalars import clean_number
from shelfscout.functions.vectors import dot, on_grid, unit
from shelfscout.operators.blocks import BROADCAST_BYTES, LEFT, MASK, deal, matrix, pack
from shelfscout.operators.ordered import with_position
from shelfscout.session import spill, task_count

USER_BLOCK = 1024
ITEM_BLOCK = 4096
# Users whose scores with one item block are worked on at a time; they stay in the cache of a core.
STRIP = 64


@dataclass(frozen=True)
class Blend:
    """Weighted sum of the first two models, each scaled by the extremes of its scores; model ``only`` when ``alpha`` is None.

    With both, the score is alpha * first + (1 - alpha) * second.
    """

    name: str
    alpha: float | None = None
    extremes: tuple[float, float, float, float] = (0.0, 1.0, 0.0, 1.0)
    only: int = 0

    def scaled(self, first, second):
        """Both scores brought to 0..1; works on columns and on arrays alike."""
        low1, high1, low2, high2 = self.extremes
        return (first - low1) / (high1 - low1 + 1e-9), (second - low2) / (high2 - low2 + 1e-9)

    def mixed(self, first, second):
        """The score from two scaled ones, or the first as it is."""
        return first if self.alpha is None else first * self.alpha + second * (1.0 - self.alpha)


@dataclass
class Scorer:
    """Packed blocks of users and items and the train mask, ready for any number of passes.

    ``models`` names the vector columns; the first two are the ones a ``Blend`` mixes.
    """

    user_blocks: DataFrame
    item_blocks: DataFrame
    masks: DataFrame
    n_blocks: int
    n_items: int
    models: list[str]
    user: str
    item: str
    item_block: int
    user_bytes: int
    item_bytes: int
    fields: dict[str, str] = field(default_factory=dict)
    narrow: bool = False  # all numbers are exact in 32 bits and move as such

    def cells(self, models: Sequence[str], masked: bool = False) -> DataFrame:
        """User and item blocks dealt to cells, with the vectors of some models; ``masked`` adds the train pairs."""

        def vectors(prefix: str) -> list[Column]:
            return [F.col(prefix + m).cast("array<float>").alias(prefix + m) if self.narrow else F.col(prefix + m) for m in models]

        left = self.user_blocks.select("_lb", "_lb_size", self.user, "_held", "_hi", *[f"_s_{m}" for m in models], *vectors(""))
        right = self.item_blocks.select("_rb", "_rb_size", "_item", *vectors("_v_"))
        n_right = max(1, -(-self.n_items // self.item_block))
        return deal(left, right, self.n_blocks, n_right, self.user_bytes, self.item_bytes, self.masks if masked else None)


def prepare(
    users: DataFrame,
    items: DataFrame,
    train: DataFrame,
    heldout: DataFrame,
    models: Sequence[str],
    user: str = "user_id",
    item: str = "item_id",
    user_block: int = USER_BLOCK,
    item_block: int = ITEM_BLOCK,
) -> Scorer:
    """Pack items in their sorted order and users by a hash of their id, and the train pairs per block pair.

    ``users`` and ``items`` carry one array<double> column per model, on the grid. Users without a held-out
    item in ``items`` are left out, as they cannot be tested. A user block has about ``user_block`` rows, an
    item block at most ``item_block``.
    """
    models = list(models)
    # Only the ids are sorted; the vectors join their places afterwards.
    vectors = spill(items.select(item, *models), "item-vectors")
    places = with_position(vectors.select(item), [item], "_i")
    item_rows = vectors.join(places, item)
    n_items = vectors.count()
    n_blocks = max(1, -(-heldout.count() // user_block))
    bucket = F.pmod(F.xxhash64(user), F.lit(n_blocks)).cast("int")

    # Train pairs move as (user, place of the item): a cell is at most a dense block pair, a hot user or item
    # is spread over the blocks of the other side.
    cells = train.join(places, item).select(
        bucket.alias("_lb"),
        F.floor(F.col("_i") / item_block).cast("int").alias("_rb"),
        F.col(user).alias("_mask_user"),
        (F.col("_i") % item_block).cast("int").alias("_mask_item"),
    )
    masks = cells.groupBy("_lb", "_rb").agg(F.collect_list(F.struct("_mask_user", "_mask_item")).alias("_m"))
    masks = spill(masks.select("_lb", "_rb", "_m._mask_user", "_m._mask_item"), "masks")

    held_items = item_rows.select(
        F.col(item).alias("_held"), F.col("_i").alias("_hi"), *[F.col(m).alias(f"_h_{m}") for m in models]
    )
    tested = heldout.select(user, F.col(item).alias("_held")).join(held_items, "_held")
    user_rows = users.select(user, *models).join(tested, user)
    user_rows = user_rows.select(
        user, "_held", "_hi", *models, *[dot(m, f"_h_{m}").alias(f"_s_{m}") for m in models], bucket.alias("_lb")
    )
    # Few, large rows: keep them in as many parts as there are tasks.
    user_rows = user_rows.repartition(min(n_blocks, task_count(users.sparkSession)), "_lb")
    user_blocks = spill(pack(user_rows, "_lb", models, [user, "_held", "_hi", *[f"_s_{m}" for m in models]]), "users")

    right = item_rows.select(
        "_i", F.col(item).alias("_item"), *[F.col(m).alias(f"_v_{m}") for m in models],
        F.floor(F.col("_i") / item_block).cast("int").alias("_rb"),
    )
    item_blocks = spill(pack(right, "_rb", [f"_v_{m}" for m in models], ["_i", "_item"], "_i").drop("_i"), "items")
    widths = vectors.select(*[F.size(m).alias(m) for m in models]).first()
    row_bytes = 8 * (1 + sum(widths)) if widths else 0
    exact = lambda c: F.min(F.forall(c, lambda x: x.cast("float").cast("double") == x))
    checks = [user_blocks.select(*[exact(F.col(m)) for m in models]), item_blocks.select(*[exact(F.col(f"_v_{m}")) for m in models])]
    narrow = all(ok is not False for check in checks for ok in check.first())
    types = {"user": dict(users.dtypes)[user], "item": dict(items.dtypes)[item]}
    user_bytes = n_blocks * user_block * (row_bytes + 8 * (2 + len(models)))
    return Scorer(user_blocks, item_blocks, masks, n_blocks, n_items, models, user, item, item_block, user_bytes, n_items * row_bytes, types, narrow)


@dataclass
class Block:
    """Users that a cell holds, and what is known of them so far."""

    ids: pa.Array
    held_ids: pa.Array
    place: np.ndarray
    vectors: list[np.ndarray]
    targets: list[np.ndarray]
    found: object = None


@dataclass
class Meeting:
    """A block of users and a block of items that passes by: strips of scores and the train pairs among them."""

    users: Block
    items: pa.Array
    vectors: list[np.ndarray]
    first: int  # place of the first item
    hidden: tuple[np.ndarray, np.ndarray]

    def strips(self) -> Iterator[tuple[slice, list[np.ndarray], tuple[np.ndarray, np.ndarray]]]:
        rows, columns = self.hidden
        # Written over by the next strip: fresh memory for each would cost more than the product.
        room = [np.empty((min(STRIP, len(self.users.ids)), len(self.items))) for _ in self.vectors]
        for start in range(0, len(self.users.ids), STRIP):
            part = slice(start, start + STRIP)
            strips = [u[part].astype(np.float64) for u in self.users.vectors]
            products = [np.matmul(u, v.T, out=r[: len(u)]) for u, v, r in zip(strips, self.vectors, room)]
            low, high = np.searchsorted(rows, (start, start + STRIP))
            yield part, products, (rows[low:high] - start, columns[low:high])


def _copied(values: pa.Array) -> pa.Array:
    """The values without the batch they came in."""
    return values.take(pa.array(np.arange(len(values))))


def _meetings(
    batches: Iterator[pa.RecordBatch], models: list[str], user: str, item_block: int, blocks: list[Block]
) -> Iterator[Meeting]:
    """Every pair of blocks of a cell; ``blocks`` is filled with those of users."""
    places: dict[int, int] = {}
    masks: dict[int, tuple[pa.Array, pa.Array]] = {}
    for batch in batches:
        for row, kind in enumerate(batch.column("_kind").to_pylist()):
            if kind == LEFT:
                n = batch.column("_lb_size")[row].as_py()
                places[batch.column("_lb")[row].as_py()] = len(blocks)
                ids, held, place, *targets = (batch.column(c)[row].values for c in (user, "_held", "_hi", *[f"_s_{m}" for m in models]))
                vectors = [matrix(batch.column(m), row, n).copy() for m in models]
                blocks.append(Block(_copied(ids), _copied(held), np.array(place), vectors, [np.array(t) for t in targets]))
            elif kind == MASK:
                masks[places[batch.column("_lb")[row].as_py()]] = (batch.column("_mask_user")[row].values, batch.column("_mask_item")[row].values)
            else:
                n, first = batch.column("_rb_size")[row].as_py(), batch.column("_rb")[row].as_py() * item_block
                vectors = [matrix(batch.column(f"_v_{m}"), row, n).astype(np.float64) for m in models]
                for number, block in enumerate(blocks):
                    hidden = _hidden(block.ids, *masks[number]) if number in masks else (np.empty(0, int), np.empty(0, int))
                    yield Meeting(block, batch.column("_item")[row].values, vectors, first, hidden)
                masks.clear()


def score_extremes(scorer: Scorer) -> dict[str, tuple[float, float]]:
    """Least and greatest score of each model that a ``Blend`` mixes over all users and items."""
    models, user, item_block = scorer.models[:2], scorer.user, scorer.item_block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(len(models), np.inf), np.full(len(models), -np.inf)
        for meeting in _meetings(batches, models, user, item_block, []):
            for _, products, _ in meeting.strips():
                low = np.minimum(low, [p.min() for p in products])
                high = np.maximum(high, [p.max() for p in products])
        if np.isfinite(low).all():
            yield pa.RecordBatch.from_pydict({"model": models, "low": low.tolist(), "high": high.tolist()})

    found = scorer.cells(models).mapInArrow(run, "model string, low double, high double")
    rows = found.groupBy("model").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    return {r["model"]: (r["low"], r["high"]) for r in rows}


def score_summary(scorer: Scorer) -> DataFrame:
    """Per user: number of scored items, least, greatest and summed score of the first model."""
    models, user, item_block = scorer.models[:1], scorer.user, scorer.item_block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[Block] = []
        for meeting in _meetings(batches, models, user, item_block, blocks):
            if meeting.users.found is None:
                n = len(meeting.users.ids)
                meeting.users.found = [np.zeros(n, int), np.full(n, np.inf), np.full(n, -np.inf), np.zeros(n)]
            count, low, high, total = meeting.users.found
            for part, (product,), _ in meeting.strips():
                count[part] += product.shape[1]
                low[part] = np.minimum(low[part], product.min(1))
                high[part] = np.maximum(high[part], product.max(1))
                total[part] += product.sum(1)
        for block in blocks:
            if block.found is not None:
                yield pa.RecordBatch.from_arrays([block.ids, *map(pa.array, block.found)], names=[user, "n", "low", "high", "total"])

    schema = f"{user} {scorer.fields['user']}, n long, low double, high double, total double"
    parts = scorer.cells(models).mapInArrow(run, schema)
    return parts.groupBy(user).agg(
        F.sum("n").alias("n_items"), F.min("low").alias("min_score"), F.max("high").alias("max_score"), F.sum("total").alias("sum_score")
    )


def _hidden(ids: pa.Array, users: pa.Array, items: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the train pairs within a block of scores, by row."""
    rows = pc.index_in(users, value_set=ids)
    known = rows.is_valid()
    rows, columns = np.asarray(rows.filter(known)), np.asarray(items.filter(known))
    order = np.argsort(rows, kind="stable")
    return rows[order], columns[order]


def _both(products: list[np.ndarray], blend: Blend) -> tuple[np.ndarray, np.ndarray | None]:
    return (products[blend.only], None) if blend.alpha is None else blend.scaled(products[0], products[1])


class _Room:
    """Memory for strips of scores that is used again and again, by name."""

    def __init__(self) -> None:
        self.held: dict[object, np.ndarray] = {}

    def like(self, name: object, strip: np.ndarray, kind: type = float) -> np.ndarray:
        found = self.held.get(name)
        if found is None or found.shape[0] < strip.shape[0] or found.shape[1] != strip.shape[1]:
            found = self.held[name] = np.empty(strip.shape, kind)
        return found[: len(strip)]

    def scaled(self, products: list[np.ndarray], blend: Blend) -> tuple[np.ndarray, np.ndarray]:
        """``Blend.scaled`` without new arrays."""
        low1, high1, low2, high2 = blend.extremes
        out = []
        for number, (product, low, high) in enumerate(((products[0], low1, high1), (products[1], low2, high2))):
            made = np.subtract(product, low, out=self.like((blend.extremes, number), product))
            out.append(np.divide(made, high - low + 1e-9, out=made))
        return out[0], out[1]

    def mixed(self, both: tuple[np.ndarray, np.ndarray], blend: Blend) -> np.ndarray:
        """``Blend.mixed`` of two scaled strips without new arrays."""
        first = np.multiply(both[0], blend.alpha, out=self.like("first", both[0]))
        second = np.multiply(both[1], 1.0 - blend.alpha, out=self.like("second", both[1]))
        return np.add(first, second, out=first)

    def scores(self, products: list[np.ndarray], blend: Blend, shared: dict) -> np.ndarray:
        """Scores of a strip; ``shared`` keeps the scaled ones for further blends of it."""
        if blend.alpha is None:
            return products[blend.only]
        if blend.extremes not in shared:
            shared[blend.extremes] = self.scaled(products, blend)
        return self.mixed(shared[blend.extremes], blend)


def heldout_ranks(scorer: Scorer, blends: Sequence[Blend]) -> DataFrame:
    """``(config, user, item, rank)``: 1 + candidates ranked before the held-out item, for each blend."""
    models, user, item, item_block = scorer.models, scorer.user, scorer.item, scorer.item_block
    blends = list(blends)

    def counted(meeting: Meeting, wanted: np.ndarray, before: np.ndarray, room: _Room) -> None:
        """Add to ``before``, per user and blend, the items ahead of the held-out one, whose scores are ``wanted``."""
        place, first, n_items = meeting.users.place, meeting.first, len(meeting.items)
        # Items of equal score count where they come first: all of a block before the held-out item, none of one behind it.
        bounds = np.where((place >= first + n_items)[:, None], np.nextafter(wanted, -np.inf), wanted)
        within = np.flatnonzero((place > first) & (place < first + n_items))
        for part, products, hidden in meeting.strips():
            among = within[(within >= part.start) & (within < part.stop)]
            shared: dict = {}
            for number, blend in enumerate(blends):
                scores = room.scores(products, blend, shared)
                ahead = np.greater(scores, bounds[part, number, None], out=room.like("ahead", scores, bool))
                for row in among:
                    end = place[row] - first
                    ahead[row - part.start, :end] |= scores[row - part.start, :end] == wanted[row, number]
                ahead[hidden] = False
                before[part, number] += np.bitwise_count(np.packbits(ahead, axis=1)).sum(axis=1, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[Block] = []
        room = _Room()
        for meeting in _meetings(batches, models, user, item_block, blocks):
            block = meeting.users
            if block.found is None:
                wanted = np.stack([blend.mixed(*_both(block.targets, blend)) for blend in blends], axis=1)
                block.found = wanted, np.zeros(wanted.shape, np.int64)
            counted(meeting, *block.found, room)
        for block in blocks:
            for number in range(len(blends) if block.found is not None else 0):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(block.ids), number, dtype=np.int32)), block.ids, block.held_ids, pa.array(block.found[1][:, number])],
                    names=["_c", user, item, "n"],
                )

    types = scorer.fields
    parts = scorer.cells(models, masked=True).mapInArrow(run, f"_c int, {user} {types['user']}, {item} {types['item']}, n long")
    names = F.lit([b.name for b in blends])
    ranks = parts.groupBy("_c", user, item).agg((F.sum("n") + 1).alias("rank"))
    return ranks.select(names[F.col("_c")].alias("config"), user, item, "rank")


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` greatest of each row, greatest first, equal ones in column order."""
    k = min(k, scores.shape[1])
    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    above, ties = scores > least, scores == least
    room = k - above.sum(axis=1, keepdims=True)
    ties &= np.cumsum(ties, axis=1, dtype=np.int32) <= room
    columns = np.nonzero(above | ties)[1].reshape(len(scores), k)
    order = np.argsort(-np.take_along_axis(scores, columns, axis=1), axis=1, kind="stable")
    return np.take_along_axis(columns, order, axis=1)


@dataclass
class Best:
    """The ``k`` best of each user so far, best first: scores and numbers of the items within the cell. Later items lose ties."""

    scores: np.ndarray
    items: np.ndarray

    @classmethod
    def none(cls, users: int, k: int) -> Best:
        return cls(np.full((users, k), -np.inf), np.full((users, k), -1))

    def meet(self, part: slice, scores: np.ndarray, first: int) -> None:
        """Scores of a strip with items from number ``first`` on."""
        k = self.scores.shape[1]
        if (self.items[part] < 0).all() and scores.shape[1] >= k:
            best = _best(scores, k)
            self.scores[part], self.items[part] = np.take_along_axis(scores, best, axis=1), first + best
            return
        met = np.flatnonzero(scores.max(axis=1) > self.scores[part, -1])
        if not len(met):
            return
        among, columns = np.divmod(np.flatnonzero(scores[met] > self.scores[part, -1:][met]), scores.shape[1])
        rows = met[among]
        held = self.scores[part][met], self.items[part][met]
        owner = np.concatenate([np.repeat(met, k), rows])
        value = np.concatenate([held[0].ravel(), scores[rows, columns]])
        item = np.concatenate([held[1].ravel(), first + columns])
        # Equal scores stay in the order they came in: held ones first, then by item.
        order = np.lexsort((-value, owner))
        starts = np.searchsorted(owner[order], met)
        chosen = order[starts[:, None] + np.arange(k)]
        self.scores[part.start + met], self.items[part.start + met] = value[chosen], item[chosen]


def top_k(scorer: Scorer, k: int, blend: Blend | None = None) -> DataFrame:
    """``(user, item, score, rank)``: the best ``k`` items of each user that are not in the train set."""
    blend = blend or Blend("")
    models, user, item_block = scorer.models, scorer.user, scorer.item_block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[Block] = []
        names: list[pa.Array] = []
        last, start, seen, room = None, 0, 0, _Room()
        for meeting in _meetings(batches, models, user, item_block, blocks):
            if meeting.first != last:
                last, start = meeting.first, seen
                names.append(_copied(meeting.items))
                seen += len(meeting.items)
            if meeting.users.found is None:
                meeting.users.found = Best.none(len(meeting.users.ids), k)
            for part, products, hidden in meeting.strips():
                scores = room.scores(products, blend, {})
                scores[hidden] = -np.inf
                meeting.users.found.meet(part, scores, start)
        items = pa.concat_arrays(names) if names else None
        for block in blocks if names else []:
            open_ = np.isfinite(block.found.scores)
            rows = np.broadcast_to(np.arange(len(open_))[:, None], open_.shape)[open_]
            yield pa.RecordBatch.from_arrays(
                [block.ids.take(pa.array(rows)), items.take(pa.array(block.found.items[open_])), pa.array(block.found.scores[open_])],
                names=[user, "item", "score"],
            )

    schema = f"{user} {scorer.fields['user']}, item {scorer.fields['item']}, score double"
    found = scorer.cells(models, masked=True).mapInArrow(run, schema).withColumnRenamed("item", scorer.item)
    return best_per_user(found, k, user, scorer.item)


def best_per_user(scores: DataFrame, k: int, user: str = "user_id", item: str = "item_id", score: str = "score") -> DataFrame:
    """First ``k`` rows per user by score, then item. Rows beyond ``k`` are cut before the shuffle as well."""
    order = Window.partitionBy(user).orderBy(F.desc(score), F.asc(item))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def candidates(scores: DataFrame, train: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Scores without the train pairs."""
    return scores.join(train, [user, item], "left_anti")


def heldout_ranks_of_scores(
    scores: DataFrame, train: DataFrame, heldout: DataFrame, user: str = "user_id", item: str = "item_id", score: str = "score"
) -> DataFrame:
    """Rank of the held-out item within a given score table; users whose item has no score are left out."""
    pool = candidates(scores, train, user, item)
    target = pool.join(heldout, [user, item]).select(
        user, F.col(item).alias("_held"), F.col(score).alias("_target")
    )
    before = (F.col(score) > F.col("_target")) | ((F.col(score) == F.col("_target")) & (F.col(item) < F.col("_held")))
    ranked = pool.join(target, user).groupBy(user, "_held").agg((F.sum(before.cast("long")) + 1).alias("rank"))
    return ranked.select(user, F.col("_held").alias(item), "rank")


def popularity_scores(items: DataFrame, counts: DataFrame, item: str = "item_id", column: str = "recommendations") -> DataFrame:
    """``(item, score)`` for the item universe; an item without a count scores 0."""
    return items.join(counts.select(item, column), item, "left").select(
        item, F.coalesce(clean_number(column), F.lit(0.0)).alias("score")
    )


def popularity_ranks(
    popularity: DataFrame, train: DataFrame, heldout: DataFrame, user: str = "user_id", item: str = "item_id"
) -> DataFrame:
    """Rank of the held-out item when all users see the same order.

    The order is worked out once; a user's rank is the global rank less the train items above it, so no
    user-by-item product is formed.
    """
    order = with_position(popularity.select(item, "score"), [F.desc("score"), F.asc(item)], "place").select(item, "place")
    target = heldout.join(order, item).select(user, F.col(item).alias("_held"), F.col("place").alias("_place"))
    seen = train.join(order, item).select(user, "place").join(target.select(user, "_place"), user)
    above = seen.where(F.col("place") < F.col("_place")).groupBy(user).agg(F.count("*").alias("_above"))
    rank = F.col("_place") - F.coalesce(F.col("_above"), F.lit(0)) + 1
    return target.join(above, user, "left").select(user, F.col("_held").alias(item), rank.alias("rank"))


def vector_sums(pairs: DataFrame, vectors: DataFrame, group: str, key: str, column: str, width: int) -> DataFrame:
    """``(group, n, sums)``: element-wise sum of the vectors of each group.

    One sum per element, so that Spark combines before the shuffle; pairs without a vector count as zero. A bounded table of vectors
    goes to pairs that are written by group first, where Spark cuts a hot group into files of 64 MB: what is shuffled is about one row
    of sums per group, not one per pair.
    """
    right = vectors.select(key, column)
    if right.count() * width * 8 <= BROADCAST_BYTES:
        pairs, right = spill(pairs.select(group, key).hint("rebalance", F.col(group)), "by-group"), F.broadcast(right)
    joined = pairs.join(right, key, "left")
    elements = ", ".join(f"coalesce(sum(get({column}, {j})), 0.0D)" for j in range(width))
    return joined.groupBy(group).agg(F.count("*").alias("n"), F.expr(f"array({elements})").alias("sums"))


def user_profiles(train: DataFrame, vectors: DataFrame, width: int, user: str = "user_id", item: str = "item_id", column: str = "vec") -> DataFrame:
    """Mean vector of the train items of each user: ``(user, profile)``."""
    sums = vector_sums(train, vectors, user, item, column, width)
    return sums.select(user, F.transform("sums", lambda x: x / F.col("n")).alias("profile"))


def cosine_model(profiles: DataFrame, vectors: DataFrame, items: DataFrame, user: str = "user_id", item: str = "item_id", width: int = 50) -> tuple[DataFrame, DataFrame]:
    """Unit vectors on the grid for users and for all items of the universe, so that dot is cosine.

    An item without a vector gets the zero vector and therefore scores 0.
    """
    zero = F.array_repeat(F.lit(0.0), width)
    users = profiles.select(user, on_grid(unit("profile")).alias("content"))
    placed = items.select(item).join(vectors.select(item, "vec"), item, "left")
    return users, placed.select(item, on_grid(unit(F.coalesce("vec", zero))).alias("content"))


def hybrid_score(content: Column, mf: Column, alpha: float, extremes: tuple[float, float, float, float]) -> Column:
    blend = Blend("", alpha, extremes)
    return blend.mixed(*blend.scaled(content, mf))
