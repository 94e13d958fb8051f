"""Quality filter: perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

Tokens are words between blanks; a word outside the vocabulary is replaced by its shape (letters, capitals and digits as one
sign each, other signs as they are, runs collapsed). Counts, continuation counts and count-of-counts are aggregates over
the n-grams. Every n-gram is kept, and every context sums to one.

The model is fitted on all trusted documents but those of the half of the ids, drawn by hash, that sets the thresholds; ``train_docs`` and
``train_words`` can bound it further. The ``VOCABULARY`` most frequent words and shapes have ids of their own. A table of n-grams stays on the cluster, a row
for each context with its successors, so that a row is bounded by the vocabulary.

Every document is scored whole, in a join with the model that is sharded by the middle word of a trigram: a shard holds the contexts
(a, b) and b of its words b, so it settles a token with all back-offs. The ``HOT`` most frequent middle words are spread over ``SALTS`` shards by
the word before, each with a copy of what follows b alone. The ids of a group of documents go to each shard in one packed row, past the shard's
tables, and one sum per document and shard comes back.
The threshold of a language is the ``QUANTILE`` of the perplexities of all its trusted documents that were not fitted on; a language with
fewer than ``LEAST_TRUSTED`` of them takes the threshold over all languages.

Defined results: a NULL or blank text has only the end to predict and is rejected as having no content; a NULL language is a language;
repeated rows are judged alike; without trusted text all documents with content stay and have no perplexity; an empty table
gives an empty one. Columns named like an added one are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfscout.llm.common import WORD, named, packed, shared, unpacked
from shelfscout.session import passing_tables, release, spill

# Share of the trusted ids that is fitted on; the others set the thresholds.
FITTED = 0.5
VOCABULARY = 1 << 15
# Trigrams of a shard, about; there are ``LEAST_SHARDS`` or more, a multiple of ``SALTS``.
SHARD_ROWS = 2_000_000
LEAST_SHARDS = 24
SALTS = 8
# Frequent words, and as many frequent shapes, at least, that are spread over several shards.
HOT = 32
# Parts in which the documents are met with the model, one after the other, so that the ids on their way take less disk.
ROUNDS = 3
# Tokens that a task deals out at a time.
TOKENS_AT_ONCE = 1_000_000
QUANTILE = 0.995
LEAST_TRUSTED = 30
# Ids of unknown words that a task remembers at a time.
SEEN_WORDS = 50_000
SEED = 42
ADDED = ("perplexity", "threshold", "keep")

# Ids of the start, the end and of what was never seen; words follow.
START, END, ODD, FIRST = 0, 1, 2, 3

# An odd multiplier whose product spreads a key over the highest bits.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

_BLANK = re.compile(r"[\x20\x09-\x0D]+")
_RUN = re.compile(r"(.)\1+")


class _Signs(dict):
    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = "0" if c.isdigit() else "a" if c.islower() else "A" if c.isalpha() else c
        return self[code]


_SIGNS = _Signs()


def shape(word: str) -> str:
    body, tail = (word[:-1], word[-1]) if word[-1] in ".,;:" else (word, "")
    if body.isalpha():
        # The common cases without a look at every sign.
        if body.islower():
            return "\x00a" + tail
        if body.istitle():
            return "\x00Aa" + tail
    return "\x00" + _RUN.sub(r"\1", word.translate(_SIGNS))


class _Codes(dict):
    """Ids of the words of a vocabulary, in UTF-8; a word outside it is looked up by its shape and remembered, ``SEEN_WORDS`` at a time."""

    def __init__(self, ids: dict[str, int]):
        super().__init__((w.encode("utf-8", "surrogatepass"), i) for w, i in ids.items())
        self.ids = ids

    def __missing__(self, word: bytes) -> int:
        if len(self) >= len(self.ids) + SEEN_WORDS:
            self.clear()
            self.__init__(self.ids)
            if word in self:
                return self[word]
        code = self[word] = self.ids.get(shape(word.decode("utf-8", "surrogatepass")), ODD)
        return code


class Words:
    """Ids of words; unknown words go by their shape."""

    def __init__(self, known: list[str], plain: int | None = None):
        """The first ``plain`` of them, all by default, are words by frequency; shapes follow, by frequency."""
        self.ids = {w: FIRST + i for i, w in enumerate(known)}
        self.size = FIRST + len(known)
        self.shapes_from = self.size if plain is None else FIRST + plain
        self._codes: _Codes | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_codes": None}

    def shapes(self, text: str | None) -> list[str]:
        """Shapes of the unknown words of a text."""
        return sorted({shape(w) for w in _BLANK.split(text or "") if w and w not in self.ids})

    def encode(self, text: str | None) -> np.ndarray:
        if self._codes is None:
            self._codes = _Codes(self.ids)
        # Bytes are split at the blanks of the contract and at no others.
        told = (text or "").encode("utf-8", "surrogatepass").split()
        out = np.empty(len(told) + 3, np.int64)
        out[:2], out[-1] = START, END
        out[2:-1] = np.fromiter(map(self._codes.__getitem__, told), np.int64, len(told))
        return out


class Lookup:
    """Values of distinct keys, in buckets by a hash of the key: a search meets one or two rows where halving meets twenty."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        # One to two buckets a key; the shift keeps the highest bits of the hash.
        bits = max(1, len(keys).bit_length())
        self._shift = np.uint64(64 - bits)
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        self._keys, self._values = keys[order], values[order]
        self._starts = np.zeros((1 << bits) + 1, np.int32)
        np.cumsum(np.bincount(bucket, minlength=1 << bits), out=self._starts[1:])

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> self._shift).astype(np.int64)

    def find(self, keys: np.ndarray, default: float) -> np.ndarray:
        found = np.full(len(keys), default)
        bucket = self._bucket(keys)
        at, end = self._starts[bucket], self._starts[bucket + 1]
        rows = np.flatnonzero(at < end)
        at, end, left = at[rows], end[rows], keys[rows]
        while len(rows):
            hit = self._keys[at] == left
            found[rows[hit]] = self._values[at[hit]]
            at = at + 1
            more = ~hit & (at < end)
            rows, at, end, left = rows[more], at[more], end[more], left[more]
        return found


@dataclass
class Fitted:
    """The fitted model: what the vocabulary bounds as arrays, the successors of each context as tables ``(key, ws, cs)``."""

    words: Words
    uni: np.ndarray
    back1: np.ndarray
    discounts: dict[int, tuple[float, float, float]]
    # ``key`` is the word before.
    two: DataFrame
    # ``key`` is a * size + b for the words a and b before.
    three: DataFrame


class Grams:
    """Probabilities from the tables of bigrams and trigrams: all of them, or those of a shard."""

    def __init__(self, size: int, uni: np.ndarray, back1: np.ndarray, bi: tuple, back2: tuple, tri: tuple):
        self.size, self.uni, self.back1 = size, uni, back1
        self.bi, self.back2, self.tri = Lookup(*bi), Lookup(*back2), Lookup(*tri)

    @classmethod
    def of(cls, size: int, uni: np.ndarray, back1: np.ndarray, discounts: dict, two: tuple, three: tuple) -> Grams:
        """From ``(keys, lengths, ws, cs)`` of the two tables."""
        bi, _ = _shares(size, discounts[2], *two)
        tri, rest = _shares(size, discounts[3], *three)
        return cls(size, uni, back1, bi, rest, tri)

    @staticmethod
    def _find(table: Lookup, keys: np.ndarray | list[int], default: float) -> np.ndarray:
        return table.find(np.asarray(keys, np.int64), default)

    def p(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Probability of ``c`` after ``a`` and ``b``."""
        p = self._find(self.bi, b * self.size + c, 0.0) + self.back1[b] * self.uni[c]
        context = a * self.size + b
        return self._find(self.tri, context * self.size + c, 0.0) + self._find(self.back2, context, 1.0) * p


class Model(Grams):
    """The whole model in one place, for bounded texts."""

    def __init__(self, words: Words, *tables):
        super().__init__(words.size, *tables)
        self.words = words

    def logs(self, text: str | None) -> np.ndarray:
        """log10 probability of each token and of the end."""
        ids = self.words.encode(text)
        return np.log10(self.p(ids[:-2], ids[1:-1], ids[2:]))

    def perplexity(self, text: str | None) -> float:
        return float(10 ** -self.logs(text).mean())


def _off(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return np.asarray(discounts)[np.minimum(counts, 3) - 1]


def _shares(size: int, discounts: tuple, keys: np.ndarray, lengths: np.ndarray, ws: np.ndarray, cs: np.ndarray) -> tuple[tuple, tuple]:
    """Discounted shares by ``key * size + w``, and what each key leaves to the next order."""
    if not len(keys):
        none = np.empty(0, np.int64), np.empty(0)
        return none, none
    starts = np.cumsum(lengths) - lengths
    total, off = np.add.reduceat(cs, starts).astype(float), _off(cs, discounts)
    shares = (cs - off) / np.repeat(total, lengths)
    return (np.repeat(keys, lengths) * size + ws, shares), (keys, np.add.reduceat(off, starts) / total)


def _bounds(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """D1, D2 and D3+ from how many n-grams occur once to four times."""
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    bound = lambda d, most: min(max(d, 0.05), most)
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.5
    return bound(1 - 2 * y * n2 / n1, 0.95), bound(2 - 3 * y * n3 / n2, 1.95), bound(d3, 2.95)


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    counts = table.select(F.explode("cs").alias("c")).where(F.col("c") <= 4).groupBy("c").agg(F.count("*").alias("n"))
    seen = {r["c"]: r["n"] for r in counts.collect()}
    return _bounds(*(seen.get(i, 0) for i in (1, 2, 3, 4)))


def _successors(grams: DataFrame, label: str) -> DataFrame:
    """``(key, ws, cs)`` of distinct ``(key, w, c)``; a list is bounded by the vocabulary."""
    rows = grams.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("w", "c"))).alias("e"))
    return spill(rows.select("key", F.col("e.w").alias("ws"), F.col("e.c").alias("cs")), label)


def fit_tables(trusted: DataFrame, text: str = "text", vocabulary: int = VOCABULARY) -> Fitted | None:
    """The model of all these texts; None when they have no word."""
    spark = trusted.sparkSession
    body = spill(trusted.select(named(text).alias("text")), "trusted")
    top = (
        body.select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"))
        .groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(vocabulary)
    )
    known = [r["w"] for r in top.where("n > 1").collect()]
    plain = shared(spark, Words(known))
    shapes = F.pandas_udf(lambda column: pd.Series([plain().shapes(t) for t in column], dtype=object), T.ArrayType(T.StringType()))
    odd = body.select(F.explode(shapes("text")).alias("w")).groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(vocabulary)
    words = Words(known + [r["w"] for r in odd.collect()], len(known))
    if words.size == FIRST:
        return None
    get, size = shared(spark, words), words.size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            waiting = 0
            for n, text in enumerate(batch.column(0)):
                held.append(get().encode(text.as_py()))
                waiting += len(held[-1])
                if waiting < TOKENS_AT_ONCE and n + 1 < batch.num_rows:
                    continue
                a, b, c, _ = _runs(held)
                grams, n = np.unique((a * size + b) * size + c, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams // size), pa.array((grams % size).astype(np.int32)), pa.array(n, pa.int64())], ["key", "w", "c"])
                held, waiting = [], 0

    found = body.mapInArrow(count, "key long, w int, c long")
    # Dealt by context, so that counts and lists of successors need no further exchange; a task has sent a trigram once per ``TOKENS_AT_ONCE``.
    three = _successors(found.repartition("key").groupBy("key", "w").agg(F.sum("c").alias("c")), "trigrams")
    pairs = three.select(F.expr(f"key % {size}").alias("key"), F.explode("ws").alias("w"))
    two = _successors(pairs.groupBy("key", "w").agg(F.count("*").alias("c")), "bigrams")
    # At most a row for each word of the vocabulary.
    one = two.select(F.explode("ws").alias("w")).groupBy("w").agg(F.count("*").alias("c")).toPandas()
    counts = one["c"].to_numpy()
    flat = np.zeros(size)
    flat[one["w"].to_numpy()] = (counts - _off(counts, _bounds(*((counts == i).sum() for i in (1, 2, 3, 4))))) / counts.sum()
    flat += (1 - flat.sum()) / size
    discounts = {2: _discounts(two), 3: _discounts(three)}
    off = [F.size(F.filter("cs", f)) * F.lit(d) for f, d in zip((lambda c: c == 1, lambda c: c == 2, lambda c: c > 2), discounts[2])]
    total = F.aggregate("cs", F.lit(0).cast("long"), lambda s, c: s + c)
    rest = two.select("key", ((off[0] + off[1] + off[2]) / total).alias("g")).toPandas()
    back1 = np.ones(size)
    back1[rest["key"].to_numpy()] = rest["g"].to_numpy()
    return Fitted(words, flat, back1, discounts, two, three)


def fit(trusted: DataFrame, text: str = "text", vocabulary: int = VOCABULARY) -> Model | None:
    """The model of a bounded table of texts, gathered in one place; None when it has no word."""
    fitted = fit_tables(trusted, text, vocabulary)
    if fitted is None:
        return None

    def gathered(table: DataFrame) -> tuple:
        rows = table.toPandas()
        flat = lambda column: np.concatenate([np.asarray(x, np.int64) for x in rows[column]])
        return rows["key"].to_numpy(np.int64), rows["ws"].map(len).to_numpy(), flat("ws"), flat("cs")

    bi, _ = _shares(fitted.words.size, fitted.discounts[2], *gathered(fitted.two))
    tri, rest = _shares(fitted.words.size, fitted.discounts[3], *gathered(fitted.three))
    return Model(fitted.words, fitted.uni, fitted.back1, bi, rest, tri)


def _runs(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The three words of each trigram of encoded texts, and how many each text has."""
    lengths = np.array([len(t) - 2 for t in texts], np.int64)
    ids = np.concatenate(texts)
    starts = np.arange(lengths.sum()) + 2 * np.repeat(np.arange(len(texts)), lengths)
    return ids[starts], ids[starts + 1], ids[starts + 2], lengths


def _dense(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, packed by planes of bytes."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _undense(packed_numbers: bytes, count: int) -> np.ndarray:
    planes = pa.Codec("zstd").decompress(packed_numbers, 4 * count, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, count).T).view("<u4").ravel().astype(np.int64)


_PACKED = "shard int, kind int, key long, n int, parts array<binary>"
_ANSWERED = "group long, shard int, sums array<double>"


@dataclass
class Sharded:
    """A fitted model whose tables are packed by shard: rows of ``kind`` 0 for bigrams, 1 for trigrams."""

    words: Words
    uni: np.ndarray
    back1: np.ndarray
    discounts: dict[int, tuple[float, float, float]]
    step: int
    table: DataFrame

    @property
    def shards(self) -> int:
        return SALTS * self.step


def _hot(row: np.ndarray, shards: int, plain: int) -> np.ndarray:
    """Whether words of the numbers ``row * shards`` and up are spread: the first words and the first shapes."""
    rows, first = -(-HOT // shards), plain // shards
    return (row < rows) | ((row >= first) & (row < first + rows))


def _bits(numbers: np.ndarray) -> list[bytes]:
    return [_dense(numbers & 0xFFFFFFFF), _dense(numbers >> 32)]


def _parts(rows: dict[int, list[list[bytes]]], kind: int, key: int, n: list[int]) -> pa.RecordBatch:
    shards, parts = list(rows), list(rows.values())
    arrays = [pa.array(shards, pa.int32()), pa.array([kind] * len(shards), pa.int32()), pa.array([key] * len(shards), pa.int64()), pa.array(n, pa.int32())]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(parts, pa.list_(pa.binary()))], ["shard", "kind", "key", "n", "parts"])


def sharded(fitted: Fitted, keep=spill) -> Sharded:
    """The tables by shard, written by ``keep``."""
    size, plain = fitted.words.size, fitted.words.shapes_from
    trigrams = fitted.three.agg(F.coalesce(F.sum(F.size("ws")), F.lit(0))).first()[0]
    step = max(LEAST_SHARDS // SALTS, -(-trigrams // (SALTS * SHARD_ROWS)))
    shards = SALTS * step

    def pack(kind: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                a, b = np.divmod(batch.column(0).to_numpy(zero_copy_only=False), size)
                lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                ws, cs = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2))
                starts = np.cumsum(lengths) - lengths
                hot = _hot(b // shards, shards, plain)
                # What follows a hot word alone is held by all its shards.
                copies = [np.where(hot, a % SALTS, 0)] if kind else [np.zeros(len(b), np.int64), *(np.where(hot, s, -1) for s in range(1, SALTS))]
                rows: dict[int, list[bytes]] = {}
                n = []
                at, salt = (np.concatenate(x) for x in zip(*((np.flatnonzero(s >= 0), s[s >= 0]) for s in copies)))
                shard = (b[at] + salt * step) % shards
                order = np.argsort(shard, kind="stable")
                ends = np.cumsum(np.bincount(shard, minlength=shards))
                for name, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends)):
                    if lo < hi:
                        own = at[order[lo:hi]]
                        cells = np.arange(lengths[own].sum()) + np.repeat(starts[own] - (np.cumsum(lengths[own]) - lengths[own]), lengths[own])
                        rows[name] = [_dense(a[own]), _dense(b[own]), _dense(lengths[own]), _dense(ws[cells]), *_bits(cs[cells].astype(np.int64))]
                        n.append(hi - lo)
                yield _parts(rows, kind, 0, n)

        return run

    tables = [t.mapInArrow(pack(kind), _PACKED) for kind, t in enumerate((fitted.two, fitted.three))]
    return Sharded(fitted.words, fitted.uni, fitted.back1, fitted.discounts, step, keep(tables[0].unionByName(tables[1]), "model"))


def log_sums(coded: DataFrame, model: Sharded) -> DataFrame:
    """``(place, s)``: the sum of log10 probabilities of the tokens of each row ``(place, n, ids)``; ``ids`` packs n + 2 of them."""
    size, plain, step, shards = model.words.size, model.words.shapes_from, model.step, model.shards

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, counts = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            # Places of a group follow each other.
            breaks = np.flatnonzero(np.diff(places) != 1) + 1
            for lo, hi in zip([0, *breaks], [*breaks, len(places)]):
                while lo < hi:
                    end = max(lo + 1, lo + int(np.searchsorted(np.cumsum(counts[lo:hi]), TOKENS_AT_ONCE, "right")))
                    yield dealt(int(places[lo]), [_undense(batch.column(2)[i].as_py(), int(counts[i]) + 2) for i in range(lo, end)])
                    lo = end

    def dealt(group: int, texts: list[np.ndarray]) -> pa.RecordBatch:
        a, b, c, lengths = _runs(texts)
        row = b // shards
        shard = (b + np.where(_hot(row, shards, plain), a % SALTS, 0) * step) % shards
        owner = np.repeat(np.arange(len(texts)), lengths)
        # Sorted within a text as well, which packs better; a sum does not ask for the order of the text.
        order = np.argsort((shard * len(texts) + owner) * (size // shards + 1) + row, kind="stable")
        ends = np.cumsum(np.bincount(shard, minlength=shards))
        rows: dict[int, list[bytes]] = {}
        for name, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends)):
            if lo < hi:
                own = order[lo:hi]
                rows[name] = [_dense(np.bincount(owner[own], minlength=len(texts))), *(_dense(x[own]) for x in (a, row, c))]
        return _parts(rows, 2, group, [len(texts)] * len(rows))

    stream = model.table.unionByName(coded.select("place", "n", "ids").mapInArrow(ask, _PACKED))
    get = shared(coded.sparkSession, (model.uni, model.back1, model.discounts))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, grams = None, None
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for own, kind, group, n, parts in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                parts = [x.as_py() for x in parts]
                if own != shard:
                    shard, grams, held = own, None, {0: [], 1: []}
                if kind < 2:
                    a, b, lengths = (_undense(x, n) for x in parts[:3])
                    ws, low, high = (_undense(x, int(lengths.sum())) for x in parts[3:])
                    held[kind].append((a * size + b, lengths, ws, low + (high << 32)))
                    continue
                if grams is None:
                    none = (np.empty(0, np.int64),) * 4
                    grams = Grams.of(size, *get(), *(tuple(map(np.concatenate, zip(*held[k]))) or none for k in (0, 1)))
                    held = {}
                lengths = _undense(parts[0], n)
                a, row, c = (_undense(x, int(lengths.sum())) for x in parts[1:])
                b = row * shards + (own - np.where(_hot(row, shards, plain), a % SALTS, 0) * step) % shards
                sums = np.bincount(np.repeat(np.arange(n), lengths), np.log10(grams.p(a, b, c)), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group], pa.int64()), pa.array([own], pa.int32()), pa.array([sums], pa.list_(pa.float64()))], ["group", "shard", "sums"]
                )

    answered = stream.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind", "key").mapInArrow(answer, _ANSWERED)
    # Added up in the order of the shards; a group has at most some ten thousand rows.
    total = F.pandas_udf(lambda column: column.map(lambda parts: np.sum([p["sums"] for p in parts], axis=0)), "array<double>")
    sums = answered.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("shard", "sums"))).alias("parts"))
    rows = sums.select("group", F.posexplode(total("parts")).alias("at", "s"))
    return rows.select((F.col("group") + F.col("at")).alias("place"), "s")


def coded(text: Column, model: Sharded) -> Column:
    """``(n, ids)``: the number of tokens, the end among them, and the packed ids of a text."""
    get = shared(model.table.sparkSession, model.words)

    def code(texts: pd.Series) -> pd.DataFrame:
        ids = [get().encode(t) for t in texts]
        return pd.DataFrame({"n": [len(x) - 2 for x in ids], "ids": [_dense(x) for x in ids]})

    return F.pandas_udf(code, "n int, ids binary")(text)


def _place(key: Column) -> Column:
    """Where the hash of a key lies in [0, 2^53)."""
    return F.pmod(F.xxhash64(F.lit(SEED), key), F.lit(1 << 53))


def trusted_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ids of documents labelled good and not toxic; an id with both a good and a bad label is not trusted."""
    judged = labels.groupBy(named(key).alias("trusted_id")).agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return judged.where("trusted_id IS NOT NULL AND q = 1 AND t = 0").select("trusted_id")


def sample_ids(
    docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", train_docs: int | None = None, train_words: int | None = None,
) -> DataFrame:
    """Ids of the trusted documents to fit on, a table ``fitted_id``: those whose hash falls in the share ``FITTED``.

    All rows of an id are drawn together. With ``train_docs`` the share is such that about so many are drawn at most; with ``train_words`` they
    are taken in the order of their hash while they fit into what is left of it, an end counted with each text, and what is
    taken passes through the driver.
    """
    share = FITTED
    if train_docs is not None:
        share = min(share, train_docs / max(1, trusted.count()))
    drawn = docs.where(_place(named(key)) < F.lit(int(share * (1 << 53)))).join(trusted, named(key) == F.col("trusted_id"), "left_semi")
    if train_words is None:
        return drawn.select(named(key).alias("fitted_id")).distinct()
    words = F.regexp_count(F.coalesce(named(text), F.lit("")), F.lit(WORD)) + 1
    sizes = drawn.groupBy(named(key).alias("fitted_id")).agg(F.sum(words).alias("n"))
    taken, left = [], train_words
    for row in sorted(sizes.select("fitted_id", "n", _place(F.col("fitted_id")).alias("at")).collect(), key=lambda r: (r["at"], r["fitted_id"])):
        if row["n"] <= left:
            left -= row["n"]
            taken.append((row["fitted_id"],))
    return docs.sparkSession.createDataFrame(taken, sizes.select("fitted_id").schema)


def judge(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    train_docs: int | None = None, quantile: float = QUANTILE, carry: bool = True, train_words: int | None = None,
) -> DataFrame:
    """Add ``perplexity``, ``threshold`` and ``keep``; ``carry=False`` leaves out the text."""
    trusted = spill(trusted_ids(labels, key), "trusted_ids")
    fitted = spill(sample_ids(docs, trusted, key, text, train_docs, train_words), "fitted_ids")
    kept = docs if carry else docs.drop(text)
    filled = F.coalesce(named(text).rlike(WORD), F.lit(False))
    told = [packed(kept, ADDED).alias("row"), named(key).alias("key"), named(lang).alias("lang"), filled.alias("filled")]
    with passing_tables(docs.sparkSession) as lasting:
        # The model holds all it needs of the tables it was fitted on.
        with passing_tables(docs.sparkSession) as between:
            tables = fit_tables(docs.join(fitted, named(key) == F.col("fitted_id"), "left_semi"), text)
            model = sharded(tables, between) if tables is not None else None
            del tables
        release(docs.sparkSession)
        if model is None:
            rows = lasting(docs.select(*told, F.lit(None).cast("double").alias("perplexity")), "scored")
        else:
            # Written, so that the places stay.
            marked = docs.select(*told, F.monotonically_increasing_id().alias("place"), coded(named(text), model).alias("code"))
            whole = lasting(marked.select("*", F.col("code.n").alias("n"), F.col("code.ids").alias("ids")).drop("code"), "coded")
            sums = []
            for turn in range(ROUNDS):
                # The high bits of a place tell the task that wrote the row.
                part = whole.where(F.shiftright("place", 33) % ROUNDS == turn).select("place", "n", "ids")
                sums.append(lasting(log_sums(part, model), "sums"))
                release(docs.sparkSession)
            sums = reduce(DataFrame.unionByName, sums)
            scored = F.pow(F.lit(10.0), -F.col("s") / F.col("n"))
            rows = whole.drop("ids").join(sums, "place").select("row", "key", "lang", "filled", scored.alias("perplexity"))
    held = (
        rows.where("filled").select("key", "lang", "perplexity")
        .join(trusted, F.col("key") == F.col("trusted_id"), "left_semi")
        .join(fitted, F.col("key") == F.col("fitted_id"), "left_anti")
    )
    cut = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    own = held.groupBy("lang").agg(cut.alias("own"), F.count("perplexity").alias("n")).where(F.col("n") >= LEAST_TRUSTED)
    limits = spill(own.select(F.col("lang").alias("of"), "own"), "limits")
    common = held.agg(cut.alias("t")).first()["t"]
    judged = rows.join(limits, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn(
        "threshold", F.coalesce("own", F.lit(common).cast("double"))
    )
    keep = F.col("filled") & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return judged.select(*unpacked("row", kept, ADDED), "perplexity", "threshold", keep.alias("keep"))
