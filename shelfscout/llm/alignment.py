"""Alignment of two tokenizers over the same text.

Tokenizer A is a byte-level BPE (``tokenizers``), B a sentence-piece BPE with byte fallback that puts a space before the text. Both
spell the bytes of a space and the text. Coarse cuts come from the character offsets of A and the byte spans of B's proto. Where one
character belongs to several tokens of A, or B falls back to bytes, the spans of neighbours overlap or are empty; there the cuts follow
from the decoded bytes, counted from the last coarse cut. Byte offsets where tokens of both end cut a text into groups. A link is a pair of
token occurrences whose byte ranges overlap, and the count of an id pair is the number of documents that hold it linked.

Texts are cut into segments at every single space between two characters that are not white space: no token of A or B reaches across it, so both end
there. Texts are taken in chunks of ``CHUNK_BYTES``, and a chunk aligns and links each distinct segment once; a task
encodes those it has not met before. It keeps the segments of its
documents and the pairs of its segments as numbers into one list of its pairs. Counts are sums over those lists, one row per chunk and pair, and
return to the chunk in one join, so no row per link is shuffled and a pair that all documents share has one row per chunk.

Defined results: a NULL or empty text, or one that either tokenizer does not spell back byte for byte, has no tokens: zeros and an empty digest, and
it counts for no pair; strings of special tokens are plain text; rows are counted as they come, so a repeated row is one more document; a text of
any length is taken whole; an empty table gives an empty one. Columns named like an added one are replaced.

``aligned`` gives the groups themselves, ``alignment_counts`` the figures and the digest.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfscout.llm.common import named, others, packed, shared, unpacked
from shelfscout.session import configure, spill

# Text that is aligned at once, in characters.
CHUNK_BYTES = 4 << 20
# Bytes of segments that are encoded in one call.
BLOCK_BYTES = 1 << 14
# Distinct segments whose tokens a task keeps from chunk to chunk.
REMEMBERED = 400_000
# Where the vocabulary files are looked for unless the caller names them; they are read on the driver and sent to the tasks.
VOCABULARY_FOLDER = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"

ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

_SEAM = re.compile(r"(?<=\S) (?=\S)")


def read_vocabularies(folder: str = VOCABULARY_FOLDER, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE) -> tuple[bytes, bytes]:
    """The two vocabulary files; a missing one is an error that names it."""
    found = []
    for name in (byte_file, piece_file):
        path = os.path.join(folder, name)
        if not os.path.isfile(path):
            raise FileNotFoundError(f"vocabulary file {path} is missing; name its folder")
        with open(path, "rb") as file:
            found.append(file.read())
    return found[0], found[1]


def byte_characters() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: itself if it is visible, else the next one from U+0100 on."""
    shown = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF}
    hidden = (b for b in range(256) if b not in shown)
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass
class Tokens:
    """Ids and byte ends of some texts laid end to end, and the number of tokens of each."""

    ids: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


class Pair:
    """Both tokenizers with the bytes of every id."""

    def __init__(self, vocabularies: tuple[bytes, bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(vocabularies[0].decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies[1])
        place = byte_characters()
        vocabulary = json.loads(vocabularies[0])["model"]["vocab"]
        self.a_bytes = np.full(max(vocabulary.values()) + 1, None, object)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(place[c] for c in entry)
        for i, known in enumerate(self.a_bytes):
            if known is None:
                self.a_bytes[i] = b""
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_byte = np.array([self.b.is_byte(i) for i in range(len(pieces))])
        self.b_bytes = np.empty(len(pieces), object)
        for i, piece in enumerate(pieces):
            self.b_bytes[i] = bytes([int(piece[3:5], 16)]) if self.b_byte[i] else piece.replace("▁", " ").encode()
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # Texts are cut only if no piece can reach over a space that follows something else.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_word = [np.array([f"{i}{end}" for i in range(len(self.a_bytes))], object) for end in ",|"]
        self.known: dict[str, int] = {}
        self.held = [Tokens(*[np.empty(0, np.int64)] * 3)] * 2
        self.b_word = [np.array([f"{i}{end}" for i in range(len(pieces))], object) for end in ",;"]

    def segments(self, text: str) -> list[str]:
        """Parts that both tokenizers take alone as they would within the whole; the space at a seam is the next part's."""
        return _SEAM.split(text) if self.cuttable else [text]

    def tokens(self, parts: Sequence[str]) -> tuple[Tokens, Tokens, np.ndarray]:
        """Tokens of all parts, each with a space before it, laid end to end, and which parts both tokenizers spell back.

        The tokens of the other parts are left out.
        """
        good, found, before = np.zeros(len(parts), bool), [], 0
        for i, part in enumerate(parts):
            both = self._one(part)
            if both is not None:
                good[i] = True
                found.append([(ids, ends + before) for ids, ends in both])
                before = found[-1][0][1][-1]
        none = np.empty(0, np.int64)
        a, b = (
            Tokens(
                np.concatenate([none, *(f[k][0] for f in found)]),
                np.concatenate([none, *(f[k][1] for f in found)]),
                np.array([len(f[k][0]) for f in found], np.int64),
            )
            for k in (0, 1)
        )
        return a, b, good

    def _one(self, part: str) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids and byte ends of A and of B."""
        spelt = (" " + part).encode()
        encoded = self.a.encode(" " + part, add_special_tokens=False)
        a = np.array(encoded.ids, np.int64)
        pieces = self.b.encode(part, return_type="proto").pieces
        told = np.array([(p.id, p.end) for p in pieces], np.int64).reshape(-1, 2)
        b = told[:, 0]
        if b"".join(self.a_bytes[a].tolist()) != spelt or b"".join(self.b_bytes[b].tolist()) != spelt:
            return None
        spans = np.fromiter(chain.from_iterable(encoded.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        if len(spelt) != len(part) + 1:
            spans = _byte_places(" " + part)[spans]
        # A cut is sure unless the next token starts before it: then both hold bytes of one character.
        sure = np.append(spans[1:, 0] >= spans[:-1, 1], True)
        ends_a = _refined(spans[:, 1], sure, self.a_size[a])
        # B's spans leave out the space put before the text; the span of a fallback byte is empty up to the last byte of a character.
        return [(a, ends_a), (b, _refined(told[:, 1] + 1, ~self.b_byte[b], self.b_size[b]))]

    def remembered(self, parts: Sequence[str]) -> tuple[Tokens, Tokens, np.ndarray]:
        """As ``segment_tokens``; segments met before are not encoded again. What is kept is bounded by ``REMEMBERED``."""
        if len(self.known) > REMEMBERED:
            self.known, self.held = {}, [Tokens(*[np.empty(0, np.int64)] * 3)] * 2
        new = [p for p in parts if p not in self.known]
        *added, place = self.segment_tokens(new)
        count = len(self.held[0].counts)
        self.known.update(zip(new, np.where(place < 0, -1, place + count).tolist()))
        joined = []
        for old, more in zip(self.held, added):
            starts = np.concatenate([[0], more.ends[np.cumsum(more.counts) - 1]])[:-1] if len(more.ids) else more.counts
            # The ends of a kept segment count from its own beginning.
            own = more.ends - np.repeat(starts, more.counts)
            joined.append(Tokens(*(np.concatenate(x) for x in ((old.ids, more.ids), (old.ends, own), (old.counts, more.counts)))))
        self.held = joined
        where = np.fromiter((self.known[p] for p in parts), np.int64, len(parts))
        wanted = where[where >= 0]
        out = []
        for held in self.held:
            begins = np.concatenate([[0], np.cumsum(held.counts)])
            members, counts = _expanded(begins, wanted), held.counts[wanted]
            last = held.ends[begins[1:][wanted] - 1]
            out.append(Tokens(held.ids[members], held.ends[members] + np.repeat(np.cumsum(last) - last, counts), counts))
        return out[0], out[1], np.where(where < 0, -1, np.cumsum(where >= 0) - 1)

    def segment_tokens(self, parts: Sequence[str]) -> tuple[Tokens, Tokens, np.ndarray]:
        """As ``tokens`` for distinct segments; the place of each among those that are spelt back, -1 for the others.

        Segments are joined to blocks again, as a call for each would cost more than its work. A block that is not spelt back is taken apart.
        """
        sizes = np.fromiter((len(p.encode()) + 1 for p in parts), np.int64, len(parts))
        block = np.cumsum(sizes) // BLOCK_BYTES if self.cuttable else np.arange(len(parts))
        firsts = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
        a, b, good = self.tokens([" ".join(parts[s:e]) for s, e in zip(firsts, [*firsts[1:], len(parts)])])
        whole = np.repeat(good, np.diff([*firsts, len(parts)])) if firsts else np.zeros(0, bool)
        alone = np.flatnonzero(~whole)
        more_a, more_b, fine = self.tokens([parts[i] for i in alone.tolist()])
        order = np.concatenate([np.flatnonzero(whole), alone[fine]])
        place = np.full(len(parts), -1, np.int64)
        place[order] = np.arange(len(order))
        bounds = np.cumsum(sizes[order])
        before = a.ends[-1] if len(a.ends) else 0
        laid = []
        for t, more in ((a, more_a), (b, more_b)):
            ends = np.concatenate([t.ends, more.ends + before])
            counts = np.diff(np.searchsorted(ends, bounds, "right"), prepend=0)
            laid.append(Tokens(np.concatenate([t.ids, more.ids]), ends, counts))
        return laid[0], laid[1], place

    @staticmethod
    def _spelt_back(table: np.ndarray, ids: np.ndarray, counts: np.ndarray, spelt: Sequence[bytes]) -> np.ndarray:
        """Which parts are the joined bytes of their tokens."""
        decoded = table[ids].tolist()
        ends = np.cumsum(counts).tolist()
        return np.fromiter((b"".join(decoded[s:e]) == x for s, e, x in zip([0, *ends], ends, spelt)), bool, len(spelt))


def _byte_places(text: str) -> np.ndarray:
    """Byte offset of every character, and of the end."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(sizes)])


def _refined(coarse: np.ndarray, sure: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The coarse ends where they are sure; else the decoded bytes counted on from the last sure one."""
    if sure.all():
        return coarse
    told = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(sure, np.arange(len(sure)), -1))
    base = np.where(last >= 0, coarse[last] - told[last], 0)
    return np.where(sure, coarse, told + base)


def links(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the linked tokens of A and of B, and the common cuts.

    Between two neighbouring ends, of either kind, lies a run of bytes that one token of each covers, and the ranges of two tokens meet in one
    such run at most, so the runs are the links.
    """
    mark = np.zeros(int(a.ends[-1]) + 1 if len(a.ends) else 1, np.int8)
    mark[a.ends] = 1
    mark[b.ends] += 2
    places = np.flatnonzero(mark)
    kinds = mark[places]
    of_a, of_b = kinds != 2, kinds >= 2
    return np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b, places[kinds == 3]


def spelled_words(pair: Pair, a: Tokens, b: Tokens, cuts: np.ndarray) -> np.ndarray:
    """The ids of all tokens as text, each with the sign behind it, in the order ``a1,a2|b1;a3|b2,b3;``."""
    last_a, last_b = np.searchsorted(a.ends, cuts), np.searchsorted(b.ends, cuts)
    words_a, words_b = pair.a_word[0][a.ids], pair.b_word[0][b.ids]
    words_a[last_a] = pair.a_word[1][a.ids[last_a]]
    words_b[last_b] = pair.b_word[1][b.ids[last_b]]
    out = np.empty(len(words_a) + len(words_b), object)
    group_a = np.searchsorted(cuts, a.ends)
    group_b = np.searchsorted(cuts, b.ends)
    out[np.arange(len(words_a)) + np.concatenate([[0], last_b + 1])[group_a]] = words_a
    out[np.arange(len(words_b)) + (last_a + 1)[group_b]] = words_b
    return out


@dataclass
class Aligned:
    """The distinct segments of some texts laid end to end, and the segments of each text (None: it has no tokens)."""

    texts: list[np.ndarray | None]
    a: Tokens
    b: Tokens
    of_a: np.ndarray
    of_b: np.ndarray
    cuts: np.ndarray
    # Where each segment begins: in bytes, tokens of A, tokens of B, links and groups.
    begins: dict[str, np.ndarray]

    def sizes(self, what: str) -> np.ndarray:
        return np.diff(self.begins[what])


class _Numbers(dict):
    """Numbers its keys as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers of one length, compressed; ``_unpacked`` gives them back."""
    return zlib.compress(np.concatenate(arrays).astype(np.int32).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.int32)


def align(pair: Pair, texts: Sequence[str]) -> Aligned:
    known = _Numbers()
    listed = [np.fromiter(map(known.__getitem__, pair.segments(t)), np.int64) if t else None for t in texts]
    a, b, place = pair.remembered(list(known))
    listed = [None if x is None or place[x].min() < 0 else place[x] for x in listed]
    starts = {name: np.concatenate([[0], np.cumsum(t.counts)]) for name, t in (("a", a), ("b", b))}
    starts["bytes"] = np.concatenate([[0], a.ends[starts["a"][1:] - 1]])
    of_a, of_b, cuts = links(a, b)
    starts["groups"] = np.searchsorted(cuts, starts["bytes"], "right") if len(cuts) else np.zeros(1, np.int64)
    starts["links"] = np.searchsorted(of_a, starts["a"])
    return Aligned(listed, a, b, of_a, of_b, cuts, starts)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows with their texts, about ``CHUNK_BYTES`` of text at a time."""
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        start, held = 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= CHUNK_BYTES or i == len(texts) - 1:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, held = i + 1, 0


def _rows(docs: DataFrame, text: str, added: Sequence[str], kept: DataFrame | None = None) -> DataFrame:
    kept = docs if kept is None else kept
    carried = packed(kept, added) if others(kept, added) else F.struct(F.lit(None).cast("int").alias("_"))
    return docs.select(carried.alias("row"), named(text).cast("string").alias("text"))


def aligned(docs: DataFrame, text: str = "text", vocabularies: tuple[bytes, bytes] | None = None) -> DataFrame:
    """Add ``groups`` to every row: byte ends in the space and text, ids of A and ids of B, in order."""
    spark = configure(docs.sparkSession)
    pair = _task_pair(spark, vocabularies)
    longs = T.ArrayType(T.LongType())
    group = T.StructType().add("end", "long").add("a_ids", longs).add("b_ids", longs)
    rows = _rows(docs, text, ("groups",))
    kind = T.StructType([rows.schema["row"], T.StructField("groups", T.ArrayType(group))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _chunks(batches):
            found = []
            whole = align(pair(), texts)
            at_a, at_b = (np.searchsorted(t.ends, whole.cuts) + 1 for t in (whole.a, whole.b))
            groups = list(zip(np.split(whole.a.ids, at_a), np.split(whole.b.ids, at_b)))
            sizes, bounds, begins = whole.sizes("bytes"), whole.begins["groups"], whole.begins["bytes"]
            for segments in whole.texts:
                parts, before = [], 0
                for k in [] if segments is None else segments.tolist():
                    for g in range(bounds[k], bounds[k + 1]):
                        a_ids, b_ids = groups[g]
                        parts.append({"end": int(before + whole.cuts[g] - begins[k]), "a_ids": a_ids.tolist(), "b_ids": b_ids.tolist()})
                    before += sizes[k]
                found.append(parts)
            item = pa.struct([("end", pa.int64()), ("a_ids", pa.list_(pa.int64())), ("b_ids", pa.list_(pa.int64()))])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.list_(item))], ["row", "groups"])

    return rows.mapInArrow(work, kind).select(*unpacked("row", docs, ("groups",)), "groups")


def _task_pair(spark: SparkSession, vocabularies: tuple[bytes, bytes] | None):
    sent = shared(spark, vocabularies or read_vocabularies())
    made: list[Pair] = []

    def get() -> Pair:
        if not made:
            made.append(Pair(sent()))
        return made[0]

    return get


def alignment_counts(
    docs: DataFrame, text: str = "text", vocabularies: tuple[bytes, bytes] | None = None, carry: Sequence[str] | None = None
) -> DataFrame:
    """Add the figures of ``ADDED`` to every row, or to the columns ``carry`` of it; what is carried is shuffled once."""
    spark = configure(docs.sparkSession)
    kept_columns = docs if carry is None else docs.select(*map(named, carry))
    held = spill(_held_links(docs, text, kept_columns, _task_pair(spark, vocabularies)), "links")
    listed = held.where("codes IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("codes", "docs")).alias("place", "pair"))
    listed = listed.select("chunk", "place", "pair.codes", "pair.docs")
    counts = spill(listed.groupBy("codes").agg(F.sum("docs").alias("n")), "pairs")
    # One row per id of A that occurs: bounded by A's vocabulary.
    best = counts.groupBy(F.shiftright("codes", 32).alias("a")).agg(F.max("n").alias("most"))
    judged = counts.join(F.broadcast(best), F.shiftright("codes", 32) == F.col("a")).select("codes", "n", (F.col("n") == F.col("most")).alias("best"))
    told = listed.join(judged, "codes").select(F.col("chunk").alias("of_chunk"), "place", "n", "best")
    rows = held.drop("codes", "docs")
    kept = [f for f in rows.schema if f.name not in ("chunk", *_LISTS)]
    kind = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    done = rows.groupBy("chunk").cogroup(told.groupBy("of_chunk")).applyInArrow(_summed, kind)
    return done.select(*unpacked("row", kept_columns, ADDED), *[F.col(c) for c in ADDED])


# What a document's row holds (the steps between its ascending segments, and how often it has each) and what the row of its chunk holds
# for all of its segments (the places of their pairs, and where those of each segment begin), compressed.
_LISTS = ("segments", "places", "bounds")


def _held_links(docs: DataFrame, text: str, kept: DataFrame, pair) -> DataFrame:
    """A row per document with its distinct segments and how often it has each, and a row per chunk that lists the pairs of its segments, and all
    pairs with the number of documents that hold them."""
    rows = _rows(docs, text, ADDED, kept)
    integers = T.ArrayType(T.IntegerType())
    kind = T.StructType(
        [
            T.StructField("chunk", T.StringType()),
            T.StructField("row", rows.schema["row"].dataType),
            *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
            T.StructField("groups_sha256", T.StringType()),
            *[T.StructField(c, T.BinaryType()) for c in _LISTS],
            T.StructField("codes", T.ArrayType(T.LongType())),
            T.StructField("docs", integers),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        # Millions of short-lived objects without cycles: looking through them again and again costs a third of the time.
        gc.disable()
        for number, (batch, texts) in enumerate(_chunks(batches)):
            yield _chunk_rows(pair(), f"{task}-{number}", batch.column("row"), texts)

    return rows.mapInArrow(work, kind)


def _expanded(begins: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of all members of the runs ``which``; run k goes from ``begins[k]`` to ``begins[k + 1]``."""
    sizes = np.diff(begins)[which]
    upto = np.cumsum(sizes)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(begins[which] - (upto - sizes), sizes)


def _chunk_rows(pair: Pair, chunk: str, carried: pa.Array, texts: Sequence[str]) -> pa.RecordBatch:
    whole = align(pair, texts)
    words = spelled_words(pair, whole.a, whole.b, whole.cuts)
    word_begins = (whole.begins["a"] + whole.begins["b"]).tolist()
    spelled = np.array(["".join(words[s:e].tolist()) for s, e in zip(word_begins, word_begins[1:])] or [""], object)
    pairs, number = np.unique((whole.a.ids[whole.of_a] << 32) | whole.b.ids[whole.of_b], return_inverse=True)
    sizes = np.stack([whole.sizes(w) for w in ("a", "b", "groups", "links")])

    n = len(texts)
    figures, digests = np.zeros((4, n), np.int64), [""] * n
    segments, times = [np.empty(0, np.int64)] * n, [np.empty(0, np.int64)] * n
    for i, listed in enumerate(whole.texts):
        if listed is None:
            continue
        figures[:, i] = sizes[:, listed].sum(axis=1)
        digests[i] = hashlib.sha256("".join(spelled[listed].tolist())[:-1].encode()).hexdigest()
        segments[i], times[i] = np.unique(listed, return_counts=True)
    # Documents of each pair: first the segments of a document, then the pairs of those, each once.
    flat = np.concatenate([np.empty(0, np.int64), *segments])
    owner = np.repeat(np.arange(n), [len(x) for x in segments])
    links_begin = whole.begins["links"]
    held = np.repeat(owner, np.diff(links_begin)[flat]) * max(len(pairs), 1) + number[_expanded(links_begin, flat)]
    held.sort()
    once = held[np.flatnonzero(np.diff(held, prepend=-1))]
    docs = np.bincount(once % max(len(pairs), 1), minlength=len(pairs)).astype(np.int32)

    of_chunk = lambda values, kind: pa.concat_arrays(
        [pa.nulls(n, pa.list_(kind)), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))]
    )
    arrays = [
        pa.array([chunk] * (n + 1), pa.string()),
        pa.concat_arrays([carried, pa.nulls(1, carried.type)]),
        *[pa.concat_arrays([pa.array(c), pa.nulls(1, pa.int64())]) for c in figures],
        pa.array([*digests, None], pa.string()),
        pa.array([*(_packed(np.diff(x, prepend=0), t) for x, t in zip(segments, times)), None], pa.binary()),
        pa.array([*[None] * n, _packed(number)], pa.binary()),
        pa.array([*[None] * n, _packed(links_begin)], pa.binary()),
        of_chunk(pairs, pa.int64()),
        of_chunk(docs, pa.int32()),
    ]
    names = ["chunk", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *_LISTS, "codes", "docs"]
    return pa.RecordBatch.from_arrays(arrays, names)


def _summed(rows: pa.Table, told: pa.Table) -> pa.Table:
    """The documents of one chunk with the counts of its pairs."""
    n, best = np.zeros(told.num_rows, np.int64), np.zeros(told.num_rows, np.int64)
    place = told.column("place").to_numpy()
    n[place] = told.column("n").to_numpy()
    best[place] = told.column("best").to_numpy(zero_copy_only=False)
    of_chunk = rows.filter(rows.column("places").is_valid())
    number, bounds = (_unpacked(of_chunk.column(c)[0].as_py()) for c in ("places", "bounds"))
    rows = rows.filter(rows.column("segments").is_valid())
    lists = [_unpacked(x).reshape(2, -1) for x in rows.column("segments").to_pylist()]
    which = np.concatenate([np.empty(0, np.int64), *(np.cumsum(x[0]) for x in lists)]).astype(np.int64)
    times = np.concatenate([np.empty(0, np.int64), *(x[1] for x in lists)]).astype(np.int64)
    ends = np.cumsum([0, *(x.shape[1] for x in lists)])
    kept = rows.drop_columns(["chunk", *_LISTS])
    for name, values in (("n_best", best), ("count_sum", n)):
        # Differences of running sums of whole numbers: exact, and right for empty runs.
        run = np.concatenate([[0], np.cumsum(values[number])])
        of_segment = run[bounds[1:]] - run[bounds[:-1]]
        run = np.concatenate([[0], np.cumsum(times * of_segment[which])])
        kept = kept.append_column(name, pa.array(run[ends[1:]] - run[ends[:-1]]))
    return kept
