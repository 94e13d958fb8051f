"""The prefix trie against one built in memory."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from shelfscout.llm import trie
from shelfscout.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string"


def built(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items() if c is not None}
    sequences = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        sequences[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved, out = {}, {}, set()
    for n in sorted(members, key=len, reverse=True):
        below = children[n]
        leaves[n] = sum(leaves[k] for k in below) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        saved[n] = (len(members[n]) - 1) * words + sum(saved[k] for k in below)
    for n, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(sequences[c]) == len(n))))
        parent = min(members[n[:-1]]) if n else None
        out.add((min(m), len(n), parent, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def odd_rows():
    draw = random.Random(5)
    rows = [
        (c, draw.choice([None, 0, 1, 2, 3]), draw.choice([None, "", "u"]), draw.choice([None, "", "a b", "c"]))
        for c in [*range(-45, 60), None]
        for _ in range(draw.randint(0, 6))
    ]
    rows += [(c, k, "u", "x y") for c, n in ((7, 60), (27, 50)) for k in range(n)]  # one is a prefix of the other
    rows += [(c, k, "u", "same") for c in range(1000, 1100) for k in range(5)]  # a hot sequence
    return rows + rows[:20]


def test_odd_conversations(make, odd_rows):
    assert got(trie.conversation_trie(make(odd_rows, TURNS))) == built(odd_rows)


def test_long_conversations_are_folded_in_blocks(make, odd_rows):
    rebuilt, conversations = trie.rebuild(trie.digested(make(odd_rows, TURNS)))
    assert got(trie.prefix_trie(rebuilt, conversations, block=4)) == built(odd_rows)


def test_extra_columns_and_partitioning_change_nothing(make, odd_rows):
    more = make([(*r, 1, "k") for r in odd_rows], TURNS + ", depth int, k1 string")
    assert got(trie.conversation_trie(more.repartition(7))) == built(odd_rows)


def test_turnless_and_empty(make):
    # Conversation 21 has fewer turns than it leaves to a base that is not there, so it ends in the root.
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 1)
    rows = [(c, 0, "u", "gone")]
    assert got(trie.conversation_trie(make(rows, TURNS))) == built(rows) == {
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())
    }
    assert trie.conversation_trie(make(rows, TURNS).limit(0)).count() == 0


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_prefix_trie"](spark, folder)) == built(rows)
