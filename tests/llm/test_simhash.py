from __future__ import annotations

import random

import pytest
import xxhash

from shelfscout.llm import simhash
from shelfscout.llm.components import components


def brute_print(text):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """key -> smallest key reachable, over rows of (key, bits)."""
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return [least.get(top(i)) for i in range(len(prints))]


TEXTS = [
    "One two three FOUR five six", "one two three four five six", "one two three four five seven", "", None, "  \n", "Éa b", "a",
    "a", "word " * 5000, "x y", "the cat sat on the mat and then left", "the cat sat on the mat and then left again",
]


@pytest.mark.parametrize("block_rows", [512, 1])
def test_texts_against_brute_force(make, block_rows):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [rng.choice(words) for _ in range(200)]
    texts = list(TEXTS)
    for _ in range(60):
        copy = list(base)
        copy[rng.randrange(200)] = rng.choice(words)
        texts.append(" ".join(copy))
    rows = [(100 + i if i != 3 else None, t, f"s{i}") for i, t in enumerate(texts)] + [(100, TEXTS[0], "again")]
    got = simhash.near_duplicates(make(rows, "doc_id long, text string, bits string"), block_rows=block_rows).collect()
    prints = [(k, brute_print(t)) for k, t, _ in rows]
    want = sorted((str(k), f"{b:016x}", str(c)) for (k, b), c in zip(prints, brute_groups(prints)))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("block_rows", [512, 4])
def test_links_reach_every_pair_within_the_radius(spark, block_rows):
    rng = random.Random(11)
    centres = [rng.getrandbits(64) for _ in range(8)]
    bits = set(centres)
    for c in centres[:4]:
        for _ in range(40):
            bits.add(c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(6)))
    bits = sorted(bits)
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    prints = spark.createDataFrame([(b,) for b in signed], "bits long")
    got = {r["bits"]: r["root"] for r in simhash.roots(prints, block_rows).collect()}
    group = brute_groups(list(zip(signed, bits)))
    want = {}
    for s, g in zip(signed, group):
        want.setdefault(g, set()).add(s)
    have = {}
    for s, g in got.items():
        have.setdefault(g, set()).add(s)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(50)]
    star = [(1000, 1001 + i) for i in range(300)]
    got = components(spark.createDataFrame([*chain, *star, (7, 7), (50, 3)], "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in got}
    assert all(roots.get(i, i) == 0 for i in range(51)) and all(roots[1001 + i] == 1000 for i in range(300))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(make):
    rows = [(9, "a b c d e", "x"), (3, "a b c d e", "y"), (3, "a b c d e", "y"), (4, "other words here now", "z"), (None, "", "n"), (None, None, "n")]
    kept = simhash.keep_one(make(rows, "doc_id long, text string, row string"))
    assert kept.columns == ["doc_id", "text", "row"]
    got = sorted(map(str, (tuple(r) for r in kept.collect())))
    assert len(got) == 3 and "(3, 'a b c d e', 'y')" in got and "(4, 'other words here now', 'z')" in got


def test_empty_table(make, spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
