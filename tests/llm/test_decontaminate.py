"""Whether a text holds an item depends on the two alone: brute force, long items, several slices."""

from __future__ import annotations

import random

from shelfscout.llm import decontaminate


def brute(text, item):
    """The check in every window of the class, at every place that half windows start at."""
    words, held = decontaminate.words_of(text), decontaminate.Index.Item(item)
    if not held.words:
        return False
    step = -(-3 * decontaminate.class_bound(len(held.words)) // 2)
    for first in range(0, max(1, len(words)), step):
        whole, question, answer = decontaminate.overlaps(held, words[first : first + 2 * step])
        if whole >= 0.8 - 1e-9 and question >= 0.5 and answer >= 0.5:
            return True
    return False


def phrase(rng, words):
    return " ".join(f"{rng.choice('abcdef')}{rng.randrange(40)}" for _ in range(words))


def test_scattered_shingles_are_clean_whatever_else_is_indexed():
    rng = random.Random(1)
    item = " ".join(f"q{i}" for i in range(14)) + ". " + " ".join(f"r{i}" for i in range(6))
    words = decontaminate.words_of(item)
    text = " ".join(" ".join(words[i : i + 5]) + " " + phrase(rng, 400) for i in range(len(words) - 4))
    long_item = phrase(rng, 5000) + ". " + phrase(rng, 20)
    assert decontaminate.Index([item]).hits(text) == [] == decontaminate.Index([item, long_item]).hits(text)
    found = decontaminate.Index([item, long_item]).hits(f"{text} {long_item} {item} {text}")
    assert [h["item"] for h in found] == [0, 1] and all(h["overlap"] == 1 for h in found)


def test_against_brute_force():
    rng = random.Random(5)
    items = [phrase(rng, rng.choice((1, 3, 8, 16, 17, 40, 64, 65, 300))) + ". " + phrase(rng, rng.choice((1, 5, 20))) for _ in range(60)] + ["", " ?"]
    index = decontaminate.Index(items)
    caught = 0
    for _ in range(80):
        item = decontaminate.words_of(rng.choice(items[:60]))
        for at in rng.sample(range(len(item)), int(len(item) * rng.choice((0, 0.02, 0.06)))):
            item[at] = "changed"
        text = " ".join([phrase(rng, rng.randrange(400)), *item, phrase(rng, rng.randrange(400))])
        wanted = [n for n, i in enumerate(items) if brute(text, i)]
        assert [h["item"] for h in index.hits(text)] == wanted
        caught += bool(wanted)
    assert caught > 40


def test_slices_change_nothing(make, monkeypatch):
    rng = random.Random(8)
    texts = [phrase(rng, rng.choice((6, 30, 90))) + ". " + phrase(rng, 6) for _ in range(30)]
    items = make([(n, t) for n, t in enumerate(texts)], "item_id long, text string")
    rows = [(n, " ".join([phrase(rng, 200), texts[n] if n % 2 else texts[n][::-1], phrase(rng, 200)])) for n in range(30)]
    docs = make(rows, "doc_id long, text string")
    wanted = {(d, i) for d, text in rows for i, item in enumerate(texts) if brute(text, item)}
    assert len(wanted) >= 15
    for most, chars in ((2000, 1 << 20), (7, 1 << 20), (2000, 600)):
        monkeypatch.setattr(decontaminate.slices, "__defaults__", ("item_id", "text", most, chars))
        assert len(decontaminate.slices(items)) > (most == 7) + (chars == 600) or most == 2000
        assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} == wanted
        assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == set(range(30)) - {d for d, _ in wanted}
