"""Alignment against a walk over tokens, byte by byte, in plain Python."""

from __future__ import annotations

import hashlib
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfscout.llm import alignment
from shelfscout.llm.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(alignment.VOCABULARY_FOLDER), reason="no vocabulary files")

TEXTS = [
    None, "", " ", "a", "plain words here", "plain words here", "é è 中文 日本𝔘 🙂🙂 ñ", "<|endoftext|> <s> <unk> <0x41>", "a▁b", "\n\n  two  spaces\t",
    "zero\x00byte", "word " * 40_000 + "é", "x" * 3000, "Ünï çödé " * 3000,
]


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(alignment.read_vocabularies())


def walked(pair, text):
    """Token ids, links and groups of a text from the decoded bytes alone, None without tokens."""
    if not text:
        return None
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    spelt = (" " + text).encode()
    if b"".join(pair.a_bytes[i] for i in a) != spelt or b"".join(pair.b_bytes[i] for i in b) != spelt:
        return None
    i = j = end_a = end_b = 0
    links, groups, group = [], [], ([], [])
    end_a, end_b = len(pair.a_bytes[a[0]]), len(pair.b_bytes[b[0]])
    group[0].append(a[0]), group[1].append(b[0])
    while True:
        links.append((a[i], b[j]))
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a and step_b:
            groups.append(group)
            group = ([], [])
        if step_a:
            i += 1
        if step_b:
            j += 1
        if i == len(a):
            return a, b, links, groups
        if step_a:
            end_a += len(pair.a_bytes[a[i]])
            group[0].append(a[i])
        if step_b:
            end_b += len(pair.b_bytes[b[j]])
            group[1].append(b[j])


def expected(pair, texts):
    found = [walked(pair, t) for t in texts]
    held = Counter(link for f in found if f for link in set(f[2]))
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = f
        spelt = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(held[k] == most[k[0]] for k in links)
        rows.append((len(a), len(b), len(groups), len(links), best, sum(held[k] for k in links), hashlib.sha256(spelt.encode()).hexdigest()))
    return rows


def test_odd_texts_and_clashing_columns(make, pair, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 200)  # several chunks
    docs = make([(i, t, 5, "z", 9) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_a int, `row` string, `chunk` int")
    got = alignment.alignment_counts(docs).collect()
    assert set(got[0].asDict()) == {"doc_id", "text", "row", "chunk", *alignment.ADDED}
    assert {r["row"] for r in got} == {"z"} and {r["chunk"] for r in got} == {9}
    by_id = {r.doc_id: tuple(r[c] for c in alignment.ADDED) for r in got}
    assert [by_id[i] for i in range(len(TEXTS))] == expected(pair, TEXTS)
    assert by_id[7][0] > 0 and by_id[8][0] == 0  # strings of special tokens are text; B's own mark for a space is not spelt back


def test_groups_are_the_texts(make, pair):
    texts = [t for t in TEXTS if t and len(t) < 5000]
    got = alignment.aligned(make(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in got:
        known = walked(pair, texts[row.doc_id])
        assert [(list(g.a_ids), list(g.b_ids)) for g in row.groups] == ([] if known is None else known[3])
        start, spelt = 0, (" " + texts[row.doc_id]).encode()
        for g in row.groups:
            assert b"".join(pair.a_bytes[i] for i in g.a_ids) == spelt[start : g.end] == b"".join(pair.b_bytes[i] for i in g.b_ids)
            start = g.end


def test_segments_change_nothing(pair):
    texts = [*TEXTS, "Éa 12 (b) c\n\nd  e f'll don't 中 文 x \u00a0 y\u2003z\x1c q " * 20]
    assert len(pair.segments(texts[-1])) > 100
    for text in texts:
        known, cut = walked(pair, text), alignment.align(pair, [text or ""])
        if known is None:
            assert cut.texts == [None]
            continue
        for k, name in ((0, "a"), (1, "b")):
            laid = (cut.a, cut.b)[k]
            assert laid.ids[alignment._expanded(cut.begins[name], cut.texts[0])].tolist() == known[k]


def test_coarse_cuts_agree_with_decoded_bytes(pair):
    texts = [t for t in TEXTS if t]
    a, b, good = pair.tokens(texts)
    assert good.tolist() == [walked(pair, t) is not None for t in texts] and not good.all()
    assert np.array_equal(a.ends, np.cumsum(pair.a_size[a.ids])) and np.array_equal(b.ends, np.cumsum(pair.b_size[b.ids]))


def test_empty_table_and_missing_vocabulary(make):
    docs = make([(1, "a")], "doc_id long, text string")
    assert alignment.alignment_counts(docs.limit(0)).count() == 0
    assert alignment.aligned(docs.limit(0)).count() == 0
    with pytest.raises(FileNotFoundError, match="nowhere"):
        alignment.read_vocabularies("/nowhere")


def test_query(spark, folder, pair):
    got = {r.doc_id: tuple(r[c] for c in alignment.ADDED) for r in QUERIES["op12_alignment"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert got == dict(zip([d.doc_id for d in docs], expected(pair, [d.text for d in docs])))


def test_forgetting_changes_nothing(monkeypatch):
    texts = [t for t in TEXTS if t and len(t) < 5000]
    runs = []
    for limit in (alignment.REMEMBERED, 2):
        monkeypatch.setattr(alignment, "REMEMBERED", limit)
        fresh = alignment.Pair(alignment.read_vocabularies())
        rows = [alignment._chunk_rows(fresh, "c", pa.array([{"d": 1}]), [t]).to_pylist() for t in [*texts, *texts]]
        assert rows[: len(texts)] == rows[len(texts) :]
        runs.append(rows)
    assert runs[0] == runs[1]
