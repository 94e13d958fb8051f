"""Texts with very many spans."""

from __future__ import annotations

import time

from shelfscout.llm import pii


def test_places_over_many_blocks(make):
    counts = (0, 1, 255, 256, 257, 513, 1300)
    texts = ["".join(f"é{'x' * (i % 7)} a{i}@b.cd," for i in range(n)) for n in counts]
    rows = pii.find_pii(make(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(counts)
    for row in rows:
        assert len(row.spans) == counts[row.doc_id]
        assert all(texts[row.doc_id][s.start : s.end] == s.value == f"a{i}@b.cd" for i, s in enumerate(row.spans))


def test_a_log_of_addresses_takes_seconds(make):
    df = make([(1, " ".join(f"10.{i // 65536}.{i // 256 % 256}.{i % 256}" for i in range(60_000)))], "doc_id long, text string")
    pii.find_pii(make([(1, "x")], "doc_id long, text string")).collect()
    start = time.perf_counter()
    spans = pii.find_pii(df).selectExpr("size(spans) AS n", "element_at(spans, -1).end AS last", "char_length(text) AS size").first()
    assert spans.n == 60_000 and spans.last == spans["size"]
    assert time.perf_counter() - start < 60
