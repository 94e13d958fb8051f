"""The dealt queries against brute force on small tables with odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from check import compare, connect

import corpus_pipeline
from shelfscout.llm import attention, decontaminate, html, mixing, pii, quality, sharding, urls
from shelfscout.llm.queries import ORACLES, QUERIES

ODD_TEXTS = [None, "", " \t\n", "a", "Word " * 3000, "same text here", "same text here", "Éa b\x0bc"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, spans string, target string"


@pytest.fixture
def docs(make):
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else f"s{i % 3}", 1, 7, "x", "y") for i, t in enumerate(ODD_TEXTS)]
    return make([*rows, rows[5], (None, "no id", "de", "s1", None, None, None, None)], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None


def test_shards_are_gapless_lawful_and_whole(docs):
    got = sharding.shuffle_into_shards(docs, shards=5, bucket_bytes=4000).collect()
    assert len(got) == docs.count() and "shard" in got[0].asDict()
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    more = {r.doc_id: r.shard for r in sharding.shuffle_into_shards(docs, shards=6).collect()}
    assert all(more[r.doc_id] in (r.shard, 5) for r in got)
    assert sharding.shuffle_into_shards(docs.limit(0)).count() == 0


def test_repeats_of_one_row_are_dealt_out(spark, make):
    hot = spark.range(3000).selectExpr("5L AS doc_id", "'the very same text' AS text")
    rows = hot.unionAll(spark.range(6000).selectExpr("id AS doc_id", "concat('text ', id) AS text"))
    parts, sizes, _ = sharding.scatter(rows, 4, 42, 2000, "doc_id", "text")
    assert max(r["count"] for r in parts.groupBy("cell").count().collect()) < 300
    assert sizes.agg({"n": "sum"}).first()[0] == 9000
    got = sharding.shuffle_into_shards(rows, shards=4, bucket_bytes=2000).collect()
    assert sorted(r.doc_id for r in got) == sorted([5] * 3000 + list(range(6000)))
    for shard in range(4):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))


def test_rerun_gives_the_same_order(docs):
    order = lambda: sorted(str((r.shard, r.slot, r.doc_id)) for r in sharding.shuffle_into_shards(docs, shards=2).collect())
    assert order() == order()


def test_mix_of_odd_rows(docs):
    planned = mixing.plan_mix(docs).collect()
    sizes = Counter()
    for r in planned:
        sizes[r.source] += r.size
    assert all(r.source_size == sizes[r.source] and r.target <= 3 * r.source_size + 1e-6 and r.copies <= 3 for r in planned)
    per_source = {r.source: r.target for r in planned}
    assert sum(per_source.values()) == pytest.approx(sum(sizes.values()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in planned)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_urls(make):
    rows = [(1, "http://A.example.ORG/es/1?x"), (2, "https://x.example.org/en/12"), (3, "http://example.org/en/2"), (4, "ftp://b.com/fr/x"),
            (5, "http://b.com/de/"), (6, "http://evilorg/"), (7, None), (8, "no scheme"), (9, "http://org"), (9, "http://org"), (10, "")]
    got = {r.page_id: r for r in urls.judge_urls(make([(*r, "h") for r in rows], "page_id long, url string, host string")).collect()}
    want = {1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("x.example.org", "/en/12", "example.org/en/1", "block"),
            3: ("example.org", "/en/2", "org/", "allow"), 4: ("b.com", "/fr/x", "com/fr/", "allow"), 5: ("b.com", "/de/", "com/de/", "block")}
    for key, (host, path, rule, verdict) in want.items():
        assert (got[key].host, got[key].path, got[key].rule, got[key].verdict) == (host, path, rule, verdict)
    assert got[6].rule is None and (got[7].host, got[7].path) == ("", "") == (got[8].host, got[8].path) and got[9].rule is None


def test_url_trees_hold_out(spark, folder):
    judged = QUERIES["op3_url_filter"](spark, folder).where("rule IS NULL").collect()
    spam = [r.verdict == "block" for r in judged if re.search("spam|pills|casino", r.host)]
    clean = [r.verdict == "allow" for r in judged if not re.search("spam|pills|casino", r.host)]
    assert sum(clean) >= 0.95 * len(clean) and sum(spam) >= 0.8 * len(spam)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def luhn(d):
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return sum(x - 9 * (x > 9) for x in twice) % 10 == 0

    def ok(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        return kind == "email" or (16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15)

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if ok(k, m.group())]


def test_pii(make):
    texts = [*ODD_TEXTS, "x@y.z_a@b.c, a@b@c.d.e 𝄞 me@mail.com", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.04 9.9.9", "4465758382889437 4465 7583-8288 9437 1",
             "+1 (743) 555-3824 +12((( +1-2", "9" * 20000, "a" * 20000 + "@", "GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433", "my ssn 123-45-6789 "]
    got = {r.i: r.spans for r in pii.find_pii(make([(i, t, "s") for i, t in enumerate(texts)], "i int, text string, spans string")).collect()}
    for i, text in enumerate(texts):
        base = [(s.kind, s.start, s.end) for s in got[i] if s.kind in PATTERNS]
        assert base == base_spans(text)
    assert [s.value for s in got[len(texts) - 2] if s.kind == "iban"] == ["GB82 WEST 1234 5698 7654 32"]
    assert [s.kind for s in got[len(texts) - 1]] == ["ssn"]


def test_decontamination(make, spark):
    item = "Where does the quick brown fox jump over. It jumps over the lazy dog at noon today."
    items = make([(7, item, "s"), (8, "", "s"), (9, None, "s"), (10, "tiny one", "s"), (None, item, "s")], "item_id long, text string, k string")
    filler = " ".join(f"w{i}" for i in range(500))
    rows = [(1, filler + " " + item.upper() + " " + filler), (2, item.replace("noon", "night")), (3, filler), (4, None), (5, "a tiny one here"),
            (6, "Where does the quick brown fox jump over."), (1, item)]
    docs = make([(*r, 0.5, "h") for r in rows], "doc_id long, text string, score double, hit string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 7), (1, None), (2, 7), (2, None), (5, 10)}
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [3, 4, 6]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0 and decontaminate.clean(docs.limit(0), items).count() == 0


def test_index_finds_what_the_check_accepts(spark, folder):
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    index = decontaminate.Index(texts)
    for n, text in enumerate(texts):
        words = decontaminate.words_of(text)
        missing = int(0.2 * max(1, len(words) - 4))
        cut = " ".join(words[: len(words) - missing])
        whole, question, answer = decontaminate.overlaps(decontaminate.Index.Item(text), decontaminate.words_of(cut))
        found = n in {h["item"] for h in index.hits("start " + cut + " end")}
        assert found == (whole >= 0.8 - 1e-9 and question >= 0.5 and answer >= 0.5)


def test_quality(make, spark):
    good = "the cat sat on the mat and looked at the dog in the garden"
    rows = [(i, good + f" number{i % 7}.", "en", "x") for i in range(200)] + [(500, "!! $$ ## @@ !!zz%% ##q", "en", "x"), (501, None, None, "x"), (502, "", "en", "x")]
    docs = make(rows, "doc_id long, text string, lang string, perplexity string")
    labels = make([(i, 1, 0) for i in range(200)] + [(None, 1, None), (0, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert sum(got[i].keep for i in range(200)) >= 195
    assert not got[500].keep and not got[501].keep and not got[502].keep
    none = quality.judge(docs, labels.limit(0)).collect()
    assert sum(r.keep for r in none) == 201
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_model_is_a_distribution(make):
    model = quality.fit(make([("a b c a b d a b c. Zz",), ("b c a 12 b",)], "text string"))
    size = model.words.size
    for a in range(size):
        for b in range(size):
            p = [model._find(model.bi, [b * size + c], 0.0)[0] + model.back1[b] * model.uni[c] for c in range(size)]
            key = (a * size + b) * size
            p = [model._find(model.tri, [key + c], 0.0)[0] + model._find(model.back2, [a * size + b], 1.0)[0] * x for c, x in enumerate(p)]
            assert sum(p) == pytest.approx(1)


PAGE = """<html><head><title>no</title><style>p{}</style><script>var x="</p>";</script></head><body><nav><a href="/">Home</a></nav>
<div class="cookie-notice">We use cookies.</div><article><h1>A  title &amp; more</h1><p><b>First<br>line, which is long enough to read.<br><p>Second &#233; one,
with <a title="a>b">a link</a> in it.</p><!-- <p>gone</p> --><p>Third one, also with some words in it.</p><div class="comments"><p>Nice article, thanks!</p></div>
</article><aside>Related</aside><form><p>Mail</p></form><footer>Imprint</footer>"""


def test_html(make, spark):
    pages = make([(1, PAGE, "t"), (2, None, "t"), (3, "", "t"), (1, PAGE, "t"), (4, "<p>" * 3000, "t"), (5, "a < b <", "t")], "page_id long, html string, text string")
    got = {r.page_id: r for r in html.extract(spark, pages).collect()}
    want = "A title & more\nFirst line, which is long enough to read.\nSecond é one, with a link in it.\nThird one, also with some words in it."
    assert got[1].text == want and got[1].n_chars == len(want)
    assert got[2].text == got[3].text == got[4].text == "" and got[2].n_chars == 0
    assert html.extract(spark, pages.limit(0)).count() == 0


def test_least_cut_against_all_labellings():
    import itertools
    import random

    rng = random.Random(3)
    for _ in range(60):
        n = rng.randrange(1, 7)
        content, other = [rng.random() for _ in range(n)], [rng.random() for _ in range(n)]
        edges = [(i, j, rng.random() / 2) for i in range(n) for j in range(i) if rng.random() < 0.6]
        price = lambda lab: sum(c if x else o for x, c, o in zip(lab, content, other)) + sum(w for i, j, w in edges if lab[i] != lab[j])
        best = min(price(lab) for lab in itertools.product([True, False], repeat=n))
        assert price(html.least_cut(content, other, edges)) == pytest.approx(best)


def test_attention_base_counts(make, spark):
    rows = [(i, t) for i, t in enumerate([*ODD_TEXTS, "the cat the dog", "The CAT runs", "zzz unseen"])] + [(None, "cat"), (5, "same text here")]
    got = attention.score_texts(make([(*r, 1.0) for r in rows], "doc_id long, text string, score double"), known_words=2).collect()
    words = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)})) if w] + [None]
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    counts = Counter(w for k, t in rows if not held(k) for w in words(t))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((str(k), held(k), len(words(t)), sum(counts[w] > 0 for w in words(t)), total,
                   round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words(t)), 6)) for k, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert attention.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_windows_score_each_token_once():
    import numpy as np

    for n in (0, 1, 31, 32, 33, 500):
        ids = np.arange(n) % 7 + 2
        seen, target = attention.windows(ids)
        assert target[target >= 0].tolist() == [*ids.tolist(), attention.END] and len(seen) == len(target)


def test_scorer_agrees_with_the_network():
    import numpy as np

    rng = np.random.default_rng(5)
    for size in (0.1, 1.0, 40.0):
        net = attention.Network.fresh(rng.integers(0, 1000, 256).astype(float))
        for name in ("embed", "query", "key", "unembed"):
            net.p[name] *= np.float32(size / 0.1)
        for n in (0, 5, 31, 32, 400):
            seen, target = attention.windows(rng.integers(1, 256, n))
            assert attention.Scorer(net).logs(seen, target) == pytest.approx(net.logs(seen, target).sum(axis=1), rel=2e-4, abs=2e-3)


def test_gradients_against_differences():
    import numpy as np

    rng = np.random.default_rng(5)
    net = attention.Network.fresh(rng.integers(0, 1000, 20).astype(float), width=4, context=4)
    net = attention.Network({n: v.astype(np.float64) for n, v in net.p.items()})
    seen, target = attention.windows(rng.integers(1, 20, 9), context=4)
    loss = lambda: -net.logs(seen, target).sum() * math.log(10) / (target >= 0).sum()
    for name, slope in net.gradients(seen, target).items():
        for at in [tuple(rng.integers(0, n) for n in slope.shape) for _ in range(4)]:
            kept, step = net.p[name][at], 1e-5
            net.p[name][at] = kept + step
            high = loss()
            net.p[name][at] = kept - step
            low = loss()
            net.p[name][at] = kept
            assert slope[at] == pytest.approx((high - low) / (2 * step), rel=1e-3, abs=1e-5)


def test_leading_subword():
    vocabulary = {b" a": 1, b" abcd": 2, b"abcde": 3, b" b": 4, b" " + b"c" * 16: 5}
    starts = attention.prefixes(vocabulary)
    want = {b"abc": 1, b"abcdef": 2, b"x": -1, b"bb": 4, b"c" * 40: 5, b"c" * 15: -1, b"": -1}
    assert {w: attention.leading(w, starts) for w in want} == want


def test_attention_beats_the_base(spark, folder):
    got = QUERIES["op5_lm_score"](spark, folder).where("held_out").toPandas()
    assert got["score"].sum() > got["base_score"].sum()


def test_pii_digest(spark, folder):
    got = {r.doc_id: r for r in QUERIES["op9_pii"](spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        spans = base_spans(r["text"])
        assert got[r["doc_id"]].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_filter", "near_dedup", "decontamination", "mix_sources", "shard"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.run(spark, folder).columns[-3:] == ["shard", "bucket", "slot"]
