"""Hand-computed values of the scalar, token and vector expressions."""

from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from shelfscout.functions import scalars as S, tokens as T, vectors as V


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def apply(spark, values, expression, kind="string"):
    rows = column(spark, values, kind).select("i", expression.alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def test_feature_parser_keeps_braces(spark):
    got = apply(spark, ["['Action', \"RPG\"; 12]", "{'Action': 316, 'Co-op': 5}", None, "[]"], T.labels("x"))
    assert got == [["Action", "RPG", "12"], ["{Action: 316", "Co-op: 5}"], [], []]


def test_segment_parser_drops_digits(spark):
    got = apply(spark, ["{'Action': 316, 'Co-op': 5, 12}", " [ 'A\t' ;\n'B' ] "], T.segment_labels("x"))
    assert got == [["Action: 316", "Co-op: 5"], ["A", "B"]]


def test_label_text(spark):
    assert apply(spark, ["{'4 Player Local': 13}", None], T.label_text("x")) == ["Player Local", ""]


def test_tag_votes(spark):
    got = apply(spark, ["{'Action': 316, 'Co-op': 5}", "{'a': 1, 'a': 2}", None, "['x']"], T.tag_votes("x"))
    assert got == [{"Action": 316, "Co-op": 5}, {"a": 2}, {}, {}]


def test_clean_tags(spark):
    assert apply(spark, ["{'Action': 316}", "['x', 'y']"], T.clean_tags("x")) == [["Action"], ["x", "y"]]


def test_vote_label(spark):
    got = apply(spark, [" TRUE ", "n", "2", "Recommended", None], S.vote_label("x"))
    assert got == ["Recommended", "Not recommended", "Unknown", "Recommended", "Unknown"]


def test_has_tags(spark):
    assert apply(spark, [None, "[]", " {} ", "abc"], T.has_tags("x")) == [False, False, False, True]


def test_numbers(spark):
    assert apply(spark, ["0 - 20000", "1e3", "", " 7\n"], S.to_number("x")) == [None, 1000.0, None, 7.0]
    assert apply(spark, ["inf", "-inf", "nan", "2"], S.clean_number("x")) == [None, None, None, 2.0]


def test_clip_keeps_null(spark):
    assert apply(spark, [None, 0.0, 9.0], S.clip("x", 1.0, 5.0), "double") == [None, 1.0, 5.0]


def test_dates(spark):
    got = apply(spark, ["Oct 21, 2008", "2020-02-03", "soon", None], S.release_date("x"))
    assert got == [datetime.date(2008, 10, 21), datetime.date(2020, 2, 3), None, None]
    age = apply(spark, ["2024-01-01"], S.age_days(S.release_date("x"), "2024-01-31"))
    assert age == [30]


def test_flags(spark):
    assert apply(spark, ["True", "false", "1", "x", None], S.flag("x")) == [1.0, 0.0, 1.0, None, None]


def test_rounding_has_no_negative_zero(spark):
    (got,) = apply(spark, [-1e-12], S.rounded("x"), "double")
    assert math.copysign(1, got) == 1


def test_words_and_bigrams(spark):
    text = "A café's game-1 x ШХД 60 _a"
    assert apply(spark, [text], T.words("x")) == [["café", "game", "шхд", "60", "_a"]]
    assert apply(spark, ["one two three", "one", ""], T.ngrams_1_2(T.words("x"))) == [
        ["one", "two", "three", "one two", "two three"],
        ["one"],
        [],
    ]


def test_blobs(spark):
    df = spark.createDataFrame(
        [("Game", None, "{'Co-op': 3}", "['RPG']", None)], "name string, short_description string, tags string, genres string, categories string"
    )
    assert df.select(T.content_blob().alias("b")).first()["b"] == "Game  Co-op RPG "
    assert df.select(T.text_blob(["name", "short_description", "genres"]).alias("b")).first()["b"] == "Game  ['RPG']"


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    row = df.select(
        V.dot("a", "b").alias("dot"), V.norm("a").alias("norm"), V.cosine("a", "b").alias("cos"),
        V.cosine("a", "z").alias("zero"), V.squared_distance("a", "b").alias("d2"), V.unit("a").alias("unit"), V.unit("z").alias("z"),
        V.min_max(F.lit(2.0), 0.0, 4.0).alias("scaled"),
    ).first()
    assert (row["dot"], row["norm"], row["d2"], row["zero"]) == (3.0, 5.0, 20.0, 0.0)
    assert row["cos"] == pytest.approx(0.6) and row["unit"] == pytest.approx([0.6, 0.8]) and row["z"] == [0.0, 0.0]
    assert row["scaled"] == pytest.approx(0.5)


def test_grid_makes_sums_exact(spark):
    df = spark.createDataFrame([([0.1, 0.2, 0.3],), ([0.3, 0.1, 0.2],)], "a array<double>")
    ones = F.array(F.lit(1.0), F.lit(1.0), F.lit(1.0))
    got = {r[0] for r in df.select(V.dot(V.on_grid("a"), ones)).collect()}
    assert len(got) == 1


def test_pick_key_is_md5_of_seed_and_ids(spark):
    import hashlib

    (got,) = apply(spark, ["b"], S.pick_key(42, F.lit("a"), "x"))
    assert got == hashlib.md5(b"42|a|b").hexdigest()
