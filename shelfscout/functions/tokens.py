"""Multi-label cells, text blobs, words and n-grams."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfscout.functions.scalars import col, strip

WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def _split_cell(text: Column) -> Column:
    parts = F.transform(F.split(text, "[;,]"), strip)
    return F.filter(parts, lambda p: p != "")


def _or_empty(cell: Column, tokens: Column) -> Column:
    return F.when(cell.isNull(), F.array().cast("array<string>")).otherwise(tokens)


def labels(c: Column | str) -> Column:
    """Cell to tokens: brackets and quotes go, split on ';' or ','. Braces and 'tag: votes' stay."""
    cell = col(c).cast("string")
    return _or_empty(cell, _split_cell(F.regexp_replace(cell, r"""[\[\]'"]""", "")))


def segment_labels(c: Column | str) -> Column:
    """As ``labels``, but braces go too and tokens made of digits only are dropped."""
    cell = col(c).cast("string")
    tokens = _split_cell(F.regexp_replace(cell, r"""[\[\]{}'"]""", ""))
    return _or_empty(cell, F.filter(tokens, lambda t: ~t.rlike("^[0-9]+$")))


def label_text(c: Column | str) -> Column:
    """Cell to plain words: quotes, brackets, colons and all digits become blanks; '' for a missing cell."""
    text = F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), r"""["'\[\]{}:0-9]""", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def tag_votes(c: Column | str) -> Column:
    """Cell written as a dict to a map tag -> votes; of a tag written twice the last entry counts."""
    cell = F.coalesce(col(c).cast("string"), F.lit(""))
    pattern = r"""['"]([^'"]+)['"]\s*:\s*(\d+)"""
    names = F.regexp_extract_all(cell, F.lit(pattern), 1)
    votes = F.transform(F.regexp_extract_all(cell, F.lit(pattern), 2), lambda v: v.try_cast("int"))
    pairs = F.arrays_zip(names.alias("name"), votes.alias("votes"))
    last = F.filter(
        F.transform(pairs, lambda p, i: F.struct(p["name"].alias("name"), p["votes"].alias("votes"), i.alias("i"))),
        lambda p: ~F.array_contains(F.slice(names, p["i"] + 2, F.greatest(F.size(names), F.lit(1))), p["name"]),
    )
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["name"], p["votes"])))


def clean_tags(c: Column | str) -> Column:
    """Tag names: the keys of a dict cell, else the tokens of a list cell."""
    votes = tag_votes(c)
    return F.when(F.size(votes) > 0, F.map_keys(votes)).otherwise(segment_labels(c))


def has_tags(c: Column | str) -> Column:
    """False for a missing cell, '[]', '{}' and anything else of at most two characters."""
    return F.coalesce(F.length(strip(c)) > 2, F.lit(False))


def prefixed(column_name: str, tokens: Column) -> Column:
    """``column__token`` in lower case."""
    return F.transform(tokens, lambda t: F.concat(F.lit(column_name + "__"), F.lower(t)))


def all_labels(columns: list[str], prefix: bool = True, parser=labels) -> Column:
    """Tokens of several label columns of one row, duplicates kept."""
    if prefix:
        return F.flatten(F.array(*[prefixed(c, parser(c)) for c in columns]))
    return F.flatten(F.array(*[F.transform(parser(c), lambda t: F.lower(t)) for c in columns]))


def text_blob(columns: list[str]) -> Column:
    """Texts joined by one blank; a missing one counts as ''."""
    return F.concat_ws(" ", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])


def content_blob(
    name: str = "name",
    description: str = "short_description",
    label_columns: tuple[str, ...] = ("tags", "genres", "categories"),
) -> Column:
    plain = [F.coalesce(col(c).cast("string"), F.lit("")) for c in (name, description)]
    return F.concat_ws(" ", *plain, *[label_text(c) for c in label_columns])


def words(c: Column | str) -> Column:
    """Lower-case words of at least two letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(WORD_PATTERN), 0)


def ngrams_1_2(tokens: Column) -> Column:
    """The words themselves, then each pair of neighbours."""
    pairs = F.when(
        F.size(tokens) > 1,
        F.zip_with(
            F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(1))),
            F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(1))),
            lambda a, b: F.concat_ws(" ", a, b),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(tokens, pairs)
