"""Cleaning, date and number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted spellings of a vote.
TRUE_SPELLINGS = ["true", "t", "1", "yes", "y", "recommended"]
FALSE_SPELLINGS = ["false", "f", "0", "no", "n", "not recommended"]
VOTE_LABELS = ["Recommended", "Not recommended", "Unknown"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Text without white space at either end, line breaks and tabs included."""
    return F.btrim(col(c).cast("string"), F.lit(" \t\r\n\f\v"))


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is no number becomes NULL."""
    return strip(c).try_cast("double")


def finite(c: Column | str) -> Column:
    """NaN and both infinities become NULL."""
    x = col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None)).otherwise(x)


def clean_number(c: Column | str) -> Column:
    return finite(to_number(c))


def clip(c: Column | str, low: float | Column | None, high: float | Column | None) -> Column:
    """Bound a value on either side; a NULL stays NULL."""
    x = col(c)
    bounded = x
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(x.isNotNull(), bounded)


def flag(c: Column | str) -> Column:
    """Platform flag to 0.0 / 1.0; accepts booleans, numbers and their text."""
    text = F.lower(strip(c))
    return F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0)).otherwise(text.try_cast("double"))


def vote_int(c: Column | str) -> Column:
    return col(c).cast("boolean").cast("int")


def vote_label(c: Column | str) -> Column:
    """Recommended / Not recommended / Unknown from any spelling of a vote."""
    text = F.lower(strip(F.coalesce(col(c).cast("string"), F.lit(""))))
    return (
        F.when(text.isin(TRUE_SPELLINGS), F.lit(VOTE_LABELS[0]))
        .when(text.isin(FALSE_SPELLINGS), F.lit(VOTE_LABELS[1]))
        .otherwise(F.lit(VOTE_LABELS[2]))
    )


def release_date(c: Column | str) -> Column:
    """Date from ISO text or 'Mon d, yyyy'; junk becomes NULL."""
    text = strip(c)
    return F.coalesce(
        F.try_to_timestamp(text),
        F.try_to_timestamp(text, F.lit("MMM d, yyyy")),
        F.try_to_timestamp(text, F.lit("MMM yyyy")),
    ).cast("date")


def release_parts(date: Column | str) -> dict[str, Column]:
    d = col(date)
    return {"release_year": F.year(d), "release_month": F.month(d)}


def age_days(date: Column | str, as_of: str) -> Column:
    """Whole days from ``date`` to ``as_of`` (a parameter, so that a run can be repeated)."""
    return F.datediff(F.lit(as_of).cast("date"), col(date))


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded metric; the added zero turns -0.0 into 0.0."""
    return F.round(col(c), digits) + F.lit(0.0)


def pick_key(seed: int, *ids: Column | str) -> Column:
    """Repeatable random order: the md5 of the seed and the ids, the same on every run and cluster."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[col(i).cast("string") for i in ids]).cast("binary"))
