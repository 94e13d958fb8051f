"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Everything is a column expression. A text is cut at the matches of a pattern, so the lengths of the pieces give the
places of the spans in code points, and the pieces beside a span are its context.

The patterns are written with possessive runs: the same matches as the plain greedy form, without backtracking and
without Java's recursion on long repeats. A run that cannot start a match is left at once (look-behind).

Defined results: a NULL text is empty; empty texts, NULL ids and repeated rows give rows of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfscout.llm.common import named, others

CONTEXT_CHARS = 40
THRESHOLD = 0.5
# Elements that are added up at a time.
FOLD = 256
ADDED = ("spans",)

# The octet of an address with any leading zeros, up to 255.
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _address(value: Column) -> Column:
    return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)


def _phone(value: Column) -> Column:
    return F.length(_digits(value)).between(8, 15)


def _mod97(value: Column) -> Column:
    """The remainder of an account number, its first four signs moved to the end and letters counted from 10."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    signs = F.filter(F.split(turned, ""), lambda c: c != "")
    code = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda acc, c: F.pmod(acc * F.when(c.rlike("[0-9]"), 10).otherwise(100) + code(c), F.lit(97))
    return F.aggregate(signs, F.lit(0), step)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    check: object = None  # value -> boolean column
    prior: float = 0.5
    words: tuple[str, ...] = ()  # nearby words that raise the score
    base: bool = True  # base spans stay whatever their score
    needs: str = "[0-9]"  # a cheap test that any text with a match passes


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, 0.9, ("mail", "contact"), needs="@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", _address, 0.6, ("ip", "host", "server", "address"), needs=r"[0-9]\.[0-9]"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", _card, 0.8, ("card", "visa", "credit", "karte", "carte", "tarjeta"), needs="[0-9]{2}|[0-9][\x20-][0-9]"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.7, ("phone", "tel", "call", "mobile", "fax"), needs=r"\+[0-9]"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         lambda v: _mod97(v) == 1, 0.8, ("iban", "account", "bank", "konto", "compte", "cuenta"), base=False, needs="[A-Z]{2}[0-9]{2}"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, ("ssn", "social security"), base=False, needs="[0-9]-[0-9]{2}-[0-9]"),
)

SPAN = "array<struct<kind:string,start:long,end:long,value:string,score:double>>"


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is bound to a name, so that it is made once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(sizes: Column) -> Column:
    """What the sizes before each one add up to.

    An array grows by copying, so the sums of blocks of ``FOLD`` are run over first and then each block by itself.
    """
    empty = F.array().cast("array<bigint>")
    firsts = F.when(F.size(sizes) > 0, F.sequence(F.lit(0), F.size(sizes) - 1, F.lit(FOLD))).otherwise(F.array().cast("array<int>"))
    places = lambda first: F.sequence(first, F.least(first + FOLD, F.size(sizes)) - 1)

    def run(at: Column, values: Column) -> Column:
        start = F.struct(at.cast("bigint").alias("at"), empty.alias("out"))
        return F.aggregate(values, start, lambda acc, x: F.struct(
            (acc.getField("at") + x).cast("bigint").alias("at"), F.array_append(acc.getField("out"), acc.getField("at")).cast("array<bigint>").alias("out"),
        )).getField("out")

    sums = F.transform(firsts, lambda f: F.aggregate(places(f), F.lit(0).cast("bigint"), lambda acc, i: (acc + F.get(sizes, i)).cast("bigint")))
    inner = lambda base: F.flatten(F.transform(firsts, lambda f, k: run(F.get(base, k), F.transform(places(f), lambda i: F.get(sizes, i)))))
    return _named(run(F.lit(0), sums), inner)


def _spans(text: Column, kind: Kind) -> Column:
    """All confirmed spans of one kind in reading order."""
    found = F.struct(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("hit"), F.split(text, kind.pattern, -1).alias("gap"))
    bonus = F.lit(0.3)

    def score(before: Column, after: Column) -> Column:
        near = F.lower(F.concat(F.right(before, F.lit(CONTEXT_CHARS)), F.lit(" "), F.left(after, F.lit(CONTEXT_CHARS))))
        told = near.rlike(r"\b(?:" + "|".join(kind.words) + ")")
        return F.least(F.lit(1.0), F.lit(kind.prior) + F.when(told, bonus).otherwise(0.0))

    def place(one: Column) -> Column:
        hit, gap = one.getField("hit"), one.getField("gap")
        size = lambda value, i: (F.char_length(F.get(gap, i)) + F.char_length(value)).cast("bigint")
        return _named(F.transform(hit, size), lambda sizes: _named(_before(sizes), lambda ends: spans(hit, gap, ends)))

    def spans(hit: Column, gap: Column, before: Column) -> Column:
        def span(value: Column, i: Column) -> Column:
            begin = F.get(before, i) + F.char_length(F.get(gap, i))
            return F.struct(
                F.lit(kind.name).alias("kind"), begin.alias("start"), (begin + F.char_length(value)).cast("long").alias("end"),
                value.alias("value"), score(F.get(gap, i), F.get(gap, i + 1)).alias("score"),
            )

        def confirmed(found: Column) -> Column:
            ok = F.coalesce(kind.check(found.getField("value")), F.lit(False)) if kind.check else F.lit(True)
            return ok if kind.base else ok & (found.getField("score") >= THRESHOLD)

        return F.filter(F.transform(hit, span), confirmed).cast(SPAN)

    return F.when(text.rlike(kind.needs), _named(found, place)).otherwise(F.array().cast(SPAN))


def find_pii(df: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Add ``spans``: kind, start, end (code points, exclusive), value and score, by kind as listed, then by start."""
    body = F.coalesce(named(text), F.lit(""))
    return df.select(*others(df, ADDED), F.concat(*[_spans(body, k) for k in kinds]).alias("spans"))


def of_kind(spans: Column, kind: str) -> Column:
    """Number of spans of this kind."""
    return F.size(F.filter(spans, lambda s: s.getField("kind") == kind)).cast("long")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.getField("kind"), s.getField("start"), s.getField("end"))), ",")
