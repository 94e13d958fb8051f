"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule is a verdict with a host and a path. It fits its host and all subdomains when the path of the url starts with the
rule's; the longest wins. Urls without a rule are judged by trees fitted on labelled urls: those of blocked words in the
host, and those that a rule decides. Suffix statistics (pages, hosts and usual length below the last two labels of a host)
come from all urls; the fit takes a bounded sample of the labelled ones (``sample_rows``).

Defined results: a NULL url or one without ``://`` has empty host and path, no rule, and the verdict of the trees on that;
repeated rows are judged alike; an empty table gives an empty one; with no labelled url of one class the other class,
and with none at all ``allow``, is the verdict. Columns named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from shelfscout.llm.common import ascii_lower, named, others, packed, unpacked
from shelfscout.session import spill

# The rules of the contract, (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Seed labels: words in a host that mark labelled spam.
BLOCK_WORDS = ("spam", "pills", "casino")
SAMPLE_ROWS = 50_000
TREES, DEPTH, SEED = 10, 4, 42
ADDED = ("host", "path", "rule", "verdict", "block_score")
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "label_length", "digit_ratio", "path_digits", "hyphens",
    "entropy", "parameters", "has_fragment", "vowel_ratio", "suffix_pages", "suffix_hosts", "suffix_length",
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(verdict, spelling) of the longest rule that fits, NULL without one."""
    verdict, spelling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, top, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == top) | host.endswith("." + top)) & path.startswith(start)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
        spelling = F.when(fits, F.lit(top + start)).otherwise(spelling)
    return verdict, spelling


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(F.length(whole) > 0, F.length(part) / F.length(whole)).otherwise(F.lit(0.0))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    signs = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text)
    return F.aggregate(signs, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))


def lexical(df: DataFrame, url: Column) -> DataFrame:
    """Add the features that one url gives by itself; needs ``host``, ``path`` and ``suffix``."""
    body, host, path = F.coalesce(url, F.lit("")), F.col("host"), F.col("path")
    owner = F.try_element_at(F.split(host, r"\."), F.lit(-3))
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    return df.withColumns(
        {
            "url_length": F.length(body).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": F.regexp_count(path, F.lit("/")).cast("double"),
            "labels": F.regexp_count(host, F.lit(r"\.")).cast("double"),
            "label_length": F.coalesce(F.length(owner), F.lit(0)).cast("double"),
            "digit_ratio": _ratio(digits(body), body),
            "path_digits": _ratio(digits(path), path),
            "hyphens": F.regexp_count(host, F.lit("-")).cast("double"),
            "entropy": F.coalesce(_entropy(host), F.lit(0.0)),
            "parameters": F.regexp_count(body, F.lit("[?&][^?&#]")).cast("double"),
            "has_fragment": F.when(body.contains("#"), 1.0).otherwise(0.0),
            "vowel_ratio": _ratio(F.regexp_replace(host, "[^aeiou]", ""), host),
        }
    )


def suffix_statistics(parts: DataFrame) -> DataFrame:
    """Per suffix of a host: log pages, log hosts and mean host length, over all urls."""
    hosts = parts.groupBy("suffix", "host").agg(F.count("*").alias("n"))
    return spill(
        hosts.groupBy("suffix").agg(
            F.log1p(F.sum("n")).alias("suffix_pages"),
            F.log1p(F.count("*")).alias("suffix_hosts"),
            (F.sum(F.length("host") * F.col("n")) / F.sum("n")).alias("suffix_length"),
        ),
        "suffixes",
    )


def fit_urls(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> Transformer | float:
    """Trees from rows of FEATURES and ``label`` (1 blocks); a constant score when a class is missing."""
    sizes = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("bad")).first()
    if sizes["bad"] in (0, sizes["n"]):
        return 1.0 if sizes["bad"] else 0.0
    share = min(1.0, sample_rows / sizes["n"])
    picked = spill(labelled.where(F.pmod(F.xxhash64("_row_hash"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))), "labelled")
    classes = picked.select("label").distinct().count()
    if classes < 2:
        picked = spill(labelled, "labelled")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(picked)
    trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=seed, maxMemoryInMB=64)
    return trees.fit(vectors.select("_features", "label"))


def judge_urls(
    df: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    block_words: Sequence[str] = BLOCK_WORDS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``block_score`` (NULL where a rule decides)."""
    address = named(url)
    split = df.select(packed(df, ADDED).alias("row"), address.alias("_url"), host_of(address).alias("host"), path_of(address).alias("path"))
    said, spelled = longest_rule(F.col("host"), F.col("path"), rules)
    suffix = F.array_join(F.slice(F.reverse(F.split("host", r"\.")), 1, 2), ".")
    parts = split.withColumns({"suffix": suffix, "rule": spelled, "said": said})
    bare = parts.select("_url", "host", "path", "suffix", "said")
    featured = lexical(bare, F.col("_url")).join(suffix_statistics(bare), "suffix")
    spam = F.col("host").rlike("|".join(block_words)) if block_words else F.lit(False)
    labelled = featured.where(spam | (F.col("said") == "allow")).select(
        *FEATURES, F.when(spam, 1.0).otherwise(0.0).alias("label"), F.col("_url").alias("_row_hash")
    )
    model = fit_urls(labelled, sample_rows)
    judged = lexical(parts, F.col("_url")).join(suffix_statistics(bare), "suffix")
    if isinstance(model, float):
        judged = judged.withColumn("block_score", F.lit(model))
    else:
        scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(judged))
        judged = scored.withColumn("block_score", vector_to_array("probability")[1])
    method = F.when(F.col("block_score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        *unpacked("row", df, ADDED), "host", "path", "rule",
        F.coalesce("said", method).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("block_score")).alias("block_score"),
    )
