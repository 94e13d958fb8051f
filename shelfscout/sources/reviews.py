"""Review files: one CSV per item, the item named by the path.

Files may differ in column order and in extra columns. Spark binds a given CSV schema by position, so the first
line of each file is looked at first; then all files are parsed in one scan, and a file's header says which cell is
which. Spark's own readers open the files, so any file system of the cluster will do.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from shelfscout.functions.scalars import flag, to_number
from shelfscout.session import spill
from shelfscout.sources.schema import ITEM_KEY, REVIEW_SCHEMA

FILE_NAME_KEY = r"([^/]+)\.csv$"
# Commas outside of quotes.
CELL_BREAK = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'

# What opening a file counts for when Spark deals files to tasks. Its own 4 MB make a task of every 32 files, however small they are.
OPEN_COST = 64 * 1024

# Opens the chosen files with a prepared reader.
Source = Callable[[DataFrameReader], DataFrame]


@contextmanager
def _small_files(spark: SparkSession) -> Iterator[None]:
    """Scans planned inside put many small files into a task."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_COST))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class ReviewScan:
    """Rows of the readable files and the files left out, with the reason."""

    rows: DataFrame
    quarantine: DataFrame


def _spelled(path: Column) -> Column:
    """One spelling of a path: an empty authority is written out."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/(?!/)", "$1:///")


def _opened() -> Column:
    """Path of the file a row was read from; the scan reports it with escapes, in which a plus sign is plain."""
    return _spelled(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))))


def _below(root: str) -> Source:
    return lambda reader: reader.options(recursiveFileLookup=True, pathGlobFilter="*.csv").load(root)


def _only(files: DataFrame) -> Source:
    """These files alone; names only, which Spark keeps on the driver for every scan."""
    paths = sorted(r["path"] for r in files.select("path").toLocalIterator())
    # A name is no pattern.
    plain = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]
    return lambda reader: reader.load(plain)


def list_review_files(
    spark: SparkSession, root: str, key_pattern: str = FILE_NAME_KEY, limit_files: int | None = None
) -> DataFrame:
    """``(path, item key)`` of every CSV below ``root``; the first ``limit_files`` by path when given.

    Only names are listed, empty files among them, as Spark lists them for any scan; nothing is read.
    """
    if limit_files is not None and limit_files <= 0:
        raise ValueError("limit_files must be a positive integer")
    listing = _below(root)(spark.read.format("binaryFile"))
    names = sorted(unquote(name) for name in listing.inputFiles())[:limit_files]
    files = spark.createDataFrame([(name,) for name in names], "path string").select(_spelled(F.col("path")).alias("path"))
    return files.select("path", F.regexp_extract("path", key_pattern, 1).alias(ITEM_KEY))


def probe_headers(files: DataFrame, source: Source, required: Sequence[str]) -> DataFrame:
    """Add the header line and, where a file cannot be used, the ``reason``."""
    reader = files.sparkSession.read
    lines = source(reader.format("text").options(ignoreCorruptFiles=True, ignoreMissingFiles=True)).select(
        _opened().alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    # A split is read from its start, so the first line of a file has the smallest place of its first split.
    first = lines.where("start = 0").groupBy("path").agg(F.min_by("value", "place").alias("header"))
    first = first.select("path", F.regexp_replace("header", "^\ufeff|\r+$", "").alias("header"))
    sizes = source(reader.format("binaryFile")).select(_spelled(F.col("path")).alias("path"), "length")
    probed = files.join(first, "path", "left").join(sizes, "path", "left")
    names = F.transform(F.split("header", CELL_BREAK), lambda n: F.trim(F.regexp_replace(n, '"', "")))
    absent = F.array_except(F.lit(list(required)), names)
    return probed.select(
        *files.columns,
        "header",
        F.when(F.col("header").isNull() & (F.col("length") > 0), F.lit("unreadable"))
        .when(F.length(F.trim(F.coalesce("header", F.lit("")))) == 0, F.lit("empty file"))
        .when(F.size(absent) > 0, F.concat(F.lit("missing columns: "), F.array_join(absent, ", ")))
        .alias("reason"),
    )


def scan_reviews(
    spark: SparkSession,
    root: str,
    key_pattern: str = FILE_NAME_KEY,
    limit_files: int | None = None,
    items: DataFrame | None = None,
    multi_line: bool = False,
    whole_files: bool = True,
) -> ReviewScan:
    """Read the review files below ``root``.

    ``items`` (one key column) keeps the files of sampled items, before anything of them is read. Lines with
    more cells than the header spoil their file, which is then left out whole; for that the parsed rows are written
    once, which ``whole_files=False`` saves by leaving out the lines only. Set ``multi_line`` when a cell may hold
    a line break; files are then not split.
    """
    files = list_review_files(spark, root, key_pattern, limit_files)
    if items is not None:
        files = files.join(items.select(F.col(items.columns[0]).cast("string").alias(ITEM_KEY)).distinct(), ITEM_KEY, "left_semi")
    required = REVIEW_SCHEMA.fieldNames()
    files = spill(files, "files")
    if files.isEmpty():
        raise RuntimeError("no review files selected")
    source = _below(root) if limit_files is None and items is None else _only(files)
    with _small_files(spark):
        probed = spill(probe_headers(files, source, required), "headers")
    if not probed.where("reason = 'unreadable'").isEmpty():
        source = _only(probed.where("reason IS NULL"))

    rows = _parse(probed, source, multi_line)
    if whole_files:
        with _small_files(spark):
            rows = spill(rows, "parsed")
    torn = rows.where("_torn").select(F.col("_path").alias("path")).distinct()
    torn = torn.withColumn("reason", F.lit("line with too many cells"))
    if whole_files:
        torn = spill(torn, "torn")
        if not torn.isEmpty():
            rows = rows.join(torn.select(F.col("path").alias("_path")), "_path", "left_anti")
    rows = rows.where(~F.col("_torn"))
    key = F.regexp_extract("_path", key_pattern, 1)
    rows = rows.select(*required, key.alias(ITEM_KEY))
    quarantine = probed.where(F.col("reason").isNotNull()).select("path", "reason").unionByName(torn)
    return ReviewScan(rows, quarantine)


def _parse(probed: DataFrame, source: Source, multi_line: bool) -> DataFrame:
    """Rows of all usable files, with ``_torn`` for a line of too many cells and ``_path``."""
    usable = probed.where("reason IS NULL")
    # Different headers are few by nature. The most frequent one is taken where the table of the others has no word on a file.
    headers = [r["header"] for r in usable.groupBy("header").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "header").collect()]
    if not headers:
        raise RuntimeError("no review file could be read")
    layouts = [[n.strip() for n in next(csv.reader([h]))] for h in headers]
    width = max(map(len, layouts))
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width + 1)])
    raw = source(
        probed.sparkSession.read.format("csv").schema(schema)
        .options(header=True, quote='"', escape='"', mode="PERMISSIVE", multiLine=multi_line, enforceSchema=True)
    )
    used = sorted({names.index(n) for names in layouts for n in REVIEW_SCHEMA.fieldNames()} | set(map(len, layouts)))
    raw = raw.select(*[f"c{i}" for i in used], _opened().alias("_path"))
    layout = F.array_position(F.lit(headers), F.col("header")).cast("int") - 1
    others = probed.select(F.col("path").alias("_path"), F.when(F.col("reason").isNull(), layout).otherwise(-1).alias("_layout"))
    others = spill(others.where("_layout <> 0"), "layouts")
    if others.isEmpty():
        raw = raw.withColumn("_layout", F.lit(0))
    else:
        raw = raw.join(others, "_path", "left").withColumn("_layout", F.coalesce("_layout", F.lit(0))).where("_layout >= 0")

    def cell(place: Callable[[list[str]], int]) -> Column:
        return F.coalesce(*[F.when(F.col("_layout") == i, F.col(f"c{place(names)}")) for i, names in enumerate(layouts)])

    named = {n: cell(lambda names, n=n: names.index(n)) for n in REVIEW_SCHEMA.fieldNames()}
    return raw.select(
        # By way of a double only where the id is not written as a whole number: large ids would change.
        F.coalesce(F.trim(named["recommendationid"]).try_cast("long"), to_number(named["recommendationid"]).cast("long")).alias("recommendationid"),
        F.trim(named["author_steamid"]).alias("author_steamid"),
        flag(named["voted_up"]).cast("boolean").alias("voted_up"),
        to_number(named["author_playtime_forever"]).alias("author_playtime_forever"),
        cell(len).isNotNull().alias("_torn"),
        "_path",
    )
