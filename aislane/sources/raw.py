"""Raw radio messages: JSON text files to one VARIANT per record."""

from __future__ import annotations

import functools
import logging
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_log = logging.getLogger(__name__)

# Line breaks within one physical line: the two characters \n, and whatever else ends a
# line of text. The rare ones are looked for first, for splitting by pattern is slow.
_TWO_CHARACTERS = r"\n"
_RARE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
# All that counts as white space at the ends of a line.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_BARE_WORDS = r"(?<![\w.+-])(-?Infinity|NaN)(?![\w.])"


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    line_separator: str | None = None,
    file_pattern: str = "*.json",
    skip_unreadable: bool = False,
    positions: bool = False,
) -> DataFrame:
    """Logical lines of all matching files under the paths: file, line.

    ``line_separator`` only chooses where Spark may cut a file into tasks. Files
    whose records are joined by the two characters ``\\n`` hold one physical line;
    pass that text as separator and they are read in parallel as well. The lines
    are the same either way. A missing folder is passed over with a warning. A file
    that can't be read fails the job unless ``skip_unreadable``; ``unreadable_files`` lists those passed over.
    With ``positions`` also ``source``, which sorts as the files are read one after the other, each from its start.
    """
    physical = _physical(spark, paths, line_separator, file_pattern, skip_unreadable)
    kept = [F.col("file"), F.col("value")]
    if positions:
        kept.append(_source().alias("source"))
    return split_lines(physical.select(*kept))


# Folders' names sort before longer names that begin alike, as a walk through the tree meets them.
_STEP = "\x01"
SOURCE_KIND = "struct<path:string,block:bigint,row:bigint,piece:int,element:int>"


def _source() -> Column:
    """Where a physical line stands. Rows are numbered in a task, and a block is read in one task from its start."""
    path = F.replace("file", F.lit("/"), F.lit(_STEP))
    return F.struct(path.alias("path"), F.col("block"), F.monotonically_increasing_id().alias("row"))


def _physical(
    spark: SparkSession, paths: str | Sequence[str], line_separator: str | None, file_pattern: str, skip_unreadable: bool
) -> DataFrame:
    """What Spark takes for lines: file, block (where the task's part of the file begins), value."""
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_pattern)
        .option("ignoreMissingFiles", skip_unreadable)
        .option("ignoreCorruptFiles", skip_unreadable)
    )
    if line_separator is not None:
        reader = reader.option("lineSep", line_separator)
    found = _of_present(paths, lambda present: reader.text(present))
    if found is None:
        return spark.createDataFrame([], "file string, block long, value string")
    return found.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _of_present(paths: str | Sequence[str], read: Callable[[list[str]], DataFrame]) -> DataFrame | None:
    """What ``read`` gives for the paths that exist. Spark looks all up before it lists any file, so each is listed once."""
    present = [paths] if isinstance(paths, str) else list(paths)
    while present:
        try:
            return read(present)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = _bare(error.getMessageParameters()["path"])
            left = [p for p in present if _bare(p) != missing]
            if len(left) == len(present):
                raise
            present = left
            _log.warning("no such folder, going on without it: %s", missing)
    return None


def _bare(address: str) -> str:
    """The path of an address, without scheme and host."""
    return "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", address).strip("/")


# As many hashes of corrupt lines go to every task.
KNOWN_TEXTS = 100_000


def corrupt_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    line_separator: str | None = None,
    file_pattern: str = "*.json",
    skip_unreadable: bool = False,
    known: DataFrame | None = None,
) -> DataFrame:
    """Lines that hold no JSON, with their number in the file, counted from 1: file, line_number, line.

    One scan, whatever the size of a file: each task counts the lines of its blocks and keeps only the corrupt ones and the
    physical lines that are several; a block is one row then, and sums over a file's blocks give where each begins.
    ``known`` holds the text of every corrupt line (``line``), where the files have been parsed before: then only lines with the
    hash of one of at most ``KNOWN_TEXTS`` texts are parsed again; beyond that, all are.
    """
    physical = _physical(spark, paths, line_separator, file_pattern, skip_unreadable)
    # The number is given to rows of the scan, before anything multiplies them.
    placed = physical.select("file", "block", F.monotonically_increasing_id().alias("row"), _pieces().alias("pieces"))
    lines = placed.select(
        "file", "block", "row", F.size("pieces").alias("n"), F.posexplode("pieces").alias("piece", "line")
    ).withColumn("line", _trimmed(F.col("line")))
    hashes = None if known is None else known.select(F.xxhash64("line").alias("hash")).distinct().limit(KNOWN_TEXTS + 1).persist()
    if hashes is not None and hashes.count() <= KNOWN_TEXTS:
        suspects = F.broadcast(hashes.withColumn("suspect", F.lit(True)))
        marked = lines.withColumn("hash", F.xxhash64("line")).join(suspects, "hash", "left").drop("hash")
        # Lines that are not suspected stand as an empty list, which costs next to nothing to parse.
        suspected = F.col("suspect").isNotNull()
        parsed = _sealed(marked.withColumns({"whole": F.col("line"), "line": F.when(suspected, F.col("line")).otherwise("[]")}))
        parsed = parsed.withColumn("line", F.col("whole"))
    else:
        parsed = _sealed(lines)
    parsed = parsed.withColumn("first", F.col("piece") == 0)
    corrupt = (F.col("line") != "") & ~F.col("_intact") & ~_is_long_list()
    several = F.col("first") & (F.col("n") > 1)
    event = F.struct("row", F.when(corrupt, F.col("piece")).alias("piece"), F.when(corrupt, F.col("line")).alias("line"),
                     F.when(several, F.col("n") - 1).otherwise(0).alias("more"))
    blocks = parsed.groupBy("file", "block").agg(
        F.min("row").alias("begin"),
        F.sum(F.when(F.col("first"), F.col("n"))).alias("lines"),
        F.collect_list(F.when(corrupt | several, event)).alias("events"),
    )
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    based = blocks.withColumn("ahead", F.coalesce(F.sum("lines").over(ahead), F.lit(0)))
    found = based.select("file", "block", "begin", "ahead", F.inline("events"))
    above = Window.partitionBy("file", "block").orderBy("row").rangeBetween(Window.unboundedPreceding, -1)
    more = F.coalesce(F.sum("more").over(above), F.lit(0))
    number = F.col("ahead") + F.col("row") - F.col("begin") + F.col("more_above") + F.col("piece") + 1
    counted = found.withColumn("more_above", more).where("line is not null")
    return counted.select("file", number.alias("line_number"), "line")


def unreadable_files(
    spark: SparkSession, paths: str | Sequence[str], file_pattern: str = "*.json"
) -> DataFrame:
    """Files that hold bytes but give no text when files that can't be read are passed over: file, bytes.

    A file that breaks off in the middle gives its first part and is not listed; without ``skip_unreadable`` it fails the job.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", file_pattern)
    found = _of_present(paths, lambda present: reader.format("binaryFile").load(present))
    if found is None:
        return spark.createDataFrame([], "file string, bytes long")
    listed = found.select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    read = _physical(spark, paths, None, file_pattern, skip_unreadable=True).select("file").distinct()
    return listed.where("bytes > 0").join(read, "file", "left_anti")


def stream_lines(
    spark: SparkSession,
    path: str,
    line_separator: str | None = None,
    file_pattern: str = "*.json",
    skip_unreadable: bool = False,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """As ``read_lines``, as a stream that takes each file once.

    A file that can't be read stops the stream before it is marked as taken, unless ``skip_unreadable``.
    A backlog is taken in batches of at most ``files_per_batch`` files or ``bytes_per_batch`` bytes (one of the two, a single larger
    file is a batch), so a batch has a bound whatever has piled up. Files of finished batches move below the folder ``archive``.
    """
    reader = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_pattern)
        .option("ignoreMissingFiles", skip_unreadable)
        .option("ignoreCorruptFiles", skip_unreadable)
    )
    if line_separator is not None:
        reader = reader.option("lineSep", line_separator)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    physical = reader.text(path)
    return split_lines(physical.select(F.col("_metadata.file_path").alias("file"), "value"))


def _pieces() -> Column:
    """The lines in a physical line, ``value``, as they stand."""
    value = F.col("value")
    # Marks beyond ASCII are looked for only in lines that have more bytes than characters.
    plain_ascii = F.octet_length(value) == F.length(value)
    rare, rare_wide = (
        functools.reduce(Column.__or__, [value.contains(mark) for mark in _RARE_BREAKS if mark.isascii() is ascii_mark])
        for ascii_mark in (True, False)
    )
    rare = rare | (~plain_ascii & rare_wide)
    common = value.contains(_TWO_CHARACTERS) | value.contains("\n")
    plain = F.replace(value, F.lit(_TWO_CHARACTERS), F.lit("\n"))
    # Most lines have no break and are copied no further.
    return (
        F.when(rare, F.split(plain, f"\r\n|[\n{_RARE_BREAKS}]"))
        .when(common, F.split(plain, "\n"))
        .otherwise(F.array(value))
    )


def split_lines(physical: DataFrame) -> DataFrame:
    """Cut the ``value`` text at every line break, trim, drop blanks; other columns stay, ``source`` with the piece."""
    others = [c for c in physical.columns if c not in ("value", "source")]
    # Pieces are trimmed as rows: a function over the list would be interpreted line by line.
    if "source" not in physical.columns:
        cut = physical.select(*others, F.explode(_pieces()).alias("line"))
    else:
        placed = physical.select(*others, "source", F.posexplode(_pieces()).alias("piece", "line"))
        cut = placed.select(*others, F.col("source").withField("piece", F.col("piece")).alias("source"), "line")
    return cut.withColumn("line", _trimmed(F.col("line"))).where("line != ''")


def _trimmed(line: Column) -> Column:
    blanks = F.lit(_BLANKS)
    closed = (line.startswith("{") | line.startswith("[")) & (line.endswith("}") | line.endswith("]"))
    at_edge = ~closed & (blanks.contains(F.left(line, F.lit(1))) | blanks.contains(F.right(line, F.lit(1))))
    return F.when(at_edge, F.btrim(line, blanks)).otherwise(line)


def _quote_bare_words(line: Column) -> Column:
    """Put quotes round NaN and Infinity outside texts, where strict JSON has no such words."""
    hidden = F.replace(
        F.replace(line, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02")
    )
    parts = F.transform(
        F.split(hidden, '"'),
        lambda part, i: F.when(i % 2 == 0, F.regexp_replace(part, _BARE_WORDS, "\x03$1\x03")).otherwise(part),
    )
    marked = F.array_join(parts, '"')
    for mark, text in (("\x03", '"'), ("\x02", '\\"'), ("\x01", "\\\\")):
        marked = F.replace(marked, F.lit(mark), F.lit(text))
    return marked


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``value``: the line's JSON, NULL unless the line holds exactly one JSON value.

    The parser stops after the first complete value, so ``{"a":1} rest`` would
    pass. Parsed as a list that ends in the line's own hash, any surplus text
    breaks the list or moves the hash.
    """
    return _sealed(lines).withColumn(
        "value", F.when(F.col("_intact"), F.try_variant_get("_listed", "$[0]", "variant"))
    ).drop("_listed", "_intact")


def _sealed(lines: DataFrame) -> DataFrame:
    """Add the line's list as ``_listed``, and ``_intact``: does the line hold exactly one JSON value?"""
    line = F.col("line")
    has_bare_word = line.contains("NaN") | line.contains("Infinity")
    strict = lines.withColumn(
        "_strict", F.when(has_bare_word, _quote_bare_words(line)).otherwise(line)
    )
    sealed = strict.withColumn("_seal", F.xxhash64("_strict")).withColumn(
        "_listed",
        F.try_parse_json(
            F.concat(F.lit("["), "_strict", F.lit(","), F.col("_seal").cast("string"), F.lit("]"))
        ),
    )
    intact = F.try_variant_get("_listed", "$[1]", "bigint") == F.col("_seal")
    return sealed.withColumn("_intact", F.coalesce(intact, F.lit(False))).drop("_strict", "_seal")


# A list this long may be too much for one VARIANT, whose limit is 128 MB; its elements are not.
_LONG_LIST = 64 << 20


def long_list(line: Column) -> Column:
    """The elements of a JSON list, each a value of its own; NULL unless the line is one list and nothing else.

    The line's own hash goes in as the last element: text behind the list moves or breaks it.
    """
    bare = line.contains("NaN") | line.contains("Infinity")
    strict = F.when(bare, _quote_bare_words(line)).otherwise(line)
    seal = F.xxhash64(line)
    opened = F.left(strict, F.length(strict) - 1)
    none = F.length(opened) == 1
    sealed = F.concat(opened, F.when(none, "").otherwise(","), seal.cast("string"), F.lit("]"))
    elements = F.from_json(F.when(strict.endswith("]"), sealed), "array<variant>")
    intact = F.try_variant_get(F.element_at(elements, -1), "$", "bigint") == seal
    return F.when(intact, F.slice(elements, 1, F.size(elements) - 1))


def _is_long_list() -> Column:
    """Is a line that no VARIANT holds one long list?"""
    line = F.col("line")
    return F.when(line.startswith("[") & (F.octet_length(line) > _LONG_LIST), long_list(line)).isNotNull()


def records(lines: DataFrame) -> DataFrame:
    """One row per record: an object gives one, a list its elements, a bare scalar none.

    A corrupt line keeps one row, with its text in ``corrupt_line`` and no record. A ``source`` gets the element's place.
    """
    line = F.col("line")
    parsed = parse_lines(lines).withColumn(
        "_long",
        F.when(
            F.col("value").isNull() & line.startswith("[") & (F.octet_length(line) > _LONG_LIST), long_list(line)
        ),
    )
    others = [c for c in lines.columns if c not in ("line", "source")]
    listed = (
        F.when(F.col("_long").isNotNull(), F.col("_long"))
        .when(F.col("value").isNull(), F.array(F.lit(None).cast("variant")))
        .when(F.col("line").startswith("["), F.try_variant_get("value", "$", "array<variant>"))
        .when(F.col("line").startswith("{"), F.array("value"))
    )
    corrupt = F.when(F.col("value").isNull() & F.col("_long").isNull(), line).alias("corrupt_line")
    if "source" not in lines.columns:
        return parsed.select(*others, corrupt, F.explode(listed).alias("record"))
    placed = parsed.select(*others, "source", corrupt, F.posexplode(listed).alias("element", "record"))
    source = F.col("source").withField("element", F.col("element")).cast(SOURCE_KIND)
    return placed.select(*others, source.alias("source"), "corrupt_line", "record")
