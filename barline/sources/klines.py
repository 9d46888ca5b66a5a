"""Raw kline files, plain or zipped, as candles."""

from __future__ import annotations

import codecs
import io
from pathlib import PurePosixPath
from zipfile import ZipFile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.time import epoch_to_ntz
from barline.schemas import CANDLE, RAW

RAW_DDL = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW.fields)
CORRUPT = "_damaged"
BLOCKS = "path string, member string, block string, error string"
BLOCK_CHARS = 4 << 20

# Fixed value: the first field of a header line.
HEADER_FIELD = "open_time"

# .../<asset>/<freq>/<data type>/<symbol>/<interval>/<file>
PATH_KEYS = r"/([^/]+)/(daily|monthly)/[^/]+/([^/]+)/([^/]+)/[^/]+\z"


def with_path_keys(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds freq, symbol and interval, taken from where a file lies."""
    keys = {"freq": 2, "symbol": 3, "interval": 4}
    return df.withColumns({name: F.regexp_extract(path, PATH_KEYS, group) for name, group in keys.items()})


def landed_files(spark: SparkSession, destination: str) -> DataFrame:
    """The `path` of every archive below a folder, spelled like the folder: contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.zip")
        .load(destination)
    )
    if "://" in destination:
        return files.select("path")
    return files.select(F.regexp_replace("path", r"^[a-z][a-z0-9+.-]*:(//[^/]*(?=/))?", "").alias("path"))


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Raw columns of (path, member, line) rows, with the line and a flag `damaged`.

    Blank lines and header lines, whose first field is the header's name, are no data. A line is damaged if it has
    another number of fields, a field that is not of its type, or no opening time.
    """
    first = F.lower(F.trim(F.split_part("line", F.lit(","), F.lit(1))))
    lines = lines.where(F.col("line").isNotNull() & (F.trim("line") != "") & (first != HEADER_FIELD))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = lines.select(F.from_csv("line", f"{RAW_DDL}, `{CORRUPT}` string", options).alias("r"), "path", "member", "line")
    damaged = F.col(CORRUPT).isNotNull() | F.col("open_time").isNull()
    return rows.select("r.*", "path", "member", "line").withColumn("damaged", damaged).drop(CORRUPT)


def damaged_lines(lines: DataFrame) -> DataFrame:
    """(path, member, line) of the lines that are neither data nor header."""
    return parsed_lines(lines).where("damaged").select("path", "member", "line")


def parse_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Raw rows of text lines. A damaged line fails the job, or with strict=False is left to `damaged_lines`."""
    rows = parsed_lines(lines)
    if strict:
        message = F.concat_ws(" ", F.lit("damaged line in"), "path", F.lit(":"), "line")
        rows = rows.where(F.when(F.col("damaged"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    else:
        rows = rows.where(~F.col("damaged"))
    return rows.drop("line", "damaged")


def file_lines(files: DataFrame) -> DataFrame:
    """(path, member, line) of text files read with their `value` and file metadata."""
    return files.select(F.col("_metadata.file_path").alias("path"), F.lit(None).cast("string").alias("member"), F.col("value").alias("line"))


def scan_lines(spark: SparkSession, paths) -> DataFrame:
    """(path, member, line) of kline CSV files below the paths."""
    return file_lines(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(paths))


def read_klines(spark: SparkSession, paths, keys: bool = True, strict: bool = True) -> DataFrame:
    """Rows of kline CSV files with their `path`, and the series keys of that path."""
    rows = parse_lines(scan_lines(spark, paths), strict)
    return with_path_keys(rows) if keys else rows


def _unzip(on_unsafe, block_chars):
    """Text blocks of the archives in a batch, cut at line ends; archives stay in memory, members do not.

    The function it returns carries all it needs, so tasks need not import this package.
    """

    def frame(path, member, block, error=None):
        return pd.DataFrame({"path": [path], "member": [member], "block": [block], "error": [error]}, dtype=object)

    def leaves_folder(name):
        member = PurePosixPath(name)
        return member.is_absolute() or ".." in member.parts

    def blocks(raw):
        decode, rest = codecs.getincrementaldecoder("utf-8")().decode, ""
        while True:
            data = raw.read(block_chars)
            text = rest + decode(data, not data)
            cut = len(text) if not data else text.rfind("\n") + 1
            if cut:
                yield text[:cut]
            rest = text[cut:]
            if not data:
                return

    def run(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with ZipFile(io.BytesIO(content)) as archive:
                    names = [m.filename for m in archive.infolist() if not m.is_dir()]
                    unsafe = [n for n in names if leaves_folder(n)]
                    if unsafe and on_unsafe == "raise":
                        raise ValueError(f"unsafe member {unsafe[0]} in {path}")
                    for name in unsafe:
                        yield frame(path, name, None, "unsafe member")
                    data = [n for n in names if n.endswith(".csv") and "/" not in n]
                    for name in [] if unsafe else data:
                        with archive.open(name) as raw:
                            for block in blocks(raw):
                                yield frame(path, name, block)

    return run


def unzip(files: DataFrame, on_unsafe: str = "raise", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(path, member, line, error) of archives given as (path, content).

    Python only unzips; the blocks are split into lines on the JVM side.
    """
    blocks = files.select("path", "content").mapInPandas(_unzip(on_unsafe, block_chars), BLOCKS)
    line = F.explode_outer(F.split("block", "\r?\n"))
    lines = blocks.select("path", "member", line.alias("line"), "error")
    # A block ends with a line end, so its last piece is empty.
    return lines.where(F.col("error").isNotNull() | (F.col("line") != ""))


def scan_archives(spark: SparkSession, path, on_unsafe: str = "raise") -> DataFrame:
    """(path, member, line, error) of every ZIP file below a path.

    An archive with a member that would leave its folder is refused as a whole: the job fails,
    or with on_unsafe="report" the archive gives one error row per such member and no lines.
    Only the unzipping is Python; lines are parsed on the JVM side.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.zip")
        .load(path)
    )
    return unzip(files, on_unsafe)


def read_zipped_klines(
    spark: SparkSession, path, on_unsafe: str = "raise", keys: bool = True, strict: bool = True
) -> DataFrame:
    """Rows of zipped kline files, as read_klines gives them for plain ones."""
    rows = parse_lines(scan_archives(spark, path, on_unsafe), strict)
    return with_path_keys(rows) if keys else rows


def to_candles(
    raw: DataFrame, symbol: str | None = None, interval: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Raw rows as candles: named columns, UTC times, series keys from arguments or columns.

    `keep` names further columns to carry along, such as `path` for keep-first by file.
    """
    rows = raw.withColumns({"open_time": epoch_to_ntz("open_time"), "close_time": epoch_to_ntz("close_time")})
    if symbol is not None:
        rows = rows.withColumn("symbol", F.lit(symbol.upper()))
    if interval is not None:
        rows = rows.withColumn("interval", F.lit(interval))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CANDLE.fields], *keep)
