"""Delimited text files.  Everything arrives as text; typing is a later, explicit step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where a row comes from, if a reader is asked for it: number of the file in the list, and place in the file.
ORIGIN = ("Source", "Row")

UTF8 = "UTF-8"
CP1252 = "windows-1252"
LATIN1 = "ISO-8859-1"

# Code page 1252 equals Latin-1 but for these bytes, which Latin-1 reads as controls.
_C1 = [(chr(b), bytes([b]).decode("cp1252")) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_CONTROLS = "".join(control for control, _ in _C1)
_LETTERS = "".join(letter for _, letter in _C1)
_UNDEFINED_IN_CP1252 = "^(..)*(81|8D|8F|90|9D)"


def _reader_charset(encoding: str) -> str:
    return LATIN1 if encoding == CP1252 else encoding


def _decoded(df: DataFrame, encoding: str) -> DataFrame:
    if encoding != CP1252:
        return df
    return df.select(*(F.col(c) if c in ORIGIN else F.translate(F.col(f"`{c}`"), _CONTROLS, _LETTERS).alias(c) for c in df.columns))


def _options(encoding: str, quoted: bool, header: bool) -> dict[str, str]:
    options = {"encoding": _reader_charset(encoding), "header": str(header).lower(), "sep": ","}
    # The file's blanks are data; cleaning decides about them later.
    options.update({"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    options.update({"quote": '"', "escape": '"'} if quoted else {"quote": "", "escape": ""})
    return options


def read_headered(
    spark: SparkSession, path: str, width: int | None = None, encoding: str = UTF8, quoted: bool = False,
    line_breaks: bool = False, source: int | None = None,
) -> DataFrame:
    """File with a header line; those past ``width`` are dropped.

    All files of a folder must have the same columns in the same order; one
    that differs is an error (use ``read_parts``, which goes by name).
    ``line_breaks`` lets quoted fields span lines, at the price of one task per
    file.  With ``source``, the number of the file, rows get ``ORIGIN``.
    """
    options = _options(encoding, quoted, header=True)
    raw = spark.read.options(**options, multiLine=str(line_breaks).lower(), enforceSchema="false").csv(path)
    kept = raw.select(*(F.col(f"`{c}`") for c in raw.columns[:width]), *([] if source is None else _origin(source)))
    names = [c.encode("latin-1").decode("cp1252") if encoding == CP1252 else c for c in raw.columns[:width]]
    return _decoded(kept.toDF(*names, *([] if source is None else ORIGIN)), encoding)


def _origin(source: int) -> list[Column]:
    """Rows of one file in order: by file name and block, then as they are read."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return [F.lit(source).alias(ORIGIN[0]), place.alias(ORIGIN[1])]


def read_headerless(
    spark: SparkSession, path: str, names: list[str], encoding: str = CP1252, quoted: bool = False, source: int | None = None
) -> DataFrame:
    """File without a header; the leading fields take ``names`` by position.  With ``source`` rows get ``ORIGIN``."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(schema).options(**_options(encoding, quoted, header=False)).csv(path)
    return _decoded(raw if source is None else raw.select("*", *_origin(source)), encoding)


def read_parts(
    spark: SparkSession, paths: list[str], width: int | None = None, encoding: str = CP1252, origin: bool = False
) -> DataFrame:
    """Several files of one shape as one source; column order may differ between files.

    With ``origin`` rows carry their place (``ORIGIN``), by which the first of several is the first file's.
    """
    frames = [read_headered(spark, p, width, encoding, source=k if origin else None) for k, p in enumerate(paths)]
    return reduce(lambda a, b: a.unionByName(b), frames)


def encoding_faults(spark: SparkSession, path: str) -> DataFrame:
    """One pass over the raw lines: how many could not be read as UTF-8 or as code page 1252."""
    lines = spark.read.text(path)
    raw = F.hex(F.col("value").cast("binary"))
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~F.call_function("is_valid_utf8", F.col("value"))).alias("not_utf8"),
        F.count_if(raw.rlike(_UNDEFINED_IN_CP1252)).alias("not_cp1252"),
    )


def detect_encoding(spark: SparkSession, path: str) -> str:
    """First of UTF-8 (byte-order mark or not), code page 1252, Latin-1 that reads without a fault."""
    faults = encoding_faults(spark, path).first()
    if not faults.not_utf8:
        return UTF8
    return CP1252 if not faults.not_cp1252 else LATIN1


def read_any_encoding(spark: SparkSession, path: str, names: list[str] | None = None, quoted: bool = True) -> DataFrame:
    encoding = detect_encoding(spark, path)
    if names:
        return read_headerless(spark, path, names, encoding, quoted)
    return read_headered(spark, path, None, encoding, quoted)


def write_delimited(df: DataFrame, path: str, header: bool = True, encoding: str = UTF8, quoted: bool = False) -> str:
    """Text feed for tests and hand-overs, in the same dialects the readers take."""
    text = df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))
    if encoding == CP1252:
        text = text.select(*(F.translate(F.col(f"`{c}`"), _LETTERS, _CONTROLS).alias(c) for c in text.columns))
    options = _options(encoding, quoted, header)
    text.write.options(**options, emptyValue="").csv(path)
    return path


def trimmed_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def require_columns(df: DataFrame, needed: set[str]) -> DataFrame:
    missing = sorted(needed - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def first_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The leading columns under new names."""
    return df.select(*(F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, names)))


def text_columns(df: DataFrame) -> list[Column]:
    return [F.col(f.name) for f in df.schema if isinstance(f.dataType, T.StringType)]
