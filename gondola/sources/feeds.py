"""Delimited feed files of mixed encodings, separators and headers."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gondola.operators.schema import SOURCE_ORDER, clean_cells, normalize_headers, quoted, require_columns

SEPARATORS = (",", ";", "\t", "|")


#: Bytes at a file's start that its dialect is told from.
HEAD = 1 << 16


class Dialect(NamedTuple):
    """How a file is written: ``UTF-16LE``, ``UTF-16BE`` or single bytes, the separator, whether a
    record may span lines, and the names of its columns."""

    encoding: str
    separator: str
    multi_line: bool
    names: tuple[str, ...]


#: Read losslessly, a byte a character; each cell is then decoded by itself.
BYTES = "ISO-8859-1"


def files_of(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The files that paths, folders and patterns name."""
    result = []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        found = [files.getFileStatus(place)] if files.exists(place) else list(files.globStatus(place) or [])
        inside = [x for s in found for x in (files.listStatus(s.getPath()) if s.isDirectory() else [s])]
        names = [s.getPath().toString() for s in inside if s.isFile() and not s.getPath().getName().startswith((".", "_"))]
        if not names:
            raise FileNotFoundError(f"no feed file at {path}")
        result += sorted(names)
    return result


def read_head(spark: SparkSession, path: str, size: int = HEAD) -> bytes:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def dialect(head: bytes, style: str = "chain", whole: bool = False) -> Dialect:
    """The dialect of a file from its first bytes; ``whole`` if these are all.

    UTF-16 is told by its byte-order mark or by NUL bytes, whose places tell the order. The
    separator comes from the header line: for ``panel`` a tab if it has one, else a comma; for
    ``chain`` the commonest of ``SEPARATORS``; a tab in UTF-16. An odd number of quotes in a line
    means that a quoted cell holds a line break.
    """
    if head[:2] in (b"\xff\xfe", b"\xfe\xff") or b"\0" in head:
        marked = {b"\xff\xfe": "UTF-16LE", b"\xfe\xff": "UTF-16BE"}.get(head[:2])
        encoding = marked or ("UTF-16LE" if head[1::2].count(0) >= head[::2].count(0) else "UTF-16BE")
        text = head[: len(head) // 2 * 2].decode(encoding, "replace")
    else:
        encoding, text = BYTES, head.decode(BYTES)
    lines = text.split("\n")
    complete = lines if whole or len(lines) == 1 else lines[:-1]
    header = complete[0].removeprefix("\ufeff").removeprefix("\xef\xbb\xbf").rstrip("\r")
    if encoding != BYTES:
        separator = "\t"
    elif style == "panel":
        separator = "\t" if "\t" in header else ","
    else:
        separator = max(SEPARATORS, key=header.count)
    names = next(csv.reader([header], delimiter=separator), [])
    return Dialect(encoding, separator, any(line.count('"') % 2 for line in complete), tuple(_decoded(n, encoding) for n in names))


def _decoded(name: str, encoding: str) -> str:
    if encoding != BYTES:
        return name
    raw = name.encode(BYTES)
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode(BYTES).translate(str.maketrans(_C1, _C1_TEXT))


def detect_dialects(spark: SparkSession, paths: Sequence[str], style: str = "chain") -> dict[str, Dialect]:
    """Each file's dialect; only the first ``HEAD`` bytes of a file are read, and no job runs."""
    heads = {path: read_head(spark, path, HEAD) for path in files_of(spark, paths)}
    return {path: dialect(head, style, len(head) < HEAD) for path, head in heads.items()}


def _decoded_uri(uri: Column) -> Column:
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def read_feed(
    spark: SparkSession,
    paths: Sequence[str],
    style: str = "chain",
    required: Sequence[str] = (),
    multi_line: bool | None = None,
) -> DataFrame:
    """All files as one DataFrame of texts, plus ``SOURCE_ORDER``.

    ``chain``: headers lower-cased and stripped, cells stripped. ``panel``: accents off
    the headers, inner spaces collapsed, cells kept, a stray ``index`` column dropped.
    Files that agree in dialect and header are read together; a feed has few of those
    groups however many files it has. The files are read once, when the result is: their
    dialects come from their first bytes, and the encoding is decided cell by cell (UTF-8 where
    it is valid, else Windows-1252).

    Spark splits files unless records span lines. ``multi_line`` says whether they do; by default
    the first bytes tell, and a record that spans lines further on stops the read with an error
    instead of being taken for two.
    """
    groups: dict[Dialect, list[str]] = {}
    for path, kind in detect_dialects(spark, paths, style).items():
        kind = kind if multi_line is None else kind._replace(multi_line=multi_line)
        groups.setdefault(kind, []).append(path)
    parts = [_read_group(spark, sorted(files), kind, style) for kind, files in sorted(groups.items())]
    if not parts:
        raise FileNotFoundError(f"no feed file among {list(paths)}")
    feed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    require_columns(feed, required, f"{style} feed")
    return feed


#: Holds a line whose number of cells is not the header's, while it is checked.
_ODD_LINE = "_odd_line"


def _read_group(spark: SparkSession, files: list[str], kind: Dialect, style: str) -> DataFrame:
    columns = [f"_{i}" for i in range(len(kind.names))]
    schema = StructType([StructField(c, StringType()) for c in [*columns, _ODD_LINE]])
    reader = (
        spark.read.schema(schema).option("columnNameOfCorruptRecord", _ODD_LINE).option("header", True)
        .option("sep", kind.separator).option("encoding", kind.encoding).option("escape", '"')
        .option("multiLine", kind.multi_line)
    )
    raw = reader.csv(files) if kind.multi_line else reader.option("lineSep", "\n").csv(files)
    if not kind.multi_line:
        quotes = F.length(_ODD_LINE) - F.length(F.replace(_ODD_LINE, F.lit('"'), F.lit("")))
        message = "a quoted cell spans lines; read the feed with multi_line=True: "
        broken = F.coalesce(quotes % 2 == 1, F.lit(False))
        raw = raw.filter(F.when(broken, F.raise_error(F.concat(F.lit(message), F.col(_ODD_LINE))).cast("boolean")).otherwise(True))
    cells = [F.col(c) for c in columns]
    if not kind.multi_line and cells:
        cells[-1] = F.regexp_replace(cells[-1], "\r$", "")
    if kind.encoding == BYTES:
        cells = [_cell(c) for c in cells]
    rows = raw.select(
        *[c.alias(n) for c, n in zip(cells, _distinct(kind.names))],
        _decoded_uri(F.col("_metadata.file_path")).alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
    )
    rows = normalize_headers(rows, "lower" if style == "chain" else "plain")
    if style == "chain":
        return clean_cells(rows)
    return rows.drop("index")


def _distinct(names: Sequence[str]) -> list[str]:
    """Names with their place behind those that are empty or come twice."""
    return [n if n and names.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names)]


def _cell(text: Column) -> Column:
    """A cell read a byte a character: as UTF-8 if its bytes are, else as Windows-1252."""
    utf8 = F.encode(text, BYTES).cast("string")
    return F.when(F.is_valid_utf8(utf8), utf8).otherwise(F.translate(text, _C1, _C1_TEXT))


def _c1_table() -> tuple[str, str]:
    """Characters ISO-8859-1 leaves as controls but Windows-1252 defines."""
    pairs = []
    for code in range(0x80, 0xA0):
        try:
            pairs.append((chr(code), bytes([code]).decode("cp1252")))
        except UnicodeDecodeError:
            continue
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_C1, _C1_TEXT = _c1_table()
