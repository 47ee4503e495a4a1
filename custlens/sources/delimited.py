"""Delimited text files: typed and raw reads, per-file profiles, writing."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.functions.columns import require_columns
from custlens.operators import quality
from custlens.session import stage
from custlens.sources import headers

# Separators that are considered, in the order that decides ties.
SEPARATORS = {"comma": ",", "semicolon": ";", "tab": "\t"}

_BREAKS = {"UTF-16LE": "\n\0", "UTF-16BE": "\0\n"}  # bytes of a line break
_CORRUPT = "_corrupt_record"
_END = "\u0001end\u0001"
_NO_SEPARATOR = "\u0001"  # does not occur in text files: a line is one field


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    sep: str = ";",
    date_format: str = "d/M/yyyy",
    encoding: str = "UTF-8",
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Typed read with a given schema; values that do not fit become NULL.

    The header is checked against the schema, so a file with other or reordered columns fails
    instead of filling the wrong columns. Line breaks inside quotes need ``multi_line``; such files are split all the same
    (see ``quoted_records``).
    """
    if multi_line:
        records = _decoded(quoted_records(spark, path, encoding), F.lit(encoding))
        options = {"sep": sep, "escape": '"', "dateFormat": date_format, "mode": "PERMISSIVE"}
        parsed = _without_headers(records, schema.names, sep) if header else records
        return parsed.filter(F.trim("value") != "").select(F.from_csv("value", _ddl(schema), options).alias("r")).select("r.*")
    reader = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("dateFormat", date_format)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
    )
    return reader.csv(path)


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    sep: str = ";",
    encoding: str = "UTF-8",
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Every column as text, plus ``malformed_line``: the text of a line with too many fields, else NULL.

    Without ``columns`` the names come from the header, which all files must share; with them a header that differs is an
    error. Short lines are padded with NULL. Split the result with :func:`good_lines` and :func:`bad_lines`. Line
    breaks inside quotes need ``multi_line``; such files are split all the same (see ``quoted_records``).
    """
    if columns is None:
        if not header:
            raise ValueError("files without a header need column names")
        found = [r.header for r in file_headers(spark, path, encoding).select("header").distinct().limit(2).collect()]
        if len(found) != 1:
            raise ValueError(f"the files have no common header: {found}")
        columns = header_fields(found[0], sep)
    if multi_line:
        records = _decoded(quoted_records(spark, path, encoding), F.lit(encoding))
        records = _without_headers(records, columns, sep) if header else records
        split = _fields(records.filter(F.trim("value") != ""), {sep: sep}, len(columns), F.lit(sep))
        named = [F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(columns)]
        return split.select(*named, F.when(F.col("n_fields") > len(columns), F.col("value")).alias("malformed_line"))
    return _read_lines(spark, path, columns, sep, encoding, header)


def _read_lines(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str, encoding: str, header: bool) -> DataFrame:
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _CORRUPT]])
    lines = (
        spark.read.schema(text)
        .option("sep", sep)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("escape", '"')
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", False)  # the field count must be seen whatever is selected later
        .csv(path)
    )
    # A corrupt line has too few or too many fields. Read again with a marker behind its last field, the
    # marker shows up inside the known columns exactly when the line is short.
    again = F.from_csv(
        F.concat(F.col(_CORRUPT), F.lit(sep + _END)), F.lit(", ".join(f"f{i} string" for i in range(len(columns)))), {"sep": sep, "escape": '"'}
    )
    short = F.exists(F.array(*[again[f"f{i}"] for i in range(len(columns))]), lambda f: f.eqNullSafe(F.lit(_END)))
    too_long = F.col(_CORRUPT).isNotNull() & (F.col(columns[-1]).isNotNull() | ~short)
    return lines.withColumn("malformed_line", F.when(too_long, F.col(_CORRUPT))).drop(_CORRUPT)


# ---------------------------------------------------------------- records that contain line breaks


def _pieces(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """``file_path, block, line, first, value`` (bytes): what lies between line breaks, block by block of each file.

    ``block`` is the place of the split in the file, ``line`` ascends inside it, ``first`` is the start of a file.
    """
    raw = spark.read.option("lineSep", _BREAKS.get(encoding, "\n")).text(path)
    placed = raw.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").cast("binary").alias("value"),
    )
    in_block = Window.partitionBy("file_path", "block").orderBy("line")
    return placed.withColumn("first", (F.col("block") == 0) & (F.row_number().over(in_block) == 1))


def join_pieces(pieces: DataFrame, is_odd: Column, glue: str) -> DataFrame:
    """Neighbouring pieces of a file put together, so that every record has an even number of odd ones.

    A piece starts a record if the odd ones before it in the file are even in number. That number is a running sum inside the
    block plus one over the file's blocks, of which a few figures each are needed; so blocks are worked on side by side, a
    record may run over any number of them, and only the pieces of records with several pieces are shuffled to meet.
    """
    in_block = Window.partitionBy("file_path", "block").orderBy("line")
    earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("_odd", is_odd.cast("int")).withColumn("_before", F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2)
    start = F.struct("block", "line")
    blocks = placed.groupBy("file_path", "block").agg(
        F.sum("_odd").alias("odds"),
        F.max(F.when(F.col("_before") == 0, start)).alias("even_start"),
        F.max(F.when(F.col("_before") == 1, start)).alias("odd_start"),
    )
    along = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_open", F.coalesce(F.sum("odds").over(along), F.lit(0)) % 2)
    last = F.when(F.col("_open") == 0, F.col("even_start")).otherwise(F.col("odd_start"))
    blocks = blocks.withColumn("_last", last).withColumn("_carried", F.last("_last", ignorenulls=True).over(along))
    joined = placed.join(blocks.select("file_path", "block", "_open", "_carried"), ["file_path", "block"])
    starts = (F.col("_before") + F.col("_open")) % 2 == 0
    columns = ["file_path", "block", "line", "first", "value"]
    whole = joined.filter(starts & (F.col("_odd") == 0)).select(*columns)
    parts = joined.filter(~starts | (F.col("_odd") == 1))
    to_here = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    record = F.coalesce(F.last(F.when(starts, start), ignorenulls=True).over(to_here), F.col("_carried"))
    in_order = F.array_sort(F.collect_list(F.struct("block", "line", F.col("value").cast("string").alias("value"))))
    merged = parts.withColumn("_record", record).groupBy("file_path", "_record").agg(F.bool_or("first").alias("first"), in_order.alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), glue).cast("binary")
    return whole.unionAll(merged.select("file_path", F.col("_record.block"), F.col("_record.line"), "first", text.alias("value")))


def quoted_records(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """``file_path, block, line, first, value`` (bytes in the files' encoding): records with line breaks inside quotes.

    Files are split like any other text. A line break ends a record where the quotes before it are even in number, whatever
    block they lie in. UTF-16 files are cut at the bytes of a line break; where these are the halves of two neighbouring
    characters, the odd number of bytes shows it and the pieces are put together again. A quote that is never closed
    makes the rest of its file one record.
    """
    pieces = _pieces(spark, path, encoding)
    if encoding in _BREAKS:
        pieces = join_pieces(pieces, F.octet_length("value") % 2 == 1, _BREAKS[encoding])
        quotes = F.decode("value", encoding)
    else:
        quotes = F.decode("value", "ISO-8859-1")  # one character per byte, whatever the encoding
    joined = join_pieces(pieces, _occurrences(quotes, '"') % 2 == 1, _BREAKS.get(encoding, "\n"))
    return joined


def _decoded(records: DataFrame, encoding: Column) -> DataFrame:
    """Bytes to text by each record's encoding, without byte order mark and carriage return at the end."""
    text = F.col("value").cast("string")
    for name in ("ISO-8859-1", "UTF-16LE", "UTF-16BE"):
        text = F.when(encoding == name, F.decode("value", name)).otherwise(text)
    text = F.when(F.col("first"), F.ltrim(text, F.lit("\ufeff"))).otherwise(text)
    return records.withColumn("value", F.when(F.endswith(text, F.lit("\r")), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text))


def _without_headers(records: DataFrame, columns: Sequence[str], sep: str) -> DataFrame:
    """Records that are no header; a header with other names is an error."""
    found = F.from_csv("value", F.lit(", ".join(f"f{i} string" for i in range(len(columns) + 1))), {"sep": sep, "escape": '"'})
    names = F.array(*[found[f"f{i}"] for i in range(len(columns) + 1)])
    same = names.eqNullSafe(F.array(*[F.lit(c) for c in columns], F.lit(None).cast("string")))
    message = F.concat(F.lit("header does not match the columns: "), F.col("value"))
    return records.filter(F.when(F.col("first") & ~same, F.raise_error(message).cast("boolean")).otherwise(~F.col("first")))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _fields(records: DataFrame, separators: Mapping[str, str], width: int, separator: Column) -> DataFrame:
    """``records`` with ``fields`` (at most one more than ``width``) and ``n_fields``, each split by its own separator.

    A marker behind the last field tells how many there are; where it isn't found there are more than ``width`` + 1.
    """
    names = [f"_f{i}" for i in range(width + 2)]
    ddl = F.lit(", ".join(f"{n} string" for n in names))
    parsed = F.lit(None).cast(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    for sep in separators.values():
        fields = F.from_csv(F.concat("value", F.lit(sep + _END)), ddl, {"sep": sep, "escape": '"'})
        parsed = F.when(separator == sep, fields).otherwise(parsed)
    end = F.array_position("fields", _END)
    n_fields = F.when(end > 0, end - 1).otherwise(F.lit(width + 2))
    # A generator's columns are computed once a record, however many expressions and filters read them.
    split = records.select("*", F.inline(F.array(parsed))).withColumn("fields", F.array(*names)).drop(*names).withColumn("n_fields", n_fields)
    return split.withColumn("fields", F.slice("fields", F.lit(1), F.least(F.col("n_fields"), F.lit(width + 1)).cast("int")))


def file_headers(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """(file_path, header): the first line of every file, without a byte order mark."""
    lines = spark.read.schema("value string").option("sep", _NO_SEPARATOR).option("quote", "").option("encoding", encoding).csv(path)
    placed = lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")).alias("place"),
        F.ltrim(F.col("value"), F.lit("\ufeff")).alias("value"),
    )
    return placed.groupBy("file_path").agg(F.min_by("value", "place").alias("header"))


def header_fields(header: str, sep: str) -> list[str]:
    return next(csv.reader([header], delimiter=sep))


def load_files(
    spark: SparkSession,
    path: str | Sequence[str],
    expected: Sequence[str],
    dates: Sequence[str] = (),
    numbers: Sequence[str] = (),
    required: Sequence[str] = (),
    drop_missing: bool = False,
    aliases: Mapping[str, Sequence[str]] | None = None,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Files of any separator, encoding and header as one typed table, and the lines that were left out.

    Separator, encoding and header are found per file and written as a table of dialects; every line meets its file's row
    there, is decoded and split by it, and takes its columns from the places that the header gives them. So the plan does
    not grow with the number of files, and only the distinct headers reach the driver, where their names are mapped to
    the ``expected`` ones. (Paths of UTF-16 files come as well: they are cut into lines apart.) Dates and numbers are
    converted, and absent ``required`` columns are an error; with ``drop_missing`` rows that lack a required value go. Blank
    lines are skipped. The second result is ``file_path, malformed_line``.
    """
    files = stage(profile_files(spark, path, with_header=True), "dialects")
    found = [(r.header, r.separator) for r in files.select("header", "separator").distinct().orderBy("header", "separator").collect()]
    if not found:
        raise ValueError(f"no files in {path}")
    layouts, columns = [], {}
    for header, sep in found:
        names = headers.canonical_names(header_fields(header, sep), expected, aliases)
        columns.update(dict.fromkeys(names))
        layouts.append((header, sep, {name: i for i, name in enumerate(names)}, len(names)))
    width = max(n for *_, n in layouts)
    layout = spark.createDataFrame(layouts, "header string, separator string, places map<string,int>, width int")
    dialects = stage(files.join(F.broadcast(layout), ["header", "separator"]).select("file_path", "separator", "encoding", "places", "width"), "dialects")
    wide = [r.encoding for r in files.filter(F.col("encoding").isin(*_BREAKS)).select("encoding").distinct().collect()]
    records = _records(spark, path, "UTF-8", multi_line)
    placed = records.join(dialects.filter(~F.col("encoding").isin(*_BREAKS)), "file_path")
    for encoding in sorted(wide):
        paths = [r.file_path for r in files.filter(F.col("encoding") == encoding).select("file_path").collect()]
        placed = placed.unionByName(_records(spark, paths, encoding, multi_line).join(dialects.filter(F.col("encoding") == encoding), "file_path"))
    texts = _decoded(placed.filter("NOT first"), F.col("encoding")).filter(F.trim("value") != "")
    split = _fields(texts, SEPARATORS, width, F.col("separator"))
    is_long = F.col("n_fields") > F.col("width")
    table = split.filter(~is_long).select(*[F.get("fields", F.col("places")[c]).alias(c) for c in columns])
    require_columns(table, required, "loaded files")
    table = quality.coerce_numeric(quality.coerce_dates(table, dates, per_row=True), numbers)
    if drop_missing and required:
        table = quality.drop_incomplete(table, required)
    return table, split.filter(is_long).select("file_path", F.col("value").alias("malformed_line"))


def _records(spark: SparkSession, path: str | Sequence[str], encoding: str, multi_line: bool) -> DataFrame:
    if multi_line:
        return quoted_records(spark, path, encoding)
    pieces = _pieces(spark, path, encoding)
    return join_pieces(pieces, F.octet_length("value") % 2 == 1, _BREAKS[encoding]) if encoding in _BREAKS else pieces


def good_lines(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("malformed_line").isNull()).drop("malformed_line")


def bad_lines(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("malformed_line").isNotNull()).select("malformed_line")


def count_malformed(raw: DataFrame) -> DataFrame:
    """One row: good_lines, malformed_lines."""
    bad = F.col("malformed_line").isNotNull()
    return raw.agg(F.count_if(~bad).alias("good_lines"), F.count_if(bad).alias("malformed_lines"))


def _occurrences(text: Column, sep: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit("")))


def profile_files(spark: SparkSession, path: str | Sequence[str], with_header: bool = False) -> DataFrame:
    """Per file: file_path, separator, encoding, line_count, and the header line on request. One splittable scan for all files.

    A byte order mark decides the encoding (UTF-8, UTF-16LE, UTF-16BE). Without one a file whose lines are all valid UTF-8 is
    UTF-8, any other is taken as Latin-1. The separator is the most frequent candidate of the first line. Lines of
    UTF-16 files are counted by bytes of value 10.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("place"),
        "value",
        F.col("value").cast("binary").alias("bytes"),
    )
    per_file = lines.groupBy("file_path").agg(
        F.min_by("bytes", "place").alias("head"),
        F.bool_and(F.is_valid_utf8("value")).alias("all_utf8"),
        F.count_if(F.col("bytes") != F.lit(b"\0")).alias("line_count"),  # the second half of a last line break is no line
    )
    mark = F.hex(F.substring("head", 1, 3))
    encoding = (
        F.when(F.startswith(mark, F.lit("FFFE")), "UTF-16LE")
        .when(F.startswith(mark, F.lit("FEFF")), "UTF-16BE")
        .when((mark == "EFBBBF") | F.col("all_utf8"), "UTF-8")
        .otherwise("ISO-8859-1")
    )
    even = F.substring("head", F.lit(1), F.octet_length("head") - F.octet_length("head") % 2)
    known = per_file.withColumn("encoding", encoding).withColumn("first", F.lit(True))
    known = known.withColumn("value", F.when(F.col("encoding").isin(*_BREAKS), even).otherwise(F.col("head")))
    known = _decoded(known, F.col("encoding"))
    counts = {sep: _occurrences(F.col("value"), sep) for sep in SEPARATORS.values()}
    most = F.greatest(*counts.values())
    separator = F.coalesce(*[F.when(n == most, F.lit(sep)) for sep, n in counts.items()])
    columns = ["file_path", separator.alias("separator"), "encoding", "line_count"]
    return known.select(*columns, *([F.col("value").alias("header")] if with_header else []))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", month_of: str | None = None, sep: str = ",") -> str:
    """Write a cleaned table; with ``month_of`` partitioned by the month of that date column.

    Rows of a month are spread over tasks by AQE (rebalance), so a very large month is not one file.
    """
    if month_of:
        df = df.withColumn("order_month", F.date_format(month_of, "yyyy-MM")).hint("rebalance", "order_month")
    writer = df.write.mode("overwrite")
    if month_of:
        writer = writer.partitionBy("order_month")
    if fmt == "csv":
        writer = writer.option("header", True).option("sep", sep)
    writer.format(fmt).save(path)
    return path
