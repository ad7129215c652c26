"""Delimited files: CSV with rejects, CSV behind a preamble, backslash-escaped text format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.scalar import format_text_array, parse_text_array
from driftline.sources.rejects import with_reason

_CORRUPT = "_malformed"


def scan_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    *,
    header: bool = True,
    delimiter: str = ",",
    null: str = "",
    quote: str = '"',
) -> DataFrame:
    """Strict CSV scan of one path, a glob or many locations with a declared schema.

    Column pruning reaches the CSV parser; the first bad value fails the job.
    """
    return _csv_reader(spark, header, delimiter, null, quote).option("mode", "FAILFAST").schema(schema).csv(paths)


def _csv_reader(spark: SparkSession, header: bool, delimiter: str, null: str, quote: str, stream: bool = False):
    return (
        (spark.readStream if stream else spark.read)
        .option("header", header)
        .option("sep", delimiter)
        .option("nullValue", null)
        .option("quote", quote)
        .option("escape", quote or "\\")
    )


def _typed(raw: str, kind: T.DataType) -> Column:
    """SQL text of a raw field to a declared type; NULL when it does not parse whole and unrounded."""
    if isinstance(kind, T.StringType):
        return F.expr(raw)
    if isinstance(kind, T.ArrayType):
        return parse_text_array(F.expr(raw))
    if isinstance(kind, T.BinaryType):
        return F.try_to_binary(F.regexp_replace(F.expr(raw), r"^\\x", ""), F.lit("hex"))
    value = f"try_cast(trim({raw}) AS {kind.simpleString()})"
    if isinstance(kind, T.DateType):
        return F.expr(f"CASE WHEN trim({raw}) RLIKE '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$' THEN {value} END")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.expr(f"CASE WHEN trim({raw}) RLIKE '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}' THEN {value} END")
    if isinstance(kind, T.DecimalType):
        # A cast would round; a fraction that does not fit is a bad value.
        wide = f"try_cast(trim({raw}) AS decimal(38,{38 - kind.precision + kind.scale}))"
        return F.expr(f"CASE WHEN {wide} = {value} THEN {value} END")
    return F.expr(value)


def _cast_or_reject(
    rows: DataFrame, schema: T.StructType, keep: list[str], fields: list[str], malformed: str
) -> DataFrame:
    """Cast raw fields, given as SQL text in schema order, and say which one failed first.

    Expressions are written as SQL text because a wide table has hundreds of them
    and each text is one call into the planner.
    """
    typed = rows.select("*", *[_typed(raw, f.dataType).alias(f"_v{i}") for i, (raw, f) in enumerate(zip(fields, schema.fields))])
    checks = " ".join(
        f"WHEN {raw} IS NOT NULL AND _v{i} IS NULL THEN '{field.name}'"
        for i, (raw, field) in enumerate(zip(fields, schema.fields))
        if not isinstance(field.dataType, T.StringType)
    )
    reason = F.expr(f"CASE WHEN {malformed} THEN 'columns' {checks} END")
    return with_reason(typed, keep, [F.col(f"_v{i}").alias(name) for i, name in enumerate(schema.fieldNames())], reason)


def scan_csv_with_rejects(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    *,
    header: bool = True,
    delimiter: str = ",",
    null: str = "",
    quote: str = '"',
) -> DataFrame:
    """Tolerant CSV scan: typed columns, ``source_file`` and ``reject_reason``.

    Fields are read as text and cast afterwards, so the reason names the column
    and a wrong field count is told apart from a bad value.
    """
    return _marked(_raw_csv(_csv_reader(spark, header, delimiter, null, quote), schema).csv(paths), schema)


def stream_csv_with_rejects(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    files_per_batch: int = 1000,
    pattern: str | None = None,
    header: bool = True,
    delimiter: str = ",",
    null: str = "",
    quote: str = '"',
) -> DataFrame:
    """The same as a stream of new files."""
    reader = _csv_reader(spark, header, delimiter, null, quote, stream=True).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return _marked(_raw_csv(reader, schema).csv(folder), schema)


def _raw_csv(reader, schema: T.StructType):
    """All fields as text, lines of another field count in a column of their own."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    text.add(_CORRUPT, T.StringType())
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    return reader.option("columnPruning", False).schema(text)


def _marked(raw: DataFrame, schema: T.StructType) -> DataFrame:
    raw = raw.withColumn("source_file", F.col("_metadata.file_path"))
    names = [f"`{name}`" for name in schema.fieldNames()]
    return _cast_or_reject(raw, schema, ["source_file"], names, f"{_CORRUPT} IS NOT NULL")


def count_records(
    spark: SparkSession, paths: str | list[str], *, header: bool = True, multi_line: bool = False
) -> DataFrame:
    """Records per file, the header line excluded.

    ``multi_line`` honours line breaks inside quotes, at the price of one task per file.
    """
    raw = _csv_reader(spark, header, ",", "", '"').option("multiLine", multi_line).schema("value string").csv(paths)
    by_file = raw.groupBy(F.col("_metadata.file_path").alias("source_file"))
    return by_file.agg(F.count(F.lit(1)).alias("record_count"))


def count_quoted_records(spark: SparkSession, paths: str | list[str], *, header: bool = True) -> DataFrame:
    """Records per file like ``count_records(multi_line=True)``, with large files counted by many tasks.

    Whether a line ends a record depends on the quotes before it in its file. Each split counts its lines that end with an
    even and with an odd number of own quotes; the sum of quotes over earlier splits then says which of the two are ends.
    Only line numbers and parities are shuffled, and only one row a split is put in order per file. Quotes inside quotes are
    doubled; blank lines outside quotes are no records; a record left open at the end of its file counts.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        (quotes % 2).alias("odd"),
        (F.trim("value") != "").alias("filled"),
    )
    so_far = F.sum("odd").over(Window.partitionBy("source_file", "block").orderBy("line")) % 2
    splits = lines.withColumn("state", so_far).groupBy("source_file", "block").agg(
        F.count_if((F.col("state") == 0) & F.col("filled")).alias("even_ends"),
        F.count_if((F.col("state") == 1) & F.col("filled")).alias("odd_ends"),
        (F.sum("odd") % 2).alias("odd"),
    )
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1
    ends = splits.withColumn("ends", F.when(inside, F.col("odd_ends")).otherwise(F.col("even_ends")))
    records = F.sum("ends") + F.sum("odd") % 2 - F.lit(int(header))
    return ends.groupBy("source_file").agg(F.greatest(records, F.lit(0)).cast("long").alias("record_count"))


def drop_leading_lines(lines: DataFrame, count: int) -> DataFrame:
    """Text lines without the first ``count`` lines of every file.

    Row ids grow line by line inside a scan partition, so within the block at
    offset 0 the distance to the smallest id of the file is the line number.
    One id per file is found, and lines meet it by their scan partition too, so
    that a file larger than one split is not gathered in one task.
    """
    numbered = lines.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    ).withColumn("_part", F.shiftright("_line", 33))
    key = ["source_file", "_part"]
    heads = numbered.filter(F.col("_block") == 0).groupBy(*key).agg(F.min("_line").alias("_first"))
    in_preamble = (F.col("_block") == 0) & (F.col("_line") - F.col("_first") < count)
    return numbered.join(heads, key, "left").filter(~in_preamble).select("value", "source_file")


def scan_csv_after_preamble(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    *,
    skip_lines: int = 2,
    delimiter: str = ",",
    null: str = "",
    quote: str = '"',
) -> DataFrame:
    """CSV whose first lines are a title and a header, with a custom null marker."""
    lines = drop_leading_lines(spark.read.text(paths), skip_lines)
    return parse_csv_lines(lines, schema, delimiter=delimiter, null=null, quote=quote)


def parse_csv_lines(
    lines: DataFrame, schema: T.StructType, *, delimiter: str = ",", null: str = "", quote: str = '"'
) -> DataFrame:
    """CSV lines in ``value`` to typed columns; a bad line fails the job.

    The record is generated rather than projected, so a filter on a parsed
    column is not moved ahead of the removal of preamble lines.
    """
    options = {"sep": delimiter, "nullValue": null, "quote": quote, "escape": quote or "\\", "mode": "FAILFAST"}
    record = F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "), options)
    return lines.select(F.inline(F.array(record)))


# --- backslash-escaped text format ----------------------------------------------

# Stand-ins for an escaped backslash and an escaped delimiter while a line is
# split. The format does not allow the zero character in data.
_BACKSLASH, _DELIMITER = "\u0000b", "\u0000d"
# Letters of the control escapes and what they stand for, in the same order.
_CONTROL_LETTERS, _CONTROLS = "tnrbfv", "\t\n\r\b\f\v"
#: A line of this alone ends the data.
_END_MARK = "\\."
#: An octal or hexadecimal byte, any other escaped character, or text without escapes.
_TOKEN = r"(?s)\\(?:[0-7]{1,3}|x[0-9A-Fa-f]{1,2}|.)|[^\\]+"


def _token_bytes(token: Column) -> Column:
    """What a token of a field stands for, as hexadecimal text of its bytes; an unknown escape stands for its character."""
    octal = F.right(F.conv(F.substr(token, F.lit(2)), 8, 16), F.lit(2))
    return (
        F.when(~token.startswith("\\"), F.hex(token))
        .when(token.rlike(r"^\\[0-7]"), F.lpad(octal, 2, "0"))
        .when(token.rlike(r"^\\x[0-9A-Fa-f]"), F.lpad(F.substr(token, F.lit(3)), 2, "0"))
        .otherwise(F.hex(F.translate(F.substr(token, F.lit(2)), _CONTROL_LETTERS, _CONTROLS)))
    )


def _unescape(field: Column, delimiter: str) -> Column:
    """Resolve the escapes of one field, from left to right; a backslash at its end is dropped.

    Escaped bytes that follow each other may form one character. Bytes that form none stay as they are in the text.
    """
    field = F.replace(field, F.lit(_DELIMITER), F.lit("\\" + delimiter))
    field = F.replace(field, F.lit(_BACKSLASH), F.lit("\\\\"))
    tokens = F.transform(F.regexp_extract_all(field, F.lit(_TOKEN), F.lit(0)), _token_bytes)
    return F.when(field.contains("\\"), F.unhex(F.array_join(tokens, "")).cast("string")).otherwise(field)


def parse_text_format(
    lines: DataFrame, schema: T.StructType, *, delimiter: str = "|", null: str = "\\N", column: str = "value"
) -> DataFrame:
    """Lines of the unquoted text format to typed columns plus ``reject_reason``.

    Null markers and escapes are resolved only on lines that hold a backslash.
    A field is cut into tokens instead of being matched by one pattern, whose
    stack depth would grow with the text. Lines that are the end mark are no rows.
    """
    lines = lines.where(~F.col(column).eqNullSafe(_END_MARK))
    keep = [c for c in lines.columns if c != column]
    line = F.col(column)
    mark = f"[{delimiter}]"
    hidden = F.replace(line, F.lit("\\\\"), F.lit(_BACKSLASH))
    hidden = F.replace(hidden, F.lit("\\" + delimiter), F.lit(_DELIMITER))
    resolved = F.transform(F.split(hidden, mark, -1), lambda f: F.when(f != null, _unescape(f, delimiter)))
    split = F.when(line.contains("\\"), resolved).otherwise(F.split(line, mark, -1))
    fields = [f"get(_fields, {i})" for i in range(len(schema))]
    return _cast_or_reject(
        lines.select(*keep, split.alias("_fields")), schema, keep, fields, f"size(_fields) <> {len(schema)}"
    )


def read_text_format(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, *, delimiter: str = "|", null: str = "\\N"
) -> DataFrame:
    """Scan of text-format files whose column list is the schema."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("source_file"))
    return parse_text_format(lines, schema, delimiter=delimiter, null=null)


def format_text_lines(df: DataFrame, *, delimiter: str = "|", null: str = "\\N") -> DataFrame:
    """Rows to text-format lines, escaping backslash, delimiter and line breaks."""

    escapes = [("\\", "\\\\"), (delimiter, "\\" + delimiter), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]

    def cell(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(field.dataType, T.BinaryType):
            # The backslash of the hex prefix is itself escaped in this format.
            text = F.concat(F.lit("\\\\x"), F.lower(F.hex(col)))
        elif isinstance(field.dataType, (T.StringType, T.ArrayType)):
            text = format_text_array(col) if isinstance(field.dataType, T.ArrayType) else col
            special = text.rlike(f"[{delimiter}\\\\\n\r\t]")
            escaped = text
            for char, escape in escapes:
                escaped = F.replace(escaped, F.lit(char), F.lit(escape))
            text = F.when(special, escaped).otherwise(text)
        else:
            text = col.cast("string")
        return F.coalesce(text, F.lit(null))

    return df.select(F.concat_ws(delimiter, *[cell(f) for f in df.schema.fields]).alias("value"))
