"""Feed file readers (S-1 CSV, S-2 JSON) with the reference's error classes.

Everything is read as strings against an explicit schema (no inference);
types are enforced later by ``try_cast`` so a bad value rejects its row
instead of failing the batch. Each row gets ``_seq``, its place in the feed
(file, start of its block, position), which defines "first copy" for keep-first
de-duplication and doesn't depend on how Spark packs splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources import fs
from tillroll.sources.fixtures import SEQ
from tillroll.sources.spliced import ListElements, QuotedLines, file_ends, pieces, splice

# Fixed values that must equal pandas' default missing-value tokens.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
CORRUPT = "_corrupt_record"


class FeedNotFoundError(FileNotFoundError):
    """The feed file does not exist."""


class FeedLoadError(RuntimeError):
    """The feed exists but cannot be read as records."""


CsvFileNotFoundError = FeedNotFoundError
CsvLoadError = FeedLoadError
JsonFileNotFoundError = FeedNotFoundError
JsonLoadError = FeedLoadError


#: one type for every feed file, so positions of different readers compare
SEQ_TYPE = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("pos", T.LongType())])


def with_seq(df: DataFrame) -> DataFrame:
    # rows of one block keep their order in monotonically_increasing_id
    m = F.col("_metadata")
    return df.withColumn(SEQ, F.struct(
        m["file_path"].alias("file"), m["file_block_start"].cast("long").alias("block"), F.monotonically_increasing_id().alias("pos")))


def _na_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)) for c in columns})


def _check_required(columns: Sequence[str], required: Sequence[str] | None, path: str) -> None:
    if required:
        missing = sorted(set(required) - set(columns))
        if missing:
            raise FeedLoadError(f"{path} is missing required columns: {missing}")


def _quotes(line: str) -> F.Column:
    return F.length(line) - F.length(F.replace(F.col(line), F.lit('"'), F.lit("")))


def has_quoted_newlines(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """Whether a quoted field holds a line end: some line has an odd number of
    quotes. One scan of the text, which stops at the first such line."""
    return not spark.read.text(path).where(_quotes("value") % 2 == 1).isEmpty()


def csv_columns(header: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(CORRUPT, T.StringType())])


def keep_short_rows(df: DataFrame, n_columns: int) -> DataFrame:
    """A row with fewer fields than the header is valid and has nulls at the end;
    one with more fields, or with an open quote, stays marked as malformed."""
    bare = F.regexp_replace(F.col(CORRUPT), '"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    short = (fields <= n_columns) & (_quotes(CORRUPT) % 2 == 0)
    return df.withColumn(CORRUPT, F.when(~short, F.col(CORRUPT)))


def _ddl(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)


def _spliced_csv(spark: SparkSession, path: str | Sequence[str], header: Sequence[str]) -> DataFrame:
    """CSV whose quoted fields hold line ends, read in splits all the same."""
    records = splice(pieces(spark, path, QuotedLines.separator), QuotedLines)
    text = F.regexp_replace(F.regexp_replace("value", "\r$", ""), "^\ufeff", "")
    is_header = (F.col("block") == 0) & (F.col("pos") == 0)
    parse = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'}
    names = F.from_csv(text, _ddl([f"c{i}" for i in range(len(header))]), {"escape": '"'})
    # files of one feed must agree on the header
    agrees = F.concat_ws("\n", *[names[f"c{i}"] for i in range(len(header))]) == F.lit("\n".join(header))
    other = records.where(is_header & ~agrees).select(text.alias("h")).limit(1).collect()
    if other:
        raise FeedLoadError(f"{path}: a file's header is {other[0].h!r}, not {','.join(header)!r}")
    row = F.from_csv(text, _ddl([*header, CORRUPT]), parse)
    seq = F.struct("file", "block", "pos").alias(SEQ)
    return records.where(~is_header & (F.length(text) > 0)).select(row.alias("_r"), seq).select(
        *[F.col(f"_r.`{c}`").alias(c) for c in [*header, CORRUPT]], SEQ)


def load_csv(
    spark: SparkSession, path: str | Sequence[str], required_columns: Sequence[str] | None = None, multi_line: bool | None = None,
) -> DataFrame:
    """CSV with a header row -> all-string DataFrame (+ ``_seq``); ``path`` is a file, a
    folder or a list of files.

    Quotes inside quoted fields are doubled. ``multi_line`` says whether quoted
    fields may hold line ends; None finds out (one more scan of the text). Such files
    are split as well: see ``spliced``.

    Malformed rows are kept with ``_corrupt_record`` set, so validation rejects
    them row by row instead of failing the whole feed; rows shorter than the header
    get nulls.
    """
    paths = [path] if isinstance(path, str) else list(path)
    for p in paths:
        if not fs.exists(spark, p):
            raise FeedNotFoundError(f"CSV file not found: {p}")
    if sum(fs.size(spark, p) for p in paths) == 0:
        raise FeedLoadError(f"CSV file is empty: {path}")
    if multi_line is None:
        multi_line = has_quoted_newlines(spark, paths)
    reader = spark.read.option("header", True).option("escape", '"')
    header = reader.option("inferSchema", False).csv(paths).columns
    if not header:
        raise FeedLoadError(f"CSV file is empty: {path}")
    _check_required(header, required_columns, str(path))
    if multi_line:
        df = _spliced_csv(spark, paths, header)
    else:
        df = with_seq(
            reader.schema(csv_columns(header))
            .option("enforceSchema", False)  # files of one feed must agree on the header
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(paths))
    return keep_short_rows(_na_to_null(df, header), len(header))


def json_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of a DataFrame with one line of JSON in ``value``: the columns of
    ``schema`` and ``_corrupt_record``, the line's text where it is no object; other
    columns stay. Blank lines are left out. A line that is a JSON list gives a record
    for each of its objects."""
    others = [c for c in lines.columns if c != "value"]
    text = F.trim(F.regexp_replace("value", "^\ufeff", ""))
    one = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name != CORRUPT), T.StructField(CORRUPT, T.StringType())])
    keep = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    is_list = text.startswith("[")
    listed = F.from_json(text, T.ArrayType(one), keep)
    broken = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in one.fields[:-1]], F.col("value").alias(CORRUPT))
    plain = F.when(text.startswith("{"), F.from_json(F.when(text.startswith("{"), text), one, keep)).otherwise(broken)
    records = F.when(is_list & listed.isNotNull() & ~F.exists(listed, lambda r: r.isNull() | r[CORRUPT].isNotNull()), listed).otherwise(F.array(plain))
    out = lines.where(F.length(text) > 0).select("value", *others, F.posexplode(records).alias("_at", "_r"))
    line = F.when(F.col(f"_r.{CORRUPT}").isNotNull(), F.col("value")).alias(CORRUPT)
    return out.select(*[F.col(f"_r.{f.name}").alias(f.name) for f in one.fields[:-1]], line, *others, "_at")


def _spliced_list(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The elements of a JSON list, whose file is read in splits."""
    parts = pieces(spark, path, ListElements.separator)
    for file, (open_, depth) in file_ends(parts, ListElements).items():
        # behind the list's end stands no brace: the last piece counts one too many
        if open_ or depth != -1:
            raise FeedLoadError(f"Could not parse JSON file {file}")
    records = splice(parts, ListElements)
    element = F.regexp_replace(F.concat("value", F.lit(ListElements.separator)), "^[\\s,\ufeff]*(\\[\\s*(?=[{}\\]]))?", "")
    lines = records.select(element.alias("value"), F.struct("file", "block", "pos").alias(SEQ))
    # the last piece: the list's end and nothing else
    return json_lines(lines.where(~F.col("value").rlike("^\\s*\\]\\s*\\}$")), schema).drop("_at")


def load_json(
    spark: SparkSession,
    path: str,
    required_columns: Sequence[str] | None = None,
    lines: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A JSON list of records, or an object whose ``data`` is that list.

    A list with a ``schema`` is read in splits (see ``spliced``); an element that is no
    object is kept with its text in ``_corrupt_record``. An object, and a list without a
    schema, is one task's work. ``lines=True`` reads JSON Lines instead. A line that can't be parsed is kept
    with its text in ``_corrupt_record`` and its own place in the feed, so each becomes
    a reject of its own. Values are read as strings when ``schema`` is given.
    """
    if not fs.exists(spark, path):
        raise FeedNotFoundError(f"JSON file not found: {path}")
    if lines:
        if schema is None:
            schema = spark.read.option("mode", "PERMISSIVE").json(path).schema
            if schema.names == [CORRUPT]:
                raise FeedLoadError(f"Could not parse JSON file {path}")
        _check_required(schema.names, required_columns, path)
        return json_lines(with_seq(spark.read.text(path)), schema).drop("_at")
    first = fs.first_non_blank(spark, path)
    if first not in (b"[", b"{"):
        raise FeedLoadError(f"Could not parse JSON file {path}")
    if first == b"[" and schema is not None:
        _check_required(schema.names, required_columns, path)
        return _spliced_list(spark, path, schema)
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    if first == b"{":
        env_schema = T.StructType([T.StructField("data", T.ArrayType(schema))]) if schema is not None else None
        raw = reader.schema(env_schema).json(path) if env_schema is not None else reader.json(path)
        if CORRUPT in raw.columns and len(raw.columns) == 1:
            raise FeedLoadError(f"Could not parse JSON file {path}")
        if "data" not in raw.columns or not isinstance(raw.schema["data"].dataType, T.ArrayType):
            raise FeedLoadError(f"JSON file {path} must be a list of records or an object with a 'data' key")
        if not isinstance(raw.schema["data"].dataType.elementType, T.StructType):
            raise FeedLoadError(f"JSON file {path} contains no records")
        df = raw.select(F.inline("data"))
        seq_src = raw
    else:
        df = reader.schema(schema).json(path) if schema is not None else reader.json(path)
        if CORRUPT in df.columns and len(df.columns) == 1:
            raise FeedLoadError(f"Could not parse JSON file {path}")
        seq_src = df
    if not df.columns:
        raise FeedLoadError(f"JSON file {path} contains no records")
    _check_required(df.columns, required_columns, path)
    if seq_src is df:
        return with_seq(df)
    # envelope: the records of one file come from one row; keep array order
    exploded = seq_src.select(F.col("_metadata.file_path").alias("_f"), F.posexplode("data").alias("_p", "_r"))
    place = F.struct(F.col("_f").alias("file"), F.lit(0).cast("long").alias("block"), F.col("_p").cast("long").alias("pos"))
    return exploded.select(*[F.col(f"_r.{c}").alias(c) for c in df.columns], place.alias(SEQ))
