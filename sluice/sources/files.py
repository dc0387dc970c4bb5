"""File and connector sources (S1–S13).  Always an explicit schema; formats
that Spark ships (JSON, XML, CSV, Parquet, JDBC, Kafka) go through
``spark.read.format(...)`` so pushdown and splitting stay Spark's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.sources.quoted_csv import read_quoted_text
from sluice.sources.xml_records import xml_record_texts


# S1 / S13 — JSON documents
def read_json_documents(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """One JSON object per file (``multiLine``) or per line; missing keys -> NULL."""
    return spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path)


# S2 — XML records
def read_xml_records(
    spark: SparkSession, path: str, row_tag: str, schema: StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """Records are the outermost ``row_tag`` elements at any depth; attributes become
    ``_name`` fields, text next to attributes ``_VALUE``.  ``FAILFAST`` matches a reader
    that raises on malformed input.  Spark's reader takes a file as one task, so that
    files are cut into records by ranges (``xml_records``) and Spark parses these."""
    parsed = F.from_xml("text", schema, {"mode": mode})
    return xml_record_texts(spark, path, row_tag, any_depth=True).select(parsed.alias("r")).select("r.*")


# S3 / S4 — CSV
# Texts that the pandas reader takes as missing by default.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    mode: str = "FAILFAST",
    encoding: str = "UTF-8",
    missing: Sequence[str] = MISSING_TOKENS,
    quoted_breaks: bool = False,
) -> DataFrame:
    """CSV with a header, columns bound by NAME and then typed as ``schema``.

    The header of the first file gives the columns' order (one line is read); the
    scan itself is all text and each further file's header must agree
    (``enforceSchema=false``).  Columns that ``schema`` does not name are never
    parsed beyond splitting; a column that the file lacks is an error.  Texts in
    ``missing`` become NULL before typing, whatever their column; any other text
    that is not of its type raises.  A quote inside a quoted field is doubled.

    ``quoted_breaks``: quoted fields may hold line breaks (UTF-8 only).  Files are
    then split all the same, at the price of a second scan (``quoted_csv``).
    """
    opts = {"header": "true", "mode": mode, "encoding": encoding, "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}
    opts["nullValue"] = missing[0] if missing else ""
    names = spark.read.options(**opts).csv(path).columns
    absent = [f.name for f in schema.fields if f.name not in names]
    if absent:
        raise ValueError(f"CSV at {path} lacks the columns {absent}")
    text = StructType([StructField(n, StringType()) for n in names])
    if quoted_breaks:
        raw = read_quoted_text(spark, path, names, opts)
    else:
        raw = spark.read.schema(text).options(**opts).option("enforceSchema", "false").csv(path)

    def typed(f: StructField) -> Column:
        value = F.col(f"`{f.name}`")
        value = F.when(~value.isin(*missing), value) if missing else value
        return (value if isinstance(f.dataType, StringType) else F.trim(value).cast(f.dataType)).alias(f.name)

    return raw.select(*[typed(f) for f in schema.fields])


# S5 / S7 / S11 — collection / table scans
def read_table(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Generic pass-through: parquet/json/orc paths, or ``jdbc`` with
    ``partitionColumn/lowerBound/upperBound/numPartitions`` for parallel reads."""
    r = spark.read.format(fmt).options(**(options or {}))
    if schema is not None and fmt != "jdbc":
        r = r.schema(schema)
    return r.load(path) if path is not None else r.load()


def drop_technical_id(df: DataFrame, column: str = "_id") -> DataFrame:
    """Drop the store's technical id if present (no-op otherwise)."""
    return df.drop(column) if column in df.columns else df


def with_read_order(scan: DataFrame, name: str = "_position") -> DataFrame:
    """A plain file scan with every row's place in read order as one number: files by
    name, then rows in the file.  Names of files come to the driver, rows do not.

    Parquet tells a row's index.  Other formats tell where the row's range of the file
    starts, and a row takes at least a byte of it, so start plus count within the range
    rises through the file."""
    spark = scan.sparkSession
    path = F.col("_metadata.file_path")
    files = sorted(r.f for r in scan.select(path.alias("f")).distinct().collect())
    number = spark.createDataFrame(list(zip(files, range(len(files)))), "_file string, _number long")
    try:
        index = F.col("_metadata.row_index")
        scan.select(index)
    except AnalysisException:
        index = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = scan.select("*", path.alias("_file"), index.alias("_index"))
    placed = rows.join(number, "_file")
    return placed.withColumn(name, F.shiftleft("_number", 44) + F.col("_index")).drop("_file", "_index", "_number")


# S6 — high-water mark
def high_water_mark(target: DataFrame, column: str = "date", alias: str = "mark") -> DataFrame:
    """``SELECT max(column)`` as a 1-row frame (NULL for an empty table)."""
    return target.agg(F.max(column).alias(alias))


# S8 / S9 — message bus
def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    security: dict[str, str] | None = None,
    for_write: bool = False,
) -> dict[str, str]:
    """Options for ``format("kafka")``.  SASL/SSL settings are passed in by
    the caller (from its secret store), never written in code."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers}
    if for_write:
        opts["topic"] = topic
    else:
        opts["subscribe"] = topic
        opts["startingOffsets"] = starting_offsets
    for k, v in (security or {}).items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = v
    return opts


def read_messages(
    spark: SparkSession, options: dict[str, str], fmt: str = "kafka", path: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """Batch read of a topic -> envelope (``key, value, topic, partition, offset,
    timestamp, ...``); with ``path`` and ``schema``, of envelopes kept in files."""
    r = spark.read.format(fmt).options(**options)
    return (r.schema(schema) if schema is not None else r).load(*([path] if path else []))


def read_message_stream(
    spark: SparkSession, options: dict[str, str], fmt: str = "kafka", path: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """Unbounded read of a topic or a folder; same envelope as ``read_messages``."""
    r = spark.readStream.format(fmt).options(**options)
    return (r.schema(schema) if schema is not None else r).load(*([path] if path else []))
