"""Load modes (K1–K11): append, replace, keyed upsert, insert-if-absent,
strict insert, mart rebuild, CSV / snapshot copies.

The pure functions (``upsert``, ``insert_if_absent``, ``strict_insert``)
return the new table as a lazy DataFrame; the ``*_path`` writers apply them to
files.  Key rules (no NULL key, no key twice) are part of the plan that
produces the rows, so a write can never see other data than its check.  Writers
never overwrite a path with a plan that still reads it: the new rows are first
written below the shared ``spark.checkpoint.dir`` (lineage cut, survives
executor loss) and that copy is removed afterwards.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from sluice.operators.dedupe import dedupe_first
from sluice.session import scratch_path


ROWS_PER_FILE = 250_000  # of compressed files


# ---------------------------------------------------------------- pure forms
def keyed_once(batch: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``batch`` with its key rules enforced inside the plan: the job fails on a key
    that is NULL or comes twice.  One partial aggregation on the keys."""
    keys = list(keys)
    rest = [c for c in batch.columns if c not in keys]
    grouped = batch.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*(rest or [F.lit(1).alias("_one")]))).alias("_row")
    )
    return _checked(grouped, keys, F.col("_n") == 1, what).select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in batch.columns]
    )


def _checked(df: DataFrame, keys: Sequence[str], ok: Column, what: str) -> DataFrame:
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return df.where(F.assert_true(ok, F.lit(f"{what}: duplicate primary key or NULL key")).isNull())


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET <all non-key columns>``:
    rows of ``batch`` replace target rows with the same key, others are added.
    A key that the batch holds twice is an error, as in PostgreSQL.

    Both sides shuffle once on ``keys`` (anti join), the union needs no shuffle.
    """
    keys = list(keys)
    new = keyed_once(batch.select(*target.columns), keys, "upsert")
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new)


def insert_if_absent(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING`` for a whole batch.

    The batch is first reduced to one row per key (first by ``order_by``);
    existing target rows always win, even if the source changed.  A NULL key is
    an error, as in a primary key column.
    """
    return target.unionByName(new_rows_if_absent(target, batch, keys, order_by).select(*target.columns))


def new_rows_if_absent(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Batch rows (one per key) whose key the target does not hold.  ``unique``: the
    batch is known to hold every key once, so that it is not reduced again.

    The target is first semi-joined with the batch keys: for the usual small
    batch into a large table the optimizer/AQE broadcasts the batch keys
    (size-checked) and the target is scanned once without a shuffle; only the
    few matching keys meet the batch in the anti join.
    """
    keys = list(keys)
    if not unique:
        batch = dedupe_first(batch, keys, order_by) if order_by is not None else batch.dropDuplicates(keys)
    batch = _checked(batch, keys, F.lit(True), "insert")
    return batch.join(existing_keys(target, batch, keys), keys, "left_anti")


def existing_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``batch`` already present in ``target``."""
    keys = list(keys)
    return target.select(*keys).join(batch.select(*keys), keys, "left_semi").distinct()


def strict_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plain ``INSERT`` into a keyed table: a key already in the target, twice in the
    batch or NULL is an error (not an upsert)."""
    return target.unionByName(strict_new_rows(target, batch, keys))


def strict_new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch, checked inside its plan: the job fails on a key that repeats, is NULL
    or is held by the target.  The target's keys are semi-joined with the batch's, so
    that a small batch (broadcast by its measured size) moves none of them."""
    keys = list(keys)
    new = keyed_once(batch.select(*target.columns), keys, "strict_insert")
    held = existing_keys(target, batch, keys).withColumn("_held", F.lit(True))
    return _checked(new.join(held, keys, "left"), keys, F.col("_held").isNull(), "strict_insert").select(*target.columns)


# ---------------------------------------------------------------- file forms
def counted(df: DataFrame, name: str = "rows"):
    """Attach a row counter to ``df``; the count is filled in by whatever
    action runs next (e.g. the write), so no second scan is needed.  Returns
    the observed frame and a function that reads the count after the action."""
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    return observed, lambda: int(obs.get["n"])



def file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = file_system(spark, path)
    return bool(fs.exists(jpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder or an emptied partition through Hadoop's file system."""
    fs, jpath = file_system(spark, path)
    fs.delete(jpath, True)


@contextmanager
def written_once(spark: SparkSession, df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written below the shared scratch folder and read back; removed at the end."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """C4 create-if-missing: the table at ``path`` or an empty frame with ``schema``."""
    if path_exists(spark, path):
        return spark.read.schema(schema).format(fmt).load(path)
    return spark.createDataFrame([], schema)


def append_load(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """K1: append (not idempotent — a rerun adds the rows again)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def replace_load(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table.  ``df`` must not read ``path``."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.save(path)


def upsert_to_path(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    schema: StructType,
) -> int:
    """K3 on files: rewrite only the partitions the batch touches.

    Touched are the partitions of the batch and those where its keys live now (a
    key may move).  Of these partitions the old rows whose key is not in the batch
    are kept and the batch rows added; the scan of the target is pruned by the
    least and largest touched partition (scalar subqueries in the partition
    filter), a semi join keeps it exact.  A partition that only lost rows is
    removed.  A batch key that repeats or is NULL fails the job before anything is
    written.  Returns the number of rows written.
    """
    keys, partition_by = list(keys), list(partition_by)
    target = read_or_empty(spark, path, schema)
    with written_once(spark, keyed_once(batch.select(*target.columns), keys, "upsert"), "upsert-batch") as new:
        homes = target.select(*keys, *[c for c in partition_by if c not in keys]).join(new.select(*keys), keys, "left_semi")
        touched = homes.select(*partition_by).unionByName(new.select(*partition_by)).distinct()
        with written_once(spark, touched, "upsert-touched") as touched:
            old = target
            for c in partition_by:
                lo, hi = touched.select(F.min(c)).scalar(), touched.select(F.max(c)).scalar()
                null_too = touched.select(F.max(F.col(c).isNull())).scalar()
                old = old.where((F.col(c) >= lo) & (F.col(c) <= hi) | F.col(c).isNull() & null_too)
            old = _same_partitions(old, touched, partition_by, "left_semi")
            merged = old.join(new.select(*keys), keys, "left_anti").unionByName(new)
            with written_once(spark, merged, "upsert-merged") as merged:
                # partitions that only lost rows: at most one folder per touched partition
                gone = _same_partitions(touched, merged.select(*partition_by).distinct(), partition_by, "left_anti")
                emptied = _partition_folders(spark, path, gone, schema)
                out, rows = counted(merged)
                (
                    out.write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy(*partition_by)
                    .format("parquet")
                    .save(path)
                )
                for folder in emptied:
                    remove_path(spark, folder)
                return rows()


def _same_partitions(rows: DataFrame, partitions: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on the partition columns; a NULL partition is one like any other."""
    other = partitions.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(by)])
    return rows.join(other, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(by)]), how)


def _partition_folders(spark: SparkSession, path: str, partitions: DataFrame, schema: StructType) -> list[str]:
    """Folders of the table at ``path`` that hold the given partitions."""
    if partitions.isEmpty() or not path_exists(spark, path):
        return []
    files = spark.read.schema(schema).parquet(path).select(*partitions.columns, F.col("_metadata.file_path").alias("_file"))
    found = _same_partitions(files, partitions, partitions.columns, "left_semi")
    folders = found.select(F.regexp_replace("_file", "/[^/]+$", "").alias("f")).distinct().collect()
    # the path is a URI: one level of percent encoding belongs to it
    return [unquote(r.f) for r in folders]


def insert_if_absent_to_path(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    schema: StructType,
    order_by: Sequence[str] | None = None,
    unique: bool = False,
) -> int:
    """K4 on files: append only rows whose key the table does not hold yet."""
    target = read_or_empty(spark, path, schema)
    new_rows = new_rows_if_absent(target, batch.select(*target.columns), keys, order_by, unique)
    with written_once(spark, new_rows, "insert-rows") as new_rows:
        new_rows, rows = counted(new_rows)
        new_rows.write.mode("append").format("parquet").save(path)
        return rows()


def strict_insert_to_path(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], schema: StructType) -> int:
    """K9 on files: fail (write nothing) if any key exists, repeats or is NULL.  The
    check is in the plan of the rows that are written."""
    target = read_or_empty(spark, path, schema)
    with written_once(spark, strict_new_rows(target, batch.select(*target.columns), keys), "strict-rows") as new_rows:
        out, rows = counted(new_rows)
        out.write.mode("append").format("parquet").save(path)
        return rows()


# CSV texts as they are: blanks kept, quotes doubled, NULL apart from ''.
CSV_FIDELITY = {
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = None) -> None:
    """Overwrite a CSV folder with header.  Array/struct columns are not
    representable in CSV — write those tables as Parquet."""
    w = df.write.mode("overwrite").options(**CSV_FIDELITY).option("header", str(header).lower())
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_json_documents(df: DataFrame, path: str, key: str) -> None:
    """Overwrites a folder with JSON documents ``{"<key>": [record, ...]}``, one a
    partition; NULL fields are left out.  ``read_json_records`` reads them by ranges."""

    def run(batches):
        before = "{" + json.dumps(key) + ": ["
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # texts may be long: few of them at a time
                texts = batch.column("value").slice(at, 256).to_pylist()
                lines = [sep + text for sep, text in zip([before, *[","] * (len(texts) - 1)], texts)]
                before = ","
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        end = "]}" if before == "," else before + "]}"
        yield pa.RecordBatch.from_arrays([pa.array([end])], names=["value"])

    df.select(F.to_json(F.struct("*")).alias("value")).mapInArrow(run, "value string").write.mode("overwrite").text(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Writes rows as JSON objects, one a line, in compressed files that follow one another
    in the rows' order.  A compressed file is read by one task, so that it holds at most
    ``ROWS_PER_FILE`` rows however many its partition has."""
    df.write.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE).json(path)


def snapshot_copy(df: DataFrame, path: str) -> None:
    """Full snapshot to uncompressed CSV with header (no CDC).

    Line breaks inside texts are written as ``\\n`` and ``\\r`` (a backslash as two), so
    that every row is one line and files stay splittable; ``read_snapshot`` undoes it."""
    write_csv(_texts(df, _escaped), path, header=True, compression="none")


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of ``snapshot_copy``, equal to its source in count and values."""
    raw = (
        spark.read.schema(schema).options(**CSV_FIDELITY).option("header", "true").option("enforceSchema", "false")
        .option("mode", "FAILFAST").option("maxCharsPerColumn", "-1").csv(path)
    )
    return _texts(raw, _unescaped)


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(*[
        change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def _escaped(c: Column) -> Column:
    for plain, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def _unescaped(c: Column) -> Column:
    # a doubled backslash is kept apart (as the control character 1 and 2, itself
    # escaped) until the breaks are back
    steps = (("\u0001", "\u00011"), ("\\\\", "\u00012"), ("\\n", "\n"), ("\\r", "\r"), ("\u00012", "\\"), ("\u00011", "\u0001"))
    for code, plain in steps:
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def write_messages(df: DataFrame, options: dict[str, str], fmt: str = "kafka") -> None:
    """K7: write the ``value`` (and optional ``key``) column to a message bus.

    ``options`` carries ``kafka.bootstrap.servers``, ``topic`` and security
    settings; credentials come from the caller's config, never from code.
    """
    cols = [c for c in ("key", "value", "headers", "topic") if c in df.columns]
    df.select(*cols).write.mode("append").format(fmt).options(**options).save()
