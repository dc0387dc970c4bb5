"""Tables of immutable files whose loads are all or nothing (K1-K5, K9, K11), with a key
index that tells which files an insert has to look at (K4, K9, C1, J2).

A table is a folder::

    data/<load>/       files of one load, never changed
    index/<load>/      Bloom bits of their keys (see ``_index_rows``)
    manifests/<load>/  the files that make up the table after that load
    versions/<n>       names the manifest of version n; made by a rename that fails
                       if the name is taken

A load writes its files, their index and a manifest, and becomes visible by the last
rename alone.  A job that dies earlier leaves folders that no version names; a reader
sees the version before.  Of two loads that started from one version the second to
arrive gets ``ConcurrentLoad``; nothing of it is visible, and it can be run again
(``attempts``).

Keys need not be partitioned.  A load reads the keys of those files only whose range of
keys and Bloom bits allow a key of the batch; an upsert rewrites only files that
hold one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sluice.operators.loads import file_system, keyed_once, new_rows_if_absent, path_exists, remove_path, written_once

BITS_PER_KEY = 16
BUCKET_BITS = 32768  # bits of one bitmap of Spark's bitmap functions
MOST_PAIRS = 50_000_000  # keys times files: beyond, a bulk load reads the keys of all files in range


class ConcurrentLoad(RuntimeError):
    """Another load has made the version that this one was about to make."""


class VersionedTable:
    """``keys`` are the table's primary key; rows have the columns of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        ranges = StructType([schema[k] for k in self.keys])
        self.manifest_schema = StructType(
            [
                StructField("file", StringType()),
                StructField("load", StringType()),
                StructField("rows", LongType()),
                StructField("classes", LongType()),
                StructField("least", ranges),
                StructField("most", ranges),
            ]
        )

    # ---- versions
    def versions(self) -> list[int]:
        folder = f"{self.path}/versions"
        if not path_exists(self.spark, folder):
            return []
        fs, jpath = file_system(self.spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(jpath)]
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int:
        """The newest version; 0 before the first load."""
        return max(self.versions(), default=0)

    def _load_of(self, version: int) -> str:
        fs, jpath = file_system(self.spark, f"{self.path}/versions/{version:020d}")
        stream = fs.open(jpath)
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> DataFrame:
        """One row per file: its place below the table, rows, and range of keys."""
        version = self.version() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], self.manifest_schema)
        return self.spark.read.schema(self.manifest_schema).parquet(f"{self.path}/manifests/{self._load_of(version)}")

    def _publish(self, version: int, load: str) -> None:
        """Names ``load`` version ``version``, unless another load has that name already."""
        target = f"{self.path}/versions/{version:020d}"
        fs, jtarget = file_system(self.spark, target)
        fs.mkdirs(jtarget.getParent())
        hidden = f"{self.path}/versions/.{uuid.uuid4().hex}"
        _, jhidden = file_system(self.spark, hidden)
        out = fs.create(jhidden)
        out.writeUTF(load)
        out.close()
        sc = self.spark.sparkContext
        gateway, hadoop = sc._gateway, sc._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(jtarget.toUri(), sc._jsc.hadoopConfiguration())
        rename = getattr(sc._jvm, "org.apache.hadoop.fs.Options$Rename")
        options = gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(context.makeQualified(jhidden), context.makeQualified(jtarget), options)
        except Exception as e:  # noqa: BLE001 — the JVM's own exception type
            fs.delete(jhidden, False)
            if fs.exists(jtarget):
                raise ConcurrentLoad(f"{self.path}: version {version} is taken") from e
            raise

    # ---- reading
    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (the newest by default)."""
        return self._files([r.file for r in self.manifest(version).select("file").collect()])

    def high_water_mark(self, column: str, version: int | None = None) -> DataFrame:
        """The largest value of a key column as one row (NULL for an empty table),
        from the manifest alone: no file of the table is opened."""
        return self.manifest(version).agg(F.max(F.col("most")[column]).alias("mark"))

    def _files(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in names])

    def candidates(self, batch: DataFrame, version: int) -> list[str]:
        """Files that may hold a key of ``batch``, by their ranges and Bloom bits.  Neither
        the table nor its keys are read; the names of files come to the driver, as they
        do for any read."""
        manifest = self.manifest(version)
        edges = batch.agg(*[f(k).alias(f"{f.__name__}_{i}") for i, k in enumerate(self.keys) for f in (F.min, F.max)])
        for i, k in enumerate(self.keys):
            low, high = edges.select(f"min_{i}").scalar(), edges.select(f"max_{i}").scalar()
            manifest = manifest.where((F.col("least")[k] <= high) & (F.col("most")[k] >= low))
        near = manifest.select("file", "load", "classes").collect()
        if not near or batch.count() * len(near) > MOST_PAIRS:
            return [r.file for r in near]
        loads, classes = sorted({r["load"] for r in near}), sorted({r["classes"] for r in near})
        index = self.spark.read.schema(_INDEX).parquet(*[f"{self.path}/index/{x}" for x in loads])
        # a key sits at one bit in every class of file size
        asked = (
            batch.select(F.explode(F.lit(classes)).alias("classes"), _hash(self.keys).alias("h"))
            .select("classes", *_place(F.col("h"), F.col("classes")))
            .distinct()
        )
        at = F.pmod(F.col("bit"), F.lit(8)).cast("int")
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hits = index.join(asked, ["classes", "bucket"]).where(F.getbit(byte, at) == 1)
        found = {r.file for r in hits.select("file").distinct().collect()}
        return [r.file for r in near if r.file in found]

    # ---- loads
    def append(self, batch: DataFrame) -> int:
        """K1: adds the rows; keys are not looked at.  Returns the new version."""
        return self._commit(self.version(), batch.select(*self.schema.names), lambda old: old)

    def replace(self, batch: DataFrame) -> int:
        """The rows become the table; ``batch`` may read the table itself."""
        return self._commit(self.version(), batch.select(*self.schema.names), lambda old: old.limit(0))

    def upsert(self, batch: DataFrame, attempts: int = 1) -> int:
        """K3: rows of ``batch`` replace those of the same key, others are added.  Only
        files that hold a key of the batch are rewritten.  A key that repeats or is NULL
        fails the load."""

        def load(version: int, new: DataFrame) -> int:
            held = self._holding(new, version)
            kept = self._files(held).join(new.select(*self.keys), self.keys, "left_anti")
            return self._commit(version, kept.unionByName(new), lambda old: old.where(~F.col("file").isin(*held)) if held else old)

        return self._keyed(keyed_once(batch.select(*self.schema.names), self.keys, "upsert"), load, attempts)

    def insert_if_absent(self, batch: DataFrame, order_by: Sequence[str] | None = None, attempts: int = 1) -> int:
        """K4: adds one row (the first by ``order_by``) of every key the table lacks."""

        def load(version: int, new: DataFrame) -> int:
            old = self._files(self.candidates(new, version))
            return self._commit(version, new_rows_if_absent(old, new, self.keys, unique=True).select(*self.schema.names), lambda m: m)

        empty = self.spark.createDataFrame([], self.schema)
        rows = new_rows_if_absent(empty, batch.select(*self.schema.names), self.keys, order_by)
        return self._keyed(rows, load, attempts)

    def strict_insert(self, batch: DataFrame, attempts: int = 1) -> int:
        """K9: adds the rows; fails, and adds none, if a key is held, repeats or is NULL."""

        def load(version: int, new: DataFrame) -> int:
            if self._holding(new, version):
                raise ValueError("strict_insert: duplicate primary key or NULL key")
            return self._commit(version, new, lambda old: old)

        return self._keyed(keyed_once(batch.select(*self.schema.names), self.keys, "strict_insert"), load, attempts)

    def _keyed(self, rows: DataFrame, load: Callable[[int, DataFrame], int], attempts: int) -> int:
        with written_once(self.spark, rows, "batch") as new:
            for left in range(attempts - 1, -1, -1):
                try:
                    return load(self.version(), new)
                except ConcurrentLoad:
                    if not left:
                        raise
        raise ValueError("attempts must be positive")

    def _holding(self, batch: DataFrame, version: int) -> list[str]:
        """Files that hold a key of ``batch``: the keys of the candidates are read."""
        near = self.candidates(batch, version)
        if not near:
            return []
        keys = self._files(near).select(*self.keys, F.col("_metadata.file_path").alias("path"))
        held = keys.join(batch.select(*self.keys), self.keys, "left_semi").select(_below("path").alias("file"))
        return [r.file for r in held.distinct().collect()]

    def _commit(self, version: int, rows: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> int:
        """Writes ``rows`` as a load of its own and publishes version + 1: the files
        that ``keep`` leaves of the manifest, and the new ones."""
        load = uuid.uuid4().hex
        data = f"{self.path}/data/{load}"
        rows.write.parquet(data)
        files = (
            self.spark.read.schema(self.schema).parquet(data)
            .select(*self.keys, F.col("_metadata.file_path").alias("path"))
        )
        ranges = files.groupBy("path").agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.struct(*[f(k).alias(k) for k in self.keys]).alias(n) for n, f in (("least", F.min), ("most", F.max))],
        )
        new = ranges.select(_below("path").alias("file"), F.lit(load).alias("load"), "rows", _classes("rows").alias("classes"), "least", "most")
        with written_once(self.spark, new, "manifest") as new:
            _index_rows(files, new, self.keys).write.parquet(f"{self.path}/index/{load}")
            keep(self.manifest(version)).unionByName(new).write.parquet(f"{self.path}/manifests/{load}")
        self._publish(version + 1, load)
        return version + 1

    def vacuum(self, keep: int = 1) -> list[str]:
        """Forgets all but the newest ``keep`` versions and removes the folders that no
        version left names (also those of loads that died).  No load may run meanwhile.
        Returns the loads removed."""
        versions = self.versions()
        for v in versions[:-keep]:
            remove_path(self.spark, f"{self.path}/versions/{v:020d}")
        named = {self._load_of(v) for v in versions[-keep:]}
        used = set(named)
        for v in versions[-keep:]:
            used |= {r["load"] for r in self.manifest(v).select("load").distinct().collect()}
        gone = set()
        for kind, wanted in (("data", used), ("index", used), ("manifests", named)):
            folder = f"{self.path}/{kind}"
            if path_exists(self.spark, folder):
                fs, jpath = file_system(self.spark, folder)
                for name in [s.getPath().getName() for s in fs.listStatus(jpath)]:
                    if name not in wanted:
                        remove_path(self.spark, f"{folder}/{name}")
                        gone.add(name)
        return sorted(gone)


# ---------------------------------------------------------------- the key index
_INDEX = "file string, classes long, bucket long, bits binary"


def _below(path: str) -> Column:
    """A file's place below its table's folder."""
    return F.regexp_extract(path, r"(data/[0-9a-f]{32}/[^/]+)$", 1)


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _classes(rows: str) -> Column:
    """Bitmaps of a file of so many rows: a power of two, so that files share classes."""
    bitmaps = F.greatest(F.lit(1.0), F.col(rows) * F.lit(BITS_PER_KEY / BUCKET_BITS))
    return F.pow(F.lit(2.0), F.ceil(F.log2(bitmaps))).cast("long")


def _place(h: Column, classes: Column) -> list[Column]:
    """The bitmap of a hash among ``classes`` bitmaps, and its bit there."""
    return [
        F.pmod(F.shiftrightunsigned(h, 16), classes).alias("bucket"),
        F.pmod(h, F.lit(BUCKET_BITS)).cast("long").alias("bit"),
    ]


def _index_rows(files: DataFrame, manifest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A Bloom filter of one hash per key for every file, as bitmaps of 32,768 bits: 16
    bits a key or more, so that at most one file in 16 is read in vain.  Keys shrink to
    bits in every task before the shuffle; few-row files have one bitmap."""
    sized = files.select(_below("path").alias("file"), _hash(keys).alias("h")).join(manifest.select("file", "classes"), "file")
    at = sized.select("file", "classes", *_place(F.col("h"), F.col("classes")))
    return at.groupBy("file", "classes", "bucket").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))
