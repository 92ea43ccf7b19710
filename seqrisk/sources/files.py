"""Session-file sources and sinks.

Two layouts are read:

* Spark-native: ``<root>/<kind>/RaceId=<key>/part-*.parquet`` (what
  ``write_sessions`` produces); the key comes from partition discovery and a
  filter on it prunes directories.
* Flat files: ``<root>/<key>_<kind>.parquet``; the key is the file name
  without the suffix (``_metadata.file_name``), overriding a stored column.

Files whose column types drift (int64 in one, double in another) are read
one DataFrame per distinct schema, cast to a contract and unioned by name,
so the plan grows with the number of schemas, not of files. Footers are read
in tasks (``file_manifest``); the driver holds names and schemas only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def list_files(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths of files, or of datasets that are folders, under ``root`` matching
    a glob (a metadata listing on the driver: names only, no data)."""
    fs, p, jvm = _fs(spark, root)
    st = fs.globStatus(jvm.org.apache.hadoop.fs.Path(p, pattern))
    return sorted(s.getPath().toString() for s in (st or []))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def _to_contract(d: DataFrame, f: T.StructField):
    """A column cast to the contract type. Timestamps written by pandas arrive
    as BIGINT nanoseconds (``nanosAsLong``) and are converted, not cast."""
    src = d.schema[f.name].dataType
    c = F.col(f.name)
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) and isinstance(src, T.LongType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        c = F.timestamp_add("MICROSECOND", F.floor(c / 1000), epoch)     # time-zone free
        return c.cast(f.dataType).alias(f.name)
    return c.cast(f.dataType).alias(f.name)


def union_by_name(dfs: Iterable[DataFrame], contract: T.StructType | None = None) -> DataFrame:
    """Bag union by column name, missing columns null; with a contract,
    every input is first cast to the contract's types."""
    out = None
    for d in dfs:
        if contract is not None:
            d = d.select(*[_to_contract(d, f) if f.name in d.columns
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in contract.fields],
                         *[c for c in d.columns if c not in contract.fieldNames()])
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def _key(path, kind: str):
    """Session key: the name of the file (or folder) without ``_<kind>.parquet``."""
    return F.regexp_extract(path, rf"([^/]+)_{kind}\.parquet(/[^/]*)?$", 1)


def file_manifest(spark: SparkSession, root: str, kind: str = "laps", key: str = "RaceId", verify: bool = False,
                  open_file: Callable | None = None) -> DataFrame:
    """One row per data file of a kind under ``root``: key, path, bytes,
    rows, row_groups, columns (name, type), readable, error. Spark lists the
    tree; footers are read in its tasks, a few kilobytes a file. ``verify`` also
    decodes every row group, batch by batch, and checks page checksums where a
    file has them. A file without a footer, or with a row group that does not
    decode, is not readable and its error says why; its counts are null if it
    has no footer. Files of no bytes are not listed. Files are opened by pyarrow's file systems (local, HDFS, S3,
    GCS, Azure); ``open_file`` (path -> seekable file) serves any other. A file
    that cannot be opened at all is an error of the job, not of the file.
    """
    def work(batches):
        import re
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        systems = {}

        def opened(path):
            scheme, authority, name = re.match(r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/]*))?(/.*)$", path).groups()
            if scheme in (None, "file"):
                return pafs.LocalFileSystem().open_input_file(name)
            at = f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{authority or ''}/"
            if at not in systems:
                systems[at] = pafs.FileSystem.from_uri(at)
            fs, base = systems[at]
            return fs.open_input_file(base.rstrip("/") + name)

        def row(path):
            columns, rows, groups = None, None, None
            with (open_file or opened)(path) as f:
                try:
                    pf = pq.ParquetFile(f, page_checksum_verification=verify)
                    columns = [{"name": c.name, "type": str(c.type)} for c in pf.schema_arrow]
                    rows, groups = pf.metadata.num_rows, pf.metadata.num_row_groups
                except (pa.ArrowException, OSError, ValueError):
                    return columns, rows, groups, "no Parquet footer"
                for g in range(groups if verify else 0):
                    try:
                        n = sum(len(b) for b in pf.iter_batches(65_536, row_groups=[g]))
                        if n != pf.metadata.row_group(g).num_rows:
                            return columns, rows, groups, f"row group {g} is short"
                    except (pa.ArrowException, OSError, ValueError):
                        return columns, rows, groups, f"row group {g} is damaged"
            return columns, rows, groups, None

        kinds = [pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])), pa.int64(), pa.int32(), pa.string()]
        for batch in batches:
            found = list(zip(*[row(p) for p in batch.column(1).to_pylist()])) or [()] * 4
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(list(v), t) for v, t in zip(found, kinds)]],
                                             names=["k", "path", "bytes", "columns", "rows", "row_groups", "error"])

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*").load(root)
    ours = raw.where(F.col("path").rlike(rf"_{kind}\.parquet(/(part-|[^_./])[^/]*)?$"))
    found = ours.select(_key(F.col("path"), kind).alias("k"), "path", F.col("length").alias("bytes")).mapInArrow(
        work, "k string, path string, bytes long, columns array<struct<name:string,type:string>>, rows long, row_groups int, error string")
    return found.select(F.col("k").alias(key), "path", "bytes", "rows", "row_groups", "columns", F.col("error").isNull().alias("readable"), "error")


def read_session_files(spark: SparkSession, root: str, kind: str = "laps", key: str = "RaceId",
                       contract: T.StructType | None = None, required: bool = True, verify: bool = False) -> DataFrame:
    """S1 (required) / S2, S3 (optional): every ``*_<kind>.parquet`` under
    ``root``, unioned by name, ``key`` := file name without ``_<kind>.parquet``.
    Files without a Parquet footer are skipped whole (``unreadable_files`` lists
    them); with ``verify`` so are files with a damaged row group, at the price of
    reading all once more (else Spark skips what it cannot decode of them). No
    file: an error when required, else an empty frame with the contract's schema
    (plus ``key``).

    One read with merged schemas; only where column types conflict, one read
    per distinct schema, cast to the contract. Timestamps that pandas wrote in
    nanoseconds need ``spark.sql.legacy.parquet.nanosAsLong`` in the session
    (``get_session`` sets it); the contract converts them.
    """
    files = list_files(spark, root, f"*_{kind}.parquet")
    if not files:
        if required:
            raise FileNotFoundError(f"no *_{kind}.parquet under {root}")
        fields = list(contract.fields) if contract is not None else []
        if key not in [f.name for f in fields]:
            fields.append(T.StructField(key, T.StringType()))
        return spark.createDataFrame([], T.StructType(fields))
    reader = spark.read.option("ignoreCorruptFiles", "true")
    key_expr = _key(F.col("_metadata.file_path"), kind)
    groups: list[list[str]] = []

    def by_schema() -> list[list[str]]:
        whole = file_manifest(spark, f"{root}/*_{kind}.parquet", kind, key, verify).where("readable")
        return [r.paths for r in whole.groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()]

    if verify:
        groups = by_schema()
        files = [p for g in groups for p in g]
    if files:
        try:
            merged = reader.option("mergeSchema", "true").parquet(*files)
            return union_by_name([merged.withColumn(key, key_expr)], contract)
        except (PySparkException, Py4JJavaError) as e:
            if "CANNOT_MERGE" not in str(e):
                raise
        groups = groups or by_schema()
    if not groups:
        raise FileNotFoundError(f"no readable *_{kind}.parquet under {root}")
    return union_by_name([reader.parquet(*paths).withColumn(key, key_expr) for paths in sorted(groups)], contract)


def unreadable_files(spark: SparkSession, root: str, kind: str = "laps", key: str = "RaceId", verify: bool = False) -> DataFrame:
    """(key, path, error) of the files of a kind that have no Parquet footer or,
    with ``verify``, a damaged row group."""
    return file_manifest(spark, root, kind, key, verify).where(~F.col("readable")).select(key, "path", "error")


def write_session_files(frames: dict, root: str, key: str) -> None:
    """The kinds of one session (laps, weather, car data, track status) as
    ``<root>/<key>_<kind>.parquet``; kinds that are None are left out."""
    for kind, df in frames.items():
        if df is not None:
            df.write.mode("overwrite").parquet(f"{root}/{key}_{kind}.parquet")


def read_sessions(spark: SparkSession, root: str, kind: str = "laps") -> DataFrame:
    """S1-S3, Spark-native layout (partition discovery of the session key). ``write_sessions`` wrote all of its files, so one
    that is damaged or gone is an error, also where the session's settings skip such files."""
    return spark.read.option("ignoreCorruptFiles", "false").option("ignoreMissingFiles", "false").parquet(f"{root}/{kind}")


def write_sessions(df: DataFrame, root: str, kind: str = "laps",
                   partition_cols: Sequence[str] = ("RaceId",)) -> None:
    """Overwrite ``<root>/<kind>`` partitioned by the session key,
    one directory per session. Tasks take ranges of the sessions of about equal
    row counts: a session has few files, a hot one is split over several tasks.
    Their number is fixed, as the time goes into files, not bytes: AQE would
    join all of many small sessions in one task."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism * 4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hashed = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and t != "variant"]
    spread = df.repartitionByRange(tasks, *[F.col(c) for c in partition_cols], F.xxhash64(*hashed))
    spread.write.mode("overwrite").partitionBy(*partition_cols).parquet(f"{root}/{kind}")


def save_dataframe(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """Overwrite a Parquet dataset (parents are created)."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def load_dataframe(spark: SparkSession, path: str) -> DataFrame:
    """Read a dataset; a missing path raises."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def tag_session(df: DataFrame, year, rnd, event, session_type) -> DataFrame:
    """Add the session tags (Year, Round, EventName, SessionType)."""
    lit = lambda v: v if not isinstance(v, (str, int, float)) else F.lit(v)
    return df.withColumns({"Year": lit(year), "Round": lit(rnd), "EventName": lit(event),
                           "SessionType": lit(session_type)})


def pending_sessions(schedule: DataFrame, catalog: DataFrame, now, types: Sequence[str] = ("Q", "R"),
                     date_col: str = "event_date", keys: Sequence[str] = ("year", "round")) -> DataFrame:
    """S9 + J8: past events x session types, minus sessions already in the
    catalog (anti join on the session key). The type list is a literal
    array exploded per event, not a join."""
    now_c = now if not isinstance(now, str) else F.lit(now).cast("date")
    past = schedule.where(F.col(date_col) < now_c)
    wanted = past.select(*keys, F.explode(F.array(*[F.lit(t) for t in types])).alias("session_type"))
    return wanted.join(catalog.select(*keys, "session_type"), [*keys, "session_type"], "left_anti")


def session_catalog(spark: SparkSession, root: str, kind: str = "laps") -> DataFrame:
    """(year, round, event, session_type, files, bytes) of the sessions whose
    ``<year>_<round>_<event>_<type>_<kind>.parquet`` is under ``root``, at any
    depth, as a file or a folder of files. Spark lists the tree (in a job where
    it is wide) and reads no file. Other names are ignored; no folder is an error."""
    if not path_exists(spark, root):
        raise FileNotFoundError(root)
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select(F.regexp_extract(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), rf"([^/=]+)_{kind}\.parquet(/[^/]*)?$", 1).alias("k"), "length"))
    part = lambda i: F.regexp_extract("k", r"^(\d{4})_(\d+)_(.+)_([^_]+)$", i)
    named = found.where(part(1) != "").select(part(1).cast("int").alias("year"), part(2).cast("int").alias("round"), part(3).alias("event"),
                                              part(4).alias("session_type"), "length")
    return named.groupBy("year", "round", "event", "session_type").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def pending_in_folder(spark: SparkSession, schedule: DataFrame, root: str, now, types: Sequence[str] = ("Q", "R"), kind: str = "laps") -> DataFrame:
    """S9 + J8: past sessions of the schedule that have no file under ``root``."""
    return pending_sessions(schedule, session_catalog(spark, root, kind).select("year", "round", "session_type").distinct(), now, types)
