"""Writers: partitioned facts, dimensions, catalog tables and year appends."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoflux.operators.shaping import only_years, sanitize_types
from ecoflux.session import scratch_dir

PARTITION_COLS = ("year", "month")
#: The folder level of one write, below that of its partition. Names rise with time.
LOAD_COL = "load_id"
#: A task keeps the files of so many partitions open; with more of them, it sorts the rest of its rows.
OPEN_FILES = 128


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Within it, tasks write rows to the files of their partitions as they come. Spark otherwise
    sorts all rows of a task by partition first, which holds them unpacked in memory (16 times
    what they take in the shuffle and in files); open files hold them encoded."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_partitioned(df: DataFrame, dest: str, partition_cols: Iterable[str] = PARTITION_COLS) -> str:
    """Write ``year=/month=`` Parquet, replacing only the partitions present in ``df``.

    ``REBALANCE(year, month)`` clusters rows of a partition into few files while AQE
    splits a month that is much larger than the others (a plain ``repartition`` on the
    same columns would put a whole month in one task). Dynamic overwrite is set on this
    write only.
    """
    cols = list(partition_cols)
    out = sanitize_types(df).hint("rebalance", *cols)
    with unsorted_writes(df.sparkSession):
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(dest)
    return dest


def append_partitions(df: DataFrame, dest: str, partition_cols: Iterable[str]) -> str:
    """Add ``df`` below ``dest``, clustered by its partitions; what is there stays."""
    cols = list(partition_cols)
    with unsorted_writes(df.sparkSession):
        df.hint("rebalance", *cols).write.mode("append").partitionBy(*cols).parquet(dest)
    return dest


def split_rows(df: DataFrame, flag: Column, name: str = "split") -> tuple[DataFrame, DataFrame]:
    """(all rows, the flagged rows), both read back from one write with a folder for each, so
    ``df`` is computed once and the flagged rows are read alone. A null flag is false."""
    path = scratch_dir(df.sparkSession, name)
    flagged = df.withColumn("_flagged", F.coalesce(flag, F.lit(False)))
    flagged.write.partitionBy("_flagged").parquet(path)
    back = df.sparkSession.read.schema(flagged.schema).parquet(path)
    return back.drop("_flagged"), back.where("_flagged").drop("_flagged")


def write_dimension(df: DataFrame, dest: str, mode: str = "overwrite") -> str:
    """Write a small, unpartitioned dimension.

    ``REBALANCE`` lets AQE coalesce a small register into one file without funnelling
    its upstream work through one task (which ``coalesce(1)`` would do). ``mode="ignore"``
    skips a dimension that already exists.
    """
    sanitize_types(df).hint("rebalance").write.mode(mode).parquet(dest)
    return dest


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (at ``location`` when given, else the warehouse)."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    path: str | None = None,
    partition_by: Iterable[str] | None = None,
    replace: bool = True,
) -> str:
    """``DROP TABLE IF EXISTS`` + create-as-select into Parquet (snappy), optionally at an
    external location and partitioned (partition columns must be the last columns)."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = list(partition_by or [])
    out = df.hint("rebalance", *cols) if cols else df.hint("rebalance")
    w = out.write.format("parquet").option("compression", "snappy")
    if path:
        w = w.option("path", path)
    if cols:
        w = w.partitionBy(*cols)
    with unsorted_writes(spark):
        w.mode("overwrite" if replace else "errorifexists").saveAsTable(name)
    return name


def append_years(df: DataFrame, name: str, years: Iterable[int | str] | None = None, year_col: str = "year") -> str:
    """Append the rows of ``years`` (all rows when ``None``) to an existing table.

    Columns are matched by position, as ``INSERT INTO ... SELECT`` does.
    """
    part = df if years is None else only_years(df, years, year_col)
    part.write.insertInto(name, overwrite=False)
    return name


def append_batch(
    df: DataFrame, name: str, path: str, batch: str, partition_by: Iterable[str] = PARTITION_COLS, batch_col: str = "batch"
) -> str:
    """Append ``df`` as a batch to the table at ``path``, whose last partition column is
    ``batch_col``. The batch has partitions of its own, which are replaced as a whole: to repeat
    it, after a failure at any point or with corrected rows, leaves it in the table once.
    Other batches are not touched."""
    spark, cols = df.sparkSession, list(partition_by)
    write_partitioned(df.withColumn(batch_col, F.lit(batch)), path, [*cols, batch_col])
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    old = [p for p in partitions_of(spark, name) if p[batch_col] == batch]
    now = {tuple(str(v) for v in r) for r in df.select(*cols).distinct().collect()}  # as many as months
    for p in old:
        if tuple(p[c] for c in cols) not in now:
            drop_table_partition(spark, name, path, p)
    spark.sql(f"REFRESH TABLE {name}")
    return name


def stage_partitions(spark: SparkSession, df: DataFrame, path: str, partition_by: Iterable[str] = PARTITION_COLS) -> dict[tuple[str, ...], str]:
    """Write ``df`` into fresh folders, one below the folder of each of its partitions
    (``year=/month=/load_id=``), and return them by partition values. A folder gets its
    ``_SUCCESS`` marker when all of it is there. No table reads the folders before
    :func:`switch_partitions`, and what a table reads now stays untouched."""
    cols, load_id = list(partition_by), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    out = sanitize_types(df).withColumn(LOAD_COL, F.lit(load_id))
    with unsorted_writes(spark):
        out.hint("rebalance", *cols).write.mode("append").partitionBy(*cols, LOAD_COL).parquet(path)
    fs, _ = _file_system(spark, path)
    fresh = {}
    for values, folder in _partition_folders(spark, path, cols):
        own = f"{folder}/{LOAD_COL}={load_id}"
        if fs.exists(_path(spark, own)):
            fs.create(_path(spark, f"{own}/_SUCCESS"), True).close()
            fresh[values] = own
    return fresh


def switch_partitions(
    spark: SparkSession, name: str, fresh: dict[tuple[str, ...], str], partition_by: Iterable[str] = PARTITION_COLS
) -> str:
    """Point the partitions of a table at staged folders, one catalog change for each, then
    remove what they replace. A reader that plans its scan before a switch gets the old
    partition, after it the new one, and never a part of either; where the driver is lost in
    between, the remaining partitions stay as they were and their staged folders are removed
    by the next switch."""
    cols = list(partition_by)
    known = {tuple(p[c] for c in cols) for p in partitions_of(spark, name)}
    for values, folder in sorted(fresh.items()):
        spec = ", ".join(f"{c} = '{v}'" for c, v in zip(cols, values))
        if values in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{folder}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec}) LOCATION '{folder}'")
    spark.sql(f"REFRESH TABLE {name}")
    for folder in fresh.values():
        fs, at = _file_system(spark, folder)
        for old in fs.listStatus(at.getParent()):
            if old.getPath().getName() != at.getName():
                fs.delete(old.getPath(), True)
    return name


def overwrite_table_partitions(spark: SparkSession, df: DataFrame, name: str, path: str) -> str:
    """Replace the partitions present in ``df`` of an existing partitioned table at ``path``;
    each is written apart and switched to when all of them are there."""
    return switch_partitions(spark, name, stage_partitions(spark, df, path))


def _recover_partitions(spark: SparkSession, name: str, path: str, cols: list[str]) -> None:
    """Find the partitions of a table that the catalog does not know yet. Each is the newest
    load that is all there, or the partition's own folder if none is."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    fs, _ = _file_system(spark, path)
    for values, folder in _partition_folders(spark, path, cols):
        loads = [s.getPath() for s in fs.listStatus(_path(spark, folder)) if s.getPath().getName().startswith(f"{LOAD_COL}=")]
        if whole := [p for p in loads if is_complete(spark, p.toString())]:
            newest = max(whole, key=lambda p: p.getName()).toString()
            spec = ", ".join(f"{c} = '{v}'" for c, v in zip(cols, values))
            spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{newest}'")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _partition_folders(spark: SparkSession, path: str, cols: list[str]) -> list[tuple[tuple[str, ...], str]]:
    """(values, folder) of the partitions below ``path``: as many as months, so the driver lists them."""
    fs, at = _file_system(spark, path)
    found = [((), at)] if fs.exists(at) else []
    for c in cols:
        subs = [(v, s.getPath()) for v, p in found for s in fs.listStatus(p) if s.isDirectory()]
        found = [((*v, unquote(p.getName()[len(c) + 1 :])), p) for v, p in subs if p.getName().startswith(f"{c}=")]
    return [(v, p.toString()) for v, p in found]


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has committed its output at ``path`` (its ``_SUCCESS`` marker is there).
    Errors of the storage are not taken for "no"."""
    fs, at = _file_system(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(at)


def drop_partition_folder(spark: SparkSession, dest: str, values: dict[str, object]) -> None:
    """Remove one partition's folder (no error if it is not there)."""
    fs, at = _file_system(spark, "/".join([dest.rstrip("/"), *(f"{k}={v}" for k, v in values.items())]))
    fs.delete(at, True)


def _merged_copies(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the merged copies beside a record, whole or not, rising."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at.getParent()):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at.getParent())]
    return sorted(int(n.rsplit("-", 1)[1]) for n in names if n.startswith(f"{at.getName()}.merged-"))


def record_path(spark: SparkSession, path: str) -> str:
    """Where the rows of an appended record are: at ``path``, or in its latest whole merged copy."""
    for n in reversed(_merged_copies(spark, path)):
        if is_complete(spark, f"{path}.merged-{n}"):
            return f"{path}.merged-{n}"
    return path


def merge_record(spark: SparkSession, path: str, schema: str, most: int = 32, small_bytes: int = 16 << 20) -> bool:
    """Write a record anew in few files once it has more than ``most`` small ones, so their
    number stays bounded however many runs append to it. The copy counts from the moment that
    it is whole; only then the files before it go. No frame that reads the record may be in use."""
    now = record_path(spark, path)
    fs, at = _file_system(spark, now)
    if not is_complete(spark, now):
        return False
    if sum(s.isFile() and s.getPath().getName().endswith(".parquet") and s.getLen() < small_bytes for s in fs.listStatus(at)) <= most:
        return False
    copies = _merged_copies(spark, path)
    new = f"{path}.merged-{max(copies, default=0) + 1}"
    spark.read.schema(schema).parquet(now).hint("rebalance").write.mode("overwrite").parquet(new)
    for old in [path, *(f"{path}.merged-{n}" for n in copies)]:
        drop_folder(spark, old)
    return True


def drop_record(spark: SparkSession, path: str) -> None:
    """Remove a record; the copy that counts goes last, so a broken-off removal leaves it as it was or gone."""
    for old in [path, *(f"{path}.merged-{n}" for n in _merged_copies(spark, path))]:
        drop_folder(spark, old)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder (no error if it is not there)."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def drop_table_partition(spark: SparkSession, name: str, path: str, values: dict[str, object]) -> None:
    """Remove one partition of an external table, then its files."""
    spec = ", ".join(f"{k} = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    spark.sql(f"REFRESH TABLE {name}")
    drop_partition_folder(spark, path, values)


def partitions_of(spark: SparkSession, name: str) -> list[dict[str, str]]:
    """The registered partitions of a table, as column values."""
    return [dict(p.split("=", 1) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def check_types(spark: SparkSession, name: str, schema: T.StructType) -> dict[str, T.DataType]:
    """The columns of a registered table (none, if there is no table). An error if ``schema``
    has another type for one of them, for older partitions could not be read any more. To be
    called before a write."""
    known = {f.name: f.dataType for f in spark.table(name).schema} if spark.catalog.tableExists(name) else {}
    if odd := [f.name for f in schema if known.get(f.name, f.dataType) != f.dataType]:
        raise ValueError(f"{name}: columns {odd} changed their types; load the table anew")
    return known


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by: Iterable[str] = (), replace: bool = False) -> str:
    """Register Parquet output at ``path`` as an external catalog table and find its partitions,
    or bring the table up to date for ``schema``: new columns are added, and partitions stay
    where they point (``switch_partitions`` adds new ones). No data file is opened. A column that changed its type is an error (``check_types``) unless
    all of the table was written anew (``replace``)."""
    cols = list(partition_by)
    known = {} if replace else check_types(spark, name, schema)
    new = {f.name: f.dataType.simpleString() for f in schema}
    if not known:
        fields = ", ".join(f"`{n}` {new[n]}" for n in [*(n for n in new if n not in cols), *cols])
        by = f" PARTITIONED BY ({', '.join(cols)})" if cols else ""
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet{by} LOCATION '{path}'")
        if cols:
            _recover_partitions(spark, name, path, cols)
    elif more := [n for n in new if n not in known]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{n}` {new[n]}' for n in more)})")
    spark.sql(f"REFRESH TABLE {name}")
    return name
