"""End-to-end runs: bronze files -> silver tables -> gold tables.

The only module with paths, order and writes. One Spark job per table and layer, over all
years at once (the source ran one job per year, and per gold statement per year). One run at
a time is assumed; every record below is written after what it records, so a run that breaks
off anywhere is made up for by the next.

Silver series load at (year, month) grain:

1. *new files* are those whose (path, length, time) the dataset's ledger does not hold (an anti
   join; file times are compared for equality only, so late files with old times count);
2. the *touched months* are the local months of their rows (after the UTC -> local shift, so a
   reading of 1 Jan 01:00 UTC touches December), and of a file that was replaced also the
   months of its former rows; months outside ``Lake.years`` are left out;
3. every bronze file that can hold rows of a touched month (all but those whose months, as the
   ledger has them or as just found, include none; names don't count) is re-read, one scan for
   each file layout, and only those partitions are replaced: a month is written into a fresh
   folder, and the catalog's partition is pointed at it when all of it is there, so readers and
   a lost driver never meet half a month. Partitions left without rows are removed. Keys and names are cast to their declared types (``schemas.SILVER``) in each
   layout, and the result is checked against the registered table before any file is touched;
   The weather and the generation keep mergeable daily states of every file
   (``plans.states``), written once when the file is first read: their months are merged from
   them, and only files that have no states yet are opened;
4. the touched months go to the change log with a rising version, then the files to the ledger.

Each gold table records the version up to which it was built. Its pending work is what the
change log holds beyond that for its inputs: months of its series, or a register, after which
it is rebuilt whole.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoflux import schemas as SC
from ecoflux.functions import entry_name, local_date, to_date_lenient, year_in_name
from ecoflux.operators.incremental import YM
from ecoflux.operators.contract import conform_declared, lost_values
from ecoflux.operators import dictionary, rejects
from ecoflux.operators.numbering import number_new
from ecoflux.operators.shaping import only_months, only_years, sanitize_types
from ecoflux.plans import gold, silver, states
from ecoflux.session import written
from ecoflux.sources import readers, sinks

# --- fixed values: folder layout of the lake -----------------------------------------
BRONZE_DIRS = {
    "hydrology": "ons/dados_hidrologicos_di",
    "load": "ons/carga_energia_di",
    "generation": "ons/geracao_usina_2_ho",
    "capacity": "ons/capacidade_geracao",
    "modality": "ons/modalidade_usina",
    "weather": "inmet/microdados",
    "stations": "inmet/estacoes",
    "municipalities": "diretorios_brasil/municipios",
}
SILVER_TABLES = {
    "hydrology": "silver_dados_hidrologicos_di",
    "load": "silver_carga_energia_di",
    "generation": "silver_geracao_usina_2_ho",
    "capacity": "silver_capacidade_geracao",
    "modality": "silver_modalidade_usina",
    "weather": "silver_microdados",
    "stations": "silver_estacoes",
    "municipalities": "silver_diretorios_brasil",
}
GOLD_TABLES = [
    "gold_dim_tempo",
    "gold_dim_localizacao",
    "gold_dim_usina",
    "gold_fato_clima",
    "gold_fato_geracao",
    "gold_fato_hidrologia",
    "gold_fato_carga",
    "gold_fato_eficiencia_hidro",
    "gold_bridge_clima_geracao",
]
# ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Series:
    """How a daily series is built from raw rows, and the date of a raw row. ``merge`` builds it
    from the states that the files left (``plans.states``; ``schema``), if it has any."""

    build: Callable[[DataFrame], DataFrame]
    numeric: tuple[str, ...]
    time_col: str
    date: Callable[[DataFrame], Column]
    merge: Callable[[DataFrame], DataFrame] | None = None
    schema: str = ""


def _instant_date(raw: DataFrame) -> Column:
    return to_date_lenient(F.col("din_instante"), raw.schema["din_instante"].dataType.typeName())


SERIES: dict[str, Series] = {
    "hydrology": Series(silver.hydrology, (*SC.HYDRO_MEASURES, "num_ordemcs", "cod_usina"), "din_instante", _instant_date),
    "load": Series(silver.load, ("val_cargaenergiamwmed",), "din_instante", _instant_date),
    "generation": Series(silver.generation_daily, ("val_geracao",), "din_instante", _instant_date, states.generation_from_states, states.GENERATION_STATES),
    "weather": Series(silver.weather_daily, tuple(SC.WEATHER_COLS[3:]), "data", lambda raw: local_date("data", "hora"), states.weather_from_states, states.WEATHER_STATES),
}
REGISTERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "capacity": silver.capacity,
    "modality": silver.modality,
    "stations": silver.stations,
    "municipalities": silver.municipalities,
}
CSV_REGISTERS = {"stations", "municipalities"}
#: The inputs of each gold table; the first series drives its rows (a month without rows there has none in gold).
GOLD_INPUTS = {
    "gold_dim_tempo": ["weather", "generation", "load", "hydrology"],
    "gold_dim_localizacao": ["stations", "municipalities"],
    "gold_dim_usina": ["capacity", "modality"],
    "gold_fato_clima": ["weather"],
    "gold_fato_geracao": ["generation"],
    "gold_fato_hidrologia": ["hydrology"],
    "gold_fato_carga": ["load"],
    "gold_fato_eficiencia_hidro": ["hydrology", "generation"],
    "gold_bridge_clima_geracao": ["weather", "generation", "load", "stations", "municipalities"],
}
DIMENSIONS = {"gold_dim_tempo", "gold_dim_localizacao", "gold_dim_usina"}
BRIDGE = "gold_bridge_clima_geracao"
LOCATION = "gold_dim_localizacao"

# all_months: the months are those of all rows; without it, only of those within ``Lake.years``
FILE = ["path", "length", "mtime"]
STATE_FILES = "path string, length long, mtime long, load_id string"
LEDGER = "path string, length long, mtime long, months array<int>, version long, loaded_at long, all_months boolean"
CHANGES = "dataset string, year int, month int, has_rows boolean, version long"
PROGRESS = "table string, version long"
# a record table with more small files than this is written anew in few
MOST_FILES = 32
BACKFILLS = "name string, table string, year int, version long"
PROFILE = "path string, length long, mtime long, column string, type string, rows long, filled long, load_id string"
PLANTS = "nom_usina string, plant_id long"
REJECTED = "path string, length long, mtime long, column string, text string, reason string, reading string, load_id string"


@dataclass
class Lake:
    bronze: str
    silver: str
    gold: str
    database: str = "ecoflux"
    bronze_dirs: dict[str, str] = field(default_factory=lambda: dict(BRONZE_DIRS))
    # inclusive range of years: of the names of ingested files (files without a year always
    # pass) and of the dates in silver
    years: tuple[int, int] | None = None
    # keep a line for each text of a new file that can't be read (``rejected_readings``)
    keep_rejected: bool = False

    def src(self, ds: str) -> str:
        return f"{self.bronze.rstrip('/')}/{self.bronze_dirs[ds]}"

    def dest(self, ds: str) -> str:
        return f"{self.silver.rstrip('/')}/{BRONZE_DIRS[ds]}"

    def state(self, name: str) -> str:
        return f"{self.silver.rstrip('/')}/_ecoflux/{name}"

    def gold_path(self, table: str) -> str:
        return f"{self.gold.rstrip('/')}/{table}"

    def gold_state(self, name: str) -> str:
        return f"{self.gold.rstrip('/')}/_ecoflux/{name}"

    def silver_table(self, ds: str) -> str:
        return f"{self.database}.{SILVER_TABLES[ds]}"

    def gold_table(self, table: str) -> str:
        return f"{self.database}.{table}"

    def in_years(self, year: Column) -> Column:
        return F.lit(True) if self.years is None else year.between(*self.years)


# --- records ------------------------------------------------------------------------------
def _records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A record table, empty before its first write."""
    path = sinks.record_path(spark, path)
    if sinks.is_complete(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _record(rows: DataFrame, path: str) -> None:
    """Append to a record table."""
    rows.write.mode("append").parquet(sinks.record_path(rows.sparkSession, path))


def _merge_records(spark: SparkSession, records: dict[str, str]) -> None:
    """Keep the number of files of these records (path: schema) bounded; between the loads only,
    when no frame reads them."""
    for path, schema in records.items():
        sinks.merge_record(spark, path, schema, most=MOST_FILES)


def _next_version(spark: SparkSession, lake: Lake) -> int:
    return (_records(spark, lake.state("changes"), CHANGES).agg(F.max("version")).first()[0] or 0) + 1


def _log_change(spark: SparkSession, lake: Lake, ds: str, months: Iterable[tuple[int | None, int | None, bool]]) -> int:
    version = _next_version(spark, lake)
    rows = [(ds, y, m, has_rows, version) for y, m, has_rows in months]
    if rows:
        _record(spark.createDataFrame(rows, CHANGES), lake.state("changes"))
    return version


# --- daily states ---------------------------------------------------------------------------
def _file_key(path: Column, encoded: bool = False) -> Column:
    """A path as the listing and the scan agree on it: they spell it file:/a b and file:///a%20b."""
    plain = F.url_decode(F.regexp_replace(path, r"\+", "%2B")) if encoded else path
    return F.regexp_replace(plain, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _state_files(spark: SparkSession, lake: Lake, ds: str, of: str = "state_files") -> DataFrame:
    """(path, length, mtime, load_id): the files with states, each with its latest load."""
    known = _records(spark, lake.state(f"{of}/{ds}"), STATE_FILES)
    return known.groupBy(*FILE).agg(F.max("load_id").alias("load_id"))


def _states_of(spark: SparkSession, lake: Lake, ds: str, files: DataFrame) -> DataFrame:
    """The states of these (path, length, mtime), as their latest load wrote them: states of a
    replaced file, or of a load that was broken off, are in no record and are left out."""
    mine = _state_files(spark, lake, ds).join(files.select(*FILE), FILE, "left_semi")
    return _records(spark, lake.state(f"states/{ds}"), SERIES[ds].schema).join(mine, [*FILE, "load_id"], "left_semi")


def _plant_ids(spark: SparkSession, lake: Lake, names: DataFrame) -> DataFrame:
    """(nom_usina, plant_id) of the lake's plants, those of ``names`` among them. A plant keeps
    its number for good: bitmaps in the states are made of them."""
    path = lake.state("plants")
    fresh = number_new(names, "nom_usina", _records(spark, path, PLANTS), "plant_id")
    # what a first write left behind without its end is in no state yet, and goes
    at = sinks.record_path(spark, path)
    fresh.write.mode("append" if sinks.is_complete(spark, at) else "overwrite").parquet(at)
    return _records(spark, path, PLANTS)


def _generation_states(spark: SparkSession, lake: Lake, raw: DataFrame) -> DataFrame:
    own = written(states.generation_by_plant(raw, ["_path"]), "plant-days")  # the files are read once
    return states.generation_states(own, _plant_ids(spark, lake, own), ["_path"])


def _problems(ds: str) -> Callable[[DataFrame], DataFrame]:
    """What tags the readings of a delivered layout with the texts that can't be read."""

    def tag(raw: DataFrame) -> DataFrame:
        series = SERIES[ds]
        when = ["data", "hora"] if ds == "weather" else [series.time_col]
        timed = [rejects.time_problem(when, series.date(raw))] if set(when) <= set(raw.columns) else []
        return rejects.with_problems(raw, [*timed, *rejects.number_problems(raw, series.numeric)])

    return tag


def _read_new(spark: SparkSession, lake: Lake, ds: str, files: DataFrame, paths: list[str], declared: T.StructType | None = None) -> DataFrame:
    """The readings of new files with their path. With ``Lake.keep_rejected`` the files are read
    here, once, into two sinks: the parsed readings, and a line for each text that can't be
    read. The record is written last; of a file's loads the latest counts."""
    if not lake.keep_rejected:
        return readers.read_union(spark, paths, list(SERIES[ds].numeric), with_path=True, declared=declared)
    raw = readers.read_union(spark, paths, list(SERIES[ds].numeric), with_path=True, declared=declared, before=_problems(ds))
    readings, rejected = sinks.split_rows(raw, F.size(rejects.PROBLEMS) > 0, "readings")
    found = rejects.lines(rejected, [_file_key(F.col("_path"), encoded=True).alias("k")])
    load_id = f"load-{time.time_ns():020d}"
    named = found.join(files.select(_file_key(F.col("path")).alias("k"), *FILE), "k").drop("k").withColumn("load_id", F.lit(load_id))
    named.write.mode("append").partitionBy("load_id").parquet(lake.state(f"rejected/{ds}"))
    _record(files.select(*FILE, F.lit(load_id).alias("load_id")), lake.state(f"rejected_files/{ds}"))
    return readings.drop(rejects.PROBLEMS, rejects.READING)


def rejected_readings(spark: SparkSession, lake: Lake, ds: str) -> DataFrame:
    """(path, length, mtime, column, text, reason, reading, load_id): every text that can't be
    read in the files that are there now, as far as they were loaded with ``keep_rejected``."""
    mine = _state_files(spark, lake, ds, "rejected_files").join(bronze_files(spark, lake, ds).select(*FILE), FILE, "left_semi")
    return _records(spark, lake.state(f"rejected/{ds}"), REJECTED).join(mine, [*FILE, "load_id"], "left_semi")


def add_states(spark: SparkSession, lake: Lake, ds: str, files: DataFrame) -> None:
    """Read these files once and keep their daily states; the record is written last, so what a
    broken-off run leaves behind does not count."""
    paths = [r["path"] for r in files.select("path").collect()]  # file names only
    if not paths:
        return
    raw = _read_new(spark, lake, ds, files, paths, SC.raw_text(ds))
    made = _generation_states(spark, lake, raw) if ds == "generation" else states.weather_states(raw, ["_path"])
    own = made.withColumn("k", _file_key(F.col("_path"), encoded=True)).drop("_path")
    named = own.join(files.select(_file_key(F.col("path")).alias("k"), *FILE), "k").drop("k")
    load_id = f"load-{time.time_ns():020d}"
    sinks.append_partitions(named.withColumn("load_id", F.lit(load_id)), lake.state(f"states/{ds}"), [*YM, "load_id"])
    _record(files.select(*FILE, F.lit(load_id).alias("load_id")), lake.state(f"state_files/{ds}"))


# --- running profile --------------------------------------------------------------------------
def profile_files(spark: SparkSession, lake: Lake, ds: str) -> list[str]:
    """Count rows and values of each column of the dataset's files that have no profile yet (one
    scan for each layout, no other file is opened); returns the paths that were read. The
    record is written last."""
    known = _state_files(spark, lake, ds, "profiled_files")
    files = written(bronze_files(spark, lake, ds).select(*FILE).join(known, FILE, "left_anti"), "unprofiled")
    paths = [r["path"] for r in files.select("path").collect()]  # file names only
    if not paths:
        return []
    load_id = f"load-{time.time_ns():020d}"
    named = files.select(_file_key(F.col("path")).alias("_k"), *FILE)
    for own, schema in readers.schema_groups(spark, paths):
        raw = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*own)
        counts = dictionary.profile(raw.withColumn("_k", _file_key(F.col("_metadata.file_path"), encoded=True)), ["_k"])
        counts.join(named, "_k").drop("_k").withColumn("load_id", F.lit(load_id)).write.mode("append").partitionBy("load_id").parquet(lake.state(f"profiles/{ds}"))
    _record(files.withColumn("load_id", F.lit(load_id)), lake.state(f"profiled_files/{ds}"))
    _merge_records(spark, {lake.state(f"profiled_files/{ds}"): STATE_FILES})
    return paths


def data_dictionary(spark: SparkSession, lake: Lake, ds: str, columns: Iterable[str] = (), descriptions: dict[str, str] | None = None) -> DataFrame:
    """The dictionary of what the dataset's files hold now (``dictionary.describe``), merged
    from their profiles: only files that have none are read. Files that were replaced or
    removed no longer count."""
    profile_files(spark, lake, ds)
    mine = _state_files(spark, lake, ds, "profiled_files").join(bronze_files(spark, lake, ds).select(*FILE), FILE, "left_semi")
    counts = written(_records(spark, lake.state(f"profiles/{ds}"), PROFILE).join(mine, [*FILE, "load_id"], "left_semi"), "profile")
    total = counts.groupBy(*FILE).agg(F.max("rows").alias("rows")).agg(F.sum("rows")).first()[0]
    return dictionary.from_profile(counts, list(columns), descriptions, total)


# --- silver -------------------------------------------------------------------------------
def bronze_files(spark: SparkSession, lake: Lake, ds: str) -> DataFrame:
    """(path, length, mtime, file_year) of the dataset's files within the ingest years."""
    files = readers.list_files(spark, lake.src(ds)).withColumn("file_year", year_in_name(entry_name("path", lake.src(ds))))
    if lake.years is None:
        return files
    lo, hi = (f"{y:04d}" for y in lake.years)
    return files.where(F.col("file_year").isNull() | F.col("file_year").between(lo, hi))


def _between(raw: DataFrame, col: str, months: list[tuple[int, int]]) -> DataFrame:
    """Raw rows within a UTC day of the span of ``months``. A plain range on a date or time
    column reaches the Parquet scan; text dates are left to the month join."""
    if col not in raw.columns or not isinstance(raw.schema[col].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return raw
    (y0, m0), (y1, m1) = months[0], months[-1]
    first, last = f"date'{y0:04d}-{m0:02d}-01'", f"date'{y1:04d}-{m1:02d}-01'"
    kind = raw.schema[col].dataType.simpleString()
    return raw.where(f"`{col}` >= cast(date_sub({first}, 1) AS {kind}) AND `{col}` < cast(date_add(add_months({last}, 1), 2) AS {kind})")


def rebuild_months(
    spark: SparkSession,
    lake: Lake,
    ds: str,
    months: list[tuple[int, int]],
    maybe_empty: Iterable[tuple[int, int]] = (),
    whole: bool = False,
    news: DataFrame | None = None,
) -> set[tuple[int, int]]:
    """Rewrite these silver months from every bronze file that can hold their rows, and
    remove those of ``maybe_empty`` that have no row any more (they are returned). The
    rewrite is complete and idempotent, so it can be repeated after a failure. ``whole``:
    these are all months of the table. ``news``: (path, length, mtime, months) of files that
    the ledger does not hold yet; files in neither are read."""
    if not months:
        return set()
    series, months = SERIES[ds], sorted(set(months))
    known = _records(spark, lake.state(f"files/{ds}"), LEDGER).where("all_months").select(*FILE, "months")
    known = known if news is None else known.unionByName(news)
    touched = F.array(*[F.lit(y * 12 + m - 1) for y, m in months])
    others = known.groupBy(*FILE).agg(F.max(F.arrays_overlap("months", touched)).alias("some")).where("NOT some")
    files = bronze_files(spark, lake, ds).join(others, FILE, "left_anti")
    paths = [r["path"] for r in files.select("path").collect()]  # file names only
    gone = set(maybe_empty)
    if paths:
        if series.merge:
            add_states(spark, lake, ds, written(files.join(_state_files(spark, lake, ds), FILE, "left_anti").select(*FILE), "stateless"))
            daily = series.merge(only_months(_states_of(spark, lake, ds, files), months))
        else:
            raw = readers.read_union(spark, paths, list(series.numeric), declared=SC.raw_text(ds))
            daily = only_months(series.build(_between(raw, series.time_col, months)), months)
        out = sanitize_types(conform_declared(daily, SC.SILVER[ds]))
        if not whole:
            sinks.check_types(spark, lake.silver_table(ds), out.schema)  # before any file is touched
        fresh = sinks.stage_partitions(spark, out, lake.dest(ds))
        sinks.register_table(spark, lake.silver_table(ds), lake.dest(ds), out.schema, YM, replace=whole)
        sinks.switch_partitions(spark, lake.silver_table(ds), fresh)
        gone -= {(int(y), int(m)) for y, m in fresh}
    if spark.catalog.tableExists(lake.silver_table(ds)):
        for y, m in gone:
            sinks.drop_table_partition(spark, lake.silver_table(ds), lake.dest(ds), {"year": y, "month": m})
    return gone


def _months_by_file(dated: DataFrame, encoded: bool) -> DataFrame:
    """(k, months) of rows (path, d): one entry for each file and date, combined map-side, is all
    that leaves a task. Paths are spelled out for these entries, not for each row."""
    # the count keeps this aggregation: Spark removes one without below the set of months
    days = dated.groupBy("path", "d").agg(F.count("d").alias("n")).where("n > 0")
    months = days.select(_file_key(F.col("path"), encoded).alias("k"), (F.year("d") * 12 + F.month("d") - 1).alias("m"))
    return months.groupBy("k").agg(F.collect_set("m").alias("months"))


def load_series(spark: SparkSession, lake: Lake, ds: str, full: bool = False) -> list[tuple[int, int]]:
    """Incrementally load one daily silver series; returns the (year, month) pairs written."""
    ledger = _records(spark, lake.state(f"files/{ds}"), LEDGER)
    files = bronze_files(spark, lake, ds).drop("file_year")
    pending = written(files if full else files.join(ledger, ["path", "length", "mtime"], "left_anti"), "pending-files")
    paths = [r["path"] for r in pending.select("path").collect()]  # file names only
    if not paths:
        return []
    if SERIES[ds].merge:
        if full:  # the record first: states without a record don't count
            sinks.drop_record(spark, lake.state(f"state_files/{ds}"))
            sinks.drop_folder(spark, lake.state(f"states/{ds}"))
        add_states(spark, lake, ds, pending.join(_state_files(spark, lake, ds), FILE, "left_anti"))
        dated = _states_of(spark, lake, ds, pending).select("path", F.col("event_date").alias("d"))
    else:
        raw = _read_new(spark, lake, ds, pending, paths)
        dated = raw.select(F.col("_path").alias("path"), SERIES[ds].date(raw).alias("d"))
    news = pending.withColumn("k", _file_key(F.col("path"))).join(_months_by_file(dated, encoded=not SERIES[ds].merge), "k", "left")
    news = written(news.select("path", "length", "mtime", F.coalesce("months", F.array().cast("array<int>")).alias("months")), "new-files")
    codes = lambda df: {(r["c"] // 12, r["c"] % 12 + 1) for r in df.select(F.explode("months").alias("c")).distinct().collect()}
    in_years = lambda ms: {m for m in ms if lake.years is None or lake.years[0] <= m[0] <= lake.years[1]}
    new_months = in_years(codes(news))
    old = ledger.join(news.select("path").distinct(), "path", "left_semi") if not full else ledger
    old_months = in_years(codes(old))
    touched = sorted(new_months | old_months)
    gone = rebuild_months(spark, lake, ds, touched, old_months - new_months, whole=full, news=news)
    if ds == "generation":
        _record_state_names(spark, lake, touched, gone)
    version = _log_change(spark, lake, ds, [(y, m, (y, m) not in gone) for y, m in touched])
    done = news.withColumns({"version": F.lit(version).cast("long"), "loaded_at": F.lit(time.time_ns() // 1000), "all_months": F.lit(True)})
    _record(done, lake.state(f"files/{ds}"))
    return touched


def _record_state_names(spark: SparkSession, lake: Lake, months: list[tuple[int, int]], gone: set[tuple[int, int]]) -> None:
    """Keep the state-name map of each month, so that the whole map is read from a small table."""
    if not months:
        return
    dest = lake.state("state_names")
    rows = only_months(spark.table(lake.silver_table("generation")), months)
    sinks.write_partitioned(gold.state_names(rows, YM), dest)
    for y, m in gone:
        sinks.drop_partition_folder(spark, dest, {"year": y, "month": m})


def load_register(spark: SparkSession, lake: Lake, ds: str, force: bool = False) -> bool:
    """Load a static register unless a completed copy exists (``force`` rebuilds it)."""
    dest = lake.dest(ds)
    if not force and sinks.is_complete(spark, dest) and not _records(spark, lake.state("changes"), CHANGES).where(F.col("dataset") == ds).isEmpty():
        return False
    src = lake.src(ds)
    raw = readers.read_csv(spark, src) if ds in CSV_REGISTERS else readers.read_parquet(spark, src)
    register = REGISTERS[ds](conform_declared(raw, SC.raw_text(ds)))
    if lost := lost_values(register, SC.SILVER[ds]):
        raise ValueError(f"{ds}: values that are not of the declared types: {lost}")
    register = conform_declared(register, SC.SILVER[ds])
    sinks.write_dimension(register, dest)
    sinks.register_table(spark, lake.silver_table(ds), dest, sanitize_types(register).schema, replace=True)
    _log_change(spark, lake, ds, [(None, None, True)])
    return True


def run_silver(spark: SparkSession, lake: Lake, datasets: Iterable[str] | None = None, full: bool = False) -> dict:
    """Load the given (default: all) datasets; series report the months written, registers
    whether they were (re)loaded."""
    sinks.create_database(spark, lake.database, f"{lake.gold.rstrip('/')}/_database")
    load = lambda ds: load_series(spark, lake, ds, full) if ds in SERIES else load_register(spark, lake, ds, force=full)
    loaded = {}
    for ds in datasets or [*SERIES, *REGISTERS]:
        loaded[ds] = load(ds)
        _merge_records(spark, {lake.state(f"files/{ds}"): LEDGER, lake.state(f"state_files/{ds}"): STATE_FILES, lake.state(f"rejected_files/{ds}"): STATE_FILES})
    _merge_records(spark, {lake.state("changes"): CHANGES, lake.state("plants"): PLANTS})
    return loaded


def silver_frames(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The loaded silver tables, from the catalog."""
    return {ds: spark.table(lake.silver_table(ds)) for ds in SILVER_TABLES if spark.catalog.tableExists(lake.silver_table(ds))}


# --- gold ---------------------------------------------------------------------------------
@dataclass
class GoldState:
    """What gold has to catch up with: the latest change of each month and register, and the
    version that each table was built up to. Read once for a run; sized by months."""

    changes: list
    progress: dict[str, int]

    @classmethod
    def read(cls, spark: SparkSession, lake: Lake) -> GoldState:
        last = F.max(F.struct("version", "has_rows")).alias("last")
        changes = _records(spark, lake.state("changes"), CHANGES).groupBy("dataset", "year", "month").agg(last).collect()
        progress = _records(spark, lake.gold_state("progress"), PROGRESS).groupBy("table").agg(F.max("version").alias("v")).collect()
        return cls(changes, {r["table"]: r["v"] for r in progress if spark.catalog.tableExists(lake.gold_table(r["table"]))})

    def pending(self, table: str) -> tuple[bool, dict[tuple[int, int], bool], int]:
        """(rebuild whole, months to rewrite, version they lead up to). The months tell whether
        the driving series has rows there."""
        mine = [r for r in self.changes if r["dataset"] in GOLD_INPUTS[table]]
        upto = max((r["last"]["version"] for r in mine), default=0)
        done = self.progress.get(table)
        news = [r for r in mine if done is not None and r["last"]["version"] > done]
        if done is None or any(r["year"] is None for r in news):
            return True, {}, upto
        driver = GOLD_INPUTS[table][0]
        months = {(r["year"], r["month"]): True for r in news}
        months |= {(r["year"], r["month"]): r["last"]["has_rows"] for r in news if r["dataset"] == driver}
        return False, months, upto


def _names(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.parquet(lake.state("state_names")).select("id_estado", "nom_estado").distinct()


def _names_changed(spark: SparkSession, lake: Lake) -> bool:
    """Whether the state-name map differs from the one that the bridge was last built with."""
    path = lake.gold_state("bridge_names")
    if not sinks.is_complete(spark, path):
        return True
    now, then = _names(spark, lake), spark.read.parquet(path)
    return not (now.exceptAll(then).isEmpty() and then.exceptAll(now).isEmpty())


def _frame(spark: SparkSession, lake: Lake, s: dict[str, DataFrame], table: str, state: GoldState | None = None) -> DataFrame:
    if table == "gold_dim_tempo":
        return gold.dim_time(s["weather"], s["generation"], s["load"], s["hydrology"])
    if table == LOCATION:
        return gold.dim_location(s["stations"], s["municipalities"])
    if table == "gold_dim_usina":
        return gold.dim_plant(s["capacity"], s["modality"])
    if table == "gold_fato_eficiencia_hidro":
        return gold.hydro_efficiency(s["generation"], s["hydrology"])
    if table != BRIDGE:
        ds = GOLD_INPUTS[table][0]
        return gold.fact(s[ds], ds)
    stale, _, _ = (state or GoldState.read(spark, lake)).pending(LOCATION)
    location = written(_frame(spark, lake, s, LOCATION), "location") if stale else spark.table(lake.gold_table(LOCATION))
    return gold.bridge(s["weather"], written(gold.places(location, _names(spark, lake)), "places"), s["generation"], s["load"])


def _calendar(spark: SparkSession, lake: Lake, s: dict[str, DataFrame], months: list[tuple[int, int]]) -> DataFrame:
    """The calendar with the dates of these months anew; other dates are taken over."""
    old = spark.table(lake.gold_table("gold_dim_tempo"))
    keep = old.where(~F.array_contains(F.array(*[F.lit(y * 12 + m) for y, m in months]), F.col("ano") * 12 + F.col("mes")))
    fresh = gold.dim_time(*[only_months(s[ds], months) for ds in GOLD_INPUTS["gold_dim_tempo"]])
    return written(keep.unionByName(fresh.select(*old.columns)), "calendar")  # not read while it is replaced


def _build(spark: SparkSession, lake: Lake, table: str, s: dict[str, DataFrame], state: GoldState, whole: bool, months: dict[tuple[int, int], bool]) -> None:
    name, path = lake.gold_table(table), lake.gold_path(table)
    if whole:
        sinks.create_table(spark, _frame(spark, lake, s, table, state), name, path=path, partition_by=None if table in DIMENSIONS else YM)
    elif table in DIMENSIONS:
        sinks.create_table(spark, _calendar(spark, lake, s, sorted(months)), name, path=path)
    else:
        sinks.overwrite_table_partitions(spark, only_months(_frame(spark, lake, s, table, state), sorted(months)), name, path)
        for y, m in (ym for ym, has_rows in months.items() if not has_rows):
            sinks.drop_table_partition(spark, name, path, {"year": y, "month": m})


def _backfill(spark: SparkSession, lake: Lake, table: str, frame: DataFrame, years: set[str]) -> None:
    """Rewrite the partitions of these years, and remove those that have no row any more."""
    name, path = lake.gold_table(table), lake.gold_path(table)
    sinks.overwrite_table_partitions(spark, frame, name, path)
    kept = {(r["year"], r["month"]) for r in frame.select(*YM).distinct().collect()}  # months
    for part in sinks.partitions_of(spark, name):
        if part["year"] in years and (part["year"], part["month"]) not in kept:
            sinks.drop_table_partition(spark, name, path, part)


def _backfill_by_year(spark: SparkSession, lake: Lake, name: str, table: str, frame: DataFrame, years: list[int], upto: int) -> bool:
    """Rewrite these years of a table one after the other, each recorded when it is done, and
    none that this backfill has already done from the same silver (``upto``); whether any was."""
    record = lake.gold_state("backfills")
    mine = _records(spark, record, BACKFILLS).where((F.col("name") == name) & (F.col("table") == table) & (F.col("version") == upto))
    done = {r["year"] for r in mine.select("year").distinct().collect()}  # years
    todo = [y for y in years if y not in done]
    for y in todo:
        _backfill(spark, lake, table, only_years(frame, [y]), {str(y)})
        _record(spark.createDataFrame([(name, table, y, upto)], BACKFILLS), record)
    return bool(todo)


def run_gold(
    spark: SparkSession,
    lake: Lake,
    tables: Iterable[str] | None = None,
    years: Iterable[int] | None = None,
    full: bool = False,
    backfill: str | None = None,
) -> list[str]:
    """Bring gold tables (default: all, the location dimension before the bridge) up to date
    with silver; returns those that were written.

    A table is built whole the first time, after a register changed, with ``full``, and the
    bridge also when the state-name map changed; otherwise only its pending months are
    rewritten, and the filter reaches the silver scans as partition filters. Progress is
    recorded after each table. ``years`` is the historical backfill: it rewrites these years of
    the existing partitioned tables and leaves the recorded progress alone. With a name in
    ``backfill`` it goes year by year and keeps what it has done, so that a run of the same name
    goes on where the last one failed; years whose silver changed since are done again.
    """
    s, years = silver_frames(spark, lake), None if years is None else sorted(set(years))
    state, built = GoldState.read(spark, lake), []
    for table in tables or GOLD_TABLES:
        whole, months, upto = state.pending(table)
        if years is not None and not whole:
            if table not in DIMENSIONS and backfill is not None:
                if _backfill_by_year(spark, lake, backfill, table, _frame(spark, lake, s, table, state), years, upto):
                    built.append(table)
            elif table not in DIMENSIONS:
                _backfill(spark, lake, table, only_years(_frame(spark, lake, s, table, state), years), {str(y) for y in years})
                built.append(table)
            continue
        whole = whole or full or (table == BRIDGE and _names_changed(spark, lake))
        if not whole and not months:
            continue
        _build(spark, lake, table, s, state, whole, months)
        if table == BRIDGE:
            _names(spark, lake).write.mode("overwrite").parquet(lake.gold_state("bridge_names"))
        _record(spark.createDataFrame([(table, upto)], PROGRESS), lake.gold_state("progress"))
        state.progress[table] = upto
        built.append(table)
    _merge_records(spark, {lake.gold_state("progress"): PROGRESS, lake.gold_state("backfills"): BACKFILLS})
    return built


def run(spark: SparkSession, lake: Lake, full: bool = False, datasets: Iterable[str] | None = None, tables: Iterable[str] | None = None) -> dict:
    """Silver for every (or the given) dataset, then gold. Incremental by default; with
    ``full`` all of silver is loaded again and every gold table is rebuilt."""
    loaded = run_silver(spark, lake, datasets, full=full)
    return {"silver": loaded, "gold": run_gold(spark, lake, tables, full=full)}


def local_lake(root: str) -> Lake:
    return Lake(bronze=os.path.join(root, "bronze"), silver=os.path.join(root, "silver"), gold=os.path.join(root, "gold"))
