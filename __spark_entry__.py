"""

``entry(spark)`` runs the flagship result (the weather x generation x load bridge) on
sf0.001; ``queries()`` has one callable per operator / result of SURVEY §2 (each reads the
driver tables through ``ecoflux.sources.adapters`` and runs the library on the whole
tables); ``oracle_sql()`` gives, for the same keys, an independent DuckDB formulation
over the raw driver tables.

Comparison surface: double columns are rounded half-up to 6 decimals with the same
arithmetic on both sides (``floor(x * 1e6 + 0.5) / 1e6``), so sums taken in different
orders compare equal.
"""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoflux.functions import utc_reading_ts, utc_to_local
from ecoflux.operators import dictionary, incremental, rejects
from ecoflux import schemas as SC
from ecoflux.operators.shaping import (
    add_year_month,
    cast_decimal_comma,
    drop_all_null,
    only_years,
    sanitize_types,
    select_existing,
    to_event_date,
)
from ecoflux.plans import gold, pipeline, silver
from ecoflux.session import scratch_dir, written
from ecoflux.sources import adapters as A
from ecoflux.sources import readers, sinks

SF_SMOKE = "/root/testdata/sf0.001"


# ------------------------------------------------------------------------------------
# Spark side
# ------------------------------------------------------------------------------------
def _rounded(df: DataFrame) -> DataFrame:
    exprs = [
        f"floor(`{f.name}` * 1e6 + 0.5) / 1e6 AS `{f.name}`" if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
        for f in df.schema.fields
    ]
    return df.selectExpr(*exprs)


def _q(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _weather(spark, d):
    return silver.weather_daily(A.weather_raw(spark, d))


def _generation(spark, d):
    return silver.generation_daily(A.generation_raw(spark, d))


def _generation_orders(spark, d):
    return silver.generation_daily(A.generation_raw_orders(spark, d))


def _hydrology(spark, d):
    return silver.hydrology(A.hydrology_raw(spark, d))


def _load_orders(spark, d):
    return silver.load(A.load_raw_orders(spark, d))


def _load_events(spark, d):
    return silver.load(A.load_raw_events(spark, d))


def _location(spark, d):
    return gold.dim_location(silver.stations(A.stations_raw(spark, d)), silver.municipalities(A.municipalities_raw(spark, d)))


def q_select_existing(spark, d):
    """Keep listed columns that exist, in list order."""
    return select_existing(
        A.table(spark, d, "orders"), ["o_orderkey", "o_orderstatus", "o_not_there", "o_totalprice", "o_orderpriority"]
    )


def q_decimal_comma(spark, d):
    """Decimal-comma text (incl. blank, padded and malformed) and double input -> double."""
    li = A.table(spark, d, "lineitem")
    ln = F.col("l_linenumber")
    text = (
        F.when(ln == 7, F.lit("1.234,56"))
        .when(ln == 6, F.lit(""))
        .when(ln == 5, F.concat(F.lit(" "), A.comma(F.col("l_tax")), F.lit(" ")))
        .otherwise(A.comma(F.col("l_extendedprice")))
    )
    df = li.select("l_orderkey", "l_linenumber", text.alias("valor_texto"), F.col("l_discount").alias("valor_num"))
    return cast_decimal_comma(df, ["valor_texto", "valor_num"])


def q_event_date_year_month(spark, d):
    """event_date from a timestamp, source column dropped, int year/month."""
    o = A.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("din_instante"))
    return add_year_month(to_event_date(o))


def q_drop_all_null(spark, d):
    """rows whose columns are all null are dropped."""
    e = A.table(spark, d, "events")
    k = F.col("event_id") % 3
    df = e.select(
        F.when(k == 0, F.lit(None)).otherwise(F.col("event_type")).alias("a"),
        F.when(k != 2, F.lit(None)).otherwise(F.col("value")).alias("b"),
        F.when(k == 0, F.lit(None)).otherwise(F.col("user_id")).alias("c"),
    )
    return drop_all_null(df)


def q_sanitize_types(spark, d):
    """K3: timestamp columns stored as text."""
    return sanitize_types(A.table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"))


def q_hour_to_local_date(spark, d):
    """UTC date + hour text -> local date (malformed hours give null)."""
    w = A.weather_raw(spark, d)
    utc = utc_reading_ts("data", "hora")
    local = utc_to_local(utc)
    return w.select(
        "event_id",
        F.to_date(local).alias("event_date"),
        F.hour(local).cast("int").alias("hora_local"),
    )


def q_weather_daily(spark, d):
    """Hourly UTC weather -> station x local day."""
    return _weather(spark, d)


def q_generation_daily(spark, d):
    """Hourly generation -> day x subsystem x state x type."""
    return _generation(spark, d)


def q_hydrology_daily(spark, d):
    """Daily hydrology, 14 measures to double."""
    return _hydrology(spark, d)


def q_load_daily(spark, d):
    """Daily load."""
    return _load_orders(spark, d)


def q_capacity_dim(spark, d):
    """T4: capacity register."""
    return silver.capacity(A.capacity_raw(spark, d))


def q_modality_dim(spark, d):
    """T5: modality register."""
    return silver.modality(A.modality_raw(spark, d))


def q_stations_dim(spark, d):
    """Station register."""
    return silver.stations(A.stations_raw(spark, d))


def q_municipalities_dim(spark, d):
    """Municipality register."""
    return silver.municipalities(A.municipalities_raw(spark, d))


def q_dim_time(spark, d):
    """Calendar over four silver tables."""
    return gold.dim_time(_weather(spark, d), _generation(spark, d), _load_orders(spark, d), _hydrology(spark, d))


def q_dim_location(spark, d):
    """Stations LEFT JOIN municipalities on int keys."""
    return _location(spark, d)


def q_dim_plant(spark, d):
    """Capacity LEFT JOIN modality on ceg, coalesced, distinct."""
    return gold.dim_plant(silver.capacity(A.capacity_raw(spark, d)), silver.modality(A.modality_raw(spark, d)))


def q_fact_weather(spark, d):
    """G4/P6."""
    return gold.fact(_weather(spark, d), "weather")


def q_fact_generation(spark, d):
    """G5/P6."""
    return gold.fact(_generation(spark, d), "generation")


def q_fact_hydrology(spark, d):
    """G6/P6."""
    return gold.fact(_hydrology(spark, d), "hydrology")


def q_fact_load(spark, d):
    """G7/P6."""
    return gold.fact(_load_orders(spark, d), "load")


def q_hydro_efficiency(spark, d):
    """Hydro productivity per day and subsystem."""
    return gold.hydro_efficiency(_generation_orders(spark, d), _hydrology(spark, d))


def q_plant_class_pivot(spark, d):
    """Generation per day/state/subsystem pivoted into plant classes."""
    return gold.generation_by_state(_generation(spark, d))


def q_weather_generation_bridge(spark, d):
    """The flagship bridge, from the written location dimension and daily generation
    (as the lake does it): generation is parsed once, and the join with the weather sees the
    real size of its small side."""
    generation = written(_generation(spark, d).drop("qtd_usinas_ativas"), "generation")
    places = written(gold.places(written(_location(spark, d), "location"), gold.state_names(generation)), "places")
    return gold.bridge(_weather(spark, d), places, generation, _load_events(spark, d))


def q_year_backfill(spark, d):
    """A fact restricted to given years."""
    return only_years(gold.fact(_hydrology(spark, d), "hydrology"), [1996, 1997, 1998])


def q_pending_partitions(spark, d):
    """Source months (lineitem) not yet in a written silver table (orders load)."""
    dest = scratch_dir(spark, "pending")
    sinks.write_partitioned(_load_orders(spark, d), dest)
    source = incremental.months_of(to_event_date(A.table(spark, d, "lineitem").select(F.col("l_shipdate").alias("din_instante"))))
    return incremental.pending(source, incremental.loaded(spark, dest))


def q_partitioned_roundtrip(spark, d):
    """year=/month= write with dynamic overwrite, read back with partition discovery."""
    dest = scratch_dir(spark, "roundtrip")
    sinks.write_partitioned(_load_orders(spark, d), dest)
    return spark.read.parquet(dest)


def q_table_append(spark, d):
    """K4-K8/K6: create a partitioned catalog table from early years, append the rest."""
    fact = gold.fact(_load_orders(spark, d), "load")
    name = f"ecoflux_fact_load_{uuid.uuid4().hex[:8]}"
    path = scratch_dir(spark, "table")
    sinks.create_table(spark, fact.where(F.col("year") < "1997"), name, path=path, partition_by=["year", "month"])
    sinks.append_years(fact.where(F.col("year") >= "1997"), name)
    return spark.table(name)


def q_table_append_retry(spark, d):
    """K6: the later years are appended as one batch, and then once more, as after a failure."""
    fact = gold.fact(_load_orders(spark, d), "load")
    name = f"ecoflux_fact_load_{uuid.uuid4().hex[:8]}"
    path = scratch_dir(spark, "table")
    early = fact.where(F.col("year") < "1997").withColumn("batch", F.lit("first"))
    sinks.create_table(spark, early, name, path=path, partition_by=["year", "month", "batch"])
    for _ in range(2):
        sinks.append_batch(fact.where(F.col("year") >= "1997"), name, path, "later")
    return spark.table(name).drop("batch")


def q_csv_roundtrip(spark, d):
    """A register landed as headered CSV and gzip CSV, read back with inferred types."""
    src = A.municipalities_raw(spark, d)
    plain = scratch_dir(spark, "csv")
    gz = scratch_dir(spark, "csvgz")
    readers.extract_table(src, plain)
    src.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(gz)
    a = silver.municipalities(readers.read_csv(spark, plain)).withColumn("fonte", F.lit("csv"))
    b = silver.municipalities(readers.read_csv(spark, gz)).withColumn("fonte", F.lit("csv.gz"))
    return a.unionByName(b)


def q_scan_years(spark, d):
    """Entries named by year, scanned for 1996-1998 plus undated entries."""
    root = scratch_dir(spark, "bronze")
    o = A.table(spark, d, "orders")
    entry = F.when(F.col("o_orderstatus") == "P", F.lit("orders_pending.parquet")).otherwise(
        F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string"), F.lit(".parquet"))
    )
    o.select("o_orderkey", "o_totalprice", entry.alias("entry")).write.partitionBy("entry").parquet(root)
    return readers.scan_years(spark, root, 1996, 1998).select("o_orderkey", "o_totalprice", "file_year")


def q_extract_year(spark, d):
    """Table landed per year with its time column as text."""
    dest = scratch_dir(spark, "extract")
    e = A.table(spark, d, "events").select(
        "event_id", F.col("ts").alias("hora"), F.year("ts").cast("int").alias("ano"), "value"
    )
    readers.extract_year(e, dest)
    return spark.read.parquet(dest).select("event_id", "hora", F.col("ano").cast("int").alias("ano"), "value")


def q_extract_years(spark, d):
    """Only the asked years are landed, and landing again replaces them."""
    dest = scratch_dir(spark, "extract-years")
    o = A.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("hora"), F.year("o_orderdate").cast("int").alias("ano"))
    for years in ([1995, 1996], [1996, 1997]):
        readers.extract_year(o, dest, years=years)
    return spark.read.parquet(dest).select("o_orderkey", "hora", F.col("ano").cast("int").alias("ano"))


def q_data_dictionary(spark, d):
    """M1-M3: per-column type and completeness."""
    return dictionary.describe(A.table(spark, d, "orders"))


def q_schema_drift_union(spark, d):
    """One series delivered in two layouts (measures as decimal-comma text in one group of
    files, as doubles in the other), scanned per group, normalised and unioned by name."""
    raw = A.hydrology_raw(spark, d)
    text_dir, num_dir = scratch_dir(spark, "drift-text"), scratch_dir(spark, "drift-num")
    is_f = F.col("nom_subsistema") == "SUB_F"
    raw.where(is_f).write.parquet(text_dir)
    cast_decimal_comma(raw.where(~is_f), SC.HYDRO_MEASURES).write.parquet(num_dir)
    return silver.hydrology(readers.read_union(spark, [text_dir, num_dir], SC.HYDRO_MEASURES))


def q_data_dictionary_csv(spark, d):
    """M2: dictionary of a CSV register with inferred types."""
    dest = scratch_dir(spark, "dict-csv")
    readers.extract_table(A.table(spark, d, "customer"), dest)
    return dictionary.describe(readers.read_csv(spark, dest))


def q_data_dictionary_comments(spark, d):
    """M1: descriptions declared in the schema go into the dictionary."""
    c = A.table(spark, d, "customer")
    said = {"c_custkey": "Chave do cliente", "c_mktsegment": "Segmento de mercado"}
    return dictionary.describe(c.select(*[F.col(n).alias(n, metadata={"comment": said[n]} if n in said else {}) for n in c.columns]))


def q_dictionary_document(spark, d):
    """M3: the dictionary as a JSON document, read back."""
    dest = scratch_dir(spark, "document")
    dictionary.write_document(A.table(spark, d, "orders"), dest, "Dicionario orders", {"o_orderkey": "Chave"})
    return spark.read.json(dest).select("titulo", F.posexplode("campos").alias("posicao", "c")).select("titulo", "posicao", "c.*")


def _new_lake(spark, name, **how):
    root = scratch_dir(spark, name)
    return pipeline.Lake(f"{root}/bronze", f"{root}/silver", f"{root}/gold", database=f"ecoflux_{uuid.uuid4().hex[:8]}", **how)


def _land(lake, df, ds, col, mode="append"):
    """Deliver ``df`` as one entry for each year of ``col``."""
    entry = F.concat(F.lit(ds + "_"), F.year(col).cast("string"), F.lit(".parquet"))
    with sinks.unsorted_writes(df.sparkSession):
        df.withColumn("entry", entry).write.mode(mode).partitionBy("entry").parquet(lake.src(ds))


def _land_registers(spark, d, lake):
    A.stations_raw(spark, d).write.option("header", True).option("compression", "gzip").csv(lake.src("stations"))
    A.municipalities_raw(spark, d).write.option("header", True).csv(lake.src("municipalities"))
    A.capacity_raw(spark, d).write.parquet(lake.src("capacity"))
    A.modality_raw(spark, d).write.parquet(lake.src("modality"))


def q_pipeline_bridge(spark, d):
    """O1: all eight datasets from bronze files through silver to all nine gold tables; returns
    the gold bridge table."""
    lake = _new_lake(spark, "lake")
    _land(lake, A.load_raw_events(spark, d), "load", "din_instante")
    _land(lake, A.generation_raw(spark, d), "generation", "din_instante")
    _land(lake, A.weather_raw(spark, d).drop("event_id"), "weather", F.to_date("data"))
    _land(lake, A.hydrology_raw(spark, d), "hydrology", "din_instante")
    _land_registers(spark, d, lake)
    pipeline.run(spark, lake)
    return spark.table(lake.gold_table(pipeline.BRIDGE))


def q_pipeline_incremental(spark, d):
    """Two deliveries, no gold run after the second (as if it had failed), a corrected
    register, and then an ordinary run: gold equals a one-shot build."""
    lake = _new_lake(spark, "incremental")
    first = F.col("event_id") % 2 == 0
    weather = A.weather_raw(spark, d)
    odd = F.dayofmonth("din_instante") % 2 == 1
    _land(lake, A.load_raw_events(spark, d).where(odd), "load", "din_instante")
    _land(lake, A.generation_raw(spark, d).where(odd), "generation", "din_instante")
    _land(lake, weather.where(first).drop("event_id"), "weather", F.to_date("data"))
    _land(lake, A.hydrology_raw(spark, d), "hydrology", "din_instante")
    _land_registers(spark, d, lake)
    register = A.stations_raw(spark, d)
    register.withColumn("estacao", F.lit("?")).write.mode("overwrite").option("header", True).csv(lake.src("stations"))
    pipeline.run(spark, lake)
    _land(lake, A.load_raw_events(spark, d).where(~odd), "load", "din_instante")
    _land(lake, A.generation_raw(spark, d).where(~odd), "generation", "din_instante")
    _land(lake, weather.where(~first).drop("event_id"), "weather", F.to_date("data"))
    pipeline.run_silver(spark, lake)
    register.write.mode("overwrite").option("header", True).csv(lake.src("stations"))
    pipeline.load_register(spark, lake, "stations", force=True)
    pipeline.run(spark, lake)
    return spark.table(lake.gold_table(pipeline.BRIDGE))


def q_late_file_load(spark, d):
    """Files that arrive late with older file times are loaded like any other."""
    lake = _new_lake(spark, "late")
    orders, late = A.load_raw_orders(spark, d), F.month("din_instante") == 6
    _land(lake, orders.where(~late), "load", "din_instante")
    pipeline.run_silver(spark, lake, ["load"])
    _land(lake, orders.where(late), "load", "din_instante")
    known = pipeline.bronze_files(spark, lake, "load").orderBy(F.desc("mtime")).select("path", "mtime").collect()
    fs, _ = sinks._file_system(spark, lake.bronze)
    for r in known:  # a few files of this fixture: the late ones get a time ten days before the others
        if r["mtime"] > known[len(known) // 2]["mtime"]:
            fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(r["path"]), r["mtime"] // 1000 - 10 * 86_400_000, -1)
    pipeline.run_silver(spark, lake, ["load"])
    return spark.table(lake.silver_table("load"))


def q_weather_states_late_file(spark, d):
    """Two deliveries with readings of the same days, and after them a file that was
    replaced; daily weather is merged from the states of the files, each read once."""
    lake = _new_lake(spark, "states")
    raw = A.weather_raw(spark, d)
    part = lambda n: raw.where(F.col("event_id") % 3 == n).drop("event_id")
    part(0).write.parquet(lake.src("weather") + "/a.parquet")
    part(1).where("hora < '06'").write.parquet(lake.src("weather") + "/b.parquet")
    pipeline.run_silver(spark, lake, ["weather"])
    part(1).write.mode("overwrite").parquet(lake.src("weather") + "/b.parquet")
    part(2).write.parquet(lake.src("weather") + "/c.parquet")
    pipeline.run_silver(spark, lake, ["weather"])
    return spark.table(lake.silver_table("weather"))


def q_generation_states_late_file(spark, d):
    """Deliveries that share plants and days; the daily count of distinct plants is
    merged from the bitmaps that each file left, each file read once."""
    lake = _new_lake(spark, "bitmaps")
    raw = A.generation_raw(spark, d)
    turn = F.dayofyear("din_instante") + F.hour("din_instante")
    for n in range(3):
        raw.where(turn % 3 == n).write.parquet(f"{lake.src('generation')}/{n}.parquet")
        if n != 1:  # two of the files come in one load
            pipeline.run_silver(spark, lake, ["generation"])
    return spark.table(lake.silver_table("generation"))


def q_rejected_readings(spark, d):
    """Weather files with hours that can't be read, loaded in two deliveries; the
    texts that were rejected, by month of the delivered date, and why."""
    lake = _new_lake(spark, "rejected", keep_rejected=True)
    raw = A.weather_raw(spark, d)
    for n in range(2):
        raw.where(F.col("event_id") % 2 == n).drop("event_id").write.parquet(f"{lake.src('weather')}/{n}.parquet")
        pipeline.run_silver(spark, lake, ["weather"])
    day = F.get_json_object("reading", "$.data")
    found = pipeline.rejected_readings(spark, lake, "weather")
    return found.groupBy("column", "reason", F.substring(day, 1, 7).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("path").alias("files"), F.min("text").alias("first_text"), F.max("text").alias("last_text")
    )


def q_readings_split(spark, d):
    """Hydrology in one pass with two sinks; readings of each, and the problems of the
    rejected ones by column and reason."""
    raw = A.hydrology_raw(spark, d)
    when = [rejects.time_problem(["din_instante"], F.to_date("din_instante"))]
    tagged = rejects.with_problems(raw, [*when, *rejects.number_problems(raw, SC.HYDRO_MEASURES)])
    kept, rejected = sinks.split_rows(tagged, F.size(rejects.PROBLEMS) > 0)
    count = lambda df, sink, *cols: df.groupBy(F.lit(sink).alias("sink"), *cols).agg(F.count(F.lit(1)).alias("n"))
    none = [F.lit("").alias(c) for c in ("column", "text", "reason")]
    return (
        count(kept, "readings", *none)
        .unionByName(count(rejected, "rejected", *none))
        .unionByName(count(rejects.lines(rejected), "problems", "column", "text", "reason"))
    )


def q_data_dictionary_running(spark, d):
    """M1: types and completeness of a dataset after two deliveries, a replaced file and a column
    that only the later files have, from the profiles of the files, each read once."""
    lake = _new_lake(spark, "profile")
    raw = A.load_raw_orders(spark, d)
    to = lambda df, n: df.write.mode("overwrite").parquet(f"{lake.src('load')}/{n}.parquet")
    half = F.col("id_subsistema") == "F"
    to(raw.where(half).drop("nom_subsistema"), "a")
    to(raw, "b")
    pipeline.profile_files(spark, lake, "load")
    to(raw.where(~half), "b")
    return pipeline.data_dictionary(spark, lake, "load", SC.LOAD_COLS, {"din_instante": "Data"})


def q_lake_schema_drift(spark, d):
    """Yearly files whose measures change from text to double, and a column that comes
    late, through the silver load."""
    lake = _new_lake(spark, "drift")
    raw = A.hydrology_raw(spark, d)
    text = F.year("din_instante") % 2 == 0
    _land(lake, raw.where(text).drop("val_vazaooutrasestruturas"), "hydrology", "din_instante")
    _land(lake, cast_decimal_comma(raw.where(~text), SC.HYDRO_MEASURES), "hydrology", "din_instante")
    pipeline.run_silver(spark, lake, ["hydrology"])
    return spark.table(lake.silver_table("hydrology"))


def q_lake_key_type_change(spark, d):
    """A key that is text in one delivery, an integer in the next and a double in a
    third stays one key, in a table of the declared types."""
    lake = _new_lake(spark, "key-type")
    raw = A.load_raw_events(spark, d).withColumn("id_subsistema", F.substring("id_subsistema", 2, 1))
    turn = F.dayofyear("din_instante") % 3
    for n, kind in enumerate(("string", "bigint", "double")):
        some = raw.where(turn == n).withColumn("id_subsistema", F.col("id_subsistema").cast(kind))
        _land(lake, some, "load", "din_instante")
        pipeline.run_silver(spark, lake, ["load"])
    return spark.table(lake.silver_table("load"))


def q_year_end_delivery(spark, d):
    """I4: a file whose first UTC hours belong to the local year before the ingest range."""
    lake = _new_lake(spark, "year-end", years=(2024, 2024))
    _land(lake, A.weather_raw(spark, d).drop("event_id"), "weather", F.to_date("data"))
    pipeline.run_silver(spark, lake, ["weather"])
    return spark.table(lake.silver_table("weather"))


def q_backfill_resumed(spark, d):
    """I4: a backfill by years in two runs of one name, the second of which does the years that
    the first was not asked for; the fact table afterwards."""
    lake = _new_lake(spark, "backfill")
    _land(lake, A.load_raw_orders(spark, d), "load", "din_instante")
    pipeline.run_silver(spark, lake, ["load"])
    pipeline.run_gold(spark, lake, ["gold_fato_carga"])
    for years in ([1993, 1995], range(1993, 1997)):
        pipeline.run_gold(spark, lake, ["gold_fato_carga"], years=years, backfill="correction")
    return spark.table(lake.gold_table("gold_fato_carga"))


def q_register_skip(spark, d):
    """A register that is present is not loaded again."""
    lake = _new_lake(spark, "register")
    A.modality_raw(spark, d).write.parquet(lake.src("modality"))
    pipeline.run_silver(spark, lake, ["modality"])
    A.modality_raw(spark, d).withColumn("nom_usina", F.lit("other")).write.mode("overwrite").parquet(lake.src("modality"))
    pipeline.run_silver(spark, lake, ["modality"])
    return spark.table(lake.silver_table("modality"))


_QUERIES = {
    "select_existing": q_select_existing,
    "decimal_comma": q_decimal_comma,
    "event_date_year_month": q_event_date_year_month,
    "drop_all_null": q_drop_all_null,
    "sanitize_types": q_sanitize_types,
    "hour_to_local_date": q_hour_to_local_date,
    "weather_daily": q_weather_daily,
    "generation_daily": q_generation_daily,
    "hydrology_daily": q_hydrology_daily,
    "load_daily": q_load_daily,
    "capacity_dim": q_capacity_dim,
    "modality_dim": q_modality_dim,
    "stations_dim": q_stations_dim,
    "municipalities_dim": q_municipalities_dim,
    "dim_time": q_dim_time,
    "dim_location": q_dim_location,
    "dim_plant": q_dim_plant,
    "fact_weather": q_fact_weather,
    "fact_generation": q_fact_generation,
    "fact_hydrology": q_fact_hydrology,
    "fact_load": q_fact_load,
    "hydro_efficiency": q_hydro_efficiency,
    "plant_class_pivot": q_plant_class_pivot,
    "weather_generation_bridge": q_weather_generation_bridge,
    "year_backfill": q_year_backfill,
    "pending_partitions": q_pending_partitions,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "table_append": q_table_append,
    "table_append_retry": q_table_append_retry,
    "csv_roundtrip": q_csv_roundtrip,
    "scan_years": q_scan_years,
    "extract_year": q_extract_year,
    "data_dictionary": q_data_dictionary,
    "schema_drift_union": q_schema_drift_union,
    "data_dictionary_csv": q_data_dictionary_csv,
    "pipeline_bridge": q_pipeline_bridge,
    "pipeline_incremental": q_pipeline_incremental,
    "late_file_load": q_late_file_load,
    "weather_states_late_file": q_weather_states_late_file,
    "generation_states_late_file": q_generation_states_late_file,
    "rejected_readings": q_rejected_readings,
    "readings_split": q_readings_split,
    "data_dictionary_running": q_data_dictionary_running,
    "lake_schema_drift": q_lake_schema_drift,
    "lake_key_type_change": q_lake_key_type_change,
    "year_end_delivery": q_year_end_delivery,
    "backfill_resumed": q_backfill_resumed,
    "register_skip": q_register_skip,
    "extract_years": q_extract_years,
    "data_dictionary_comments": q_data_dictionary_comments,
    "dictionary_document": q_dictionary_document,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: weather x generation x load bridge on sf0.001."""
    return queries()["weather_generation_bridge"](spark, SF_SMOKE)


def _llm() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the ``llm`` subpackage and its pipeline; nothing if they are absent."""
    try:
        import corpus_pipeline
        from ecoflux.llm import oracle
        from ecoflux.llm import queries as llm
    except ImportError as e:
        warnings.warn(f"queries of the llm subpackage are left out: {e}", stacklevel=2)
        return {}, {}
    sql = oracle.ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return llm.QUERIES | {"pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _q(v) for k, v in _QUERIES.items()} | _llm()[0]


# ------------------------------------------------------------------------------------
# DuckDB oracle side (independent SQL over the raw driver tables)
# ------------------------------------------------------------------------------------
def _c(x: str) -> str:
    """number -> decimal-comma text with 2 decimals"""
    return f"replace(CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR), '.', ',')"


def _n(x: str) -> str:
    """decimal-comma text -> double (lenient)"""
    return f"TRY_CAST(replace(CAST({x} AS VARCHAR), ',', '.') AS DOUBLE)"


def _ym(d: str) -> str:
    return f"CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month"


_CTE = {
    "fx_weather": f"""
        SELECT 'E' || CAST(user_id % 120 AS VARCHAR) AS id_estacao,
               strftime(ts, '%Y-%m-%d') AS data,
               CASE WHEN event_id % 50 = 0 THEN '1200'
                    ELSE strftime(ts, '%H') || ':00:00' || CASE WHEN user_id % 2 = 0 THEN ' UTC' ELSE '' END
               END AS hora,
               CASE WHEN event_id % 7 = 0 THEN NULL ELSE {_c('value')} END AS precipitacao_total,
               CASE WHEN event_type = 'error' THEN NULL ELSE {_c('value')} END AS radiacao_global,
               {_c('value')} AS temperatura_bulbo_hora,
               value AS vento_velocidade,
               event_id
        FROM events""",
    "fx_generation": f"""
        SELECT ts AS din_instante,
               'S' || CAST(user_id % 2 AS VARCHAR) AS id_subsistema,
               'SUB' || CAST(user_id % 2 AS VARCHAR) AS nom_subsistema,
               CAST(user_id % 4 AS VARCHAR) AS id_estado,
               CASE user_id % 4 WHEN 0 THEN 'AFRICA' WHEN 1 THEN 'AMERICA' WHEN 2 THEN 'ASIA' ELSE 'AFRICA' END AS nom_estado,
               CASE event_type WHEN 'click' THEN 'Eólica' WHEN 'purchase' THEN 'Solar Fotovoltaica'
                               WHEN 'view' THEN 'Hidrelétrica' WHEN 'signup' THEN 'Térmica'
                               WHEN 'error' THEN 'Nuclear' END AS nom_tipousina,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'U' || CAST(user_id AS VARCHAR) END AS nom_usina,
               {_c('value')} AS val_geracao
        FROM events""",
    "fx_load_ev": f"""
        SELECT 'S' || CAST(user_id % 2 AS VARCHAR) AS id_subsistema,
               'SUB' || CAST(user_id % 2 AS VARCHAR) AS nom_subsistema,
               ts AS din_instante, {_c('value')} AS val_cargaenergiamwmed
        FROM events""",
    "fx_stations": """
        SELECT CAST(CASE WHEN s_suppkey % 5 = 0 THEN s_nationkey + 100 ELSE s_nationkey END AS INTEGER) AS id_municipio,
               'E' || CAST(s_suppkey AS VARCHAR) AS id_estacao, s_name AS estacao,
               DATE '2006-07-25' AS data_fundacao, s_acctbal AS latitude,
               CAST(s_suppkey AS DOUBLE) AS longitude, CAST(NULL AS DOUBLE) AS altitude
        FROM supplier""",
    "fx_municipalities": """
        SELECT CAST(n_nationkey AS INTEGER) AS id_municipio, n_name AS nome, substr(r_name, 1, 2) AS sigla_uf,
               r_name AS nome_uf, r_name AS nome_regiao
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fx_hydro": f"""
        SELECT 'R' || CAST(l_suppkey AS VARCHAR) AS id_reservatorio,
               'RES_' || CAST(l_suppkey AS VARCHAR) AS nom_reservatorio,
               'BACIA_' || l_returnflag AS nom_bacia, 'SUB_' || l_linestatus AS nom_subsistema,
               'REE_' || l_returnflag AS nom_ree, l_returnflag AS tip_reservatorio,
               l_linenumber AS num_ordemcs, l_partkey AS cod_usina, l_shipdate AS din_instante,
               {_c('l_quantity')} AS val_nivelmontante, {_c('l_discount')} AS val_niveljusante,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE {_c('l_tax')} END AS val_volumeutilcon,
               {_c('l_extendedprice')} AS val_vazaoafluente,
               CASE WHEN l_suppkey % 9 = 0 THEN '0' WHEN l_suppkey % 13 = 0 THEN {_c('-l_quantity')}
                    ELSE {_c('l_quantity')} END AS val_vazaoturbinada,
               {_c('l_tax')} AS val_vazaovertida, CAST(NULL AS VARCHAR) AS val_vazaooutrasestruturas,
               {_c('l_discount')} AS val_vazaodefluente, l_discount AS val_vazaotransferida,
               {_c('l_extendedprice')} AS val_vazaonatural, '' AS val_vazaoartificial,
               {_c('l_quantity')} AS val_vazaoincremental, {_c('l_tax')} AS val_vazaoevaporacaoliquida,
               CASE WHEN l_linenumber = 6 THEN '1.234,56' ELSE {_c('l_tax')} END AS val_vazaousoconsuntivo
        FROM lineitem""",
    "fx_gen_ord": f"""
        SELECT o_orderdate AS din_instante, o_orderstatus AS id_subsistema,
               'SUB_' || o_orderstatus AS nom_subsistema,
               CAST(o_custkey % 3 AS VARCHAR) AS id_estado, 'UF' || CAST(o_custkey % 3 AS VARCHAR) AS nom_estado,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Hidrelétrica' ELSE 'HIDRELÉTRICA' END AS nom_tipousina,
               'U' || CAST(o_custkey AS VARCHAR) AS nom_usina, {_c('o_totalprice')} AS val_geracao
        FROM orders""",
    "fx_load_ord": f"""
        SELECT o_orderstatus AS id_subsistema, 'SUB_' || o_orderstatus AS nom_subsistema,
               o_orderdate AS din_instante, {_c('o_totalprice')} AS val_cargaenergiamwmed
        FROM orders""",
    "fx_capacity": f"""
        SELECT p_type AS id_subsistema, p_type AS nom_subsistema,
               CASE WHEN p_size < 10 THEN NULL ELSE p_brand END AS id_estado, p_brand AS nom_estado,
               p_type AS nom_tipousina, p_name AS nom_usina,
               CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE 'C' || CAST(p_partkey // 3 AS VARCHAR) END AS ceg,
               'O' || CAST(p_partkey AS VARCHAR) AS id_ons,
               CASE WHEN p_size > 40 THEN NULL ELSE 'TIPO I' END AS nom_modalidadeoperacao,
               {_c('p_retailprice')} AS val_potenciaefetiva,
               '2000-01-01' AS dat_entradaoperacao, CAST(NULL AS VARCHAR) AS dat_desativacao
        FROM part""",
    "fx_modality": f"""
        SELECT s_name AS nom_usina, 'C' || CAST(s_suppkey // 2 AS VARCHAR) AS ceg,
               'O' || CAST(s_suppkey AS VARCHAR) AS id_ons, 'TIPO II' AS nom_modalidadeoperacao,
               {_c('s_acctbal')} AS val_potenciaautorizada,
               CAST(s_nationkey AS VARCHAR) AS id_estado, CAST(s_nationkey AS VARCHAR) AS nom_estado,
               CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'OK' END AS sts_aneel
        FROM supplier""",
    # ---- silver ------------------------------------------------------------------
    "w_parsed": f"""
        SELECT id_estacao, event_id,
               {_n('precipitacao_total')} AS p, {_n('radiacao_global')} AS r,
               {_n('temperatura_bulbo_hora')} AS t, CAST(vento_velocidade AS DOUBLE) AS v,
               try_strptime(concat_ws(' ', strftime(TRY_CAST(data AS DATE), '%Y-%m-%d'),
                                      regexp_replace(hora, '\\s*UTC\\s*', '', 'g')),
                            '%Y-%m-%d %H:%M:%S') AS ts_utc
        FROM fx_weather""",
    "w_local": """
        SELECT *, CAST(timezone('America/Sao_Paulo', timezone('UTC', ts_utc)) AS DATE) AS event_date
        FROM w_parsed WHERE ts_utc IS NOT NULL""",
    "s_weather": f"""
        SELECT id_estacao, event_date,
               sum(p) AS precipitacao_total, avg(r) AS radiacao_global,
               avg(t) AS temperatura_media, max(t) AS temperatura_maxima, min(t) AS temperatura_minima,
               avg(v) AS vento_velocidade_media, 'America/Sao_Paulo' AS timezone, {_ym('event_date')}
        FROM w_local GROUP BY id_estacao, event_date""",
    "s_generation": f"""
        SELECT event_date, id_subsistema, nom_subsistema, id_estado, nom_estado, nom_tipousina,
               sum(v) AS val_geracao_total_mwmed, count(DISTINCT nom_usina) AS qtd_usinas_ativas,
               {_ym('event_date')}
        FROM (SELECT *, CAST(din_instante AS DATE) AS event_date, {_n('val_geracao')} AS v FROM fx_generation)
        WHERE event_date IS NOT NULL
        GROUP BY event_date, id_subsistema, nom_subsistema, id_estado, nom_estado, nom_tipousina""",
    "s_gen_ord": f"""
        SELECT event_date, id_subsistema, nom_subsistema, id_estado, nom_estado, nom_tipousina,
               sum(v) AS val_geracao_total_mwmed, count(DISTINCT nom_usina) AS qtd_usinas_ativas,
               {_ym('event_date')}
        FROM (SELECT *, CAST(din_instante AS DATE) AS event_date, {_n('val_geracao')} AS v FROM fx_gen_ord)
        WHERE event_date IS NOT NULL
        GROUP BY event_date, id_subsistema, nom_subsistema, id_estado, nom_estado, nom_tipousina""",
    "s_hydro": f"""
        SELECT id_reservatorio, nom_reservatorio, nom_bacia, nom_subsistema, nom_ree, tip_reservatorio,
               CAST(num_ordemcs AS DOUBLE) AS num_ordemcs, CAST(cod_usina AS DOUBLE) AS cod_usina,
               {_n('val_nivelmontante')} AS val_nivelmontante, {_n('val_niveljusante')} AS val_niveljusante,
               {_n('val_volumeutilcon')} AS val_volumeutilcon, {_n('val_vazaoafluente')} AS val_vazaoafluente,
               {_n('val_vazaoturbinada')} AS val_vazaoturbinada, {_n('val_vazaovertida')} AS val_vazaovertida,
               {_n('val_vazaooutrasestruturas')} AS val_vazaooutrasestruturas,
               {_n('val_vazaodefluente')} AS val_vazaodefluente,
               CAST(val_vazaotransferida AS DOUBLE) AS val_vazaotransferida,
               {_n('val_vazaonatural')} AS val_vazaonatural, {_n('val_vazaoartificial')} AS val_vazaoartificial,
               {_n('val_vazaoincremental')} AS val_vazaoincremental,
               {_n('val_vazaoevaporacaoliquida')} AS val_vazaoevaporacaoliquida,
               {_n('val_vazaousoconsuntivo')} AS val_vazaousoconsuntivo,
               CAST(din_instante AS DATE) AS event_date, {_ym('din_instante')}
        FROM fx_hydro WHERE din_instante IS NOT NULL""",
    "s_load_ord": f"""
        SELECT id_subsistema, nom_subsistema, {_n('val_cargaenergiamwmed')} AS val_cargaenergiamwmed,
               CAST(din_instante AS DATE) AS event_date, {_ym('din_instante')}
        FROM fx_load_ord WHERE din_instante IS NOT NULL""",
    "s_load_ev": f"""
        SELECT id_subsistema, nom_subsistema, {_n('val_cargaenergiamwmed')} AS val_cargaenergiamwmed,
               CAST(din_instante AS DATE) AS event_date, {_ym('din_instante')}
        FROM fx_load_ev WHERE din_instante IS NOT NULL""",
    "s_stations": """
        SELECT id_estacao, id_municipio, estacao, data_fundacao, CAST(latitude AS DOUBLE) AS latitude,
               CAST(longitude AS DOUBLE) AS longitude, CAST(altitude AS DOUBLE) AS altitude
        FROM fx_stations""",
    "s_capacity": f"""
        SELECT id_subsistema, nom_subsistema, id_estado, nom_estado, nom_tipousina, nom_usina, ceg, id_ons,
               nom_modalidadeoperacao, {_n('val_potenciaefetiva')} AS val_potenciaefetiva,
               dat_entradaoperacao, dat_desativacao
        FROM fx_capacity""",
    "s_modality": f"""
        SELECT nom_usina, ceg, id_ons, nom_modalidadeoperacao, {_n('val_potenciaautorizada')} AS val_potenciaautorizada,
               id_estado, nom_estado, sts_aneel
        FROM fx_modality""",
    # ---- gold --------------------------------------------------------------------
    "g_location": """
        SELECT DISTINCT e.id_estacao, CAST(e.id_municipio AS INTEGER) AS id_municipio, e.estacao, e.data_fundacao,
               e.latitude, e.longitude, e.altitude, m.nome AS nome_municipio, m.sigla_uf, m.nome_uf, m.nome_regiao
        FROM s_stations e
        LEFT JOIN fx_municipalities m ON CAST(e.id_municipio AS INTEGER) = CAST(m.id_municipio AS INTEGER)
        WHERE e.id_estacao IS NOT NULL""",
    # straight from the hourly rows, without the daily step
    "g_by_state": f"""
        SELECT h.din_instante::DATE AS event_date, h.nom_estado, h.nom_subsistema,
               sum(h.v) FILTER (regexp_matches(h.nom_tipousina, 'E[óo]lica')) AS geracao_eolica_mwmed,
               sum(h.v) FILTER (regexp_matches(h.nom_tipousina, 'Solar|Fotovolt')) AS geracao_solar_mwmed,
               sum(h.v) FILTER (contains(h.nom_tipousina, 'Hidrel')) AS geracao_hidro_mwmed,
               sum(h.v) FILTER (regexp_matches(h.nom_tipousina, 'T[ée]rmica')) AS geracao_termica_mwmed,
               sum(h.v) AS geracao_total_mwmed, {_ym('any_value(h.din_instante)')}
        FROM (SELECT *, {_n('val_geracao')} AS v FROM fx_generation WHERE din_instante IS NOT NULL) AS h
        GROUP BY ALL""",
}

_CTE_ORDER = list(_CTE)


def _with(body: str, *ctes: str) -> str:
    """Prefix ``body`` with the named CTEs and every CTE they reference (in definition order)."""
    need: set[str] = set()

    def visit(name: str) -> None:
        if name in need:
            return
        need.add(name)
        for other in _CTE_ORDER:
            if other != name and re.search(rf"\b{other}\b", _CTE[name]):
                visit(other)

    for c in ctes:
        visit(c)
    parts = [f"{n} AS ({_CTE[n]}\n)" for n in _CTE_ORDER if n in need]
    goes_on = re.match(r"\w+ AS \(", body)  # the body begins with CTEs of its own
    return ("WITH " + ",\n".join(parts) + (",\n" if goes_on else "\n") if parts else "") + body


def _round(sql: str, cols: list[str]) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"floor({c} * CAST(1000000 AS DOUBLE) + 0.5) / CAST(1000000 AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


_WEATHER_D = ["precipitacao_total", "radiacao_global", "temperatura_media", "temperatura_maxima",
              "temperatura_minima", "vento_velocidade_media"]
_HYDRO_D = ["num_ordemcs", "cod_usina", "val_nivelmontante", "val_niveljusante", "val_volumeutilcon",
            "val_vazaoafluente", "val_vazaoturbinada", "val_vazaovertida", "val_vazaooutrasestruturas",
            "val_vazaodefluente", "val_vazaotransferida", "val_vazaonatural", "val_vazaoartificial",
            "val_vazaoincremental", "val_vazaoevaporacaoliquida", "val_vazaousoconsuntivo"]
_PIVOT_D = ["geracao_eolica_mwmed", "geracao_solar_mwmed", "geracao_hidro_mwmed", "geracao_termica_mwmed",
            "geracao_total_mwmed"]
_HYDRO_FACT_SELECT = ", ".join(
    ["id_reservatorio", "nom_reservatorio", "nom_bacia", "nom_subsistema", "nom_ree", "tip_reservatorio",
     "num_ordemcs", "cod_usina", "event_date", *_HYDRO_D[2:],
     "CAST(year AS VARCHAR) AS year", "CAST(month AS VARCHAR) AS month"]
)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["select_existing"] = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
    q["decimal_comma"] = _round(
        f"""
        SELECT l_orderkey, l_linenumber,
               TRY_CAST(replace(CASE WHEN l_linenumber = 7 THEN '1.234,56'
                                     WHEN l_linenumber = 6 THEN ''
                                     WHEN l_linenumber = 5 THEN ' ' || {_c('l_tax')} || ' '
                                     ELSE {_c('l_extendedprice')} END, ',', '.') AS DOUBLE) AS valor_texto,
               CAST(l_discount AS DOUBLE) AS valor_num
        FROM lineitem""",
        ["valor_texto", "valor_num"],
    )
    q["event_date_year_month"] = f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date, {_ym('o_orderdate')} FROM orders"
    q["drop_all_null"] = _round(
        """
        SELECT * FROM (
          SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS a,
                 CASE WHEN event_id % 3 <> 2 THEN NULL ELSE value END AS b,
                 CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS c
          FROM events)
        WHERE NOT (a IS NULL AND (b IS NULL OR isnan(b)) AND c IS NULL)""",
        ["b"],
    )
    q["sanitize_types"] = _round(
        "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_totalprice FROM orders",
        ["o_totalprice"],
    )
    q["hour_to_local_date"] = _with(
        """
        SELECT event_id, CAST(lt AS DATE) AS event_date, CAST(hour(lt) AS INTEGER) AS hora_local
        FROM (SELECT event_id, timezone('America/Sao_Paulo', timezone('UTC', ts_utc)) AS lt FROM w_parsed)""",
        "w_parsed",
    )
    q["weather_daily"] = _round(_with("SELECT * FROM s_weather", "s_weather"), _WEATHER_D)
    q["generation_daily"] = _round(_with("SELECT * FROM s_generation", "s_generation"), ["val_geracao_total_mwmed"])
    q["hydrology_daily"] = _round(_with("SELECT * FROM s_hydro", "s_hydro"), _HYDRO_D)
    q["load_daily"] = _round(_with("SELECT * FROM s_load_ord", "s_load_ord"), ["val_cargaenergiamwmed"])
    q["capacity_dim"] = _round(_with("SELECT * FROM s_capacity", "s_capacity"), ["val_potenciaefetiva"])
    q["modality_dim"] = _round(_with("SELECT * FROM s_modality", "s_modality"), ["val_potenciaautorizada"])
    q["stations_dim"] = _round(_with("SELECT * FROM s_stations", "s_stations"), ["latitude", "longitude", "altitude"])
    q["municipalities_dim"] = _with("SELECT * FROM fx_municipalities", "fx_municipalities")
    q["dim_time"] = _with(
        """
        SELECT event_date,
               CAST(year(event_date) AS INTEGER) AS ano, CAST(quarter(event_date) AS INTEGER) AS trimestre,
               CAST(month(event_date) AS INTEGER) AS mes, monthname(event_date) AS nome_mes,
               CAST(day(event_date) AS INTEGER) AS dia, CAST(isodow(event_date) AS INTEGER) AS dia_semana_numero,
               dayname(event_date) AS nome_dia_semana, isodow(event_date) IN (6, 7) AS fim_de_semana
        FROM (SELECT event_date FROM s_weather UNION SELECT event_date FROM s_generation
              UNION SELECT event_date FROM s_load_ord UNION SELECT event_date FROM s_hydro)
        WHERE event_date IS NOT NULL""",
        "s_weather", "s_generation", "s_load_ord", "s_hydro",
    )
    q["dim_location"] = _round(_with("SELECT * FROM g_location", "g_location"), ["latitude", "longitude", "altitude"])
    q["dim_plant"] = _round(
        _with(
            """
            , matched AS (
                SELECT a.id_subsistema, a.nom_subsistema, ifnull(a.id_estado, b.id_estado) AS id_estado,
                       ifnull(a.nom_estado, b.nom_estado) AS nom_estado, a.nom_tipousina,
                       ifnull(a.nom_usina, b.nom_usina) AS nom_usina, ceg, b.id_ons,
                       ifnull(a.nom_modalidadeoperacao, b.nom_modalidadeoperacao) AS nom_modalidadeoperacao,
                       a.val_potenciaefetiva, b.val_potenciaautorizada, a.dat_entradaoperacao, a.dat_desativacao, b.sts_aneel
                FROM s_capacity AS a JOIN s_modality AS b USING (ceg)),
            alone AS (
                SELECT * EXCLUDE (id_ons), NULL AS id_ons, NULL AS val_potenciaautorizada, NULL AS sts_aneel
                FROM s_capacity AS a WHERE NOT EXISTS (FROM s_modality AS b WHERE b.ceg = a.ceg))
            FROM matched UNION BY NAME FROM alone""".strip().removeprefix(", "),
            "s_capacity", "s_modality",
        ),
        ["val_potenciaefetiva", "val_potenciaautorizada"],
    )
    q["fact_weather"] = _round(
        _with(
            "SELECT id_estacao, event_date, precipitacao_total, radiacao_global, temperatura_media, temperatura_maxima,"
            " temperatura_minima, vento_velocidade_media, timezone, CAST(year AS VARCHAR) AS year,"
            " CAST(month AS VARCHAR) AS month FROM s_weather WHERE event_date IS NOT NULL",
            "s_weather",
        ),
        _WEATHER_D,
    )
    q["fact_generation"] = _round(
        _with(
            "SELECT event_date, id_subsistema, nom_subsistema, id_estado, nom_estado, nom_tipousina,"
            " val_geracao_total_mwmed, qtd_usinas_ativas, CAST(year AS VARCHAR) AS year,"
            " CAST(month AS VARCHAR) AS month FROM s_generation WHERE event_date IS NOT NULL",
            "s_generation",
        ),
        ["val_geracao_total_mwmed"],
    )
    q["fact_hydrology"] = _round(
        _with(f"SELECT {_HYDRO_FACT_SELECT} FROM s_hydro WHERE event_date IS NOT NULL", "s_hydro"), _HYDRO_D
    )
    q["fact_load"] = _round(
        _with(
            "SELECT id_subsistema, nom_subsistema, event_date, val_cargaenergiamwmed, CAST(year AS VARCHAR) AS year,"
            " CAST(month AS VARCHAR) AS month FROM s_load_ord WHERE event_date IS NOT NULL",
            "s_load_ord",
        ),
        ["val_cargaenergiamwmed"],
    )
    # both inputs in one long table, aggregated once; a group counts if hydrology is in it
    q["hydro_efficiency"] = _round(
        _with(
            """
            SELECT event_date, nom_subsistema, sum(turb) AS val_vazaoturbinada_total, sum(aflu) AS val_vazaoafluente_total,
                   sum(deflu) AS val_vazaodefluente_total, avg(vol) AS val_volumeutilcon_medio, sum(ger) AS val_geracao_hidro_mwmed,
                   sum(ger) / nullif(greatest(sum(turb), 0), 0) AS eficiencia_mwmed_por_m3s,
                   year(event_date)::VARCHAR AS year, month(event_date)::VARCHAR AS month
            FROM (SELECT event_date, nom_subsistema, TRUE AS hydro, val_vazaoturbinada AS turb, val_vazaoafluente AS aflu,
                         val_vazaodefluente AS deflu, val_volumeutilcon AS vol, NULL AS ger FROM s_hydro
                  UNION ALL
                  SELECT event_date, nom_subsistema, FALSE, NULL, NULL, NULL, NULL, val_geracao_total_mwmed
                  FROM s_gen_ord WHERE contains(nom_tipousina, 'Hidrel')) AS rows
            WHERE event_date IS NOT NULL
            GROUP BY event_date, nom_subsistema
            HAVING bool_or(hydro)""",
            "s_hydro", "s_gen_ord",
        ),
        ["val_vazaoturbinada_total", "val_vazaoafluente_total", "val_vazaodefluente_total",
         "val_volumeutilcon_medio", "val_geracao_hidro_mwmed", "eficiencia_mwmed_por_m3s"],
    )
    q["plant_class_pivot"] = _round(_with("SELECT * FROM g_by_state", "g_by_state"), _PIVOT_D)
    # a station row is repeated by the number of ids of its state's name, counted once per name
    q["weather_generation_bridge"] = _round(
        _with(
            """
            , ids AS (SELECT nom_estado AS nome_uf, count(DISTINCT coalesce(id_estado, '-')) AS n FROM fx_generation
                      WHERE din_instante IS NOT NULL GROUP BY nom_estado),
            station AS (SELECT * EXCLUDE (n), unnest(range(coalesce(n, 1))) AS copy FROM g_location LEFT JOIN ids USING (nome_uf)),
            state AS (SELECT * EXCLUDE (nom_estado, year, month), nom_estado AS nome_uf FROM g_by_state),
            demand AS (SELECT event_date, nom_subsistema, sum(val_cargaenergiamwmed) AS val_cargaenergiamwmed FROM s_load_ev GROUP BY ALL)
            SELECT event_date, id_estacao, sigla_uf, nome_uf, nome_regiao, nome_municipio, latitude, longitude,
                   precipitacao_total, radiacao_global, temperatura_media, temperatura_maxima, temperatura_minima,
                   vento_velocidade_media, nom_subsistema, geracao_eolica_mwmed, geracao_solar_mwmed, geracao_hidro_mwmed,
                   geracao_termica_mwmed, geracao_total_mwmed, val_cargaenergiamwmed,
                   year(event_date)::VARCHAR AS year, month(event_date)::VARCHAR AS month
            FROM station JOIN s_weather USING (id_estacao)
            LEFT JOIN state USING (event_date, nome_uf)
            LEFT JOIN demand USING (event_date, nom_subsistema)
            WHERE event_date IS NOT NULL""".strip().removeprefix(", "),
            "s_weather", "g_location", "g_by_state", "s_load_ev",
        ),
        [*"latitude longitude".split(), *_WEATHER_D, *_PIVOT_D, "val_cargaenergiamwmed"],
    )
    q["year_backfill"] = _round(
        _with(
            f"SELECT {_HYDRO_FACT_SELECT} FROM s_hydro WHERE event_date IS NOT NULL AND year IN (1996, 1997, 1998)",
            "s_hydro",
        ),
        _HYDRO_D,
    )
    q["pending_partitions"] = f"""
        SELECT DISTINCT {_ym('l_shipdate')} FROM lineitem WHERE l_shipdate IS NOT NULL
        EXCEPT
        SELECT DISTINCT {_ym('o_orderdate')} FROM orders WHERE o_orderdate IS NOT NULL"""
    q["partitioned_roundtrip"] = q["load_daily"]
    q["table_append"] = q["fact_load"]
    q["table_append_retry"] = q["fact_load"]
    q["csv_roundtrip"] = _with(
        "SELECT *, 'csv' AS fonte FROM fx_municipalities UNION ALL SELECT *, 'csv.gz' AS fonte FROM fx_municipalities",
        "fx_municipalities",
    )
    q["scan_years"] = _round(
        """
        SELECT o_orderkey, o_totalprice,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS file_year
        FROM orders
        WHERE o_orderstatus = 'P' OR year(o_orderdate) BETWEEN 1996 AND 1998""",
        ["o_totalprice"],
    )
    q["extract_year"] = _round(
        "SELECT event_id, strftime(ts, '%H:%M:%S') AS hora, CAST(year(ts) AS INTEGER) AS ano, value FROM events",
        ["value"],
    )
    cols = [("o_orderkey", "INTEGER"), ("o_custkey", "INTEGER"), ("o_orderstatus", "STRING"),
            ("o_totalprice", "FLOAT"), ("o_orderdate", "DATE"), ("o_orderpriority", "STRING")]
    q["data_dictionary"] = "\nUNION ALL\n".join(
        f"SELECT CAST({i + 1} AS INTEGER) AS posicao, '{c}' AS codigo, '{t}' AS tipo, 'Campo {c}' AS descricao,"
        f" count(*) AS n_linhas, count({c}) AS n_preenchidos FROM orders"
        for i, (c, t) in enumerate(cols)
    )
    q["schema_drift_union"] = q["hydrology_daily"]
    ccols = [("c_custkey", "INTEGER"), ("c_name", "STRING"), ("c_nationkey", "INTEGER"),
             ("c_acctbal", "FLOAT"), ("c_mktsegment", "STRING")]
    q["data_dictionary_csv"] = "\nUNION ALL\n".join(
        f"SELECT CAST({i + 1} AS INTEGER) AS posicao, '{c}' AS codigo, '{t}' AS tipo, 'Campo {c}' AS descricao,"
        f" count(*) AS n_linhas, count({c}) AS n_preenchidos FROM customer"
        for i, (c, t) in enumerate(ccols)
    )
    q["pipeline_bridge"] = q["weather_generation_bridge"]
    q["pipeline_incremental"] = q["weather_generation_bridge"]
    q["late_file_load"] = q["load_daily"]
    q["weather_states_late_file"] = q["weather_daily"]
    q["generation_states_late_file"] = q["generation_daily"]
    q["rejected_readings"] = _with(
        """SELECT 'data+hora' AS "column", CASE WHEN data IS NULL OR hora IS NULL THEN 'no_time' ELSE 'time' END AS reason,
                  substr(data, 1, 7) AS month, count(*) AS n, count(DISTINCT event_id % 2) AS files,
                  min(concat_ws(' ', data, hora)) AS first_text, max(concat_ws(' ', data, hora)) AS last_text
           FROM fx_weather WHERE data IS NULL OR hora IS NULL OR hora = '1200' GROUP BY 1, 2, 3""",
        "fx_weather",
    )
    q["readings_split"] = """
        SELECT 'readings' AS sink, '' AS "column", '' AS text, '' AS reason, count(*) AS n FROM lineitem
        UNION ALL SELECT 'rejected', '', '', '', count(*) FROM lineitem WHERE l_linenumber = 6 OR l_shipdate IS NULL
        UNION ALL SELECT 'problems', 'val_vazaousoconsuntivo', '1.234,56', 'number', count(*) FROM lineitem WHERE l_linenumber = 6 HAVING count(*) > 0
        UNION ALL SELECT 'problems', 'din_instante', '', 'no_time', count(*) FROM lineitem WHERE l_shipdate IS NULL HAVING count(*) > 0"""
    q["data_dictionary_running"] = "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS posicao, '{c}' AS codigo, '{t}' AS tipo, '{text}' AS descricao,"
        f" count(*) AS n_linhas, count({source}) AS n_preenchidos FROM orders"
        for i, (c, t, text, source) in enumerate(
            [("id_subsistema", "STRING", "Campo id_subsistema", "o_orderstatus"),
             ("nom_subsistema", "STRING", "Campo nom_subsistema", "nullif(o_orderstatus, 'F')"),
             ("din_instante", "DATE", "Data", "o_orderdate"),
             ("val_cargaenergiamwmed", "STRING", "Campo val_cargaenergiamwmed", "o_totalprice")], 1)
    )
    q["lake_schema_drift"] = q["hydrology_daily"]
    q["lake_key_type_change"] = _round(
        _with("SELECT * REPLACE (substr(id_subsistema, 2, 1) AS id_subsistema) FROM s_load_ev", "s_load_ev"), ["val_cargaenergiamwmed"]
    )
    q["year_end_delivery"] = f"SELECT * FROM ({q['weather_daily']}) AS w WHERE year = 2024"
    q["backfill_resumed"] = q["fact_load"]
    q["register_skip"] = q["modality_dim"]
    q["extract_years"] = """
        SELECT o_orderkey, strftime(o_orderdate, '%H:%M:%S') AS hora, CAST(year(o_orderdate) AS INTEGER) AS ano
        FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997"""
    q["data_dictionary_comments"] = q["data_dictionary_csv"].replace("Campo c_custkey", "Chave do cliente").replace(
        "Campo c_mktsegment", "Segmento de mercado"
    )
    q["dictionary_document"] = "\nUNION ALL\n".join(
        f"SELECT 'Dicionario orders' AS titulo, CAST({i} AS INTEGER) AS posicao, '{c}' AS codigo, '{t}' AS tipo,"
        f" '{'Chave' if c == 'o_orderkey' else 'Campo ' + c}' AS descricao"
        for i, (c, t) in enumerate(cols)
    )
    return q | _llm()[1]
