"""Daily weather and generation as mergeable states: what each delivered file adds to a day.

A day's sums, counts, maxima and minima can be merged in any order, and so can the set of its
plants, kept as bitmaps over the numbers of a plant dictionary. A late file adds its own states
and no other file of the month is read again. Pure functions, no I/O.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoflux import schemas as SC
from ecoflux.functions import LOCAL_TZ, utc_reading_ts, utc_to_local
from ecoflux.operators.shaping import add_year_month, cast_decimal_comma, select_existing, to_event_date

#: Measures of a reading: each has a sum and a count of its readings in a state.
MEASURES = ["precipitacao_total", "radiacao_global", "temperatura_bulbo_hora", "vento_velocidade"]
_EXTREMES = "temperatura_bulbo_hora"
#: The kept states: the file and the load that read it, then what the file adds to a station's day.
WEATHER_STATES = ", ".join(
    ["path string, length long, mtime long, id_estacao string, event_date date"]
    + [f"{m}_sum double, {m}_count long" for m in MEASURES]
    + [f"{_EXTREMES}_max double, {_EXTREMES}_min double, year int, month int, load_id string"]
)


#: One row for each (file, day, group, bucket of plant numbers); ``plants`` has a bit for each plant.
GENERATION_STATES = ", ".join(
    ["path string, length long, mtime long, event_date date"]
    + [f"{k} string" for k in SC.GENERATION_KEYS[1:]]
    + ["plants_at long, val_geracao_sum double, plants binary, year int, month int, load_id string"]
)


def weather_states(raw: DataFrame, file_cols: list[str], tz: str = LOCAL_TZ) -> DataFrame:
    """Hourly UTC readings -> one state for each (file, station, local day), with ``year`` and
    ``month`` of the day. ``file_cols`` name the file. Readings whose time does not parse have
    no day and are left out."""
    df = cast_decimal_comma(select_existing(raw, [*file_cols, *SC.WEATHER_COLS]), MEASURES)
    missing = [c for c in MEASURES if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("double") for c in missing}) if missing else df
    df = df.withColumn("event_date", F.to_date(utc_to_local(utc_reading_ts("data", "hora"), tz)))
    parts = [f(m).alias(f"{m}_{name}") for m in MEASURES for f, name in ((F.sum, "sum"), (F.count, "count"))]
    extremes = [F.max(_EXTREMES).alias(f"{_EXTREMES}_max"), F.min(_EXTREMES).alias(f"{_EXTREMES}_min")]
    # filtered after the aggregation by a count, as in ``silver.weather_daily``: a filter on the
    # date would be pushed below it and parse every reading twice
    dated = F.count("event_date").alias("_dated")
    states = df.groupBy(*file_cols, "id_estacao", "event_date").agg(*parts, *extremes, dated).where("_dated > 0")
    return add_year_month(states.drop("_dated"))


def _mean(measure: str) -> Column:
    return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_count"))


def weather_from_states(states: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Merge states into the daily weather table (the columns of ``silver.weather_daily``). A
    measure without any reading on a day is null there."""
    days = states.groupBy("id_estacao", "event_date").agg(
        F.sum("precipitacao_total_sum").alias("precipitacao_total"),
        _mean("radiacao_global").alias("radiacao_global"),
        _mean(_EXTREMES).alias("temperatura_media"),
        F.max(f"{_EXTREMES}_max").alias("temperatura_maxima"),
        F.min(f"{_EXTREMES}_min").alias("temperatura_minima"),
        _mean("vento_velocidade").alias("vento_velocidade_media"),
    )
    return add_year_month(days.withColumn("timezone", F.lit(tz)))


def generation_by_plant(raw: DataFrame, file_cols: list[str]) -> DataFrame:
    """Hourly generation -> one row for each (file, day, group, plant) with the sum of its
    values. Readings without a date are left out; a plant without a name is a row of its own."""
    df = cast_decimal_comma(select_existing(raw, [*file_cols, *SC.GENERATION_COLS]), ["val_geracao"])
    kinds = {c: "string" for c in [*SC.GENERATION_KEYS[1:], "nom_usina"]} | {"val_geracao": "double"}
    missing = {c: F.lit(None).cast(t) for c, t in kinds.items() if c not in df.columns}
    df = to_event_date(df.withColumns(missing) if missing else df).where("event_date IS NOT NULL")
    return df.groupBy(*file_cols, *SC.GENERATION_KEYS, "nom_usina").agg(F.sum("val_geracao").alias("val_geracao_sum"))


def generation_states(by_plant: DataFrame, plants: DataFrame, file_cols: list[str]) -> DataFrame:
    """(file, day, group, plant) rows -> the kept states. ``plants`` is the dictionary
    (nom_usina, plant_id), which must know every name. A bitmap takes 32,768 numbers; plants
    without a name have no bit, and a bucket (null) for their sums."""
    # a left join: rows without a name stay, without a number
    known = by_plant.join(plants, "nom_usina", "left").withColumn("plants_at", F.bitmap_bucket_number("plant_id"))
    states = known.groupBy(*file_cols, *SC.GENERATION_KEYS, "plants_at").agg(
        F.sum("val_geracao_sum").alias("val_geracao_sum"),
        F.bitmap_construct_agg(F.bitmap_bit_position("plant_id")).alias("plants"),
    )
    return add_year_month(states)


def generation_from_states(states: DataFrame) -> DataFrame:
    """Merge states into the daily generation table (the columns of ``silver.generation_daily``).
    Bitmaps of a bucket are merged by OR, so a plant that several files have counts once."""
    parts = states.groupBy(*SC.GENERATION_KEYS, "plants_at").agg(
        F.sum("val_geracao_sum").alias("val_geracao_sum"), F.bitmap_or_agg("plants").alias("plants")
    )
    days = parts.groupBy(*SC.GENERATION_KEYS).agg(
        F.sum("val_geracao_sum").alias("val_geracao_total_mwmed"),
        F.sum(F.bitmap_count("plants")).alias("qtd_usinas_ativas"),
    )
    return add_year_month(days)
