"""Gold results: silver DataFrames -> star schema (dimensions, facts, indicators).

Pure functions, no I/O. Gold uses strict casts: bad values fail loudly, as a typed
warehouse load should. No join carries a broadcast hint: the dimensions read from files
are planned as broadcasts from their file sizes, and aggregated sides are turned into
broadcasts by AQE only after their *measured* size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` (sort-merge join otherwise, with AQE
skew splitting for hot keys, null keys included).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoflux import schemas as SC
from ecoflux.functions import (
    PLANT_CLASS_PATTERNS,
    is_weekend,
    iso_weekday,
    like_any,
    month_name,
    safe_ratio,
    weekday_name,
)
from ecoflux.operators.shaping import coalesce_pairs, conditional_sums, conform

YM = ["year", "month"]


def _ym_str(df: DataFrame) -> list:
    return [F.col("year").cast("string").alias("year"), F.col("month").cast("string").alias("month")]


def dim_time(*dated: DataFrame) -> DataFrame:
    """Calendar dimension over every date present in the given frames.

    One distinct over the union: Spark de-duplicates partially per input partition
    before the shuffle, so the exchange carries at most one row per date per task.
    """
    dates = reduce(lambda a, b: a.unionByName(b), [d.select("event_date") for d in dated])
    d = F.col("event_date")
    return (
        dates.where(d.isNotNull())
        .distinct()
        .select(
            d.cast("date").alias("event_date"),
            F.year(d).cast("int").alias("ano"),
            F.quarter(d).cast("int").alias("trimestre"),
            F.month(d).cast("int").alias("mes"),
            month_name(d).alias("nome_mes"),
            F.dayofmonth(d).cast("int").alias("dia"),
            iso_weekday(d).alias("dia_semana_numero"),
            weekday_name(d).alias("nome_dia_semana"),
            is_weekend(d).alias("fim_de_semana"),
        )
    )


def dim_location(stations: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Station dimension enriched with its municipality (LEFT: unknown municipality keeps
    the station with null names). Keys are compared as integers."""
    e = stations.where(F.col("id_estacao").isNotNull()).alias("e")
    m = municipalities.alias("d")
    joined = e.join(m, F.col("e.id_municipio").cast("int") == F.col("d.id_municipio").cast("int"), "left")
    return joined.select(
        F.col("e.id_estacao").cast("string").alias("id_estacao"),
        F.col("e.id_municipio").cast("int").alias("id_municipio"),
        F.col("e.estacao").alias("estacao"),
        F.col("e.data_fundacao").cast("date").alias("data_fundacao"),
        F.col("e.latitude").cast("double").alias("latitude"),
        F.col("e.longitude").cast("double").alias("longitude"),
        F.col("e.altitude").cast("double").alias("altitude"),
        F.col("d.nome").alias("nome_municipio"),
        F.col("d.sigla_uf").alias("sigla_uf"),
        F.col("d.nome_uf").alias("nome_uf"),
        F.col("d.nome_regiao").alias("nome_regiao"),
    ).distinct()


def dim_plant(capacity: DataFrame, modality: DataFrame) -> DataFrame:
    """Plant dimension: capacity register LEFT JOIN modality register on ``ceg``.

    Both sides are de-duplicated first; the join is many-to-many on purpose (a ``ceg``
    repeated on both sides multiplies), modality rows without a capacity row are not
    kept, and for shared attributes the capacity value wins (``coalesce``).
    """
    cap = capacity.select(
        "id_subsistema", "nom_subsistema", "id_estado", "nom_estado", "nom_tipousina", "nom_usina",
        "ceg", "nom_modalidadeoperacao", F.col("val_potenciaefetiva").cast("double").alias("val_potenciaefetiva"),
        "dat_entradaoperacao", "dat_desativacao",
    ).distinct().alias("c")
    mod = modality.select(
        "nom_usina", "ceg", "id_ons", "nom_modalidadeoperacao",
        F.col("val_potenciaautorizada").cast("double").alias("val_potenciaautorizada"),
        "id_estado", "nom_estado", "sts_aneel",
    ).distinct().alias("m")
    c = lambda n: F.col(f"c.{n}")
    m = lambda n: F.col(f"m.{n}")
    both = ["id_estado", "nom_estado", "nom_usina", "ceg", "nom_modalidadeoperacao"]
    shared = dict(zip(both, coalesce_pairs({n: c(n) for n in both}, {n: m(n) for n in both}, both)))
    from_modality = {"id_ons", "val_potenciaautorizada", "sts_aneel"}
    columns = [shared.get(n, (m if n in from_modality else c)(n).alias(n)) for n in SC.GOLD_DIM_PLANT_COLS]
    return cap.join(mod, c("ceg") == m("ceg"), "left").select(*columns).distinct()


def fact(silver: DataFrame, kind: str) -> DataFrame:
    """Typed pass-through fact (``weather``, ``generation``, ``hydrology``, ``load``):
    dated rows only, gold column order and types, ``year``/``month`` as text."""
    return conform(silver.where(F.col("event_date").isNotNull()), SC.GOLD_FACTS[kind])


def hydro_generation(generation: DataFrame) -> DataFrame:
    """Hydro generation per day and subsystem (types matching ``%Hidrel%``)."""
    return (
        generation.where(like_any("nom_tipousina", PLANT_CLASS_PATTERNS["hidro"]) & F.col("event_date").isNotNull())
        .groupBy("event_date", "nom_subsistema", *YM)
        .agg(F.sum(F.col("val_geracao_total_mwmed").cast("double")).alias("val_geracao_hidro_mwmed"))
    )


def hydrology_by_subsystem(hydrology: DataFrame) -> DataFrame:
    """Reservoir flows summed and useful volume averaged per day and subsystem."""
    v = lambda n: F.col(n).cast("double")
    return (
        hydrology.where(F.col("event_date").isNotNull())
        .groupBy("event_date", "nom_subsistema", *YM)
        .agg(
            F.sum(v("val_vazaoturbinada")).alias("val_vazaoturbinada_total"),
            F.sum(v("val_vazaoafluente")).alias("val_vazaoafluente_total"),
            F.sum(v("val_vazaodefluente")).alias("val_vazaodefluente_total"),
            F.avg(v("val_volumeutilcon")).alias("val_volumeutilcon_medio"),
        )
    )


def hydro_efficiency(generation: DataFrame, hydrology: DataFrame) -> DataFrame:
    """Hydro productivity: MWmed generated per m3/s turbined, per day and subsystem.

    Hydrology drives the grain (LEFT JOIN); subsystems are matched by name. The ratio is
    null when the turbined flow is null, zero or negative. ``year``/``month`` are join
    keys too (functions of the date, so the result is unchanged) which lets a year filter
    on the result prune both scans, and lets the join reuse the aggregations' hash
    partitioning instead of shuffling again.
    """
    h = hydrology_by_subsystem(hydrology).alias("h")
    g = hydro_generation(generation).alias("g")
    keys = ["event_date", "nom_subsistema", *YM]
    cond = reduce(lambda a, b: a & b, [F.col(f"h.{k}") == F.col(f"g.{k}") for k in keys])
    return h.join(g, cond, "left").select(
        F.col("h.event_date").alias("event_date"),
        F.col("h.nom_subsistema").alias("nom_subsistema"),
        F.col("h.val_vazaoturbinada_total").alias("val_vazaoturbinada_total"),
        F.col("h.val_vazaoafluente_total").alias("val_vazaoafluente_total"),
        F.col("h.val_vazaodefluente_total").alias("val_vazaodefluente_total"),
        F.col("h.val_volumeutilcon_medio").alias("val_volumeutilcon_medio"),
        F.col("g.val_geracao_hidro_mwmed").alias("val_geracao_hidro_mwmed"),
        safe_ratio(F.col("g.val_geracao_hidro_mwmed"), F.col("h.val_vazaoturbinada_total")).alias(
            "eficiencia_mwmed_por_m3s"
        ),
        F.col("h.year").cast("string").alias("year"),
        F.col("h.month").cast("string").alias("month"),
    )


def generation_by_state(generation: DataFrame, with_year_month: bool = True) -> DataFrame:
    """Daily generation per state and subsystem, pivoted into plant classes + total.

    A class with no matching rows is null (not 0); classes may overlap; types outside the
    four classes count only in the total.
    """
    classes = {f"geracao_{k}_mwmed": ("nom_tipousina", pats) for k, pats in PLANT_CLASS_PATTERNS.items()}
    keys = ["event_date", "nom_estado", "nom_subsistema", *(YM if with_year_month else [])]
    return conditional_sums(
        generation.where(F.col("event_date").isNotNull()),
        keys,
        F.col("val_geracao_total_mwmed").cast("double"),
        classes,
        total="geracao_total_mwmed",
    )


def state_names(generation: DataFrame, also: list[str] = ()) -> DataFrame:
    """Distinct (state id, state name, ``also``...) seen in generation (the name map)."""
    return (
        generation.where(F.col("nom_estado").isNotNull())
        .select(F.col("id_estado").cast("string").alias("id_estado"), "nom_estado", *also)
        .distinct()
    )


def load_by_subsystem(load: DataFrame) -> DataFrame:
    return (
        load.where(F.col("event_date").isNotNull())
        .groupBy("event_date", "nom_subsistema", *YM)
        .agg(F.sum(F.col("val_cargaenergiamwmed").cast("double")).alias("val_cargaenergiamwmed"))
    )


def places(location: DataFrame, names: DataFrame) -> DataFrame:
    """Stations with the state names that generation knows (LEFT, by exact name): one row for
    each state id of that name, one without a state where no name fits. Both sides are
    registers, so the result is small; write it before a join with the facts, so that the
    join sees its size and not the product of both."""
    loc, dp = location.alias("loc"), names.alias("dp")
    return loc.join(dp, F.col("loc.nome_uf") == F.col("dp.nom_estado"), "left").select(
        *[F.col(f"loc.{c}").alias(c) for c in ("id_estacao", "sigla_uf", "nome_uf", "nome_regiao", "nome_municipio", "latitude", "longitude")],
        F.col("dp.nom_estado").alias("nom_estado"),
    )


def bridge(weather: DataFrame, station_places: DataFrame, generation: DataFrame, load: DataFrame) -> DataFrame:
    """Weather x generation x load bridge, one row per station, day and matched subsystem.

    ``station_places`` (see :func:`places`) links a station to generation by the state
    *name*: a name with two ids repeats the row, a state present in two subsystems fans out
    once per subsystem, and load follows the generation row's subsystem. State-level
    measures repeat on every station of the state, so they are not additive over stations.
    Weather of stations without a place is not kept.
    """
    measures = ["precipitacao_total", "radiacao_global", "temperatura_media", "temperatura_maxima", "temperatura_minima", "vento_velocidade_media"]
    at = station_places.withColumnRenamed("id_estacao", "place_id")
    days = weather.where(F.col("event_date").isNotNull())
    days = days.join(at, days["id_estacao"].cast("string") == at["place_id"]).select(
        "event_date", "id_estacao", "sigla_uf", "nome_uf", "nome_regiao", "nome_municipio", "latitude", "longitude",
        *[F.col(c).cast("double").alias(c) for c in measures], *YM, "nom_estado",
    )
    out = days.join(generation_by_state(generation), ["event_date", "nom_estado", *YM], "left")
    out = out.join(load_by_subsystem(load), ["event_date", "nom_subsistema", *YM], "left")
    return out.select(*SC.GOLD_BRIDGE_COLS[:-2], *[F.col(c).cast("string").alias(c) for c in YM])
