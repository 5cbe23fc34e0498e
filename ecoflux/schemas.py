"""Column contracts of the bronze inputs and the silver / gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, DT, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType()

# --- fixed values: source column allow-lists, in source order -------------------------
HYDRO_MEASURES = [
    "val_nivelmontante", "val_niveljusante", "val_volumeutilcon",
    "val_vazaoafluente", "val_vazaoturbinada", "val_vazaovertida",
    "val_vazaooutrasestruturas", "val_vazaodefluente", "val_vazaotransferida",
    "val_vazaonatural", "val_vazaoartificial", "val_vazaoincremental",
    "val_vazaoevaporacaoliquida", "val_vazaousoconsuntivo",
]
HYDRO_COLS = [
    "id_reservatorio", "nom_reservatorio", "nom_bacia", "nom_subsistema", "nom_ree",
    "tip_reservatorio", "num_ordemcs", "cod_usina", "din_instante", *HYDRO_MEASURES,
]
LOAD_COLS = ["id_subsistema", "nom_subsistema", "din_instante", "val_cargaenergiamwmed"]
GENERATION_COLS = [
    "din_instante", "id_subsistema", "nom_subsistema", "id_estado", "nom_estado",
    "nom_tipousina", "nom_usina", "id_ons", "val_geracao",
]
CAPACITY_COLS = [
    "id_subsistema", "nom_subsistema", "id_estado", "nom_estado", "nom_tipousina",
    "nom_usina", "ceg", "id_ons", "nom_modalidadeoperacao", "val_potenciaefetiva",
    "dat_entradaoperacao", "dat_desativacao",
]
MODALITY_COLS = [
    "nom_usina", "ceg", "id_ons", "nom_modalidadeoperacao", "val_potenciaautorizada",
    "id_estado", "nom_estado", "sts_aneel",
]
WEATHER_COLS = [
    "id_estacao", "data", "hora", "precipitacao_total", "radiacao_global",
    "temperatura_bulbo_hora", "vento_velocidade",
]
STATION_COLS = ["id_estacao", "id_municipio", "estacao", "data_fundacao", "latitude", "longitude", "altitude"]
MUNICIPALITY_COLS = ["id_municipio", "nome", "sigla_uf", "nome_uf", "nome_regiao"]
GENERATION_KEYS = ["event_date", "id_subsistema", "nom_subsistema", "id_estado", "nom_estado", "nom_tipousina"]
# ------------------------------------------------------------------------------------


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- fixed values: declared columns of the silver tables (without year and month) -------
SILVER = {
    "hydrology": _st(
        ("id_reservatorio", S), ("nom_reservatorio", S), ("nom_bacia", S), ("nom_subsistema", S), ("nom_ree", S),
        ("tip_reservatorio", S), ("num_ordemcs", D), ("cod_usina", D), *[(m, D) for m in HYDRO_MEASURES], ("event_date", DT),
    ),
    "load": _st(("id_subsistema", S), ("nom_subsistema", S), ("val_cargaenergiamwmed", D), ("event_date", DT)),
    "generation": _st(
        ("event_date", DT), ("id_subsistema", S), ("nom_subsistema", S), ("id_estado", S), ("nom_estado", S),
        ("nom_tipousina", S), ("val_geracao_total_mwmed", D), ("qtd_usinas_ativas", L),
    ),
    "weather": _st(
        ("id_estacao", S), ("event_date", DT), ("precipitacao_total", D), ("radiacao_global", D), ("temperatura_media", D),
        ("temperatura_maxima", D), ("temperatura_minima", D), ("vento_velocidade_media", D), ("timezone", S),
    ),
    "capacity": _st(
        ("id_subsistema", S), ("nom_subsistema", S), ("id_estado", S), ("nom_estado", S), ("nom_tipousina", S),
        ("nom_usina", S), ("ceg", S), ("nom_modalidadeoperacao", S), ("val_potenciaefetiva", D),
        ("dat_entradaoperacao", S), ("dat_desativacao", S),
    ),
    "modality": _st(
        ("nom_usina", S), ("ceg", S), ("id_ons", S), ("nom_modalidadeoperacao", S), ("val_potenciaautorizada", D),
        ("id_estado", S), ("nom_estado", S), ("sts_aneel", S),
    ),
    "stations": _st(
        ("id_estacao", S), ("id_municipio", I), ("estacao", S), ("data_fundacao", DT), ("latitude", D), ("longitude", D), ("altitude", D),
    ),
    "municipalities": _st(("id_municipio", I), ("nome", S), ("sigla_uf", S), ("nome_uf", S), ("nome_regiao", S)),
}
# ------------------------------------------------------------------------------------
#: Text columns that are read but not written under their names, or not declared: keys and names all the same.
RAW_TEXT = _st(("nom_usina", S), ("id_ons", S))


def raw_text(dataset: str) -> T.StructType:
    """The columns of a raw delivery that are keys or names, whatever type it has them in."""
    return T.StructType([f for f in SILVER[dataset] if f.dataType == S] + list(RAW_TEXT))


YM_STR = (("year", S), ("month", S))

GOLD_FACT_WEATHER = _st(
    ("id_estacao", S), ("event_date", DT), ("precipitacao_total", D), ("radiacao_global", D),
    ("temperatura_media", D), ("temperatura_maxima", D), ("temperatura_minima", D),
    ("vento_velocidade_media", D), ("timezone", S), *YM_STR,
)
GOLD_FACT_GENERATION = _st(
    ("event_date", DT), ("id_subsistema", S), ("nom_subsistema", S), ("id_estado", S),
    ("nom_estado", S), ("nom_tipousina", S), ("val_geracao_total_mwmed", D),
    ("qtd_usinas_ativas", L), *YM_STR,
)
GOLD_FACT_HYDROLOGY = _st(
    ("id_reservatorio", S), ("nom_reservatorio", S), ("nom_bacia", S), ("nom_subsistema", S),
    ("nom_ree", S), ("tip_reservatorio", S), ("num_ordemcs", D), ("cod_usina", D),
    ("event_date", DT), *[(m, D) for m in HYDRO_MEASURES], *YM_STR,
)
GOLD_FACT_LOAD = _st(
    ("id_subsistema", S), ("nom_subsistema", S), ("event_date", DT), ("val_cargaenergiamwmed", D), *YM_STR,
)
GOLD_FACTS = {
    "weather": GOLD_FACT_WEATHER,
    "generation": GOLD_FACT_GENERATION,
    "hydrology": GOLD_FACT_HYDROLOGY,
    "load": GOLD_FACT_LOAD,
}

GOLD_DIM_TIME = _st(
    ("event_date", DT), ("ano", I), ("trimestre", I), ("mes", I), ("nome_mes", S), ("dia", I),
    ("dia_semana_numero", I), ("nome_dia_semana", S), ("fim_de_semana", B),
)
GOLD_DIM_LOCATION = _st(
    ("id_estacao", S), ("id_municipio", I), ("estacao", S), ("data_fundacao", DT), ("latitude", D),
    ("longitude", D), ("altitude", D), ("nome_municipio", S), ("sigla_uf", S), ("nome_uf", S),
    ("nome_regiao", S),
)
GOLD_DIM_PLANT_COLS = [
    "id_subsistema", "nom_subsistema", "id_estado", "nom_estado", "nom_tipousina", "nom_usina",
    "ceg", "id_ons", "nom_modalidadeoperacao", "val_potenciaefetiva", "val_potenciaautorizada",
    "dat_entradaoperacao", "dat_desativacao", "sts_aneel",
]
GOLD_HYDRO_EFFICIENCY_COLS = [
    "event_date", "nom_subsistema", "val_vazaoturbinada_total", "val_vazaoafluente_total",
    "val_vazaodefluente_total", "val_volumeutilcon_medio", "val_geracao_hidro_mwmed",
    "eficiencia_mwmed_por_m3s", "year", "month",
]
GOLD_BRIDGE_COLS = [
    "event_date", "id_estacao", "sigla_uf", "nome_uf", "nome_regiao", "nome_municipio",
    "latitude", "longitude", "precipitacao_total", "radiacao_global", "temperatura_media",
    "temperatura_maxima", "temperatura_minima", "vento_velocidade_media", "nom_subsistema",
    "geracao_eolica_mwmed", "geracao_solar_mwmed", "geracao_hidro_mwmed",
    "geracao_termica_mwmed", "geracao_total_mwmed", "val_cargaenergiamwmed", "year", "month",
]
