"""Adapters: the driver's test tables reshaped into source-shaped (bronze) inputs.

Pure projections over *whole* tables (no row filters): every edge case the source
data has (decimal-comma text, blank and malformed numbers, ``UTC``-suffixed and
malformed hours, null keys, a state with two ids and two subsystems, unknown
municipalities, stations without location, duplicate plant codes) is derived from
column values, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def comma(c: Column) -> Column:
    """Number -> its shortest decimal text with a decimal comma ("12,3")."""
    return F.translate(c.cast("string"), ".", ",")


def _comma(x: str) -> str:
    return f"translate(cast({x} AS STRING), '.', ',')"


# --- fixed values: plant type per event type, state name per state id ----------------
PLANT_TYPE_BY_EVENT = {
    "click": "Eólica",
    "purchase": "Solar Fotovoltaica",
    "view": "Hidrelétrica",
    "signup": "Térmica",
    "error": "Nuclear",
}
STATE_NAME_BY_ID = {0: "AFRICA", 1: "AMERICA", 2: "ASIA", 3: "AFRICA"}
# ------------------------------------------------------------------------------------


def _case(x: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN {k!r} THEN '{v}'" if isinstance(k, str) else f"WHEN {k} THEN '{v}'" for k, v in mapping.items())
    return f"CASE {x} {arms} END"


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly UTC station readings from ``events``."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('E', cast(user_id % 120 AS STRING)) AS id_estacao",
        "cast(to_date(ts) AS STRING) AS data",
        "CASE WHEN event_id % 50 = 0 THEN '1200' ELSE concat(lpad(cast(hour(ts) AS STRING), 2, '0'), ':00:00', "
        "CASE WHEN user_id % 2 = 0 THEN ' UTC' ELSE '' END) END AS hora",
        f"CASE WHEN event_id % 7 = 0 THEN NULL ELSE {_comma('value')} END AS precipitacao_total",
        f"CASE WHEN event_type = 'error' THEN NULL ELSE {_comma('value')} END AS radiacao_global",
        f"{_comma('value')} AS temperatura_bulbo_hora",
        "value AS vento_velocidade",
        "event_id",
    )


def generation_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly plant generation from ``events``."""
    return table(spark, sf_dir, "events").selectExpr(
        "ts AS din_instante",
        "concat('S', cast(user_id % 2 AS STRING)) AS id_subsistema",
        "concat('SUB', cast(user_id % 2 AS STRING)) AS nom_subsistema",
        "cast(user_id % 4 AS STRING) AS id_estado",
        f"{_case('user_id % 4', STATE_NAME_BY_ID)} AS nom_estado",
        f"{_case('event_type', PLANT_TYPE_BY_EVENT)} AS nom_tipousina",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE concat('U', cast(user_id AS STRING)) END AS nom_usina",
        "concat('O', cast(user_id AS STRING)) AS id_ons",
        f"{_comma('value')} AS val_geracao",
    )


def load_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly subsystem load from ``events``."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('S', cast(user_id % 2 AS STRING)) AS id_subsistema",
        "concat('SUB', cast(user_id % 2 AS STRING)) AS nom_subsistema",
        "ts AS din_instante",
        f"{_comma('value')} AS val_cargaenergiamwmed",
    )


def stations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station register from ``supplier``: every 5th station has an unknown municipality."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(CASE WHEN s_suppkey % 5 = 0 THEN s_nationkey + 100 ELSE s_nationkey END AS INT) AS id_municipio",
        "concat('E', cast(s_suppkey AS STRING)) AS id_estacao",
        "s_name AS estacao",
        "DATE'2006-07-25' AS data_fundacao",
        "s_acctbal AS latitude",
        "cast(s_suppkey AS DOUBLE) AS longitude",
        "cast(NULL AS DOUBLE) AS altitude",
    )


def municipalities_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipality register from ``nation`` x ``region`` (state = region name)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).selectExpr(
        "cast(n_nationkey AS INT) AS id_municipio",
        "n_name AS nome",
        "substring(r_name, 1, 2) AS sigla_uf",
        "r_name AS nome_uf",
        "r_name AS nome_regiao",
    )


def hydrology_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily reservoir readings from ``lineitem``: text and double measures mixed, a
    blank column, a malformed value, zero and negative turbined flow, a null useful
    volume, and one column outside the allow-list."""
    q, p, d, t = (_comma(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('R', cast(l_suppkey AS STRING)) AS id_reservatorio",
        "concat('RES_', cast(l_suppkey AS STRING)) AS nom_reservatorio",
        "concat('BACIA_', l_returnflag) AS nom_bacia",
        "concat('SUB_', l_linestatus) AS nom_subsistema",
        "concat('REE_', l_returnflag) AS nom_ree",
        "l_returnflag AS tip_reservatorio",
        "l_linenumber AS num_ordemcs",
        "l_partkey AS cod_usina",
        "l_shipdate AS din_instante",
        f"{q} AS val_nivelmontante",
        f"{d} AS val_niveljusante",
        f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {t} END AS val_volumeutilcon",
        f"{p} AS val_vazaoafluente",
        f"CASE WHEN l_suppkey % 9 = 0 THEN '0' WHEN l_suppkey % 13 = 0 THEN {_comma('-l_quantity')} ELSE {q} END AS val_vazaoturbinada",
        f"{t} AS val_vazaovertida",
        "cast(NULL AS STRING) AS val_vazaooutrasestruturas",
        f"{d} AS val_vazaodefluente",
        "l_discount AS val_vazaotransferida",
        f"{p} AS val_vazaonatural",
        "'' AS val_vazaoartificial",
        f"{q} AS val_vazaoincremental",
        f"{t} AS val_vazaoevaporacaoliquida",
        f"CASE WHEN l_linenumber = 6 THEN '1.234,56' ELSE {t} END AS val_vazaousoconsuntivo",
        f"{q} AS val_vazaoincrementalbruta",
    )


def generation_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hydro generation from ``orders``: subsystem ``SUB_P`` has no reservoirs, and the
    upper-case type spelling does not match the hydro pattern."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderdate AS din_instante",
        "o_orderstatus AS id_subsistema",
        "concat('SUB_', o_orderstatus) AS nom_subsistema",
        "cast(o_custkey % 3 AS STRING) AS id_estado",
        "concat('UF', cast(o_custkey % 3 AS STRING)) AS nom_estado",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Hidrelétrica' ELSE 'HIDRELÉTRICA' END AS nom_tipousina",
        "concat('U', cast(o_custkey AS STRING)) AS nom_usina",
        f"{_comma('o_totalprice')} AS val_geracao",
    )


def load_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily subsystem load from ``orders``."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderstatus AS id_subsistema",
        "concat('SUB_', o_orderstatus) AS nom_subsistema",
        "o_orderdate AS din_instante",
        f"{_comma('o_totalprice')} AS val_cargaenergiamwmed",
    )


def capacity_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacity register from ``part``: null and repeated plant codes, codes without a
    modality row, null state ids and modalities."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_type AS id_subsistema",
        "p_type AS nom_subsistema",
        "CASE WHEN p_size < 10 THEN NULL ELSE p_brand END AS id_estado",
        "p_brand AS nom_estado",
        "p_type AS nom_tipousina",
        "p_name AS nom_usina",
        "CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE concat('C', cast(p_partkey div 3 AS STRING)) END AS ceg",
        "concat('O', cast(p_partkey AS STRING)) AS id_ons",
        "CASE WHEN p_size > 40 THEN NULL ELSE 'TIPO I' END AS nom_modalidadeoperacao",
        f"{_comma('p_retailprice')} AS val_potenciaefetiva",
        "'2000-01-01' AS dat_entradaoperacao",
        "cast(NULL AS STRING) AS dat_desativacao",
    )


def modality_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modality register from ``supplier``: plant codes repeat (many-to-many join)."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS nom_usina",
        "concat('C', cast(s_suppkey div 2 AS STRING)) AS ceg",
        "concat('O', cast(s_suppkey AS STRING)) AS id_ons",
        "'TIPO II' AS nom_modalidadeoperacao",
        f"{_comma('s_acctbal')} AS val_potenciaautorizada",
        "cast(s_nationkey AS STRING) AS id_estado",
        "cast(s_nationkey AS STRING) AS nom_estado",
        "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'OK' END AS sts_aneel",
    )
