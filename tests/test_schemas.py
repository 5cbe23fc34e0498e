"""Silver and gold outputs against the table contracts (column order and types)."""

import __spark_entry__ as E
from ecoflux import schemas as SC
from ecoflux.plans import gold, silver
from ecoflux.sources import adapters as A

SF = "/root/testdata/sf0.001"

# fixed values: silver contracts (the catalog dump; year/month are written as ints)
SILVER_TYPES = {
    "load": {"id_subsistema": "string", "nom_subsistema": "string", "val_cargaenergiamwmed": "double",
             "event_date": "date", "year": "int", "month": "int"},
    "generation": {"event_date": "date", "id_subsistema": "string", "nom_subsistema": "string", "id_estado": "string",
                   "nom_estado": "string", "nom_tipousina": "string", "val_geracao_total_mwmed": "double",
                   "qtd_usinas_ativas": "bigint", "year": "int", "month": "int"},
    "weather": {"id_estacao": "string", "event_date": "date", "precipitacao_total": "double", "radiacao_global": "double",
                "temperatura_media": "double", "temperatura_maxima": "double", "temperatura_minima": "double",
                "vento_velocidade_media": "double", "timezone": "string", "year": "int", "month": "int"},
    "modality": {"nom_usina": "string", "ceg": "string", "id_ons": "string", "nom_modalidadeoperacao": "string",
                 "val_potenciaautorizada": "double", "id_estado": "string", "nom_estado": "string", "sts_aneel": "string"},
    "stations": {"id_estacao": "string", "id_municipio": "int", "estacao": "string", "data_fundacao": "date",
                 "latitude": "double", "longitude": "double", "altitude": "double"},
    "municipalities": {"id_municipio": "int", "nome": "string", "sigla_uf": "string", "nome_uf": "string",
                       "nome_regiao": "string"},
}


def test_silver_contracts(spark):
    frames = {
        "load": silver.load(A.load_raw_events(spark, SF)),
        "generation": silver.generation_daily(A.generation_raw(spark, SF)),
        "weather": silver.weather_daily(A.weather_raw(spark, SF)),
        "modality": silver.modality(A.modality_raw(spark, SF)),
        "stations": silver.stations(A.stations_raw(spark, SF)),
        "municipalities": silver.municipalities(A.municipalities_raw(spark, SF)),
    }
    for name, df in frames.items():
        assert dict(df.dtypes) == SILVER_TYPES[name], name
        assert df.columns == list(SILVER_TYPES[name]), name
    hyd = silver.hydrology(A.hydrology_raw(spark, SF))
    types = dict(hyd.dtypes)
    assert all(types[m] == "double" for m in SC.HYDRO_MEASURES + ["num_ordemcs", "cod_usina"])
    cap = silver.capacity(A.capacity_raw(spark, SF))
    assert dict(cap.dtypes)["val_potenciaefetiva"] == "double"
    assert dict(cap.dtypes)["dat_entradaoperacao"] == "string" and dict(cap.dtypes)["dat_desativacao"] == "string"


def test_gold_contracts(spark):
    w, g, ld, h = E._weather(spark, SF), E._generation(spark, SF), E._load_events(spark, SF), E._hydrology(spark, SF)
    loc = E._location(spark, SF)
    for kind, df in {"weather": w, "generation": g, "load": ld, "hydrology": h}.items():
        out = gold.fact(df, kind)
        assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in SC.GOLD_FACTS[kind].fields]
    dt_ = gold.dim_time(w, g)
    assert [(f.name, f.dataType) for f in dt_.schema.fields] == [(f.name, f.dataType) for f in SC.GOLD_DIM_TIME.fields]
    assert [(f.name, f.dataType) for f in loc.schema.fields] == [(f.name, f.dataType) for f in SC.GOLD_DIM_LOCATION.fields]
    plant = gold.dim_plant(silver.capacity(A.capacity_raw(spark, SF)), silver.modality(A.modality_raw(spark, SF)))
    assert plant.columns == SC.GOLD_DIM_PLANT_COLS
    eff = gold.hydro_efficiency(E._generation_orders(spark, SF), h)
    assert eff.columns == SC.GOLD_HYDRO_EFFICIENCY_COLS
    assert dict(eff.dtypes)["year"] == "string"
    br = gold.bridge(w, gold.places(loc, gold.state_names(g)), g, ld)
    assert br.columns == SC.GOLD_BRIDGE_COLS
    assert {t for c, t in br.dtypes if c.startswith("geracao_")} == {"double"}
