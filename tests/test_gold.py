"""Gold results on the minimum frames of FIXTURES.md, with hand-computed values."""

import datetime as dt

from ecoflux.plans import gold

D = dt.date
GEN = ("event_date date, id_subsistema string, nom_subsistema string, id_estado string, nom_estado string, "
       "nom_tipousina string, val_geracao_total_mwmed double, qtd_usinas_ativas bigint, year int, month int")
HYD = "event_date date, nom_subsistema string, val_vazaoturbinada double, val_vazaoafluente double, val_vazaodefluente double, val_volumeutilcon double, year int, month int"


def test_hydro_efficiency_minimum_frame(spark):
    d1, d2, d3 = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    hyd = spark.createDataFrame(
        [
            (d1, "SE", 10.0, 100.0, 90.0, 50.0, 2024, 1),
            (d1, "SE", 30.0, 200.0, 80.0, None, 2024, 1),
            (d1, "S", 0.0, 5.0, 5.0, 10.0, 2024, 1),      # zero flow -> null ratio
            (d2, "SE", 20.0, 1.0, 1.0, 1.0, 2024, 1),     # hydrology only -> null generation
            (d3, "S", -5.0, 1.0, 1.0, 1.0, 2024, 1),      # negative flow -> null ratio
        ],
        HYD,
    )
    gen = spark.createDataFrame(
        [
            (d1, "1", "SE", "MG", "MINAS", "Hidrelétrica", 80.0, 1, 2024, 1),
            (d1, "1", "SE", "MG", "MINAS", "UHE Hidrel", 20.0, 1, 2024, 1),
            (d1, "1", "SE", "MG", "MINAS", "HIDRELÉTRICA", 999.0, 1, 2024, 1),  # not matched
            (d1, "2", "S", "RS", "RIO G", "Hidrelétrica", 7.0, 1, 2024, 1),
            (d3, "2", "S", "RS", "RIO G", "Hidrelétrica", 7.0, 1, 2024, 1),
            (d2, "3", "NE", "BA", "BAHIA", "Hidrelétrica", 5.0, 1, 2024, 1),  # generation only -> lost
        ],
        GEN,
    )
    out = {(r.event_date, r.nom_subsistema): r for r in gold.hydro_efficiency(gen, hyd).collect()}
    assert set(out) == {(d1, "SE"), (d1, "S"), (d2, "SE"), (d3, "S")}
    se = out[(d1, "SE")]
    assert (se.val_vazaoturbinada_total, se.val_vazaoafluente_total, se.val_vazaodefluente_total) == (40.0, 300.0, 170.0)
    assert (se.val_volumeutilcon_medio, se.val_geracao_hidro_mwmed, se.eficiencia_mwmed_por_m3s) == (50.0, 100.0, 2.5)
    assert (se.year, se.month) == ("2024", "1")
    assert out[(d1, "S")].val_geracao_hidro_mwmed == 7.0 and out[(d1, "S")].eficiencia_mwmed_por_m3s is None
    assert out[(d2, "SE")].val_geracao_hidro_mwmed is None and out[(d2, "SE")].eficiencia_mwmed_por_m3s is None
    assert out[(d3, "S")].eficiencia_mwmed_por_m3s is None


def _bridge_inputs(spark):
    d = D(2024, 1, 1)
    weather = spark.createDataFrame(
        [("E1", d, 1.0, 2.0, 3.0, 4.0, 2.0, 5.0, "America/Sao_Paulo", 2024, 1),
         ("E2", d, 1.0, 2.0, 3.0, 4.0, 2.0, 5.0, "America/Sao_Paulo", 2024, 1),
         ("E3", d, 1.0, 2.0, 3.0, 4.0, 2.0, 5.0, "America/Sao_Paulo", 2024, 1),
         ("E4", d, 1.0, 2.0, 3.0, 4.0, 2.0, 5.0, "America/Sao_Paulo", 2024, 1)],
        "id_estacao string, event_date date, precipitacao_total double, radiacao_global double, temperatura_media double, "
        "temperatura_maxima double, temperatura_minima double, vento_velocidade_media double, timezone string, year int, month int",
    )
    stations = spark.createDataFrame(
        [("E1", 1, "st1", D(2000, 1, 1), -10.0, -40.0, None),
         ("E2", 99, "st2", D(2000, 1, 1), -11.0, -41.0, None),   # unknown municipality
         ("E4", 2, "st4", D(2000, 1, 1), -12.0, -42.0, None)],   # E3 has no location row
        "id_estacao string, id_municipio int, estacao string, data_fundacao date, latitude double, longitude double, altitude double",
    )
    muni = spark.createDataFrame(
        [(1, "Cidade A", "AF", "AFRICA", "AFRICA"), (2, "Cidade B", "EU", "EUROPE", "EUROPE")],
        "id_municipio int, nome string, sigla_uf string, nome_uf string, nome_regiao string",
    )
    gen = spark.createDataFrame(
        [
            (d, "S0", "SUB0", "0", "AFRICA", "Eólica", 1.0, 1, 2024, 1),
            (d, "S0", "SUB0", "0", "AFRICA", "Hidrelétrica", 2.0, 1, 2024, 1),
            (d, "S1", "SUB1", "3", "AFRICA", "Nuclear", 4.0, 1, 2024, 1),  # second id, second subsystem
        ],
        GEN,
    )
    load = spark.createDataFrame(
        [("S0", "SUB0", 100.0, d, 2024, 1), ("S0", "SUB0", 50.0, d, 2024, 1), ("S1", "SUB1", 7.0, d, 2024, 1)],
        "id_subsistema string, nom_subsistema string, val_cargaenergiamwmed double, event_date date, year int, month int",
    )
    return weather, stations, muni, gen, load


def test_bridge_fan_outs(spark):
    weather, stations, muni, gen, load = _bridge_inputs(spark)
    loc = gold.dim_location(stations, muni)
    out = gold.bridge(weather, gold.places(loc, gold.state_names(gen)), gen, load).collect()
    by_station = {}
    for r in out:
        by_station.setdefault(r.id_estacao, []).append(r)
    # No location row -> dropped; E2: unknown municipality -> one row with nulls
    assert set(by_station) == {"E1", "E2", "E4"}
    assert len(by_station["E2"]) == 1 and by_station["E2"][0].nome_uf is None and by_station["E2"][0].nom_subsistema is None
    # State without generation -> one row, null generation and load
    assert len(by_station["E4"]) == 1 and by_station["E4"][0].geracao_total_mwmed is None
    # AFRICA has two ids (x2) and two subsystems (x2) -> 4 rows
    e1 = by_station["E1"]
    assert len(e1) == 4
    sub0 = [r for r in e1 if r.nom_subsistema == "SUB0"]
    sub1 = [r for r in e1 if r.nom_subsistema == "SUB1"]
    assert len(sub0) == 2 and len(sub1) == 2
    r0, r1 = sub0[0], sub1[0]
    assert (r0.geracao_eolica_mwmed, r0.geracao_hidro_mwmed, r0.geracao_solar_mwmed, r0.geracao_total_mwmed) == (1.0, 2.0, None, 3.0)
    assert (r1.geracao_eolica_mwmed, r1.geracao_termica_mwmed, r1.geracao_total_mwmed) == (None, None, 4.0)  # Nuclear: total only
    assert (r0.val_cargaenergiamwmed, r1.val_cargaenergiamwmed) == (150.0, 7.0)
    assert (r0.year, r0.month, r0.sigla_uf) == ("2024", "1", "AF")


def test_dim_location_left_join_and_int_keys(spark):
    _, stations, muni, _, _ = _bridge_inputs(spark)
    rows = {r.id_estacao: r for r in gold.dim_location(stations, muni).collect()}
    assert set(rows) == {"E1", "E2", "E4"}
    assert rows["E1"].nome_municipio == "Cidade A" and rows["E2"].nome_municipio is None


def test_dim_time_unique_and_calendar(spark):
    a = spark.createDataFrame([(D(2024, 1, 6),), (D(2024, 1, 7),), (None,)], "event_date date")
    b = spark.createDataFrame([(D(2024, 1, 7),), (D(2023, 12, 31),)], "event_date date")
    rows = {r.event_date: r for r in gold.dim_time(a, b).collect()}
    assert len(rows) == 3
    sat = rows[D(2024, 1, 6)]
    assert (sat.ano, sat.trimestre, sat.mes, sat.nome_mes, sat.dia) == (2024, 1, 1, "January", 6)
    assert (sat.dia_semana_numero, sat.nome_dia_semana, sat.fim_de_semana) == (6, "Saturday", True)
    assert rows[D(2023, 12, 31)].trimestre == 4 and rows[D(2023, 12, 31)].dia_semana_numero == 7


def test_dim_plant_many_to_many_and_precedence(spark):
    cap = spark.createDataFrame(
        [("S", "SUB", None, "MG", "UHE", "Cap1", "C1", None, 10.0, "2000-01-01", None),
         ("S", "SUB", "31", "MG", "UHE", "Cap1", "C1", None, 10.0, "2000-01-01", None),
         ("S", "SUB", "31", "MG", "UHE", "Cap2", "C2", "TIPO I", 5.0, "2001-01-01", None)],
        "id_subsistema string, nom_subsistema string, id_estado string, nom_estado string, nom_tipousina string, "
        "nom_usina string, ceg string, nom_modalidadeoperacao string, val_potenciaefetiva double, "
        "dat_entradaoperacao string, dat_desativacao string",
    )
    mod = spark.createDataFrame(
        [("Mod1", "C1", "O1", "TIPO II", 11.0, "99", "XX", "OK"),
         ("Mod1b", "C1", "O1b", "TIPO II", 12.0, "99", "XX", None),
         ("Mod3", "C3", "O3", "TIPO II", 1.0, "1", "Y", "OK")],  # C3 only here: lost
        "nom_usina string, ceg string, id_ons string, nom_modalidadeoperacao string, val_potenciaautorizada double, "
        "id_estado string, nom_estado string, sts_aneel string",
    )
    rows = gold.dim_plant(cap, mod).collect()
    c1 = [r for r in rows if r.ceg == "C1"]
    assert len(c1) == 4  # 2 distinct capacity rows x 2 modality rows
    assert {r.id_estado for r in c1} == {"99", "31"}  # capacity value wins when present
    assert {r.nom_modalidadeoperacao for r in c1} == {"TIPO II"}
    assert all(r.nom_usina == "Cap1" for r in c1)
    c2 = [r for r in rows if r.ceg == "C2"]
    assert len(c2) == 1 and c2[0].id_ons is None and c2[0].nom_modalidadeoperacao == "TIPO I"
    assert not [r for r in rows if r.ceg == "C3"]
