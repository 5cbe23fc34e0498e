"""Property tests (hypothesis): Spark expressions against plain-Python statements of the rules."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ecoflux import functions as X
from ecoflux.plans import gold, silver

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _py_decimal_comma(s):
    """The rule: every comma becomes a point, then a lenient float parse (else null)."""
    if s is None:
        return None
    t = s.replace(",", ".").strip()
    try:
        if any(c.isalpha() for c in t.lower().replace("e", "")):
            return None
        return float(t)
    except ValueError:
        return None


numeric_text = st.one_of(
    st.none(),
    st.decimals(min_value=-10**6, max_value=10**6, places=3, allow_nan=False).map(lambda d: str(d).replace(".", ",")),
    st.text(alphabet="0123456789,.- ", max_size=8),
)


@SETTINGS
@given(st.lists(numeric_text, min_size=1, max_size=30))
def test_decimal_comma_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(X.decimal_comma("s")).collect()]
    assert got == [_py_decimal_comma(v) for v in values]


hourly = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C"]),
        st.dates(min_value=dt.date(2017, 12, 25), max_value=dt.date(2018, 1, 5)),
        st.integers(min_value=0, max_value=23),
        st.integers(min_value=0, max_value=5000),
    ),
    min_size=1,
    max_size=60,
)


@SETTINGS
@given(hourly)
def test_daily_precipitation_adds_up_to_hourly(spark, rows):
    raw = spark.createDataFrame(
        [(s, d.isoformat(), f"{h:02d}:00:00 UTC", f"{v // 100},{v % 100:02d}", None, "1,0", 1.0) for s, d, h, v in rows],
        "id_estacao string, data string, hora string, precipitacao_total string, radiacao_global string, "
        "temperatura_bulbo_hora string, vento_velocidade double",
    )
    daily = silver.weather_daily(raw)
    total = daily.agg(F.sum("precipitacao_total")).first()[0]
    assert round(total, 6) == round(sum(v for *_, v in rows) / 100, 6)
    # every station-day is unique, and local dates are at most one day before the UTC date
    assert daily.count() == daily.select("id_estacao", "event_date").distinct().count()
    days = {r.event_date for r in daily.collect()}
    assert all(dt.date(2017, 12, 24) <= d <= dt.date(2018, 1, 5) for d in days)


@SETTINGS
@given(st.lists(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31)), min_size=1, max_size=40))
def test_dim_time_matches_python_calendar(spark, dates):
    df = spark.createDataFrame([(d,) for d in dates], "event_date date")
    rows = gold.dim_time(df).collect()
    assert len(rows) == len(set(dates))
    for r in rows:
        d = r.event_date
        assert (r.ano, r.mes, r.dia, r.trimestre) == (d.year, d.month, d.day, (d.month - 1) // 3 + 1)
        assert r.dia_semana_numero == d.isoweekday()
        assert r.fim_de_semana == (d.isoweekday() >= 6)
        assert r.nome_dia_semana == d.strftime("%A") and r.nome_mes == d.strftime("%B")


def test_bridge_rows_are_the_product_of_fan_outs(spark):
    """Per station and day the bridge has (ids sharing the state name) x (subsystems of the
    state that day) rows, or one row when the state name has no generation (G9 notes 1-2)."""
    from collections import Counter

    import __spark_entry__ as E
    from ecoflux.sources import adapters as A

    sf = "/root/testdata/sf0.01"
    weather = silver.weather_daily(A.weather_raw(spark, sf))
    location = E._location(spark, sf)
    generation = silver.generation_daily(A.generation_raw(spark, sf))
    load = silver.load(A.load_raw_events(spark, sf))

    ids = Counter(r.nom_estado for r in gold.state_names(generation).collect())
    subsystems = Counter((r.event_date, r.nom_estado) for r in gold.generation_by_state(generation).collect())
    expected = Counter()
    for r in weather.join(location, "id_estacao").select("event_date", "id_estacao", "nome_uf").collect():
        k = ids.get(r.nome_uf, 0)
        expected[(r.event_date, r.id_estacao)] += k * max(subsystems.get((r.event_date, r.nome_uf), 0), 1) if k else 1
    bridge = gold.bridge(weather, gold.places(location, gold.state_names(generation)), generation, load)
    got = Counter((r.event_date, r.id_estacao) for r in bridge.select("event_date", "id_estacao").collect())
    assert got == expected
    assert max(ids.values()) > 1 and max(got.values()) > 2  # both fan-outs occur in the fixture
