"""Edge cases of the silver and gold layers on hand-made rows (FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retentia.functions.dates import month_diff
from retentia.functions.labels import feature_category, risk_band
from retentia.operators import features as FT
from retentia.operators import gold as G
from retentia.operators import silver as S
from retentia.plans.layers import Layers
from tests.fixtures import client, frames, purchase, ret


def D(s):
    return dt.date.fromisoformat(s)


def test_email_cleaning_and_validity(spark):
    c, _, _ = frames(spark, [client("C1", email=" A@B.COM "), client("C2", email="ok@mail.com"),
                             client("C3", email=None), client(None, email="n@n.com")], [], [])
    rows = {r.cliente_id: r for r in S.silver_clientes(c, as_of="2021-01-01").collect()}
    assert set(rows) == {"C1", "C2"}
    assert rows["C1"].email == "a@b.com" and rows["C1"].email_valido is False
    assert rows["C2"].email_valido is True


def test_email_pattern_rejects_trailing_newline(spark):
    c, _, _ = frames(spark, [client("C1", email="ok@mail.com\n")], [], [])
    assert S.silver_clientes(c, as_of="2021-01-01").first().email_valido is False


def test_purchase_filters_and_null_profile(spark):
    c, t, _ = frames(spark, [client("C1"), client("C2", email=None)], [
        purchase("T1", "C1", "2020-02-01", amount=-1.0),
        purchase("T2", "C1", "2020-02-01", amount=None),
        purchase("T3", "C1", "2020-02-01", amount=0.0),
        purchase("T4", "C2", "2020-02-01", amount=5.0),
        purchase("T5", "C1", "2020-02-01", qty=0.0, disc=1.0),
    ], [])
    sc = S.silver_clientes(c, as_of="2021-01-01")
    st = {r.transaccion_id: r for r in S.silver_transacciones(t, sc).collect()}
    assert set(st) == {"T3", "T4", "T5"}
    assert st["T4"].perfil_cliente is None
    assert st["T5"].porcentaje_descuento is None


def test_season_flags(spark):
    dates = ["2020-11-19", "2020-11-20", "2020-11-30", "2020-12-01", "2020-12-26", "2020-12-27", "2021-01-15",
             "2021-07-15", "2021-08-15"]
    c, t, _ = frames(spark, [client("C1")], [purchase(f"T{i}", "C1", d) for i, d in enumerate(dates)], [])
    rows = sorted(S.silver_transacciones(t, S.silver_clientes(c)).collect(), key=lambda r: r.fecha_transaccion)
    assert [r.es_black_friday for r in rows[:3]] == [False, True, True]
    assert [r.es_navidad for r in rows[3:6]] == [True, True, False]
    assert [r.es_rebajas for r in rows[6:]] == [True, True, False]
    assert rows[0].nombre_mes == "November" and rows[0].dia_semana == "Thursday"


def test_return_types_and_quick_flag(spark):
    c, t, d = frames(spark, [client("C1")], [purchase(f"T{i}", "C1", "2020-03-01", amount=100.0) for i in range(5)], [
        ret("D1", "T1", "C1", "2020-03-08", 95.0),
        ret("D2", "T2", "C1", "2020-03-09", 50.0),
        ret("D3", "T3", "C1", "2020-03-02", 1.0),
        ret("D4", "T4", "C1", "2020-03-02", 0.0),
        ret("D5", "TX", "C1", "2020-03-02", 10.0),
    ])
    st = S.silver_transacciones(t, S.silver_clientes(c))
    rows = {r.devolucion_id: r for r in S.silver_devoluciones(d, st).collect()}
    assert [rows[k].tipo_devolucion for k in ["D1", "D2", "D3", "D4", "D5"]] == [
        "Completa", "Parcial Alta", "Parcial Baja", "Sin Importe", "Parcial Baja"]
    assert rows["D1"].devolucion_rapida is True and rows["D2"].devolucion_rapida is False
    assert rows["D5"].fecha_transaccion is None and rows["D5"].devolucion_rapida is False


def _gold(spark, purchases, returns=(), sentinel="1990-01-01"):
    c, t, d = frames(spark, [client("C1"), client("C2"), client("C3")], purchases, list(returns))
    L = Layers(spark, (c, t, d), as_of="2002-01-01", sentinel=sentinel)
    return {(r.cliente_id, r.fecha_referencia): r for r in L.gold.collect()}


def test_rolling_windows_at_month_bounds(spark):
    g = _gold(spark, [
        purchase("T1", "C1", "2001-07-01", amount=10.0), purchase("T2", "C1", "2001-04-01", amount=20.0),
        purchase("T3", "C1", "2001-01-01", amount=30.0), purchase("T4", "C1", "2001-06-30", amount=40.0),
        purchase("T5", "C1", "2001-03-31", amount=50.0), purchase("T6", "C1", "2000-12-31", amount=60.0),
    ])
    r = g[("C1", D("2001-07-01"))]
    assert (r.num_compras_3m, r.num_compras_6m) == (2, 4)
    assert (r.valor_compras_3m, r.valor_compras_6m) == (60.0, 140.0)
    assert r.tendencia_valor_6m == 60.0 - 80.0
    assert r.num_compras_mes == 1 and r.valor_compras_mes == 10.0
    assert r.dias_desde_ultima_compra == 1
    # month with no purchase by anyone is not in the calendar
    assert ("C1", D("2001-05-01")) not in g and ("C1", D("2001-02-01")) not in g


def test_variation_single_purchase_is_null_then_imputed(spark):
    g = _gold(spark, [purchase("T1", "C1", "2001-01-10", amount=10.0), purchase("T2", "C1", "2001-02-10"),
                      purchase("T3", "C2", "2001-01-10", amount=10.0), purchase("T4", "C2", "2001-01-20", amount=30.0)])
    assert g[("C1", D("2001-02-01"))].coef_variacion_valor_6m is None
    cv = g[("C2", D("2001-02-01"))].coef_variacion_valor_6m
    assert cv == pytest.approx((200 ** 0.5) / 20.0)
    assert g[("C1", D("2001-01-01"))].coef_variacion_valor_6m == 0.0


def test_target_and_sentinel(spark):
    g = _gold(spark, [purchase("T1", "C1", "2001-01-10"), purchase("T2", "C1", "2001-02-10"),
                      purchase("T3", "C2", "2001-01-10"), purchase("T4", "C2", "2001-03-10"),
                      purchase("T5", "C3", "2001-03-10")])
    assert g[("C1", D("2001-01-01"))].fuga_combinada_1m == 0
    assert g[("C2", D("2001-01-01"))].fuga_combinada_1m == 1
    assert g[("C2", D("2001-02-01"))].fuga_combinada_1m == 0
    first = g[("C3", D("2001-01-01"))]
    assert first.dias_desde_ultima_compra == (D("2001-01-01") - D("1990-01-01")).days
    assert first.meses_desde_primera_compra == -2


def test_return_outside_calendar_is_dropped(spark):
    g = _gold(spark, [purchase("T1", "C1", "2001-01-10")], [ret("D1", "T1", "C1", "2001-02-03", 5.0),
                                                          ret("D2", "T1", "C1", "2001-01-20", 7.0)])
    assert list(g) == [("C1", D("2001-01-01"))]
    r = g[("C1", D("2001-01-01"))]
    assert r.num_devoluciones_mes == 1 and r.importe_devuelto_mes == 7.0
    assert r.tasa_devolucion_mes == pytest.approx(0.07)


def test_month_difference_counts_boundaries(spark):
    r = spark.createDataFrame([(D("2001-02-01"), D("2001-01-31"))], "a date, b date").select(
        month_diff("a", "b").alias("m")).first()
    assert r.m == 1


def test_risk_bands(spark):
    df = spark.createDataFrame([(0.8,), (0.6,), (0.4,), (0.2,), (0.1999,), (None,)], "p double")
    assert [r.b for r in df.select(risk_band("p").alias("b")).collect()] == [
        "MUY_ALTO", "ALTO", "MEDIO", "BAJO", "MUY_BAJO", "MUY_BAJO"]


def test_feature_categories(spark):
    df = spark.createDataFrame([(f,) for f in FT.CHURN_FEATURES], "feature string")
    counts = {r.c: r.n for r in df.groupBy(feature_category("feature").alias("c")).agg(F.count("*").alias("n")).collect()}
    assert counts == {"RFM - Monetary": 4, "RFM - Frequency": 2, "RFM - Recency": 1, "Engagement": 2,
                      "Tendencias": 2, "Temporales": 5, "Transformadas": 2, "Devoluciones": 1, "Flags": 3}


def test_training_drops_sentinel_rows(spark):
    c, t, d = frames(spark, [client("C1")], [purchase("T1", "C1", "2001-01-10"), purchase("T2", "C1", "2001-02-10"),
                                             purchase("T3", "C1", "2001-03-10")], [])
    gold = Layers(spark, (c, t, d), sentinel="1990-01-01").gold
    rows = FT.training_set(gold).collect()
    assert [r.fecha_referencia for r in rows] == [D("2001-02-01")]
    assert G.GOLD_COLUMNS == gold.columns


def test_hot_client_is_reduced_before_the_window(spark):
    """One client with a third of all purchases: results stay exact and the window sees one row per month."""
    hot = [purchase(f"H{i}", "C1", f"2001-0{1 + i % 3}-{1 + i % 28:02d}", amount=float(1 + i % 7)) for i in range(3000)]
    cold = [purchase(f"X{i}", f"K{i}", f"2001-0{1 + i % 3}-15", amount=5.0) for i in range(6000)]
    c, t, d = frames(spark, [client("C1")] + [client(f"K{i}") for i in range(6000)], hot + cold, [])
    L = Layers(spark, (c, t, d), sentinel="1990-01-01")
    from retentia.operators.gold import client_month_purchases
    per_month = client_month_purchases(L.silver_transacciones).where(F.col("cliente_id") == "C1").count()
    assert per_month == 3
    g = {r.fecha_referencia: r for r in L.gold.where(F.col("cliente_id") == "C1").collect()}
    assert g[D("2001-03-01")].num_compras_3m == 2000
    assert g[D("2001-03-01")].valor_compras_3m == float(sum(1 + i % 7 for i in range(3000) if i % 3 != 2))
    assert L.gold.count() == 6001 * 3
