"""Properties of the gold panel and the reports on the smallest test tables."""

from pyspark.sql import functions as F

from retentia.operators import analysis as A
from retentia.operators import reports as RP


def test_gold_is_clients_times_months(small_layers):
    g = small_layers.gold
    n = g.count()
    clients = g.select("cliente_id").distinct().count()
    months = g.select("fecha_referencia").distinct().count()
    assert n == clients * months == 12000


def test_window_inequalities_and_trend(small_layers):
    g = small_layers.gold
    bad = g.where((F.col("num_compras_3m") > F.col("num_compras_6m"))
                  | (F.col("valor_compras_3m") > F.col("valor_compras_6m") + 1e-6)
                  | (F.abs(F.col("tendencia_valor_6m")
                           - (2 * F.col("valor_compras_3m") - F.col("valor_compras_6m"))) > 1e-6))
    assert bad.count() == 0


def test_target_matches_next_month_purchases(small_layers):
    g = small_layers.gold.select("cliente_id", "fecha_referencia", "fuga_combinada_1m", "num_compras_mes")
    nxt = g.select("cliente_id", F.add_months("fecha_referencia", -1).alias("fecha_referencia"),
                   F.col("num_compras_mes").alias("n_next"))
    j = g.join(nxt, ["cliente_id", "fecha_referencia"])
    assert j.where((F.col("fuga_combinada_1m") == 1) != (F.col("n_next") == 0)).count() == 0


def test_bands_partition_rows_and_shares_sum(small_layers):
    s = A.churn_over_time(small_layers.gold).collect()
    assert all(0 <= r.tasa_churn_pct <= 100 for r in s)
    shares = [r.porcentaje for r in RP.clients_by_profile(small_layers.silver_clientes).collect()]
    assert abs(sum(shares) - 100) <= 0.01 * len(shares)
