"""Physical-plan checks: one client exchange feeding the gold windows, no Python evaluation, pushdown."""

import re


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_window_has_no_exchange_above_union(small_layers):
    from retentia.operators.gold import gold_features
    gold = gold_features(small_layers.silver_transacciones, small_layers.silver_devoluciones, "1990-01-01")
    text = gold._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    w = next(i for i, line in enumerate(lines) if "Window" in line)
    u = next(i for i, line in enumerate(lines) if re.search(r"\bUnion\b", line))
    assert not any("Exchange" in line for line in lines[w:u])
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_filters_reach_the_scan(spark, small_layers, tmp_path):
    from retentia.operators.gold import latest_month
    from retentia.sources.bronze import save_table
    save_table(small_layers.gold, path=str(tmp_path / "gold"), partition_by="fecha_referencia")
    g = spark.read.parquet(str(tmp_path / "gold"))
    q = g.where(g.fecha_referencia < latest_month(g)).select("cliente_id", "fuga_combinada_1m")
    text = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha_referencia" in text
    assert "ReadSchema: struct<cliente_id:string,fuga_combinada_1m:bigint>" in text


def test_hot_client_join_is_split_by_aqe(spark):
    """A client with most of the purchases: AQE splits its partition in the silver join (skew=true)."""
    from retentia.operators import silver as S
    from tests.fixtures import client, frames, purchase
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = [purchase(f"H{i}", "C1", "2001-01-05") for i in range(20000)]
        cold = [purchase(f"X{i}", f"K{i % 500}", "2001-01-05") for i in range(2000)]
        c, t, _ = frames(spark, [client("C1")] + [client(f"K{i}") for i in range(500)], hot + cold, [])
        st = S.silver_transacciones(t, S.silver_clientes(c))
        assert len(st.collect()) == 22000
        plan = st._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_rfm_scores_use_no_global_ntile_window(small_layers):
    from retentia.operators.analysis import rfm_scores
    text = rfm_scores(small_layers.gold)._jdf.queryExecution().executedPlan().toString()
    assert "ntile(" not in text
