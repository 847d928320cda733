"""Hand-made bronze rows, one trap each (FIXTURES.md §3)."""

from retentia.sources.bronze import (BRONZE_CLIENTES_SCHEMA, BRONZE_DEVOLUCIONES_SCHEMA,
                                     BRONZE_TRANSACCIONES_SCHEMA)


def client(cid, email="x@y.com", ciudad="Madrid", pais="ES", fr="2020-01-01", fpc="2020-01-01", perfil="VIP"):
    return (cid, email, ciudad, pais, fr, fpc, perfil)


def purchase(tid, cid, date, amount=100.0, qty=1.0, price=100.0, disc=0.0, canal="Web"):
    return (tid, cid, date, "p", "c", qty, price, disc, amount, canal, "Tarjeta")


def ret(did, tid, cid, date, amount, n=1, motivo="Producto defectuoso"):
    return (did, tid, cid, date, n, amount, motivo)


def frames(spark, clients, purchases, returns):
    return (spark.createDataFrame(clients, BRONZE_CLIENTES_SCHEMA),
            spark.createDataFrame(purchases, BRONZE_TRANSACCIONES_SCHEMA),
            spark.createDataFrame(returns, BRONZE_DEVOLUCIONES_SCHEMA))
