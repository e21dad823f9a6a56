"""Edge cases of cleaning and per-customer features."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from vitrina.operators import cleaning, customer360, features
from vitrina.sources import csv as csv_source


def _clientes(spark, rows):
    return spark.createDataFrame(rows, "id_cliente string, zona_geografica string, antiguedad_meses int, "
                                       "score_credito_interno double, celular_contacto string, "
                                       "email_contacto string")


def test_contact_flags_follow_python_re(spark):
    rows = [("a", "z", 1, 1.0, None, None),
            ("b", "z", 1, 1.0, "null", "null"),
            ("c", "z", 1, 1.0, " ", " "),
            ("d", "z", 1, 1.0, "3001234567", "ñu@a.co"),
            ("e", "z", 1, 1.0, "3001234567\n", "a@b"),
            ("f", "z", 1, 1.0, "3001234567\r", "x.y-z@dom.com\n"),
            ("g", "z", 1, 1.0, "٣٠٠١٢٣٤٥٦٧", "a@b.c\r")]
    out = {r["id_cliente"]: (r["tiene_celular_valido"], r["tiene_email_valido"])
           for r in cleaning.clean_clientes(_clientes(spark, rows)).collect()}
    # Python: re.match(r'^\d{10}$', s) accepts a final "\n" (not "\r") and Unicode digits
    assert out["a"] == (0, 0)
    assert out["b"] == (0, 0)
    assert out["c"] == (0, 0)
    assert out["d"] == (1, 1)
    assert out["e"] == (1, 0)
    assert out["f"] == (0, 1)
    assert out["g"] == (1, 0)


def test_zone_then_global_median(spark):
    rows = [("a", "N", 1, 1.0, None, None), ("b", "N", 1, 2.0, None, None),
            ("c", "N", 1, 4.0, None, None), ("d", "N", 1, 10.0, None, None),
            ("e", "N", 1, None, None, None),            # zone median of 1,2,4,10 = 3.0 (interpolated)
            ("f", "S", 1, None, None, None),            # all-null zone -> global median
            ("g", None, 1, None, None, None),           # null zone -> global median
            ("h", None, 1, 7.0, None, None)]
    out = {r["id_cliente"]: r["score_credito_interno"]
           for r in cleaning.clean_clientes(_clientes(spark, rows)).collect()}
    assert out["e"] == 3.0
    # global median over the zone-imputed column: 1,2,4,10,3,7 -> 3.5
    assert out["f"] == 3.5 and out["g"] == 3.5
    assert out["h"] == 7.0


def test_median_paths_agree(spark, monkeypatch):
    """The one-pass median and the distributed exact quantiles give the same
    imputed scores (a hot zone holds most rows; zone N has an even count)."""
    rows = [(f"h{i}", "HOT", 1, float(i % 37) if i % 9 else None, None, None) for i in range(600)]
    rows += [("a", "N", 1, 1.0, None, None), ("b", "N", 1, 2.0, None, None),
             ("c", "N", 1, 4.0, None, None), ("d", "N", 1, 10.0, None, None),
             ("e", "N", 1, None, None, None), ("f", "S", 1, None, None, None),
             ("g", None, 1, None, None, None)]
    df = _clientes(spark, rows)

    def imputed():
        out = cleaning.clean_clientes(df)
        return {r["id_cliente"]: r["score_credito_interno"] for r in out.collect()}

    assert imputed()["e"] == 3.0
    zm = {r["zona_geografica"]: r["mediana_zona"] for r in cleaning.zone_median(df).collect()}
    assert zm == {"HOT": 18.0, "N": 3.0, "S": None}


def _tx(spark, rows):
    return spark.createDataFrame(rows, "id_transaccion string, id_cliente string, fecha_compra timestamp_ntz, "
                                       "categoria_producto string, monto_pago double, medio_pago string")


def test_tx_features_edge_cases(spark):
    t = dt.datetime
    rows = [("1", "a", t(2024, 1, 1, 23, 0), "lavado", 10.0, "efectivo"),
            ("2", "a", t(2024, 1, 1, 23, 0), "coccion", 20.0, "tarjeta"),      # tie lavado/coccion
            ("3", "b", t(2024, 1, 2, 1, 0), None, None, None),                 # all-null amounts / category
            ("4", None, t(2024, 1, 2, 1, 0), "lavado", 5.0, "credito_propio_retail")]
    f = {r["id_cliente"]: r for r in features.build_tx_features(_tx(spark, rows)).collect()}
    assert set(f) == {"a", "b"}                     # null customer id dropped
    assert f["a"]["recency_dias"] == 0              # 23:00 -> 01:00 next day is 0 whole days
    assert f["a"]["categoria_favorita"] == "coccion"  # tie -> smallest value
    assert f["a"]["frequency"] == 2 and f["a"]["monetary_total"] == 30.0
    assert f["a"]["monetary_avg"] == 15.0 and f["a"]["usa_credito_propio"] == 0
    assert f["b"]["monetary_total"] == 0.0          # sum of all-null is 0
    assert f["b"]["monetary_avg"] is None           # mean of all-null is missing
    assert f["b"]["categoria_favorita"] is None     # mode of all-null is missing
    assert f["b"]["diversidad_categorias"] == 0


def test_c360_keeps_customers_without_history(spark):
    cl = _clientes(spark, [("a", "N", 3, 1.0, None, None), ("z", "N", 4, 2.0, None, None)])
    tx = _tx(spark, [("1", "a", dt.datetime(2024, 1, 1), "lavado", 10.0, "efectivo")])
    vis = spark.createDataFrame([("v1", "q", "t1", dt.datetime(2024, 1, 1), "cotizacion", 1)],
                                "id_interaccion string, id_cliente string, id_tienda string, "
                                "fecha_visita timestamp_ntz, motivo_visita string, compro_en_visita int")
    c = {r["id_cliente"]: r for r in customer360.build_customer_360(cleaning.clean_clientes(cl), tx, vis).collect()}
    assert set(c) == {"a", "z"}
    assert c["z"]["frequency"] == 0 and c["z"]["recency_dias"] == 0 and c["z"]["total_visitas"] == 0
    assert c["z"]["categoria_favorita"] is None     # strings keep their nulls
    assert len(c["a"]) == 22


def test_dedupe_by_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "id_cliente string, v int")
    out = customer360.dedupe_by_key(df)
    assert sorted(r["id_cliente"] for r in out.collect()) == ["a", "b"]


def test_na_normalisation_and_csv_reader(spark, tmp_path):
    path = str(tmp_path / "clientes.csv")
    with open(path, "w") as fh:
        fh.write("id_cliente,zona_geografica,antiguedad_meses,score_credito_interno,celular_contacto,email_contacto\n")
        fh.write("a,NA,3,1.5,0300123456,null\n")
        fh.write("b,Norte,x,,Null,a@b.co\n")
    df = {r["id_cliente"]: r for r in csv_source.read_clientes(spark, path).collect()}
    assert df["a"]["zona_geografica"] is None and df["a"]["email_contacto"] is None
    assert df["a"]["celular_contacto"] == "0300123456"       # leading zero kept (string)
    assert df["b"]["antiguedad_meses"] is None               # bad number -> null
    assert df["b"]["score_credito_interno"] is None
    assert df["b"]["celular_contacto"] == "Null"             # pandas keeps 'Null' as text too


def test_medians_equal_pandas_with_missing_scores_and_zones(spark):
    import pandas as pd
    draw = random.Random(3)
    rows = [(f"c{i}", draw.choice(["N", "S", "HOT", "HOT", "HOT", None, "EMPTY"]), 1, None, None, None) for i in range(400)]
    rows = [(*r[:3], None if r[1] == "EMPTY" or draw.random() < 0.2 else round(draw.uniform(0, 9), draw.choice([0, 3])), *r[4:]) for r in rows]
    p = pd.DataFrame(rows, columns=["id", "z", "a", "s", "x", "y"])
    p["s"] = p["s"].astype(float)
    filled = p["s"].fillna(p["z"].map(p.groupby("z")["s"].median()))
    want = dict(zip(p["id"], filled.fillna(filled.median())))
    got = {r["id_cliente"]: r["score_credito_interno"] for r in cleaning.clean_clientes(_clientes(spark, rows)).collect()}
    assert got == pytest.approx(want)
    zones = {r["zona_geografica"]: r["mediana_zona"] for r in cleaning.zone_median(_clientes(spark, rows)).collect()}
    assert zones == pytest.approx({**p.groupby("z")["s"].median().dropna().to_dict(), "EMPTY": None})


def test_amounts_keep_sub_cent_parts_and_large_values(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("1", "a", t, "lavado", 0.0005, "efectivo"), ("2", "a", t, "lavado", 0.0007, "efectivo"), ("3", "b", t, "lavado", 4e17, "x"), ("4", "b", t, "coccion", 5e17, "x")]
    f = {r["id_cliente"]: r for r in features.build_tx_features(_tx(spark, rows)).collect()}
    assert f["a"]["monetary_total"] == pytest.approx(0.0012) and f["b"]["monetary_total"] == 9e17
