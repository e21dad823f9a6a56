"""Raw CSV folder, bad rows, point-in-time features and published artefacts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitrina.operators import asof
from vitrina.plans import catalog
from vitrina.session import scratch_dir
from vitrina.sources import artefacts
from vitrina.sources import csv as csv_source

from .conftest import SMALL


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_columns_by_name_quotes_breaks_and_bad_rows(spark, tmp_path):
    text = ('email_contacto,notas,id_cliente,score_credito_interno,zona_geografica,celular_contacto,antiguedad_meses\n'
            'a@b.co,"dijo ""hola"",\nadiós",c1,1.5,Norte,0300123456,3\n'
            'null,x,c2,,NA,,4\n'
            'a@b.co,x,c3,mucho,Sur,1,5\n'
            'a@b.co,x,c4,2.5,Sur,1,cinco\n'
            'a@b.co,x,c5,2.5\n')
    path = put(tmp_path / "clientes.csv", text)
    good, bad = csv_source.read_checked(spark, path, csv_source.CLIENTES_SCHEMA, "clientes")
    rows = {r["id_cliente"]: r for r in good.collect()}
    assert set(rows) == {"c1", "c2"} and good.columns == [n for n, _ in csv_source.CLIENTES_SCHEMA]
    assert rows["c1"]["celular_contacto"] == "0300123456" and rows["c1"]["score_credito_interno"] == 1.5
    assert rows["c2"]["zona_geografica"] is None and rows["c2"]["email_contacto"] is None
    found = {(r["columna"], r["valor"]) for r in bad.collect()}
    assert found == {("score_credito_interno", "mucho"), ("antiguedad_meses", "cinco"), (None, None)}
    assert "c5" in next(r["registro"] for r in bad.collect() if r["columna"] is None)
    assert {(r["columna"], r["filas"]) for r in csv_source.bad_row_counts(bad).collect()} == {("score_credito_interno", 1), ("antiguedad_meses", 1), (None, 1)}


def test_missing_column_is_refused(spark, tmp_path):
    path = put(tmp_path / "x.csv", "id_cliente,zona_geografica\na,b\n")
    with pytest.raises(csv_source.HeaderError, match="antiguedad_meses"):
        csv_source.read_checked(spark, path, csv_source.CLIENTES_SCHEMA, "clientes")


def test_header_without_rows(spark, tmp_path):
    path = put(tmp_path / "x.csv", ",".join(n for n, _ in csv_source.INTERACCIONES_SCHEMA) + "\n")
    good, bad = csv_source.read_checked(spark, path, csv_source.INTERACCIONES_SCHEMA, "interacciones")
    assert good.count() == bad.count() == 0 and dict(good.dtypes)["fecha_visita"] == "timestamp_ntz"


def test_asof_counts_only_what_came_before(spark):
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    visits = spark.createDataFrame(
        [("v1", "a", "t", t(2), "cotizacion", 1), ("v2", "a", "t", t(2), "reclamo", 0), ("v3", "a", "t", t(9), "cotizacion", 0), ("v4", None, "t", t(9), "cotizacion", 1), ("v5", "b", "t", t(1), "cotizacion", 1)],
        "id_interaccion string, id_cliente string, id_tienda string, fecha_visita timestamp_ntz, motivo_visita string, compro_en_visita int")
    tx = spark.createDataFrame(
        [("p1", "a", t(2), "x", 10.0, "e"), ("p1", "a", t(2), "x", 5.0, "e"), ("p2", "a", t(3), "x", None, "e"), ("p3", "a", t(10), "x", 7.0, "e"), ("p4", None, t(1), "x", 3.0, "e")],
        "id_transaccion string, id_cliente string, fecha_compra timestamp_ntz, categoria_producto string, monto_pago double, medio_pago string")
    got = {r["id_interaccion"]: r for r in asof.visit_asof(visits, tx).collect()}
    assert len(got) == 5
    assert (got["v1"]["total_visitas"], got["v1"]["frequency"], got["v1"]["monetary_total"]) == (0, 2, 15.0)     # the same moment's purchases come first
    assert (got["v2"]["total_visitas"], got["v2"]["tasa_conversion_hist"]) == (1, 1.0)
    assert (got["v3"]["total_visitas"], got["v3"]["tasa_conversion_hist"], got["v3"]["visitas_reclamo"], got["v3"]["frequency"], got["v3"]["monetary_avg"]) == (2, 0.5, 1, 3, 7.5)
    assert all(got[v][c] == 0 for v in ("v4", "v5") for c in asof.ASOF_COLS)


def test_training_table_without_leak_has_all_histories_as_of_the_visit(spark):
    from vitrina.operators.dataset import FEATURE_COLS, TARGET

    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    kinds = "id_interaccion string, id_cliente string, id_tienda string, fecha_visita timestamp_ntz, motivo_visita string, compro_en_visita int"
    seen = [("v1", "a", "t", t(1), "cotizacion", 1), ("v2", "a", "t", t(6, 12), "reclamo", 0), ("v3", "a", "t", t(20), "cotizacion", 0), ("v3", "b", "t", t(20), "cotizacion", 0),
            ("v4", None, "t", t(9), "cotizacion", 1), ("v4", None, "t", t(9), "cotizacion", 1), (None, "b", "t", t(30), "cotizacion", 1), ("v6", "b", "t", None, "cotizacion", 1)]
    visits = spark.createDataFrame(seen, kinds)
    tx = spark.createDataFrame(
        [("p1", "a", t(2), "x", 10.0, "e"), ("p2", "a", t(4), "y", 5.0, "e"), ("p3", "a", t(6, 12), "x", 1.0, "e"), ("p4", "a", t(10), None, 7.0, "e"), ("p5", "a", t(25), "z", 7.0, "e"),
         ("p6", None, t(1), "x", 3.0, "e"), ("p7", "b", t(28), "y", 3.0, "e"), ("p8", "b", None, "w", 3.0, "e")],
        "id_transaccion string, id_cliente string, fecha_compra timestamp_ntz, categoria_producto string, monto_pago double, medio_pago string")
    # a training table whose histories are wrong throughout
    table = visits.select("id_interaccion", *asof.WHOSE, *[F.lit(99).alias(c) for c in FEATURE_COLS], TARGET)
    out = asof.without_leak(table, asof.visit_histories(visits, tx))
    assert out.columns == ["id_interaccion", *FEATURE_COLS, TARGET]
    got = sorted(((r["id_interaccion"] or "", r["recency_dias"], r["diversidad_categorias"], r["frequency"], r["total_visitas"]) for r in out.collect()))
    assert got == [("", 2, 2, 2, 2), ("v1", 0, 0, 0, 0), ("v2", 0, 2, 3, 1), ("v3", 0, 1, 1, 1), ("v3", 10, 2, 4, 2), ("v4", 0, 0, 0, 0), ("v4", 0, 0, 0, 0), ("v6", 0, 1, 1, 0)]


@pytest.fixture(scope="module")
def published(spark):
    return catalog.publish_artefacts(spark, SMALL)


def test_scoring_from_the_manifest_fits_nothing(spark, published, monkeypatch):
    from vitrina.operators import propensity, segmentation

    def never(*a, **k):
        raise AssertionError("fitted")

    for module, name in ((propensity, "fit"), (segmentation, "fit_many"), (segmentation, "segment_model")):
        monkeypatch.setattr(module, name, never)
    visits = catalog.raw(spark, SMALL).interacciones
    assert catalog.recommend_all(spark, visits, published).count() == visits.count()
    assert catalog.segment_all(spark, visits, published).count() > 0


def test_wrong_or_half_written_manifests_are_refused(spark, published):
    base = scratch_dir(spark, "test-artefacts")
    with pytest.raises(artefacts.ArtefactError, match="no manifest"):
        artefacts.load(spark, base)
    manifest = spark.read.parquet(f"{published}/manifest")
    spoiled = {
        "layout": manifest.withColumn("layout", F.lit(99)), "none": manifest.where("1 = 0"), "twice": manifest.union(manifest),
        "model": manifest.withColumn("propensity", F.lit(f"{base}/nowhere")), "rows": manifest.withColumn("n_profiles", F.col("n_profiles") + 1),
        "columns": manifest.withColumn("columns", F.array(F.lit("x"))),
    }
    for name, m in spoiled.items():
        m.coalesce(1).write.parquet(f"{base}/{name}/manifest")
        with pytest.raises(artefacts.ArtefactError):
            artefacts.load(spark, f"{base}/{name}")
    assert artefacts.load(spark, published).profiles.count() > 0
