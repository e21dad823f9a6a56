"""Independent DuckDB SQL for every exactly checkable query key.

Each oracle is self-contained: the fixture views (``FIXTURE_CTES``) plus the
CTEs it needs, written directly in SQL (not generated from the Spark plans),
so a wrong Spark operator cannot make its own oracle wrong too.
"""

from __future__ import annotations

from ..functions import dims
from ..sources.fixtures import FIXTURE_CTES


def with_ctes(*ctes: str, body: str) -> str:
    parts = [FIXTURE_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


# --- cleaning ---------------------------------------------------------------
ZM = """
zm AS (
  SELECT zona_geografica, median(score_credito_interno) AS mediana_zona
  FROM clientes WHERE zona_geografica IS NOT NULL GROUP BY zona_geografica
)"""
C1 = """
c1 AS (
  SELECT c.*, coalesce(c.score_credito_interno, zm.mediana_zona) AS s1
  FROM clientes c LEFT JOIN zm ON c.zona_geografica = zm.zona_geografica
)"""
PHONE_SQL = r"CAST(coalesce(regexp_matches(celular_contacto, '^\d{10}$'), false) AS INTEGER)"
EMAIL_SQL = r"CAST(coalesce(regexp_matches(email_contacto, '^[\w.-]+@[\w.-]+\.\w+$'), false) AS INTEGER)"
CLEAN = f"""
clientes_clean AS (
  SELECT id_cliente, zona_geografica, antiguedad_meses,
    coalesce(s1, (SELECT median(s1) FROM c1)) AS score_credito_interno,
    {PHONE_SQL} AS tiene_celular_valido,
    {EMAIL_SQL} AS tiene_email_valido
  FROM c1
)"""
CLEAN_CTES = (ZM, C1, CLEAN)

# --- purchase features --------------------------------------------------------
TX_AGG = """
tx_agg AS (
  SELECT id_cliente, max(fecha_compra) AS ultima, count(id_transaccion) AS frequency,
    round(sum(monto_pago), 4) AS mt, count(monto_pago) AS nm,
    max(monto_pago) AS ticket_max,
    count(DISTINCT categoria_producto) AS diversidad_categorias,
    CAST(max(CASE WHEN coalesce(medio_pago = 'credito_propio_retail', false) THEN 1 ELSE 0 END) AS INTEGER)
      AS usa_credito_propio
  FROM transacciones GROUP BY id_cliente
)"""
FAV = """
fav AS (
  SELECT id_cliente, v AS categoria_favorita FROM (
    SELECT id_cliente, categoria_producto AS v,
      row_number() OVER (PARTITION BY id_cliente ORDER BY count(*) DESC, categoria_producto) AS rn
    FROM transacciones WHERE categoria_producto IS NOT NULL GROUP BY id_cliente, categoria_producto)
  WHERE rn = 1
)"""
PAY = """
pay AS (
  SELECT id_cliente, v AS medio_pago_habitual FROM (
    SELECT id_cliente, medio_pago AS v,
      row_number() OVER (PARTITION BY id_cliente ORDER BY count(*) DESC, medio_pago) AS rn
    FROM transacciones WHERE medio_pago IS NOT NULL GROUP BY id_cliente, medio_pago)
  WHERE rn = 1
)"""
TXF = """
tx_features AS (
  SELECT a.id_cliente,
    date_sub('day', a.ultima, (SELECT max(fecha_compra) FROM transacciones)) AS recency_dias,
    a.frequency, coalesce(a.mt, 0.0) AS monetary_total,
    CASE WHEN a.nm = 0 THEN NULL ELSE a.mt / a.nm END AS monetary_avg,
    a.ticket_max, a.diversidad_categorias, f.categoria_favorita, p.medio_pago_habitual,
    a.usa_credito_propio
  FROM tx_agg a LEFT JOIN fav f ON a.id_cliente = f.id_cliente
    LEFT JOIN pay p ON a.id_cliente = p.id_cliente
  WHERE a.id_cliente IS NOT NULL
)"""
TX_CTES = (TX_AGG, FAV, PAY, TXF)

# --- visit features -----------------------------------------------------------
VF = """
visit_features AS (
  SELECT id_cliente, count(id_interaccion) AS total_visitas,
    avg(compro_en_visita) AS tasa_conversion_hist,
    count(*) FILTER (WHERE motivo_visita = 'servicio_tecnico') AS visitas_servicio_tecnico,
    count(*) FILTER (WHERE motivo_visita = 'cotizacion') AS visitas_cotizacion,
    count(*) FILTER (WHERE motivo_visita = 'reclamo') AS visitas_reclamo,
    count(*) FILTER (WHERE motivo_visita = 'pago_cuota_credito') AS visitas_pago_cuota,
    date_sub('day', max(fecha_visita), (SELECT max(fecha_visita) FROM interacciones))
      AS dias_desde_ultima_visita
  FROM interacciones WHERE id_cliente IS NOT NULL GROUP BY id_cliente
)"""
VISIT_CTES = (VF,)

C360 = """
customer_360 AS (
  SELECT c.id_cliente, c.zona_geografica, coalesce(c.antiguedad_meses, 0) AS antiguedad_meses,
    coalesce(c.score_credito_interno, 0) AS score_credito_interno,
    coalesce(c.tiene_celular_valido, 0) AS tiene_celular_valido,
    coalesce(c.tiene_email_valido, 0) AS tiene_email_valido,
    coalesce(t.recency_dias, 0) AS recency_dias, coalesce(t.frequency, 0) AS frequency,
    coalesce(t.monetary_total, 0) AS monetary_total, coalesce(t.monetary_avg, 0) AS monetary_avg,
    coalesce(t.ticket_max, 0) AS ticket_max, coalesce(t.diversidad_categorias, 0) AS diversidad_categorias,
    t.categoria_favorita, t.medio_pago_habitual, coalesce(t.usa_credito_propio, 0) AS usa_credito_propio,
    coalesce(v.total_visitas, 0) AS total_visitas, coalesce(v.tasa_conversion_hist, 0) AS tasa_conversion_hist,
    coalesce(v.visitas_servicio_tecnico, 0) AS visitas_servicio_tecnico,
    coalesce(v.visitas_cotizacion, 0) AS visitas_cotizacion,
    coalesce(v.visitas_reclamo, 0) AS visitas_reclamo,
    coalesce(v.visitas_pago_cuota, 0) AS visitas_pago_cuota,
    coalesce(v.dias_desde_ultima_visita, 0) AS dias_desde_ultima_visita
  FROM clientes_clean c LEFT JOIN tx_features t ON c.id_cliente = t.id_cliente
    LEFT JOIN visit_features v ON c.id_cliente = v.id_cliente
)"""
C360_CTES = CLEAN_CTES + TX_CTES + VISIT_CTES + (C360,)

ORACLES: dict[str, str] = {}


def oracle(key: str, *ctes: str):
    def register(body: str):
        ORACLES[key] = with_ctes(*ctes, body=body)
        return body
    return register


oracle("src_clientes")("SELECT * FROM clientes")
oracle("src_transacciones")("SELECT * FROM transacciones")
oracle("src_interacciones")("SELECT * FROM interacciones")
oracle("raw_load")("""
SELECT 'clientes' AS tabla, '' AS columna, count(*) FILTER (antiguedad_meses % 7 <> 0) AS filas FROM clientes
UNION ALL SELECT 'transacciones', '', count(*) FROM transacciones
UNION ALL SELECT 'interacciones', '', count(*) FILTER (id_tienda <> 't3') FROM interacciones
UNION ALL SELECT 'clientes', 'score_credito_interno', count(*) FROM clientes WHERE antiguedad_meses % 7 = 0 HAVING count(*) > 0
UNION ALL SELECT 'interacciones', 'fecha_visita', count(*) FROM interacciones WHERE id_tienda = 't3' HAVING count(*) > 0
""")
oracle("drift_tables")("""
, t AS (SELECT coalesce(medio_pago = 'efectivo', false) AS ref, monto_pago, categoria_producto, medio_pago FROM transacciones),
k AS (SELECT monto_pago AS v, CAST(count(*) FILTER (ref) AS DOUBLE) AS r, CAST(count(*) FILTER (NOT ref) AS DOUBLE) AS c
      FROM t WHERE monto_pago IS NOT NULL GROUP BY monto_pago),
d AS (SELECT sum(r) OVER (ORDER BY v) / (SELECT sum(r) FROM k) - sum(c) OVER (ORDER BY v) / (SELECT sum(c) FROM k) AS gap FROM k),
l AS (SELECT 'categoria_producto' AS columna, categoria_producto AS v, ref FROM t UNION ALL SELECT 'medio_pago', medio_pago, ref FROM t),
g AS (SELECT columna, v, CAST(count(*) FILTER (ref) AS DOUBLE) AS r, CAST(count(*) FILTER (NOT ref) AS DOUBLE) AS c
      FROM l WHERE v IS NOT NULL GROUP BY columna, v),
n AS (SELECT *, r * sum(c) OVER (PARTITION BY columna) / sum(r) OVER (PARTITION BY columna) AS e FROM g)
SELECT 'monto_pago' AS columna, 'ks' AS test, round(max(abs(gap)), 9) AS statistic FROM d
UNION ALL SELECT columna, 'chi2', round(sum(CASE WHEN e = 0 THEN CASE WHEN c = 0 THEN 0.0 ELSE CAST('inf' AS DOUBLE) END ELSE (c - e) * (c - e) / e END), 9)
FROM n GROUP BY columna
""")
oracle("visit_asof")("""
, ev AS (
  SELECT id_cliente, CAST(fecha_visita AS TIMESTAMP) AS ts, 1 AS kind, id_interaccion AS event, 1 AS v, compro_en_visita AS b,
    CASE WHEN motivo_visita = 'servicio_tecnico' THEN 1 ELSE 0 END AS s, CASE WHEN motivo_visita = 'cotizacion' THEN 1 ELSE 0 END AS q,
    CASE WHEN motivo_visita = 'reclamo' THEN 1 ELSE 0 END AS r, 0 AS p, NULL AS m FROM interacciones
  UNION ALL
  SELECT id_cliente, CAST(fecha_compra AS TIMESTAMP), 0, id_transaccion, 0, 0, 0, 0, 0, 1, monto_pago FROM transacciones
), w AS (
  SELECT *, coalesce(sum(v) OVER past, 0) AS nv, coalesce(sum(b) OVER past, 0) AS nb, coalesce(sum(s) OVER past, 0) AS ns,
    coalesce(sum(q) OVER past, 0) AS nq, coalesce(sum(r) OVER past, 0) AS nr, coalesce(sum(p) OVER past, 0) AS np,
    coalesce(sum(CAST(m AS DECIMAL(38, 4))) OVER past, 0) AS nm, count(m) OVER past AS nc
  FROM ev WHERE id_cliente IS NOT NULL
  WINDOW past AS (PARTITION BY id_cliente ORDER BY ts NULLS FIRST, kind, event ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT event AS id_interaccion, CAST(nv AS BIGINT) AS total_visitas, CASE WHEN nv = 0 THEN 0.0 ELSE CAST(nb AS DOUBLE) / nv END AS tasa_conversion_hist,
  CAST(ns AS BIGINT) AS visitas_servicio_tecnico, CAST(nq AS BIGINT) AS visitas_cotizacion, CAST(nr AS BIGINT) AS visitas_reclamo,
  CAST(np AS BIGINT) AS frequency, CAST(nm AS DOUBLE) AS monetary_total, CASE WHEN nc = 0 THEN 0.0 ELSE CAST(nm AS DOUBLE) / nc END AS monetary_avg
FROM w WHERE kind = 1
UNION ALL SELECT id_interaccion, 0, 0.0, 0, 0, 0, 0, 0.0, 0.0 FROM interacciones WHERE id_cliente IS NULL
""")
oracle("clean_phone")(f"SELECT id_cliente, celular_contacto, {PHONE_SQL} AS tiene_celular_valido FROM clientes")
oracle("clean_email")(f"SELECT id_cliente, email_contacto, {EMAIL_SQL} AS tiene_email_valido FROM clientes")
oracle("zone_median", ZM)("SELECT * FROM zm")
oracle("impute_zone", ZM, C1)("SELECT id_cliente, zona_geografica, s1 AS score_credito_interno FROM c1")
oracle("impute_global", *CLEAN_CTES)("SELECT id_cliente, score_credito_interno FROM clientes_clean")
oracle("clean_clientes", *CLEAN_CTES)("SELECT * FROM clientes_clean")

oracle("tx_ref_date")("SELECT max(fecha_compra) AS fecha_ref FROM transacciones")
for _key, _col in [("tx_recency", "recency_dias"), ("tx_frequency", "frequency"),
                   ("tx_monetary", "monetary_total"), ("tx_avg", "monetary_avg"),
                   ("tx_ticket_max", "ticket_max"), ("tx_diversity", "diversidad_categorias"),
                   ("tx_fav_category", "categoria_favorita"),
                   ("tx_usual_payment", "medio_pago_habitual"),
                   ("tx_uses_credit", "usa_credito_propio")]:
    oracle(_key, *TX_CTES)(f"SELECT id_cliente, {_col} FROM tx_features")
oracle("tx_features", *TX_CTES)("SELECT * FROM tx_features")

oracle("visit_ref_date")("SELECT max(fecha_visita) AS fecha_ref FROM interacciones")
for _key, _col in [("visit_total", "total_visitas"), ("visit_conversion", "tasa_conversion_hist"),
                   ("visit_service", "visitas_servicio_tecnico"), ("visit_quote", "visitas_cotizacion"),
                   ("visit_claim", "visitas_reclamo"), ("visit_instalment", "visitas_pago_cuota"),
                   ("visit_recency", "dias_desde_ultima_visita")]:
    oracle(_key, *VISIT_CTES)(f"SELECT id_cliente, {_col} FROM visit_features")
oracle("visit_features", *VISIT_CTES)("SELECT * FROM visit_features")
oracle("customer_360", *C360_CTES)("SELECT * FROM customer_360")

# --- sources, previews ----------------------------------------------------------
_NA_LIST = ", ".join("'" + s + "'" for s in __import__("vitrina.functions.columns", fromlist=["x"]).NA_STRINGS)


def _na(col: str) -> str:
    return f"CASE WHEN {col} IN ({_NA_LIST}) THEN NULL ELSE {col} END AS {col}"


oracle("na_normalise")(
    f"SELECT {_na('id_cliente')}, {_na('zona_geografica')}, antiguedad_meses, score_credito_interno, "
    f"{_na('celular_contacto')}, {_na('email_contacto')} FROM clientes")

VJ = """
vj AS (
  SELECT i.id_interaccion, i.id_cliente, i.id_tienda, i.fecha_visita, i.motivo_visita, i.compro_en_visita,
    c.antiguedad_meses, c.score_credito_interno, c.tiene_celular_valido, c.tiene_email_valido,
    c.recency_dias, c.frequency, c.monetary_total, c.monetary_avg, c.diversidad_categorias,
    c.total_visitas, c.tasa_conversion_hist, c.visitas_servicio_tecnico, c.visitas_cotizacion,
    c.visitas_reclamo, c.zona_geografica
  FROM interacciones i LEFT JOIN customer_360 c ON i.id_cliente = c.id_cliente
)"""
DICT = """
dict AS (
  SELECT 'zona_geografica' AS columna, valor, CAST(row_number() OVER (ORDER BY valor) - 1 AS INTEGER) AS codigo
  FROM (SELECT DISTINCT zona_geografica AS valor FROM vj WHERE zona_geografica IS NOT NULL)
  UNION ALL
  SELECT 'motivo_visita', valor, CAST(row_number() OVER (ORDER BY valor) - 1 AS INTEGER)
  FROM (SELECT DISTINCT motivo_visita AS valor FROM vj WHERE motivo_visita IS NOT NULL)
  UNION ALL
  SELECT 'id_tienda', valor, CAST(row_number() OVER (ORDER BY valor) - 1 AS INTEGER)
  FROM (SELECT DISTINCT id_tienda AS valor FROM vj WHERE id_tienda IS NOT NULL)
)"""
CODED = """
coded AS (
  SELECT vj.*,
    CASE WHEN vj.zona_geografica IS NULL THEN 0 ELSE coalesce(dz.codigo, -1) END AS zona_code,
    CASE WHEN vj.motivo_visita IS NULL THEN 0 ELSE coalesce(dm.codigo, -1) END AS motivo_code,
    CASE WHEN vj.id_tienda IS NULL THEN 0 ELSE coalesce(dt.codigo, -1) END AS tienda_code
  FROM vj
  LEFT JOIN dict dz ON dz.columna = 'zona_geografica' AND dz.valor = vj.zona_geografica
  LEFT JOIN dict dm ON dm.columna = 'motivo_visita' AND dm.valor = vj.motivo_visita
  LEFT JOIN dict dt ON dt.columna = 'id_tienda' AND dt.valor = vj.id_tienda
)"""
WEEKDAY_SQL = "CAST(isodow(fecha_visita) - 1 AS INTEGER)"
MONTH_SQL = "CAST(month(fecha_visita) AS INTEGER)"
PAYDAY_SQL = "CAST(dayofmonth(fecha_visita) IN (14, 15, 16, 28, 29, 30, 31) AS INTEGER)"
VD = f"""
vd AS (
  SELECT id_interaccion, zona_code AS zona_geografica,
    coalesce(antiguedad_meses, 0) AS antiguedad_meses,
    coalesce(score_credito_interno, 0) AS score_credito_interno,
    coalesce(tiene_celular_valido, 0) AS tiene_celular_valido,
    coalesce(tiene_email_valido, 0) AS tiene_email_valido,
    coalesce(recency_dias, 0) AS recency_dias, coalesce(frequency, 0) AS frequency,
    coalesce(monetary_total, 0) AS monetary_total, coalesce(monetary_avg, 0) AS monetary_avg,
    coalesce(diversidad_categorias, 0) AS diversidad_categorias,
    coalesce(total_visitas, 0) AS total_visitas,
    coalesce(tasa_conversion_hist, 0) AS tasa_conversion_hist,
    coalesce(visitas_servicio_tecnico, 0) AS visitas_servicio_tecnico,
    coalesce(visitas_cotizacion, 0) AS visitas_cotizacion,
    coalesce(visitas_reclamo, 0) AS visitas_reclamo,
    motivo_code AS motivo_visita, tienda_code AS id_tienda,
    {WEEKDAY_SQL} AS dia_semana, {MONTH_SQL} AS mes, {PAYDAY_SQL} AS es_quincena,
    compro_en_visita
  FROM coded
)"""
VD_CTES = C360_CTES + (VJ, DICT, CODED, VD)

oracle("step_counts", *VD_CTES)("""
SELECT 'clientes' AS tabla, count(*) AS filas, CAST(6 AS INTEGER) AS columnas FROM clientes
UNION ALL SELECT 'transacciones', count(*), 6 FROM transacciones
UNION ALL SELECT 'interacciones', count(*), 6 FROM interacciones
UNION ALL SELECT 'clientes_clean', count(*), 6 FROM clientes_clean
UNION ALL SELECT 'customer_360', count(*), 22 FROM customer_360
UNION ALL SELECT 'visit_dataset', count(*), 22 FROM vd""")
oracle("head_c360", *C360_CTES)("SELECT * FROM customer_360 ORDER BY id_cliente LIMIT 5")
# sinks: the written tables, counted (or scanned with a filter) after the write
oracle("sink_clean", *CLEAN_CTES)("""
SELECT 'clientes_clean' AS tabla, count(*) AS filas FROM clientes_clean
UNION ALL SELECT 'transacciones_clean', count(*) FROM transacciones
UNION ALL SELECT 'interacciones_clean', count(*) FROM interacciones""")
oracle("sink_c360", *C360_CTES)("SELECT 'customer_360' AS tabla, count(*) AS filas FROM customer_360")
oracle("scan_c360", *C360_CTES)(
    "SELECT id_cliente, frequency, monetary_total FROM customer_360")
oracle("fill_numeric", *C360_CTES)("SELECT * FROM customer_360")
oracle("lookup_client", *C360_CTES)("""
SELECT a.id_cliente, CASE WHEN c.id_cliente IS NULL THEN 0 ELSE 1 END AS encontrado,
  c.zona_geografica, c.frequency, c.monetary_total
FROM (SELECT DISTINCT id_cliente FROM interacciones WHERE id_cliente IS NOT NULL) a
LEFT JOIN customer_360 c ON a.id_cliente = c.id_cliente""")

# --- lookups ---------------------------------------------------------------------
oracle("visit_join", *C360_CTES, VJ)("SELECT * FROM vj")
_TRANS = dims.values_sql(dims.CATEGORY_TRANSITIONS, ["categoria", "next_cat"])
oracle("next_category", *C360_CTES)(f"""
SELECT c.id_cliente, c.categoria_favorita, coalesce(t.next_cat, '{dims.DEFAULT_NEXT_CATEGORY}') AS next_best_category
FROM customer_360 c LEFT JOIN {_TRANS} ON c.categoria_favorita = t.categoria""")
_NAMES = dims.values_sql(dims.SEGMENT_NAMES, ["sid", "sname"])
SEG_RULE = f"""
seg AS (
  SELECT s.id_cliente, s.segmento_id, coalesce(t.sname, concat('Segmento ', CAST(s.segmento_id AS STRING))) AS segmento_nombre
  FROM (SELECT id_cliente, {{rule}} AS segmento_id FROM customer_360) s
  LEFT JOIN {_NAMES} ON s.segmento_id = t.sid
)"""
oracle("segment_name", *C360_CTES, SEG_RULE.replace("{rule}", "CAST(antiguedad_meses % 7 AS INT)"))(
    "SELECT * FROM seg")
_PB = dims.values_sql(dims.SEGMENT_PLAYBOOK, ["seg", "lec", "est"])
oracle("playbook", *C360_CTES, SEG_RULE.replace("{rule}", "CAST(antiguedad_meses % 7 AS INT)"))(f"""
SELECT s.id_cliente, s.segmento_nombre, coalesce(t.lec, '{dims.DEFAULT_PLAYBOOK[0]}') AS lectura,
  coalesce(t.est, '{dims.DEFAULT_PLAYBOOK[1]}') AS estrategia
FROM seg s LEFT JOIN {_PB} ON s.segmento_nombre = t.seg""")
_LAB = dims.values_sql(dims.VISIT_REASON_LABELS, ["m", "l"])
oracle("reason_label")(f"""
SELECT i.id_interaccion, i.motivo_visita, coalesce(t.l, i.motivo_visita) AS motivo_label,
  lower(coalesce(t.l, i.motivo_visita)) AS motivo_label_lower
FROM interacciones i LEFT JOIN {_LAB} ON i.motivo_visita = t.m""")

# --- training table ---------------------------------------------------------------
oracle("date_weekday")(f"SELECT id_interaccion, {WEEKDAY_SQL} AS dia_semana FROM interacciones")
oracle("date_month")(f"SELECT id_interaccion, {MONTH_SQL} AS mes FROM interacciones")
oracle("date_payday")(f"SELECT id_interaccion, {PAYDAY_SQL} AS es_quincena FROM interacciones")
oracle("ordinal_fit", *C360_CTES, VJ, DICT)("SELECT * FROM dict")
oracle("ordinal_apply", *C360_CTES, VJ, DICT, CODED)(
    "SELECT id_interaccion, zona_code AS zona_geografica, motivo_code AS motivo_visita, "
    "tienda_code AS id_tienda FROM coded")
oracle("visit_dataset", *VD_CTES)("SELECT * FROM vd")
oracle("target_rate", *VD_CTES)(
    "SELECT avg(compro_en_visita) AS target_rate, count(*) AS n_obs FROM vd")

# --- profiling and quality ---------------------------------------------------------
_NA_CLIENTES = f"""
cna AS (
  SELECT {_na('id_cliente')}, {_na('zona_geografica')}, antiguedad_meses, score_credito_interno,
    {_na('celular_contacto')}, {_na('email_contacto')} FROM clientes
)"""


def _problem_sql(col: str) -> str:
    c = f"CAST({col} AS VARCHAR)"
    return f"({c} IS NULL OR lower({c}) = 'null' OR regexp_matches({c}, '^\\s*$'))"


_COMP = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, 1 - count(*) FILTER (WHERE {_problem_sql(c)}) / count(*) AS completitud FROM cna"
    for c in ["id_cliente", "celular_contacto", "email_contacto", "score_credito_interno"])
_VALID = (f"SELECT 'celular_contacto' AS variable, avg({PHONE_SQL}) AS validez FROM cna UNION ALL "
          f"SELECT 'email_contacto', avg({EMAIL_SQL}) FROM cna")
_UNIQ = ("SELECT 'id_cliente' AS variable, 1 - (sum(n) - count(*)) / sum(n) AS unicidad "
         "FROM (SELECT id_cliente, count(*) AS n FROM cna GROUP BY id_cliente)")
oracle("dq_completeness", _NA_CLIENTES)(_COMP)
oracle("dq_validity", _NA_CLIENTES)(_VALID)
oracle("dq_uniqueness", _NA_CLIENTES)(_UNIQ)
oracle("dq_report", _NA_CLIENTES, f"comp AS ({_COMP})", f"val AS ({_VALID})", f"uniq AS ({_UNIQ})")("""
SELECT comp.variable, comp.completitud, val.validez, uniq.unicidad
FROM comp LEFT JOIN val ON comp.variable = val.variable LEFT JOIN uniq ON comp.variable = uniq.variable""")
oracle("id_coverage")("""
SELECT 'clientes' AS tabla, count(DISTINCT id_cliente) AS n_ids FROM clientes
UNION ALL SELECT 'transacciones', count(DISTINCT id_cliente) FROM transacciones
UNION ALL SELECT 'interacciones', count(DISTINCT id_cliente) FROM interacciones""")
oracle("id_intersection")("""
SELECT count(*) AS n_ids_en_todas FROM (
  SELECT id_cliente FROM clientes WHERE id_cliente IS NOT NULL
  INTERSECT SELECT id_cliente FROM transacciones WHERE id_cliente IS NOT NULL
  INTERSECT SELECT id_cliente FROM interacciones WHERE id_cliente IS NOT NULL)""")
oracle("value_counts")(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS valor, count(*) AS n FROM {t} "
    f"WHERE {c} IS NOT NULL GROUP BY {c}"
    for c, t in [("zona_geografica", "clientes"), ("categoria_producto", "transacciones"),
                 ("medio_pago", "transacciones"), ("motivo_visita", "interacciones"),
                 ("compro_en_visita", "interacciones")]))


def _hist_sql(col: str, bins: int = 15) -> str:
    return f"""
SELECT '{col}' AS variable, s.bin, st.lo + s.bin * st.w AS desde, st.lo + (s.bin + 1) * st.w AS hasta,
  coalesce(c.n, 0) AS n
FROM (SELECT min(CAST({col} AS DOUBLE)) AS lo, max(CAST({col} AS DOUBLE)) AS hi,
        (max(CAST({col} AS DOUBLE)) - min(CAST({col} AS DOUBLE))) / {bins} AS w FROM clientes) st
CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(0, {bins})) s
LEFT JOIN (
  SELECT CASE WHEN st2.hi = st2.lo THEN 0
    ELSE least(CAST(floor((CAST(x.{col} AS DOUBLE) - st2.lo) / ((st2.hi - st2.lo) / {bins})) AS INTEGER), {bins - 1}) END AS bin,
    count(*) AS n
  FROM clientes x, (SELECT min(CAST({col} AS DOUBLE)) AS lo, max(CAST({col} AS DOUBLE)) AS hi FROM clientes) st2
  WHERE x.{col} IS NOT NULL GROUP BY 1) c ON c.bin = s.bin"""


oracle("histogram")(_hist_sql("antiguedad_meses") + "\nUNION ALL" + _hist_sql("score_credito_interno"))
oracle("monthly_counts")("""
SELECT CAST(m.mes AS DATE) AS mes, coalesce(c.n, 0) AS n
FROM (SELECT unnest(generate_series(min(date_trunc('month', fecha_compra)), max(date_trunc('month', fecha_compra)),
        INTERVAL 1 MONTH)) AS mes FROM transacciones) m
LEFT JOIN (SELECT date_trunc('month', fecha_compra) AS mes, count(id_transaccion) AS n FROM transacciones
           WHERE fecha_compra IS NOT NULL GROUP BY 1) c ON c.mes = m.mes""")
oracle("conversion_by_reason")("""
SELECT motivo_visita, avg(compro_en_visita) AS tasa_conversion FROM interacciones
WHERE motivo_visita IS NOT NULL GROUP BY motivo_visita""")

C360_NUMERIC = ["antiguedad_meses", "score_credito_interno", "tiene_celular_valido", "tiene_email_valido",
                "recency_dias", "frequency", "monetary_total", "monetary_avg", "ticket_max",
                "diversidad_categorias", "usa_credito_propio", "total_visitas", "tasa_conversion_hist",
                "visitas_servicio_tecnico", "visitas_cotizacion", "visitas_reclamo", "visitas_pago_cuota",
                "dias_desde_ultima_visita"]


def _corr_sql(columns) -> str:
    aggs = [f"stddev_pop(CAST({c} AS DOUBLE)) AS s_{i}" for i, c in enumerate(columns)]
    rows = []
    for i in range(len(columns)):
        for j in range(i + 1, len(columns)):
            aggs.append(f"covar_pop(CAST({columns[j]} AS DOUBLE), CAST({columns[i]} AS DOUBLE)) AS c_{i}_{j}")
            rows.append(f"SELECT '{columns[j]}' AS variable_a, '{columns[i]}' AS variable_b, "
                        f"round_even(CASE WHEN s_{i} * s_{j} = 0 THEN NULL ELSE c_{i}_{j} / (s_{i} * s_{j}) END, 6)"
                        f" AS correlacion FROM agg")
    return f"agg AS (SELECT {', '.join(aggs)} FROM customer_360)", " UNION ALL ".join(rows)


_CA, _CB = _corr_sql(C360_NUMERIC)
oracle("correlation", *C360_CTES, _CA)(_CB)

# --- evaluation on the fixed score rule -----------------------------------------------
SCORED = """
scored AS (
  SELECT id_interaccion, compro_en_visita AS y,
    0.5 * CAST(motivo_visita = 'cotizacion' AS DOUBLE) + 0.5 * coalesce(tasa_conversion_hist, 0) AS score
  FROM vj
)"""
CS = """
cs AS (
  SELECT score, pos, neg,
    sum(pos) OVER (ORDER BY score) AS cum_pos, sum(neg) OVER (ORDER BY score) AS cum_neg,
    sum(pos) OVER () AS P, sum(neg) OVER () AS N
  FROM (SELECT score, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg
        FROM scored WHERE score IS NOT NULL GROUP BY score)
),
tf AS (SELECT score, pos, P, N, P - cum_pos + pos AS tps, N - cum_neg + neg AS fps FROM cs)"""
EVAL_CTES = C360_CTES + (VJ, SCORED, CS)
oracle("auc", *EVAL_CTES)(
    "SELECT sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (max(P) * max(N)) AS auc FROM cs")
oracle("roc_curve", *EVAL_CTES)("""
SELECT score AS threshold, fps / N AS fpr, tps / P AS tpr FROM tf
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
oracle("pr_curve", *EVAL_CTES)("""
SELECT score AS threshold, CASE WHEN tps + fps = 0 THEN 0.0 ELSE tps / (tps + fps) END AS precision,
  tps / P AS recall FROM tf
UNION ALL SELECT NULL, 1.0, 0.0""")
oracle("avg_precision", *EVAL_CTES)(
    "SELECT sum((pos / P) * (tps / (tps + fps))) AS average_precision FROM tf")
oracle("confusion", *C360_CTES, VJ, SCORED)("""
SELECT a.y_real, b.y_pred, coalesce(c.n, 0) AS n
FROM (VALUES (0), (1)) a(y_real) CROSS JOIN (VALUES (0), (1)) b(y_pred)
LEFT JOIN (SELECT y AS y_real, CAST(score > 0.5 AS INTEGER) AS y_pred, count(*) AS n FROM scored GROUP BY 1, 2) c
  ON a.y_real = c.y_real AND b.y_pred = c.y_pred""")
oracle("class_report", *C360_CTES, VJ, SCORED, """
m AS (
  SELECT count(*) FILTER (WHERE y = 0 AND score <= 0.5) AS n00, count(*) FILTER (WHERE y = 0 AND score > 0.5) AS n01,
         count(*) FILTER (WHERE y = 1 AND score <= 0.5) AS n10, count(*) FILTER (WHERE y = 1 AND score > 0.5) AS n11
  FROM scored
)""", """
pc AS (
  SELECT 'No compra' AS clase,
    CASE WHEN n00 + n10 = 0 THEN 0.0 ELSE n00 / (n00 + n10) END AS precision,
    CASE WHEN n00 + n01 = 0 THEN 0.0 ELSE n00 / (n00 + n01) END AS recall,
    CASE WHEN (n00 + n01) + (n00 + n10) = 0 THEN 0.0 ELSE 2 * n00 / ((n00 + n01) + (n00 + n10)) END AS f1_score,
    n00 + n01 AS support, n00 + n01 + n10 + n11 AS total, 0 AS k FROM m
  UNION ALL
  SELECT 'Compra',
    CASE WHEN n11 + n01 = 0 THEN 0.0 ELSE n11 / (n11 + n01) END,
    CASE WHEN n11 + n10 = 0 THEN 0.0 ELSE n11 / (n11 + n10) END,
    CASE WHEN (n11 + n10) + (n11 + n01) = 0 THEN 0.0 ELSE 2 * n11 / ((n11 + n10) + (n11 + n01)) END,
    n11 + n10, n00 + n01 + n10 + n11, 1 FROM m
)""")("""
SELECT clase, precision, recall, f1_score, support FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT (n00 + n11) / (n00 + n01 + n10 + n11) FROM m), max(total) FROM pc
UNION ALL SELECT 'macro avg',
  (max(precision) FILTER (WHERE k = 0) + max(precision) FILTER (WHERE k = 1)) / 2,
  (max(recall) FILTER (WHERE k = 0) + max(recall) FILTER (WHERE k = 1)) / 2,
  (max(f1_score) FILTER (WHERE k = 0) + max(f1_score) FILTER (WHERE k = 1)) / 2, max(total) FROM pc
UNION ALL SELECT 'weighted avg',
  (max(precision * support) FILTER (WHERE k = 0) + max(precision * support) FILTER (WHERE k = 1)) / max(total),
  (max(recall * support) FILTER (WHERE k = 0) + max(recall * support) FILTER (WHERE k = 1)) / max(total),
  (max(f1_score * support) FILTER (WHERE k = 0) + max(f1_score * support) FILTER (WHERE k = 1)) / max(total),
  max(total) FROM pc""")
DEC = """
edges AS (
  SELECT list_sort(list_distinct(quantile_cont(score, [0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5,
    0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]))) AS ed FROM scored
),
dec AS (
  SELECT s.id_interaccion, s.y, s.score, greatest(len(list_filter(e.ed, lambda x: x < s.score)) - 1, 0) AS decil
  FROM scored s CROSS JOIN edges e
)"""
oracle("deciles", *C360_CTES, VJ, SCORED, DEC)("SELECT * FROM dec")
oracle("lift_by_decile", *C360_CTES, VJ, SCORED, DEC)(
    "SELECT decil, avg(y) AS tasa_compra, count(*) AS n FROM dec GROUP BY decil")
oracle("top_lift", *C360_CTES, VJ, SCORED, DEC)("""
SELECT b.baseline, t.tasa_top, t.tasa_top / b.baseline AS lift_top
FROM (SELECT avg(y) AS baseline FROM dec) b,
     (SELECT arg_max(r, decil) AS tasa_top FROM (SELECT decil, avg(y) AS r FROM dec GROUP BY decil)) t""")
oracle("top_row", *C360_CTES, VJ, SCORED)(
    "SELECT * FROM scored ORDER BY score DESC, id_interaccion ASC LIMIT 1")

# --- drift ------------------------------------------------------------------------------
DRIFT_NUMERIC_COLS = ["antiguedad_meses", "score_credito_interno", "tiene_celular_valido", "tiene_email_valido",
                      "recency_dias", "frequency", "monetary_total", "monetary_avg", "diversidad_categorias",
                      "total_visitas", "tasa_conversion_hist", "visitas_servicio_tecnico", "visitas_cotizacion",
                      "visitas_reclamo", "dia_semana", "mes", "es_quincena"]
DRIFT_CAT_COLS = ["zona_geografica", "motivo_visita", "id_tienda", "target"]
SPLIT = """
vdx AS (
  SELECT vd.*, vd.compro_en_visita AS target, c.fecha_visita AS fecha_orden
  FROM vd JOIN coded c ON vd.id_interaccion = c.id_interaccion
),
split AS (
  SELECT vdx.*, CASE WHEN row_number() OVER (ORDER BY fecha_orden, id_interaccion) <= (SELECT count(*) FROM vdx) // 2
    THEN 'referencia' ELSE 'actual' END AS corte
  FROM vdx
)"""


def _long_sql(cols) -> str:
    body = " UNION ALL ".join(f"SELECT corte, '{c}' AS columna, CAST({c} AS DOUBLE) AS valor FROM split"
                              for c in cols)
    return f"""
lc AS (
  SELECT columna, valor, count(*) FILTER (WHERE corte = 'referencia') AS n_ref,
    count(*) FILTER (WHERE corte = 'actual') AS n_cur
  FROM ({body}) WHERE valor IS NOT NULL GROUP BY columna, valor
)"""


oracle("drift_split", *VD_CTES, SPLIT)("SELECT id_interaccion, corte FROM split")
oracle("drift_ks", *VD_CTES, SPLIT, _long_sql(DRIFT_NUMERIC_COLS))("""
SELECT columna, max(abs(c1 / N1 - c2 / N2)) AS statistic, CAST(max(N1) AS BIGINT) AS n_ref,
  CAST(max(N2) AS BIGINT) AS n_cur
FROM (SELECT columna, sum(n_ref) OVER (PARTITION BY columna ORDER BY valor) AS c1,
        sum(n_cur) OVER (PARTITION BY columna ORDER BY valor) AS c2,
        sum(n_ref) OVER (PARTITION BY columna) AS N1, sum(n_cur) OVER (PARTITION BY columna) AS N2 FROM lc)
GROUP BY columna""")
oracle("drift_chi2", *VD_CTES, SPLIT, _long_sql(DRIFT_CAT_COLS))("""
SELECT columna,
  round_even(sum(CASE WHEN e = 0 THEN (CASE WHEN n_cur = 0 THEN 0.0 ELSE CAST('inf' AS DOUBLE) END)
      ELSE (n_cur - e) * (n_cur - e) / e END), 9) AS statistic,
  count(*) - 1 AS dof
FROM (SELECT columna, n_ref, CAST(n_cur AS DOUBLE) AS n_cur,
        n_ref * (CAST(sum(n_cur) OVER (PARTITION BY columna) AS DOUBLE) / sum(n_ref) OVER (PARTITION BY columna)) AS e
      FROM lc)
GROUP BY columna""")

# --- segmentation (fixed segment rule) --------------------------------------------
SEG_FEATURES = ["recency_dias", "frequency", "monetary_total", "monetary_avg", "total_visitas",
                "tasa_conversion_hist", "usa_credito_propio", "diversidad_categorias",
                "score_credito_interno", "antiguedad_meses"]
_Z = ", ".join(
    f"round_even((CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM customer_360)) / "
    f"(SELECT CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END "
    f"FROM customer_360), 9) AS {c}" for c in SEG_FEATURES)
oracle("seg_scaled", *C360_CTES)(f"SELECT id_cliente, {_Z} FROM customer_360")
_RULE_SEG = SEG_RULE.replace("{rule}", "CAST(antiguedad_meses % 7 AS INT)")
oracle("segment_profile", *C360_CTES, _RULE_SEG)(
    "SELECT s.segmento_nombre, " + ", ".join(f"round_even(avg(c.{c}), 2) AS {c}" for c in SEG_FEATURES) +
    " FROM seg s JOIN customer_360 c ON s.id_cliente = c.id_cliente GROUP BY s.segmento_nombre")
BOX_COLS = ["monetary_total", "frequency", "recency_dias", "tasa_conversion_hist"]
_LONG_BOX = " UNION ALL ".join(
    f"SELECT s.segmento_nombre, '{c}' AS variable, CAST(c.{c} AS DOUBLE) AS x "
    f"FROM seg s JOIN customer_360 c ON s.id_cliente = c.id_cliente" for c in BOX_COLS)
oracle("segment_box", *C360_CTES, _RULE_SEG, f"lb AS ({_LONG_BOX})", """
rk AS (
  SELECT segmento_nombre, variable, x,
    row_number() OVER (PARTITION BY segmento_nombre, variable ORDER BY x) - 1 AS r,
    count(*) OVER (PARTITION BY segmento_nombre, variable) AS n
  FROM lb WHERE x IS NOT NULL
)""", """
pr AS (
  SELECT g.segmento_nombre, g.variable, p.p, p.p * (g.n - 1) AS h, CAST(floor(p.p * (g.n - 1)) AS BIGINT) AS j
  FROM (SELECT DISTINCT segmento_nombre, variable, n FROM rk) g CROSS JOIN (VALUES (0.25), (0.5), (0.75)) p(p)
)""", """
qv AS (
  SELECT pr.segmento_nombre, pr.variable, pr.p,
    CASE WHEN b.x IS NULL THEN a.x
         WHEN pr.h - pr.j >= 0.5 THEN b.x - (b.x - a.x) * (1.0 - (pr.h - pr.j))
         ELSE a.x + (b.x - a.x) * (pr.h - pr.j) END AS q
  FROM pr JOIN rk a ON a.segmento_nombre = pr.segmento_nombre AND a.variable = pr.variable AND a.r = pr.j
  LEFT JOIN rk b ON b.segmento_nombre = pr.segmento_nombre AND b.variable = pr.variable AND b.r = pr.j + 1
)""", """
fe AS (
  SELECT segmento_nombre, variable, max(q) FILTER (WHERE p = 0.25) AS q1, max(q) FILTER (WHERE p = 0.5) AS mediana,
    max(q) FILTER (WHERE p = 0.75) AS q3
  FROM qv GROUP BY segmento_nombre, variable
)""")("""
SELECT fe.segmento_nombre, fe.variable, fe.q1, fe.mediana, fe.q3,
  min(lb.x) FILTER (WHERE lb.x >= fe.q1 - 1.5 * (fe.q3 - fe.q1) AND lb.x <= fe.q3 + 1.5 * (fe.q3 - fe.q1)) AS bigote_inf,
  max(lb.x) FILTER (WHERE lb.x >= fe.q1 - 1.5 * (fe.q3 - fe.q1) AND lb.x <= fe.q3 + 1.5 * (fe.q3 - fe.q1)) AS bigote_sup,
  count(*) FILTER (WHERE NOT (lb.x >= fe.q1 - 1.5 * (fe.q3 - fe.q1) AND lb.x <= fe.q3 + 1.5 * (fe.q3 - fe.q1))) AS n_atipicos
FROM fe JOIN lb ON lb.segmento_nombre = fe.segmento_nombre AND lb.variable = fe.variable
WHERE lb.x IS NOT NULL
GROUP BY fe.segmento_nombre, fe.variable, fe.q1, fe.mediana, fe.q3""")

# --- propensity: stratified folds ---------------------------------------------------
oracle("folds", *VD_CTES)("""
SELECT id_interaccion, compro_en_visita,
  CAST((row_number() OVER (PARTITION BY compro_en_visita
        ORDER BY md5(concat(id_interaccion, '42')), id_interaccion) - 1) % 5 AS INTEGER) AS fold
FROM vd""")

# --- next-best-action (fixed segment and score rules) ---------------------------------
LK = """
lk AS (
  SELECT i.id_interaccion, i.id_cliente, i.id_tienda, i.fecha_visita, i.motivo_visita,
    c.* EXCLUDE (id_cliente), c.id_cliente IS NOT NULL AS found
  FROM interacciones i LEFT JOIN customer_360 c ON i.id_cliente = c.id_cliente
)"""
_TPL = dims.values_sql(dims.ACTION_TEMPLATES, ["seg", "tpl"])
RR = f"""
rr AS (
  SELECT lk.id_interaccion, lk.id_cliente, lk.motivo_visita, lk.categoria_favorita,
    coalesce(sn.sname, concat('Segmento ', CAST(CAST(lk.antiguedad_meses % 7 AS INT) AS STRING))) AS segmento,
    0.5 * CAST(lk.motivo_visita = 'cotizacion' AS DOUBLE) + 0.5 * coalesce(lk.tasa_conversion_hist, 0) AS score
  FROM lk LEFT JOIN {_NAMES.replace(' AS t(', ' AS sn(')} ON CAST(lk.antiguedad_meses % 7 AS INT) = sn.sid
  WHERE lk.found
),
rec AS (
  SELECT rr.*, CASE WHEN score > 0.6 THEN 'ALTO' WHEN score > 0.35 THEN 'MEDIO' ELSE 'BAJO' END AS nivel,
    round_even(score, 3) AS score_compra_hoy,
    coalesce(t.next_cat, '{dims.DEFAULT_NEXT_CATEGORY}') AS next_best_category
  FROM rr LEFT JOIN {_TRANS} ON rr.categoria_favorita = t.categoria
),
act AS (
  SELECT rec.*, replace(coalesce(a.tpl, '{dims.DEFAULT_ACTION}'), '{{cat}}', next_best_category)
    || CASE WHEN nivel = 'BAJO' THEN '{dims.LOW_PRIORITY_SUFFIX}' ELSE '' END AS accion_recomendada
  FROM rec LEFT JOIN {_TPL.replace(' AS t(', ' AS a(')} ON rec.segmento = a.seg
)"""
NBA_CTES = C360_CTES + (LK, RR)
oracle("nba_lookup", *C360_CTES, LK)("""
SELECT id_interaccion, id_cliente, CAST(found AS INTEGER) AS encontrado,
  CASE WHEN found THEN NULL ELSE concat('Cliente ', coalesce(id_cliente, 'None'), ' no encontrado') END AS error
FROM lk""")
oracle("nba_features", *VD_CTES, LK)(f"""
SELECT lk.id_interaccion,
  CASE WHEN lk.zona_geografica IS NULL THEN -1 ELSE coalesce(dz.codigo, -1) END AS zona_geografica,
  lk.antiguedad_meses, lk.score_credito_interno, lk.tiene_celular_valido, lk.tiene_email_valido,
  lk.recency_dias, lk.frequency, lk.monetary_total, lk.monetary_avg, lk.diversidad_categorias,
  lk.total_visitas, lk.tasa_conversion_hist, lk.visitas_servicio_tecnico, lk.visitas_cotizacion,
  lk.visitas_reclamo,
  CASE WHEN lk.motivo_visita IS NULL THEN -1 ELSE coalesce(dm.codigo, -1) END AS motivo_visita,
  CASE WHEN lk.id_tienda IS NULL THEN -1 ELSE coalesce(dt.codigo, -1) END AS id_tienda,
  {WEEKDAY_SQL} AS dia_semana, {MONTH_SQL} AS mes, {PAYDAY_SQL} AS es_quincena
FROM lk
LEFT JOIN dict dz ON dz.columna = 'zona_geografica' AND dz.valor = lk.zona_geografica
LEFT JOIN dict dm ON dm.columna = 'motivo_visita' AND dm.valor = lk.motivo_visita
LEFT JOIN dict dt ON dt.columna = 'id_tienda' AND dt.valor = lk.id_tienda
WHERE lk.found""")
oracle("nba_level", *NBA_CTES)("SELECT id_interaccion, score_compra_hoy, nivel FROM rec")
oracle("nba_action", *NBA_CTES)(
    "SELECT id_interaccion, segmento, nivel, next_best_category, accion_recomendada FROM act")
_OPP = dims.values_sql(dims.OPPORTUNITY_MESSAGES, ["lv", "ttl", "sub"])
_LOW = [r for r in dims.OPPORTUNITY_MESSAGES if r[0] == "BAJO"][0]
oracle("opportunity", *NBA_CTES)(f"""
SELECT rec.id_interaccion, rec.nivel, coalesce(t.ttl, '{_LOW[1]}') AS opp_title,
  coalesce(t.sub, '{_LOW[2]}') AS opp_subtitle
FROM rec LEFT JOIN {_OPP} ON rec.nivel = t.lv""")


def _title_sql(col: str) -> str:
    return (f"array_to_string(list_transform(string_split(replace({col}, '_', ' '), ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")


oracle("category_title", *C360_CTES)(
    f"SELECT id_cliente, categoria_favorita, {_title_sql('categoria_favorita')} AS categoria_titulo "
    "FROM customer_360")
oracle("advisor_card", *NBA_CTES)(f"""
SELECT act.id_interaccion, act.segmento,
  coalesce(pb.lec, '{dims.DEFAULT_PLAYBOOK[0]}') AS lectura, coalesce(pb.est, '{dims.DEFAULT_PLAYBOOK[1]}') AS estrategia,
  lower(coalesce(lb.l, act.motivo_visita)) AS motivo_label_lower,
  coalesce(op.ttl, '{_LOW[1]}') AS opp_title, coalesce(op.sub, '{_LOW[2]}') AS opp_subtitle,
  {_title_sql('act.next_best_category')} AS categoria_sugerida,
  {_title_sql('act.categoria_favorita')} AS categoria_historica
FROM act
LEFT JOIN {_PB.replace(' AS t(', ' AS pb(')} ON act.segmento = pb.seg
LEFT JOIN {_LAB.replace(' AS t(', ' AS lb(')} ON act.motivo_visita = lb.m
LEFT JOIN {_OPP.replace(' AS t(', ' AS op(')} ON act.nivel = op.lv""")
