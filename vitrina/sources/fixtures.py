"""The three raw tables as views over the driver's TPC-H-like parquet tables.

The reference reads three CSV files (customers, purchases, store visits). The
test data are TPC-H-like tables, so these views give them the same schemas
(FIXTURES.md §2). The Spark side is written with the DataFrame API so that
Catalyst prunes columns and pushes filters into the parquet scans; the same
views as SQL text (``FIXTURE_CTES``) are the inputs of every DuckDB oracle.

Timestamps stay ``TIMESTAMP_NTZ`` in batch work (no time-zone dependence);
only the streaming path casts to ``timestamp`` for the watermark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RawTables:
    clientes: DataFrame
    transacciones: DataFrame
    interacciones: DataFrame


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cli(col: Column) -> Column:
    return F.concat(F.lit("cli_"), col.cast("string"))


def clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").alias("c")
    n = _read(spark, sf_dir, "nation").alias("n")
    r = _read(spark, sf_dir, "region").alias("r")
    key = F.col("c.c_custkey")
    j = (c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"), "left")
          .join(r, F.col("n.n_regionkey") == F.col("r.r_regionkey"), "left"))
    phone = (F.when(key % 5 == 0, F.lit(None).cast("string"))
              .when(key % 5 == 1, F.lit("300-123"))
              .otherwise(F.concat(F.lit("3"), F.lpad(key.cast("string"), 9, "0"))))
    email = (F.when(key % 4 == 0, F.lit(None).cast("string"))
              .when(key % 4 == 1, F.lit("sin_correo"))
              .otherwise(F.concat(F.lit("c."), key.cast("string"), F.lit("@mail.co"))))
    return j.select(
        _cli(key).alias("id_cliente"),
        F.when(key % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("r.r_name")).alias("zona_geografica"),
        (key % 120).cast("int").alias("antiguedad_meses"),
        F.when((F.col("c.c_acctbal") < 0) | (F.col("r.r_regionkey") == 4), F.lit(None).cast("double"))
         .otherwise(F.col("c.c_acctbal")).alias("score_credito_interno"),
        phone.alias("celular_contacto"),
        email.alias("email_contacto"),
    )


# Product type -> category and order priority -> payment method
# used by the fixture views (FIXTURES.md §2).
TYPE_TO_CATEGORY = {
    "ECONOMY": "refrigeracion",
    "STANDARD": "refrigeracion",
    "SMALL": "pequenos_electrodomesticos",
    "MEDIUM": "lavado",
    "LARGE": "coccion",
}
PRIORITY_TO_PAYMENT = {"1-URGENT": "credito_propio_retail", "2-HIGH": "tarjeta"}


def _case(col: Column, mapping: dict, default: str) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = F.when(col == key, value) if expr is None else expr.when(col == key, value)
    return expr.otherwise(default)


def transacciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").alias("l")
    o = _read(spark, sf_dir, "orders").alias("o")
    p = _read(spark, sf_dir, "part").alias("p")
    j = (li.join(o, F.col("l.l_orderkey") == F.col("o.o_orderkey"))
           .join(p, F.col("l.l_partkey") == F.col("p.p_partkey")))
    return j.select(
        F.concat(F.col("l.l_orderkey").cast("string"), F.lit("-"),
                 F.col("l.l_linenumber").cast("string")).alias("id_transaccion"),
        F.when(F.col("o.o_custkey") % 10 != 0, _cli(F.col("o.o_custkey"))).alias("id_cliente"),
        F.col("l.l_shipdate").alias("fecha_compra"),
        _case(F.col("p.p_type"), TYPE_TO_CATEGORY, "otros").alias("categoria_producto"),
        F.col("l.l_extendedprice").alias("monto_pago"),
        _case(F.col("o.o_orderpriority"), PRIORITY_TO_PAYMENT, "efectivo").alias("medio_pago"),
    )


# Event type -> visit reason (FIXTURES.md §2).
EVENT_TO_REASON = {
    "click": "cotizacion",
    "purchase": "cotizacion",
    "view": "servicio_tecnico",
    "signup": "pago_cuota_credito",
}


def interacciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    store = F.regexp_extract("props", "[0-9]+", 0).cast("int") % 10
    bought = (F.col("event_type") == "purchase") | ((F.col("user_id") % 3 == 0) & (F.col("value") > 30))
    return e.select(
        F.concat(F.lit("int_"), F.col("event_id").cast("string")).alias("id_interaccion"),
        _cli(F.col("user_id")).alias("id_cliente"),
        F.concat(F.lit("t"), store.cast("string")).alias("id_tienda"),
        F.col("ts").alias("fecha_visita"),
        _case(F.col("event_type"), EVENT_TO_REASON, "reclamo").alias("motivo_visita"),
        F.when(bought, 1).otherwise(0).cast("int").alias("compro_en_visita"),
    )


def load_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(clientes(spark, sf_dir), transacciones(spark, sf_dir), interacciones(spark, sf_dir))


# Missing-value words that take the nulls' places in the written files.
NA_CYCLE = ("NA", "", "NULL", "nan", "N/A", "<NA>")


def with_na_words(df: DataFrame, key: str) -> DataFrame:
    """All columns as text, each null as one of the missing-value words, by a hash of the row's key."""
    words = F.array(*map(F.lit, NA_CYCLE))
    word = F.element_at(words, F.pmod(F.hash(key), F.lit(len(NA_CYCLE))).cast("int") + 1)
    return df.select(*[F.coalesce(F.col(c).cast("string"), word).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, key: str) -> str:
    """``df`` as CSV files: columns in reverse order, missing-value words, and a note with quotes and line breaks behind each row."""
    note = F.concat(F.lit('dijo "hola",\n'), F.col(key), F.lit("\nadiós"))
    out = with_na_words(df, key).select(*reversed(df.columns)).withColumn("notas", note)
    out.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return path


# The same three views as SQL text, used as CTEs by the DuckDB oracles.
FIXTURE_CTES = """
clientes AS (
  SELECT concat('cli_', CAST(c.c_custkey AS STRING)) AS id_cliente,
    CASE WHEN c.c_custkey % 97 = 0 THEN NULL ELSE r.r_name END AS zona_geografica,
    CAST(c.c_custkey % 120 AS INT) AS antiguedad_meses,
    CASE WHEN c.c_acctbal < 0 OR r.r_regionkey = 4 THEN NULL ELSE c.c_acctbal END AS score_credito_interno,
    CASE c.c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '300-123'
      ELSE concat('3', lpad(CAST(c.c_custkey AS STRING), 9, '0')) END AS celular_contacto,
    CASE c.c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'sin_correo'
      ELSE concat('c.', CAST(c.c_custkey AS STRING), '@mail.co') END AS email_contacto
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
transacciones AS (
  SELECT concat(CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING)) AS id_transaccion,
    CASE WHEN o.o_custkey % 10 <> 0 THEN concat('cli_', CAST(o.o_custkey AS STRING)) END AS id_cliente, l.l_shipdate AS fecha_compra,
    CASE p.p_type WHEN 'ECONOMY' THEN 'refrigeracion' WHEN 'STANDARD' THEN 'refrigeracion'
      WHEN 'SMALL' THEN 'pequenos_electrodomesticos' WHEN 'MEDIUM' THEN 'lavado'
      WHEN 'LARGE' THEN 'coccion' ELSE 'otros' END AS categoria_producto,
    l.l_extendedprice AS monto_pago,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'credito_propio_retail'
      WHEN '2-HIGH' THEN 'tarjeta' ELSE 'efectivo' END AS medio_pago
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
interacciones AS (
  SELECT concat('int_', CAST(event_id AS STRING)) AS id_interaccion,
    concat('cli_', CAST(user_id AS STRING)) AS id_cliente,
    concat('t', CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 10 AS STRING)) AS id_tienda,
    ts AS fecha_visita,
    CASE event_type WHEN 'click' THEN 'cotizacion' WHEN 'purchase' THEN 'cotizacion'
      WHEN 'view' THEN 'servicio_tecnico' WHEN 'signup' THEN 'pago_cuota_credito' ELSE 'reclamo' END AS motivo_visita,
    CASE WHEN event_type = 'purchase' OR (user_id % 3 = 0 AND value > 30) THEN 1 ELSE 0 END AS compro_en_visita
  FROM events
)
"""
