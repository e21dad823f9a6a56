"""CSV sources for the three raw tables, with declared schemas.

Everything is read as text first, the missing-value words a pandas CSV read
treats as NA are turned into null, and only then are the typed columns cast
(``try_cast``). Phone numbers stay strings (leading zeros and the 10-digit
check survive). ``read_csv`` keeps every row and leaves an unparseable value
null, like a PERMISSIVE read. ``read_checked`` and ``load_raw`` check the header
and put rows that don't parse into a side table instead: records with too few
or too many fields, and values that don't fit their column's type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import na_normalise
from .fixtures import RawTables

# Column names and types of the three raw tables.
CLIENTES_SCHEMA = [
    ("id_cliente", "string"), ("zona_geografica", "string"), ("antiguedad_meses", "int"),
    ("score_credito_interno", "double"), ("celular_contacto", "string"), ("email_contacto", "string"),
]
TRANSACCIONES_SCHEMA = [
    ("id_transaccion", "string"), ("id_cliente", "string"), ("fecha_compra", "timestamp_ntz"),
    ("categoria_producto", "string"), ("monto_pago", "double"), ("medio_pago", "string"),
]
INTERACCIONES_SCHEMA = [
    ("id_interaccion", "string"), ("id_cliente", "string"), ("id_tienda", "string"),
    ("fecha_visita", "timestamp_ntz"), ("motivo_visita", "string"), ("compro_en_visita", "int"),
]


def normalise_na(df: DataFrame) -> DataFrame:
    """NA words -> null on every string column."""
    return df.select(*[na_normalise(f.name).alias(f.name) if f.dataType.simpleString() == "string"
                       else F.col(f.name) for f in df.schema.fields])


def read_csv(spark: SparkSession, path: str, schema: list[tuple[str, str]],
             multi_line: bool = True) -> DataFrame:
    """Columns are matched by the header's names; a quote inside a quoted field
    is doubled; a quoted field may hold line breaks. ``multi_line=False`` lets
    Spark split large files whose fields have none.
    """
    raw = (spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
                .option("inferSchema", False).option("mode", "PERMISSIVE").csv(path))
    clean = normalise_na(raw.select(*[F.col(f"`{name}`") for name, _ in schema]))
    return clean.select(*[F.col(n) if t == "string" else F.col(n).try_cast(t).alias(n)
                          for n, t in schema])


class HeaderError(ValueError):
    """A file whose header lacks a column."""


RECORD = "_registro"
BAD_ROWS = "tabla string, columna string, valor string, registro string"


def read_checked(spark: SparkSession, path: str, schema: list[tuple[str, str]], table: str,
                 multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that parse, bad rows as ``BAD_ROWS``). A bad row names the first column that doesn't fit;
    a record with another number of fields names none and shows the record.

    Files of a folder must have one header (Spark checks each against the first).
    """
    reader = (spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
                   .option("mode", "PERMISSIVE").option("enforceSchema", False))
    header = reader.csv(path).columns
    missing = [name for name, _ in schema if name not in header]
    if missing:
        raise HeaderError(f"{path}: no column {', '.join(missing)}")
    fields = ", ".join(f"`{c}` STRING" for c in [*header, RECORD])
    raw = reader.option("enforceSchema", True).option("columnNameOfCorruptRecord", RECORD).schema(fields).csv(path)
    text = raw.select(*[na_normalise(F.col(f"`{name}`")).alias(name) for name, _ in schema], F.col(RECORD))
    typed = [(n, t) for n, t in schema if t != "string"]
    misfit = F.coalesce(*[F.when(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull(), F.struct(F.lit(n).alias("columna"), F.col(n).alias("valor")))
                          for n, t in typed], F.lit(None).cast("struct<columna:string,valor:string>"))
    marked = text.withColumn("_malo", misfit)
    bad = marked.where(F.col(RECORD).isNotNull() | F.col("_malo").isNotNull()).select(
        F.lit(table).alias("tabla"), F.when(F.col(RECORD).isNull(), F.col("_malo.columna")).alias("columna"),
        F.when(F.col(RECORD).isNull(), F.col("_malo.valor")).alias("valor"),
        F.coalesce(F.col(RECORD), F.to_json(F.struct(*[F.col(n) for n, _ in schema]))).alias("registro"))
    good = marked.where(F.col(RECORD).isNull() & F.col("_malo").isNull())
    return good.select(*[F.col(n) if t == "string" else F.col(n).cast(t).alias(n) for n, t in schema]), bad


#: File or folder names of the raw tables and their schemas.
RAW_FILES = {"clientes": CLIENTES_SCHEMA, "transacciones": TRANSACCIONES_SCHEMA, "interacciones": INTERACCIONES_SCHEMA}


def load_raw(spark: SparkSession, folder: str, multi_line: bool = True) -> tuple[RawTables, DataFrame]:
    """The three raw tables of a folder of CSV files, and all their bad rows."""
    tables, bad = {}, None
    for name, schema in RAW_FILES.items():
        tables[name], own = read_checked(spark, f"{folder.rstrip('/')}/{name}.csv", schema, name, multi_line)
        bad = own if bad is None else bad.unionByName(own)
    return RawTables(**tables), bad


def bad_row_counts(bad: DataFrame) -> DataFrame:
    """(tabla, columna, filas): bad rows by table and column (null: another number of fields)."""
    return bad.groupBy("tabla", "columna").agg(F.count(F.lit(1)).alias("filas"))


def read_clientes(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CLIENTES_SCHEMA)


def read_transacciones(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TRANSACCIONES_SCHEMA)


def read_interacciones(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, INTERACCIONES_SCHEMA)
