"""Dirty customer file cleaning (B01-B17) and its summaries.

Steps, in order: keep the first record per customer id (by source row
number), strip whitespace from every text column, title-case name / city /
category, blank the 'Nan'/'None' sentinels, map gender (2 classes), parse the
sign-up date (ISO first, day-first as fallback), read the spend with comma or
dot decimals, drop rows without a date, default the city. All steps are
column expressions in one projection chain - no shuffle except the keep-first
window, which is partitioned by customer id.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.functions import clean as C
from dwspark.operators.aggregates import pivot_count, pivot_mean, value_counts
from dwspark.operators.windows import dedup_first
from dwspark.plans.warehouse import Warehouse
from dwspark.session import scratch_path
from dwspark.sources.ingest import read_csv_contract, write_csv

UNKNOWN_CITY = "Desconocida"
DUPLICATE_MOD = 50            # ids with id % 50 = 0 appear twice in the dirty file
DUPLICATE_SUFFIX = " DUP"


class Customers:
    def __init__(self, w: Warehouse):
        self.w = w

    @cached_property
    def raw(self) -> DataFrame:
        """The dirty file with its repeated records and source row numbers."""
        base = self.w.fx.cliente_sucio()
        first = base.withColumn("_row_number", F.col("id_cliente") * 2)
        dup = (
            base.filter((F.col("id_cliente") % DUPLICATE_MOD) == 0)
            .withColumn("nombre", F.concat(F.col("nombre"), F.lit(DUPLICATE_SUFFIX)))
            .withColumn("_row_number", F.col("id_cliente") * 2 + 1)
        )
        return first.unionByName(dup)

    @cached_property
    def deduplicated(self) -> DataFrame:
        return dedup_first(self.raw, ["id_cliente"], ["_row_number"])

    @cached_property
    def clean(self) -> DataFrame:
        d = C.strip_all(self.deduplicated)
        d = d.withColumns({c: C.title_case(c) for c in ("nombre", "ciudad", "categoria")})
        d = C.sentinel_to_blank(d)
        d = d.select(
            "id_cliente",
            "nombre",
            C.map_gender2("genero").alias("genero"),
            F.to_date(C.parse_dates("fecha_registro", C.CUSTOMER_DATE_PATTERNS)).alias("fecha_registro"),
            C.comma_decimal("gasto_q", "decimal(12,2)").alias("gasto_q"),
            C.default_text("ciudad", UNKNOWN_CITY).alias("ciudad"),
            "categoria",
            "_row_number",
        )
        return C.drop_null_rows(d, ["fecha_registro"]).drop("_row_number")


def b10_clean_customers(c: Customers) -> DataFrame:
    return c.clean


def a16_customers_export(c: Customers) -> DataFrame:
    """The clean customers written as a CSV file with its header, spend NULL as 0, and read back."""
    path = scratch_path(c.w.spark, "a16_csv")
    write_csv(c.clean, path, fill={"gasto_q": 0})
    types = c.clean.schema
    text = read_csv_contract(c.w.spark, path, types.names)
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in types.fields])


def f05_dedup_first(c: Customers) -> DataFrame:
    """Keep-first deduplication by explicit source order."""
    return c.deduplicated.select("id_cliente", "nombre", "_row_number")


def g04_first_rows_sample(c: Customers, n: int = 15) -> DataFrame:
    """First n records of the raw file in source order (G04); the limit is the feature."""
    return c.raw.orderBy("_row_number").limit(n)


def j52_spend_city_category(c: Customers) -> DataFrame:
    return pivot_mean(c.clean, "ciudad", "categoria", "gasto_q")


def j53_customers_city_gender(c: Customers) -> DataFrame:
    return pivot_count(c.clean, "ciudad", "genero", "id_cliente")


def j54_mean_spend_by_category(c: Customers) -> DataFrame:
    from dwspark.functions.exprs import avg_dec

    return c.clean.groupBy("categoria").agg(avg_dec("gasto_q", 2).alias("gasto_promedio"))


def j54_gender_share(c: Customers) -> DataFrame:
    return value_counts(c.clean, "genero", 4)


def j55_cleaning_report(c: Customers) -> DataFrame:
    """Input rows, duplicates removed, rows dropped for a bad date, values filled."""
    raw_n = c.raw.agg(F.count(F.lit(1))).scalar()
    dedup_n = c.deduplicated.agg(F.count(F.lit(1))).scalar()
    out = c.clean.agg(
        F.count(F.lit(1)).alias("filas_salida"),
        F.count_if(F.col("genero") == "No especificado").alias("genero_no_especificado"),
        F.count_if(F.col("ciudad") == UNKNOWN_CITY).alias("ciudad_desconocida"),
        F.count_if(F.col("gasto_q").isNull()).alias("gasto_nulo_a_cero"),
    )
    return out.select(
        raw_n.alias("filas_entrada"),
        (raw_n - dedup_n).alias("duplicados_eliminados"),
        (dedup_n - F.col("filas_salida")).alias("filas_sin_fecha_eliminadas"),
        "filas_salida", "genero_no_especificado", "ciudad_desconocida", "gasto_nulo_a_cero",
    )


def customers_of(w: Warehouse) -> Customers:
    c = getattr(w, "_customers", None)
    if c is None:
        c = w._customers = Customers(w)
    return c


def queries() -> dict:
    fns = [b10_clean_customers, a16_customers_export, f05_dedup_first, g04_first_rows_sample, j52_spend_city_category,
           j53_customers_city_gender, j54_mean_spend_by_category, j54_gender_share, j55_cleaning_report]
    return {f.__name__: f for f in fns}
