"""Scalar expressions: NULLs, blanks, garbage, boundaries."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from dwspark.functions import clean as C
from dwspark.functions import exprs as X
from dwspark.functions.keys import sk, sk_date, sk_date_in_range, sk_unknown


def _col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {typ}")


def test_parse_dates_patterns(spark):
    vals = ["05/01/2000 08:30", "5/1/2000 8:30", "01-05-2000 09:15 PM", "05-01-2000 14:05", "2000-01-05 23:59",
            "", None, "garbage", "13/02/2026 10:00"]
    out = _col(spark, vals).select(C.parse_dates("c", C.FLIGHT_DATE_PATTERNS).alias("t")).collect()
    got = [r.t for r in out]
    assert got[0] == dt.datetime(2000, 1, 5, 8, 30)
    assert got[1] == dt.datetime(2000, 1, 5, 8, 30)
    assert got[2] == dt.datetime(2000, 1, 5, 21, 15)
    assert got[3] == dt.datetime(2000, 1, 5, 14, 5)
    assert got[4] == dt.datetime(2000, 1, 5, 23, 59)
    assert got[5] is None and got[6] is None and got[7] is None
    assert got[8] == dt.datetime(2026, 2, 13, 10, 0)  # day/month ambiguous: first pattern (day first) wins


def test_parse_dates_guard_changes_nothing(spark):
    """The shape guard only skips strings a pattern cannot parse: same result as trying all patterns."""
    vals = ["05/03/2001 08:30", "3-5-2001 9:15 pm", "12-13-2001 10:00 AM", "13-12-2001 10:00", "2001-5-3 3:59",
            "05-05-05 10:00", "+2001-05-03 10:00", "31/02/2001 10:00", "29/02/2000 10:00", "2001-13-01 10:00",
            " 2001-05-03 23:59 ", "05-03-2001 10:00 XM", "5-3-12345 10:00", "0005-03-01 10:00", "01-01-0001 01:01",
            "1-1-1 1:1", "2001/05/03 10:00", "2001-05-03", "03/05/2001", "3/5/01", "", None, "abc"]
    df = _col(spark, vals)
    for pats in (C.FLIGHT_DATE_PATTERNS, C.CUSTOMER_DATE_PATTERNS):
        s = F.nullif(F.trim("c"), F.lit(""))
        unguarded = F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in pats])
        rows = df.select(unguarded.cast("string").alias("a"), C.parse_dates("c", pats).cast("string").alias("b")).collect()
        assert [r.a for r in rows] == [r.b for r in rows]
    assert C._shape_regex("dd MMM yyyy") is None  # month names: no guard, plain parse


def test_customer_dates_iso_then_day_first(spark):
    out = _col(spark, ["2026-01-20", "13/02/2026", "02/03/2026", "x"]).select(
        F.to_date(C.parse_dates("c", C.CUSTOMER_DATE_PATTERNS)).alias("d")).collect()
    assert [r.d for r in out] == [dt.date(2026, 1, 20), dt.date(2026, 2, 13), dt.date(2026, 3, 2), None]


def test_gender_mappings(spark):
    vals = ["m", " M ", "Masculino", "F", "femenino", "x", "No Binario", "nobinario", "", None, "\tf\n", "otro"]
    g4 = [r[0] for r in _col(spark, vals).select(C.map_gender4("c")).collect()]
    assert g4 == ["Masculino", "Masculino", "Masculino", "Femenino", "Femenino", "No Binario", "No Binario", "No Binario",
                  "No Especificado", "No Especificado", "Femenino", "No Especificado"]
    g2 = [r[0] for r in _col(spark, ["m", "F", "x", None, ""]).select(C.map_gender2("c")).collect()]
    assert g2 == ["Masculino", "Femenino", "No especificado", "No especificado", "No especificado"]


def test_numbers(spark):
    vals = ["1,5", "1.5", " 12 ", "abc", "", None]
    df = _col(spark, vals)
    assert [r[0] for r in df.select(C.comma_decimal("c")).collect()] == [1.5, 1.5, 12.0, None, None, None]
    assert [r[0] for r in df.select(C.to_number("c")).collect()] == [None, 1.5, 12.0, None, None, None]
    assert [r[0] for r in df.select(C.int_or_zero("c")).collect()] == [0, 1, 12, 0, 0, 0]


def test_text_helpers(spark):
    df = _col(spark, ["  ana diaz\t", "", None, "O'NEIL"])
    assert [r[0] for r in df.select(C.strip_ws("c")).collect()] == ["ana diaz", "", None, "O'NEIL"]
    assert [r[0] for r in df.select(C.default_text("c", "SIN_DATO")).collect()] == ["  ana diaz\t", "SIN_DATO", "SIN_DATO", "O'NEIL"]
    assert [r[0] for r in df.select(C.title_case(C.strip_ws("c"))).collect()][0] == "Ana Diaz"
    s = C.sentinel_to_blank(_col(spark, ["Nan", "None", "nan", "x"]))
    assert [r[0] for r in s.collect()] == ["", "", "nan", "x"]
    assert [r[0] for r in df.select(C.truncate("c", 3)).collect()][3] == "O'N"


def test_safe_div_and_pct(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00")), (Decimal("1.00"), Decimal("0.00")), (None, Decimal("2.00")),
                                (Decimal("2.675"), Decimal("1"))], "a decimal(12,3), b decimal(12,2)")
    out = df.select(X.safe_div("a", "b", 2).alias("q"), X.pct("a", "b").alias("p")).collect()
    assert out[0].q == Decimal("0.33") and out[0].p == Decimal("33.33")
    assert out[1].q is None and out[2].q is None
    assert out[3].q == Decimal("2.68")  # half-up on the decimal value, not binary rounding


def test_surrogate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (1, None)], "k int, s string")
    out = df.select(sk("k").alias("a"), sk("k", "s").alias("b"), sk_unknown().alias("u")).collect()
    import hashlib

    assert out[0].a == hashlib.md5(b"1").hexdigest()
    assert out[0].b == hashlib.md5(b"1-a").hexdigest()
    assert out[1].a == hashlib.md5(b"<null>").hexdigest()
    assert out[2].b == hashlib.md5(b"1-<null>").hexdigest()
    assert out[0].u == hashlib.md5(b"-1").hexdigest()


def test_date_keys(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 5),), (dt.date(1990, 1, 1),), (None,)], "d date")
    out = df.select(sk_date("d").alias("k"), sk_date_in_range("d", "1995-01-01", "2002-12-31").alias("r")).collect()
    assert [r.k for r in out] == [20000105, 19900101, None]
    assert [r.r for r in out] == [20000105, -1, -1]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2020, 12, 31),)], "d date")
    p = X.calendar_parts("d")
    r = df.select(*[v.alias(k) for k, v in p.items()]).collect()
    assert r[0].semana_iso == 53 and r[0].dia_semana_iso == 7 and r[0].nombre_dia == "Domingo" and r[0].es_fin_de_semana
    assert r[1].nombre_mes == "Diciembre" and r[1].trimestre == 4 and r[1].anio_mes == "2020-12"


def test_months_back_clamps(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 31),)], "d date")
    assert df.select(X.months_back("d", 3)).first()[0] == dt.date(2024, 2, 29)


def test_stock_status_priority(spark):
    df = spark.createDataFrame([(True, True, True), (False, True, True), (False, False, True), (False, False, False)],
                               "es_sin_stock boolean, es_bajo_minimo boolean, es_sobre_maximo boolean")
    assert [r[0] for r in df.select(X.stock_status()).collect()] == ["SIN STOCK", "BAJO MÍNIMO", "SOBRE STOCK", "OK"]
