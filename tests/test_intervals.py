"""Dyadic covers, interval joins without expansion, and SCD2 histories in one pass."""

import datetime as dt
import random

from dwspark.functions import intervals as I
from dwspark.operators.joins import attribute_promotion, overlaps, promotion_calendar
from dwspark.operators.scd import scd2_apply, scd2_history
from pyspark.sql import functions as F

DAY = dt.timedelta(days=1)
END = dt.date(9999, 12, 31)
SCHEMA = "id_promocion int, categoria string, fecha_inicio date, fecha_fin date, porcentaje_descuento decimal(5,4)"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_cover_is_exact_and_small(spark):
    rng = random.Random(1)
    lo = dt.date(2000, 2, 25)
    spans = [(lo + rng.randint(0, 40) * DAY, lo + rng.randint(0, 90) * DAY) for _ in range(200)] + [(lo, lo), (lo + DAY, lo), (None, lo), (lo, None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "id int, a date, b date")
    got = df.select("id", "a", "b", I.cover("a", "b").alias("n")).select("id", "a", "b", F.size("n").alias("size"), F.flatten(F.transform("n", lambda n: I.days_of(n["level"], n["node"]))).alias("days")).collect()
    for r in got:
        want = [r["a"] + k * DAY for k in range((r["b"] - r["a"]).days + 1)] if r["a"] and r["b"] else []
        assert sorted(r["days"]) == want and r["size"] <= 14
    forever = spark.sql("select date'0001-01-01' as a, date'9999-12-31' as b, date'2024-02-29' as d")
    assert forever.select(F.size(I.cover("a", "b"))).first()[0] <= 2 * I.LEVELS
    both = forever.select(F.size(F.array_intersect(I.cover("a", "b"), I.path("d")))).first()[0]
    assert both == 1


def promotions(n, seed, categories, span):
    rng, lo, out = random.Random(seed), dt.date(2020, 1, 1), []
    for i in range(n):
        a = lo + rng.randint(0, span) * DAY
        b = rng.choice([END, a + rng.randint(-3, span) * DAY])
        out.append((i, rng.choice(categories), a, b, rng.choice(["0.1000", "0.2000", "0.2000", "0.5000"])))
    return out


def frame(spark, given):
    text = SCHEMA.replace("decimal(5,4)", "string")
    return spark.createDataFrame(given, text).withColumn("porcentaje_descuento", F.col("porcentaje_descuento").cast("decimal(5,4)"))


def test_winners_equal_brute_force_with_open_ends(spark):
    given = promotions(60, 3, ["a", "b", None], 50)
    first, last = dt.date(2020, 1, 10), dt.date(2020, 2, 20)
    want = {}
    for i, c, a, b, p in given:
        d = max(a, first)
        while d <= min(b, last):
            if (c, d) not in want or (p, -i) > want[c, d]:
                want[c, d] = (p, -i)
            d += DAY
    got = {(r["categoria"], r["fecha"]): -r["id_promocion"] for r in promotion_calendar(frame(spark, given), first=first, last=last).collect()}
    assert got == {k: v[1] for k, v in want.items()}
    lines = spark.createDataFrame([(k, c, dt.date(2020, 1, 1) + k * DAY) for k, c in enumerate(["a", "b", "c"] * 20)], "id int, categoria string, fecha_venta date")
    for r in attribute_promotion(lines, frame(spark, given)).collect():
        active = [(p, -i) for i, c, a, b, p in given if c == r["categoria"] and a <= r["fecha_venta"] <= b]
        assert r["id_promocion"] == (-max(active)[1] if active else None)


def test_a_hundred_thousand_open_intervals(spark):
    # each would be millions of days; one category holds them all
    df = spark.range(100_000).select(
        F.col("id").cast("int").alias("id_promocion"), F.lit("a").alias("categoria"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int")).alias("fecha_inicio"),
        F.lit("9999-12-31").cast("date").alias("fecha_fin"), (F.col("id") % 7 / 10).cast("decimal(5,4)").alias("porcentaje_descuento"))
    cal = promotion_calendar(df, first=dt.date(2020, 1, 1), last=dt.date(2022, 12, 31))
    assert cal.count() == 1096 and cal.where("fecha >= '2021-01-01'").select("id_promocion").distinct().collect() == [(6,)]
    apart = df.withColumn("fecha_inicio", F.date_add("fecha_inicio", (F.col("id_promocion") * 20).cast("int"))).withColumn("fecha_fin", F.date_add("fecha_inicio", 5))
    assert overlaps(apart.where("id_promocion % 1000 < 900"), "categoria", "fecha_inicio", "fecha_fin", "id_promocion").count() == 0


def test_overlaps_of_open_intervals(spark):
    given = promotions(40, 9, ["a", "b", None], 400)
    got = rows(overlaps(frame(spark, given), "categoria", "fecha_inicio", "fecha_fin", "id_promocion"))
    want = [
        (i, j, c, max(a, x), min(b, y))
        for i, c, a, b, _ in given for j, k, x, y, _ in given
        if i < j and c is not None and c == k and a <= y and x <= b and a <= b and x <= y
    ]
    reversed_ = {i for i, _, a, b, _ in given if a > b}
    assert [g for g in got if not {g[0], g[1]} & reversed_] == sorted(want, key=str)


def test_history_at_once_equals_load_by_load(spark):
    rng = random.Random(6)
    dates = [f"2020-{m:02d}-01" for m in range(1, 9)]
    loads = {d: [(k, rng.choice([None, 1, 2]), rng.choice(["x", "y"])) for k in (None, "a", "b", "c", "d") if rng.random() < 0.7 and (k is not None)] for d in dates}
    hist = None
    for d in dates:
        hist = scd2_apply(hist, spark.createDataFrame(loads[d], "id string, price int, note string"), "id", ["price"], d)
        hist = spark.createDataFrame(hist.collect(), hist.schema)
    all_rows = [(*r, dt.date.fromisoformat(d)) for d in dates for r in loads[d]]
    rng.shuffle(all_rows)  # loads in any order
    once = scd2_history(spark.createDataFrame(all_rows, "id string, price int, note string, as_of date").repartition(3), "id", ["price"])
    assert rows(once.select(hist.columns)) == rows(hist)
