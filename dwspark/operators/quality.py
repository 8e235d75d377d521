"""Data-quality engine.

A check is a DataFrame of *violating rows* plus a name, a type and a severity
(``error`` fails the run, ``warn`` is only reported). The result of a check
is its number of violations.

Scale design: all declared tests of a suite run over ONE scan of each table
(``run_tests``): row rules, uniqueness, combinations and foreign keys are
counted together as (domain, key, test) in the tasks. Singular checks are
frames of their own, counted and unioned into one small frame.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.functions.keys import packed, sk_unknown

ERROR = "error"
WARN = "warn"

ROW_LEVEL = {"not_null", "accepted_values", "accepted_range", "expression_is_true", "valid_percentage", "not_unknown"}
SET_BASED = {"unique", "unique_combination", "relationships"}

RESULT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("check_type", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("failing_rows", T.LongType(), False),
    T.StructField("passed", T.BooleanType(), False),
])


@dataclass(frozen=True)
class Test:
    """A declared test on a table (the YAML tests of a model, as data)."""

    kind: str
    table: str
    column: str | None = None
    args: dict[str, Any] = field(default_factory=dict)
    severity: str = ERROR
    name: str | None = None

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        col = self.column or "_".join(self.args.get("columns", [])) or "expr"
        return f"{self.kind}_{self.table}_{col}"


@dataclass
class Check:
    """A named DataFrame of violating rows."""

    name: str
    check_type: str
    severity: str
    violations: DataFrame


# --------------------------------------------------------------- row-level rules
def violation_predicate(t: Test) -> Column:
    """Boolean column: TRUE when the row violates the rule (NULL passes, as in SQL tests)."""
    c = F.col(t.column) if t.column else None
    if t.kind == "not_null":
        return c.isNull()
    if t.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*t.args["values"])
    if t.kind == "accepted_range":
        inclusive = t.args.get("inclusive", True)
        bad = F.lit(False)
        if "min_value" in t.args:
            lo = F.lit(t.args["min_value"])
            bad = bad | ((c < lo) if inclusive else (c <= lo))
        if "max_value" in t.args:
            hi = F.lit(t.args["max_value"])
            bad = bad | ((c > hi) if inclusive else (c >= hi))
        return c.isNotNull() & bad
    if t.kind == "expression_is_true":
        return F.coalesce(~F.expr(t.args["expression"]), F.lit(False))
    if t.kind == "valid_percentage":
        return F.coalesce((c < 0) | (c > 1), F.lit(False))
    if t.kind == "not_unknown":
        return F.coalesce(c.cast("string").isin(F.lit("-1"), sk_unknown()), F.lit(False))
    raise ValueError(f"not a row-level rule: {t.kind}")


# ---------------------------------------------------------------- single checks
def unique(df: DataFrame, col: str) -> DataFrame:
    """Duplicated keys, one row each; NULL keys ignored."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Duplicated combinations."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def relationships(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose non-NULL key is missing in the parent."""
    keys = parent.select(F.col(field_).alias("__pk")).filter(F.col("__pk").isNotNull())
    c = child.filter(F.col(col).isNotNull())
    return c.join(keys, c[col] == F.col("__pk"), "left_anti")


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(violation_predicate(Test("accepted_values", "", col, {"values": values})))


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    args: dict[str, Any] = {"inclusive": inclusive}
    if min_value is not None:
        args["min_value"] = min_value
    if max_value is not None:
        args["max_value"] = max_value
    return df.filter(violation_predicate(Test("accepted_range", "", col, args)))


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    return df.filter(violation_predicate(Test("expression_is_true", "", None, {"expression": expression})))


def valid_percentage(df: DataFrame, col: str) -> DataFrame:
    return df.filter(violation_predicate(Test("valid_percentage", "", col)))


def not_unknown(df: DataFrame, col: str) -> DataFrame:
    return df.filter(violation_predicate(Test("not_unknown", "", col)))


def violations_of(t: Test, tables: dict[str, DataFrame]) -> DataFrame:
    """Violating rows of one declared test (for quarantine, I35)."""
    df = tables[t.table]
    if t.kind in ROW_LEVEL:
        return df.filter(violation_predicate(t))
    if t.kind == "unique":
        return unique(df, t.column)
    if t.kind == "unique_combination":
        return unique_combination(df, t.args["columns"])
    if t.kind == "relationships":
        return relationships(df, t.column, tables[t.args["to"]], t.args["field"])
    raise ValueError(t.kind)


# ------------------------------------------------------------------- the runner
def _result_row(name: str, ctype: str, severity: str, count_col: Column) -> list[Column]:
    n = F.coalesce(count_col, F.lit(0)).cast("bigint")
    return [F.lit(name).alias("check_name"), F.lit(ctype).alias("check_type"), F.lit(severity).alias("severity"),
            n.alias("failing_rows"), (n == 0).alias("passed")]


def _entries(tests: list[tuple[int, Test]], parents: list[tuple[int, str]], places: dict[int, int]) -> Column:
    """What one row of a table tells: (domain, key, place) for each set test and (test) for each broken row rule.

    A domain is the column that keys are looked up in, and a test has a place
    among those of its domain. ``parents`` are the domains that are columns of
    this table, whose keys are marked with no place. Row rules have neither
    domain nor key, so a task sends one count for each. NULL entries are left
    out after the explode: a lambda over the array would have the keys of every
    row made by the interpreter.
    """
    def entry(domain, key: Column, place, keep: Column) -> Column:
        fields = [F.lit(domain).cast("int").alias("domain"), packed(key).alias("k"), F.lit(place).cast("int").alias("p")]
        return F.when(keep, F.struct(*fields))

    out = [entry(d, F.col(c), None, F.col(c).isNotNull()) for d, c in parents]
    for i, t in tests:
        if t.kind in ROW_LEVEL:
            # its number stands where the key does
            out.append(entry(None, F.lit(i), 0, violation_predicate(t)))
        elif t.kind == "unique_combination":
            # JSON leaves a NULL out, so it is told from every value, and equals itself
            # its md5 stands for it, as a surrogate key does for a natural one
            key = F.md5(F.to_json(F.struct(*[F.col(c).alias(f"{n}") for n, c in enumerate(t.args["columns"])])))
            out.append(entry(-1 - i, key, 0, F.lit(True)))
        else:
            domain = t.args["domain"] if t.kind == "relationships" else -1 - i
            out.append(entry(domain, F.col(t.column), places[i], F.col(t.column).isNotNull()))
    return F.explode(F.array(*out))


def run_tests(spark: SparkSession, tables: dict[str, DataFrame], tests: list[Test]) -> DataFrame:
    """Evaluate declared tests; one result row per test.

    Every table is read once, whatever its tests and whichever other tables
    refer to it. Its rows are reduced in the tasks to counts of (domain, key),
    one for each test of the domain, so a key with a third of all rows costs
    one row a task. Keys meet once: a key that a test counted twice is no
    unique key, and one that its domain doesn't hold is an orphan.
    """
    if not tests:
        return spark.createDataFrame([], RESULT_SCHEMA)
    domains = sorted({(t.args["to"], t.args["field"]) for t in tests if t.kind == "relationships"})
    number = {d: i for i, d in enumerate(domains)}
    named = [
        (i, Test(t.kind, t.table, t.column, {**t.args, "domain": number[t.args["to"], t.args["field"]]}, t.severity, t.name) if t.kind == "relationships" else t)
        for i, t in enumerate(tests)
    ]
    # the tests of each domain, in their places; a test of uniqueness has a domain of its own
    of = {d: [i for i, t in named if t.kind == "relationships" and t.args["domain"] == d] for d in number.values()}
    of.update({-1 - i: [i] for i, t in named if t.kind in ("unique", "unique_combination")})
    places = {i: p for ids in of.values() for p, i in enumerate(ids)}
    told = None
    for table in sorted({t.table for t in tests} | {d[0] for d in domains}):
        mine = [(i, t) for i, t in named if t.table == table]
        one = tables[table].select(_entries(mine, [(number[d], d[1]) for d in domains if d[0] == table], places).alias("e")).where("e is not null").select("e.*")
        told = one if told is None else told.unionAll(one)
    width = max([len(ids) for ids in of.values()] + [1])
    counts = [F.count_if(F.col("p") == p).alias(f"n{p}") for p in range(width)]
    keys = told.groupBy("domain", "k").agg(F.bool_or(F.col("p").isNull()).alias("held"), *counts)
    # a negative domain is a test of uniqueness, whose failures are keys; those of the others are rows, as are those of row rules
    rows = F.array(*[F.when(F.col("domain") < 0, (F.col(f"n{p}") > 1).cast("bigint")).when(F.coalesce("held", F.lit(False)) & F.col("domain").isNotNull(), 0).otherwise(F.col(f"n{p}")) for p in range(width)])
    broken = keys.select("domain", F.when(F.col("domain").isNull(), F.col("k").cast("string").cast("int")).alias("t"), F.posexplode(rows).alias("p", "n")).where("n > 0")
    failing = broken.groupBy("domain", "t", "p").agg(F.sum("n").alias("n"))
    where = {i: (d, None, p) for d, ids in of.items() for p, i in enumerate(ids)}
    listed = spark.createDataFrame([(i, t.check_name, t.kind, t.severity, *where.get(i, (None, i, 0))) for i, t in enumerate(tests)],
                                   "i int, check_name string, check_type string, severity string, d int, at int, place int")
    met = F.col("d").eqNullSafe(F.col("domain")) & F.col("at").eqNullSafe(F.col("t")) & (F.col("place") == F.col("p"))
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return listed.join(failing, met, "left").select("check_name", "check_type", "severity", n.alias("failing_rows"), (n == 0).alias("passed"))


def run_checks(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """Results of named violation frames: count each."""
    parts = [c.violations.agg(*_result_row(c.name, c.check_type, c.severity, F.count(F.lit(1)))) for c in checks]
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(results: DataFrame) -> DataFrame:
    """One row: whether the run may publish (no failed ``error`` check)."""
    return results.agg(
        F.count_if((F.col("severity") == ERROR) & ~F.col("passed")).alias("errores"),
        F.count_if((F.col("severity") == WARN) & ~F.col("passed")).alias("advertencias"),
        F.count(F.lit(1)).alias("pruebas"),
    ).withColumn("puede_publicar", (F.col("errores") == 0) & (F.col("pruebas") > 0))


def tagged(table: DataFrame, tests: list[Test], tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of a table that break any of ``tests``, with the names of all that each one breaks in ``fallas``.

    Row rules are told from the row; keys that are repeated, or that a parent
    lacks, are found once for each set test and joined in by key.
    """
    rows, broken = table, []
    for i, t in enumerate(tests):
        if t.kind in ROW_LEVEL:
            broken.append(violation_predicate(t))
            continue
        if t.kind == "relationships":
            held = tables[t.args["to"]].select(F.col(t.args["field"]).cast("string").alias("__pk"))
            keys = table.select(F.col(t.column).cast("string").alias("__k")).where("__k is not null").distinct().join(held, F.col("__k") == F.col("__pk"), "left_anti")
            own = F.col(t.column).cast("string")
        else:
            cols = [t.column] if t.kind == "unique" else t.args["columns"]
            own = F.to_json(F.struct(*cols))
            counted = (table.where(F.col(t.column).isNotNull()) if t.kind == "unique" else table).groupBy(own.alias("__k"))
            keys = counted.agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__k")
        keys = keys.select(F.col("__k").alias(f"__k{i}"), F.lit(True).alias(f"__bad{i}"))
        rows = rows.join(keys, own == F.col(f"__k{i}"), "left")
        broken.append(F.coalesce(F.col(f"__bad{i}"), F.lit(False)))
    names = F.array_compact(F.array(*[F.when(b, F.lit(t.check_name)) for b, t in zip(broken, tests)]))
    return rows.select(*table.columns, names.alias("fallas")).where(F.size("fallas") > 0)


QUARANTINE = ["check_name", "tabla", "fila", "fallas"]


def store_failures(tests: list[Test], tables: dict[str, DataFrame], path: str, mode: str = "overwrite", checks: list[Check] = []) -> None:
    """Quarantine (I35): one write of all failing rows under ``path/check_name=...``.

    A row that fails several tests of its table is stored under each, with the
    names of all of them; a singular check stores the rows it reports.
    """
    parts = []
    for name in dict.fromkeys(t.table for t in tests):
        bad = tagged(tables[name], [t for t in tests if t.table == name], tables)
        parts.append(bad.select(F.explode("fallas").alias("check_name"), F.lit(name).alias("tabla"), F.to_json(F.struct(*tables[name].columns)).alias("fila"), "fallas"))
    for c in checks:
        parts.append(c.violations.select(F.lit(c.name).alias("check_name"), F.lit("").alias("tabla"), F.to_json(F.struct(*c.violations.columns)).alias("fila"), F.array(F.lit(c.name)).alias("fallas")))
    if parts:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        out.select(*QUARANTINE).write.mode(mode).partitionBy("check_name").parquet(path)
