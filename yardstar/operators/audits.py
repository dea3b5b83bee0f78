"""Integrity rules as audit jobs.

Every audit returns violations ``(regra, chave, detalhe)``. As with database
constraints, a check whose outcome is NULL passes and NULL foreign keys refer to
nothing. All row-level rules of a table are evaluated in one pass; duplicates
and orphans are counted by key before anything is shuffled or joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstar import config as C


UNCHECKED = "não verificada"


@dataclass(frozen=True)
class Rule:
    """A row-level rule: ``ok`` must not be false; ``shows`` is what a violation reports."""

    name: str
    ok: str
    shows: str
    columns: tuple[str, ...]


def required(*columns: str) -> list[Rule]:
    return [Rule(f"obrigatorio:{c}", f"{c} IS NOT NULL", f"'{c}'", (c,)) for c in columns]


def one_of(column: str, *values: str) -> Rule:
    listed = ", ".join(f"'{v}'" for v in values)
    return Rule(f"dominio:{column}", f"{column} IN ({listed})", column, (column,))


def at_least(column: str, low: int) -> Rule:
    return Rule(f"faixa:{column}", f"{column} >= {low}", column, (column,))


def above(column: str, low: int) -> Rule:
    return Rule(f"faixa:{column}", f"{column} > {low}", column, (column,))


def not_before(column: str, other: str) -> Rule:
    return Rule(f"ordem:{column}", f"{column} >= {other}", f"concat_ws(' < ', {column}, {other})", (column, other))


def after(column: str, other: str) -> Rule:
    return Rule(f"ordem:{column}", f"{column} > {other}", f"concat_ws(' <= ', {column}, {other})", (column, other))


def length(column: str, low: int, high: int | None = None) -> Rule:
    return Rule(f"tamanho:{column}", f"length({column}) BETWEEN {low} AND {high or low}", column, (column,))


def at_most(column: str, width: int) -> Rule:
    return Rule(f"largura:{column}", f"length({column}) <= {width}", column, (column,))


def without(column: str, letters: str) -> Rule:
    return Rule(f"padrao:{column}", f"NOT (upper({column}) RLIKE '[{letters}]')", column, (column,))


def any_of(name: str, *columns: str) -> Rule:
    return Rule(f"algum:{name}", f"coalesce({', '.join(columns)}) IS NOT NULL", f"'{','.join(columns)}'", columns)


def exactly_one(name: str, a: str, b: str) -> Rule:
    return Rule(f"exclusivo:{name}", f"({a} IS NULL) <> ({b} IS NULL)", f"concat_ws(',', {a}, {b})", (a, b))


def past(column: str) -> Rule:
    """Strictly before the audit date."""
    return Rule(f"futuro:{column}", f"CAST({column} AS DATE) < {{as_of}}", column, (column,))


def not_future(column: str) -> Rule:
    """Not later than the audit date."""
    return Rule(f"futuro:{column}", f"CAST({column} AS DATE) <= {{as_of}}", column, (column,))


@dataclass(frozen=True)
class TableRules:
    """What a source's schema demands of one table."""

    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, its key)
    required: tuple[str, ...] = ()
    checks: tuple[Rule, ...] = ()
    one_active: tuple[str, str, str] | None = None  # (key column, status column, status)


def _key(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def _violations(df: DataFrame, rule: str, keys: Sequence[str], detail: str | Column) -> DataFrame:
    detail = F.col(detail) if isinstance(detail, str) else detail
    return df.select(F.lit(rule).alias("regra"), _key(keys).alias("chave"), detail.cast("string").alias("detalhe"))


def _counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows by key; a key with a NULL is none."""
    present = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    return df.where(present).groupBy(*keys).agg(F.count("*").alias("__n"))


def audit_unique(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Key values held by more than one row; the detail is how many hold it."""
    return _violations(_counted(df, keys).where("__n > 1"), rule, keys, "__n")


def audit_uniques(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """``audit_unique`` of several keys ``{rule: columns}``, each counted in its own columns' types.

    Rows of one shape for all keys would hold each value as text beside its rule, several times as wide.
    """
    return _all_of([audit_unique(df, columns, rule) for rule, columns in keys.items()])


def _all_of(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by halves: a chain of unions would be analysed anew for each part."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return _all_of(parts[:half]).unionByName(_all_of(parts[half:]))


def audit_orphans(child: DataFrame, column: str, parent: DataFrame, key: str, rule: str) -> DataFrame:
    """Foreign keys without a parent; the detail is how many rows refer to it.

    They are counted as ``audit_unique`` counts a key: one that is checked for both is shuffled once, unless Spark
    broadcasts the parent.
    """
    counted = _counted(child, [column])
    known = parent.select(F.col(key).alias("__key"))
    return _violations(counted.join(known, F.col(column) == F.col("__key"), "left_anti"), rule, [column], "__n")


def audit_rows(
    df: DataFrame, keys: Sequence[str], rules: Iterable[Rule], prefix: str = "", as_of: date | None = None
) -> DataFrame:
    """Violations of any number of row-level rules, in one pass over the table."""
    day = f"DATE '{as_of}'" if as_of else "current_date()"
    found = F.array(
        *(
            F.when(
                ~F.expr(r.ok.format(as_of=day) if "{as_of}" in r.ok else r.ok),
                F.struct(F.lit(prefix + r.name).alias("regra"), F.expr(f"CAST({r.shows} AS STRING)").alias("detalhe")),
            )
            for r in rules
        )
    )
    return df.select(_key(keys).alias("chave"), F.explode(F.array_compact(found)).alias("v")).select(
        F.col("v.regra").alias("regra"), "chave", F.col("v.detalhe").alias("detalhe")
    )


def audit_one_active(df: DataFrame, key: str, status: str, value: str, rule: str) -> DataFrame:
    """Keys with more than one row in the given status."""
    return audit_unique(df.where(F.col(status) == value), [key], rule)


def audit_unresolved(resolved: DataFrame) -> DataFrame:
    """How many rows of each source a load leaves out, by missing lookup."""
    return (
        resolved.select("fonte_grupo", F.explode("motivos").alias("motivo"))
        .groupBy("fonte_grupo", "motivo")
        .agg(F.count("*").alias("linhas"))
    )


def audit_table(
    name: str, rules: TableRules, tables: Mapping[str, DataFrame], as_of: date | None = None
) -> DataFrame:
    """All violations of one table.

    A rule that can't be checked, because its column or the table it refers to
    isn't given, is a row of its own: no key, and the detail says what lacks.
    """
    df = tables[name]
    columns = {c.lower() for c in df.columns}

    def has(*names: str) -> bool:
        return all(n.lower() in columns for n in names)

    parts: list[DataFrame] = []
    unchecked: list[tuple[str, str | None, str]] = []

    def checkable(rule: str, *names: str) -> bool:
        lacking = [n for n in names if not has(n)]
        if lacking:
            unchecked.append((rule, None, f"{UNCHECKED}: {', '.join(lacking)}"))
        return not lacking

    keys = {f"{name}:unico:{'+'.join(k)}": k for k in (rules.key, *rules.unique)}
    keys = {rule: k for rule, k in keys.items() if checkable(rule, *k)}
    if keys:
        parts.append(audit_uniques(df, keys))
    for column, (parent, key) in rules.references.items():
        rule = f"{name}:referencia:{column}"
        if checkable(rule, column):
            if parent in tables:
                parts.append(audit_orphans(df, column, tables[parent], key, rule))
            else:
                unchecked.append((rule, None, f"{UNCHECKED}: {parent}"))
    row_rules = [
        r for r in (*required(*rules.required), *rules.checks) if checkable(f"{name}:{r.name}", *r.columns)
    ]
    if row_rules:
        parts.append(audit_rows(df, [k for k in rules.key if has(k)], row_rules, f"{name}:", as_of))
    if rules.one_active:
        key, status, value = rules.one_active
        rule = f"{name}:um_ativo:{key}"
        if checkable(rule, key, status):
            parts.append(audit_one_active(df, key, status, value, rule))
    if unchecked:
        parts.append(df.sparkSession.createDataFrame(unchecked, "regra string, chave string, detalhe string"))
    return _all_of(parts)


def rule_names(name: str, rules: TableRules) -> list[str]:
    """Every rule of one table, as the audit names them."""
    names = [f"unico:{'+'.join(k)}" for k in (rules.key, *rules.unique)]
    names += [f"referencia:{column}" for column in rules.references]
    names += [r.name for r in (*required(*rules.required), *rules.checks)]
    if rules.one_active:
        names.append(f"um_ativo:{rules.one_active[0]}")
    return [f"{name}:{n}" for n in dict.fromkeys(names)]


def audit_all(
    catalog: Mapping[str, TableRules], tables: Mapping[str, DataFrame], as_of: date | None = None, absent: bool = False
) -> DataFrame:
    """Violations of every table that is both in the catalog and given.

    With ``absent``, each rule of a table that isn't given is an unchecked row
    of its own.
    """
    parts = [audit_table(n, r, tables, as_of) for n, r in catalog.items() if n in tables]
    unchecked = [(rule, None, f"{UNCHECKED}: {n}") for n, r in catalog.items() if n not in tables for rule in rule_names(n, r)]
    if absent and unchecked:
        spark = next(iter(tables.values())).sparkSession if tables else SparkSession.active()
        parts.append(spark.createDataFrame(unchecked, "regra string, chave string, detalhe string"))
    return _all_of(parts)


def summary(violations: DataFrame) -> DataFrame:
    """Violations by rule; rules that couldn't be checked have none and say so."""
    unchecked = F.col("chave").isNull()
    return violations.groupBy("regra").agg(
        F.count_if(~unchecked).alias("violacoes"), F.bool_or(unchecked).alias("nao_verificada")
    )
