"""Constraint suites: rules stated once, compiled to as few scans and joins as they need, giving a table of violations.

A violation is (rule, key, detail). Conditions on a row are one scan of its table for all of them. Rules that two tables have
the same keys go together, whatever their number: each table gives its keys with a bit for each side it stands on, and one
aggregation by key finds what stands on one side alone. Links to a table by the same columns share one join, from whatever
tables they come, and only digests of compared values travel. Figures are one aggregation a table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Holds:
    """Each row of a table meets a condition; one that is null is not met. ``key`` and ``holds`` are SQL expressions."""

    rule: str
    table: str
    key: str
    holds: str


@dataclass(frozen=True)
class Distinct:
    """No two rows of a table with one key agree in ``columns`` (SQL expressions)."""

    rule: str
    table: str
    key: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class SameKeys:
    """Two sides, (table, key, condition), have the same keys. ``detail`` says on which side a key stands alone."""

    rule: str
    left: tuple[str, str, str]
    right: tuple[str, str, str]


@dataclass(frozen=True)
class Link:
    """Each row of ``table`` under ``where`` finds a row of ``other`` by ``on``.

    With ``equal``, a pair of expressions, one on either side, the rule is that the two are the same where a row is found, and
    says nothing of a row that finds none. Nulls are equal to each other; of several rows found all must agree.
    """

    rule: str
    table: str
    key: str
    on: tuple[str, ...]
    other: str
    other_on: tuple[str, ...]
    where: str = "true"
    equal: tuple[str, str] | None = None


@dataclass(frozen=True)
class Figure:
    """An aggregate of a table equals the value of that name in the ``figures`` table (name, value)."""

    rule: str
    table: str
    aggregate: str
    name: str


Rule = Holds | Distinct | SameKeys | Link | Figure
_SCHEMA = "rule string, key string, detail string"


def _told(rule: str, broken: Column, detail: Column | None = None) -> Column:
    return F.when(broken, F.struct(F.lit(rule).alias("rule"), (F.lit("") if detail is None else detail).alias("detail")))


def _out(rows: DataFrame, key: Column, told: list[Column]) -> DataFrame:
    found = rows.select(key.cast("string").alias("key"), F.explode(F.array_compact(F.array(*told))).alias("v"))
    return found.select("v.rule", "key", "v.detail")


def _unmet(condition: str) -> Column:
    return ~F.coalesce(F.expr(condition), F.lit(False))


def _holds(tables: Mapping[str, DataFrame], rules: list[Holds]) -> Iterable[DataFrame]:
    by: dict[tuple, list[Holds]] = defaultdict(list)
    for r in rules:
        by[r.table, r.key].append(r)
    for (table, key), own in by.items():
        yield _out(tables[table], F.expr(key), [_told(r.rule, _unmet(r.holds)) for r in own])


def _distinct(tables: Mapping[str, DataFrame], rules: list[Distinct]) -> Iterable[DataFrame]:
    for r in rules:
        keys = [F.expr(r.key).cast("string").alias("key"), *[F.expr(c).alias(f"c{i}") for i, c in enumerate(r.columns)]]
        again = tables[r.table].select(*keys).groupBy("key", *[f"c{i}" for i in range(len(r.columns))]).count().where("count > 1")
        yield again.groupBy("key").agg(F.sum(F.col("count") - 1).alias("n")).select(F.lit(r.rule).alias("rule"), "key", F.col("n").cast("string").alias("detail"))


def _same_keys(tables: Mapping[str, DataFrame], rules: list[SameKeys]) -> Iterable[DataFrame]:
    for start in range(0, len(rules), 30):  # two bits a rule in a long
        some = rules[start : start + 30]
        bits: dict[tuple[str, str], list[Column]] = defaultdict(list)
        for i, r in enumerate(some):
            for j, (table, key, where) in enumerate((r.left, r.right)):
                bits[table, key].append(F.when(F.coalesce(F.expr(where), F.lit(False)), F.lit(1 << (2 * i + j)).cast("long")).otherwise(F.lit(0).cast("long")))
        sides = [tables[t].select(F.expr(k).cast("string").alias("key"), reduce(lambda a, b: a.bitwiseOR(b), own).alias("bits")) for (t, k), own in bits.items()]
        keys = reduce(DataFrame.unionByName, sides).where("bits <> 0").groupBy("key").agg(F.bit_or("bits").alias("bits"))
        side = lambda i: F.shiftright("bits", 2 * i).bitwiseAND(F.lit(3))
        told = [_told(r.rule, side(i).isin(1, 2), F.when(side(i) == 1, r.left[0]).otherwise(r.right[0])) for i, r in enumerate(some)]
        yield _out(keys, F.col("key"), told)


def _digest(expression: str) -> Column:
    return F.coalesce(F.sha2(F.expr(expression).cast("string"), 256), F.lit("null"))


def _links(tables: Mapping[str, DataFrame], rules: list[Link]) -> Iterable[DataFrame]:
    """One join for all links to a table by the same columns, from whatever tables: rows bring the list of what they ask."""
    by: dict[tuple, list[Link]] = defaultdict(list)
    for r in rules:
        by[r.other, r.other_on].append(r)
    for (other, other_on), own in by.items():
        names = [f"on{i}" for i in range(len(other_on))]
        compared = list(dict.fromkeys(r.equal[1] for r in own if r.equal))
        askers: dict[tuple, list[Link]] = defaultdict(list)
        for r in own:
            askers[r.table, r.key, r.on].append(r)
        sides = []
        for (table, key, on), asked in askers.items():
            asks = [F.when(F.coalesce(F.expr(r.where), F.lit(False)), F.struct(F.lit(r.rule).alias("rule"), F.lit(compared.index(r.equal[1]) if r.equal else -1).alias("which"), (_digest(r.equal[0]) if r.equal else F.lit("")).alias("digest"))) for r in asked]
            columns = [F.expr(c).cast("string").alias(n) for c, n in zip(on, names, strict=True)]
            sides.append(tables[table].select(F.expr(key).cast("string").alias("key"), *columns, F.array_compact(F.array(*asks)).alias("asks")).where(F.size("asks") > 0))
        right = tables[other].select(*[F.expr(c).cast("string").alias(n) for c, n in zip(other_on, names, strict=True)], *[_digest(c).alias(f"d{i}") for i, c in enumerate(compared)])
        ends = [F.array(*[f(f"d{i}") for i in range(len(compared))]).cast("array<string>").alias(n) for n, f in (("least", F.min), ("most", F.max))]
        right = right.groupBy(*names).agg(F.lit(True).alias("found"), *ends)
        joined = reduce(DataFrame.unionByName, sides).join(right, names, "left").withColumn("found", F.coalesce("found", F.lit(False)))
        differs = lambda a: F.col("found") & ((a["digest"] != F.get("least", a["which"])) | (a["digest"] != F.get("most", a["which"])))
        broken = F.filter("asks", lambda a: F.when(a["which"] < 0, ~F.col("found")).otherwise(differs(a)))
        rows = joined.select("key", F.concat_ws(" ", *names).alias("at"), F.explode(broken).alias("a"))
        yield rows.select("a.rule", "key", F.when(F.col("a.which") < 0, F.col("at")).otherwise("").alias("detail"))


def _figures(tables: Mapping[str, DataFrame], rules: list[Figure]) -> Iterable[DataFrame]:
    by: dict[str, list[Figure]] = defaultdict(list)
    for r in rules:
        by[r.table].append(r)
    for table, own in by.items():
        row = tables[table].agg(*[F.expr(r.aggregate).cast("long").alias(f"a{i}") for i, r in enumerate(own)])
        rows = row.select(F.explode(F.array(*[F.struct(F.lit(r.rule).alias("rule"), F.lit(r.name).alias("name"), F.col(f"a{i}").alias("n")) for i, r in enumerate(own)])).alias("r")).select("r.*")
        rows = rows.join(tables["figures"].select("name", F.col("value").cast("long").alias("value")), "name", "left").where(~F.col("n").eqNullSafe(F.col("value")))
        yield rows.select("rule", F.col("name").alias("key"), F.concat_ws(" ", F.lit("is"), F.col("n"), F.lit("not"), F.coalesce(F.col("value").cast("string"), F.lit("null"))).alias("detail"))


def violations(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """(rule, key, detail): a row for each row, key or figure that breaks a rule. Empty tables break no rule but figures."""
    kinds: dict[type, list] = defaultdict(list)
    for r in rules:
        kinds[type(r)].append(r)
    compiled = {Holds: _holds, Distinct: _distinct, SameKeys: _same_keys, Link: _links, Figure: _figures}
    parts = [df for kind, own in kinds.items() for df in compiled[kind](tables, own)]
    empty = next(iter(tables.values())).sparkSession.createDataFrame([], _SCHEMA)
    return reduce(DataFrame.unionByName, parts, empty)
