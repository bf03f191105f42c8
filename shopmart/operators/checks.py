"""Data-quality checks: every check yields its failing rows; none means it passed.

The summary of a suite reads each table once, however many checks look at it.
Every row yields the keys its table's checks ask about and one entry for each rule it breaks;
those are counted by key in a single shuffle, partly before it, so a key that a third of all rows share is
one row per task there. A key's count among the parents and among each of its
children then tells repeated keys and orphans alike, without a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, IntegerType, LongType, ShortType

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


@dataclass(frozen=True)
class Keys:
    """Columns of a table taken as one key."""

    table: DataFrame
    columns: tuple[str, ...]

    def types(self) -> tuple[DataType, ...]:
        return tuple(self.table.schema[c].dataType for c in self.columns)

    def same(self, other: Keys) -> bool:
        return self.table is other.table and self.columns == other.columns

    def key(self, types: Sequence[DataType]) -> dict[str, Column]:
        """The key as columns ``a``, ``b`` and ``text``, equal for equal keys of these types.

        Whole numbers, two at most, stay numbers, and text in hexadecimal digits takes half: keys are most of
        what a summary shuffles.
        """
        columns = [F.col(c).cast(t) for c, t in zip(self.columns, types)]
        if len(columns) <= 2 and all(isinstance(t, _WHOLE) for t in types):
            numbers = [c.cast("long") for c in (*columns, F.lit(None))[:2]]
            return {"a": numbers[0], "b": numbers[1], "text": F.lit(None).cast("binary")}
        if len(columns) == 1:
            text = columns[0].cast("string")
            digits = F.unhex(F.when(text.rlike("^[0-9a-f]+$") & (F.length(text) % 2 == 0), text))
            text = F.coalesce(F.concat(F.lit(b"\x01"), digits), F.concat(F.lit(b"\x00"), F.encode(text, "UTF-8")))
        else:
            named = [c.cast("string").alias(f"c{i}") for i, c in enumerate(columns)]
            text = F.encode(F.when(F.coalesce(*named).isNotNull(), F.to_json(F.struct(*named))), "UTF-8")
        none = F.lit(None).cast("long")
        return {"a": none, "b": none, "text": text}


@dataclass(frozen=True)
class Check:
    """Failing rows are ``rows`` (where ``fails`` holds, if given).

    More than ``warn_above`` failures warn; more than ``error_above`` fail the
    run, unless the severity is ``warn``.

    The rest tells the summary how to count failures without ``rows``: rows of
    ``counted`` that break ``rule``; values of ``unique`` seen more than once; rows
    (or ``distinct`` values, NULL being one) of ``child`` that ``parent`` has not; one
    if the two ``sums``, each of a table's column, differ.
    """

    name: str
    rows: DataFrame
    fails: Column | None = None
    severity: str = "error"
    warn_above: int = 0
    error_above: int = 0
    counted: DataFrame | None = None
    rule: Column | None = None
    unique: Keys | None = None
    with_nulls: bool = False
    child: Keys | None = None
    parent: Keys | None = None
    distinct: bool = False
    sums: tuple[tuple[DataFrame, str], ...] = ()

    def failing(self) -> DataFrame:
        return self.rows if self.fails is None else self.rows.filter(self.fails)

    def as_warning(self) -> Check:
        return replace(self, severity="warn")


class QualityError(RuntimeError):
    """At least one check of severity ``error`` failed."""


def not_null(table: str, df: DataFrame, column: str) -> Check:
    return Check(f"not_null:{table}.{column}", df, F.col(column).isNull())


def accepted_values(table: str, df: DataFrame, column: str, values: Sequence) -> Check:
    """NULL passes."""
    return Check(f"accepted_values:{table}.{column}", df, ~F.col(column).isin(*values))


def accepted_range(
    table: str, df: DataFrame, column: str, minimum: float, inclusive: bool = True
) -> Check:
    """NULL passes."""
    below = F.col(column) < minimum if inclusive else F.col(column) <= minimum
    return Check(f"accepted_range:{table}.{column}", df, below)


def expression_is_true(
    table: str, df: DataFrame, expression: str, where: str | None = None
) -> Check:
    """Rows (selected by ``where``) for which the expression is false; NULL passes."""
    fails = ~F.expr(expression)
    fails = fails if where is None else F.expr(where) & fails
    return Check(f"expression_is_true:{table}:{expression}", df, fails)


def unique(table: str, df: DataFrame, column: str) -> Check:
    """Failing rows: the non-null values seen more than once, and how often."""
    repeated = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )
    return Check(f"unique:{table}.{column}", repeated, unique=Keys(df, (column,)))


def unique_combination(table: str, df: DataFrame, columns: Sequence[str]) -> Check:
    repeated = (
        df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")
    )
    return Check(
        f"unique_combination:{table}:{'+'.join(columns)}",
        repeated,
        unique=Keys(df, tuple(columns)),
        with_nulls=True,
    )


def relationships(
    table: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> Check:
    """Failing rows: child rows whose key has no parent; NULL keys pass."""
    keys = parent.select(F.col(parent_column).alias("__parent"))
    orphans = child.filter(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("__parent"), "left_anti"
    )
    return Check(
        f"relationships:{table}.{column}",
        orphans,
        child=Keys(child, (column,)),
        parent=Keys(parent, (parent_column,)),
    )


def _row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
        F.lit(check.warn_above).alias("warn_above"),
        F.lit(check.error_above).alias("error_above"),
    )


def _adds_up(table: DataFrame, column: str) -> bool:
    """Whether the column's sum fits the amounts of a suite unrounded."""
    kind = table.schema[column].dataType
    return isinstance(kind, DecimalType) and kind.scale <= 2 and kind.precision - kind.scale <= 36


class _Suite:
    """The entries each table yields, and what they tell of each check.

    An entry is (domain, key, slot). The keys of a parent or of a unique check
    are a domain with slot 0, its children have the slots from 1 on; a broken rule is a domain of its own, without a key,
    and so is a column to add up, the only one with amounts.
    """

    def __init__(self) -> None:
        self.domains: list[tuple[Keys | None, bool]] = []
        self.slots: list[int] = []
        self.entries: dict[int, tuple[DataFrame, list[Column]]] = {}
        self.failures: list[tuple[Check, Column]] = []
        self.adds = False

    def _yield(self, table: DataFrame, entry: Column) -> None:
        self.entries.setdefault(id(table), (table, []))[1].append(entry)

    @staticmethod
    def _entry(domain: int, key: dict[str, Column], slot: int, amount: Column | None = None) -> Column:
        amount = F.lit(None) if amount is None else amount
        columns = {"domain": F.lit(domain), **key, "slot": F.lit(slot), "amount": amount.cast("decimal(38, 2)")}
        return F.struct(*[c.alias(name) for name, c in columns.items()])

    _NO_KEY = {"a": "long", "b": "long", "text": "binary"}

    def _own_domain(self) -> tuple[int, dict[str, Column]]:
        self.domains.append((None, False))
        self.slots.append(0)
        return len(self.domains) - 1, {name: F.lit(None).cast(t) for name, t in self._NO_KEY.items()}

    def _keyed(self, table: DataFrame, d: int, key: dict[str, Column], slot: int, with_nulls: bool) -> None:
        entry = self._entry(d, key, slot)
        self._yield(table, entry if with_nulls else F.when(reduce(Column.__or__, [c.isNotNull() for c in key.values()]), entry))

    def _domain(self, keys: Keys, with_nulls: bool) -> int:
        for d, (known, nulls) in enumerate(self.domains):
            if known is not None and known.same(keys) and nulls == with_nulls:
                return d
        self.domains.append((keys, with_nulls))
        self.slots.append(0)
        d = len(self.domains) - 1
        self._keyed(keys.table, d, keys.key(keys.types()), 0, with_nulls)
        return d

    def add(self, check: Check) -> bool:
        """Take a check into the one pass; False if it can only be counted by its rows."""
        at = F.col("domain")
        if check.unique is not None:
            d = self._domain(check.unique, check.with_nulls)
            self.failures.append((check, F.sum(F.when(at == d, F.col("repeated")))))
        elif check.child is not None and check.parent is not None:
            d = self._domain(check.parent, check.distinct)
            self.slots[d] += 1
            slot, key = self.slots[d], check.child.key(check.parent.types())
            self._keyed(check.child.table, d, key, slot, check.distinct)
            orphans = f"{'lost' if check.distinct else 'orphans'}{slot}"
            self.failures.append((check, F.sum(F.when(at == d, F.col(orphans)))))
        elif check.sums:
            if not all(_adds_up(table, column) for table, column in check.sums):
                return False
            told = []
            for table, column in check.sums:
                d, key = self._own_domain()
                self._yield(table, self._entry(d, key, 0, F.col(column)))
                told.append(F.sum(F.when(at == d, F.col("total"))))
            self.adds = True
            self.failures.append((check, F.when(told[0] != told[1], 1)))
        else:
            table, rule = (check.counted, check.rule) if check.rule is not None else (check.rows, check.fails)
            if rule is None:
                return False
            d, key = self._own_domain()
            self._yield(table, F.when(rule, self._entry(d, key, 0)))
            self.failures.append((check, F.sum(F.when(at == d, F.col("own")))))
        return True

    def rows(self) -> DataFrame:
        """One row per check."""
        told = [
            table.select(F.inline(F.array(*entries))).filter("domain is not null")
            for table, entries in self.entries.values()
        ]
        entries = reduce(DataFrame.unionAll, told)
        counts = [F.count_if(F.col("slot") == j).alias(f"s{j}") for j in range(max(self.slots) + 1)]
        # Only where it is asked for: a sum widens every row.
        amount = F.sum("amount") if self.adds else F.lit(None).cast("decimal(38, 2)")
        counted = entries.groupBy("domain", *self._NO_KEY).agg(*counts, amount.alias("amount"))
        orphans = [
            aggregate
            for j in range(1, max(self.slots) + 1)
            for aggregate in (
                F.sum(F.when(F.col("s0") == 0, F.col(f"s{j}"))).alias(f"orphans{j}"),
                F.count_if((F.col("s0") == 0) & (F.col(f"s{j}") > 0)).alias(f"lost{j}"),
            )
        ]
        # One row per domain, of which there are no more than checks.
        counted = counted.groupBy("domain").agg(
            F.sum("s0").alias("own"), F.count_if(F.col("s0") > 1).alias("repeated"), F.sum("amount").alias("total"), *orphans
        )
        results = F.array(*[_row(c, F.coalesce(failures, F.lit(0))) for c, failures in self.failures])
        return counted.agg(results.alias("all")).select(F.inline("all"))


def summary(checks: Sequence[Check]) -> DataFrame:
    """``check, severity, failures, status`` with one row per check.

    Each table is scanned once for all checks that look at its rows and keys; only
    checks that are a query of their own add scans.
    """
    suite = _Suite()
    alone = [c for c in checks if not suite.add(c)]
    told = [c.rows.agg(_row(c, F.count("*")).alias("r")).select("r.*") for c in alone]
    rows = reduce(DataFrame.unionByName, ([suite.rows()] if suite.failures else []) + told)
    blocking = (F.col("severity") == "error") & (F.col("failures") > F.col("error_above"))
    status = (
        F.when(blocking, "error").when(F.col("failures") > F.col("warn_above"), "warn")
    ).otherwise("pass")
    return rows.select("check", "severity", "failures", status.alias("status"))


def enforce(checks: Sequence[Check]) -> list[tuple[str, int, str]]:
    """Run the checks; raise :class:`QualityError` if any blocks, else report them.

    One row per check comes back to the driver, never the failing rows.
    """
    results = [(r["check"], r["failures"], r["status"]) for r in summary(checks).collect()]
    errors = [f"{name} ({failures} rows)" for name, failures, status in results if status == "error"]
    if errors:
        raise QualityError("failed checks: " + "; ".join(sorted(errors)))
    return results
