"""Constraints that hold at write time.

A relational warehouse refuses a row that breaks a constraint. Here the rules
of a table are compiled into one set of conditional counts that rides on the
write itself (``observe``): the rows are read once, whatever the number of
rules, and the counts are known when the write ends. The caller then publishes
the written files or, with :class:`RuleViolation`, leaves them unpublished.

A rule is violated where its predicate is true; a NULL predicate is no
violation, as in SQL. Counts are taken in the tasks that write, so a task that
runs again is counted once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martlet.operators.quality import VARCHAR_LIMITS, rules_to_rows
from martlet.schemas import FACT_LINE_KEY, SOURCES

_ROWS = "rows"


class RuleViolation(RuntimeError):
    """Raised instead of publishing; ``counts`` maps each violated rule to its rows."""

    def __init__(self, counts: Mapping[str, int]):
        self.counts = dict(counts)
        super().__init__("; ".join(f"{rule}: {n} rows" for rule, n in sorted(self.counts.items())))


@dataclass
class Rules:
    """The rules of one table by name; each adds a violation predicate."""

    table: str
    violations: dict[str, Column] = field(default_factory=dict)

    def not_null(self, columns: Iterable[str]) -> Rules:
        for c in columns:
            self.violations[f"{self.table}.{c} not null"] = F.col(c).isNull()
        return self

    def check(self, text: str, predicate: Column) -> Rules:
        self.violations[f"{self.table}.{text}"] = ~predicate
        return self

    def lengths(self, limits: Mapping[str, int]) -> Rules:
        for c, n in limits.items():
            self.violations[f"{self.table}.{c} length <= {n}"] = F.length(c) > n
        return self


class Gate:
    """The rules attached to one frame that is about to be written.

    Write ``gate.rows``, then ask ``gate.check()`` (or ``counts()``); both wait
    for that write. The frame is to be run by one action only."""

    def __init__(self, rows: DataFrame, rules: Rules):
        self._names = list(rules.violations)
        self._seen = Observation()
        counts = [F.count_if(F.coalesce(rules.violations[n], F.lit(False))).alias(f"r{i}") for i, n in enumerate(self._names)]
        self.rows = rows.observe(self._seen, F.count(F.lit(1)).alias(_ROWS), *counts)

    def counts(self) -> dict[str, int]:
        seen = self._seen.get
        return {n: int(seen[f"r{i}"]) for i, n in enumerate(self._names)}

    def written(self) -> int:
        return int(self._seen.get[_ROWS])

    def check(self) -> int:
        """The number of rows written, or :class:`RuleViolation`."""
        refuse({n: c for n, c in self.counts().items() if c})
        return self.written()


def refuse(violated: Mapping[str, int]) -> None:
    if violated:
        raise RuleViolation(violated)


def source_rules() -> dict[str, Rules]:
    """The declared constraints of the source tables."""
    rules = {t: Rules(t).not_null(schema.fieldNames()).lengths(VARCHAR_LIMITS.get(t, {})) for t, schema in SOURCES.items()}
    rules["products"].check("price >= 0", F.col("price") >= 0)
    rules["transactions"].check("total_amount >= 0", F.col("total_amount") >= 0)
    rules["transaction_items"].check("quantity > 0", F.col("quantity") > 0).check("price >= 0", F.col("price") >= 0)
    rules["marketing_campaigns"].check("end_date >= start_date", F.col("end_date") >= F.col("start_date"))
    return rules


def fact_rules() -> Rules:
    """The fact's constraints: keys and measures present, gross = quantity x
    price. An amount too large for its type is null by then, so it is refused
    here and not stored as null."""
    keys = ["sales_key", "customer_key", "product_key", "campaign_key", *FACT_LINE_KEY, "month_key"]
    amounts = ["quantity", "unit_price", "gross_amount", "net_amount", "tax_amount", "total_amount", "cost_amount", "profit_amount"]
    gross = F.col("gross_amount") == F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")
    return Rules("fact_sales").not_null([*keys, *amounts]).check("gross_amount = quantity * unit_price", gross)


def dimension_rules(name: str, columns: Sequence[str]) -> Rules:
    """Surrogate and business key of a dimension."""
    return Rules(name).not_null(columns)


def report(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> DataFrame:
    """(rule, n_violations) of stored tables: one pass for each table over
    all of its rules together."""
    frames = [rules_to_rows(df, rules[t].violations) for t, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
