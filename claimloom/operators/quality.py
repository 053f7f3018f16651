"""Applying all rules of a dataset: clean rows, quarantined rows, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.lookup import BROADCAST_BYTES, ROWS_PER_TASK, with_exceptions
from claimloom.operators.rules import ROW, RULE_TYPES, Rule, RuleInputs
from claimloom.sources.tables import Staging

REASONS = "_dq_failures"
REPORT_LINE = (
    "array<struct<rule_type:string,column:string,description:string,rows_failed:bigint>>"
)


def _flag(i: int) -> str:
    return f"_dq_{i}"


@dataclass(frozen=True)
class RuleOutcome:
    """A dataset with one flag per rule and the reasons text per row.

    ``checked`` may be swapped for a stored copy of itself before the three
    results below are taken from it, see ``on``.
    """

    checked: DataFrame
    dataset: str
    rules: tuple[Rule, ...]
    data_columns: tuple[str, ...]

    def on(self, stored: DataFrame) -> RuleOutcome:
        return RuleOutcome(stored, self.dataset, self.rules, self.data_columns)

    def failing(self, i: int) -> DataFrame:
        """Rows that fail the rule at position ``i``, with all columns."""
        return self.checked.where(_flag(i))

    @property
    def clean(self) -> DataFrame:
        return self.checked.where(F.col(REASONS) == "").select(*self.data_columns)

    @property
    def quarantined(self) -> DataFrame:
        return self.checked.where(F.col(REASONS) != "").select(*self.data_columns, REASONS)

    @property
    def report(self) -> DataFrame:
        """One row per rule, from a single aggregate over all flags."""
        return self.report_of(self.checked.agg(*self.counts))

    @property
    def counts(self) -> list[Column]:
        """The aggregates the report is made of."""
        failed = [F.count_if(_flag(i)).alias(_flag(i)) for i in range(len(self.rules))]
        return [F.count(F.lit(1)).alias("rows_checked"), *failed]

    def report_of(self, counts: DataFrame) -> DataFrame:
        """The report from one row of ``counts``."""
        lines = [
            F.struct(
                F.lit(rule.type).alias("rule_type"),
                F.lit(rule.label).alias("column"),
                F.lit(rule.description).alias("description"),
                F.col(_flag(i)).alias("rows_failed"),
            )
            for i, rule in enumerate(self.rules)
        ]
        each = counts.select("rows_checked", F.explode(F.array(*lines).cast(REPORT_LINE)).alias("line"))
        return each.select(
            F.lit(self.dataset).alias("dataset"),
            "line.rule_type",
            "line.column",
            "line.description",
            "rows_checked",
            "line.rows_failed",
            _pass_rate(F.col("rows_checked"), F.col("line.rows_failed")).alias("pass_rate_pct"),
        )


def _pass_rate(checked: Column, failed: Column) -> Column:
    """Percent of rows that passed, to 2 digits, halves to even; 100 on no rows."""
    share = F.lit(1.0) - failed / F.nullif(checked, F.lit(0))
    return F.bround(F.coalesce(share, F.lit(1.0)) * F.lit(100.0), 2)


def apply_rules(
    df: DataFrame,
    dataset: str,
    rules: Sequence[Rule],
    references: Mapping[str, DataFrame] | None = None,
    order_by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
    earlier: DataFrame | None = None,
    store: Callable[[str, DataFrame], DataFrame] | None = None,
    row_id: Column | None = None,
) -> RuleOutcome:
    """Check every rule on all rows of ``df``, whatever other rules say.

    So a copy is still a copy when the row it repeats fails elsewhere. The
    ``order_by`` columns give the input order; they are not part of the
    clean and quarantined rows. ``earlier`` rows count as occurrences for
    ``unique`` and are not checked again.

    ``unique`` tells rows that tie apart by ``row_id``, which must be the same
    whenever the rows are read, by how many tasks ever: a stored number, or
    ``sources.tables.row_in_file`` of a frame that is read from Parquet files.
    Without it the rows are written first, with a number each. ``store`` writes
    intermediate frames.
    """
    rows = df
    if any(r.type == "unique" for r in rules):
        if row_id is not None:
            rows = df.withColumn(ROW, row_id)
        else:
            write = store or Staging(df.sparkSession, f"rows-{uuid4().hex}").store
            rows = write(f"{dataset}-rows", df.withColumn(ROW, F.monotonically_increasing_id()))
    inputs = RuleInputs(
        rows, references or {}, tuple(order_by), rows_per_task, broadcast_bytes, earlier, store
    )
    unknown = [
        r.args["reference"]
        for r in rules
        if r.type == "referential" and r.args["reference"] not in inputs.references
    ]
    if unknown:
        raise ValueError(f"{dataset}: no keys given for {', '.join(unknown)}")

    data_columns = tuple(c for c in df.columns if c not in order_by)
    checked = rows
    flags: dict[str, Column] = {}
    for i, rule in enumerate(rules):
        check = RULE_TYPES[rule.type].check
        checked, flags[_flag(i)] = check(checked, rule, inputs, f"_found_{i}")
    reasons = F.concat(
        F.lit(""), *[F.when(F.col(_flag(i)), r.reason).otherwise("") for i, r in enumerate(rules)]
    )
    checked = (
        with_exceptions(checked, inputs.later)
        .withColumns(flags)
        .select(*df.columns, *flags)
        .withColumn(REASONS, reasons)
    )
    return RuleOutcome(checked, dataset, tuple(rules), data_columns)


def union_reports(outcomes: Sequence[RuleOutcome]) -> DataFrame:
    """The audit report of a run: the rules of all datasets."""
    report = outcomes[0].report
    for outcome in outcomes[1:]:
        report = report.unionByName(outcome.report)
    return report


def total_failures(report: DataFrame) -> DataFrame:
    """Failures over all rules; a row that fails two rules counts twice."""
    return report.agg(F.coalesce(F.sum("rows_failed"), F.lit(0)).alias("total_failures"))


def reason_counts(quarantined: DataFrame, *by: str) -> DataFrame:
    """Quarantined rows per single reason, and per the columns ``by``."""
    single = F.explode(F.split(F.regexp_replace(REASONS, ";$", ""), ";"))
    return quarantined.select(*by, single.alias("reason")).groupBy(*by, "reason").agg(
        F.count(F.lit(1)).alias("rows")
    )
