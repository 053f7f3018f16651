"""Row rules: each turns a dataset into a column that is true where a row fails.

A rule never yields null. Most are plain column expressions; ``unique`` and
``referential`` first look something up by key and so return a wider frame.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.dates import ISO, parse_by
from claimloom.functions.exprs import lenient_number, plain_text
from claimloom.functions.patterns import java_pattern
from claimloom.operators.lookup import (
    BROADCAST_BYTES,
    ROWS_PER_TASK,
    Exceptions,
    broadcast_lookup,
    lookup,
    may_have,
    measured_bytes,
    parts_of_hot,
    salted_lookup,
)

#: Tells apart rows that are equal in everything else; ``unique`` needs it.
ROW = "_dq_row"


@dataclass(frozen=True)
class Rule:
    """One declared rule; ``args`` holds what its type needs besides columns."""

    type: str
    columns: tuple[str, ...]
    args: Mapping[str, Any] = field(default_factory=dict)
    description: str = ""

    @property
    def label(self) -> str:
        return "->".join(self.columns)

    @property
    def reason(self) -> str:
        return f"{self.type}:{self.label};"


@dataclass(frozen=True)
class RuleInputs:
    """What rules may look at besides the row itself.

    ``rows`` is the dataset as given, without what earlier rules looked up;
    counting on it keeps those joins out of the counting pass.
    ``references`` maps a dataset name to its accepted keys, one column each;
    they are measured when the rule is built, so they should be stored.
    ``order_by`` names columns that put the rows in input order; where they
    tie, the row id decides. ``earlier`` holds keys that came before all of
    these rows, for a load in batches. ``store`` writes a small intermediate
    frame, so that it can be measured; without it large rows are shuffled.
    Rows have a ``ROW`` column that stays the same however they are read.
    What is too large to be broadcast is left in ``later``, to be looked up for
    the rows of all rules at once.
    """

    rows: DataFrame
    references: Mapping[str, DataFrame]
    order_by: Sequence[str]
    rows_per_task: int = ROWS_PER_TASK
    broadcast_bytes: int = BROADCAST_BYTES
    earlier: DataFrame | None = None
    store: Callable[[str, DataFrame], DataFrame] | None = None
    later: list[Exceptions] = field(default_factory=list)


Check = Callable[[DataFrame, Rule, RuleInputs, str], tuple[DataFrame, Column]]


def _decided(condition: Column, when_null: bool) -> Column:
    """The condition with its nulls settled."""
    return F.coalesce(condition, F.lit(when_null))


def _not_null(df: DataFrame, rule: Rule, inputs: RuleInputs, slot: str):
    (name,) = rule.columns
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(name)
    return df, missing


def _allowed_values(df: DataFrame, rule: Rule, inputs: RuleInputs, slot: str):
    (name,) = rule.columns
    accepted = list(rule.args["values"])
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        fitting = [v for v in accepted if isinstance(v, str)]
    elif isinstance(kind, T.BooleanType):
        fitting = [v for v in accepted if isinstance(v, bool)]
    else:
        fitting = [v for v in accepted if v is not None and not isinstance(v, (str, bool))]
    unknown = ~F.col(name).isin(fitting) if fitting else F.lit(True)
    return df, F.when(F.col(name).isNull(), None not in accepted).otherwise(unknown)


def _min_value(df: DataFrame, rule: Rule, inputs: RuleInputs, slot: str):
    (name,) = rule.columns
    number = lenient_number(F.col(name), df.schema[name].dataType)
    below = (number < F.lit(float(rule.args["threshold"]))) & ~F.isnan(number)
    return df, _decided(below, when_null=False)


def _regex_match(df: DataFrame, rule: Rule, inputs: RuleInputs, slot: str):
    (name,) = rule.columns
    from_start = rf"\A(?:{rule.args.get('java') or java_pattern(rule.args['pattern'])})"
    text = plain_text(F.col(name), df.schema[name].dataType)
    return df, _decided(~text.rlike(from_start), when_null=True)


def _date_order(df: DataFrame, rule: Rule, inputs: RuleInputs, slot: str):
    formats = rule.args.get("formats", {})
    first, second = (parse_by(F.col(name), formats.get(name, ISO)) for name in rule.columns)
    return df, _decided(first > second, when_null=False)


def _unique(df: DataFrame, rule: Rule, inputs: RuleInputs, slot: str):
    """Every row after the first with the same key fails; nulls are one key.

    Exactly one row per key passes: the one with the smallest position, and of
    those that tie the one with the smallest row id. A null position comes
    first. Only keys that occur twice are looked up, with their first row. A
    window per key would sort all copies of a key in one task.
    """
    (name,) = rule.columns
    if not inputs.order_by:
        raise ValueError("unique needs order_by columns to tell which row came first")
    first = F.min(F.struct(*inputs.order_by, ROW))[ROW]
    sizes = inputs.rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    spread_by = [*inputs.order_by, ROW]
    if inputs.store:
        # Hashes are counted, without a sort and without moving a key. Which row came first is only asked
        # for keys that come twice; keys that share a hash, or a bit, are told apart there.
        hashed = inputs.rows.groupBy(F.xxhash64(name).alias("hash")).agg(F.count(F.lit(1)).alias("n"))
        hashes = inputs.store(f"repeated_{slot}", hashed.where("n > 1"))
        copies = inputs.rows.where(may_have(F.xxhash64(name), hashes, "hash"))
        firsts = copies.groupBy(name).agg(first.alias(slot), F.count(F.lit(1)).alias("n"))
        repeated = inputs.store(f"first_{slot}", firsts.where("n > 1"))
    else:
        repeated = inputs.rows.groupBy(name).agg(first.alias(slot), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = _looked_up(df, repeated, name, spread_by, inputs)
    later_copy = _decided(F.col(ROW) != F.col(slot), when_null=False)
    if inputs.earlier is None:
        return found, later_copy

    # Only earlier keys that come up again are looked up, so what is joined
    # to the rows does not grow with all that came before.
    own = sizes.select(F.col(name).alias("_own_key"), "n")
    again = (
        inputs.earlier.select(name)
        .distinct()
        .join(own, F.col(name).eqNullSafe(F.col("_own_key")))
        .select(name, "n", F.lit(True).alias(f"{slot}_again"))
    )
    if inputs.store:
        again = inputs.store(f"again_{slot}", again)
    found = _looked_up(found, again, name, spread_by, inputs)
    return found, later_copy | F.col(f"{slot}_again").isNotNull()


def _looked_up(df: DataFrame, keys: DataFrame, name: str, spread_by: list[str], inputs: RuleInputs) -> DataFrame:
    """``df`` with the other columns of ``keys``, which also has the rows ``n`` of each key; or it gets them later."""
    table = keys.drop("n")
    if not inputs.store:
        return salted_lookup(df, table, name, parts_of_hot(keys, name, inputs.rows_per_task), spread_by)
    if measured_bytes(table) <= inputs.broadcast_bytes:
        return broadcast_lookup(df, table, name)
    inputs.later.append(Exceptions(keys, name, tuple(spread_by), inputs.rows_per_task))
    return df


def _readable(df: DataFrame, rule: Rule, inputs: RuleInputs, slot: str):
    """Fails where a cell has text that is no value of the column's type."""
    (name,) = rule.columns
    value = F.col(name)
    kind, _, fmt = rule.args["kind"].partition(":")
    if kind == "timestamp":
        parsed = parse_by(value.cast("string"), fmt or ISO)
    else:
        parsed = lenient_number(value, df.schema[name].dataType)
    return df, value.isNotNull() & parsed.isNull()


def _whole_line(df: DataFrame, rule: Rule, inputs: RuleInputs, slot: str):
    """Fails where the line had more or fewer cells than the header."""
    (name,) = rule.columns
    return df, F.col(name).isNotNull()


def _referential(df: DataFrame, rule: Rule, inputs: RuleInputs, slot: str):
    """Fails where the key is not among the accepted keys of the reference."""
    (name,) = rule.columns
    keys = inputs.references[rule.args["reference"]]
    kind = df.schema[name].dataType
    accepted = keys.select(F.col(keys.columns[0]).try_cast(kind).alias(name)).distinct()
    spread_by = list(inputs.order_by or inputs.rows.columns)
    if inputs.store and measured_bytes(keys) > inputs.broadcast_bytes:
        # Keys are moved, once for each task that has them, and the rows only of those that are missing.
        sizes = inputs.rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
        known = accepted.withColumnRenamed(name, "_known_key")
        missing = sizes.join(known, F.col(name).eqNullSafe(F.col("_known_key")), "left_anti")
        missing = inputs.store(f"missing_{slot}", missing.withColumn(slot, F.lit(True)))
        return _looked_up(df, missing, name, spread_by, inputs), F.col(slot).isNotNull()
    found = lookup(
        df,
        accepted.withColumn(slot, F.lit(True)),
        name,
        spread_by=spread_by,
        measured=keys,
        counted_on=inputs.rows,
        rows_per_task=inputs.rows_per_task,
        broadcast_bytes=inputs.broadcast_bytes,
    )
    return found, F.col(slot).isNull()


@dataclass(frozen=True)
class RuleType:
    """How a rule type is declared in a config, and what it checks."""

    check: Check
    column_keys: tuple[str, ...] = ("column",)
    arg_keys: tuple[str, ...] = ()


#: A new rule type is one function and one line here.
RULE_TYPES: dict[str, RuleType] = {
    "not_null": RuleType(_not_null),
    "unique": RuleType(_unique),
    "allowed_values": RuleType(_allowed_values, arg_keys=("values",)),
    "min_value": RuleType(_min_value, arg_keys=("threshold",)),
    "regex_match": RuleType(_regex_match, arg_keys=("pattern",)),
    "date_order": RuleType(_date_order, column_keys=("column_a", "column_b")),
    "referential": RuleType(_referential, arg_keys=("reference",)),
    "readable": RuleType(_readable, arg_keys=("kind",)),
    "whole_line": RuleType(_whole_line),
}


def _is_number(value: Any) -> bool:
    try:
        float(value)
    except (TypeError, ValueError):
        return False
    return True


def check_pattern(pattern: Any) -> None:
    """Refuse what no regular expression can be. Of Java's patterns only what Python refuses too
    is found here, as the driver may have no session yet."""
    try:
        re.compile(pattern)
    except TypeError as error:
        raise ValueError(f"pattern is no text: {pattern!r}") from error
    except re.error as error:
        if any(sign in str(error) for sign in ("unterminated", "missing )", "unbalanced", "nothing to repeat")):
            raise ValueError(f"broken pattern {pattern!r}: {error}") from error


def rule_from_dict(declared: Mapping[str, Any]) -> Rule:
    """Read one declared rule; any mistake is found before a job starts."""
    name = declared.get("type")
    if name not in RULE_TYPES:
        raise ValueError(f"unknown rule type: {name!r}")
    kind = RULE_TYPES[name]
    missing = [k for k in (*kind.column_keys, *kind.arg_keys) if k not in declared]
    if missing:
        raise ValueError(f"rule {name} lacks {', '.join(missing)}")
    if name == "min_value" and not _is_number(declared["threshold"]):
        raise ValueError(f"threshold is no number: {declared['threshold']!r}")
    args = {k: declared[k] for k in kind.arg_keys}
    if name == "regex_match":
        dialect = declared.get("dialect", "python")
        if dialect not in ("python", "java"):
            raise ValueError(f"the dialect of a pattern is python or java, not {dialect!r}")
        if dialect == "java":
            check_pattern(declared["pattern"])
        args["java"] = declared["pattern"] if dialect == "java" else java_pattern(declared["pattern"])
    return Rule(
        type=name,
        columns=tuple(declared[k] for k in kind.column_keys),
        args=args,
        description=declared.get("description", ""),
    )
