"""Run configuration: paths, datasets and their rules, checked before any job."""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from graphlib import CycleError, TopologicalSorter
from pathlib import Path
from typing import Any

from claimloom.functions.dates import ISO, check_format
from claimloom.operators.rules import Rule, rule_from_dict

# The calendar the monthly figures are limited to, if the config names no other.
CALENDAR_START = dt.date(2024, 1, 1)
CALENDAR_END = dt.date(2026, 12, 31)

#: Column of a bronze table that holds a line whose number of cells was wrong, else null.
CORRUPT_LINE = "_corrupt_line"
ON_BAD_VALUE = ("fail", "quarantine")

#: Columns of the known datasets that are not text; their cells stay text until
#: silver is made.
TYPED_COLUMNS = {
    "members": {
        "date_of_birth": "timestamp",
        "enrolment_date": "timestamp",
        "monthly_premium_eur": "double",
    },
    "claims": {
        "service_date": "timestamp",
        "submitted_date": "timestamp",
        "billed_amount_eur": "double",
        "approved_amount_eur": "double",
    },
}


def reading_rules(kinds: Mapping[str, str]) -> tuple[Rule, ...]:
    """Rules that quarantine what could not be read: ragged lines, cells that are no value of their type."""
    whole = Rule("whole_line", (CORRUPT_LINE,), description="A line has as many cells as the header")
    return (
        whole,
        *(Rule("readable", (c,), {"kind": k}, f"{c} can be read") for c, k in kinds.items()),
    )


def references_of(rules: Sequence[Rule]) -> set[str]:
    """Datasets whose keys the rules look into."""
    return {r.args["reference"] for r in rules if r.type == "referential"}


@dataclass(frozen=True)
class Dataset:
    """One raw extract. ``key`` is the column other datasets refer to."""

    name: str
    file: str
    key: str
    rules: tuple[Rule, ...] = ()
    columns: Mapping[str, str] = field(default_factory=dict)
    multi_line: bool = False
    #: Formats that date columns may be written in; each is read by the one that reads most of its cells.
    date_formats: tuple[str, ...] = (ISO,)

    @property
    def date_columns(self) -> list[str]:
        """Columns that are read as dates."""
        of_rules = {c for r in self.rules if r.type == "date_order" for c in r.columns}
        return sorted({c for c, kind in self.kinds.items() if kind == "timestamp"} | of_rules)

    def in_formats(self, chosen: Mapping[str, str]) -> Dataset:
        """The dataset with its date columns in the formats that were found."""
        kinds = {c: f"timestamp:{chosen[c]}" if kind == "timestamp" and c in chosen else kind for c, kind in self.kinds.items()}
        rules = []
        for rule in self.rules:
            if rule.type == "date_order":
                rule = replace(rule, args={**rule.args, "formats": {c: chosen[c] for c in rule.columns if c in chosen}})
            elif rule.type == "readable" and rule.args["kind"] == "timestamp" and rule.columns[0] in chosen:
                rule = replace(rule, args={"kind": f"timestamp:{chosen[rule.columns[0]]}"})
            rules.append(rule)
        return replace(self, rules=tuple(rules), columns=kinds)

    @property
    def kinds(self) -> dict[str, str]:
        """Types of the columns other than text; declared ones win."""
        return {**TYPED_COLUMNS.get(self.name, {}), **self.columns}

    @property
    def rule_columns(self) -> set[str]:
        """Columns of the extract that the key and the rules need."""
        return {self.key, *(c for r in self.rules for c in r.columns)} - {CORRUPT_LINE}

    @property
    def references(self) -> set[str]:
        return references_of(self.rules)


@dataclass(frozen=True)
class Config:
    raw_zone: str
    quarantine_zone: str
    reports: str
    warehouse: str
    datasets: Mapping[str, Dataset]
    database_prefix: str = ""
    #: First and last day of the calendar.
    calendar: tuple[dt.date, dt.date] = (CALENDAR_START, CALENDAR_END)

    @property
    def stages(self) -> list[list[str]]:
        """Dataset names in stages; each refers to earlier stages only."""
        sorter = TopologicalSorter({name: ds.references for name, ds in self.datasets.items()})
        sorter.prepare()
        stages = []
        while sorter.is_active():
            stages.append(list(sorter.get_ready()))
            sorter.done(*stages[-1])
        return stages

    @property
    def order(self) -> list[str]:
        """Dataset names, each after the datasets it refers to."""
        return [name for stage in self.stages for name in stage]

    def database(self, layer: str) -> str:
        return f"{self.database_prefix}{layer}"


def _dataset(name: str, declared: Mapping[str, Any], on_bad_value: str) -> Dataset:
    ds = Dataset(
        name=name,
        file=declared["file"],
        key=declared.get("key", f"{name[:-1]}_id"),
        rules=tuple(rule_from_dict(r) for r in declared.get("rules") or ()),
        columns=dict(declared.get("columns") or {}),
        multi_line=bool(declared.get("multi_line", False)),
        date_formats=tuple(declared.get("date_formats") or (ISO,)),
    )
    for fmt in ds.date_formats:
        check_format(fmt)
    odd = {k for k in ds.columns.values() if k not in ("double", "timestamp")}
    if odd:
        raise ValueError(f"{name}: columns are text, double or timestamp, not {', '.join(sorted(odd))}")
    return ds if on_bad_value == "fail" else replace(ds, rules=(*ds.rules, *reading_rules(ds.kinds)))


def qualified(path: str) -> str:
    """A path that means the same wherever it is used: relative ones are below the working folder."""
    return path if ":" in path.split("/")[0] else os.path.abspath(path)


def _calendar(declared: Mapping[str, Any]) -> tuple[dt.date, dt.date]:
    first, last = (
        dt.date.fromisoformat(str(declared.get(k, default)))
        for k, default in (("start", CALENDAR_START), ("end", CALENDAR_END))
    )
    if first > last:
        raise ValueError(f"the calendar ends on {last}, before it starts on {first}")
    return first, last


def config_from_dict(declared: Mapping[str, Any]) -> Config:
    on_bad_value = declared.get("on_bad_value", "fail")
    if on_bad_value not in ON_BAD_VALUE:
        raise ValueError(f"on_bad_value is one of {', '.join(ON_BAD_VALUE)}, not {on_bad_value!r}")
    datasets = {n: _dataset(n, d, on_bad_value) for n, d in declared["datasets"].items()}
    for name, ds in datasets.items():
        unknown = ds.references - datasets.keys()
        if unknown:
            raise ValueError(f"{name} refers to unknown datasets: {sorted(unknown)}")
    config = Config(
        **{
            k: qualified(declared["paths"][k])
            for k in ("raw_zone", "quarantine_zone", "reports", "warehouse")
        },
        datasets=datasets,
        database_prefix=declared.get("database_prefix", ""),
        calendar=_calendar(declared.get("calendar") or {}),
    )
    try:
        config.order
    except CycleError as error:
        raise ValueError(f"datasets refer to each other: {error.args[1]}") from error
    return config


def load_config(path: str | Path) -> Config:
    """Read a YAML or JSON file; YAML needs the yaml package on the driver."""
    text = Path(path).read_text()
    if str(path).endswith(".json"):
        return config_from_dict(json.loads(text))
    try:
        import yaml
    except ImportError as error:
        raise ImportError("reading a YAML config needs PyYAML; or give it as JSON") from error
    return config_from_dict(yaml.safe_load(text))
