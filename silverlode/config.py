"""Typed configuration: formats, sources, columns, targets and rules, checked when built."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

INGESTION_TYPES = ("BATCH", "STREAM")
LOAD_TYPES = ("MERGE", "APPEND")
FORMAT_TYPES = ("CSV", "JSON", "PARQUET")
CHECK_TYPES = (
    "MANDATORY_CHECK", "VALUE_CHECK", "LOOKUP_CHECK", "DUPLICATE_ALLOW_ONE_CHECK",
)
EXTENDED_CHECK_TYPES = (
    "VALUE_RANGE", "PATTERN", "DUPLICATE", "COMPLETENESS", "CONSISTENCY", "FRESHNESS", "VOLUME", "STATISTICAL",
    "CUSTOM_QUERY",
)


class ConfigError(ValueError):
    """A configuration value nothing handles, or a name nothing defines."""


class UnknownSource(ConfigError):
    pass


def _one_of(kind: str, value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ConfigError(f"unknown {kind} {value!r}; expected one of {', '.join(allowed)}")


@dataclass(frozen=True)
class FileFormat:
    kind: str = "CSV"
    delimiter: str = ","
    quote: str = '"'
    header: bool = True
    null_tokens: tuple[str, ...] = ("\\N",)
    trim: bool = False
    ragged: bool = False

    def __post_init__(self):
        _one_of("format type", self.kind, FORMAT_TYPES)


@dataclass(frozen=True)
class Column:
    """A source column: its rule, and the type the rule gives.

    ``rule`` is one of raw, trim, upper, lower, code (upper case, blanks as underscores), int, date,
    timestamp, json, decimal(p,s), or any SQL expression over the source column.
    """

    name: str
    rule: str = "raw"
    key: bool = False
    generated: bool = False
    default: str | None = None
    tag: str | None = None


@dataclass(frozen=True)
class Target:
    bronze: str
    errors: str
    silver: str
    gold: str
    load_type: str = "MERGE"
    merge_keys: tuple[str, ...] = ()
    raw_columns: bool = True
    audit_columns: bool = True

    def __post_init__(self):
        _one_of("load type", self.load_type, LOAD_TYPES)


@dataclass(frozen=True)
class Source:
    source_id: int
    name: str
    entity: str
    ingestion: str
    columns: tuple[Column, ...]
    target: Target
    landing: str = ""
    pattern: str | None = None
    format: FileFormat = field(default_factory=FileFormat)
    active: bool = True
    derived: tuple[str, ...] = ()

    def __post_init__(self):
        _one_of("ingestion type", self.ingestion, INGESTION_TYPES)
        if not self.keys:
            raise ConfigError(f"source {self.name} has no key column")

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.key]

    @property
    def merge_on(self) -> list[str]:
        return list(dict.fromkeys([*self.keys, *self.target.merge_keys]))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def silver_names(self) -> list[str]:
        """Columns from Silver on: those of the source and those derived on the way there."""
        return [*self.names, *self.derived]


@dataclass(frozen=True)
class Rule:
    """A quality rule.  ``expression`` is TRUE for good rows; NULL is not an error."""

    name: str
    kind: str
    column: str
    expression: str | None = None
    message: str = ""
    active: bool = True
    lookup: tuple[str, str] | None = None
    severity: str = "ERROR"
    threshold: float | None = None

    def __post_init__(self):
        _one_of("validation type", self.kind, CHECK_TYPES + EXTENDED_CHECK_TYPES)


def ordered_rules(rules: Sequence[Rule], kinds: Sequence[str] = CHECK_TYPES) -> list[Rule]:
    """Active rules by type (mandatory, value, lookup, duplicate), then as written."""
    return sorted((r for r in rules if r.active), key=lambda r: (*kinds, *EXTENDED_CHECK_TYPES).index(r.kind))


@dataclass(frozen=True)
class Sla:
    pipeline_name: str
    metric_type: str
    threshold: str
    operator: str
    unit: str
    severity: str = "WARNING"
    active: bool = True

    def __post_init__(self):
        _one_of("SLA metric", self.metric_type, ("LATENCY", "QUALITY", "AVAILABILITY", "THROUGHPUT"))
        _one_of("SLA operator", self.operator, (">", "<", ">=", "<=", "="))


@dataclass(frozen=True)
class Retry:
    pipeline_name: str
    error_type: str
    max_retries: int = 3
    delay_seconds: int = 300
    backoff: bool = True
    multiplier: float = 2.0
    active: bool = True


@dataclass(frozen=True)
class Catalog:
    """Everything a run needs to know."""

    sources: Mapping[str, Source]
    rules: Mapping[str, Sequence[Rule]]

    def source(self, name: str) -> Source:
        found = self.sources.get(name)
        if found is None or not found.active:
            raise UnknownSource(f"source {name!r} is not configured or not active")
        return found

    def rules_for(self, entity: str) -> list[Rule]:
        return ordered_rules(self.rules.get(entity, ()))

    def column_mapping(self) -> list[tuple]:
        """The resolved mapping: one row per active source and column."""
        return [
            (s.source_id, s.name, s.ingestion, s.format.kind, position, c.name, c.rule, c.key, s.target.bronze,
             s.target.silver, s.target.gold, s.target.load_type)
            for s in self.sources.values() if s.active
            for position, c in enumerate(s.columns, start=1)
        ]

    @classmethod
    def from_rows(cls, rows: Sequence[Mapping], rules: Mapping[str, Sequence[Rule]] | None = None) -> Catalog:
        """Build from mapping rows (one per column), e.g. collected from configuration tables."""
        grouped: dict[str, list[Mapping]] = {}
        for row in rows:
            grouped.setdefault(row["source_name"], []).append(row)
        sources = {}
        for name, members in grouped.items():
            members = sorted(members, key=lambda r: r["column_position"])
            head = members[0]
            sources[name] = Source(
                head["source_id"], name, head["entity"], head["ingestion_type"],
                tuple(Column(r["column_name"], r.get("rule") or "raw", bool(r.get("is_primary_key"))) for r in members),
                Target(head["bronze_table"], head["load_error_table"], head["silver_table"], head["gold_table"],
                       head.get("load_type", "MERGE")),
                head.get("landing_path", ""), head.get("file_pattern"),
            )
        return cls(sources, rules or {})
