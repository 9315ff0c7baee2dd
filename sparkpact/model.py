"""One contract as a small driver-side value, to be baked into expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Row

from sparkpact.functions.types import CONTRACT_TYPES


@dataclass(frozen=True)
class Column:
    name: str
    data_type: str
    nullable: bool = True
    description: str = ""

    def __post_init__(self) -> None:
        if not self.name.strip():
            raise ValueError("a column needs a name")
        if self.data_type not in CONTRACT_TYPES:
            raise ValueError(f"column {self.name}: unknown data_type {self.data_type!r}")


# What a contract says when it says nothing.
@dataclass(frozen=True)
class Metadata:
    data_owner: str = "Data Team"
    data_owner_email: str = "data-team@company.com"
    data_steward: str = "Data Engineering"
    data_steward_email: str = "data-engineering@company.com"
    sla_uptime_percentage: float = 99.95
    sla_max_latency_ms: int = 5000


DEFAULT_VERSION = "1.0.0"


@dataclass(frozen=True)
class Contract:
    contract_id: str
    name: str
    columns: tuple[Column, ...]
    description: str = ""
    version: str = DEFAULT_VERSION
    metadata: Metadata = field(default_factory=Metadata)

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if not names:
            raise ValueError("a contract needs at least one column")
        if len(set(names)) != len(names):
            raise ValueError(f"contract {self.contract_id}: a column name is repeated")

    @classmethod
    def from_row(cls, row: Row) -> "Contract":
        """From the ``contract`` struct of one built document."""
        doc = row.asDict(recursive=True)
        return cls(
            contract_id=doc["contract_id"],
            name=doc["name"],
            description=doc["description"],
            version=doc["version"],
            columns=tuple(Column(**c) for c in doc["columns"]),
            metadata=Metadata(**doc["metadata"]),
        )
