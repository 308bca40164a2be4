"""Job settings. Everything the jobs need is passed in; nothing is read from files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Contract type names and the Spark types they stand for.
CONTRACT_TYPES = {
    "integer": T.LongType(),
    "string": T.StringType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    nullable: bool = True

    def __post_init__(self):
        if self.type not in CONTRACT_TYPES:
            raise ValueError(f"unknown contract type {self.type!r} of column {self.name!r}")


@dataclass(frozen=True)
class Contract:
    """A versioned column contract. Columns are nullable unless they say otherwise."""

    version: str
    columns: tuple[ContractColumn, ...]

    @classmethod
    def from_dict(cls, spec: dict) -> Contract:
        return cls(spec["version"], tuple(ContractColumn(**c) for c in spec["columns"]))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def critical(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, CONTRACT_TYPES[c.type], c.nullable) for c in self.columns])


@dataclass(frozen=True)
class QualityLimits:
    """Strict limits: a value must exceed them to be flagged."""

    row_count_change_pct: float = 30.0
    null_pct: float = 5.0
    critical_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class DriftLimits:
    """Inclusive limits in percent."""

    warn_at: float = 10.0
    critical_at: float = 30.0


@dataclass(frozen=True)
class DatasetConfig:
    dataset: str
    contract: Contract
    dedup_keys: tuple[str, ...]
    gold_keys: tuple[str, ...]
    gold_columns: tuple[str, ...]
    gold_partition: str
    numeric_columns: tuple[str, ...]
    categorical_columns: tuple[str, ...]
    quality: QualityLimits = field(default_factory=QualityLimits)
    numeric_drift: DriftLimits = field(default_factory=DriftLimits)
    cardinality_drift: DriftLimits = field(default_factory=DriftLimits)
    baseline_window: int = 7
    raw_format: str = "csv"
    layer_format: str = "parquet"
    mergeable_profiles: bool = False   # bucket counts and distinct sketches in profiles, for windows of rows
    raw_multi_line: bool = False   # quoted line breaks in raw CSV; files are then read twice


# The player-statistics data set the pipeline runs on by default.
PLAYER_STATS = DatasetConfig(
    dataset="player_stats",
    contract=Contract("v1", tuple(
        ContractColumn(name, kind, nullable=False) for name, kind in [
            ("player_id", "integer"),
            ("player_name", "string"),
            ("team", "string"),
            ("season", "string"),
            ("points", "integer"),
            ("assists", "integer"),
            ("rebounds", "integer"),
            ("snapshot_time_date", "date"),
        ])),
    dedup_keys=("player_id", "season", "team", "snapshot_time_date"),
    gold_keys=("player_id", "season", "snapshot_time_date"),
    gold_columns=("player_id", "player_name", "team", "season", "points", "assists", "rebounds",
                  "snapshot_time_date", "ingested_at", "schema_version"),
    gold_partition="snapshot_time_date",
    numeric_columns=("points", "assists", "rebounds"),
    categorical_columns=("team", "season"),
    quality=QualityLimits(30.0, 5.0, ("player_id", "points", "season")),
)
