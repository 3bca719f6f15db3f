"""Feature mapping: which columns of a table become which features of which entity type."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

MODES = ("check_types_only", "ingest")
# Columns of the tables that hold feature values.
RESERVED = frozenset({"entity_id", "feature_time", "feature_date", "tie_break"})


@dataclass(frozen=True)
class FeatureEntry:
    name: str
    column: str  # the feature name where the configuration gives none
    description: str | None = None
    labels: Mapping[str, str] = field(default_factory=dict)
    monitoring: str | None = None


@dataclass(frozen=True)
class EntityMapping:
    entity_type: str
    feature_time: str
    entity_id_field: str
    table: str
    features: tuple[FeatureEntry, ...]
    description: str | None = None
    labels: Mapping[str, str] = field(default_factory=dict)

    @property
    def source_fields(self) -> dict[str, str]:
        """Feature name -> column name."""
        return {f.name: f.column for f in self.features}


@dataclass(frozen=True)
class StoreConfig:
    store_id: str
    mode: str
    mappings: tuple[EntityMapping, ...]


class ConfigError(ValueError):
    pass


def parse_config(raw: Mapping[str, Any]) -> StoreConfig:
    """Read a configuration and check all of it before anything is created. Unknown keys are ignored."""
    problems: list[str] = []

    def need(section: Mapping[str, Any], key: str, where: str) -> Any:
        if section.get(key) in (None, "", []):
            problems.append(f"{where}: {key} is missing")
        return section.get(key)

    store = need(raw, "experimental_feature_store", "configuration") or {}
    store_id, mode = need(store, "id", "feature store"), need(store, "ingestion_mode", "feature store")
    if mode is not None and mode not in MODES:
        problems.append(f"feature store: ingestion_mode {mode!r} is not one of {', '.join(MODES)}")
    mappings = []
    for i, section in enumerate(need(raw, "feature_mapping", "configuration") or []):
        where = f"feature_mapping[{i}]"
        features = []
        for j, entry in enumerate(need(section, "features", where) or []):
            name = need(entry, "feature_name", f"{where}.features[{j}]")
            features.append(
                FeatureEntry(
                    name, entry.get("column_name") or name, entry.get("description"), entry.get("labels") or {}, entry.get("monitoring")
                )
            )
        names = [f.name for f in features]
        problems += [f"{where}: feature {n} is listed twice" for n in sorted({n for n in names if names.count(n) > 1})]
        mappings.append(
            EntityMapping(
                entity_type=need(section, "entity_type_id", where),
                feature_time=need(section, "feature_time", where),
                entity_id_field=need(section, "entity_id_field", where),
                table=need(section, "output_full_table_id", where),
                features=tuple(features),
                description=section.get("description"),
                labels=section.get("labels") or {},
            )
        )
    listed = [(m.entity_type, f.name.lower()) for m in mappings for f in m.features if f.name]
    for i, m in enumerate(mappings):
        own = [(m.entity_type, f.name.lower()) for f in m.features if f.name]
        elsewhere = sorted({name for kind, name in own if listed.count((kind, name)) > own.count((kind, name))})
        problems += [f"feature_mapping[{i}]: feature {n} of {m.entity_type} is also mapped from another table" for n in elsewhere]
        problems += [f"feature_mapping[{i}]: feature name {n} is reserved" for _, n in own if n in RESERVED]
    if problems:
        raise ConfigError("; ".join(problems))
    return StoreConfig(store_id, mode, tuple(mappings))


def load_config(text: str) -> StoreConfig:
    """Parse YAML text. Needs PyYAML; without it, pass a dictionary to :func:`parse_config`."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML needs the PyYAML package") from missing
    return parse_config(yaml.safe_load(text))
