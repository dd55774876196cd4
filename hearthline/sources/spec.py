"""Table specifications: which columns of a raw table mean what."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from types import MappingProxyType
from typing import Any

from ..operators.cleaning import UNKNOWN_CODES

# Keys a table read in entry and exit stages must declare.
STAGE_KEYS = (
    "collection_stage_column",
    "entry_stage_val",
    "exit_stage_val",
    "update_stage_val",
    "annual_assessment_stage_val",
    "post_exit_stage_val",
    "person_enrollment_ID",
)


@dataclass(frozen=True)
class TableSpec:
    """One raw table. ``roles`` holds the keys that only some tables have.

    ``types`` gives Spark types for columns; with None the types are inferred from the data,
    which costs one more pass over the files.
    """

    name: str = ""
    duplicate_check_columns: tuple[str, ...] | None = None
    columns_to_drop: tuple[str, ...] = ()
    categorical_var: tuple[str, ...] = ()
    categorical_unknown: tuple[float, ...] = UNKNOWN_CODES
    time_var: tuple[str, ...] = ()
    name_columns: tuple[str, ...] = ()
    encoding: str | None = None
    dedup: bool = True
    types: Mapping[str, str] | None = None
    roles: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, given: Mapping[str, Any]) -> TableSpec:
        known = {f.name for f in fields(cls)} - {"roles"}
        own = {
            k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in known
        }
        roles = {
            k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k not in known
        }
        return cls(**own, roles=MappingProxyType(roles))

    @classmethod
    def from_json(cls, path: str) -> TableSpec:
        with open(path, encoding="utf-8") as handle:
            return cls.from_dict(json.load(handle))

    @classmethod
    def of(cls, given: TableSpec | Mapping[str, Any] | str) -> TableSpec:
        """A specification from a path to JSON, a mapping or a specification."""
        if isinstance(given, TableSpec):
            return given
        return cls.from_dict(given) if isinstance(given, Mapping) else cls.from_json(given)

    def role(self, key: str) -> Any:
        """A declared role; a missing one is a ValueError."""
        if key not in self.roles:
            raise ValueError(f"{key} entry must be present in the table specification")
        return self.roles[key]

    def require(self, *keys: str) -> None:
        for key in keys:
            self.role(key)

    def with_dedup_columns(self, columns: tuple[str, ...]) -> TableSpec:
        return replace(self, duplicate_check_columns=columns)


def code_map(given: Mapping[Any, str] | str) -> dict[int, str]:
    """Numeric code to name, from a mapping or a JSON file; a ``name`` entry is ignored."""
    if isinstance(given, str):
        with open(given, encoding="utf-8") as handle:
            given = json.load(handle)
    return {int(k): v for k, v in given.items() if k != "name"}
