"""Strict run configuration from YAML or a mapping: unknown keys, bad ids and reversed dates are errors."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field, fields
from datetime import date
from hashlib import sha256
from typing import Any

ID = re.compile(r"[0-9][0-9]{4}[A-Z]{1,3}[0-9A-Z/()_.\-]{2,}")


class ConfigError(ValueError):
    pass


def _take(cls, data: Any, where: str):
    if not isinstance(data, dict):
        raise ConfigError(f"{where}: a mapping is needed")
    names = {f.name for f in fields(cls)}
    if unknown := set(data) - names:
        raise ConfigError(f"{where}: unknown keys {sorted(unknown)}")
    return cls(**data)


@dataclass(frozen=True)
class Metadata:
    project_name: str = "dataset"
    author: str | None = None
    description: str | None = None


@dataclass(frozen=True)
class Fixed:
    mode: str = "fixed"
    celex_ids: list[str] = field(default_factory=list)
    procedure_numbers: list[str] = field(default_factory=list)

    def __post_init__(self):
        ids = [str(x).strip().upper() for x in self.celex_ids]
        if bad := [x for x in ids if not ID.fullmatch(x)]:
            raise ConfigError(f"malformed ids: {bad}")
        object.__setattr__(self, "celex_ids", ids)
        if not ids and not self.procedure_numbers:
            raise ConfigError("fixed mode needs an id or a procedure number")


@dataclass(frozen=True)
class Descriptive:
    mode: str = "descriptive"
    document_types: list[str] = field(default_factory=list)
    start_date: date | str = ""
    end_date: date | str = ""
    keywords: list[str] = field(default_factory=list)
    include_corrigenda: bool = False
    include_consolidated: bool = False

    def __post_init__(self):
        for n in ("start_date", "end_date"):
            v = getattr(self, n)
            try:
                object.__setattr__(self, n, v if isinstance(v, date) else date.fromisoformat(str(v)))
            except ValueError as e:
                raise ConfigError(f"{n}: {v!r} is no date") from e
        if not self.document_types:
            raise ConfigError("descriptive mode needs a document type")
        if not self.start_date < self.end_date:
            raise ConfigError("start_date must be before end_date")


@dataclass(frozen=True)
class Processing:
    include_recitals: bool = True
    include_articles: bool = True
    include_annexes: bool = True
    strip_boilerplate: bool = True
    store_raw_html: bool = False
    text_unit_granularity: str = "article"
    parallel: bool = False
    workers: int = 4
    limit: int | None = None
    translate: bool = False
    max_full_text_chars: int = 100_000

    def __post_init__(self):
        if self.text_unit_granularity not in ("article", "paragraph", "point"):
            raise ConfigError("text_unit_granularity must be article, paragraph or point")
        if not 1 <= self.workers <= 16:
            raise ConfigError("workers must be from 1 to 16")
        if self.limit is not None and self.limit < 0 or self.max_full_text_chars < 0:
            raise ConfigError("limits must not be negative")


@dataclass(frozen=True)
class Output:
    output_directory: str = "output"
    formats: list[str] = field(default_factory=lambda: ["parquet"])

    def __post_init__(self):
        if not self.formats or set(self.formats) - {"parquet", "csv"}:
            raise ConfigError("formats must be parquet or csv")


@dataclass(frozen=True)
class Config:
    data: Fixed | Descriptive
    metadata: Metadata = Metadata()
    processing: Processing = Processing()
    output: Output = field(default_factory=Output)

    @staticmethod
    def of(raw: dict) -> "Config":
        if not isinstance(raw, dict) or "data" not in raw:
            raise ConfigError("data is missing")
        if unknown := set(raw) - {"data", "metadata", "processing", "output"}:
            raise ConfigError(f"unknown keys {sorted(unknown)}")
        mode = raw["data"].get("mode") if isinstance(raw["data"], dict) else None
        kinds = {"fixed": Fixed, "descriptive": Descriptive}
        if mode not in kinds:
            raise ConfigError(f"mode must be one of {sorted(kinds)}")
        return Config(_take(kinds[mode], raw["data"], "data"), _take(Metadata, raw.get("metadata") or {}, "metadata"), _take(Processing, raw.get("processing") or {}, "processing"), _take(Output, raw.get("output") or {}, "output"))

    def canonical(self) -> str:
        """Sorted keys, no blanks: the same for equal configurations."""
        return json.dumps(asdict(self), sort_keys=True, separators=(",", ":"), default=str)

    def digest(self) -> str:
        return sha256(self.canonical().encode()).hexdigest()


def load_config(path: str) -> Config:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        raw = json.loads(text)
    except ValueError:
        import yaml

        raw = yaml.safe_load(text)
    return Config.of(raw)
