"""Configuration as data: fields, labels, patterns, weights, phrases. Every operator takes a Config; DEFAULT is the file beside the package."""

from __future__ import annotations

import json
import os
import pkgutil
from dataclasses import dataclass, field
from functools import cached_property

HERE = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "config", "default.json")


@dataclass(frozen=True)
class Config:
    """Tables of one configuration file. Names are those of the file."""

    fields: dict[str, dict]
    extra_labels: dict[str, list[str]]
    patterns: dict[str, list[str]]
    critical: list[str]
    weights: dict[str, float]
    section_keywords: dict[str, list[str]]
    thresholds: dict[str, float]
    line_phrases: dict[str, dict[str, int]]
    party_detail: list[str] = field(default_factory=list)
    service_detail: list[str] = field(default_factory=list)
    value_detail: list[str] = field(default_factory=list)
    review_thresholds: dict[str, float] = field(default_factory=dict)
    review_default: float = 0.70
    states: list[str] = field(default_factory=list)
    media_types: dict[str, str] = field(default_factory=dict)

    @cached_property
    def money_fields(self) -> list[str]:
        return [f for f, d in self.fields.items() if d["type"] == "decimal"]

    @cached_property
    def singletons(self) -> list[str]:
        """Fields of which a document has one value."""
        return ["issue_date", "nfse_number", "verification_code", *self.money_fields, "iss_rate"]

    @cached_property
    def known_labels(self) -> dict[str, list[str]]:
        """Every label of a field: its own, then the extra ones, once each."""
        return {f: list(dict.fromkeys([*d["labels"], *self.extra_labels.get(f, [])])) for f, d in self.fields.items()}


def load(path: str | None = None) -> Config:
    """A configuration file in JSON or (where a parser is there) YAML, else the package's own; unknown keys are an error, so that slips do not pass."""
    if path is None:  # also within an archive
        raw = json.loads(pkgutil.get_data(__package__.rpartition(".")[0], "config/default.json"))
        raw.pop("note", None)
        return Config(**raw)
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            import yaml

            raw = yaml.safe_load(f) or {}
        else:
            raw = json.load(f)
    raw.pop("note", None)
    return Config(**raw)


DEFAULT = load()
FIELDS = {f: (d["category"], d["type"], d["required"]) for f, d in DEFAULT.fields.items()}
CRITICAL = DEFAULT.critical
ALIASES = DEFAULT.extra_labels
PATTERNS = DEFAULT.patterns
SECTION_KEYWORDS = DEFAULT.section_keywords
WEIGHTS = DEFAULT.weights
MINIMUM_CONFIDENCE, AMBIGUITY = DEFAULT.thresholds["minimum_field_confidence"], 0.10
PHRASES = DEFAULT.line_phrases
PARTY_DETAIL, SERVICE_DETAIL, VALUE_DETAIL = DEFAULT.party_detail, DEFAULT.service_detail, DEFAULT.value_detail
MONEY_FIELDS, SINGLETONS = DEFAULT.money_fields, DEFAULT.singletons
REVIEW_THRESHOLDS, REVIEW_DEFAULT = DEFAULT.review_thresholds, DEFAULT.review_default
UFS, MEDIA_TYPES = DEFAULT.states, DEFAULT.media_types
