"""What to run, as a dataclass with a JSON round trip."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields

STAGES = ["cleaning", "type", "missing", "encoding", "feature", "validation"]


@dataclass
class PrepConfig:
    target: str | None = None
    keys: list[str] = field(default_factory=list)
    stages: list[str] = field(default_factory=lambda: list(STAGES))
    safe_mode: bool = False
    # cleaning
    drop_columns: list[str] = field(default_factory=list)
    name_style: str = "trim"
    trim_text: bool = True
    lowercase_text: bool = False
    null_tokens: bool = True
    drop_duplicates: bool = True
    null_threshold: float = 0.60
    drop_constant: bool = True
    drop_ids: bool = False
    # types
    coerce_ratio: float = 0.80
    cast_types: dict[str, str] = field(default_factory=dict)
    datetime_with_time: bool = False
    # missing values
    impute_rule: str = "skew"
    impute_columns: dict[str, str] = field(default_factory=dict)
    # encoding
    encode_columns: dict[str, str] = field(default_factory=dict)
    # features
    feature_rules: list[dict] = field(default_factory=list)
    log_skewed: bool = False
    scaling: str | None = None
    interactions: bool = False
    row_stats: bool = False
    # analysis
    outlier_method: str = "auto"
    outlier_strategy: str = "clip"
    variance_threshold: float = 0.01
    corr_threshold: float = 0.90
    top_k: int = 0
    test_size: float = 0.2
    val_size: float = 0.0
    # models
    models: list[str] | None = None
    max_models: int = 8
    time_limit: float = 300.0
    cv_folds: int = 0

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=2, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "PrepConfig":
        known = {f.name for f in fields(PrepConfig)}
        return PrepConfig(**{k: v for k, v in json.loads(text).items() if k in known})

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            f.write(self.to_json())

    @staticmethod
    def load(path: str) -> "PrepConfig":
        with open(path, encoding="utf-8") as f:
            return PrepConfig.from_json(f.read())

    def problems(self) -> list[str]:
        """Settings that cannot work; empty when the config is valid."""
        out = [f"unknown stage {s!r}" for s in self.stages if s not in STAGES]
        for name in ("null_threshold", "coerce_ratio", "corr_threshold"):
            if not 0.0 <= getattr(self, name) <= 1.0:
                out.append(f"{name} must lie in [0, 1]")
        if not 0.0 < self.test_size < 1.0 or self.val_size < 0 or self.test_size + self.val_size >= 1.0:
            out.append("test_size and val_size must leave rows for the train part")
        if self.impute_rule not in ("skew", "family", "table"):
            out.append(f"unknown impute_rule {self.impute_rule!r}")
        if self.name_style not in ("trim", "snake", "ml", "dedup"):
            out.append(f"unknown name_style {self.name_style!r}")
        if self.scaling not in (None, "minmax", "standard", "robust", "auto"):
            out.append(f"unknown scaling {self.scaling!r}")
        if self.outlier_method not in ("auto", "iqr", "zscore", "both"):
            out.append(f"unknown outlier_method {self.outlier_method!r}")
        if self.max_models < 1 or self.time_limit <= 0:
            out.append("max_models and time_limit must be positive")
        return out


def starter_config(columns: list[str], target: str | None = None) -> PrepConfig:
    """A config that names every column, ready to edit."""
    return PrepConfig(
        target=target,
        impute_columns={c: "auto" for c in columns if c != target},
        encode_columns={c: "auto" for c in columns if c != target},
    )
