"""Settings of the model pipeline: defaults, values from the environment, checks, and their JSON."""

from __future__ import annotations

import dataclasses
import json
import os
from collections.abc import Mapping


@dataclasses.dataclass(frozen=True)
class ModelConfig:
    train_share: float = 0.8
    train_months: int = 18
    test_months: int = 6
    lookback_days: int = 60
    least_rows: int = 1000
    outlier_method: str = "iqr"
    balance_cap: float = 1.2
    trees: int = 200
    depth: int = 15
    step: float = 0.05
    seed: int = 42
    ensemble_size: int = 3
    models: tuple[str, ...] = ("forest", "boosted", "linear")

    @classmethod
    def load(cls, environment: Mapping[str, str] | None = None, prefix: str = "HEARTH_", **given) -> ModelConfig:
        """Defaults, then ``HEARTH_TRAIN_SHARE`` and the like, then what is given."""
        found = os.environ if environment is None else environment
        values = {}
        for field in dataclasses.fields(cls):
            text = found.get(prefix + field.name.upper())
            if text is not None:
                kind = type(field.default)
                values[field.name] = tuple(x.strip() for x in text.split(",") if x.strip()) if kind is tuple else kind(text)
        return cls(**values | given).checked()

    def checked(self) -> ModelConfig:
        faults = [
            text
            for bad, text in (
                (not 0 < self.train_share < 1, "train_share must be between 0 and 1"),
                (min(self.train_months, self.test_months, self.lookback_days, self.least_rows, self.trees, self.depth, self.ensemble_size) < 1, "counts must be positive"),
                (self.outlier_method not in ("iqr", "zscore", "none"), "unknown outlier_method"),
                (self.balance_cap < 1, "balance_cap must be at least 1"),
                (not 0 < self.step <= 1, "step must be above 0 and at most 1"),
                (not self.models, "no model is named"),
            )
            if bad
        ]
        if faults:
            raise ValueError("; ".join(faults))
        return self

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> ModelConfig:
        values = json.loads(text)
        return cls(**values | {"models": tuple(values["models"])}).checked()
