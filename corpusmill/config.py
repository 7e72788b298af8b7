"""Feature and model settings, and their JSON form."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class FeatureConfig:
    """Settings of the feature build; defaults are the published ones."""

    random_state: int = 42
    test_size: float = 0.20
    include_subject: bool = False
    drop_date: bool = True
    fill_missing_with_empty: bool = True
    drop_exact_duplicates: bool = True
    lowercase: bool = True
    remove_urls_emails: bool = True
    normalize_whitespace: bool = True
    ngram_min: int = 1
    ngram_max: int = 2
    max_features: int = 20000
    min_df: int = 2
    max_df: float = 0.95
    stop_words: str | None = "english"
    sublinear_tf: bool = True
    strip_accents: str | None = "unicode"
    produce_scaled: bool = True
    scaler_with_mean: bool = False

    def __post_init__(self):
        if not 1 <= self.ngram_min <= self.ngram_max:
            raise ValueError("need 1 <= ngram_min <= ngram_max")
        if self.scaler_with_mean:
            raise ValueError("centring would make the sparse features dense")
        if self.max_features < 1:
            raise ValueError("max_features must be positive")


@dataclass(frozen=True)
class LinearConfig:
    """Gradient-descent settings, search space and hold-out."""

    learning_rate: float = 0.05
    n_iterations: int = 1500
    regularization: float = 0.001
    random_seed: int = 42
    validation_split: float = 0.2
    search_space: dict = field(default_factory=lambda: {
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "n_iterations": [500, 1000, 1500, 2000],
        "regularization": [0.001, 0.01, 0.1, 1.0],
    })


# The published configurations of the comparison, in their order.
SVM_CONFIGS = (
    {"name": "Linear_C1", "kernel": "linear", "c": 1.0},
    {"name": "Linear_C10", "kernel": "linear", "c": 10.0},
    {"name": "Linear_C0.1", "kernel": "linear", "c": 0.1},
    {"name": "RBF_scale", "kernel": "rbf", "c": 1.0, "gamma": "scale"},
    {"name": "RBF_0.1", "kernel": "rbf", "c": 1.0, "gamma": 0.1},
    {"name": "RBF_10", "kernel": "rbf", "c": 1.0, "gamma": 10.0},
    {"name": "Poly_deg3", "kernel": "poly", "c": 1.0, "gamma": "scale", "degree": 3},
    {"name": "Poly_deg4", "kernel": "poly", "c": 1.0, "gamma": "scale", "degree": 4},
    {"name": "Sigmoid", "kernel": "sigmoid", "c": 1.0, "gamma": "scale"},
    {"name": "Linear_balanced", "kernel": "linear", "c": 1.0, "balanced": True},
)

# The published search space of the boosted trees. Spark's trees have no leaf penalties; the search adds them.
TREE_SPACE = {"n_estimators": [90], "max_depth": [3, 5, 7], "learning_rate": [0.1], "subsample": [0.6], "gamma": [0.1, 1, 2], "reg_lambda": [0.1, 1, 2]}


def feature_config_from_json(text: str) -> FeatureConfig:
    return FeatureConfig(**json.loads(text))


def feature_config_to_json(config: FeatureConfig) -> str:
    return json.dumps(asdict(config), indent=2)


def load_linear_config(path: str | None) -> LinearConfig:
    """Read the model JSON; defaults stand in for a missing file or key."""
    if path is None or not Path(path).exists():
        return LinearConfig()
    return linear_config_from_json(Path(path).read_text(encoding="utf-8"))


def linear_config_from_json(text: str) -> LinearConfig:
    raw = json.loads(text)
    known = {f.name for f in fields(LinearConfig)}
    flat = {**raw.get("hyperparameters", {}), **raw.get("training", {})}
    kwargs = {k: v for k, v in flat.items() if k in known}
    if "hyperparameter_search_space" in raw:
        kwargs["search_space"] = raw["hyperparameter_search_space"]
    return LinearConfig(**kwargs)
