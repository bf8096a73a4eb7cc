"""Default settings, in one frozen place."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    key: str = "tx_id"
    target: str = "Class"
    seed: int = 42

    # preparation
    test_size: float = 0.2
    stratify: bool = True
    scaling_columns: tuple[str, ...] = ("Time", "Amount")
    capping_columns: tuple[str, ...] = ("Amount",)
    cap_quantile: float = 0.999

    # oversampling
    neighbors: int = 5
    neighbor_method: str = "exact"  # or "approximate", near linear in the minority rows

    # training
    folds: int = 5
    search_iterations: int = 10
    lr_max_iter: int = 1000
    lr_c: float = 1.0
    forest_trees: int = 100
    forest_depth: int = 10

    # thresholds and cost
    avg_fraud_amount: float = 122.21
    investigation_cost: float = 15.0
    fraud_recovery_rate: float = 0.25

    # drift
    ks_alpha: float = 0.05
    psi_threshold: float = 0.1
    psi_bins: int = 10

    # explanation
    shap_permutations: int = 100


DEFAULTS = Settings()


@dataclass(frozen=True)
class SearchSpace:
    """Fixed value lists of the two randomised searches."""

    forest: dict = field(
        default_factory=lambda: {
            "n_estimators": [50, 100, 200],
            "max_depth": [5, 10, 15, None],
            "min_samples_split": [2, 5, 10],
            "min_samples_leaf": [1, 2, 4],
            "max_features": ["sqrt", "log2", None],
        }
    )
    boosted: dict = field(
        default_factory=lambda: {
            "n_estimators": [100, 200, 300, 500],
            "max_depth": [3, 5, 6, 8, 10],
            "learning_rate": [0.01, 0.05, 0.1, 0.2],
            "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
            "colsample_bytree": [0.6, 0.7, 0.8, 0.9, 1.0],
            "min_child_weight": [1, 3, 5, 7],
            "gamma": [0, 0.1, 0.2, 0.5],
        }
    )
