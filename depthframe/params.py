"""Validated parameter sets. They hold no data and run no Spark job."""

from __future__ import annotations

from dataclasses import dataclass, replace

GAP_MODES = ("skip", "forward_fill", "interpolate")


@dataclass(frozen=True)
class BookParams:
    """Time line, labelling and split settings of one run.

    ``assets`` is the configured asset list: ``build_line`` restricts the book to
    it, so tables with one row per asset have a proven size bound and may be
    broadcast.
    ``block_rows`` is the number of consecutive snapshots one window task sorts.
    """

    cadence_seconds: int
    window_seconds: int
    horizon_seconds: int
    boundaries: tuple[float, ...]
    max_gap_seconds: int
    gap_mode: str
    assets: tuple[str, ...] | None = None
    train_ratio: float = 0.70
    validation_ratio: float = 0.15
    test_ratio: float = 0.15
    block_rows: int = 65536

    def __post_init__(self) -> None:
        for name in ("cadence_seconds", "window_seconds", "horizon_seconds", "max_gap_seconds"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        if self.window_seconds % self.cadence_seconds:
            raise ValueError("window_seconds must be a multiple of cadence_seconds")
        if self.horizon_steps < 1:
            raise ValueError("horizon_seconds must be at least cadence_seconds")
        if not self.boundaries or list(self.boundaries) != sorted(self.boundaries):
            raise ValueError("boundaries must be a non-empty ascending sequence")
        if self.gap_mode not in GAP_MODES:
            raise ValueError(f"gap_mode must be one of {GAP_MODES}")
        if abs(self.train_ratio + self.validation_ratio + self.test_ratio - 1.0) > 1e-6:
            raise ValueError("split ratios must sum to 1")
        if self.block_rows < 1:
            raise ValueError("block_rows must be positive")

    @property
    def window_steps(self) -> int:
        return self.window_seconds // self.cadence_seconds

    @property
    def horizon_steps(self) -> int:
        return self.horizon_seconds // self.cadence_seconds

    @property
    def num_classes(self) -> int:
        """Classes of one intensity head."""
        return len(self.boundaries) + 1

    def with_(self, **changes) -> "BookParams":
        return replace(self, **changes)


@dataclass(frozen=True)
class ProfileParams:
    """Data-quality profile settings. The thresholds are fixed values of the reference set-up.

    The profile reads all training rows; ``num_samples`` asks for a sample of that
    many rows per asset, ``anomaly_limit`` for the first anomalies only.
    """

    sample_method: str = "uniform"
    num_samples: int | None = None
    seed: int = 42
    suspicious_pct: float = 1.0
    high_spread_pct: float = 5.0
    max_high_spread_fraction: float = 0.05
    negative_checks: bool = True
    zero_stats: bool = True
    outlier_checks: bool = True
    z_threshold: float = 3.0
    min_points: int = 10
    gap_checks: bool = True
    large_gap_multiplier: float = 2.0
    very_large_gap_multiplier: float = 6.0
    anomaly_limit: int | None = None
    histogram_bins: int = 50
    time_bins: int = 50
    spread_bins: int = 50
    price_bins: int = 50
    clip_sigma: float = 5.0
    label_examples: int = 3

    def __post_init__(self) -> None:
        if self.sample_method not in ("uniform", "random"):
            raise ValueError("sample_method must be 'uniform' or 'random'")
        for name in ("num_samples", "histogram_bins", "time_bins", "spread_bins", "price_bins"):
            if getattr(self, name) is not None and getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
