"""Frozen parameter sets. They are passed as arguments; there is no global instance."""

from __future__ import annotations

from dataclasses import dataclass, field


def _require(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)


# The defaults below are part of the observable behaviour.


@dataclass(frozen=True)
class KafkaConfig:
    bootstrap_servers: str = "localhost:9092"
    topic: str = "telemetry.raw"
    group_id: str = "telemetry-pipeline-v1"
    auto_offset_reset: str = "earliest"
    max_poll_records: int = 500
    session_timeout_ms: int = 30_000
    max_offsets_per_trigger: int | None = None


@dataclass(frozen=True)
class DedupConfig:
    ttl_seconds: int = 300

    def __post_init__(self):
        _require(self.ttl_seconds > 0, "ttl_seconds must be positive")

    @property
    def ttl_us(self) -> int:
        return self.ttl_seconds * 1_000_000


@dataclass(frozen=True)
class WindowConfig:
    window_seconds: int = 60
    min_samples: int = 3
    percentile: float = 95.0
    alignment: str = "epoch"  # or "series": anchored at the first record of each series
    percentile_method: str = "exact"  # or "sketch": near enough, see operators.windows.rank_error
    sketch_size: int = 200

    def __post_init__(self):
        _require(self.window_seconds > 0, "window_seconds must be positive")
        _require(0.0 <= self.percentile <= 100.0, "percentile must be within 0..100")
        _require(self.alignment in ("epoch", "series"), "alignment is 'epoch' or 'series'")
        _require(self.percentile_method in ("exact", "sketch"), "percentile_method is 'exact' or 'sketch'")
        _require(8 <= self.sketch_size <= 65_535, "sketch_size must be within 8..65535")

    @property
    def window_us(self) -> int:
        return self.window_seconds * 1_000_000


@dataclass(frozen=True)
class DetectConfig:
    z_threshold: float = 3.0
    baseline_rows: int = 20
    min_baseline_rows: int = 10
    record_critical_factor: float = 1.5
    baseline_windows: int = 30
    min_baseline_windows: int = 5
    window_critical_factor: float = 2.0
    min_sigma: float = 1e-9

    def __post_init__(self):
        _require(
            self.baseline_rows >= self.min_baseline_rows,
            "baseline_rows below min_baseline_rows could never raise an alert",
        )
        _require(
            self.baseline_windows >= self.min_baseline_windows,
            "baseline_windows below min_baseline_windows could never raise an alert",
        )


@dataclass(frozen=True)
class ClockConfig:
    """How a stream's clock follows event times; see ``streaming.triggers.Clock``."""

    delay_seconds: int = 0
    ahead_seconds: int = 86_400
    idle_seconds: int = 600

    def __post_init__(self):
        _require(self.ahead_seconds > 0, "ahead_seconds must be positive")


@dataclass(frozen=True)
class SkewConfig:
    """When a group is too large for one task.

    ``mode`` is "auto" (count the groups first, split the hot ones), "off" (the caller
    knows that no group is hot, so the counting scan is saved) or "on" (treat every
    group as hot; for tests).
    """

    mode: str = "auto"
    max_group_rows: int = 2_000_000
    max_dedup_group_rows: int = 2_000
    rows_per_slice: int = 2_000_000
    broadcast_rows: int = 200_000
    broadcast_bytes: int = 32_000_000

    def __post_init__(self):
        _require(self.mode in ("auto", "off", "on"), "mode is 'auto', 'off' or 'on'")


@dataclass(frozen=True)
class EngineConfig:
    kafka: KafkaConfig = field(default_factory=KafkaConfig)
    dedup: DedupConfig = field(default_factory=DedupConfig)
    windows: WindowConfig = field(default_factory=WindowConfig)
    detect: DetectConfig = field(default_factory=DetectConfig)
    skew: SkewConfig = field(default_factory=SkewConfig)
    clock: ClockConfig = field(default_factory=ClockConfig)
    flush_interval_seconds: float = 10.0
