"""Rule thresholds, size limits and table locations."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LookupLimits:
    """When a set of flagged keys may be broadcast, and what happens beyond that.

    A set is broadcast only after it has been counted and found to be within
    ``max_rows`` and ``max_bytes``. A larger set is joined by shuffle; then hashes of
    its biggest groups, at most ``max_rows`` of them, are broadcast to mark the rows
    that are spread over cells, a quarter of ``heavy_rows`` in each.
    """

    max_rows: int = 200_000
    max_bytes: int = 32 * 1024 * 1024
    heavy_rows: int = 1_000_000


@dataclass(frozen=True)
class FraudRules:
    """Thresholds and durations of the fraud rules. All thresholds are strict."""

    # The published rule settings.
    flood_clicks: int = 50
    bot_campaigns: int = 20
    instant_ms: int = 200
    click_window: str = "10 minutes"
    alert_window: str = "1 minute"
    tolerance: str = "30 minutes"
    watermark: str = "10 minutes"

    # How many cells one key is spread over in a streaming join.
    stream_salts: int = 16
    orphan_salts: int = 4
    limits: LookupLimits = field(default_factory=LookupLimits)


@dataclass(frozen=True)
class TablePaths:
    """Locations of the layered tables and of the checkpoints below one root."""

    root: str

    def bronze(self, topic: str) -> str:
        return f"{self.root}/bronze/{topic}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str = "fraud_alerts") -> str:
        return f"{self.root}/gold/{table}"

    def checkpoint(self, layer: str, table: str) -> str:
        return f"{self.root}/checkpoints/{layer}/{table}"
