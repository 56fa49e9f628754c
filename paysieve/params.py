"""All tunable values of the cleansing and scoring operators."""

from __future__ import annotations

from dataclasses import dataclass

HIGH_AMOUNT, SHARED_IP, VELOCITY, FANOUT, ODD_HOUR = "high_amount", "shared_ip", "velocity", "fanout", "odd_hour"
LOW, MEDIUM, HIGH = "LOW", "MEDIUM", "HIGH"


@dataclass(frozen=True)
class Params:
    # fixed values: what counts as valid, and the scoring rules
    statuses: tuple[str, ...] = ("SUCCESS", "FAILED", "PENDING", "REVERSED")
    currencies: tuple[str, ...] = ("INR",)
    max_amount: float = 500_000.0
    watermark: str = "2 hours"
    fence_k: float = 3.0
    fence_floor: float = 50_000.0
    ip_payers: int = 5
    velocity_seconds: int = 5 * 60
    velocity_most: int = 10
    fanout_seconds: int = 60 * 60
    fanout_most: int = 15
    odd_from: int = 0
    odd_to: int = 5
    weights: tuple[tuple[str, int], ...] = ((HIGH_AMOUNT, 30), (SHARED_IP, 25), (VELOCITY, 25), (FANOUT, 25), (ODD_HOUR, 10))
    high_from: int = 50
    medium_from: int = 25
    tz: str = "Asia/Kolkata"
    score_bucket: int = 5
    top_combinations: int = 10
    #: null statuses and currencies pass, unless this is set
    strict_enums: bool = False
    #: null keys have no features ("zero"), or are one group ("group")
    null_keys: str = "zero"
    #: percentiles of the fence: exact by counted amounts, or approximate in one pass, to one part in ``fence_accuracy``
    exact_fence: bool = False
    fence_accuracy: int = 10_000
