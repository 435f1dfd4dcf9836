"""Capability areas, weights, detector map and thresholds.

Every number is a default: each operator takes a ``Settings`` and a caller can
``dataclasses.replace`` any of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Capability areas with their weight in the attention index.
CAPABILITY_WEIGHTS = {
    "Threat Detection": 1.5,
    "Investigation": 1.2,
    "Escalation": 1.0,
    "Incident Response": 1.5,
    "Security Operations": 1.0,
    "Governance and Oversight": 0.8,
    "Operational Discipline": 1.0,
    "Cyber Resilience": 1.2,
}

# Capabilities a detector speaks to; any other detector counts
# towards DEFAULT_CAPABILITIES.
DETECTOR_CAPABILITIES = {
    "EG-01": ["Investigation", "Operational Discipline"],
    "NS-01": ["Threat Detection", "Security Operations"],
}
DEFAULT_CAPABILITIES = ["Security Operations"]

# Fixed value: entity id carried by findings about an analyst or a rule.
GLOBAL_ENTITY = "GLOBAL"


@dataclass(frozen=True)
class Settings:
    """Thresholds of the detectors and of the scoring, with their defaults."""

    weights: dict = field(default_factory=lambda: dict(CAPABILITY_WEIGHTS))
    detector_capabilities: dict = field(default_factory=lambda: dict(DETECTOR_CAPABILITIES))
    default_capabilities: tuple = tuple(DEFAULT_CAPABILITIES)

    # finding score
    severity_scale: float = 5.0
    default_severity: int = 3
    default_effect: float = 0.8
    default_confidence: float = 0.9
    score_ceiling: float = 0.99

    # execution gaps
    high_severity: int = 4
    fast_close_seconds: float = 60.0
    case_min_severity: int = 3
    case_fast_seconds: float = 60.0
    template_min_notes: int = 10
    template_share: float = 0.8
    idle_rule_min_cases: int = 5
    bulk_min_closures: int = 10
    bulk_window_seconds: int = 60

    # negative space
    critical_label: str = "Critical"
    common_category_share: float = 0.8
    low_activity_ratio: float = 0.2
    volume_z: float = -1.25

    # exploratory
    forest_trees: int = 100
    forest_sample: int = 256
    forest_contamination: float = 0.1
    forest_seed: int = 42
    path_min_cases: int = 5
    steady_min_cases: int = 5
    steady_max_std: float = 2.0
    drift_min_alerts: int = 20
    drift_min_first_half: int = 10
    drift_ratio: float = 0.2
    grid_share: float = 0.05
    grid_min_alerts: int = 50
    root_cause_min_cases: int = 5
    flatline_days: int = 7
    flatline_recent: float = 0.5
    flatline_prior: float = 2.0
    regular_min_alerts: int = 20

    # peers
    mad_scale: float = 1.4826
    shrink_k: int = 3
    outlier_z: float = 2.0

    # review sample
    explore_share: float = 0.2


DEFAULTS = Settings()
