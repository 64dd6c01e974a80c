"""Windows, gates and names used by every job.

All times are explicit: jobs take an ``as_of`` instant instead of reading the
wall clock, so a run can be repeated or backfilled.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)

# Severities that make an event an error, and the signal names.
ERROR_SEVERITIES = ("ERROR", "CRITICAL")
SIG_ERROR_RATE = "backend_http_error_rate"
SIG_LATENCY = "route_latency_p95"
SIG_SIGNATURE = "error_signature_spike"
SIG_FRESHNESS = "forwarder_freshness_drop"
SIG_DROPS = "forwarder_drop_failure"
SIG_DEPLOY = "post_deployment_regression"
KEY_FRESHNESS = "forwarder_freshness"
KEY_DROPS = "forwarder_drops"


@dataclass(frozen=True)
class ObsConfig:
    # time-binned roll-ups
    bin_seconds: int = 300
    history: timedelta = timedelta(days=2)
    holdback: timedelta = timedelta(minutes=15)
    # span recomputed as a whole when new rows touch it
    refresh_seconds: int = 3600
    # z-score detectors
    z_threshold: float = 1.5
    deploy_z_threshold: float | None = None
    min_requests_error_rate: int = 20
    min_requests_latency: int = 10
    min_errors_signature: int = 3
    min_requests_deploy: int = 20
    min_requests_trend: int = 5
    latest_sha_only: bool = False
    drop_partial_bin: bool = False
    # with replay=True rows after as_of are ignored; live jobs have no upper bound
    replay: bool = False
    # latency percentile
    percentile: float = 0.95
    # service names
    forwarder_service: str = "log-forwarder"
    frontend_service: str = "web-frontend"
    # forecast detector
    ml_holdback: timedelta = timedelta(minutes=30)
    ml_keep: timedelta = timedelta(minutes=15)
    ml_min_history: timedelta = timedelta(days=2)
    ml_phase_seconds: int = 3600
    ml_interval: float = 0.99
    # dashboard and evidence windows
    tile_window: timedelta = timedelta(minutes=60)
    tile_rate_window: timedelta = timedelta(hours=2)
    tile_deploy_window: timedelta = timedelta(hours=24)
    tile_sha_window: timedelta = timedelta(hours=4)
    tile_min_requests: int = 10
    evidence_window: timedelta = timedelta(minutes=30)
    # supplementary alerts
    alert_error_rate: float = 0.05
    alert_p95_ms: float = 5000.0
    # incident policy
    incident_min_score: float = 3.0
    incident_types: tuple[str, ...] = field(
        default=(SIG_ERROR_RATE, SIG_SIGNATURE, SIG_DEPLOY)
    )
    remediation_enabled: bool = True

    def __post_init__(self) -> None:
        if 86400 % self.bin_seconds:
            raise ValueError("bin_seconds must divide a day")
        if 86400 % self.refresh_span:
            raise ValueError("refresh_seconds must divide a day and hold whole bins")

    def with_(self, **changes) -> "ObsConfig":
        return replace(self, **changes)

    @property
    def refresh_span(self) -> int:
        """Seconds per refresh span: at least one bin."""
        return max(self.refresh_seconds, self.bin_seconds)

    @property
    def deploy_threshold(self) -> float:
        return self.z_threshold if self.deploy_z_threshold is None else self.deploy_z_threshold


def as_utc(moment: datetime) -> datetime:
    """Naive UTC datetime; a naive argument is taken to be UTC already."""
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def utc_now() -> datetime:
    return as_utc(datetime.now(timezone.utc))


def ts_lit(moment: datetime) -> Column:
    """Timestamp literal that does not depend on the Python process time zone."""
    micros = (as_utc(moment) - EPOCH) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros).cast("bigint"))
