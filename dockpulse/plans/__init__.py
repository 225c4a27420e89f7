"""Every query by name, with the SQL that must give the same rows."""

from __future__ import annotations

from dockpulse.plans import forecasting, ingest, relational, stations, streams  # noqa: F401
from dockpulse.plans.registry import ORACLES, QUERIES  # noqa: F401
