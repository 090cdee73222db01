"""All registered queries."""

from unmask.plans.queries import ingest, learning, matching, reporting, snapshots, texts  # noqa: F401
from unmask.plans.queries.registry import ORACLES, QUERIES  # noqa: F401
