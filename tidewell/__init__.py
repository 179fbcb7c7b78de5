"""CRM and chat exports to analytics tables, on Spark."""

from .plans.ingest import Lake, backfill_chat, ingest_entity, run_all, run_family
from .plans.live import LiveFeed
from .plans.marts import MARTS, publish_views
from .plans.publish import publish
from .session import configure

__all__ = [
    "MARTS", "Lake", "LiveFeed", "backfill_chat", "configure", "ingest_entity", "publish", "publish_views", "run_all",
    "run_family",
]
