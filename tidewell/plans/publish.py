"""A lake's tables and views under their names, for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model.specs import FAMILIES
from ..operators.messages import live_messages, unify_messages
from ..operators.tables import create_view
from .ingest import BACKFILL, SNAPSHOT, Lake
from .marts import publish_views


def chat_messages(lake: Lake, loaded: set[str]) -> DataFrame:
    """History with the live messages; a message that is in both is the history's."""
    channels = lake.bronze("chat", "channels") if "channels" in loaded else None
    fresh = live_messages(lake.bronze("chat", "realtime_events"), channels)
    if "historical" not in loaded:
        return fresh
    return unify_messages(lake.bronze("chat", "messages"), fresh)


def publish(lake: Lake, family: str, *, live: bool = False) -> list[str]:
    """Define every loaded bronze table of a family, and the views over them.

    ``live`` adds the table the event stream feeds, and its messages to the messages table, so
    that the chat views see history and live messages, each once.
    """
    saved = lake.state.current(family).where(
        ~F.col("resource").startswith(BACKFILL) & ~F.col("resource").endswith(SNAPSHOT)
    )
    loaded = {row["resource"] for row in saved.select("resource").collect()}  # at most one per declared table
    if "historical" in loaded:
        loaded |= {"messages", *lake.state.load("chat", "historical")["dimensions"]}
    if live:
        loaded |= {"realtime_events", "messages"}
    names = []
    own = {s.entity: s for s in lake.declared.values() if s.family == family}
    specs = FAMILIES[family] | {e: lake.spec(family, e) for e in lake.saved_tables(family)} | own
    for entity, spec in specs.items():
        if entity in loaded:
            with_live = live and (family, entity) == ("chat", "messages")
            create_view(chat_messages(lake, loaded) if with_live else lake.bronze(family, entity), spec.table)
            names.append(spec.table)
    return names + publish_views(lake.spark, family)
