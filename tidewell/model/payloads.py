"""Shapes of the raw JSON records and event envelopes, as explicit read schemas.

Text fields are read as strings, which keeps nested JSON as its text. Number and flag
fields are read as VARIANT, so the coercion can tell ``3.7`` from ``"3.7"``.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .specs import MARKETING, SALES, TEXT, TableSpec

_S = T.StringType()
_V = T.VariantType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


REACTIONS = T.ArrayType(_struct(name=_S, users=T.ArrayType(_S), count=_V))
FILES = T.ArrayType(_struct(id=_S, name=_S, mimetype=_S, size=_V, url_private=_S, created=_V))
STAGES = T.ArrayType(_struct(id=_S, label=_S, displayOrder=_V))
TEAMS = T.ArrayType(_struct(id=_S, name=_S))

MESSAGE = _struct(
    type=_S, subtype=_S, ts=_S, user=_S, text=_S, channel=_S, team=_S, thread_ts=_S,
    reply_count=_V, reply_users_count=_V, latest_reply=_S, reactions=REACTIONS, files=FILES,
)
USER = _struct(
    id=_S, team_id=_S, name=_S, real_name=_S, profile=_struct(email=_S, title=_S),
    is_admin=_V, is_bot=_V, deleted=_V, tz=_S, updated=_V,
)
CHANNEL = _struct(
    id=_S, name=_S, is_channel=_V, is_private=_V, is_archived=_V, created=_V, creator=_S,
    topic=_struct(value=_S, creator=_S), purpose=_struct(value=_S, creator=_S), num_members=_V,
)
ENVELOPE = _struct(
    type=_S,
    envelope_id=_S,
    payload=_struct(
        type=_S,
        event_time=_S,
        event=_struct(
            type=_S, subtype=_S, channel=_S, user=_S, text=_S, ts=_S, thread_ts=_S, team=_S,
            channel_type=_S, reaction=_S, event_ts=_S, item=_struct(type=_S, channel=_S, ts=_S),
        ),
    ),
    # Spark puts the text of a line here that does not fit.
    _corrupt_record=_S,
)

_NESTED = {"stages": STAGES, "teams": TEAMS}
_OWN_TIMES = ("_created_at", "_updated_at")


def _raw_field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, _S if kind == TEXT else _V, True)


def sales_record(spec: TableSpec) -> T.StructType:
    undeclared = [(name, TEXT) for name in spec.modified if name not in spec.names]
    return T.StructType([_raw_field(name, kind) for name, kind in [*spec.columns, *undeclared]])


def marketing_record(spec: TableSpec) -> T.StructType:
    own = [(name, kind) for name, kind in spec.columns if name != "id" and name not in _OWN_TIMES]
    if spec.entity in ("pipelines", "owners"):
        body = [T.StructField(n, _NESTED[n], True) if n in _NESTED else _raw_field(n, k) for n, k in own]
    else:
        bag = T.StructType([_raw_field(n, k) for n, k in [("id", TEXT), *own]])
        body = [T.StructField("properties", bag, True)]
    return T.StructType([T.StructField("id", _S, True), *body, *_struct(createdAt=_S, updatedAt=_S).fields])


# Field of a landed page that holds the records, and the schema of one record.
PAGES: dict[tuple[str, str], tuple[str, T.StructType]] = {
    **{("sales", e): ("records", sales_record(s)) for e, s in SALES.items()},
    **{("marketing", e): ("results", marketing_record(s)) for e, s in MARKETING.items()},
    ("chat", "messages"): ("messages", MESSAGE),
    ("chat", "users"): ("members", USER),
    ("chat", "channels"): ("channels", CHANNEL),
}
# The field for objects without a declaration.
PAGE_FIELDS = {"sales": "records", "marketing": "results"}


def page_field(family: str, entity: str) -> str:
    return PAGES[(family, entity)][0] if (family, entity) in PAGES else PAGE_FIELDS[family]


def page_schema(family: str, entity: str, record: T.StructType | None = None) -> T.StructType:
    """Schema of a page; ``record`` replaces the declared shape of its records."""
    shape = record if record is not None else PAGES[(family, entity)][1]
    return T.StructType([T.StructField(page_field(family, entity), T.ArrayType(shape), True)])
