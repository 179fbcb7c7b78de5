"""Declared bronze tables: names, column kinds, keys and modification columns."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

TEXT, INT, LONG, DOUBLE, FLAG = "text", "int", "long", "double", "flag"

KIND_TYPES = {
    TEXT: T.StringType(),
    INT: T.IntegerType(),
    LONG: T.LongType(),
    DOUBLE: T.DoubleType(),
    FLAG: T.IntegerType(),
}

# Generic type names accepted when a table is declared by hand.
# Any other name is text.
GENERIC_TYPES = {
    "str": T.StringType(),
    "string": T.StringType(),
    "int": T.LongType(),
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "float": T.DoubleType(),
    "float64": T.DoubleType(),
    "bool": T.IntegerType(),
    "boolean": T.IntegerType(),
    "datetime": T.TimestampType(),
    "date": T.DateType(),
    "list": T.StringType(),
    "dict": T.StringType(),
    "object": T.StringType(),
}


@dataclass(frozen=True)
class TableSpec:
    """One declared bronze table.

    ``modified`` names the fields of the raw record that carry its modification time, best first,
    whether or not the table declares them; incremental loads use the first one that is filled.
    Rows are told apart by ``key`` and ``more_keys``. A table that is landed ``as_text`` is typed
    when it is read, so its types can widen from load to load.
    """

    family: str
    entity: str
    columns: tuple[tuple[str, str], ...]
    key: str
    modified: tuple[str, ...] = ()
    more_keys: tuple[str, ...] = ()
    as_text: bool = False

    @property
    def keys(self) -> list[str]:
        return [self.key, *self.more_keys]

    @property
    def table(self) -> str:
        return f"bronze_{self.family}_{self.entity.lower()}"

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(name, KIND_TYPES[kind], True) for name, kind in self.columns])


def _spec(family: str, entity: str, columns: str, modified: tuple[str, ...]) -> TableSpec:
    parsed = tuple((name, kind or TEXT) for name, _, kind in (c.partition(":") for c in columns.split()))
    return TableSpec(family, entity, parsed, parsed[0][0], modified)


# The declared columns of every table. A column without a kind is text;
# the first column is the key.
SALES_COLUMNS = {
    "Account": """Id Name Industry AnnualRevenue:double NumberOfEmployees:long BillingCity
        BillingState BillingCountry Phone Website Type CreatedDate LastModifiedDate""",
    "Contact": """Id FirstName LastName Email Phone Title Department AccountId MailingCity
        MailingState LeadSource CreatedDate LastModifiedDate""",
    "Opportunity": """Id Name StageName Amount:double CloseDate Probability:int AccountId Type
        LeadSource ForecastCategory IsClosed:flag IsWon:flag CreatedDate""",
    "Lead": """Id FirstName LastName Email Company Title Status LeadSource Industry Rating
        Phone City State CreatedDate""",
    "Task": """Id Subject Status Priority WhoId WhatId ActivityDate Description OwnerId
        IsHighPriority:flag CreatedDate""",
    "Case": """Id Subject Status Priority Origin Type Reason AccountId ContactId Description
        IsClosed:flag CreatedDate""",
    "Product2": """Id Name ProductCode Description Family IsActive:flag QuantityUnitOfMeasure
        StockKeepingUnit CreatedDate""",
    "PricebookEntry": """Id Name Pricebook2Id Product2Id UnitPrice:double IsActive:flag
        UseStandardPrice:flag CurrencyIsoCode CreatedDate""",
    "Contract": """Id AccountId Status StartDate EndDate ContractTerm:int OwnerExpirationNotice
        ContractNumber Description CreatedDate""",
    "Asset": """Id Name AccountId ContactId Product2Id SerialNumber Status InstallDate
        PurchaseDate Quantity:long Price:double CreatedDate""",
    "Campaign": """Id Name Type Status StartDate EndDate BudgetedCost:double ActualCost:double
        ExpectedRevenue:double NumberSent:long NumberOfLeads:long NumberOfContacts:long CreatedDate""",
    "Event": """Id Subject StartDateTime EndDateTime Location WhoId WhatId Description
        IsAllDayEvent:flag OwnerId CreatedDate""",
}

MARKETING_COLUMNS = {
    "contacts": """id firstname lastname email phone company jobtitle lifecyclestage
        hs_lead_status city state country createdate lastmodifieddate hs_object_id
        _created_at _updated_at""",
    "companies": """id name domain industry annualrevenue numberofemployees city state country
        phone website type createdate lastmodifieddate hs_object_id _created_at _updated_at""",
    "deals": """id dealname dealstage amount closedate pipeline dealtype hs_priority createdate
        lastmodifieddate hs_object_id _created_at _updated_at""",
    "tickets": """id subject content hs_pipeline hs_pipeline_stage hs_ticket_priority
        hs_ticket_category createdate lastmodifieddate hs_object_id _created_at _updated_at""",
    "line_items": """id name quantity price amount discount hs_product_id createdate
        lastmodifieddate hs_object_id _created_at _updated_at""",
    "engagements": """id hs_engagement_type hs_engagement_source hs_timestamp hs_body_preview
        hs_engagement_source_id createdate lastmodifieddate hs_object_id _created_at _updated_at""",
    "pipelines": "id label displayOrder:int stages _created_at _updated_at",
    "owners": "id email firstName lastName userId:long teams _created_at _updated_at",
}

CHAT_COLUMNS = {
    "messages": """channel_id channel_name message_ts user_id text thread_ts reply_count:int
        reactions has_files:flag file_count:int team subtype processing_date ingestion_mode""",
    "realtime_events": """event_type channel_id user_id text message_ts thread_ts team
        channel_type subtype event_time processing_date ingestion_mode envelope_id""",
    "users": "id name real_name email title is_admin:flag is_bot:flag tz",
    "channels": "id name is_private:flag created:long creator num_members:int topic purpose",
}


def _family(family: str, tables: dict[str, str], modified: tuple[str, ...]) -> dict[str, TableSpec]:
    specs = {}
    for entity, columns in tables.items():
        specs[entity] = _spec(family, entity, columns, modified)
    return specs


SALES = _family("sales", SALES_COLUMNS, ("LastModifiedDate",))
MARKETING = _family("marketing", MARKETING_COLUMNS, ("_updated_at",))
CHAT = _family("chat", CHAT_COLUMNS, ("message_ts",))
CHAT["messages"] = replace(CHAT["messages"], more_keys=("message_ts",))
FAMILIES = {"sales": SALES, "marketing": MARKETING, "chat": CHAT}


def find_spec(family: str, entity: str) -> TableSpec:
    try:
        return FAMILIES[family][entity]
    except KeyError:
        raise KeyError(f"no declared table for {family}/{entity}") from None


def schema_from_names(schema: dict[str, str]) -> T.StructType:
    """Schema for a table declared as ``{column: generic type name}``."""
    return T.StructType(
        [T.StructField(name, GENERIC_TYPES.get(kind.lower(), T.StringType()), True) for name, kind in schema.items()]
    )
