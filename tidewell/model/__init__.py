from .specs import CHAT, FAMILIES, MARKETING, SALES, TableSpec, find_spec, schema_from_names

__all__ = ["CHAT", "FAMILIES", "MARKETING", "SALES", "TableSpec", "find_spec", "schema_from_names"]
