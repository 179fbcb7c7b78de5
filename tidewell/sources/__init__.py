from .events import read_envelopes, stream_envelopes
from .landed import list_files, load_bronze, read_landed, read_named
from .pages import explode_pages, infer_record, read_pages, rescue_pages, within

__all__ = [
    "explode_pages", "infer_record", "list_files", "load_bronze", "read_envelopes", "read_landed",
    "read_named", "read_pages", "rescue_pages", "stream_envelopes", "within",
]
