"""Texts to byte-level BPE ids and back, with the tiktoken library and a local rank file.

The library cuts a text by its pattern and merges each piece by rank. Its pattern engine keeps a place
to go back to for each character of a run of white space, and fails beyond a million of them, so texts longer than
``LONG`` characters are cut here first, at *safe* boundaries: between a printing ASCII character and a
space or line feed no match of the pattern goes on, and no match looks back, so both sides are encoded as
in the whole text. Where the next safe boundary is further than ``LONG`` away, the rest up to it is cut by the
same pattern in the regex module, match by match, and each match goes to the library's merge as raw bytes.

Ids are kept as little-endian unsigned 32-bit numbers in a binary column. Decoding joins the bytes of
the ids, whether or not they are valid UTF-8; an id that the file doesn't have is an error. Null text is empty and has no ids; long texts are whole;
rows are independent, so ties and repeated rows need no rule; all columns are kept, and a column named as one
that is added is replaced. Nothing is shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

#: Characters that go to the library at once; far below what its engine can go back over.
LONG = 100_000

SAFE = regex.compile(r"(?<=[!-~])(?=[ \n])")


class Codec:
    """The ranks of one file in one worker."""

    def __init__(self, path: str, pattern: str, long: int = LONG):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.library = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.matches = regex.compile(pattern)
        self.ranks, self.long = ranks, long

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text in parts of at most ``long`` characters, or single matches where that can't be (then true)."""
        at = 0
        while len(text) - at > self.long:
            cut = None
            for found in SAFE.finditer(text, at + 1, at + self.long + 1):
                cut = found.start()
                if cut > at + self.long // 2:
                    break
            if cut is None:
                after = SAFE.search(text, at + self.long)
                cut = after.start() if after else len(text)
                for match in self.matches.finditer(text[at:cut]):
                    yield match.group(), True
            else:
                yield text[at:cut], False
            at = cut
        yield text[at:], False

    def encode(self, text: str) -> bytes:
        if len(text) <= self.long:
            return np.array(self.library.encode_ordinary(text), "<u4").tobytes()
        out = bytearray()
        for part, single in self.parts(text):
            out += np.array(self._piece(part.encode()) if single else self.library.encode_ordinary(part), "<u4").tobytes()
        return bytes(out)

    def _piece(self, piece: bytes) -> list[int]:
        rank = self.ranks.get(piece)
        return [rank] if rank is not None else self.library._encode_single_piece(piece)

    def decode(self, ids: bytes, at_once: int = 1 << 20) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        return b"".join(self.library.decode_bytes(numbers[a : a + at_once].tolist()) for a in range(0, len(numbers), at_once))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of this file, made once."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _added(df: DataFrame, make: Callable[[pa.RecordBatch], dict[str, pa.Array]], new: list[StructField]) -> DataFrame:
    """All columns and the new ones; columns of the same names are replaced, in any case of letters."""
    names = {f.name.lower() for f in new}
    kept = [f for f in df.schema if f.name.lower() not in names]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = make(batch)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *found.values()], [*[f.name for f in kept], *found])

    return df.mapInArrow(add, StructType([*kept, *new]))


def _large(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``ids`` and their number ``n_tokens`` for ``text``."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ids = [codec(path, pattern).encode(t.as_py() or "") for t in batch.column("text")]
        return {"ids": _large(ids), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}

    return _added(docs.withColumn("text", F.col("text").cast("string")), make, [StructField("ids", BinaryType()), StructField("n_tokens", LongType())])


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``; null ids are none."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"decoded": _large([codec(path, pattern).decode(x.as_py() or b"") for x in batch.column("ids")])}

    return _added(encoded, make, [StructField("decoded", BinaryType())])
