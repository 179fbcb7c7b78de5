"""Whole texts to token ids with the tokenizers library, a batch at a time.

The library spends most of its time on words it has seen before. Texts of plain Latin
letters are cut here, by the rules of the two kinds of tokenizer that state them in their
files, into the pieces that the library's own pre-tokenizer would give; each distinct piece
goes to the library once and its ids are kept by its bytes. A hash finds the distinct pieces of a
block; a text with a piece that only shares its hash goes to the library whole. Every other text, and every other kind of
tokenizer, goes to the library whole. ``tests/llm/test_tokens.py`` compares both ways.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import pyarrow as pa

from tidewell.llm import text as T

#: How many distinct pieces a worker keeps before it drops those not met lately.
KEPT = 280_000
#: Bytes of pieces compared with their first ones at once.
COMPARED = 1 << 18
SPACE, OTHER_SPACE, LETTER, NUMBER, REST = 0, 1, 2, 3, 4


def _kind(char: str) -> int:
    if char == " ":
        return SPACE
    if char in "\t\n\v\f\r":
        return OTHER_SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(char)[0], REST)


ASCII = np.array([_kind(chr(i)) for i in range(128)], np.uint8)
#: Kinds of the two-byte characters U+0080 to U+024F, by lead byte and continuation byte.
TWO = np.array([_kind(chr(i)) for i in range(0x80, 0x280)], np.uint8).reshape(8, 64)


class Encoder:
    """One tokenizer in one worker. ``encode`` gives ids and bounds of a text column."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rule = self._rule(spec)
        added = [x["content"].encode() for x in spec.get("added_tokens", [])]
        if any(not x.startswith(b"<|") for x in added):
            self.rule = None
        self._letters = {i: chr(c) for i, c in enumerate(_byte_letters())}
        self._forget()

    @staticmethod
    def _rule(spec: dict) -> str | None:
        normal, before = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
        if spec.get("post_processor") and spec["post_processor"].get("type") != "ByteLevel":
            return None
        if normal is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"):
            return "spaced"
        if normal and [x.get("type") for x in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            steps = before.get("pretokenizers", [])
            if [x.get("type") for x in steps] == ["Split", "ByteLevel"] and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space"):
                known = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
                if steps[0]["pattern"].get("Regex") == known and steps[0]["invert"] and steps[0]["behavior"] == "Removed":
                    return "lower"
        return None

    def encode(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin."""
        ids, counts = [], []
        for _, data, offsets in T.blocks(*T.column(array), size=2 * T.BLOCK):
            parts = self._block(data, offsets)
            ids.extend(parts)
            counts.extend(map(len, parts))
        bounds = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=bounds[1:])
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)), bounds

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * (len(offsets) - 1)
        hard = self._hard(data, offsets) if self.rule else np.ones(len(out), bool)
        raw = data.tobytes()
        whole = np.flatnonzero(hard).tolist()
        if whole:
            texts = [raw[offsets[i] : offsets[i + 1]].decode() for i in whole]
            for i, got in zip(whole, self.library.encode_batch_fast(texts, add_special_tokens=False)):
                out[i] = np.array(got.ids, np.uint32)
        easy = np.flatnonzero(~hard)
        if len(easy):
            if len(whole):
                lengths = offsets[easy + 1] - offsets[easy]
                data = np.concatenate([data[offsets[i] : offsets[i + 1]] for i in easy])
                offsets = np.concatenate([[0], np.cumsum(lengths)])
            for i, got in zip(easy.tolist(), self._easy(data, offsets)):
                out[i] = got
        return out

    def _hard(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows with anything that the cutting rules here don't cover."""
        bad = data >= (0xCA if self.rule == "spaced" else 0xC4)
        bad |= (data >= 0x1C) & (data <= 0x1F)
        if len(data) > 1:
            after = data[1:]
            two = data[:-1] == 0xC2
            bad[:-1] |= two & ((after == 0x85) | (after == 0xA0))
            bad[:-1] |= (data[:-1] == 0x3C) & (after == 0x7C)
            low = after | 0x20
            mark = data[:-1] == 0x27
            if mark.any():
                bad[:-1] |= mark & np.isin(low, np.frombuffer(b"strvmld", np.uint8))
        total = np.concatenate([[0], np.cumsum(bad)])
        return total[offsets[1:]] > total[offsets[:-1]]

    def _easy(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        rows = len(offsets) - 1
        if not len(data):
            return [np.zeros(0, np.uint32)] * rows
        kind = ASCII[data & 0x7F]
        lead = np.flatnonzero(data >= 0xC2)
        if len(lead):
            kinds = TWO[data[lead] - 0xC2, data[lead + 1] & 0x3F]
            kind[lead] = kinds
            kind[lead + 1] = kinds
        if self.rule == "lower":
            data = T.LOWER[data]
            upper = lead[(data[lead] == 0xC3) & (data[lead + 1] <= 0x9E) & (data[lead + 1] != 0x97)]
            data[upper + 1] += 0x20
        first = np.zeros(len(data), bool)
        first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        before = np.empty_like(kind)
        before[0] = REST
        before[1:] = kind[:-1]
        white = kind <= OTHER_SPACE
        if self.rule == "spaced":
            after_white = np.zeros(len(data), bool)
            after_white[1:] = white[:-1]
            last = np.zeros(len(data), bool)  # of a run of spaces that more text follows
            last[:-1] = ~white[1:] & ~first[1:]
            begins = np.where(white, ~after_white | last, (before == OTHER_SPACE) | (before != kind) & (before != SPACE))
            begins |= first
            skip = None
        else:
            single = (kind == NUMBER) & ((data & 0xC0) != 0x80)
            begins = ~white & (first | (before != kind) | single)
            skip = white
        starts = np.flatnonzero(begins)
        if not len(starts):
            return [np.zeros(0, np.uint32)] * rows
        keys, at, inverse = np.unique(T.hash_runs(data, starts, skip), return_index=True, return_inverse=True)
        size = np.diff(np.append(starts, len(data))) if skip is None else np.add.reduceat((~skip).astype(np.int64), starts)
        raw = data.tobytes()
        found = self._learn([raw[a : a + n] for a, n in zip(starts[at].tolist(), size[at].tolist())])
        per = np.array([len(x) // 4 for x in found], np.int64)
        pool, begin, per = np.frombuffer(b"".join(found), np.uint32), (np.cumsum(per) - per)[inverse], per[inverse]
        total = np.concatenate([[0], np.cumsum(per)])
        ids = pool[np.repeat(begin - total[:-1], per) + np.arange(total[-1])]
        bounds = np.searchsorted(starts, offsets)
        out = T.slices(ids, total[bounds])
        for row in self._unlike(data, starts, size, at[inverse], bounds):
            (got,) = self.library.encode_batch_fast([raw[offsets[row] : offsets[row + 1]].decode()], add_special_tokens=False)
            out[row] = np.array(got.ids, np.uint32)
        return out

    @staticmethod
    def _unlike(data: np.ndarray, starts: np.ndarray, size: np.ndarray, twin: np.ndarray, bounds: np.ndarray) -> list[int]:
        """Rows with a piece that isn't byte for byte the first one of its hash."""
        same = size == size[twin]
        later = np.flatnonzero((twin != np.arange(len(twin))) & same)
        total = np.concatenate([[0], np.cumsum(size[later])])
        cuts = np.unique(np.append(np.searchsorted(total, np.arange(0, total[-1], COMPARED)), len(later))).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            some, ends = later[a:b], total[a : b + 1] - total[a]
            k = np.arange(ends[-1]) - np.repeat(ends[:-1], size[some])
            differ = data[np.repeat(starts[some], size[some]) + k] != data[np.repeat(starts[twin[some]], size[some]) + k]
            if differ.any():
                same[some] &= np.add.reduceat(differ, ends[:-1], dtype=np.int64) == 0
        wrong = np.flatnonzero(~same)
        return np.unique(np.searchsorted(bounds, wrong, "right") - 1).tolist()

    def _forget(self) -> None:
        """No piece known. Ids of pieces by their bytes: those met lately, and those met before that."""
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @property
    def keys(self) -> list[bytes]:
        """All pieces whose ids are kept."""
        return [*self.known, *(x for x in self.older if x not in self.known)]

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece; the library encodes those not known."""
        if len(self.known) > KEPT // 2:
            self.known, self.older = {}, self.known
        out, tokenize, letters = [], self.library.model.tokenize, self._letters
        for piece in pieces:
            ids = self.known.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                if ids is None:
                    ids = np.array([y.id for y in tokenize(piece.decode("latin1").translate(letters))], np.uint32).tobytes()
                self.known[piece] = ids
            out.append(ids)
        return out


def _byte_letters() -> list[int]:
    """The character by which byte-level vocabularies write each byte: itself if it prints, else the next above 255."""
    shown = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    return [b if shown[b] else 256 + sum(not x for x in shown[:b]) for b in range(256)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of this file, made once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
