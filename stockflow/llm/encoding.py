"""Token ids of texts, by the tokenizers library, with a table of encoded pieces.

The vocabularies used here split a text by a regular expression before they look anything
up. Where its splits fall can be told from bytes for most text: before a white space
character that a non-space follows, and between letters, digits and other signs (a space
stays with what follows). Texts are cut there, each different piece is encoded once, and
the ids of a text are those of its pieces in order. A stretch between spaces with an
apostrophe or with signs beyond Latin letters is one piece, and so is a text with white
space or separators beyond ASCII: those go through the whole library. Tests compare the
ids with those of whole texts.

The strings of special tokens count as ordinary text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex

from stockflow.llm.shingles import text_slices

# the table is started anew beyond so many pieces; longer pieces do not enter it
TABLE_PIECES = 1_000_000
TABLE_LENGTH = 48
SLICE_BYTES = 4 << 20

_OTHER, _LETTER, _DIGIT, _SPACE = range(4)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
# bytes with which a stretch is not cut: apostrophe, separators, and all that begin a
# character beyond Latin letters; with 0xC3 begin two signs that are no letters
_SIGN = np.zeros(256, bool)
_SIGN[[0x27, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, *range(0xC4, 0x100)]] = True
_PLAIN = re.compile(rb"(?:[\x00-\x1b\x20-\x26\x28-\x7f]|\xc3[^\x97\xb7])*")
# separators, and bytes that may begin white space beyond ASCII
_ODD = np.zeros(256, bool)
_ODD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as they are, the others
    as the characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class TableEncoder:
    """Ids of texts made of pieces that are encoded alone; each different piece once.

    One per worker process: the table stays between tasks.
    """

    limit = TABLE_PIECES

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        """Start the table: piece to its number; the ids of all pieces, one after the other."""
        self._number: dict[bytes, int] = {}
        self._ids = np.zeros(0, "<u4")
        self._ends = np.zeros(1, np.int64)

    def _piece_ids(self, piece: bytes) -> list[int]:
        raise NotImplementedError

    def _ids_of_pieces(self, pieces: list[bytes]) -> Iterable[list[int]]:
        """The ids of each of some different pieces."""
        return map(self._piece_ids, pieces)

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces start in the bytes of some texts."""
        raise NotImplementedError

    def _rows(self, pieces: list[bytes]) -> np.ndarray:
        """The table's numbers of some different pieces; new ones are added."""
        number, added, lengths, row = self._number, [], [], len(self._ends) - 1
        rows = [number.get(piece, -1) for piece in pieces]
        new = [i for i, found in enumerate(rows) if found < 0]
        for i, ids in zip(new, self._ids_of_pieces([pieces[i] for i in new]), strict=True):
            added += ids
            lengths.append(len(ids))
            rows[i] = row
            if len(pieces[i]) <= TABLE_LENGTH:
                number[pieces[i]] = row
            row += 1
        self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(np.array(lengths, np.int64))])
        self._ids = np.concatenate([self._ids, np.array(added, "<u4")])
        return np.array(rows)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yield, for slices of ``texts``, their ids and the offsets of each text in them."""
        for data, offsets in text_slices(texts, SLICE_BYTES):
            yield self.encode_bytes(data, offsets)

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        if len(self._number) > self.limit or len(self._ends) > 2 * self.limit:
            self._forget()
        cuts = self._cuts(data, offsets)
        edges = pa.py_buffer(np.append(cuts, len(data)).astype(np.int64))
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts), [None, edges, pa.py_buffer(data)]
        ).dictionary_encode()
        rows = self._rows(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        begin = self._ends[rows]
        counts = self._ends[rows + 1] - begin
        ends = np.cumsum(counts)
        places = np.repeat(begin - (ends - counts), counts) + np.arange(ends[-1])
        return self._ids[places], np.concatenate([[0], ends])[np.searchsorted(cuts, offsets)]


class ChunkEncoder(TableEncoder):
    """Encodes by a vocabulary file of the tokenizers library."""

    # some 64 MB: a piece takes about 200 bytes
    limit = 300_000

    def __init__(self, vocabulary: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        self._letters = _byte_letters()
        with open(vocabulary, encoding="utf-8") as source:
            self._lower, self._split = self._steps(json.load(source))

    @staticmethod
    def _steps(described: dict):
        """Whether texts are lower-cased, and the expression that splits them; (False, None)
        if the file works in another way: then texts are encoded whole."""
        import public_tokenizers

        normalizer, splitter = described.get("normalizer"), described.get("pre_tokenizer") or {}
        if normalizer is None and splitter.get("type") == "ByteLevel" and splitter.get("use_regex"):
            return False, regex.compile(public_tokenizers.PATTERN)
        steps = [step["type"] for step in (normalizer or {}).get("normalizers", [])]
        parts = splitter.get("pretokenizers", [])
        if steps == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in parts] == ["Split", "ByteLevel"]:
            return True, regex.compile(parts[0]["pattern"]["Regex"])
        return False, None

    def whole(self, text: str) -> list[int]:
        """The ids of a text by the library alone."""
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _piece_ids(self, piece: bytes) -> list[int]:
        if self._split is None or not _PLAIN.fullmatch(piece):
            return self.whole(piece.decode())
        if not self._lower:
            # such a piece is not split again
            return [token.id for token in self._model.tokenize(piece.decode("latin-1").translate(self._letters))]
        ids = []
        for part in self._split.findall(piece.decode().lower()):
            letters = part.encode().decode("latin-1").translate(self._letters)
            ids += [token.id for token in self._model.tokenize(letters)]
        return ids

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts = offsets[:-1][offsets[:-1] < offsets[1:]]
        if self._split is None:
            return starts
        kind = _CLASS[data]
        space = kind == _SPACE
        stretch = np.zeros(len(data), bool)
        stretch[:-1] = space[:-1] & ~space[1:]
        stretch[starts] = True
        cut = stretch.copy()
        cut[1:] |= (kind[1:] != kind[:-1]) & ((data[:-1] != 32) | space[1:])
        signs = _SIGN[data]
        signs[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        signs = np.flatnonzero(signs)
        if len(signs):
            begins = np.flatnonzero(stretch)
            ends = np.append(begins[1:], len(data))
            for i in np.unique(np.searchsorted(begins, signs, "right") - 1).tolist():
                cut[begins[i] + 1 : ends[i]] = False
        odd = np.flatnonzero(_ODD[data])
        if len(odd):
            for i in np.unique(np.searchsorted(offsets, odd, "right") - 1).tolist():
                if _ODD_SPACE.search(data[offsets[i] : offsets[i + 1]].tobytes().decode()):
                    cut[offsets[i] + 1 : offsets[i + 1]] = False
        return np.flatnonzero(cut)


_encoders: dict[str, ChunkEncoder] = {}


def encoder(vocabulary: str) -> ChunkEncoder:
    """The encoder of a vocabulary file in this process."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = ChunkEncoder(vocabulary)
    return _encoders[vocabulary]


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
