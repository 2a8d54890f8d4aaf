"""Token ids of whole texts by a byte-level BPE tokenizer file, many texts at once.

The tokenizer first splits a text by a pattern (letter runs, digit runs, other
runs, each with at most one space before it, and white space), then merges bytes
inside each part. Between some bytes that pattern always splits, whatever stands
around them: after an ASCII letter followed by another kind of ASCII byte, between
an ASCII sign other than the apostrophe and an ASCII letter, and before the first
white space after an ASCII byte. Texts are cut there into units; every distinct
unit is encoded once by the tokenizer and kept, and a text's ids are put together
from its units' ids. So they are exactly the ids of encoding the whole text, and
words are not merged again each time they occur. The table of units is emptied
when it holds ``limit`` units, so memory stays bounded.

Strings of special tokens inside a text count as ordinary text.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Sequence

import numpy as np

from statflow.llm.common import SpanHasher


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


_BYTE = np.arange(256)
_LETTER = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122))
_WHITE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
_HIGH = _BYTE >= 128
_SIGN = (_BYTE > 32) & (_BYTE < 127) & ~_LETTER & ~((_BYTE >= 48) & (_BYTE <= 57)) & (_BYTE != 39)
_ASCII_OTHER = ~_LETTER & ~_HIGH
_ASCII_BLACK = ~_WHITE & ~_HIGH


def _cuts(raw: np.ndarray) -> np.ndarray:
    """True at i where a unit may start (between bytes i - 1 and i)."""
    out = np.zeros(len(raw), bool)
    a, b = raw[:-1], raw[1:]
    out[1:] = (_LETTER[a] & _ASCII_OTHER[b]) | (_SIGN[a] & _LETTER[b]) | \
        (_ASCII_BLACK[a] & _WHITE[b])
    # A space after a non-ASCII byte, before ASCII that is not white space.
    out[1:-1] |= _HIGH[raw[:-2]] & (raw[1:-1] == 32) & _ASCII_BLACK[raw[2:]]
    return out


class TextEncoder:
    def __init__(self, path: str, limit: int = 1_000_000, piece: int = 1 << 19):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True
        vocab = self._tok.get_vocab()
        self.vocab_size = 1 + max(vocab.values())
        self._width = np.zeros(self.vocab_size, np.int64)
        for token, i in vocab.items():
            self._width[i] = len(token)  # one character of a token stands for one byte
        self.limit, self.piece = limit, piece
        self._hasher = SpanHasher()
        self._reset()

    def _reset(self) -> None:
        """Two sorted tables (hash, start and length in the ids): new units go to the
        small one, which is merged into the large one when it is full."""
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self._large = self._small = none
        self._ids = np.zeros(1 << 16, np.uint32)
        self._used = 0

    def _find(self, hashes: np.ndarray):
        """Start and length of each hash; length -1 where it is new."""
        at, length = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1)
        for keys, starts, lengths in (self._large, self._small):
            if len(keys):
                slot = np.searchsorted(keys, hashes)
                slot[slot == len(keys)] = 0
                hit = keys[slot] == hashes
                at[hit], length[hit] = starts[slot[hit]], lengths[slot[hit]]
        return at, length

    def _remember(self, hashes: np.ndarray, at: np.ndarray, length: np.ndarray) -> None:
        where = np.searchsorted(self._small[0], hashes)
        self._small = tuple(np.insert(a, where, b) for a, b in
                            zip(self._small, (hashes, at, length)))
        if len(self._small[0]) > 1 << 16:
            where = np.searchsorted(self._large[0], self._small[0])
            self._large = tuple(np.insert(a, where, b) for a, b in zip(self._large, self._small))
            self._small = tuple(a[:0] for a in self._small)

    def _keep(self, ids: np.ndarray) -> int:
        first = self._used
        if first + len(ids) > len(self._ids):
            grown = np.zeros(2 * (first + len(ids)), np.uint32)
            grown[:first] = self._ids[:first]
            self._ids = grown
        self._ids[first:first + len(ids)] = ids
        self._used += len(ids)
        return first

    def _each(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self._tok.encode_batch_fast(units, add_special_tokens=False)]
        return (np.fromiter(itertools.chain.from_iterable(lists), np.uint32),
                np.array([len(x) for x in lists], np.int64))

    def _joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units that start with a space before, and end in, something else: encoded in
        runs (the pattern splits before such a space) and cut by byte length."""
        runs = [units[i:i + 32] for i in range(0, len(units), 32)]
        lists = [e.ids for e in self._tok.encode_batch_fast(
            ["".join(r) for r in runs], add_special_tokens=False)]
        ids = np.fromiter(itertools.chain.from_iterable(lists), np.uint32)
        ends = np.cumsum(self._width[ids])
        want = np.cumsum(np.array([len(u.encode()) for u in units], np.int64))
        cut = np.searchsorted(ends, want)
        if len(ends) and cut[-1] < len(ends) and np.array_equal(ends[cut], want):
            return ids, np.diff(np.r_[-1, cut])
        return self._each(units)  # not a tokenizer of this kind

    def _learn(self, hashes: np.ndarray, units: list[str]):
        plain = np.array([len(u) > 1 and u[0] == " " and not u[1].isspace()
                          and not u[-1].isspace() for u in units], bool)
        at, length = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        for some, encode in ((np.flatnonzero(plain), self._joined),
                             (np.flatnonzero(~plain), self._each)):
            if len(some):
                ids, n = encode([units[k] for k in some.tolist()])
                length[some] = n
                at[some] = self._keep(ids) + np.cumsum(n) - n
        self._remember(hashes, at, length)
        return at, length

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: text i has ``ids[bounds[i]:bounds[i + 1]]`` (uint32)."""
        data = [t.encode() for t in texts]
        offsets = np.zeros(len(data) + 1, np.int64)
        np.cumsum([len(d) for d in data], out=offsets[1:])
        return self.encode_buffer(np.frombuffer(b"".join(data), np.uint8), offsets)

    def encode_buffer(self, raw: np.ndarray, offsets: np.ndarray):
        """The same for UTF-8 bytes with row bounds."""
        parts, i, n = [], 0, len(offsets) - 1
        bounds = np.zeros(n + 1, np.int64)
        while i < n:
            j = int(np.searchsorted(offsets, offsets[i] + self.piece, "right")) - 1
            j = min(max(j, i + 1), n)
            ids, counts = self._rows(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            parts.append(ids)
            bounds[i + 1:j + 1] = bounds[i] + np.cumsum(counts)
            i = j
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), bounds

    def _rows(self, raw: np.ndarray, offsets: np.ndarray):
        if len(raw) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        if len(self._large[0]) > self.limit:
            self._reset()
        first = _cuts(raw) if len(raw) > 1 else np.zeros(1, bool)
        first[offsets[:-1][offsets[:-1] < len(raw)]] = True
        start = np.flatnonzero(first)
        end = np.r_[start[1:], len(raw)]
        distinct, example, code = np.unique(self._hasher.spans(raw, start, end),
                                            return_index=True, return_inverse=True)
        at, length = self._find(distinct)
        new = np.flatnonzero(length < 0)
        if len(new):
            data = raw.tobytes()
            spans = zip(start[example[new]].tolist(), end[example[new]].tolist())
            at[new], length[new] = self._learn(
                distinct[new], [data[a:b].decode() for a, b in spans])
        width = length[code]
        ends = np.cumsum(width)
        take = np.repeat(at[code] - (ends - width), width)
        take += np.arange(len(take))
        unit_bounds = np.searchsorted(start, offsets)
        total = np.r_[0, ends]
        return self._ids[take], np.diff(total[unit_bounds])
