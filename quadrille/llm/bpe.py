"""Byte-level BPE: short pieces by merging pairs by rank, long and growing ones by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that ends its encoding, so an encoder only has to store that
last token per prefix: the token ``t`` that ends a prefix is the one whose rest is a prefix ending in a token which stays
apart from ``t`` when the two are merged by rank. Reading the last tokens backwards gives the encoding. Appending bytes leaves
the stored tokens right, so appends cost only what is appended.

Texts are split by the pattern of the vocabulary first, and every piece is encoded on its own. A split always occurs where
white space follows something else, and what stands before does not depend on what follows; edits use that to
encode anew only what lies between two such places.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import regex

# Entries of each of a worker's memories of pieces and pairs. This changes speed and memory only.
PIECES = 200_000
# Bytes of a piece up to which merging its pairs is faster than the last tokens of its prefixes, whose cost stays in proportion to the bytes.
SHORT = 64
_NO_RANK = 1 << 62
# Characters of a text that are split into pieces at a time.
SPAN = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PrefixBpe:
    """An encoder for a table of ranks, which must hold all 256 single bytes."""

    def __init__(self, ranks: dict[bytes, int], entries: int = PIECES):
        self._entries = entries
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no rank for single bytes {missing[:5]}")
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.token = {rank: token for token, rank in ranks.items()}
        self._whole: dict[int, bool] = {}
        self._apart: dict[int, bool] = {}
        self._old_apart: dict[int, bool] = {}
        size = max(self.token) + 1
        self._length = np.zeros(size, np.int64)
        for rank, token in self.token.items():
            self._length[rank] = len(token)
        self._start = np.concatenate([[0], np.cumsum(self._length)[:-1]])
        self._pool = np.frombuffer(b"".join(self.token.get(i, b"") for i in range(size)), np.uint8)

    def merge(self, data: bytes) -> list[int]:
        """Ranks by repeated merging of the adjacent pair of lowest rank, the leftmost of equals: fast on short pieces, slow on long ones.

        A pair's rank is looked up when one of its parts is new, so there are three look-ups a byte at most.
        """
        get = self.ranks.get
        cuts = list(range(len(data) + 1))  # where parts start, and the end
        pairs = [get(data[i:i + 2], _NO_RANK) for i in range(len(data) - 1)]
        while pairs:
            best = min(pairs)
            if best == _NO_RANK:
                break
            at = pairs.index(best)
            del cuts[at + 1], pairs[at]
            if at < len(pairs):
                pairs[at] = get(data[cuts[at]:cuts[at + 2]], _NO_RANK)
            if at:
                pairs[at - 1] = get(data[cuts[at - 1]:cuts[at + 1]], _NO_RANK)
        return [self.ranks[data[i:j]] for i, j in zip(cuts, cuts[1:])]

    def _stays_whole(self, token: int) -> bool:
        found = self._whole.get(token)
        if found is None:
            found = self._whole[token] = self.merge(self.token[token]) == [token]
        return found

    def _stay_apart(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self._apart.get(key)
        if found is None:
            found = self._old_apart.get(key)
            if found is None:
                found = self.merge(self.token[left] + self.token[right]) == [left, right]
            if len(self._apart) >= self._entries // 2:
                self._old_apart, self._apart = self._apart, {}
            self._apart[key] = found
        return found

    def extend(self, data: bytes, last: list[int]) -> None:
        """Continue ``last``, the last tokens of the first prefixes of ``data``, to all its prefixes."""
        get, longest, stay_apart = self.ranks.get, self.longest, self._stay_apart
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - longest), end):
                token = get(data[start:end])
                if token is not None and (stay_apart(last[start - 1], token) if start else self._stays_whole(token)):
                    last.append(token)
                    break
            else:
                raise AssertionError("a prefix without a last token")

    def walk_back(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.token[last[end - 1]])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        """Ids of one piece. A piece that is itself in the table is that one token."""
        if data in self.ranks:
            return [self.ranks[data]]
        if len(data) <= SHORT:
            return self.merge(data)
        last: list[int] = []
        self.extend(data, last)
        return self.walk_back(last)

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        sizes = self._length[ids]
        upto = np.cumsum(sizes)
        total = int(upto[-1]) if len(ids) else 0
        return self._pool[np.arange(total) + np.repeat(self._start[ids] - upto + sizes, sizes)].tobytes()


class Prefixes:
    """The last tokens of a growing piece: ``append`` costs what is appended, ``ids`` is exact at any time."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, data: bytes) -> Prefixes:
        self.data += data
        self.bpe.extend(self.data, self.last)
        return self

    def cut(self, size: int) -> Prefixes:
        self.data, self.last = self.data[:size], self.last[:size]
        return self

    def ids(self) -> list[int]:
        return [self.bpe.ranks[self.data]] if self.data in self.bpe.ranks else self.bpe.walk_back(self.last)


class _Known(dict):
    """Ids of strings as little-endian bytes, made when they are asked for and kept for the next time.

    When it is full, what it holds is set aside, and what is asked for again comes back from there.
    """

    def __init__(self, make, entries: int = PIECES):
        super().__init__()
        self.make, self.old, self.entries = make, {}, entries

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = self.make(piece)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = found
        return found


#: Where white space follows something else, a piece ends whatever comes after.
_END = regex.compile(r"\S(?=\s)")


def spans(text: str, size: int = SPAN) -> Iterator[str]:
    """Parts of about ``size`` characters whose pieces are those of the whole text."""
    start = 0
    while len(text) - start > size:
        found = _END.search(text, start + size)
        if found is None:
            break
        yield text[start:found.end()]
        start = found.end()
    yield text[start:]


#: White space beside white space, or any that is neither a space nor a line feed.
_ODD = re.compile(r"\s\s|[^\S \n]")


class TextBpe:
    """Encodes whole texts: pieces by the pattern, ids of a piece by :class:`PrefixBpe`.

    A single space or line feed and what follows it up to the next one has the same ids wherever it stands, so these units
    are remembered. Texts with other white space are split by the pattern throughout.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, entries: int = PIECES):
        self.bpe, self.pattern = PrefixBpe(ranks, entries), regex.compile(pattern)
        self._units = _Known(self._split, entries)
        self._spaced = _Known(lambda unit: self._split(" " + unit), entries)

    def _piece(self, piece: str) -> bytes:
        return np.array(self.bpe.encode(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()

    def _split(self, text: str) -> bytes:
        """Ids of a text by its pieces; a piece that is the whole text is not kept twice."""
        pieces = self.pattern.findall(text)
        if len(pieces) == 1:
            return self._piece(pieces[0])
        return b"".join([self._spaced[p[1:]] if p[0] == " " else self._units[p] for p in pieces])

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if _ODD.search(text):
            return b"".join(map(self._split, spans(text)))
        unit, spaced, out, lead = self._units.__getitem__, self._spaced.__getitem__, [], ""
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(unit(lead + first))
            out.extend(map(spaced, rest))
            lead = "\n"
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def count(self, text: str) -> int:
        return len(self.encode_bytes(text)) // 4

    def decode(self, ids) -> bytes:
        return self.bpe.decode(ids)

    def decode_bytes(self, ids: bytes) -> bytes:
        return self.bpe.decode(np.frombuffer(ids, "<u4"))


class EncodedText:
    """A text with its ids in segments, each of which ends where a piece always ends. Edits encode only the segments they touch."""

    def __init__(self, coder: TextBpe, text: str, segment: int = 256):
        self.coder, self.size = coder, segment
        self.parts = [(p, coder.encode(p)) for p in spans(text, segment)]
        self.encoded = len(text)

    @property
    def text(self) -> str:
        return "".join(p for p, _ in self.parts)

    def ids(self) -> list[int]:
        return [i for _, ids in self.parts for i in ids]

    def append(self, text: str) -> EncodedText:
        size = sum(len(p) for p, _ in self.parts)
        return self.replace(size, size, text)

    def replace(self, start: int, end: int, text: str) -> EncodedText:
        """Put ``text`` in the place of characters ``start`` to ``end``."""
        first, at = 0, 0
        while first < len(self.parts) - 1 and at + len(self.parts[first][0]) < start:
            at += len(self.parts[first][0])
            first += 1
        last, upto = first, at + len(self.parts[first][0])
        # A segment starts with white space and the one before ends without, unless the edit reaches that place.
        while last < len(self.parts) - 1 and upto <= end:
            last += 1
            upto += len(self.parts[last][0])
        old = "".join(p for p, _ in self.parts[first:last + 1])
        new = old[:start - at] + text + old[end - at:]
        self.encoded += len(new)
        self.parts[first:last + 1] = [(p, self.coder.encode(p)) for p in spans(new, self.size)]
        return self


_CODERS: dict[tuple[str, str, int], TextBpe] = {}


def coder(path: str, pattern: str, entries: int = PIECES) -> TextBpe:
    """The coder of a vocabulary file, made once per worker."""
    key = (path, pattern, entries)
    if key not in _CODERS:
        _CODERS[key] = TextBpe(read_ranks(path), pattern, entries)
    return _CODERS[key]


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
