"""Token ids by the tokenizers library, with a bounded cache of the pieces that its pre-tokenizer makes.

A byte-pair tokenizer encodes each piece of its pre-tokenizer by itself. PieceEncoder cuts a text into the same pieces
with the tokenizer's own pattern, asks the library once for each new piece and reuses its answer. Texts that hold
anything beyond a plain character range, in which pattern and normalisation are certain to agree, or a special token's
string, as they are or lower-cased where the tokenizer does that, are given to the library whole, so the ids are those
of encode(text, add_special_tokens=False) in every case.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np

from spillway.llm.common import worker_cache

# Letters, numbers and white space among the plain characters, which are ASCII text and Latin-1 and Latin Extended A and B signs. Their classes and normal forms are the same in every Unicode version.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t\n\r \xa0"
_BEYOND = re.compile("[^\t\n\r\x20-\x7e\xa0-\u024f]").search

# A pre-tokenizer's pattern as its tokenizer file states it, and the forms of the two known patterns over plain characters.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BYTE_PLAIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_WORD_PLAIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")

#: Pieces kept per process at most.
CACHE_PIECES = 800_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """encode(text) gives a text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.cut, self.lower = self._cutter(spec)
        self.special = [t["content"].lower() if self.lower else t["content"] for t in spec.get("added_tokens") or []]
        self.cache: dict[str, bytes] = {}
        self.most = cache_pieces

    @staticmethod
    def _cutter(spec: dict):
        """What cuts a plain text into pieces, and whether texts are lower-cased; (None, False) for pipelines not known here."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            return _BYTE_PLAIN.findall, False
        if pre.get("type") == "Sequence" and norm and norm["type"] == "Sequence" and norm["normalizers"] == NORMALIZERS:
            split, *more = pre["pretokenizers"]
            if split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"] and split["pattern"].get("Regex") == WORD_PATTERN and [(m["type"], m["use_regex"]) for m in more] == [("ByteLevel", False)]:
                return _WORD_PLAIN.findall, True
        return None, False

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        # Lower case may lead out of the plain range, and into a special token's string. What it leads into the range (three
        # signs whose lower case is a Latin letter) the library's normalisation makes the same letter.
        plain = text.lower() if self.lower else text
        if self.cut is None or _BEYOND(plain) or any(s in plain for s in self.special):
            return self.whole(text)
        pieces = self.cut(plain)
        cache = self.cache
        if new := set(pieces).difference(cache):
            if len(cache) + len(new) > self.most:
                cache.clear()
                new = set(pieces)
            new = list(new)
            cache.update(zip(new, [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)], strict=True))
        return b"".join(map(cache.__getitem__, pieces))


# Classes of the 256 Latin-1 signs; END is none of a plain text's and stands behind each text.
_END, _LETTER, _NUMBER, _SPACE, _OTHER = range(5)
_CLASS = np.array([_END] + [_LETTER if re.match(f"[{_L}]", c) else _NUMBER if re.match(f"[{_N}]", c) else _SPACE if re.match(f"[{_S}]", c) else _OTHER for c in map(chr, range(1, 256))], np.uint8)
#: Bytes of a piece that is looked up by arrays, and zeros behind the texts for that; by a piece's length, what its first and second eight bytes keep.
_KEY = 16
_KEEPS = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(_KEY + 1)], np.uint64), np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(_KEY + 1)], np.uint64)
#: New pieces that go to the library as one text; bytes of long pieces kept at most; signs of a long text that are looked up at once, about.
_JOINED, _LONG_BYTES, _STRETCH = 2000, 16_000_000, 1_000_000
#: A space between other signs than blanks: always a piece's begin, whatever stands around.
_BETWEEN = re.compile(rb"[^\t\n\r \xa0] (?=[^\t\n\r \xa0])").search


def byte_pieces(raw: np.ndarray) -> np.ndarray:
    """Where the pieces of _BYTE_PLAIN begin in Latin-1 texts that each end with a zero byte, which is a piece of its own."""
    kind = _CLASS[raw]
    edge = np.empty(len(raw), bool)
    edge[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[kind == _END] = True
    # The last blank before anything else stands apart from those before it; a space goes with what follows.
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & (kind[1:] != _END))
    edge[last] = True
    edge[last + 1] = raw[last] != 0x20
    # 's and the like, where a piece begins with the apostrophe.
    at = np.flatnonzero(raw == 0x27)
    at = at[edge[at]]
    if len(at):
        one, two = raw[at + 1], raw[np.minimum(at + 2, len(raw) - 1)]
        size = np.where(np.isin(one, (0x73, 0x74, 0x6D, 0x64)), 1, np.where(((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C), 2, 0))
        at, size = at[size > 0], size[size > 0]
        edge[at + 1] = False
        edge[at + 1 + size] = True
    return np.flatnonzero(edge)


class TableEncoder:
    """encode(texts) gives the ids of many texts one after another, each text's with the end id behind them, and where each text's end.

    Pieces of Latin-1 texts are numbers of up to 16 bytes, looked up in an open hash table by the whole number; longer ones are few and in a dict. Texts that are not plain Latin-1, or of a tokenizer whose pattern is another, go by PieceEncoder.
    """

    def __init__(self, path: str, end_id: int, cache_pieces: int = CACHE_PIECES):
        self.one = PieceEncoder(path, cache_pieces // 8)
        self.tokenizer, self.end_id, self.most = self.one.tokenizer, end_id, cache_pieces
        vocab = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocab.values(), default=0) + 1, np.int64)  # a byte-level token has one sign for each byte
        self.bytes_of[list(vocab.values())] = [len(t) for t in vocab]
        self.by_table = self.one.cut == _BYTE_PLAIN.findall
        self._clear()

    def _clear(self) -> None:
        """The table starts small; its rows are two numbers that make the key, and first place << 32 | count of its ids in the pool (0: a free row)."""
        self.rows, self.n = np.zeros((1 << 12, 3), np.uint64), 0
        self.pool, self.used = np.zeros(1 << 14, np.uint32), 0
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self._insert(np.zeros((1, 2), np.uint64), self._pooled(np.array([self.end_id], np.uint32), np.ones(1, np.int64)))

    def _pooled(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Puts pieces' ids into the pool; where they are."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.r_[self.pool[: self.used], np.zeros(max(self.used, len(ids)) + len(ids), np.uint32)]
        self.pool[self.used : self.used + len(ids)] = ids
        first = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        return (first.astype(np.uint64) << np.uint64(32)) | counts.astype(np.uint64)

    def _slots(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        mixed = (one ^ (two * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xC4CEB9FE1A85EC53)
        return (mixed >> np.uint64(65 - len(self.rows).bit_length())).astype(np.int64)

    def _insert(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Adds keys that the table does not hold, each once."""
        self.n += len(keys)
        if 2 * self.n > len(self.rows):
            old = self.rows[self.rows[:, 2] != 0]
            self.rows = np.zeros((1 << (4 * self.n - 1).bit_length(), 3), np.uint64)
            keys, places = np.concatenate([old[:, :2], keys]), np.concatenate([old[:, 2], places])
        slot, rows = self._slots(keys[:, 0], keys[:, 1]), self.rows
        left = np.arange(len(keys))
        while len(left):
            free = left[rows[slot[left], 2] == 0]
            rows[slot[free], :2], rows[slot[free], 2] = keys[free], places[free]
            # Of several at one free row the last is there now.
            left = left[rows[slot[left], 2] != places[left]]
            slot[left] = (slot[left] + 1) & (len(rows) - 1)

    def _find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The keys' places, 0 where the table does not hold a key."""
        slot = self._slots(one, two)
        rows = self.rows.take(slot, axis=0)
        places = rows[:, 2].copy()
        left = np.flatnonzero(((rows[:, 0] != one) | (rows[:, 1] != two)) & (places != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.rows) - 1)
            rows = self.rows[slot[left]]
            places[left] = rows[:, 2]
            left = left[((rows[:, 0] != one[left]) | (rows[:, 1] != two[left])) & (rows[:, 2] != 0)]
        return places

    def _ask(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of texts one after another, and their counts."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """_ask for pieces of a space and what follows it: one behind the other they are a text that is cut into them again. Their bytes tell the ids apart."""
        whole = "".join(texts)
        if not any(s in whole for s in self.one.special):
            ids, _ = self._ask([whole])
            ends, want = np.cumsum(self.bytes_of[ids]), np.cumsum([len(t.encode()) for t in texts])
            at = np.searchsorted(ends, want)
            if len(ids) and ends[-1] == want[-1] and (ends[at] == want).all():
                return ids, np.diff(at, prepend=-1)
        return self._ask(texts)

    def _learn(self, new: list[bytes]) -> dict[bytes, int]:
        """Asks the library for new pieces, keeps its answers and gives their places."""
        after_space = [x for x in new if len(x) > 1 and x[0] == 0x20 and _CLASS[x[1]] != _SPACE]
        apart = set(new).difference(after_space)
        texts = [x.decode("latin-1") for x in (*after_space, *apart)]
        answers = [self._joined(texts[lo : min(lo + _JOINED, len(after_space))]) for lo in range(0, len(after_space), _JOINED)]
        if apart:
            answers.append(self._ask(texts[len(after_space) :]))
        new = [*after_space, *apart]
        places = self._pooled(np.concatenate([a[0] for a in answers]), np.concatenate([a[1] for a in answers]))
        found = dict(zip(new, places.tolist(), strict=True))
        short = np.array([len(x) <= _KEY for x in new])
        keys = np.frombuffer(b"".join([x.ljust(_KEY, b"\0") for x in new if len(x) <= _KEY]), "<u8").reshape(-1, 2)
        self._insert(keys, places[short])
        for x in new:
            if len(x) > _KEY:
                self.long[x] = found[x]
                self.long_bytes += len(x)
        return found

    def _of_table(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.n + len(self.long) > self.most or self.used > 8 * self.most or self.long_bytes > _LONG_BYTES:
            self._clear()
        data = b"\0".join([*texts, b"\0" * (_KEY + 1)])
        raw = np.frombuffer(data, np.uint8)[: len(data) - _KEY - 1]
        starts = byte_pieces(raw)
        sizes = np.diff(starts, append=len(raw))
        keeps = np.minimum(sizes, _KEY)
        eights = np.ndarray(len(data) - 7, "<u8", data, 0, 1)  # the eight bytes from each place on
        one, two = eights[starts] & _KEEPS[0][keeps], eights[starts + 8] & _KEEPS[1][keeps]
        places = self._find(one, two)
        places[sizes > _KEY] = 0
        at = np.flatnonzero(places == 0)
        if len(at):
            pieces = [data[lo:hi] for lo, hi in zip(starts[at].tolist(), (starts[at] + sizes[at]).tolist(), strict=True)]
            long = self.long
            new = [x for x in dict.fromkeys(pieces) if x not in long]
            found = self._learn(new) if new else {}
            places[at] = np.array([found[x] if x in found else long[x] for x in pieces], np.uint64)
        counts = (places & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ends = np.cumsum(counts)
        from_pool = np.repeat((places >> np.uint64(32)).astype(np.int64) - ends + counts, counts)
        from_pool += np.arange(len(from_pool))
        return self.pool[from_pool], ends[raw[starts] == 0]

    def _of_long(self, raw: bytes) -> np.ndarray:
        """A long text's ids, stretch by stretch."""
        parts, lo = [], 0
        while lo < len(raw):
            found = _BETWEEN(raw, lo + _STRETCH)
            hi = found.start() + 1 if found else len(raw)
            parts.append(self._of_table([raw[lo:hi]])[0][:-1])
            lo = hi
        return np.concatenate([*parts, np.array([self.end_id], np.uint32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids up to each text's end."""
        plain: list[bytes] = []
        others: dict[int, np.ndarray] = {}
        for i, t in enumerate(texts):
            try:
                raw = t.encode("latin-1") if self.by_table and not _BEYOND(t) and not any(s in t for s in self.one.special) else None
            except UnicodeEncodeError:
                raw = None
            if raw is None:
                others[i] = np.r_[np.frombuffer(self.one.encode(t), "<u4"), np.uint32(self.end_id)]
            elif len(raw) > 2 * _STRETCH:
                others[i] = self._of_long(raw)
            else:
                plain.append(raw)
        ids, ends = self._of_table(plain) if plain else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        if not others:
            return ids, ends
        by_table = iter(np.split(ids, ends[:-1]) if plain else [])
        parts = [others[i] if i in others else next(by_table) for i in range(len(texts))]
        return np.concatenate(parts), np.cumsum([len(x) for x in parts])


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise RuntimeError("token ids are kept as the machine's unsigned 32-bit integers, which must be little-endian")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
_encoders: dict = worker_cache()


def encoder(path: str, cache_pieces: int = CACHE_PIECES) -> PieceEncoder:
    """The process's encoder for a tokenizer file; Python workers are reused and keep it."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path, cache_pieces)
    return _encoders[path]


def table_encoder(path: str, end_id: int, cache_pieces: int = CACHE_PIECES) -> TableEncoder:
    """encoder's like for many texts at once."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = TableEncoder(path, end_id, cache_pieces)
    return _encoders[path, end_id]
