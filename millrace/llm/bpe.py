"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

A byte-level BPE tokenizer splits a text into pieces (words with their leading blank, numbers,
signs, white space) and encodes each on its own. No piece goes on over the first character of a run of
white space, and a single line feed between other characters is a piece of its own. ``Encoder`` therefore
cuts texts before a blank or line feed that follows another character, and after such a single line
feed, wherever the characters beside the cut are certainly no white space, and keeps the ids of these
units to use them again. Units are looked up many at a time, by their bytes, in a hash table of
numpy rows: 24 bytes and the length tell a short unit exactly; longer ones go through a
dictionary. Texts with a special token's string are encoded whole.
"""

from __future__ import annotations

import json
import os

import numpy as np

#: Units kept at most; beyond them the table starts anew. The table has 5 to 10 slots for 3 units.
KEPT = 1_250_000

#: Bytes of a unit that the table tells exactly, and the bits of the hash that say its two slots.
SHORT = 24
SHIFTS = (40, 12)

#: Bytes of texts that are encoded at a time, at least where one text has no more. Each takes some 50 bytes of memory meanwhile.
SPAN = 500_000

#: Units of more bytes are not kept.
LONG = 64

_ASCII = np.zeros(256, dtype=bool)
_ASCII[33:127] = True
#: First bytes of characters among which there is no white space.
_LEAD = np.zeros(256, dtype=bool)
_LEAD[33:127] = _LEAD[0xC3:0xE1] = _LEAD[0xE4:0xF5] = True
#: Bytes that are white space or may begin it.
_ODD = np.zeros(256, dtype=bool)
_ODD[:33] = _ODD[127] = _ODD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _safe_before(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is certainly no white space."""
    ok = _ASCII[b[at - 1]]
    rest = np.flatnonzero(~ok & (at >= 4) & (b[at - 1] >= 0x80))
    if len(rest):
        p = at[rest]
        one, two, three = b[p - 1], b[p - 2], b[p - 3]
        # of two bytes, but U+0085 and U+00A0; of three, but the blanks among U+1680, U+180E, U+2000 to U+207F and U+3000; of four
        narrow = (two >= 0xC3) & (two <= 0xDF) | (two == 0xC2) & (one != 0x85) & (one != 0xA0)
        wide = (three >= 0xE0) & (three <= 0xEF) & (two < 0xC0)
        wide &= ~((three == 0xE1) & ((two == 0x9A) | (two == 0xA0)))
        wide &= ~((three == 0xE2) & ((two == 0x81) | (two == 0x80) & ((one < 0x90) | (one >= 0xA8))))
        wide &= ~((three == 0xE3) & (two == 0x80) & (one == 0x80))
        ok[rest] = narrow | wide | (b[p - 4] >= 0xF0)
    return ok


class Encoder:
    def __init__(self, path: str, kept: int = KEPT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Bytes of an id.
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
        self.special = [t["content"].encode() for t in spec.get("added_tokens", ())]
        self.by_unit = (
            not any(spec.get(k) for k in ("normalizer", "truncation", "padding"))
            and model.get("type") == "BPE"
            and not model.get("dropout")
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
        )
        #: The id of a line feed, which parts the units that are encoded in one text.
        self.feed = next(iter(self.tokenizer.encode("\n", add_special_tokens=False).ids), -1)
        self.kept, self.slots = kept, 1 << (kept * 5 // 3).bit_length()
        self._begin()

    def _begin(self) -> None:
        #: Of a unit: its first 24 bytes; the place of its ids in the pool (40 bits), its length (8) and the number of its ids (16).
        self.rows = np.zeros((self.slots, 4), dtype=np.uint64)
        self.pool, self.used, self.n = np.zeros(1 << 16, dtype=self.kind), 0, 0
        self.more: dict[bytes, tuple[int, int]] = {}  # longer units: number and place of ids

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind)

    def encode(self, texts):
        """Yields the ids of each text as little-endian unsigned integers of ``width`` bytes; null counts as empty."""
        import pyarrow as pa

        ids, bounds = self.column(pa.array(list(texts), pa.string()))
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield ids[a:z].tobytes()

    def column(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of an Arrow column, and where those of each begin (and end); null counts as empty."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not len(texts):
            return np.zeros(0, dtype=self.kind), np.zeros(1, dtype=np.int64)
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        ids, sizes, i = [], [], 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SPAN, side="right")) - 1)
            got, n = self._span(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            ids.append(got)
            sizes.append(n)
            i = j
        return np.concatenate(ids), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int64)

    def _span(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, and the number of each."""
        raw = data.tobytes()
        odd = [k for k in range(len(offsets) - 1) if any(s in raw[offsets[k] : offsets[k + 1]] for s in self.special)] if any(s in raw for s in self.special) else []
        if not self.by_unit:
            odd = range(len(offsets) - 1)
        if not len(odd):
            return self._units(raw, offsets)
        parts, sizes, at = [], [], 0
        for k in [*odd, len(offsets) - 1]:
            if k > at:
                got, n = self._units(raw[offsets[at] : offsets[k]], offsets[at : k + 1] - offsets[at])
                parts.append(got)
                sizes += n.tolist()
            if k < len(offsets) - 1:
                parts.append(self.whole(raw[offsets[k] : offsets[k + 1]].decode("utf-8", "replace")))
                sizes.append(len(parts[-1]))
            at = k + 1
        return np.concatenate(parts), np.array(sizes, dtype=np.int64)

    def _units(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(raw)
        if not n:
            return np.zeros(0, dtype=self.kind), np.zeros(len(offsets) - 1, dtype=np.int64)
        b = np.frombuffer(raw + b"\0" * 32, dtype=np.uint8)
        space = np.flatnonzero((b[:n] == 32) | (b[:n] == 10))
        space = space[space > 0]
        space = space[_safe_before(b, space)]
        feed = space[b[space] == 10]
        starts = np.zeros(n + 1, dtype=bool)
        starts[space] = True
        starts[feed[_LEAD[b[feed + 1]]] + 1] = True
        starts[offsets] = True  # an empty text begins where the next one does
        starts = np.flatnonzero(starts[:n])
        size = np.diff(starts, append=n)
        number, place = self._find(raw, b, starts, size)
        ends = np.cumsum(number)
        total = int(ends[-1])
        ids = self.pool[np.repeat(place - (ends - number), number) + np.arange(total)]
        before = np.concatenate(([0], ends))
        return ids, np.diff(before[np.searchsorted(starts, offsets)])

    def _find(self, raw: bytes, b: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each unit, and their place in the pool."""
        if self.n > self.kept or self.used > 16 * self.slots or len(self.more) > self.slots:
            self._begin()
        number, place = np.zeros(len(starts), dtype=np.int64), np.zeros(len(starts), dtype=np.int64)
        short = size <= SHORT
        some = np.flatnonzero(short)
        at, n = starts[some], size[some]
        words = np.ndarray(shape=(len(b) - 7,), dtype="<u8", buffer=b.data, strides=(1,))
        keys = [words[at + 8 * k] & _MASK[np.clip(n - 8 * k, 0, 8)] for k in range(SHORT // 8)]
        h = n.astype(np.uint64)
        for k in keys:
            h = (h ^ (h >> np.uint64(29)) ^ k) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        keys.append(n.astype(np.uint64))
        left = np.arange(len(some))
        for shift in SHIFTS:
            row = self.rows[((h[left] >> np.uint64(shift)) & np.uint64(self.slots - 1)).astype(np.int64)]
            hit = row[:, 3] >> np.uint64(16) & np.uint64(0xFF) == keys[3][left]
            for i in range(3):
                hit &= row[:, i] == keys[i][left]
            to = some[left[hit]]
            number[to], place[to] = row[hit, 3] & np.uint64(0xFFFF), row[hit, 3] >> np.uint64(24)
            left = left[~hit]
        if len(left):
            _, first, of = np.unique(h[left], return_index=True, return_inverse=True)
            first = left[first]
            same = np.ones(len(left), dtype=bool)
            for k in keys:
                same &= k[left] == k[first][of]
            lone = left[~same]  # of one hash with another unit
            new = np.concatenate((first, lone))
            found = self._learn(raw, b, at[new], n[new])
            of[~same] = len(first) + np.arange(len(lone))
            number[some[left]], place[some[left]] = found[0][of], found[1][of]
            self._keep([k[first] for k in keys], h[first], *(x[: len(first)] for x in found))
        long = np.flatnonzero(~short)
        if len(long):
            units = [raw[a : a + k] for a, k in zip(starts[long].tolist(), size[long].tolist())]
            new = list({u for u in units if u not in self.more})
            found = dict(zip(new, self._add(new)))
            number[long], place[long] = zip(*(found[u] if u in found else self.more[u] for u in units))
            self.more.update((u, x) for u, x in found.items() if len(u) <= LONG)
        return number, place

    def _learn(self, raw: bytes, b: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encodes new units, those without any further white space in one text of lines."""
        number, place = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        ends = np.cumsum(n)
        chars = b[np.repeat(at - (ends - n), n) + np.arange(ends[-1])]
        bad = _ODD[chars]
        bad[(ends - n)[b[at] == 32]] = False
        plain = np.add.reduceat(bad, ends - n, dtype=np.int64) == 0
        plain &= ~((b[at] == 32) & (n == 1))
        lines = np.flatnonzero(plain)
        if len(lines):
            m = n[lines] + 1
            ends = np.cumsum(m)
            text = b[np.minimum(np.repeat(at[lines] - (ends - m), m) + np.arange(ends[-1]), len(b) - 1)]
            text[ends - 1] = 10
            ids = np.array(self.tokenizer.encode_batch_fast([text.tobytes().decode()], add_special_tokens=False)[0].ids, dtype=self.kind)
            cuts = np.flatnonzero(ids == self.feed)
            if len(cuts) == len(lines):
                first = np.concatenate(([0], cuts[:-1] + 1))
                number[lines], place[lines] = cuts - first, self._put(ids) + first
            else:
                plain[:] = False
        rest = np.flatnonzero(~plain)
        if len(rest):
            number[rest], place[rest] = zip(*self._add([raw[a : a + k] for a, k in zip(at[rest].tolist(), n[rest].tolist())]))
        return number, place

    def _keep(self, keys: list[np.ndarray], h: np.ndarray, number: np.ndarray, place: np.ndarray) -> None:
        """Gives new units a free slot, where they find one."""
        left = np.arange(len(h))
        for shift in SHIFTS:
            slot = ((h[left] >> np.uint64(shift)) & np.uint64(self.slots - 1)).astype(np.int64)
            slot, i = np.unique(slot, return_index=True)
            free = self.rows[slot, 3] == 0
            slot, i = slot[free], i[free]
            mine = left[i]
            told = place[mine].astype(np.uint64) << np.uint64(24) | keys[3][mine] << np.uint64(16) | number[mine].astype(np.uint64)
            self.rows[slot] = np.stack([*(k[mine] for k in keys[:3]), told], axis=1)
            self.n += len(mine)
            left = np.delete(left, i)

    def _put(self, ids: np.ndarray) -> int:
        """Adds ids to the pool; gives their place."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def _add(self, units: list[bytes]) -> list[tuple[int, int]]:
        out = []
        for at in range(0, len(units), 20_000):
            for got in self.tokenizer.encode_batch_fast([u.decode("utf-8", "replace") for u in units[at : at + 20_000]], add_special_tokens=False):
                ids = np.array(got.ids, dtype=self.kind)
                out.append((len(ids), self._put(ids)))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def width(path: str) -> int:
    """Bytes of an id of a tokenizer file."""
    return encoder(path).width


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
