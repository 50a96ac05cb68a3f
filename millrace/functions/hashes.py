"""Hash functions that Spark does not have: CityHash64 and XXH64 with any seed, as unsigned numbers.

Both run as Arrow UDFs on whole batches: CityHash64 by numpy over all texts of a batch, a class of lengths at a time.
Results are decimal(20,0), as they exceed a signed bigint.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# The constants of CityHash as published.
K0, K1, K2, K3 = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F, 0xC949C7DEFEBC9BB7
KMUL = 0x9DDFEA08EB382D69
k0, k1, k2, k3, kmul = (np.uint64(k) for k in (K0, K1, K2, K3, KMUL))


def _u(n) -> np.uint64 | np.ndarray:
    return n.astype(np.uint64) if isinstance(n, np.ndarray) else np.uint64(n)


def _rot(v: np.ndarray, n) -> np.ndarray:
    n = _u(n)
    return (v >> n) | (v << (np.uint64(64) - n))


def _mix(v: np.ndarray) -> np.ndarray:
    return v ^ (v >> np.uint64(47))


def _pair(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return _mix((v ^ _mix((u ^ v) * kmul)) * kmul) * kmul


class _Texts:
    """Some texts of one buffer, and the numbers that lie at a place of each."""

    def __init__(self, b: np.ndarray, at: np.ndarray, n: np.ndarray):
        self.b, self.at, self.n = b, at, n
        self.wide = np.ndarray(shape=(max(0, len(b) - 7),), dtype="<u8", buffer=b.data, strides=(1,))

    def u64(self, i) -> np.ndarray:
        return self.wide[self.at + i]

    def u32(self, i) -> np.ndarray:
        return self.u64(i) & np.uint64(0xFFFFFFFF)

    def u8(self, i) -> np.ndarray:
        return _u(self.b[self.at + i])

    def some(self, which: np.ndarray) -> _Texts:
        return _Texts(self.b, self.at[which], self.n[which])


def _to_3(s: _Texts) -> np.ndarray:
    y, z = s.u8(0) + (s.u8(s.n >> 1) << np.uint64(8)), _u(s.n) + (s.u8(s.n - 1) << np.uint64(2))
    return _mix((y * k2) ^ (z * k3)) * k2


def _to_8(s: _Texts) -> np.ndarray:
    return _pair(_u(s.n) + (s.u32(0) << np.uint64(3)), s.u32(s.n - 4))


def _to_16(s: _Texts) -> np.ndarray:
    b = s.u64(s.n - 8)
    return _pair(s.u64(0), _rot(b + _u(s.n), s.n)) ^ b


def _to_32(s: _Texts) -> np.ndarray:
    a, b = s.u64(0) * k1, s.u64(8)
    c, d = s.u64(s.n - 8) * k2, s.u64(s.n - 16) * k0
    return _pair(_rot(a - b, 43) + _rot(c, 30) + d, a + _rot(b ^ k3, 20) - c + _u(s.n))


def _to_64(s: _Texts) -> np.ndarray:
    def half(z, a, first, second):
        b, c = _rot(a + z, 52), _rot(a, 37)
        a = a + s.u64(first)
        c = c + _rot(a, 7)
        a = a + s.u64(second)
        return a + z, b + _rot(a, 31) + c

    vf, vs = half(s.u64(24), s.u64(0) + (_u(s.n) + s.u64(s.n - 16)) * k0, 8, 16)
    wf, ws = half(s.u64(s.n - 8), s.u64(16) + s.u64(s.n - 32), s.n - 24, s.n - 16)
    return _mix(_mix((vf + ws) * k2 + (wf + vs) * k0) * k0 + vs) * k2


def _weak(s: _Texts, i, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, x, y, z = (s.u64(i + k) for k in (0, 8, 16, 24))
    a = a + w
    b = _rot(b + a + z, 21)
    c = a
    a = a + x + y
    return a + z, b + _rot(a, 44) + c


def _longer(s: _Texts) -> np.ndarray:
    x, y, z = s.u64(0), s.u64(s.n - 16) ^ k1, s.u64(s.n - 56) ^ k0
    v = _weak(s, s.n - 64, _u(s.n), y)
    w = _weak(s, s.n - 32, _u(s.n) * k1, np.full(len(s.n), k0))
    z = z + _mix(v[1]) * k1
    x, y = _rot(z + x, 39) * k1, _rot(y, 33) * k1
    state = np.stack([x, y, z, *v, *w])
    ends, i = (s.n - 1) & ~63, 0
    live = np.flatnonzero(ends > i)
    while len(live):  # a block of 64 bytes of all texts that have one more
        t = s.some(live)
        x, y, z, v0, v1, w0, w1 = state[:, live]
        x = _rot(x + y + v0 + t.u64(i + 16), 37) * k1
        y = _rot(y + v1 + t.u64(i + 48), 42) * k1
        x, y = x ^ w1, y ^ v0
        z = _rot(z ^ w0, 33)
        v = _weak(t, i, v1 * k1, x + w0)
        w = _weak(t, i + 32, z + w1, y)
        state[:, live] = np.stack([z, y, x, *v, *w])
        i += 64
        live = live[ends[live] > i]
    x, y, z, v0, v1, w0, w1 = state
    return _pair(_pair(v0, w0) + _mix(y) * k1 + z, _pair(v1, w1) + x)


_CLASSES = ((3, _to_3), (8, _to_8), (16, _to_16), (32, _to_32), (64, _to_64), (None, _longer))


def city64_many(b: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CityHash64 of texts in a buffer, which goes on for eight bytes after the last of them; in the published version 1.0.2, which SQL servers keep for stability."""
    out, least = np.full(len(at), k2, dtype=np.uint64), 0
    for most, f in _CLASSES:
        mine = np.flatnonzero((n > least) if most is None else (n > least) & (n <= most))
        if len(mine):
            out[mine] = f(_Texts(b, at[mine], n[mine]))
        least = most
    return out


def city64(s: bytes) -> int:
    return int(city64_many(np.frombuffer(s + b"\0" * 8, dtype=np.uint8), np.zeros(1, dtype=np.int64), np.array([len(s)]))[0])


def _xx64(seed: int):
    def many(b: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        from xxhash import xxh64_intdigest

        raw = memoryview(b)
        return np.fromiter((xxh64_intdigest(raw[a : a + k], seed) for a, k in zip(at.tolist(), n.tolist())), dtype=np.uint64, count=len(at))

    return many


def _arrow(f):
    @F.arrow_udf("decimal(20,0)")
    def run(values):
        import pyarrow as pa

        texts = values.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        b = np.append(np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]], np.zeros(8, np.uint8))
        valid = values.is_valid().to_numpy(zero_copy_only=False)
        found = np.zeros((len(texts), 2), dtype=np.uint64)
        found[valid, 0] = f(b, (offsets[:-1] - offsets[0])[valid], np.diff(offsets)[valid])
        mask = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
        return pa.Array.from_buffers(pa.decimal128(20, 0), len(texts), [mask, pa.py_buffer(found.tobytes())])

    return run


def city_hash_64(x) -> Column:
    """CityHash64 of the value's text; null for null."""
    return _arrow(city64_many)((F.col(x) if isinstance(x, str) else x).cast("string"))


def xx_hash_64(x, seed: int = 0) -> Column:
    """XXH64 of the value's text in UTF-8, seed 0 by default; null for null."""
    text = (F.col(x) if isinstance(x, str) else x).cast("string")
    if seed == 42:  # Spark's own function has this seed, and a signed result
        h = F.xxhash64(text).cast("decimal(20,0)")
        return F.when(text.isNotNull(), F.when(h < 0, h + F.lit(str(1 << 64)).cast("decimal(20,0)")).otherwise(h).cast("decimal(20,0)"))

    return _arrow(_xx64(seed))(text)
