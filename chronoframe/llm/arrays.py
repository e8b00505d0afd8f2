"""Column-at-a-time text helpers for Arrow batches: byte views, word spans, polynomial prefix hashes, minimiser runs.

Texts are handled as the UTF-8 bytes Arrow already holds, so no per-row
Python string is made. Work inside a task goes in pieces of a few MB
(:func:`chunks`), which bounds memory whatever the batch size.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa

#: One less than a power of two: prefix sums and power tables then fit the power of two.
PIECE_BYTES = (2 << 20) - 1
#: Bytes or values whose prefix sums are held at once; tables of powers, which a worker keeps, are as long.
HASHED = 1 << 16
#: Words are runs of bytes other than space and \t \n \v \f \r.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Ids that are null rank after every real id.
NO_ID = np.iinfo(np.int64).max
U64 = np.uint64


def ids(column: pa.Array) -> np.ndarray:
    """Integer ids; null becomes :data:`NO_ID`."""
    return column.cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def string_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, offs.astype(np.int64)


def chunks(column: pa.Array, limit: int = PIECE_BYTES):
    """Yield ``(first_row, last_row, bytes, offsets)`` for runs of rows of about ``limit`` bytes (one row at least)."""
    raw, offs = string_view(column)
    n, row = len(offs) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1)
        yield row, end, raw[offs[row]:offs[end]], offs[row:end + 1] - offs[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, bounds)``: byte spans of the words; document ``d`` has words ``bounds[d]:bounds[d+1]``."""
    inside = ~SEPARATOR[data]
    n = len(data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < n]
    begins[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads the weak low bits of a polynomial hash."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: Odd bases; seeds of unlike parity give independent hashes of one sequence.
BASES = (0x2545F4914F6CDD1D, 0x369DEA0F31A53F85)


class Poly:
    """Polynomial hash modulo 2**64 with an odd base: ``span`` hashes any part of a sequence from its prefix sums.

    Prefix ``C[i] = sum(v[j] * p**j for j < i)``; as p is odd it has an
    inverse, so ``(C[e] - C[s]) * p**-s`` depends on the part's content alone.
    """

    #: Powers of a base and of its inverse, shared by all hashes with that base (a worker keeps them).
    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, seed: int):
        self.table = np.random.Generator(np.random.PCG64(seed)).integers(1, 2**64, 256, dtype=U64)
        self.base = BASES[seed % len(BASES)]
        self._up = self._down = np.ones(1, dtype=U64)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            up, down = Poly._powers.get(self.base, (self._up, self._down))
            if len(up) < n:
                size = 1 << (n - 1).bit_length()
                tables = []
                for b in (self.base, pow(self.base, -1, 2**64)):
                    a = np.full(size, b, dtype=U64)
                    a[0] = 1
                    tables.append(np.multiply.accumulate(a))
                up, down = Poly._powers[self.base] = tuple(tables)
            self._up, self._down = up, down

    def prefix(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        self._grow(n + 1)
        out = np.zeros(n + 1, dtype=U64)
        np.cumsum(values * self._up[:n], out=out[1:])
        return out

    def prefix_bytes(self, data: np.ndarray) -> np.ndarray:
        return self.prefix(self.table[data])

    def span(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self._down[start])

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """Hash of every window of ``width`` neighbours."""
        n = max(0, len(prefix) - width)
        return mix((prefix[width:width + n] - prefix[:n]) * self._down[:n])

    def windows_of(self, values: np.ndarray, width: int) -> np.ndarray:
        """:meth:`windows` of the values' prefix sums, made ``HASHED`` values at a time."""
        n = max(0, len(values) - width + 1)
        out = np.empty(n, dtype=U64)
        step = max(HASHED - width, width)
        for a in range(0, n, step):
            b = min(n, a + step)
            out[a:b] = self.windows(self.prefix(values[a:b + width - 1]), width)
        return out


@functools.lru_cache(maxsize=None)
def poly(seed: int) -> Poly:
    return Poly(seed)


#: Words of more bytes are hashed by blake2b: polynomials modulo a power of two let long patterned strings collide whatever the base.
LONG_WORD = 32


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each word; ``starts`` and ``ends`` rise. Prefix sums take eight times the bytes, so they are made of ``HASHED`` at a time."""
    p = poly(seed)
    out = np.empty(len(starts), dtype=U64)
    row = 0
    while row < len(starts):
        left = starts[row]
        end = max(row + 1, int(np.searchsorted(ends, left + HASHED - 1, side="right")))
        if end > row + 1 or ends[row] - left <= LONG_WORD:
            out[row:end] = p.span(p.prefix_bytes(data[left:ends[end - 1]]), starts[row:end] - left, ends[row:end] - left)
        row = end
    key = seed.to_bytes(8, "little")
    for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():        # at most one for each LONG_WORD bytes of text
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k]:ends[k]], digest_size=8, key=key).digest(), "little")
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[0] .. starts[0]+lengths[0]-1, starts[1] ..`` in one array."""
    total = int(lengths.sum())
    out = np.ones(total, dtype=np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    out[0] = starts[0]
    at = np.cumsum(lengths)[:-1]
    out[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(out)


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of many spans, one after the other."""
    return data[ranges(starts, lengths)]


def owners(bounds: np.ndarray) -> np.ndarray:
    """Document number of each item, from ``bounds`` as in :func:`word_spans`."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
