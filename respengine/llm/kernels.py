"""Vectorised text kernels that run inside Spark tasks (numpy on Arrow buffers).

Hashes that stand for content take a ``salt``: a secret number drawn by each call of an
operator on the driver and sent with its tasks, so that nobody can prepare texts that
collide. Long content goes through a keyed digest or a polynomial modulo a prime.
"""

from __future__ import annotations

import hashlib
import secrets
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
# After one block of this size was freed, malloc keeps freed blocks up to it for the next
# arrays; before, it returns them and their pages fault in anew for every array.
np.empty((32 << 20) - 8192, np.uint8)
_MASK = (1 << 64) - 1
# An odd base, so that its powers have inverses modulo 2^64.
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def new_salt() -> int:
    """A secret for one call of an operator; its tasks all get the same."""
    return secrets.randbits(64)


@lru_cache(maxsize=4)
def _secret(salt: int, label: str, n: int) -> np.ndarray:
    """``n`` 64-bit values that only holders of the salt can tell."""
    raw = b"".join(hashlib.blake2b(i.to_bytes(8, "little"), key=salt.to_bytes(8, "little"),
                                   person=label.encode(), digest_size=8).digest() for i in range(n))
    return np.frombuffer(raw, np.uint64)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p)
    return _POWERS[0], _POWERS[1]


class Rolling:
    """Hashes of any range of a sequence of 64-bit values, from one prefix sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        power, self.inverse = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def windows(self, n: int) -> np.ndarray:
        """Raw hash of every window of ``n`` values."""
        count = max(0, len(self.sums) - n)
        return (self.sums[n:n + count] - self.sums[:count]) * self.inverse[:count]


def byte_values(data: np.ndarray, salt: int) -> np.ndarray:
    return _secret(salt, "byte", 256)[data]


_PRIME = np.uint64((1 << 31) - 1)


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number that is the same modulo 2^31 - 1."""
    return (x & _PRIME) + (x >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= _PRIME, x - _PRIME, x)


@lru_cache(maxsize=4)
def _prime_powers(salt: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    prime = int(_PRIME)
    base = int(_secret(salt, "base", 1)[0]) % (prime - 2) + 2
    out = []
    for b in (base, pow(base, -1, prime)):
        p = np.ones(1, np.uint64)
        while len(p) < n:
            p = np.concatenate([p, _reduced(p * np.uint64(pow(b, len(p), prime)))])
        out.append(p)
    return out[0], out[1]


class PrimeRolling:
    """Hashes below 2^31 of any range of bytes: a polynomial modulo 2^31 - 1 at a secret
    base over secret values, so two different ranges of n bytes collide with a chance of
    n / 2^31 at most, whatever they hold."""

    def __init__(self, data: np.ndarray, salt: int):
        n = len(data)
        power, self.inverse = _prime_powers(salt, 1 << max(16, n.bit_length()))
        values = _secret(salt, "prime", 256) % _PRIME
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_fold(values[data] * power[:n]), out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _reduced(_reduced(self.sums[end] - self.sums[start]) * self.inverse[start])


def lanes(data: np.ndarray, extra: int = 0) -> np.ndarray:
    """The eight bytes from each position on (zeros beyond the end) as one number, also
    for ``extra`` positions beyond the end."""
    padded = np.zeros(len(data) + extra + 8, np.uint8)
    padded[:len(data)] = data
    return np.ndarray((len(data) + extra,), "<u8", padded, strides=(1,))


def text_slices(table: pa.Table, column: str = "text", limit: int = SLICE_BYTES):
    """Yield ``first row, bytes, offsets`` of runs of rows of about ``limit`` bytes."""
    for first, arr in _arrays(table, column):
        if not len(arr):
            continue
        off = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8)
        body = arr.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        row = 0
        while row < len(arr):
            end = int(np.searchsorted(off, off[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), len(arr))
            yield first + row, data[off[row]:off[end]], off[row:end + 1] - off[row]
            row = end


def _arrays(table: pa.Table, column: str):
    first = 0
    for chunk in table.column(column).chunks:
        yield first, chunk.cast(pa.large_binary())
        first += len(chunk)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy with the bytes A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, off: np.ndarray):
    """Start and end of each word (run of bytes other than white space, never across
    documents), and the number of words before each document."""
    inside = ~SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


_LANE = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
WORD_LANES = 4


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of words by keyed rounds of eight bytes; words of more than 32 bytes by
    digests. Words of up to eight bytes and one length never collide."""
    size = ends - starts
    eight = lanes(data, 8 * WORD_LANES)
    keys = _secret(salt, "word", 2 * WORD_LANES + 1)
    hashes = size.astype(np.uint64) * (keys[-1] | np.uint64(1))
    for k in range(WORD_LANES):
        rows = np.flatnonzero(size > 8 * k) if k else slice(None)
        if k and not len(rows):
            break
        own = eight[starts[rows] + 8 * k] & _LANE[np.minimum(size[rows] - 8 * k, 8)]
        hashes[rows] = mix((hashes[rows] ^ own) * (keys[2 * k] | np.uint64(1)) + keys[2 * k + 1])
    key = salt.to_bytes(8, "little")
    for i in np.flatnonzero(size > 8 * WORD_LANES):
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), key=key, digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def table_words(table: pa.Table, salt: int, *, lower: bool = False):
    """Word hashes of all rows of a table, and the word offset of each row."""
    hashes, counts = [], [np.zeros(1, np.int64)]
    for _, data, off in text_slices(table):
        if lower:
            data = lower_ascii(data)
        starts, ends, woff = words(data, off)
        hashes.append(word_hashes(data, starts, ends, salt))
        counts.append(np.diff(woff))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
            np.cumsum(np.concatenate(counts)))


def room(off: np.ndarray) -> np.ndarray:
    """For each item, how many items its document still has from there on."""
    ends = np.repeat(off[1:], np.diff(off))
    return ends - np.arange(off[0], off[-1])


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


class Keys:
    """The distinct 80-bit keys of a chunk in order, and the way back to its items."""

    def __init__(self, key: np.ndarray, check: np.ndarray | None = None):
        if check is None:
            check = np.zeros(len(key), np.uint16)
        order = np.argsort(key, kind="stable")
        k, c = key[order], check[order]
        same = k[1:] == k[:-1]
        if (same & (c[1:] != c[:-1])).any():
            order = np.lexsort((check, key))
            k, c = key[order], check[order]
            same = k[1:] == k[:-1]
        new = np.ones(len(k), bool)
        new[1:] = ~(same & (c[1:] == c[:-1]))
        self.key, self.check = k[new], c[new]
        at = np.flatnonzero(new)
        self.count = np.diff(np.append(at, len(k)))
        self.order, self.new = order, new

    def to_items(self, per_key: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.order), per_key.dtype)
        out[self.order] = np.repeat(per_key, self.count)
        return out

    def blocks(self, parts: int):
        """``part, keys, checks`` for each part that has keys."""
        bounds = np.searchsorted(parts_of(self.key, parts), np.arange(parts + 1, dtype=np.uint64))
        for p in np.flatnonzero(np.diff(bounds)):
            yield int(p), slice(int(bounds[p]), int(bounds[p + 1]))


def pack(key: np.ndarray) -> bytes:
    """Sorted keys with their upper halves as 16-bit steps (longer ones at the end)."""
    step = np.diff(key >> np.uint64(32), prepend=np.uint64(0))
    far = step >= 65535
    return (np.where(far, 65535, step).astype("<u2").tobytes() + key.astype("<u4").tobytes()
            + step[far].astype("<u4").tobytes())


def unpack(packed: bytes, n: int) -> np.ndarray:
    step = np.frombuffer(packed, "<u2", n).astype(np.uint64)
    low = np.frombuffer(packed, "<u4", n, 2 * n).astype(np.uint64)
    step[step == 65535] = np.frombuffer(packed, "<u4", offset=6 * n)
    return (np.cumsum(step) << np.uint64(32)) | low


def _blocks(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    checks = [np.frombuffer(b, np.uint16) for b in table.column("checks").to_pylist()]
    return [unpack(b, len(c)) for b, c in zip(table.column("keys").to_pylist(), checks)], checks


REQUEST = "chunk int, part int, keys binary, checks binary"
ANSWER = "chunk int, part int, n int, bits binary"


def request_table(chunk: int, keys: Keys, parts: int) -> pa.Table:
    rows = [(p, pack(keys.key[s]), keys.check[s].tobytes()) for p, s in keys.blocks(parts)]
    return pa.table({
        "chunk": pa.array([chunk] * len(rows), pa.int32()),
        "part": pa.array([r[0] for r in rows], pa.int32()),
        "keys": pa.array([r[1] for r in rows], pa.binary()),
        "checks": pa.array([r[2] for r in rows], pa.binary())})


def answer_table(chunks, parts, flags: list[np.ndarray]) -> pa.Table:
    return pa.table({
        "chunk": pa.array(chunks, pa.int32()), "part": pa.array(parts, pa.int32()),
        "n": pa.array([len(f) for f in flags], pa.int32()),
        "bits": pa.array([np.packbits(f).tobytes() for f in flags], pa.binary())})


def repeated(table: pa.Table) -> pa.Table:
    """For the blocks of one part: which keys another chunk has too."""
    chunks, parts = table.column("chunk").to_pylist(), table.column("part").to_pylist()
    blocks, checks = _blocks(table)
    keys = Keys(np.concatenate(blocks), np.concatenate(checks))
    flags = keys.to_items(keys.count > 1)
    return answer_table(chunks, parts, np.split(flags, np.cumsum([len(b) for b in blocks])[:-1]))


def holders(table: pa.Table) -> pa.Table:
    """For the blocks of one part: which keys another chunk has too, then (as many bits
    again) for which this chunk is the first that has them."""
    chunks, parts = table.column("chunk").to_pylist(), table.column("part").to_pylist()
    blocks, checks = _blocks(table)
    by_chunk = np.argsort(chunks, kind="stable")
    chunks, parts, blocks, checks = ([x[i] for i in by_chunk] for x in (chunks, parts, blocks, checks))
    keys = Keys(np.concatenate(blocks), np.concatenate(checks))
    several = keys.to_items(keys.count > 1)
    first = np.zeros(len(several), bool)
    first[keys.order[keys.new]] = True  # the order is stable: the lowest chunk leads
    cuts = np.cumsum([len(b) for b in blocks])[:-1]
    flags = [np.concatenate(f) for f in zip(np.split(several, cuts), np.split(first, cuts))]
    return answer_table(chunks, parts, flags)


class Originals:
    """Which rows of a chunk are the first with their key, and which have copies."""

    def __init__(self, key: np.ndarray, check: np.ndarray, answers: pa.Table):
        keys = Keys(key, check)
        rows = sorted(zip(answers.column("part").to_pylist(), answers.column("n").to_pylist(),
                          answers.column("bits").to_pylist()))
        halves = [np.split(np.unpackbits(np.frombuffer(b, np.uint8), count=n), 2) for _, n, b in rows]
        several, first = (np.concatenate([h[i] for h in halves]).astype(bool) if halves
                          else np.zeros(0, bool) for i in (0, 1))
        if len(several) != len(keys.key):
            raise RuntimeError(f"{len(several)} answers for {len(keys.key)} keys")
        self.copied = keys.to_items(several | (keys.count > 1))
        leads = np.zeros(len(key), bool)
        leads[keys.order[keys.new]] = True
        self.active = leads & keys.to_items(first)


def text_keys(table: pa.Table, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """80-bit keys of whole texts, from keyed digests."""
    secret, digests = salt.to_bytes(8, "little"), []
    for _, data, off in text_slices(table):
        body = memoryview(data)
        digests += [hashlib.blake2b(body[a:b], key=secret, digest_size=10).digest()
                    for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    both = np.frombuffer(b"".join(digests), np.dtype([("key", "<u8"), ("check", "<u2")]))
    return both["key"].astype(np.uint64), both["check"].astype(np.uint16)


def answered(table: pa.Table, n: int) -> np.ndarray:
    """The flags of a chunk's ``n`` distinct keys, from the answers of all parts."""
    rows = sorted(zip(table.column("part").to_pylist(), table.column("n").to_pylist(),
                      table.column("bits").to_pylist()))
    flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=k) for _, k, b in rows]
    out = np.concatenate(flags).astype(bool) if flags else np.zeros(0, bool)
    if len(out) != n:
        raise RuntimeError(f"{len(out)} answers for {n} keys")
    return out
