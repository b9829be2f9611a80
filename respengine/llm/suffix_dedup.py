"""Suffix-array deduplication of bytes by a common-prefix-aware merge sort.

A window is ``width`` consecutive bytes of one text; a byte is removed when a window that
also starts anywhere else covers it.

1. Runs. Every window holds a sampled suffix: the first position whose 16-byte hash is
   least among the window's first ``SPAN`` positions depends on the window's bytes only,
   so equal windows hold equal sampled suffixes at equal offsets. Each chunk sorts its
   sampled suffixes (cut to the ``width - SPAN + 1`` bytes certain to lie in the window,
   whole 8-byte words of them) and front-codes the sorted run: the length of the prefix
   shared with the predecessor, then the rest. Runs are dealt out by the hash of the
   first 16 bytes, so equal suffixes meet and no splitters are needed.
2. Merge. Each part merges the runs of all chunks with a loser tree that keeps common
   prefix lengths: a match is decided by the lengths alone, or compares bytes from the
   known length on. Where neighbours share the whole string, the suffix is repeated.
Of equal texts only the first takes part (found by one exchange of 80-bit text keys); the
others, and it, go whole if a window fits into them.

3. Extension. Windows around repeated suffixes are taken to full width, counted over the
   corpus by 80-bit keys, and the bytes that repeated windows cover are removed.

The keys come from a secret of the call (see ``kernels``): windows that differ are taken
for equal by chance only, about 40 pairs among 10^13 windows, and texts made to collide
cannot be prepared (a chance of about 2^-46 a pair at most).

Sorting every suffix would move the input about a hundred times over; the sample moves
about one suffix in sixty-four positions and loses no window.

Defined results: null and empty texts have no bytes; texts below ``width`` bytes lose
nothing; equal rows count as separate occurrences; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respengine.llm import kernels as K
from respengine.llm.common import chunk_count, chunked

GRAM, SPAN = 16, 128
_GRAM = K.mix(np.arange(1, 4, dtype=np.uint64)) | np.uint64(1)

RUN = "chunk int, part int, shared binary, rest binary, several binary"
RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
          "kept binary")


def suffix_length(width: int) -> int:
    """Bytes of a sampled suffix that are compared: whole words inside the window."""
    return (width - SPAN + 1) // 8 * 8


# -- sampling ---------------------------------------------------------------------------

def _sampled(data: np.ndarray, off: np.ndarray, width: int):
    """For every window start: its sampled suffix. Returns starts, sampled positions
    (ascending), how many successive starts have each, and the hashes to deal them by."""
    starts = np.flatnonzero(K.room(off) >= width)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    eight = np.ascontiguousarray(K.lanes(data))
    grams = eight[:-8] * _GRAM[0]
    grams += eight[8:] * _GRAM[1]
    grams ^= grams >> np.uint64(32)
    grams *= _GRAM[2]
    least = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < SPAN:  # SPAN is a power of two
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    chosen = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(chosen), bool)
    new[1:] = chosen[1:] != chosen[:-1]
    first = np.flatnonzero(new)
    at = chosen[first]
    return starts, at, np.diff(np.append(first, len(chosen))), K.mix(grams[at])


def _strings(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes from each position on, as rows of numbers of eight bytes."""
    eight = K.lanes(data)
    out = np.empty((len(at), size // 8), "<u8")
    for k in range(size // 8):
        out[:, k] = eight[at + 8 * k]
    return out


def _suffix_hashes(strings: np.ndarray) -> np.ndarray:
    """Hash of each row of ``_strings``; it only nominates windows."""
    out = np.zeros(len(strings), np.uint64)
    for column in strings.T:
        out = K.mix((out ^ column) * _GRAM[0])
    return out


def _run(table: pa.Table, width: int, parts: int, chunk: int) -> pa.Table:
    """The sampled suffixes of a chunk, sorted and front-coded within parts."""
    size = suffix_length(width)
    strings, hashes = [np.zeros((0, size), np.uint8)], [np.zeros(0, np.uint64)]
    for _, data, off in K.text_slices(table):
        _, at, _, part_hash = _sampled(data, off, width)
        if len(at):
            strings.append(_strings(data, at, size).view(np.uint8))
            hashes.append(part_hash)
    rows, part = np.concatenate(strings), K.parts_of(np.concatenate(hashes), parts)
    columns = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.lexsort([*columns.T[::-1], part])
    rows, part = rows[order], part[order]
    differs = rows[1:] != rows[:-1]
    prefix = np.where(differs.any(axis=1), differs.argmax(axis=1), size)
    new = np.ones(len(rows), bool)
    new[1:] = (prefix < size) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    several = np.diff(np.append(first, len(rows))) > 1
    shared = np.zeros(len(first), np.uint8)
    shared[1:] = prefix[first[1:] - 1]
    rows = rows[first]
    bounds = np.searchsorted(part[first], np.arange(parts + 1, dtype=np.uint64))
    out = {"chunk": [], "part": [], "shared": [], "rest": [], "several": []}
    for p in np.flatnonzero(np.diff(bounds)):
        s = slice(bounds[p], bounds[p + 1])
        known = shared[s].copy()
        known[0] = 0
        rest = rows[s][np.arange(size) >= known[:, None]]
        for name, value in zip(out, (chunk, int(p), known.tobytes(), rest.tobytes(),
                                     np.packbits(several[s]).tobytes())):
            out[name].append(value)
    return pa.table(out, schema=pa.schema([
        ("chunk", pa.int32()), ("part", pa.int32()), ("shared", pa.binary()), ("rest", pa.binary()),
        ("several", pa.binary())]))


# -- merging ----------------------------------------------------------------------------

def merge_runs(runs: list[tuple[bytes, bytes]], size: int) -> list[np.ndarray]:
    """Merge front-coded runs of strings of ``size`` bytes; flag those of other runs too.

    A loser tree over the runs. Every string carries the length it shares with the last
    string that left the tree, which is also what the losers on its path carry. The
    longer length wins without a look at the bytes; equal lengths compare from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    shared = [r[0] for r in runs] + [b""] * (k - len(runs))
    rest = [r[1] for r in runs] + [b""] * (k - len(runs))
    flags = [np.zeros(len(s), bool) for s in shared]
    index, offset = [0] * k, [0] * k
    string: list[bytes | None] = [None] * k
    known = [-1] * k  # -1: the run is used up

    def advance(r: int) -> None:
        i = index[r]
        if i < len(shared[r]):
            n = shared[r][i]
            end = offset[r] + size - n
            string[r] = rest[r][offset[r]:end] if not n else string[r][:n] + rest[r][offset[r]:end]
            offset[r] = end
            known[r] = n
            index[r] = i + 1
        else:
            known[r] = -1

    def beats(x: int, y: int) -> bool:
        """Whether x leaves before y; the loser's known length becomes that with the winner."""
        n, m = known[x], known[y]
        if n != m:
            return n > m
        if n < 0 or n == size:
            return True
        a, b = string[x][n:], string[y][n:]
        if a == b:
            known[y] = size
            return True
        n += len(a) - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8
        if a < b:
            known[y] = n
            return True
        known[x] = n
        return False

    loser = [0] * k
    winner = list(range(k)) * 2
    for r in range(k):
        advance(r)
    for node in range(k - 1, 0, -1):
        x, y = winner[2 * node] if 2 * node < k else 2 * node - k, \
            winner[2 * node + 1] if 2 * node + 1 < k else 2 * node + 1 - k
        won = beats(x, y)
        winner[node], loser[node] = (x, y) if won else (y, x)
    top = winner[1] if k > 1 else 0
    last = None
    while known[top] >= 0:
        at = (top, index[top] - 1)
        if last is not None and known[top] == size:
            flags[at[0]][at[1]] = flags[last[0]][last[1]] = True
        last = at
        advance(top)
        node = (top + k) // 2
        while node:
            if not beats(top, loser[node]):
                top, loser[node] = loser[node], top
            node //= 2
    return flags[:len(runs)]


def _unpack(shared: bytes, rest: bytes, size: int) -> np.ndarray:
    """The strings of a front-coded run as rows of bytes."""
    known = np.frombuffer(shared, np.uint8)
    column = np.arange(size)
    own = column >= known[:, None]
    rows = np.zeros(own.shape, np.uint8)
    rows[own] = np.frombuffer(rest, np.uint8)
    # A byte that is not a row's own is that of the last row above that has its own there.
    last = np.maximum.accumulate(np.where(own, np.arange(len(known))[:, None], 0), axis=0)
    return rows[last, column]


def _merge(table: pa.Table, size: int) -> pa.Table:
    """For each chunk's run: the hashes of its suffixes that are repeated."""
    runs = list(zip(table.column("shared").to_pylist(), table.column("rest").to_pylist()))
    found = []
    for (shared, rest), several, flags in zip(runs, table.column("several").to_pylist(), merge_runs(runs, size)):
        flags |= np.unpackbits(np.frombuffer(several, np.uint8), count=len(flags)).astype(bool)
        found.append(_suffix_hashes(_unpack(shared, rest, size)[flags].view("<u8")) if flags.any() else np.zeros(0, np.uint64))
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"),
                     "n": pa.array([len(f) for f in found], pa.int32()),
                     "bits": pa.array([f.tobytes() for f in found], pa.binary())})


# -- extension --------------------------------------------------------------------------

def _windows(table: pa.Table, answers: pa.Table, width: int, salt: int):
    """Keys of the windows around repeated suffixes, and their starts by slice."""
    size = suffix_length(width)
    repeated = np.unique(np.concatenate([np.zeros(0, np.uint64)] + [
        np.frombuffer(b, np.uint64) for b in answers.column("bits").to_pylist()]))
    keys, checks, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)], []
    for _, data, off in K.text_slices(table):
        every, at, count, _ = _sampled(data, off, width)
        flags = np.isin(_suffix_hashes(_strings(data, at, size)), repeated)
        mine = every[np.repeat(flags, count)]
        starts.append(mine)
        if len(mine):
            # Only the bytes of these windows are hashed: within a window, none is left out.
            change = np.zeros(len(data) + 1, np.int32)
            change[mine] += 1
            change[mine + width] -= 1
            covered = np.cumsum(change[:-1]) > 0
            begin = (np.cumsum(covered) - 1)[mine]
            inside = data[covered]
            keys.append(K.mix(K.Rolling(K.byte_values(inside, salt)).ranges(begin, begin + width)))
            other = K.PrimeRolling(inside, salt).ranges(begin, begin + width)
            checks.append((K.mix(other) >> np.uint64(48)).astype(np.uint16))
    return K.Keys(np.concatenate(keys), np.concatenate(checks)), starts


def suffix_dedup(docs: DataFrame, *, width: int = 200, id_col: str = "doc_id",
                 text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per document: what is left without the bytes of repeated windows.

    ``kept`` holds the remaining bytes (null with ``keep_text=False``); they need not be
    valid UTF-8, since a cut may fall inside a character.
    """
    if suffix_length(width) < GRAM:
        raise ValueError(f"width must be at least {SPAN + GRAM - 1} bytes")
    n = chunk_count(docs, text_col)
    size, salt = suffix_length(width), K.new_salt()
    base = chunked(docs, n, id_col=id_col, text_col=text_col)

    def level(answers: pa.Table, k: int) -> pa.Table:
        return answers.filter(pa.compute.equal(answers.column("level"), k))

    def originals(table: pa.Table, answers: pa.Table):
        """Only the first of equal texts takes part; the chunk's number; who has copies."""
        which = K.Originals(*K.text_keys(table, salt), level(answers, 0))
        return table.filter(pa.array(which.active)), which

    def ask_texts(table: pa.Table) -> pa.Table:
        return K.request_table(table.column("chunk")[0].as_py(), K.Keys(*K.text_keys(table, salt)), n)

    def ask_runs(table: pa.Table, answers: pa.Table) -> pa.Table:
        mine, _ = originals(table, answers)
        return _run(mine, width, n, table.column("chunk")[0].as_py())

    def merge(table: pa.Table) -> pa.Table:
        return _merge(table, size)

    def ask_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        mine, _ = originals(table, answers)
        keys, _ = _windows(mine, level(answers, 1), width, salt)
        return K.request_table(table.column("chunk")[0].as_py(), keys, n)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        every = table
        table, which = originals(every, answers)
        keys, starts = _windows(table, level(answers, 1), width, salt)
        twice = keys.to_items(K.answered(level(answers, 2), len(keys.key)) | (keys.count > 1))
        del keys
        rows = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}

        def add(doc_id, n_bytes, removed, spans, kept):
            for name, value in zip(rows, (doc_id, n_bytes, removed, spans, hashlib.sha256(kept).hexdigest(),
                                          kept if keep_text else None)):
                rows[name].append(value)

        # A text with a copy goes whole, if a window fits into it.
        copied = which.copied[which.active]
        for i in np.flatnonzero(~which.active):
            raw = every.column("text")[int(i)].as_py().encode("utf-8")
            whole = len(raw) >= width
            add(every.column("doc_id")[int(i)].as_py(), len(raw), len(raw) if whole else 0, int(whole),
                b"" if whole else raw)
        ids = table.column("doc_id").to_pylist()
        done = 0
        for (row, data, off), mine in zip(K.text_slices(table), starts):
            again = twice[done:done + len(mine)]
            done += len(mine)
            change = np.zeros(len(data) + 1, np.int32)
            change[mine[again]] += 1
            change[mine[again] + width] -= 1
            for i in np.flatnonzero(copied[row:row + len(off) - 1] & (np.diff(off) >= width)):
                change[off[i]] += 1
                change[off[i + 1]] -= 1
            gone = np.cumsum(change[:-1]) > 0
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            inner = off[:-1][off[:-1] < len(data)]
            edge[inner] = gone[inner]
            left, removed = data[~gone], np.append(0, np.cumsum(gone))[off]
            spans = np.append(0, np.cumsum(edge))[off]
            kept_off = off - removed
            for i in range(len(off) - 1):
                add(ids[row + i], int(off[i + 1] - off[i]), int(removed[i + 1] - removed[i]),
                    int(spans[i + 1] - spans[i]), left[kept_off[i]:kept_off[i + 1]].tobytes())
        return pa.table(rows, schema=pa.schema([
            ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
            ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]))

    def by_chunk(answers: DataFrame, k: int) -> DataFrame:
        return answers.withColumn("level", F.lit(k)).repartition(n, "chunk")

    def joined(answers: DataFrame):
        return base.groupBy("chunk").cogroup(answers.groupBy("chunk"))

    texts = by_chunk(base.groupBy("chunk").applyInArrow(ask_texts, K.REQUEST)
                     .groupBy("part").applyInArrow(K.holders, K.ANSWER), 0)
    suffixes = by_chunk(joined(texts).applyInArrow(ask_runs, RUN)
                        .groupBy("part").applyInArrow(merge, K.ANSWER), 1)
    windows = by_chunk(joined(texts.unionAll(suffixes)).applyInArrow(ask_windows, K.REQUEST)
                       .groupBy("part").applyInArrow(K.repeated, K.ANSWER), 2)
    return joined(texts.unionAll(suffixes).unionAll(windows)).applyInArrow(remove, RESULT)
