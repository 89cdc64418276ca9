"""Hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from fillforge.llm.minhash import mixed

GOLD = np.uint64(0x9E3779B97F4A7C15)
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWERED = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], np.uint8)
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG = 256  # bytes from which a word is hashed on its own


def texts_of(batch: pa.RecordBatch, name: str, size: int = 1 << 22):
    """Slices of a batch that hold about `size` bytes of text each, one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(name)).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 (one more than rows) and the bytes of a binary or string column without nulls."""
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.empty(0, np.uint8)
    return off - off[0], raw


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a binary column (runs of non-blank bytes, A-Z as a-z), and where each text's words begin
    among them (one more than rows)."""
    off, raw = binary_parts(column)
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(off), np.int64)
    inside = ~BLANK[raw]
    edges = off[(off > 0) & (off < len(raw))]
    before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sizes = ends - starts
    low = np.concatenate([LOWERED[raw], np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(low, (len(raw) + 1, 8), (1, 1))
    h = sizes.astype(np.uint64) * GOLD
    todo, at = np.arange(len(starts)), 0
    while len(todo):
        part = eights[starts[todo] + at].view("<u8")[:, 0] & MASKS[np.minimum(sizes[todo] - at, 8)]
        h[todo] = mixed(h[todo] * GOLD + part)
        at += 8
        todo = todo[sizes[todo] > at]
        if at >= LONG:
            for i in todo.tolist():
                h[i] = xxhash.xxh3_64_intdigest(low[starts[i] : ends[i]].tobytes())
            break
    return h, np.searchsorted(starts, off)
