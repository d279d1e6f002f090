"""Vectorised work on the UTF-8 bytes of Arrow string columns: spans, hashes, shingles.

All functions see one flat byte array for many documents. A span never crosses a document. Equal spans have equal
hashes everywhere; different ones have the same 64-bit hash by chance alone, about once in 2**64 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: An odd multiplier and the finaliser's constants (fixed values).
BASE = 0x9E3779B97F4A7C15
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
#: Bytes of text that one vectorised step covers; a longer document is a step of its own.
STEP_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Masks of the first bytes of a block, by their number.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def table(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over byte values, true in the inclusive ranges."""
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Words split at blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_BLANK = ~table((0x20, 0x20), (0x09, 0x0D))
#: Words of digits, lower-case letters and everything beyond ASCII.
ALNUM_OR_HIGH = table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def steps(batch: pa.RecordBatch, column: str, step_bytes: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``step_bytes`` of text, each with its flat bytes and document offsets; null is empty."""
    if not batch.num_rows:
        return
    text = batch.column(batch.schema.get_field_index(column))
    text = pc.fill_null(text.cast(pa.large_string()), "")
    lengths = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + step_bytes, side="right")))
        part = text.slice(at, to - at)
        offsets = np.frombuffer(part.buffers()[1], dtype=np.int64, count=len(part) + 1, offset=8 * part.offset)
        data = part.buffers()[2]
        flat = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        yield batch.slice(at, to - at), flat, offsets - offsets[0]
        at = to


def spans(flat: np.ndarray, offsets: np.ndarray, inside: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-document offsets of the maximal runs of ``inside`` bytes; ``cut[i]`` starts a new run at byte i."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    m = inside[flat]
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[offsets] = True
    fresh[0] = fresh[n] = True
    if cut is not None:
        fresh[:n] |= cut
    joins = np.zeros(n + 1, dtype=bool)
    joins[1:n] = m[:-1] & m[1:] & ~fresh[1:n]
    starts = np.flatnonzero(m & ~joins[:n])
    ends = np.flatnonzero(m & ~joins[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span that isn't empty: the sum of its 8-byte blocks, each mixed with its number, and its length.

    No polynomial of the bytes: those modulo 2**64 give equal values to some words whatever their base."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    count = (size + 7) >> 3
    first = np.cumsum(count) - count
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    blocks = np.ndarray((len(flat) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    if int(first[-1]) + int(count[-1]) == len(count):  # no span is longer than a block
        number, at, left = np.zeros(len(count), np.int64), starts, size
    else:
        number = np.arange(int(first[-1] + count[-1])) - np.repeat(first, count)
        at = np.repeat(starts, count) + 8 * number
        left = np.repeat(size, count) - 8 * number
    value = blocks[at] & _LOW_BYTES[np.minimum(left, 8)]
    value = mix(mix(value + np.uint64(BASE)) ^ mix((number.astype(np.uint64) + np.uint64(1)) * MIX_B))
    if len(value) > len(count):
        value = np.add.reduceat(value, first)
    return mix(value + size.astype(np.uint64) * np.uint64(BASE))


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words and per-document offsets; a shorter, not empty document is one shingle."""
    n = np.diff(offsets)
    counts = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    out_offsets = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(out_offsets[-1], dtype=np.uint64)
    if len(words) >= width:
        runs = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            runs = runs * np.uint64(BASE) + words[k : k + len(runs)]
        long = np.flatnonzero(n >= width)
        at = np.repeat(offsets[:-1][long] - out_offsets[:-1][long], counts[long]) + _where(out_offsets, long)
        out[_where(out_offsets, long)] = mix(runs[at])
    for d in np.flatnonzero((n > 0) & (n < width)):
        h = int(n[d])
        for w in words[offsets[d] : offsets[d + 1]]:
            h = (h * BASE + int(w)) & (2**64 - 1)
        out[out_offsets[d]] = mix(np.array([h], dtype=np.uint64) ^ np.uint64(n[d]))[0]
    return out, out_offsets


def _where(offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The flat positions of the given rows."""
    counts = np.diff(offsets)[rows]
    if not counts.sum():
        return np.zeros(0, dtype=np.int64)
    firsts = np.repeat(offsets[:-1][rows], counts)
    return firsts + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def ragged(offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat positions of ``rows`` in their order and the offsets of the result."""
    counts = np.diff(offsets)[rows]
    return _where(offsets, rows), np.concatenate([[0], np.cumsum(counts)])
