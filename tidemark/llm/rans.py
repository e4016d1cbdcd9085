"""Static range asymmetric numeral system over token ids, with numpy across lanes.

A segment holds one frequency table and blocks that decode on their own. The tokens of a block are
dealt out to lanes; all lanes of all blocks step together. The states with which a block's decoder
starts are its checkpoint, and a checksum of its ids guards it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 32
STEPS = 1024
BLOCK = LANES * STEPS
#: States stay at or above 2**31 and below 2**63; words of 32 bits are moved out and in.
_LOW = np.uint64(31)
_WORD = np.uint64(32)
_MAX_ID = 1 << 24
_HEAD = struct.Struct("<4sIIIQ")
_MAGIC = b"RNS1"


def frequencies(counts: np.ndarray, bits: int) -> np.ndarray:
    """Shares of 2**bits in proportion to ``counts``, at least one each."""
    whole = 1 << bits
    shares = np.maximum(1, counts.astype(np.float64) * (whole / counts.sum())).astype(np.int64)
    over = int(shares.sum()) - whole
    for i in np.argsort(-shares, kind="stable"):
        if over == 0:
            break
        change = min(over, int(shares[i]) // 2) if over > 0 else over
        shares[i] -= change
        over -= change
    return shares


def encode(ids: np.ndarray) -> bytes:
    """One segment: head, table, checkpoints, checksums and streams of all blocks."""
    n = len(ids)
    if n == 0:
        return _HEAD.pack(_MAGIC, 0, 0, 0, 0)
    if int(ids.max()) >= _MAX_ID:
        raise ValueError(f"ids must be below {_MAX_ID}")
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    bits = max(12, int(len(symbols) - 1).bit_length() + 3)
    shares = frequencies(counts[symbols], bits)
    place = np.zeros(len(counts), dtype=np.int32)
    place[symbols] = np.arange(len(symbols), dtype=np.int32)
    blocks = -(-n // BLOCK)
    dense = np.full(blocks * BLOCK, int(np.argmax(shares)), dtype=np.int32)
    dense[:n] = place[ids]
    steps = STEPS if blocks > 1 else -(-n // LANES)
    dense = dense.reshape(blocks, STEPS, LANES)[:, :steps].transpose(1, 0, 2).reshape(steps, blocks * LANES)
    share = shares.astype(np.uint64)
    below = np.concatenate(([0], np.cumsum(shares)[:-1])).astype(np.uint64)
    limit = share << np.uint64(63 - bits)
    state = np.full(blocks * LANES, 1 << 31, dtype=np.uint64)
    words = np.empty((steps, blocks * LANES), dtype=np.uint32)
    moved = np.empty((steps, blocks * LANES), dtype=bool)
    shift = np.uint64(bits)
    for t in range(steps - 1, -1, -1):
        s = dense[t]
        f = share[s]
        out = state >= limit[s]
        words[t] = state.astype(np.uint32)
        moved[t] = out
        state = np.where(out, state >> _WORD, state)
        times = state // f
        state = (times << shift) + (state - times * f) + below[s]
    by_block = moved.reshape(steps, blocks, LANES).transpose(1, 0, 2)
    stream = words.reshape(steps, blocks, LANES).transpose(1, 0, 2)[by_block]
    lengths = by_block.sum(axis=(1, 2)).astype("<u4")
    sums = np.array([zlib.crc32(ids[b * BLOCK : (b + 1) * BLOCK].astype("<u4")) for b in range(blocks)], dtype="<u4")
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + shares.astype("<u4").tobytes(), 1)
    return b"".join(
        (
            _HEAD.pack(_MAGIC, bits, len(symbols), len(table), n),
            table,
            lengths.tobytes(),
            sums.tobytes(),
            state.astype("<u8").tobytes(),
            stream.astype("<u4").tobytes(),
        )
    )


def decode(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (excluded; all by default), checked against their sums."""
    magic, bits, size, table, n = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a segment")
    if n == 0:
        return np.empty(0, dtype=np.uint32)
    blocks = -(-n // BLOCK)
    last = blocks if last is None else min(last, blocks)
    if not 0 <= first < last:
        return np.empty(0, dtype=np.uint32)
    steps = STEPS if blocks > 1 else -(-n // LANES)
    at = _HEAD.size
    both = np.frombuffer(zlib.decompress(data[at : at + table]), dtype="<u4")
    symbols, shares = np.cumsum(both[:size], dtype=np.int64).astype(np.uint32), both[size:]
    at += table
    lengths = np.frombuffer(data, "<u4", blocks, at).astype(np.int64)
    sums = np.frombuffer(data, "<u4", blocks, at + 4 * blocks)
    state = np.frombuffer(data, "<u8", blocks * LANES, at + 8 * blocks).reshape(blocks, LANES)[first:last].copy()
    at += 8 * blocks + 8 * blocks * LANES
    ends = np.cumsum(lengths)
    stream = np.frombuffer(data, "<u4", int(ends[-1]), at)
    pointer = (ends - lengths)[first:last].copy()
    share = shares.astype(np.uint64)
    below = np.concatenate(([0], np.cumsum(shares, dtype=np.int64)[:-1])).astype(np.uint64)
    slots = np.repeat(np.arange(size, dtype=np.uint32), shares)
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    out = np.empty((steps, last - first, LANES), dtype=np.uint32)
    for t in range(steps):
        slot = state & mask
        s = slots[slot.astype(np.int64)]
        out[t] = s
        state = share[s] * (state >> shift) + slot - below[s]
        need = (state >> _LOW) == 0
        taken = np.cumsum(need, axis=1)
        # a damaged stream may ask for more than there is; its checksum tells
        where = np.minimum(pointer[:, None] + taken, len(stream)) - 1
        state[need] = (state[need] << _WORD) | stream[where[need]].astype(np.uint64)
        pointer += taken[:, -1]
    ids = symbols[out.transpose(1, 0, 2).reshape(last - first, steps * LANES)]
    ids = ids.reshape(-1)[: min(n, last * BLOCK) - first * BLOCK]
    for b in range(first, last):
        if zlib.crc32(ids[(b - first) * BLOCK : (b - first + 1) * BLOCK].astype("<u4")) != sums[b]:
            raise ValueError(f"block {b} is damaged")
    return ids
