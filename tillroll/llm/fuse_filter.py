"""Static 3-wise binary fuse filters over 64-bit keys, in numpy.

A filter is built once from an immutable key set, answers "maybe" for every key
of the set, and "maybe" for about 1 in 256 other keys. It takes about 9 bits a
key for large sets. Keys are peeled in rounds: every slot that holds one key
only gives up that key, all such slots at once.
"""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = struct.Struct("<QIII")
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_S32, _S33, _S18 = np.uint64(32), np.uint64(33), np.uint64(18)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    h ^= h >> _S33
    h *= _MIX[0]
    h ^= h >> _S33
    h *= _MIX[1]
    return h ^ (h >> _S33)


def _slots(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    """Three slots a key, in three neighbouring segments."""
    base = ((h >> _S32) * np.uint64(segments * length)) >> _S32
    mask = np.uint64(length - 1)
    out = np.empty((3, len(h)), np.int64)
    out[0] = base
    out[1] = (base + np.uint64(length)) ^ ((h >> _S18) & mask)
    out[2] = (base + np.uint64(2 * length)) ^ (h & mask)
    return out


def _prints(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> _S32)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """The filter of ``keys`` (uint64, repeats allowed), as bytes."""
    keys = np.unique(np.asarray(keys, np.uint64))
    n = len(keys)
    if n == 0:
        return b""
    length = 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25))) if n > 1 else 4
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, -(-int(round(n * factor)) // length) - 2)
    size = (segments + 2) * length
    rng = np.random.default_rng(n)
    while True:
        seed = int(rng.integers(1, 2 ** 63))
        with np.errstate(over="ignore"):
            h = _mix(keys, seed)
            slots = _slots(h, length, segments)
        order = _peel(slots, size)
        if order is not None:
            break
    table = np.zeros(size, np.uint8)
    prints = _prints(h)
    for who, at in reversed(order):
        s = slots[:, who]
        # The slot itself is still 0, so the three together give the other two.
        table[at] = prints[who] ^ table[s[0]] ^ table[s[1]] ^ table[s[2]]
    return _HEAD.pack(seed, length, segments, n) + table.tobytes()


def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    n = slots.shape[1]
    count = np.bincount(slots.ravel(), minlength=size)
    who = np.bincount(slots.ravel(), np.tile(np.arange(n, dtype=np.float64), 3), size).astype(np.int64)
    alone, order, left = np.flatnonzero(count == 1), [], n
    while len(alone):
        key, first = np.unique(who[alone], return_index=True)
        at = alone[first]
        order.append((key, at))
        left -= len(key)
        touched = slots[:, key].ravel()
        np.subtract.at(count, touched, 1)
        np.subtract.at(who, touched, np.tile(key, 3))
        touched = np.unique(touched)
        alone = touched[count[touched] == 1]
    return order if left == 0 else None


def contains(filter_bytes: bytes | None, keys: np.ndarray) -> np.ndarray:
    """True where a key may be in the set; False only where it is not."""
    keys = np.asarray(keys, np.uint64)
    if not filter_bytes:
        return np.zeros(len(keys), bool)
    seed, length, segments, _ = _HEAD.unpack_from(filter_bytes)
    table = np.frombuffer(filter_bytes, np.uint8, offset=_HEAD.size)
    with np.errstate(over="ignore"):
        h = _mix(keys, seed)
        s = _slots(h, length, segments)
    return table[s[0]] ^ table[s[1]] ^ table[s[2]] == _prints(h)
