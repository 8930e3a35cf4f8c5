"""CRC-32C of many byte strings at once, and its masked form in length-delimited records."""

from __future__ import annotations

import numpy as np

_POLYNOMIAL = 0x82F63B78  # fixed value: the reflected Castagnoli polynomial
_MASK_DELTA = 0xA282EAD8  # fixed value: of the record format
_LANE = 256  # bytes that are summed side by side
_SHORT = 16  # bytes below which an item is summed by itself


def _table16() -> np.ndarray:
    """The remainder of each 16-bit value."""
    crc = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(_POLYNOMIAL), crc >> 1)
    return crc.astype(np.uint32)


_TABLE = _table16()
# The remainder of each byte, for items that are not worth a lane.
_BYTE = [int(_TABLE[b << 8]) for b in range(256)]


def _after_zeros(crc: np.ndarray, length: int) -> np.ndarray:
    for _ in range(length // 2):
        crc = _TABLE[crc & 0xFFFF] ^ (crc >> 16)
    return crc


# What a remainder becomes after a lane of zeros, by its low and its high half.
_LOW = _after_zeros(np.arange(1 << 16, dtype=np.uint32), _LANE).tolist()
_HIGH = _after_zeros(np.arange(1 << 16, dtype=np.uint32) << 16, _LANE).tolist()


def short_crc32c(data: bytes) -> int:
    """CRC-32C of a few bytes, one by one."""
    crc = 0xFFFFFFFF
    for byte in data:
        crc = _BYTE[(crc ^ byte) & 0xFF] ^ (crc >> 8)
    return crc ^ 0xFFFFFFFF


def crc32c(items: list[bytes]) -> list[int]:
    """CRC-32C of each item.

    Remainders are linear: zeros in front change nothing, and starting at all ones is the same
    as flipping the first 32 bits. So items are padded in front to whole lanes, all lanes are
    summed in step, and the lanes of an item are folded in order.
    """
    lanes = [-(-len(x) // _LANE) if len(x) >= _SHORT else 0 for x in items]
    buffer = np.zeros(sum(lanes) * _LANE, np.uint8)
    end = 0
    for item, count in zip(items, lanes):
        end += count * _LANE
        if count:
            start = end - len(item)
            buffer[start:end] = np.frombuffer(item, np.uint8)
            buffer[start : start + 4] ^= 0xFF
    steps = np.ascontiguousarray(buffer.view("<u2").reshape(-1, _LANE // 2).T)
    crc = np.zeros(steps.shape[1], np.uint32)
    low = np.empty(len(crc), np.uint16)
    for step in steps if len(crc) else ():
        np.bitwise_xor(crc.astype(np.uint16), step, out=low)
        crc >>= np.uint32(16)
        crc ^= _TABLE.take(low)
    sums = iter(crc.tolist())
    found = []
    for item, count in zip(items, lanes):
        total = 0
        for _ in range(count):
            total = _LOW[total & 0xFFFF] ^ _HIGH[total >> 16] ^ next(sums)
        found.append(total ^ 0xFFFFFFFF if count else short_crc32c(item))
    return found


def masked(crcs: list[int]) -> list[int]:
    """Sums that are stored beside data which may itself hold sums are rotated and shifted."""
    return [(((c >> 15) | (c << 17)) + _MASK_DELTA) & 0xFFFFFFFF for c in crcs]
