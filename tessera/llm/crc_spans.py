"""CRC-32 of many byte spans at once by position tables.

CRC-32 is linear: the digest of ``n`` bytes is the XOR of one contribution per byte,
which depends on the byte and its distance from the end alone, and a constant of the
length. ``TABLE[d, b]`` holds the contribution of byte ``b`` with ``d`` bytes behind it,
``ZEROS[n]`` the digest of ``n`` zero bytes, so all spans of up to ``BLOCK`` bytes are one
gather and one ``bitwise_xor.reduceat``. Longer spans are cut into blocks counted from
their end; the blocks' contributions are folded in pairs, level by level, the earlier
block of a pair moved by the bytes of the later one with the tables of ``_moves``.
"""

from __future__ import annotations

import numpy as np

from tessera.llm.token_pieces import ragged

BLOCK = 64
POLYNOMIAL = np.uint32(0xEDB88320)
LEVELS = 48  # spans of up to 2**47 bytes


def _byte_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> np.uint32(1)) ^ (POLYNOMIAL * (out & np.uint32(1)))
    return out


_ONE = _byte_table()


def _one_byte_on(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint32(8)) ^ _ONE[x & np.uint32(255)]


def _move(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    """State ``x`` after the zero bytes that ``tables`` (4 x 256) stand for."""
    out = tables[0][x & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ tables[k][(x >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _move_tables() -> list[np.ndarray]:
    """Tables that move a state by 1, 2, 4, ... zero bytes."""
    units = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
    out = [np.stack([_one_byte_on(u) for u in units])]
    for _ in range(LEVELS - 1):
        out.append(np.stack([_move(out[-1], out[-1][k]) for k in range(4)]))
    return out


_moves = _move_tables()


def _position_table() -> np.ndarray:
    out = np.empty((BLOCK, 256), np.uint32)
    out[0] = _ONE
    for d in range(1, BLOCK):
        out[d] = _one_byte_on(out[d - 1])
    return out


TABLE = _position_table()


def zeros_digest(lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of that many zero bytes: the start value moved over them, then inverted."""
    state = np.full(len(lengths), 0xFFFFFFFF, np.uint32)
    k = 0
    while len(lengths) and int(lengths.max()) >> k:
        on = (lengths >> k) & 1 == 1
        state[on] = _move(_moves[k], state[on])
        k += 1
    return state ^ np.uint32(0xFFFFFFFF)


ZEROS = zeros_digest(np.arange(BLOCK + 1))


def _short(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XOR of the contributions of spans of 1 to ``BLOCK`` bytes."""
    at = ragged(starts, lengths, np.arange(len(starts)))
    first = np.cumsum(lengths) - lengths
    behind = np.repeat(first + lengths - 1, lengths) - np.arange(len(at))
    return np.bitwise_xor.reduceat(TABLE[behind, buf[at]], first) if len(starts) else np.empty(0, np.uint32)


def _folded(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The same for longer spans, by blocks."""
    blocks = -(-lengths // BLOCK)
    span = np.repeat(np.arange(len(starts)), blocks)
    number = np.arange(len(span)) - np.repeat(np.cumsum(blocks) - blocks, blocks)  # 0: last block
    end = (starts + lengths)[span] - BLOCK * number
    begin = np.maximum(end - BLOCK, starts[span])
    state = _short(buf, begin, end - begin)
    level = BLOCK.bit_length() - 1
    while len(state) > len(starts):
        odd = number & 1 == 1
        state[odd] = _move(_moves[level], state[odd])
        number >>= 1
        first = np.flatnonzero((np.diff(span, prepend=-1) != 0) | (np.diff(number, prepend=-1) != 0))
        state, span, number = np.bitwise_xor.reduceat(state, first), span[first], number[first]
        level += 1
    return state


def crc32_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of ``buf[start:end]`` for every span; spans may overlap or be empty."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint32)
    short = (lengths > 0) & (lengths <= BLOCK)
    out[short] = _short(buf, starts[short], lengths[short]) ^ ZEROS[lengths[short]]
    long = lengths > BLOCK
    if long.any():
        out[long] = _folded(buf, starts[long], lengths[long]) ^ zeros_digest(lengths[long])
    return out
