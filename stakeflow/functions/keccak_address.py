"""Compressed secp256k1 public key to 20-byte account address.

Spark has no Keccak-256 (its SHA-3 differs in padding) and no curve arithmetic,
so this is the one Python helper. It runs as an Arrow-batched UDF over one row
per key; see ``plans.snapshots.validator_addresses``.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# Fixed value: the secp256k1 field prime.
FIELD = 2**256 - 2**32 - 977

_MASK = (1 << 64) - 1
_RATE = 136


def _round_constants() -> list[int]:
    """Iota constants from the LFSR x^8 + x^6 + x^5 + x^4 + 1 of the specification."""
    bits, state = [], 1
    for _ in range(24 * 7):
        bits.append(state & 1)
        state = (state << 1) ^ (0x171 if state & 0x80 else 0)
    return [sum(bits[7 * r + j] << ((1 << j) - 1) for j in range(7)) for r in range(24)]


def _rho_pi_path() -> list[tuple[int, int]]:
    """(lane, rotation) pairs in the order the pi permutation visits lanes."""
    path, x, y = [], 1, 0
    for t in range(24):
        path.append((x + 5 * y, (t + 1) * (t + 2) // 2 % 64))
        x, y = y, (2 * x + 3 * y) % 5
    return path


_IOTA = _round_constants()
_PATH = _rho_pi_path()


def _rotate(lane: int, n: int) -> int:
    return ((lane << n) | (lane >> (64 - n))) & _MASK if n else lane


def _permute(a: list[int]) -> list[int]:
    for iota in _IOTA:
        parity = [a[x] ^ a[x + 5] ^ a[x + 10] ^ a[x + 15] ^ a[x + 20] for x in range(5)]
        flip = [parity[x - 1] ^ _rotate(parity[(x + 1) % 5], 1) for x in range(5)]
        a = [lane ^ flip[i % 5] for i, lane in enumerate(a)]
        moved = a[:]
        for i, (lane, rotation) in enumerate(_PATH):
            moved[_PATH[(i + 1) % 24][0]] = _rotate(a[lane], rotation)
        a = [
            moved[i] ^ (~moved[i - i % 5 + (i + 1) % 5] & moved[i - i % 5 + (i + 2) % 5])
            for i in range(25)
        ]
        a[0] ^= iota
    return a


def keccak256(data: bytes) -> bytes:
    pad = _RATE - len(data) % _RATE
    block = bytearray(data) + bytearray(pad)
    block[len(data)] ^= 0x01
    block[-1] ^= 0x80
    state = [0] * 25
    for at in range(0, len(block), _RATE):
        for i in range(_RATE // 8):
            state[i] ^= int.from_bytes(block[at + 8 * i : at + 8 * i + 8], "little")
        state = _permute(state)
    return b"".join(lane.to_bytes(8, "little") for lane in state[:4])


def address_of(key: str | None) -> str | None:
    """Address of a compressed key, or None for anything that is not one."""
    if not key:
        return None
    try:
        raw = bytes.fromhex(key[2:] if key[:2] in ("0x", "0X") else key)
    except ValueError:
        return None
    if len(raw) != 33 or raw[0] not in (2, 3):
        return None
    x = int.from_bytes(raw[1:], "big")
    square = (pow(x, 3, FIELD) + 7) % FIELD
    y = pow(square, (FIELD + 1) // 4, FIELD)  # the prime is 3 modulo 4
    if y * y % FIELD != square:
        return None
    if y % 2 != raw[0] % 2:
        y = FIELD - y
    return "0x" + keccak256(raw[1:] + y.to_bytes(32, "big"))[-20:].hex()


def address_from_key(key: Column) -> Column:
    """Column form. The module travels by value, so workers need no install."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @F.pandas_udf("string")
    def derive(keys: pd.Series) -> pd.Series:
        return keys.map(address_of, na_action="ignore")

    return derive(key)
