"""Words of SQL that the operators' SQL shares."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string: its bits, the lowest of a byte first, through the shift register."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda b: list_transform(range(8), lambda k: ((ascii(b) >> k) & 1)::BIGINT)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"
