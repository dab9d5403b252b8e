"""SQL fragments shared by the SQL counterparts of the queries."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: One row with the 256 steps of a byte-wise CRC-32 (reversed polynomial 0xEDB88320) as list ``t``; named ``crc``.
CRC_TABLE = ("crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), "
             "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))")


def crc32(text: str, table: str = "t") -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text; ``crc`` must be in scope."""
    digits = f"hex(encode({text}))"
    values = f"list_transform(range(CAST(length({digits}) // 2 AS BIGINT)), lambda i: CAST('0x' || substr({digits}, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {values}), lambda c, v: xor(c >> 8, {table}[(xor(c, v) & 255) + 1])), 4294967295)"


def low(text: str) -> str:
    """A-Z lower-cased."""
    return f"translate({text}, '{UPPER}', '{LOWER}')"
