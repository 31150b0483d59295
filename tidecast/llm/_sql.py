"""Pieces of DuckDB SQL that several oracles share."""

#: A table expression (one row, one list) of crc32's 256 values, made from its polynomial.
CRC_TABLE = """crc AS (SELECT list(v ORDER BY b) AS crc_table FROM (
  SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256))::BIGINT AS b)))"""


def crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of ``text`` (an expression), where ``crc`` is joined."""
    code = f"hex(encode({text}))"
    byte = f"list_transform(range(length({code}) // 2), lambda i: (strpos('0123456789ABCDEF', substr({code}, 2 * i + 1, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr({code}, 2 * i + 2, 1)) - 1)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"
