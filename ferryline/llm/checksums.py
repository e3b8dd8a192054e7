"""Statements that the SQL of several queries shares."""

# CRC-32 by a table of its 256 remainders, for texts of ASCII characters.
CRC_TABLE = """
crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        [i] || list_transform(range(8), lambda k: 0::BIGINT),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""


def crc32(text: str) -> str:
    """The check sum of a SQL text, unsigned; the statement reads t of crc_table."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {step}), 4294967295)"
