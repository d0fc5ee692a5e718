"""Pieces of the operators' SQL counterparts (DuckDB)."""

#: A common table expression ``crc_table`` with the 256 entries of the CRC-32 table, by its rule.
CRC_TABLE = """
crc_table as (
  select list_transform(range(0, 256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as entries)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string expression; needs ``crc_table`` among the tables of its query."""
    step = "xor(a >> 8, entries[(xor(a, b) & 255) + 1])"
    codes = f"list_transform(string_split({text}, ''), lambda c: cast(ord(c) as bigint))"
    return f"xor(list_reduce([4294967295::bigint] || {codes}, lambda a, b: {step}), 4294967295::bigint)"
