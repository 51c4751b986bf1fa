"""SQL that several oracles share."""

# ``crc(doc_id, crc32)``: the unsigned CRC-32 of each id in decimal, with its table of 256 built by rule.
CRC32 = """
crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc32
  FROM documents, crc_table)
"""
