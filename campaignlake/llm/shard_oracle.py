"""DuckDB statement of the sharding query: crc32 by its table, the Feistel network round by round."""

from __future__ import annotations

from .sharding import FIRST_FACTOR, SECOND_FACTOR, SEED, round_keys

# The table of the reflected polynomial 0xEDB88320, as a list from index 1.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda x, step: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i))"""


def crc32(text: str, digits: str) -> str:
    """The unsigned crc32 of a string; `digits` is hex(string), and `t` must be in scope."""
    octets = f"list_transform(range(1, strlen({text}) + 1), lambda i: ('0x' || {digits}[2 * i - 1 : 2 * i])::BIGINT)"
    rounds = f"list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda x, b: xor(x >> 8, t[xor(x & 255, b) + 1]))"
    return f"xor(4294967295, {rounds})"


_WORD = f"{2**64}::HUGEINT"


def _network(source: str) -> str:
    """`source`, holding (doc_id, x, low, top_mask, low_mask), with all rounds applied to x."""
    step = f"SELECT doc_id, low, top_mask, low_mask, x >> low AS a, x & low_mask AS b FROM {source}"
    for turn, key in enumerate(round_keys(SEED)):
        changed, kept, mask = ("a", "b", "top_mask") if turn % 2 == 0 else ("b", "a", "low_mask")
        step = f"""SELECT doc_id, low, top_mask, low_mask, {kept}, xor({changed}, xor(z, z >> 32) & {mask}) AS {changed}
          FROM (SELECT *, xor(y, y >> 29) * {SECOND_FACTOR}::HUGEINT % {_WORD} AS z
                FROM (SELECT *, xor({kept}, {key}::HUGEINT) * {FIRST_FACTOR}::HUGEINT % {_WORD} AS y FROM ({step})))"""
    return f"SELECT doc_id, (a << low) | b AS x, low, top_mask, low_mask FROM ({step})"


OP11 = f"""
WITH RECURSIVE {CRC_TABLE},
texts AS (SELECT doc_id, coalesce(text, '') AS s, hex(coalesce(text, '')) AS digits FROM documents),
measured AS (
  SELECT doc_id, (strlen(s) + 1)::BIGINT AS size, ({crc32("s", "digits")})::BIGINT AS text_crc32 FROM texts, crc_table),
total AS (SELECT count(*) AS n, greatest(2, ceil(log2(count(*)))::INTEGER) AS bits FROM documents),
numbered AS (
  SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::HUGEINT AS x, (bits // 2)::HUGEINT AS low,
         (1::HUGEINT << (bits - bits // 2)::HUGEINT) - 1 AS top_mask, (1::HUGEINT << (bits // 2)::HUGEINT) - 1 AS low_mask
  FROM documents, total),
walk AS (
  {_network("numbered")}
  UNION ALL
  {_network("(SELECT walk.* FROM walk, total WHERE x >= n)")})
SELECT m.doc_id, size, text_crc32, 'rows' AS law, (x % 16)::INTEGER AS shard, (x // 16)::BIGINT AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM measured m JOIN walk w ON m.doc_id = w.doc_id, total WHERE x < n
"""
