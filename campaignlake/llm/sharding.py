"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0 to n - 1 in the order of their ids. A Feistel network is a bijection of the numbers
below 2**bits whatever its round function is; walking along its cycles until a number below n comes makes
it one of 0 to n - 1. The permuted number decides everything: its remainder by the shard count is the
shard, its quotient the slot. So shards differ by one row at most, slots have no gaps, any row's place can
be computed from its number alone, and the inverse names the row at a place. Nothing is drawn at random:
the order follows from the ids, the row count and the seed, not from files, partitions or cores.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from campaignlake.operators.scan import ordered_scan

from .common import NO_ID, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 20240229
ROUNDS = 8

# Odd multipliers of the round function, below 2**63.
FIRST_FACTOR = 0x1E3779B97F4A7C15
SECOND_FACTOR = 0x3F58476D1CE4E5B9


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """64-bit keys, one for each round, from the seed."""
    keys, state = [], seed
    for _ in range(rounds):
        state = (state * 0x5851F42D4C957F2D + 0x14057B7EF767814F) % 2**64
        keys.append(state ^ (state >> 31))
    return keys


class Permutation:
    """Bijection of 0 to n - 1 and its inverse, on numpy arrays of numbers."""

    def __init__(self, n: int, seed: int = SEED):
        self.n, self.keys = int(n), round_keys(seed)
        bits = max(2, (self.n - 1).bit_length())
        # Even rounds change the high part, odd rounds the low part.
        self.low = bits // 2
        self.masks = [np.uint64((1 << (bits - self.low)) - 1), np.uint64((1 << self.low) - 1)]

    def _mixed(self, half: np.ndarray, turn: int) -> np.ndarray:
        x = (half ^ np.uint64(self.keys[turn])) * np.uint64(FIRST_FACTOR)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(SECOND_FACTOR)
        return (x ^ (x >> np.uint64(32))) & self.masks[turn % 2]

    def _network(self, x: np.ndarray, turns) -> np.ndarray:
        halves = [x >> np.uint64(self.low), x & self.masks[1]]
        for turn in turns:
            side = turn % 2
            halves[side] = halves[side] ^ self._mixed(halves[1 - side], turn)
        return (halves[0] << np.uint64(self.low)) | halves[1]

    def _walk(self, numbers, turns: list[int]) -> np.ndarray:
        x = np.asarray(numbers).astype(np.uint64)
        if len(x) and int(x.max()) >= self.n:
            raise ValueError(f"numbers must lie below {self.n}")
        x = self._network(x, turns)
        while len(outside := np.flatnonzero(x >= np.uint64(self.n))):
            x[outside] = self._network(x[outside], turns)
        return x.astype(np.int64)

    def forward(self, numbers) -> np.ndarray:
        return self._walk(numbers, list(range(len(self.keys))))

    def backward(self, numbers) -> np.ndarray:
        return self._walk(numbers, list(range(len(self.keys)))[::-1])


def place_of(rows, n: int, shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of row numbers out of n, without any data."""
    place = Permutation(n, seed).forward(rows)
    return place % shards, place // shards


def row_at(shard, slot, n: int, shards: int, seed: int = SEED) -> np.ndarray:
    """The row numbers that stand at places (shard, slot)."""
    return Permutation(n, seed).backward(np.asarray(slot) * shards + np.asarray(shard))


def sharded(
    docs: DataFrame, shards: int = 16, seed: int = SEED, id_column: str = "doc_id", ties: str | None = "text",
) -> DataFrame:
    """All rows and columns of `docs` with `row_number`, `shard` and `slot` (long, int, long).

    Rows are numbered by the id, missing ids first, then by a digest of the column `ties`; rows that repeat
    both are interchangeable and each gets a place of its own. The rows move through one range shuffle
    that a crowded id cannot crowd, as copies of a row spread by their place in the input; pass only the
    columns that are needed. Null and empty texts are rows like others, and texts are not read but for the
    digest. An empty table gives no rows. Columns that are already called like one of the three are replaced.
    """
    if shards < 1:
        raise ValueError("There must be one shard at least.")
    digest = F.xxhash64(F.col(ties)) if ties else F.lit(0).cast("long")
    kept = [c for c in docs.columns if c not in ("row_number", "shard", "slot")]
    stored = materialize(
        docs.select(
            F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("key"), digest.alias("tie"),
            F.monotonically_increasing_id().alias("place"), F.lit(1).cast("long").alias("one"),
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        ),
        "numbered",
    )
    n = stored.count()
    numbered = ordered_scan(stored, ["key", "tie", "place"], sums=["one"])
    if not n:
        return numbered.select(
            "row.*", F.col("one").alias("row_number"), F.lit(0).alias("shard"), F.col("one").alias("slot"))

    def run(batches):
        permutation = Permutation(n, seed)
        for batch in batches:
            rows = batch.column(0).to_numpy() - 1
            place = permutation.forward(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array((place % shards).astype(np.int32)), pa.array(place // shards), batch.column(1)],
                names=["row_number", "shard", "slot", "row"],
            )

    schema = StructType.fromDDL("row_number long, shard int, slot long").add(stored.schema["row"])
    placed = numbered.select("cum_one", "row").mapInArrow(run, schema)
    return placed.select("row.*", "row_number", "shard", "slot")


def write_shards(
    docs: DataFrame, path: str, shards: int = 16, seed: int = SEED, id_column: str = "doc_id", ties: str | None = "text",
) -> None:
    """Write the rows as folders `shard=k` under `path`, whose files hold runs of slots in order.

    A shard spans many tasks and files, as large as they may be.
    """
    placed = sharded(docs, shards, seed, id_column, ties)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def report(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """One row per document: its size in bytes and one, the text's crc32, and its place under the law `rows`.

    A missing text has no bytes: size 1, crc32 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("digest"),
    )
    placed = sharded(rows, shards, seed, ties="digest")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
