"""Near-duplicate documents by b-bit MinHash.

Signing keeps `bits` low bits of each minimum, packed into longs, and the band keys. Documents that
share a band key are candidates; the share of equal packed minima, corrected for the chance that
different minima end in the same bits, ranks and prunes them. What is left is confirmed on the full
shingle sets. Exact copies (equal sets) are one class and are signed into the buckets once.

Only components are asked for, so a pair whose documents are already connected needs no test. Tests
therefore run in rounds: in the first, every document of a bucket meets the bucket's leader and tests
its most similar leader; in the next ones, only pairs across components are listed, the most similar
few of each document first, and in the last all that remain. A large group of copies collapses in the
first rounds instead of becoming all its pairs, and no link between components stays untested. What the
rounds list is cut further by an exact bound: shingles that no other document of the open buckets has
cannot be common to two documents, which rules out the partners of heavily edited copies.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .common import NO_ID, grouped, materialize, parallel, row_key, worker_state
from .components import components
from .hashing import WordHasher, mix, runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HASHES, BITS = 512, 4
BANDS, BAND_ROWS = 32, 4
# An estimate may fall short of the threshold by this much, five standard deviations at 0.8.
MARGIN = 0.092
# Members of a bucket that one task compares with each other; larger buckets are cut into tiles.
TILE = 2048

SIGNED = "doc_id long, key_text long, n_shingles long, set_a long, set_b long, signature array<long>, bands array<long>"


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; shorter texts are one shingle, wordless ones none."""
    hasher = worker_state("words lower", lambda: WordHasher(True))
    _, _, _, words, bounds = hasher.split(texts)
    shingles = runs(words, size)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(shingles[a : b - size + 1]))
        elif b > a:
            out.append(runs(words[a:b], b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minima of each of some nonempty sets."""
    rng = np.random.default_rng(7)
    factors = rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 2**63, HASHES, dtype=np.uint64)
    joined = np.concatenate(sets)
    at = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), HASHES), dtype=np.uint64)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(joined * factors[k] + offsets[k], at)
    return out


def _pack(minima: np.ndarray) -> np.ndarray:
    """The low bits of the minima, 64 // BITS of them in a long."""
    low = (mix(minima) & np.uint64((1 << BITS) - 1)).reshape(len(minima), -1, 64 // BITS)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.reshape(-1).view(np.int64))
    )


def sign(docs: DataFrame, shingle: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Set size, set digest, packed signature and band keys of every document."""
    def signed(texts):
        sets = shingle_sets(texts, shingle)
        full = [s for s in sets if len(s)]
        digests = np.array([[_digest(s, 3), _digest(s, 5)] for s in sets], dtype=np.uint64).reshape(-1, 2)
        width = HASHES * BITS // 64
        packed, bands = np.zeros((len(sets), width), np.uint64), np.zeros((len(sets), BANDS), np.uint64)
        if full:
            minima, has = _minima(full), np.array([len(s) > 0 for s in sets])
            packed[has] = _pack(minima)
            rows = minima[:, : BANDS * BAND_ROWS].reshape(len(full), BANDS, BAND_ROWS)
            keys = np.zeros((len(full), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for k in range(BAND_ROWS):
                keys = mix(keys ^ rows[:, :, k])
            bands[has] = keys
        yield [len(s) for s in sets], digests, packed, bands

    def run(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            at = 0
            for sizes, digests, packed, bands in grouped(signed, texts, 1_000_000):
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, n), keys.slice(at, n), pa.array(sizes, pa.int64()), pa.array(digests[:, 0].view(np.int64)),
                     pa.array(digests[:, 1].view(np.int64)), _lists(packed), _lists(bands)],
                    names=["doc_id", "key_text", "n_shingles", "set_a", "set_b", "signature", "bands"],
                )
                at += n

    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(F.col(text_column)).alias("key_text"),
        F.col(text_column).cast("binary").alias("text"))
    return source.mapInArrow(run, SIGNED)


def _digest(values: np.ndarray, salt: int) -> int:
    """Hash of a sorted set; two of them name the set."""
    places = np.arange(1, len(values) + 1, dtype=np.uint64) * np.uint64(2 * salt + 1)
    return int(mix(np.array([mix(values * np.uint64(2 * salt + 7) + places).sum(dtype=np.uint64) + np.uint64(len(values))]))[0])


def estimate(a: Column, b: Column) -> Column:
    """Similarity estimated from two packed signatures, corrected for chance collisions."""
    def unequal(x: Column, y: Column) -> Column:
        diff = x.bitwiseXOR(y)
        for step in (1, 2)[: BITS.bit_length() - 1]:
            diff = diff.bitwiseOR(F.shiftrightunsigned(diff, step))
        every = int("1".rjust(BITS, "0") * (64 // BITS), 2)
        return F.bit_count(diff.bitwiseAND(F.lit(every)))

    total = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    return ((1 - total / F.lit(float(HASHES))) - chance) / (1 - chance)


def _best_pairs(rows, width: int, percent: int):
    """From the members of one tile: each one's most similar members of other components.

    `rows` has columns rep, label, side (0 both, 1 left, 2 right), key (the bucket), signature, bands,
    n_shingles and common (how many of them others have too). Compares every member that is not of the
    tile's largest component with all others. A pair that shares several buckets is listed in the first.
    """
    reps, sizes, common = rows["rep"].to_numpy(), rows["n_shingles"].to_numpy(), rows["common"].to_numpy()
    least = percent / 100 - MARGIN
    labels, side = rows["label"].to_numpy(), rows["side"].to_numpy()
    packed = np.stack([np.asarray(x, dtype=np.int64) for x in rows["signature"]]).view(np.uint64)
    keys = np.stack([np.asarray(x, dtype=np.int64) for x in rows["bands"]])
    own = int(np.flatnonzero(keys[0] == rows["key"].iloc[0])[0])
    values, counts = np.unique(labels, return_counts=True)
    main = values[counts.argmax()]
    every = np.uint64(int("1".rjust(BITS, "0") * (64 // BITS), 2))
    chance = 2.0**-BITS
    out = []
    for i in np.flatnonzero(labels != main):
        other = labels != labels[i]
        if side[i]:
            other &= side != side[i]
        if own:
            other &= ~(keys[:, :own] == keys[i, :own]).any(axis=1)
        most = np.minimum(common, common[i])
        other &= 100 * most >= percent * (sizes + sizes[i] - most)
        j = np.flatnonzero(other)
        if not len(j):
            continue
        diff = packed[j] ^ packed[i]
        for step in (1, 2)[: BITS.bit_length() - 1]:
            diff |= diff >> np.uint64(step)
        share = 1 - np.bitwise_count(diff & every).sum(axis=1) / HASHES
        near = (share - chance) / (1 - chance)
        good = np.flatnonzero(near >= least)
        if width and len(good) > width:
            good = good[np.lexsort((reps[j[good]], -near[good]))[:width]]
        for k in good:
            a, b = int(reps[i]), int(reps[j[k]])
            out.append((min(a, b), max(a, b)))
    return out


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, rep, label, tiles) of the buckets that hold several components."""
    named = members.join(labels, members["rep"] == labels["vertex"], "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("label")
    )
    mixed = named.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")
    ).where("low < high").select("key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    return materialize(named.join(mixed, "key"), "open")


def _common_counts(opened: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep, common): how many shingles of each document another document of the open buckets has too."""
    listed = sets.join(opened.select("rep").distinct(), "rep").select("rep", F.explode("items").alias("item"))
    single = listed.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("rep")).where("n = 1")
    own = single.groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    sizes = sets.select("rep", F.size("items").alias("n"))
    return sizes.join(own, "rep", "left").select("rep", (F.col("n") - F.coalesce("own", F.lit(0))).alias("common"))


def _across(opened: DataFrame, signatures: DataFrame, width: int, percent: int) -> DataFrame:
    """Candidate pairs (a, b) across components within the buckets, at most `width` per member and tile (0: all)."""
    tiled = opened.join(signatures, "rep").select(
        "key", "rep", "label", "signature", "bands", "n_shingles", "common", "tiles",
        F.expr("int(pmod(xxhash64(rep), tiles))").alias("own")
    )
    # A tile is a pair of slices of a bucket; a member goes to the tiles of its own slice.
    spread = tiled.select(
        "key", "rep", "label", "signature", "bands", "n_shingles", "common", "own",
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"),
    ).select(
        "key", "rep", "label", "signature", "bands", "n_shingles", "common",
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
    )

    def run(batches):
        import pandas as pd

        held, current = [], None

        def flush():
            rows = pd.concat(held) if len(held) > 1 else held[0]
            if len(rows) > 1:
                yield from _best_pairs(rows.reset_index(drop=True), width, percent)

        def emit(pairs):
            if pairs:
                a, b = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            frame, pairs = batch.to_pandas(), []
            tile = frame["tile"].to_numpy()
            cuts = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist(), len(tile)]
            for x, y in zip(cuts, cuts[1:]):
                if y == x:
                    continue
                if held and tile[x] != current:
                    pairs.extend(flush())
                    held = []
                current = tile[x]
                held.append(frame.iloc[x:y])
            yield from emit(pairs)
        if held:
            yield from emit(list(flush()))

    placed = spread.repartition(parallel(opened.sparkSession), "tile").sortWithinPartitions("tile", "rep")
    return placed.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Component of every document under links of Jaccard similarity >= percent / 100 on word shingles.

    Returns doc_id, n_shingles, component_id (smallest reachable id), kept (it is its own component's
    smallest) and key_text (hash of the text, see `row_key`), one row per input row. Texts compare lower-cased (A-Z) by words; a null, empty or wordless
    text has the empty set and links with nothing, and a text of fewer words than a shingle is one
    shingle. Rows that repeat an id and text share one result. A row without an id links with nothing:
    its component_id is null and it is kept. Other columns are not read. An empty table gives no rows.
    """
    signed = materialize(sign(docs, shingle, id_column, text_column), "signed")
    real = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"))
    chosen = real.join(classes.select("set_a", "set_b", F.col("rep").alias("doc_id")), ["doc_id", "set_a", "set_b"])
    # An id may stand for several rows; a class then still has one signature.
    reps = materialize(
        chosen.select(F.col("doc_id").alias("rep"), "set_a", "set_b", "n_shingles", "signature", "bands")
        .dropDuplicates(["set_a", "set_b"]), "classes",
    )
    reps = reps.select(F.xxhash64("set_a", "set_b").alias("class"), "*")

    buckets = reps.select(F.explode("bands").alias("key"), F.col("class").alias("rep"))
    # A bucket's leader differs from band to band, so that a document meets several members of its group.
    shared = buckets.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("key", "rep").alias("h"), "rep"))["rep"].alias("leader")
    ).where("n > 1")
    members = materialize(buckets.join(shared, "key").select("key", "rep", "leader"), "members")
    signatures = reps.select(F.col("class").alias("rep"), "signature", "bands", "n_shingles")

    # Sets of the documents in shared buckets, the only ones that may have a link.
    wanted = members.select("rep").distinct().join(
        reps.select(F.col("class").alias("rep"), F.col("rep").alias("doc_id")), "rep"
    )
    sets = materialize(_sets(docs, wanted, shingle, id_column, text_column), "sets")

    least = percent / 100 - MARGIN
    left, right = signatures.select(F.col("rep"), F.col("signature").alias("s1")), signatures.select(
        F.col("rep").alias("leader"), F.col("signature").alias("s2"))
    met = members.where("rep <> leader").select("rep", "leader").distinct().join(left, "rep").join(right, "leader")
    first = met.select("rep", "leader", estimate(F.col("s1"), F.col("s2")).alias("near")).where(F.col("near") >= least)
    best = first.groupBy("rep").agg(F.max(F.struct("near", "leader")).alias("x")).select(
        F.least("rep", "x.leader").alias("a"), F.greatest("rep", "x.leader").alias("b")).distinct()

    tested = materialize(best, "pairs")
    links = materialize(_confirm(tested, sets, percent), "confirmed")
    labels = components(links, "a", "b")
    common = None
    for width in (4, 0):
        opened = _open_buckets(members, labels)
        if opened.isEmpty():
            break
        if common is None:  # later rounds open no further buckets
            common = materialize(_common_counts(opened, sets), "common")
        pairs = _across(opened, signatures.join(common, "rep"), width, percent).join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        found = materialize(_confirm(pairs, sets, percent), "confirmed")
        tested = tested.union(pairs)
        if not found.isEmpty():
            labels = components(labels.select(F.col("vertex").alias("a"), F.col("component").alias("b")).union(found), "a", "b")

    # From the smallest class to the smallest document of each component.
    ids = reps.select(F.col("class"), "set_a", "set_b", F.col("rep").alias("doc"))
    named = ids.join(labels, ids["class"] == labels["vertex"], "left").select(
        "set_a", "set_b", "doc", F.coalesce("component", "class").alias("component"))
    lowest = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    by_set = named.join(lowest, "component").select("set_a", "set_b", "component_id")
    found = signed.where("n_shingles > 0").join(by_set, ["set_a", "set_b"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        "key_text")
    empty = signed.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "key_text")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.union(empty).select("doc_id", "n_shingles", "component_id", kept, "key_text")


def deduplicated(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps, all columns unchanged.

    One document of each component stays. Rows that repeat an id and text are one document, of which one
    row stays; a missing id counts as an id here.
    """
    found = near_duplicates(docs, shingle, percent, id_column, text_column)
    kept = found.where("kept").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("key_id"), "key_text").distinct()
    taken = docs.columns
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in taken]).alias("row"), *row_key(id_column, text_column))
    # The join places rows by key, so dropping repeated rows needs no further shuffle.
    once = keyed.join(kept, ["key_id", "key_text"]).dropDuplicates(["key_id", "key_text"])
    return once.select(*[F.col("row")[c].alias(c) for c in taken])


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int, id_column: str, text_column: str) -> DataFrame:
    """(rep, items): the full shingle set of each wanted class, read from its document."""
    def run(batches):
        for batch in batches:
            at = 0
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for size, sets in grouped(lambda run: [(len(run), shingle_sets(run, shingle))], texts, 1_000_000):
                ends = np.cumsum([0, *[len(s) for s in sets]]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                sums = np.array([[_digest(s, 3), _digest(s, 5)] for s in sets], dtype=np.uint64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").slice(at, size), pa.array(sums[:, 0].view(np.int64)),
                     pa.array(sums[:, 1].view(np.int64)), items], names=["rep", "set_a", "set_b", "items"])
                at += size

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    # Rows that repeat an id and text count once; the rows are already placed by id.
    once = source.join(wanted, "doc_id").withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "rep", "h"])
    read = once.select("rep", "text").mapInArrow(run, "rep long, set_a long, set_b long, items array<long>")
    # An id that stands for several texts brings others along; the digest tells which is meant.
    return read.where(F.xxhash64("set_a", "set_b") == F.col("rep")).select("rep", "items")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a, b = sets.select(F.col("rep").alias("a"), F.col("items").alias("x")), sets.select(
        F.col("rep").alias("b"), F.col("items").alias("y"))
    common, x, y = F.size(F.array_intersect("x", "y")), F.size("x"), F.size("y")
    sized = pairs.join(a, "a").join(b, "b").where(100 * F.least(x, y) >= percent * F.greatest(x, y))
    return sized.where(100 * common >= percent * (x + y - common)).select("a", "b")
