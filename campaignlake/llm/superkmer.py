"""Removal of repeated passages by super-k-mer partitioning.

Every window of `window` words has a minimiser, the smallest hash among its runs of MINIMISER_WORDS
words, and consecutive windows mostly share it: such a stretch is a super-k-mer. Equal windows have
equal minimisers, so a window can only repeat where its minimiser does. The light part of a super-k-mer
(minimiser, document, place) decides which minimisers occur in several documents; only super-k-mers of
those travel on, each as one packed string of its words, to their minimiser's bucket, and there sorting
the windows' texts tells which document holds each first. Buckets of a minimiser that very many
super-k-mers share are not formed: equal strings among them become one with the range of their documents
before the shuffle, and the windows of the different ones go separately by a 128-bit digest, so that a
passage found everywhere spreads over all tasks.
"""

from __future__ import annotations

import hashlib
import sys
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .common import grouped, materialize, parallel, worker_state
from .hashing import WordHasher, runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MINIMISER_WORDS = 8
# Super-k-mers of one minimiser from which on its windows travel separately.
BUCKET = 256


def _hasher() -> WordHasher:
    return worker_state("words exact", lambda: WordHasher(False))


def super_kmers(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, number of windows) of the super-k-mers of one text's word hashes."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = min(MINIMISER_WORDS, window)
    low, span, reach = runs(words, size), window - size + 1, 1
    while reach < span:  # minimum over `span` places by doubling
        step = min(reach, span - reach)
        low = np.minimum(low[: len(low) - step], low[step:])
        reach += step
    first = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    return low[first], first, np.diff(np.concatenate([first, [len(low)]]))


def _sketch(docs: DataFrame, window: int) -> DataFrame:
    """Per row of (doc_id, h, text): word count, digest of all words, and its super-k-mers' light part."""
    def sketched(texts):
        joined, starts, ends, words, bounds = _hasher().split(texts)
        yield [
            (b - a, *super_kmers(words[a:b], window)) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
        ]

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            at = 0
            for rows in grouped(sketched, texts, 1_000_000):
                n = len(rows)
                cuts = np.cumsum([0, *[len(r[1]) for r in rows]]).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([r[k] for r in rows]).view(np.int64)))
                    for k in (1, 2, 3)
                ]
                digests = [hashlib.sha256(b" ".join(_split(t))).hexdigest() for t in texts[at : at + n]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, n), batch.column("h").slice(at, n),
                     pa.array([r[0] for r in rows], pa.int64()), pa.array(digests, pa.string()), *lists],
                    names=["doc_id", "h", "n_words", "kept_sha256", "minimiser", "first", "windows"],
                )
                at += n

    return docs.mapInArrow(
        run, "doc_id long, h long, n_words long, kept_sha256 string, minimiser array<long>, first array<long>, "
        "windows array<long>"
    )


def _split(text: bytes) -> list[bytes]:
    """Words of a text; bytes.split() without an argument knows just the six separators."""
    return text.split()


def _packed(touched: DataFrame, window: int, hot: bool) -> DataFrame:
    """Super-k-mers of the ordinary or the crowded buckets, each as one string of its words."""
    def run(batches):
        for batch in batches:
            for doc_id, h, text, kmers in zip(*[batch.column(c).to_pylist() for c in ["doc_id", "h", "text", "kmers"]]):
                words = _split(text)
                found = [k for k in kmers if k["hot"] == hot]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k["minimiser"] for k in found], pa.int64()),
                         pa.array([doc_id] * len(found), pa.int64()), pa.array([h] * len(found), pa.int64()),
                         pa.array([k["first"] for k in found], pa.int64()),
                         pa.array([b" ".join(words[k["first"] : k["first"] + k["windows"] + window - 1])
                                   for k in found], pa.binary())],
                        names=["minimiser", "doc_id", "h", "first", "words"],
                    )

    return touched.mapInArrow(
        _in_batches(run, 20_000), "minimiser long, doc_id long, h long, first long, words binary"
    )


def _in_batches(run, rows: int):
    """The batches of `run` joined to about `rows` rows each."""
    def joined(batches):
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def repeated_windows(rows: list[tuple[int, int, int, bytes]], window: int) -> list[tuple[int, int, int, int]]:
    """(doc_id, h, first word, number of words) of the words to remove, from one bucket's super-k-mers.

    `rows` holds (doc_id, h, first, words). Equal strings are looked at once; the windows of the others
    are sorted by their words, which brings equal ones together.
    """
    places: dict[bytes, list[tuple[int, int, int]]] = {}
    for doc_id, h, first, words in rows:
        places.setdefault(words, []).append((doc_id, h, first))
    if len(places) == 1 and len({r[0] for r in rows}) == 1:
        return []
    listed = []
    for text, at in places.items():
        cuts = [0, *(np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1).tolist(), len(text) + 1]
        lowest = min(p[0] for p in at)
        listed += [(text[cuts[j] : cuts[j + window] - 1], lowest, text, j) for j in range(len(cuts) - window)]
    listed.sort(key=lambda x: (x[0], x[1]))
    out = []
    for _, same in groupby(listed, key=lambda x: x[0]):
        lowest = None
        for _, doc, text, j in same:
            lowest = doc if lowest is None else lowest
            out += [(d, h, first + j, window) for d, h, first in places[text] if d > lowest]
    return out


def _merged(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Overlapping ranges of a document joined."""
    out: list[list[int]] = []
    for d, h, at, n in sorted(found):
        if out and out[-1][0] == d and out[-1][1] == h and at <= out[-1][2] + out[-1][3]:
            out[-1][3] = max(out[-1][3], at + n - out[-1][2])
        else:
            out.append([d, h, at, n])
    return [tuple(x) for x in out]


def _bucket_ranges(packed: DataFrame, window: int) -> DataFrame:
    """Ranges of words to remove, bucket by bucket; a task holds one bucket of at most BUCKET rows."""
    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*[
                    batch.column(c).to_pylist() for c in ["minimiser", "doc_id", "h", "first", "words"]
                ])

        held: list[tuple[int, int, int, int]] = []

        def emit():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in zip(*held)], names=["doc_id", "h", "at", "n"]
            )

        for _, bucket in groupby(rows(), key=lambda r: r[0]):
            held += _merged(repeated_windows([r[1:] for r in bucket], window))
            if len(held) > 20_000:
                yield emit()
                held = []
        if held:
            yield emit()

    placed = packed.repartition(parallel(packed.sparkSession), "minimiser").sortWithinPartitions("minimiser")
    return placed.mapInArrow(run, "doc_id long, h long, at long, n long")


def _window_digests(strings: DataFrame, window: int) -> DataFrame:
    """One row per different window of (k, lo, hi, words): a 128-bit digest, its places, the string's documents."""
    def run(batches):
        other = worker_state("words second", _second_hasher)
        for batch in batches:
            texts = batch.column("words").to_pylist()
            (_, _, _, one, bounds), (_, _, _, two, _) = _hasher().split(texts), other.split(texts)
            high, low, places, row = [], [], [], []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                x, y = runs(one[a:b], window), runs(two[a:b], window)
                order = np.lexsort((y, x))
                x, y = x[order], y[order]
                first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
                high.append(x[first])
                low.append(y[first])
                places += np.split(order, first[1:])
                row.append(np.full(len(first), i))
            if not places:
                continue
            cuts = np.cumsum([0, *map(len, places)]).astype(np.int32)
            rows = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(np.concatenate(x).view(np.int64)) for x in (high, low)],
                 *[batch.column(c).take(rows) for c in ("k", "lo", "hi")],
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(places).astype(np.int64)))],
                names=["high", "low", "k", "lo", "hi", "places"],
            )

    return strings.select("k", "lo", "hi", "words").mapInArrow(
        run, "high long, low long, k string, lo long, hi long, places array<long>")


def _crowded_cuts(touched: DataFrame, window: int) -> DataFrame:
    """(doc_id, h, cuts) from the crowded buckets, one row per super-k-mer with words to remove."""
    packed = materialize(_packed(touched, window, True).select(
        F.md5("words").alias("k"), "doc_id", "h", "first", "words"), "crowded")
    strings = packed.groupBy("k", "words").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    windows = materialize(_window_digests(strings, window), "windows")
    earliest = windows.groupBy("high", "low").agg(
        F.min("lo").alias("earliest"), F.max("hi").alias("last")).where("earliest < last")
    # Windows of a string that some document of the string has to give up.
    late = windows.join(earliest.select("high", "low", "earliest"), ["high", "low"]).where("earliest < hi")
    by_string = late.groupBy("k").agg(F.collect_list(F.struct("places", "earliest")).alias("late"))
    cut = F.expr(
        "transform(flatten(transform(filter(late, x -> x.earliest < doc_id), x -> x.places)), "
        f"j -> struct(first + j AS at, {window}L AS n))")
    return packed.select("k", "doc_id", "h", "first").join(by_string, "k").select(
        "doc_id", "h", cut.alias("cuts")).where(F.size("cuts") > 0)


def _second_hasher() -> WordHasher:
    """A hasher whose byte values and step are independent of the first one's."""
    hasher, rng = WordHasher(False), np.random.default_rng(97)
    hasher.values = rng.integers(1, 2**63, 256, dtype=np.uint64)
    hasher.step = int(rng.integers(0, 2**62)) * 4 + 1
    return hasher


def remove_repeats(
    docs: DataFrame, window: int = 50, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False,
) -> DataFrame:
    """Remove every word that a window of `window` words covers which a document of smaller id also holds.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by spaces), one row per
    input row, and with `with_text` the kept words as `kept_text`. A null or empty text has no words. Rows
    that repeat an id and text share one result; rows that share only the id do not count as each other's
    earlier copies. Rows without an id keep all words and cover none elsewhere. Other columns are not
    read. An empty table gives no rows. Windows are judged on the input texts.
    """
    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(F.col(text_column)).alias("h"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    sketch = materialize(_sketch(source, window), "sketch")
    light = sketch.where("doc_id IS NOT NULL").select(
        "doc_id", "h", F.explode(F.arrays_zip("minimiser", "first", "windows")).alias("k")
    ).select("doc_id", "h", "k.*")
    shared = light.groupBy("minimiser").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")
    ).where("lo < hi").select("minimiser", (F.col("n") >= BUCKET).alias("hot"))
    kmers = light.join(shared, "minimiser").groupBy("doc_id", "h").agg(
        F.array_distinct(F.collect_list(F.struct("minimiser", "first", "windows", "hot"))).alias("kmers")
    )
    touched = materialize(
        source.join(kmers, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]), "touched"
    )

    ranges = _bucket_ranges(_packed(touched, window, False), window).select(
        "doc_id", "h", F.array(F.struct("at", "n")).alias("cuts"))
    cuts = ranges.union(_crowded_cuts(touched, window)).groupBy("doc_id", "h").agg(
        F.flatten(F.collect_list("cuts")).alias("cuts"))

    def cut(batches):
        for batch in batches:
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist()):
                words = _split(text)
                keep = np.ones(len(words), dtype=bool)
                for c in found:
                    keep[c["at"] : c["at"] + c["n"]] = False
                kept = b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])
                out.append((int((~keep).sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            removed, digests, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(removed, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(kept, pa.string())],
                names=["doc_id", "h", "removed", "digest", "kept_text"],
            )

    changed = touched.select("doc_id", "h", "text").join(cuts, ["doc_id", "h"]).mapInArrow(
        cut, "doc_id long, h long, removed long, digest string, kept_text string")
    whole = sketch.select("doc_id", "h", "n_words", "kept_sha256")
    if with_text:
        spaced = F.translate(F.col("text").cast("string"), "\t\n\x0b\x0c\r", "     ")
        counts = whole.dropDuplicates(["doc_id", "h"]).select(
            F.col("doc_id").alias("id"), F.col("h").alias("hash"), "n_words", "kept_sha256")
        whole = source.join(counts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash"))).select(
            "doc_id", "h", "n_words", "kept_sha256",
            F.regexp_replace(F.trim(spaced), " +", " ").alias("whole"))
    joined = whole.join(changed, ["doc_id", "h"], "left")
    texts = [F.coalesce("kept_text", "whole").alias("kept_text")] if with_text else []
    return joined.select(
        "doc_id", "n_words", F.coalesce("removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("digest", "kept_sha256").alias("kept_sha256"), *texts,
    )
