"""Phrase mining on a weighted de Bruijn graph of word sequences.

Nodes are runs of four words, edges the runs of five that join two overlapping nodes, weighted by their
occurrences. Every position of a text gives one row: the longest gram that begins there, five words unless
its piece ends before. So only edges and the short grams at piece ends are counted; the count of a shorter
gram is the flow through it: what its edges carry, plus the pieces that end with it. Flows go down one
length at a time, from edges to single words.

A node whose whole flow enters or leaves through one edge is unary: it never stands without that longer
phrase. Compaction takes it into the edge, at every length, so chains of unary nodes leave only their
longest phrases, and `unary_paths` joins those into the passages they come from.

A pair of words that is too rare ends a gram as a piece does: no phrase that holds it can be frequent. Rare
pairs are told by a bitmap of the hashes of frequent ones. A wrong bit only keeps a gram longer; counts are
sums over strings and exact.
"""

from __future__ import annotations

import hashlib
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize, parallel, worker_state
from .hashing import WordHasher, mix, runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters that end a piece, and those that separate the words of a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"

RUN_BYTES = 750_000
BITMAP_BITS = 26
# Distinct pairs that a task holds before it passes them on.
HELD_PAIRS = 1_000_000

_CUT = re.compile(b"[" + re.escape(PIECE_ENDS) + b"]")


class PieceWords:
    """The words of many texts, lower-cased, in one buffer with a space behind each, and their pieces."""

    def __init__(self):
        self.hasher = WordHasher(True)
        self.hasher.within[list(PIECE_ENDS)] = False
        # Other white space than SPACES is part of a word unless it ends a piece.
        self.ends_piece = np.zeros(256, dtype=bool)
        self.ends_piece[list(PIECE_ENDS)] = True
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def split(self, texts: list[bytes]):
        """(buffer, start of each word in it and its end, word hashes, piece numbers, text numbers)."""
        joined, starts, ends, hashes, first = self.hasher.split(texts)
        sizes = ends - starts
        at = np.concatenate([[0], np.cumsum(sizes + 1)])
        take = np.arange(at[-1], dtype=np.int64) + np.repeat(starts - at[:-1], sizes + 1)
        buffer = self.lower[joined[take]]
        buffer[at[1:] - 1] = 32
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        # A text starts a piece of its own, and so does what follows a mark.
        piece = np.cumsum(self.ends_piece[joined], dtype=np.int64)[starts] + text
        return buffer, at[:-1], at[1:] - 1, hashes, piece, text


def _words() -> PieceWords:
    return worker_state("piece words", PieceWords)


def _long_cut(text: bytes) -> list[bytes]:
    """A text in parts of about RUN_BYTES that end where pieces do."""
    parts, at = [], 0
    while len(text) - at > RUN_BYTES and (found := _CUT.search(text, at + RUN_BYTES)):
        parts.append(text[at : found.end()])
        at = found.end()
    return [*parts, text[at:]] if parts else [text]


def _runs_of_texts(batch):
    """(texts, languages) of a record batch of (text, lang), about RUN_BYTES at a time."""
    texts, langs, held = [], [], 0
    for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        for part in _long_cut(text or b""):
            texts.append(part)
            langs.append(lang)
            held += len(part)
            if held >= RUN_BYTES:
                yield texts, langs
                texts, langs, held = [], [], 0
    if texts:
        yield texts, langs


def _pair_keys(hashes: np.ndarray, langs: list[str], text: np.ndarray) -> np.ndarray:
    """A key for each word and the next one, in the language of its text."""
    if len(hashes) < 2:
        return np.zeros(0, np.uint64)
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    return mix(runs(hashes, 2) ^ np.array([known[x] for x in langs], np.uint64)[text[:-1]])


def frequent_pairs(texts: DataFrame, least: int) -> np.ndarray:
    """Bitmap over pair hashes: set wherever a pair of neighbours may occur `least` times in a language.

    Its size is fixed, so what the driver and every task hold does not grow with the corpus.
    """

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            keys = np.concatenate([k for k, _ in held])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([n for _, n in held])[order]
            edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[edge], np.add.reduceat(n, edge)

        def rows(keys, n):
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

        words = _words()
        for batch in batches:
            for part, langs in _runs_of_texts(batch):
                _, _, _, hashes, piece, text = words.split(part)
                keys, n = np.unique(_pair_keys(hashes, langs, text)[piece[1:] == piece[:-1]], return_counts=True)
                if len(keys):
                    held.append((keys, n))
                if sum(len(k) for k, _ in held) > HELD_PAIRS:
                    held = [merged()]
                    if len(held[0][0]) > HELD_PAIRS // 2:
                        yield rows(*held.pop())
        if held:
            yield rows(*merged())

    counted = texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    bit = F.col("key").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    cells = counted.groupBy(F.shiftright(bit, 6).alias("cell")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    # At most 2**(BITMAP_BITS - 6) rows.
    found = cells.toArrow()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    bitmap[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return bitmap


def _grams_of(part: list[bytes], langs: list[str], bitmap: np.ndarray, longest: int):
    """Arrays (lang, size, gram, n): the distinct longest grams of a run of texts."""
    buffer, starts, ends, hashes, piece, text = _words().split(part)
    n = len(hashes)
    if not n:
        return pa.array([], pa.string()), np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)
    names = sorted(set(langs))
    number = {x: i for i, x in enumerate(names)}
    lang = np.array([number[x] for x in langs])[text]
    keys = _pair_keys(hashes, langs, text)
    bit = keys & np.uint64((1 << BITMAP_BITS) - 1)
    linked = (bitmap[(bit >> np.uint64(6)).astype(np.int64)].view(np.uint64) >> (bit & np.uint64(63))) & np.uint64(1)
    linked = (linked == 1) & (piece[1:] == piece[:-1])
    reach = np.zeros(n, dtype=np.int64)
    for _ in range(longest - 1):
        reach[:-1] = np.where(linked, reach[1:] + 1, 0)
    first, second = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    other = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    for size in range(1, longest + 1):
        of = np.flatnonzero(reach == size - 1)
        if len(of):
            first[of] = mix(runs(hashes, size)[of] ^ mix(lang[of].astype(np.uint64) + np.uint64(size)))
            second[of] = runs(other, size)[of]
    # Equal grams have equal digests of 128 bits; a gram that is met in two groups only makes two rows.
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    edge = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    times = np.diff(np.concatenate([edge, [n]]))
    at = order[edge]
    begin, stop = starts[at], ends[at + reach[at]]
    offsets = np.concatenate([[0], np.cumsum(stop - begin)])
    data = buffer[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], stop - begin)]
    grams = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    return pa.array(names, pa.string()).take(pa.array(lang[at])), reach[at] + 1, grams, times


def edges(docs: DataFrame, least: int, longest: int = 5, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """(lang, size, gram, n): how often each longest gram begins at a position, as a stored table."""
    texts = docs.select(
        F.col(text_column).cast("binary").alias("text"), F.coalesce(F.col(lang_column), F.lit("und")).alias("lang"))
    bitmap = docs.sparkSession.sparkContext.broadcast(frequent_pairs(texts, least))

    def run(batches):
        for batch in batches:
            for part, langs in _runs_of_texts(batch):
                lang, size, gram, n = _grams_of(part, langs, bitmap.value, longest)
                yield pa.RecordBatch.from_arrays(
                    [lang, pa.array(size.astype(np.int32)), gram, pa.array(n)], names=["lang", "size", "gram", "n"])

    rows = texts.mapInArrow(run, "lang string, size int, gram string, n long")
    return materialize(rows.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")), "edges")


def _words_of(gram: Column, first: int | Column, length: Column) -> Column:
    """Words `first` (from 1) and on of a gram, `length` of them."""
    return F.array_join(F.slice(F.split(gram, " "), first, length), " ")


def nodes(counted: DataFrame, longest: int = 5) -> DataFrame:
    """(lang, size, gram, f) of all grams: the flow through each, from the longest down, as a stored table.

    A gram's flow is that of the longer grams it begins plus the positions where it was the longest itself.
    """
    level = counted.where(F.col("size") == longest).select("lang", "size", "gram", F.col("n").alias("f"))
    levels = [level]
    for size in range(longest - 1, 0, -1):
        ended = counted.where(F.col("size") == size).select("lang", "gram", F.col("n").alias("f"))
        passing = level.select("lang", F.substring_index("gram", " ", size).alias("gram"), "f")
        level = passing.union(ended).groupBy("lang", "gram").agg(F.sum("f").alias("f"))
        level = materialize(level.select("lang", F.lit(size).alias("size"), "gram", "f"), f"nodes{size}")
        levels.append(level)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def _unary(frequent: DataFrame) -> DataFrame:
    """(lang, gram, most): the largest flow that an edge of one word more carries into or out of a gram."""
    size = F.col("size")
    longer = frequent.where(size > 2).select("lang", "f", F.explode(F.array(
        _words_of(F.col("gram"), 1, size - 1),
        _words_of(F.col("gram"), 2, size - 1),
    )).alias("gram"))
    return longer.groupBy("lang", "gram").agg(F.max("f").alias("most"))


def unary_paths(frequent: DataFrame, longest: int = 5) -> DataFrame:
    """(lang, passage, f): chains of edges through unary nodes, each joined into one passage.

    `frequent` are rows of `nodes` above some count. Two edges join where the node between them has one edge
    in and one out that both carry its whole flow. Each round lets every edge see twice as far ahead, so the
    rounds follow the logarithm of the longest passage; a circle is cut before its smallest edge.
    """
    edge = frequent.where(F.col("size") == longest).select("lang", "gram", "f")
    node = frequent.where(F.col("size") == longest - 1).select("lang", F.col("gram").alias("node"), F.col("f").alias("flow"))
    ahead = edge.select("lang", _words_of(F.col("gram"), 2, longest - 1).alias("node"), F.col("gram").alias("before"), "f")
    behind = edge.select("lang", _words_of(F.col("gram"), 1, longest - 1).alias("node"), F.col("gram").alias("after"), F.col("f").alias("g"))
    links = ahead.join(node, ["lang", "node"]).where("f = flow").join(behind, ["lang", "node"]).where("g = flow")
    links = links.select("lang", F.col("before").alias("gram"), F.col("after").alias("next"))
    # Steps back to the first edge of the chain so far, and the smallest edge on the way.
    state = edge.join(links.select("lang", F.col("next").alias("gram"), F.col("gram").alias("back")), ["lang", "gram"], "left")
    state = materialize(state.select(
        "lang", "gram", "f", "back", F.coalesce("back", "gram").alias("head"), F.when(F.col("back").isNull(), 0).otherwise(1).alias("steps"),
        F.col("back").alias("to"), F.least("gram", "back").alias("low")), "paths")
    chained = state.where("back IS NOT NULL").count()
    for _ in range(max(1, chained).bit_length() + 1):
        if state.where("to IS NOT NULL").isEmpty():
            break
        other = state.select("lang", F.col("gram").alias("to"), F.col("head").alias("head2"), F.col("steps").alias("steps2"),
                             F.col("to").alias("to2"), F.col("low").alias("low2"))
        state = materialize(state.join(other, ["lang", "to"], "left").select(
            "lang", "gram", "f", "back", F.coalesce("head2", "head").alias("head"),
            (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"), F.col("to2").alias("to"),
            F.least("low", F.coalesce("low2", "low")).alias("low")), "paths")
    # What still points on after that many rounds goes round in a circle, which its smallest edge begins.
    circle = state.where("to IS NOT NULL")
    if not circle.isEmpty():
        cut = circle.where("gram = low").select("lang", F.col("gram").alias("next"))
        open_ = links.join(cut, ["lang", "next"], "left_anti")
        rest = circle.select("lang", "gram", "f").join(open_.select("lang", F.col("next").alias("gram"), F.col("gram").alias("back")), ["lang", "gram"], "left")
        walked = _walk_back(rest)
        state = state.where("to IS NULL").select("lang", "gram", "f", "head", "steps").unionByName(walked)
    last = F.substring_index("gram", " ", -1)
    parts = F.array_sort(F.collect_list(F.struct("steps", F.when(F.col("steps") == 0, F.col("gram")).otherwise(last).alias("words"))))
    joined = state.groupBy("lang", "head").agg(parts.alias("parts"), F.max("f").alias("f"))
    return joined.select("lang", F.array_join(F.col("parts.words"), " ").alias("passage"), "f")


def _walk_back(rows: DataFrame) -> DataFrame:
    """(lang, gram, f, head, steps) of chains without circles, by `back`."""
    state = materialize(rows.select(
        "lang", "gram", "f", F.coalesce("back", "gram").alias("head"), F.when(F.col("back").isNull(), 0).otherwise(1).alias("steps"),
        F.col("back").alias("to")), "paths")
    while not state.where("to IS NOT NULL").isEmpty():
        other = state.select("lang", F.col("gram").alias("to"), F.col("head").alias("head2"), F.col("steps").alias("steps2"), F.col("to").alias("to2"))
        state = materialize(state.join(other, ["lang", "to"], "left").select(
            "lang", "gram", "f", F.coalesce("head2", "head").alias("head"),
            (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"), F.col("to2").alias("to")), "paths")
    return state.select("lang", "gram", "f", "head", "steps")


def mine(
    docs: DataFrame, least: int = 100, longest: int = 5, keep: int = 2000, lang_column: str = "lang", text_column: str = "text",
) -> DataFrame:
    """The strongest phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split into pieces at marks and line ends, pieces into words at spaces and
    tabs. A phrase has 2 to `longest` words and occurs `least` times (a) within pieces; cutting it into first
    and rest with l and r occurrences scores floor(1000 * a * n / (l * r)) for n words, and the lowest cut
    counts, the shorter first part on ties. Phrases that every time stand in the same longer one are left out.

    A null text holds no words, a null language is `und`, repeated rows count as often as they occur, very
    long texts are read in parts that end where pieces do, an empty table gives no rows, and other columns
    are not read.
    """
    flows = nodes(edges(docs, least, longest, lang_column, text_column), longest)
    totals = flows.where("size = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = materialize(flows.where(F.col("f") >= least), "frequent")
    phrases = frequent.where("size > 1").join(_unary(frequent), ["lang", "gram"], "left")
    phrases = phrases.where("most IS NULL OR most < f").select("lang", "size", "gram", F.col("f").alias("a"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*", _words_of(F.col("gram"), 1, F.col("k")).alias("head"),
        _words_of(F.col("gram"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    heads = frequent.select("lang", F.col("gram").alias("head"), F.col("f").alias("l"))
    rests = frequent.select("lang", F.col("gram").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    # One row per language.
    cuts = cuts.join(F.broadcast(totals), "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    over = (F.lit(1000).cast("decimal(4,0)") * wide["a"]) * wide["n"]
    cuts = cuts.withColumn("over", over).withColumn("under", wide["l"] * wide["r"]).withColumn("score", F.expr("over div under"))
    scored = cuts.groupBy("lang", "gram").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("best"))
    scored = scored.select("lang", F.col("gram").alias("phrase"), "best.a", "best.l", "best.r", "best.n", "best.score")
    # The best of every slice of a language, then the best of those.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = scored.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(parallel(docs.sparkSession))))
    near = sliced.withColumn("place", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(
        F.col("place") <= keep)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= keep).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
