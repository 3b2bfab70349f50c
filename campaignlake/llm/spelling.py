"""Spelling variants of the corpus vocabulary, found in a trie over letter-group counts.

A word is the path of its counts of LEVELS letter groups, in order. One inserted letter raises one count by
one, a deleted letter lowers one, a replaced letter does both or, within a group, neither. So all words at
edit distance one lie on paths that a depth-first search reaches with a budget of one surplus and one
deficit, and whatever the search reaches at the leaves is verified letter by letter.

The top of the trie is spread over the cluster: its first levels are the counts of ROUTES coarse groups, a
word is stored under its own coarse counts, and goes as a search to those within budget, a fixed number of
them. Below, each task builds the trie of the words stored with it, as sorted arrays, and moves all of its
searches down one level at a time. A crowded coarse key is dealt to several tasks by its word count.

Every pair is found once: with equal coarse counts from the smaller word, with one letter moved between
coarse groups from one of both sides by the groups' order, and with unequal lengths from the longer word.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..session import broadcast_checked
from .common import materialize, text_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUTES = 4
LEVELS = 16
# Words stored under one coarse key in one task, words in one trie, and searches that go down together.
CHUNK, TRIE, SEARCHES = 50_000, 50_000, 20_000

# Fixed value: the letters of a run.
LETTERS = r"A-Za-zÀ-ÿ"


def vocabulary(
    docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(word, n) of the words with at least `shortest` letters and `least` occurrences, as a stored table.

    Words are the maximal runs of letters, A-Z lower-cased. Where `every` divides the crc32 of
    "<id>:<run>", the run loses the letter whose place is the crc32 modulo its length: slips with a known
    origin. A missing id is written as nothing.
    """
    # A maximal run shorter than `shortest` cannot give a word: slips only shorten.
    runs = F.regexp_extract_all(text_or_empty(text_column), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    lower = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = found.select("id", lower.alias("run"))
    code = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    found = found.select("run", code.alias("code"))
    at = (F.col("code") % F.length("run")).cast("int")
    slip = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("code") % every == 0, slip).otherwise(F.col("run"))
    words = found.select(word.alias("word")).where(F.length("word") >= shortest)
    return materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least), "vocabulary")


class Letters:
    """Many words as one array of code points."""

    def __init__(self, words: list[str]):
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        self.start = np.concatenate([[0], np.cumsum(self.sizes)])

    def counts(self, groups: int) -> np.ndarray:
        """Letters of each group, by word."""
        word = np.repeat(np.arange(len(self.sizes)), self.sizes)
        flat = np.bincount(word * groups + self.codes % groups, minlength=len(self.sizes) * groups)
        return flat.reshape(len(self.sizes), groups)


def one_apart(left: Letters, a: np.ndarray, right: Letters, b: np.ndarray) -> np.ndarray:
    """Whether the words left[a] and right[b] differ by exactly one inserted, deleted or replaced letter."""
    out = np.zeros(len(a), dtype=bool)
    longer, shorter = left.sizes[a], right.sizes[b]
    alive = np.flatnonzero(np.abs(longer - shorter) <= 1)
    least = np.minimum(longer, shorter)

    def common(alive, of_left, of_right, step):
        """Letters that both words share from a side on, at most all of the shorter one."""
        same = np.zeros(len(a), dtype=np.int64)
        i = 0
        while len(alive := alive[least[alive] > i]):
            alive = alive[left.codes[of_left[alive] + step * i] == right.codes[of_right[alive] + step * i]]
            i += 1
            same[alive] = i
        return same

    front = common(alive, left.start[a], right.start[b], 1)
    back = common(alive, left.start[a + 1] - 1, right.start[b + 1] - 1, -1)
    replaced = (longer == shorter) & (front < longer) & (front + back == longer - 1)
    moved = (longer != shorter) & (front + back >= least)
    out[alive] = (replaced | moved)[alive]
    return out


class Trie:
    """Words by the counts of their letter groups: per level, the children of each node in order.

    Level 0 holds the coarse keys; a node is numbered within its level, and the words below a node are a
    run of the sorted words.
    """

    def __init__(self, words: list[str], keys: np.ndarray):
        self.words = Letters(words)
        counts = self.words.counts(LEVELS)
        # Counts of searches may be one more than any here; a child's number is its node's times this, plus its count.
        self.spread = int(counts.max(initial=0)) + 2
        order = np.lexsort([counts[:, i] for i in range(LEVELS - 1, -1, -1)] + [keys])
        self.order = order
        self.roots, node = np.unique(keys[order], return_inverse=True)
        self.children: list[np.ndarray] = []
        for level in range(LEVELS):
            step = node * self.spread + counts[order, level]
            children, node = np.unique(step, return_inverse=True)
            self.children.append(children)
        self.leaf = np.searchsorted(node, np.arange(len(self.children[-1]) + 1))

    def search(self, words: Letters, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(search, word) pairs on paths within the budget, for words searched below the coarse `keys`."""
        counts = words.counts(LEVELS)
        node = np.searchsorted(self.roots, keys)
        who = np.flatnonzero((node < len(self.roots)) & (self.roots[np.minimum(node, len(self.roots) - 1)] == keys))
        node = node[who]
        surplus, deficit = np.zeros(len(who), dtype=np.int8), np.zeros(len(who), dtype=np.int8)
        for level, children in enumerate(self.children):
            found = []
            for change, open_ in ((0, None), (1, surplus == 0), (-1, deficit == 0)):
                pick = np.arange(len(who)) if open_ is None else np.flatnonzero(open_)
                value = counts[who[pick], level] + change
                inside = (value >= 0) & (value < self.spread)
                pick, value = pick[inside], value[inside]
                step = node[pick] * self.spread + value
                at = np.searchsorted(children, step)
                there = children[np.minimum(at, len(children) - 1)] == step
                pick, at = pick[there], at[there]
                found.append((who[pick], at, surplus[pick] + (change == 1), deficit[pick] + (change == -1)))
            who, node, surplus, deficit = (np.concatenate(x) for x in zip(*found))
        # A stored word is as long as the search or one letter shorter.
        who, node = who[surplus <= deficit], node[surplus <= deficit]
        n = self.leaf[node + 1] - self.leaf[node]
        place = np.arange(n.sum()) + np.repeat(self.leaf[node] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return np.repeat(who, n), self.order[place]


# Base of the coarse key; larger counts are taken modulo it, which only joins keys.
_UP = 1 << 15


def _coarse(counts: np.ndarray) -> np.ndarray:
    return (counts % _UP) @ (np.int64(_UP) ** np.arange(ROUTES, dtype=np.int64))


def _route(batches):
    """Each word under its own coarse counts (role 0), and as a search under all within budget (role 1, 2).

    Role 1 searches among words of equal coarse counts, where a pair comes from both sides.
    """
    unit = np.eye(ROUTES, dtype=np.int64)
    for batch in batches:
        words = batch.column(0).to_pylist()
        counts = Letters(words).counts(ROUTES).astype(np.int64)
        n = len(words)
        rows = [(np.arange(n), _coarse(counts), 0), (np.arange(n), _coarse(counts), 1)]
        for i in range(ROUTES):
            # One letter fewer, or one letter moved to a later group.
            for moved in (counts - unit[i], *[counts - unit[i] + unit[j] for j in range(i + 1, ROUTES)]):
                of = np.flatnonzero(moved[:, i] >= 0)
                rows.append((of, _coarse(moved[of]), 2))
        column = pa.array(words, pa.string())
        for of, key, role in rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(np.full(len(of), role, dtype=np.int32)), column.take(pa.array(of))],
                names=["key", "role", "word"])


def _search_batch(trie: Trie, stored: list[str], words: list[str], keys: np.ndarray, own: np.ndarray):
    """Verified (word, near word) pairs of searches, SEARCHES at a time."""
    for at in range(0, len(words), SEARCHES):
        some = words[at : at + SEARCHES]
        letters = Letters(some)
        who, found = trie.search(letters, keys[at : at + SEARCHES])
        near = one_apart(letters, who, trie.words, found)
        who, found = who[near], found[near]
        for i, j in zip(who.tolist(), found.tolist()):
            if not own[at + i] or some[i] < stored[j]:
                yield some[i], stored[j]


def _pairs(batches):
    """Near pairs of rows that come sorted by place: the stored words of a place before its searches.

    Places are gathered until TRIE stored words are held, then their searches go through one trie.
    """
    stored: list[str] = []
    keys: list[int] = []
    searches: list[str] = []
    targets: list[int] = []
    own: list[bool] = []

    def flush():
        if stored and searches:
            trie = Trie(stored, np.array(keys, dtype=np.int64))
            out = list(_search_batch(trie, stored, searches, np.array(targets, dtype=np.int64), np.array(own)))
            if out:
                left, right = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["word", "near"])
        searches.clear(), targets.clear(), own.clear()

    place, number = None, -1
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in range(4)]
        for key, chunk, role, word in zip(*columns):
            if (key, chunk) != place:
                if len(stored) >= TRIE:
                    yield from flush()
                    stored.clear(), keys.clear()
                place, number = (key, chunk), number + 1
                held = False
            if role == 0:
                stored.append(word)
                keys.append(number)
                held = True
            elif held:
                searches.append(word)
                targets.append(number)
                own.append(role == 1)
                if len(searches) >= 4 * TRIE:
                    yield from flush()
    yield from flush()


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near) for every two words of the column `word` that differ by one letter, each pair once.

    A coarse key with more than CHUNK words is dealt by the words' hash to as many places as that takes,
    and its searches go to each of them.
    """
    routed = materialize(words.select("word").mapInArrow(_route, "key long, role int, word string"), "routes")
    crowded = routed.where("role = 0").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK)
    crowded = crowded.select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    placed = routed.join(broadcast_checked(crowded), "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    everywhere = F.sequence(F.lit(0), F.col("chunks") - 1)
    placed = placed.select("key", F.explode(F.when(F.col("role") == 0, F.array(own)).otherwise(everywhere)).alias("chunk"), "role", "word")
    dealt = placed.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "role")
    return dealt.mapInArrow(_pairs, "word string, near string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last word that following forms leads to.

    A form occurs ten times as often as its word, so chains are short and have no circles; each round
    doubles the steps taken.
    """
    steps = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = materialize(steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def variants(
    docs: DataFrame, shortest: int = 7, least: int = 2, ratio: int = 10, every: int = 31, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every word of the vocabulary with the frequent word that it is a variant of.

    Returns word, form, root, n, n_near, form_n. Near words differ by one letter; the form is the near word
    of largest n, the smallest word on ties, if that n is at least `ratio` times the word's own, else null;
    the root is where following forms ends. Null and empty texts hold no words, repeated rows count as often
    as they occur, rows without an id slip by their run alone, a run of letters may be as long as a text, an
    empty table gives no rows, and other columns are not read.
    """
    words = vocabulary(docs, shortest, least, every, id_column, text_column)
    pairs = materialize(near_pairs(words), "near")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    both = pairs.union(pairs.select("near", "word"))
    best = both.join(counts, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"),
        (-F.col("best.less")).alias("near_n"))
    wins: Column = F.col("near_n") >= ratio * F.col("n")
    named = materialize(named.select(
        "word", "n", "n_near", F.when(wins, F.col("near")).alias("form"), F.when(wins, F.col("near_n")).alias("form_n")), "forms")
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
