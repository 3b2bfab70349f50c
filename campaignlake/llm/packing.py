"""Best-fit packing of tokenised documents by bin completion.

Token lengths decide a packing, and there are at most `capacity` of them. So the documents are
tokenised and counted by Spark, a packing plan is found on the counts alone (one row per length,
whatever the corpus size), and Spark gives every piece its place from the plan. The plan lists
fillings with the number of sequences that use each, so it stays short too: every step uses up a
length.
"""

from __future__ import annotations

import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .common import grouped, materialize, worker_state
from .hashing import WordHasher

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Memory for token ids of known words in one Python worker.
CACHE_BYTES = 160_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, block long, place long"

# Closing marks: a step from a letter to one of them ends a word for the tokenizer, as white space does.
MARKS = b".,;:!?"
# First bytes of the code points U+00C0 to U+00FF, and the second bytes of those that are no letters.
LATIN, NO_LETTERS = 0xC3, (0x97, 0xB7)


class Chunks:
    """The white-space-free chunks of texts that are a word of letters with closing marks, or else anything.

    Letters are those of a-z and U+00E0 to U+00FF with their capitals, which lower-case and compose alike
    everywhere; words are lower-cased here, so a word is one word with any capitals and marks.
    """

    def __init__(self):
        self.hasher = WordHasher(False)
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.letter = np.zeros(256, dtype=bool)
        self.letter[97:123] = True
        self.mark = np.zeros(256, dtype=bool)
        self.mark[list(MARKS)] = True

    def split(self, texts: list[bytes]):
        """(lower-cased bytes, bytes, starts, ends of words, ends of chunks, which are words, chunks by text)."""
        joined = np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)
        lowered = self.lower[joined]
        second = np.concatenate([[False], joined[:-1] == LATIN]) & (joined >= 0x80) & ~np.isin(joined, NO_LETTERS)
        lowered[second & (joined < 0x9F)] += 32
        letter = self.letter[lowered] | second
        letter[:-1] |= second[1:]
        mark = self.mark[joined]
        inside = self.hasher.within[joined]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        # Neither letter nor mark, or a letter behind a mark, makes a chunk something else.
        odd = inside & ~letter & ~mark
        odd[1:] |= letter[1:] & mark[:-1]
        bad, marks = np.concatenate([[0], np.cumsum(odd)]), np.concatenate([[0], np.cumsum(mark)])
        plain = (bad[ends] == bad[starts]) & letter[starts]
        stops = np.where(plain, ends - (marks[ends] - marks[starts]), ends)
        text_at = np.cumsum([1, *[len(x) + 1 for x in texts]])
        return lowered, joined, starts, stops, ends, plain, np.searchsorted(starts, text_at)


class ChunkCache(dict):
    """Token ids (little-endian unsigned 32-bit) of the whitespace-free chunks of texts.

    The tokenizer's normaliser and word pattern never join characters across ASCII white space, so
    the ids of a text are those of its chunks in order, and those of a word with closing marks are the word's
    and the marks'. A run of texts looks up each of its distinct words, marks and other chunks once; new
    words go through the tokenizer's model together, in one line, and the end-of-word flag of the vocabulary
    separates their ids. The cache empties itself when it is full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model for lines of lower-case words of letters, which need no other preparation.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.chunks = Chunks()
        self.held = self.emptied = 0

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn_words(self, found: list[bytes]) -> None:
        """Ids of each of many lower-case words of letters."""
        ids = np.array(self.plain.encode(b" ".join(found).decode(), add_special_tokens=False).ids, dtype="<u4")
        stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(stops) != len(found) or stops[-1:] != [4 * len(ids)][: len(stops)]:
            raise ValueError("the vocabulary does not mark the ends of words")
        raw = ids.tobytes()
        self.update(zip(found, [raw[a:b] for a, b in zip([0, *stops], stops)]))
        self.held += 170 * len(found) + 2 * len(raw)

    def looked_up(self, keys: list[bytes], plain: bool) -> list[bytes]:
        """Ids of distinct words of letters, or of anything else."""
        found = list(map(self.get, keys))
        if missing := [k for k, x in zip(keys, found) if x is None]:
            if plain:
                self.learn_words(missing)
            else:
                for key in missing:
                    self[key] = self.encode(key.decode())
                    self.held += 170 + len(key) + len(self[key])
            found = list(map(self.get, keys))
        return found

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Token ids of each text."""
        if self.held > CACHE_BYTES:
            self.clear()
            self.held, self.emptied = 0, self.emptied + 1
        lowered, joined, starts, stops, ends, plain, first = self.chunks.split(texts)
        raw, low = joined.tobytes(), lowered.tobytes()
        hasher = self.chunks.hasher
        marked = stops < ends
        # Parts in three kinds: words, marks behind words, other chunks. Equal parts have equal hashes of 64 bits.
        kinds = [
            (low, np.flatnonzero(plain), starts, stops, lowered, True), (raw, np.flatnonzero(marked), stops, ends, joined, False),
            (raw, np.flatnonzero(~plain), starts, ends, joined, False),
        ]
        place = np.arange(len(starts)) + np.cumsum(marked) - marked  # of a chunk's first part
        entry = np.empty(len(starts) + int(marked.sum()), dtype=np.int64)
        known: list[bytes] = []
        for i, (source, of, begin, end, array, word) in enumerate(kinds):
            if not len(of):
                continue
            hashes = hasher.spans(array, begin[of], end[of])
            _, at, back = np.unique(hashes, return_index=True, return_inverse=True)
            entry[place[of] + (i == 1)] = back + len(known)
            keys = [source[a:b] for a, b in zip(begin[of][at].tolist(), end[of][at].tolist())]
            known += self.looked_up(keys, word)
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        sizes = np.array([len(x) // 4 for x in known], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        count = sizes[entry] if len(entry) else np.zeros(0, dtype=np.int64)
        total = np.concatenate([[0], np.cumsum(count)])
        out = flat[np.arange(total[-1]) + np.repeat(offsets[entry] - total[:-1], count)] if len(entry) else flat
        raw_ids = out.tobytes()
        # First part of each text: parts before its first chunk.
        before = np.concatenate([place, [len(entry)]])[first]
        cuts = (4 * total[before]).tolist()
        return [raw_ids[a:b] for a, b in zip(cuts, cuts[1:])]


def tokenize_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece of at most `capacity` tokens, with its place among its block's pieces of that length.

    `block` numbers the task that read the document; a task counts its own lengths, so no shuffle is
    needed to number pieces. The result must be stored before it is used twice.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        cache = worker_state(f"ids {tokenizer_path}", lambda: ChunkCache(tokenizer_path))
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            texts = [text or b"" for text in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), grouped(cache.ids, texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    length = len(part) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(part), block, int(seen[length])))
                    seen[length] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "block", "place"]
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            columns = zip(*rows) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return source.mapInArrow(run, PIECES)


@dataclass
class Filling:
    """Lengths in one sequence with how often each occurs, and the number of sequences that look so."""

    parts: tuple[tuple[int, int], ...]
    times: int


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The least number of sequences by total size and by the items above half, over all cut-offs."""
    sizes = np.arange(capacity + 1)
    n, s = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * sizes)])

    def between(a, b, sums):  # items of size a..b
        return sums[b + 1] - sums[a]

    best = -(-int(s[-1]) // capacity)
    half = capacity // 2
    for cut in range(half + 1):
        large = between(capacity - cut + 1, capacity, n) if cut else 0
        middle, middle_sum = between(half + 1, capacity - cut, n), between(half + 1, capacity - cut, s)
        small_sum = between(max(cut, 1), half, s)
        rest = int(small_sum) - (int(middle) * capacity - int(middle_sum))
        best = max(best, int(large) + int(middle) + max(0, -(-rest // capacity)))
    return best


class Lengths:
    """Counts by length with the largest available length at or below any size."""

    def __init__(self, counts: list[int]):
        self.counts = counts
        self.mask = sum(1 << k for k, n in enumerate(counts) if k and n)  # one bit for each available length

    def at_most(self, size: int) -> int:
        """Largest length with documents left at or below `size`, 0 if none."""
        return max(0, (self.mask & ((2 << size) - 1)).bit_length() - 1) if size > 0 else 0

    def most(self, parts: dict[int, int]) -> int:
        """How often the counts allow a filling."""
        return min(self.counts[length] // k for length, k in parts.items())

    def use(self, parts: dict[int, int], times: int) -> None:
        """Take the documents of a filling `times` times, or give them back if `times` is negative."""
        for length, k in parts.items():
            self.counts[length] -= k * times
            if self.counts[length]:
                self.mask |= 1 << length
            else:
                self.mask &= ~(1 << length)

    def fill(self, room: int, top: int) -> int:
        """What lengths up to `top` can fill of `room` at most."""
        total, size = 0, self.at_most(min(room, top))
        while size and total < room:
            total += size * self.counts[size]
            size = self.at_most(size - 1)
        return min(total, room)


def best_fit(lengths: Lengths, first: int, room: int) -> dict[int, int]:
    """The largest document, then always the largest that still fits."""
    parts, size = {first: 1}, lengths.at_most(room)
    while size:
        k = min(lengths.counts[size] - parts.get(size, 0), room // size)
        if k > 0:
            parts[size] = parts.get(size, 0) + k
            room -= k * size
        size = lengths.at_most(min(room, size - 1))
    return parts


def completions(
    lengths: Lengths, first: int, room: int, waste: int, nodes: int, keep: int,
) -> tuple[list[dict[int, int]], int, bool]:
    """Undominated fillings around a document of length `first` that waste at most `waste`, least waste first.

    Sizes are tried in falling order, each with every multiplicity from the largest down to none. A filling
    is dominated, and left out, when one of its sizes could give way to a larger one that is still available
    and fits, or another document still fits: that does no worse later on. A branch is cut when the
    documents left for it cannot bring its waste within `waste`. Also returns the nodes visited, and whether
    these are all such fillings: the walk stops after `nodes` nodes or `keep` fillings without waste.
    """
    found: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    counts, spent, full = lengths.counts, 0, 0

    def left(size: int, taken: dict[int, int]) -> bool:
        return counts[size] > taken.get(size, 0) + (size == first)

    def walk(room: int, top: int, parts: list[tuple[int, int]]) -> bool:
        nonlocal spent, full
        if spent >= nodes or full >= keep:
            return False
        spent += 1
        size = lengths.at_most(min(room, top))
        if size == first and counts[size] == 1:
            size = lengths.at_most(size - 1)
        if not size:
            taken = dict(parts)
            for length in [0, *taken]:
                larger = lengths.at_most(min(length + room, first))
                while larger > length and not left(larger, taken):
                    larger = lengths.at_most(larger - 1)
                if larger > length:
                    return True
            found.append((room, tuple(parts)))
            full += room == 0
            return True
        while size:
            for k in range(min(counts[size] - (size == first), room // size), 0, -1):
                rest = room - k * size
                if rest - lengths.fill(rest, size - 1) > waste:
                    continue
                if not walk(rest, size - 1, parts + [(size, k)]):
                    return False
            size = lengths.at_most(size - 1)
            if room - lengths.fill(room, size) > waste:
                break
        return True

    whole = walk(room, first, []) if room <= waste or lengths.fill(room, first) >= room - waste else True
    out = []
    for _, parts in sorted((x for x in found if x[0] <= waste), key=lambda x: x[0]):
        filling = {first: 1}
        for length, k in parts:
            filling[length] = filling.get(length, 0) + k
        out.append(filling)
    return out, spent, whole


def finish(lengths: Lengths, capacity: int) -> list[Filling]:
    """Best-fit fillings until nothing is left."""
    out = []
    while first := lengths.at_most(capacity):
        parts = best_fit(lengths, first, capacity - first)
        times = lengths.most(parts)
        lengths.use(parts, times)
        out.append(Filling(tuple(sorted(parts.items(), reverse=True)), times))
    return out


def plan_packing(
    counts: dict[int, int], capacity: int = 4096, nodes: int = 400, branches: int = 2, restarts: int = 8,
    budget: int = 200_000,
) -> list[Filling]:
    """Fillings that hold every document, in as few sequences as the search finds.

    Bin completion: the incumbent is the best-fit packing. The search completes the sequence of the
    largest document left with each undominated filling in turn, least waste first, as often as the counts
    allow or once, and drops a branch when its waste exceeds what would improve on the incumbent. It ends
    at the lower bound, or when it has been through all branches, which proves the incumbent best. A pass
    looks at `nodes` nodes for a sequence and `restarts` finished branches at most; as long as that cut
    something off, another pass has four times as many, until `budget` nodes were visited in all.
    """
    start = [0] * (capacity + 1)
    for length, n in counts.items():
        start[int(length)] += int(n)
    total, bound = sum(k * n for k, n in enumerate(start)), lower_bound(np.array(start, dtype=np.int64), capacity)
    best = finish(Lengths(start[:]), capacity)
    size = sum(f.times for f in best)
    visited = 0
    while size > bound:
        lengths, ended, cut = Lengths(start[:]), 0, False
        # One frame for each step: the choices still open there, and the one in use.
        frames: list[list] = []
        wasted = 0
        while True:
            allowed = (size - 1) * capacity - total - wasted
            first = lengths.at_most(capacity)
            choices: list[tuple[dict[int, int], int, int]] = []
            if allowed >= 0 and first:
                found, spent, whole = completions(lengths, first, capacity - first, allowed, nodes, branches)
                visited += spent + 1
                cut |= not whole
                if not found and not whole:
                    found = [best_fit(lengths, first, capacity - first)]
                once = []
                for parts in found:
                    waste = capacity - sum(length * k for length, k in parts.items())
                    times = min(lengths.most(parts), allowed // waste if waste else total)
                    if times:
                        choices.append((parts, times, waste))
                    if times > 1:
                        once.append((parts, 1, waste))
                choices = [*once[::-1], *choices[::-1]]
            elif allowed >= 0:
                best = [Filling(tuple(sorted(f[1][0].items(), reverse=True)), f[1][1]) for f in frames]
                size = sum(f.times for f in best)
            ended += not choices
            frames.append([choices, None])
            if size <= bound:
                break
            if ended >= restarts or (ended and visited >= budget):
                cut = True
                break
            while frames:
                open_, used = frames[-1]
                if used:
                    lengths.use(used[0], -used[1])
                    wasted -= used[1] * used[2]
                    frames[-1][1] = None
                if open_:
                    break
                frames.pop()
            if not frames:
                break
            used = frames[-1][1] = frames[-1][0].pop()
            lengths.use(used[0], used[1])
            wasted += used[1] * used[2]
        if not cut or visited >= budget:
            break
        nodes, branches, restarts = 4 * nodes, 4 * branches, 4 * restarts
    return best


def plan_slots(plan: list[Filling]) -> dict[str, np.ndarray]:
    """The plan by length: which ranks of a length go to which sequences, and where in them."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for filling in plan:
        offset = 0
        for length, k in filling.parts:
            rank = used.get(length, 0)
            rows.append(((length << 48) | rank, k, base, offset, rank, length))
            used[length] = rank + k * filling.times
            offset += length * k
        base += filling.times
    rows.sort()
    return {
        name: np.array([r[i] for r in rows], dtype=np.int64)
        for i, name in enumerate(["key", "per", "base", "offset", "rank", "length"])
    }


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Place every document in sequences of at most `capacity` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row per piece. A null or
    empty text is the end id alone. Rows that repeat an id, or hold none, are packed as documents of
    their own. Other columns are not read. An empty table gives no rows. Only documents longer than
    `capacity` are cut; the place of equal lengths follows the reading order.
    """
    pieces = materialize(
        tokenize_pieces(docs, tokenizer_path, capacity, end_id, id_column, text_column), "pieces"
    )
    by_block = pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most `capacity` rows, however many documents there are.
    counts = {r["length"]: r["n"] for r in by_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan_slots(plan_packing(counts, capacity))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_block.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # Bounded too: fillings use up a length each, and distinct lengths in one sequence are few.
    shared = docs.sparkSession.sparkContext.broadcast(slots)

    def run(batches):
        plan = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("place").to_numpy() + batch.column("first").to_numpy()
            at = np.searchsorted(plan["key"], (length << 48) | rank, side="right") - 1
            step = rank - plan["rank"][at]
            sequence = plan["base"][at] + step // plan["per"][at]
            offset = plan["offset"][at] + (step % plan["per"][at]) * length
            kept = [batch.column(c) for c in ["doc_id", "piece", "start", "length", "ids_crc32"]]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return pieces.join(starts, ["block", "length"]).mapInArrow(run, schema)
