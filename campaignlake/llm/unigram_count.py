"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; a Viterbi pass keeps
the best score and the number of pieces up to each place. Ties go as in the public unigram tokenizer:
a later candidate must score strictly higher, and candidates come by start, so the longest last piece
wins; characters that no piece covers are unknown, neighbouring ones are one unknown token, and that
falls back to its bytes. Words (white space before them becomes the mark U+2581) are counted once each.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .common import grouped, worker_state

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "\u2581"
# Fixed value: what an unknown character scores below the lowest piece.
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 700_000
# Characters that Python takes for white space and the tokenizer does not.
_ODD = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in id order, without its control symbols."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size()) if not model.is_control(i)
    ]


def split_words(text: str) -> list[str]:
    return [w for w in _SPACE.split(text) if w] if _ODD.search(text) else text.split()


class PieceCounter:
    """Counts pieces of words and remembers the words."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.vocabulary = dict(pieces)
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.vocabulary.items():
            if piece != "<unk>":
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.bytes = all(f"<0x{k:02X}>" in self.vocabulary for k in range(256))
        self.known: dict[str, int] = {}

    def run_of_unknown(self, text: str) -> int:
        if text in self.vocabulary:
            return 1
        return len(text.encode("utf-8", "surrogatepass")) if self.bytes else 1

    def of_word(self, word: str) -> int:
        """Pieces of a word behind its mark; marks inside the word begin words of their own."""
        marked = word if word.startswith(MARK) else MARK + word
        return sum(self.count(MARK + part) for part in marked[1:].split(MARK))

    def count(self, text: str) -> int:
        """Pieces of one marked word."""
        n = len(text)
        score, pieces, open_at = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        done = 0

        # Matches come by end, the longest first; `done` is the last end that is settled.
        def settle(end, matches):
            best, at, one = None, -1, False
            for length, value in matches:
                start = end - length
                candidate = value + score[start]
                if best is None or candidate > best:
                    best, at = candidate, start
                one = one or length == 1
            if not one:
                candidate = self.unknown + score[end - 1]
                if best is None or candidate > best:
                    score[end], pieces[end] = candidate, pieces[end - 1]
                    open_at[end] = open_at[end - 1] if open_at[end - 1] >= 0 else end - 1
                    return
            closed = self.run_of_unknown(text[open_at[at] : at]) if open_at[at] >= 0 else 0
            score[end], pieces[end] = best, pieces[at] + closed + 1

        held: list[tuple[int, float]] = []
        for last, match in self.automaton.iter(text):
            if last + 1 != done and held:
                settle(done, held)
                held = []
            while done < last:
                done += 1
                settle(done, [])
            done = last + 1
            held.append(match)
        if held:
            settle(done, held)
        while done < n:
            done += 1
            settle(done, [])
        return pieces[n] + (self.run_of_unknown(text[open_at[n] : n]) if open_at[n] >= 0 else 0)

    def counts(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pieces, words) of each text."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known, out = self.known, []
        for text in texts:
            found = split_words(text)
            numbers = list(map(known.get, found))
            if None in numbers:
                for i, x in enumerate(numbers):
                    if x is None:
                        word = found[i]
                        numbers[i] = known[word] if word in known else self.of_word(word)
                        if len(word) <= 64:
                            known[word] = numbers[i]
            out.append((sum(numbers), len(found)))
        return out


def count_tokens(
    docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id, n_tokens and n_words of every row, whole texts.

    A null or empty text has none. Rows that repeat an id, or hold none, are counted as they stand. Other
    columns are not read. An empty table gives no rows. Memory per task is the vocabulary, a bounded table
    of known words and one run of texts; a word without white space takes time in proportion to its length.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(vocabulary(model_path))

    def run(batches):
        counter = worker_state(f"pieces {model_path}", lambda: PieceCounter(pieces.value))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = list(grouped(counter.counts, texts))
            tokens, found = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.int64()), pa.array(found, pa.int64())],
                names=["doc_id", "n_tokens", "n_words"],
            )

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_tokens long, n_words long")
