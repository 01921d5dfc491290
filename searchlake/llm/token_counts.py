"""Operator 10: token counts by a count-only Viterbi pass.

The number of tokens a unigram tokenizer makes of a text: the segmentation into
vocabulary pieces with the largest sum of scores. Pieces and scores come from a
public vocabulary file, whose path is a parameter. An Aho-Corasick automaton
enumerates the pieces that end at each place; the dynamic program carries the
best score and the number of pieces of that path, and no back pointers.

Tie and fallback rules, as in the unigram model of the ``tokenizers`` library:

- of paths with equal scores to a place, the one whose last piece starts first
  wins (starts are tried in order, and only a larger score replaces);
- where no piece is one character long, that character can be unknown, at the
  least score minus 10;
- an unknown character counts as its UTF-8 bytes if the vocabulary has all byte
  pieces; else neighbouring unknown characters are one token.

White space: as in the vocabulary file's own normaliser, a space before the text
and all spaces become U+2581, and other characters are unchanged. When no piece
has that mark after another character and all scores are whole numbers (sums are
then exact in any order), a text may be cut before each run of marks without
changing the result, so repeated words are counted once and cached.

There is no shuffle; a task needs the cache (``GENERATION`` words, twice) and one
text. Cases: null or empty text has 0 tokens; a null ``doc_id`` stays null. Other
columns are not looked at.
"""

from __future__ import annotations

import re
from array import array
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

MARK = "▁"
UNKNOWN_PENALTY = 10.0
GENERATION = 250_000
#: Longer units are not cached.
LONG = 64
RUNS = re.compile(f"{MARK}+[^{MARK}]*")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in id order."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(reversed(vocabulary)).items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        names = {p for p, _ in vocabulary}
        self.by_bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.by_word = (all(float(s).is_integer() and abs(s) < 2**31 for _, s in vocabulary) and MARK in names
                        and not any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in vocabulary))
        self.words: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def segment(self, text: str) -> int:
        """Tokens of a text that has its marks already."""
        n = len(text)
        if n <= 10_000 and self.single.issuperset(text):  # no unknown character: pieces end at every place
            best, count = [0.0] + [-inf] * n, [0] * (n + 1)
            for at, (length, score) in self.automaton.iter(text):  # by end, then longest first
                end, start = at + 1, at + 1 - length
                score += best[start]
                if score > best[end]:
                    best[end], count[end] = score, count[start] + 1
            return count[n]
        large = n > 10_000
        best = array("d", bytes(8 * n + 8)) if large else [0.0] * (n + 1)
        count = array("q", bytes(8 * n + 8)) if large else [0] * (n + 1)
        unknown_last = bytearray(n + 1)  # the best path to here ends in an unknown character
        done = opened = 0  # the last place where pieces end, and the last one not closed yet

        def close(end: int, has_piece: bool) -> None:
            """The unknown character before ``end``, tried after all pieces, which start earlier."""
            char = text[end - 1]
            if char in self.single:
                return
            score = best[end - 1] + self.unknown
            if not has_piece or score > best[end]:
                best[end] = score
                count[end] = count[end - 1] + (len(char.encode("utf-8", "surrogatepass")) if self.by_bytes
                                               else 1 - unknown_last[end - 1])
                unknown_last[end] = 1

        for at, (length, score) in self.automaton.iter(text):  # by end, then longest first
            end = at + 1
            if end > done:
                if done and done == opened:
                    close(done, True)
                for place in range(done + 1, end):
                    close(place, False)
                done = opened = end
                best[end], count[end] = best[end - length] + score, count[end - length] + 1
            elif best[end - length] + score > best[end]:
                best[end], count[end] = best[end - length] + score, count[end - length] + 1
        if done and done == opened:
            close(done, True)
        for place in range(done + 1, n + 1):
            close(place, False)
        return count[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self.segment(marked)
        if len(self.words) > GENERATION:
            self.older, self.words = self.words, {}
        # without repeated marks this is the same as RUNS.findall, but for the mark itself
        units = text.split(" ") if MARK * 2 not in marked and MARK not in text else None
        if units is None:
            units = [u[1:] for u in RUNS.findall(marked)]
        words, total = self.words, 0
        try:
            return sum(map(words.__getitem__, units))
        except KeyError:
            pass
        for unit in units:
            n = words.get(unit)
            if n is None:
                n = self.older.get(unit)
                if n is None:
                    n = self.segment(MARK + unit)
                if len(unit) <= LONG:
                    words[unit] = n
            total += n
        return total


_SHARED: dict[str, Counter] = {}


def shared(path: str) -> Counter:
    """One counter per worker process and file."""
    if path not in _SHARED:
        _SHARED[path] = Counter(read_vocabulary(path))
    return _SHARED[path]


def _run(path: str):
    def run(batches):
        counter = shared(path)
        for batch in batches:
            counts = [counter.count(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_tokens."""
    prepare(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _run(vocabulary), "doc_id long, n_tokens long")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: tokens of every document."""
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
