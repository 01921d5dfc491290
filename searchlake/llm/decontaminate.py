"""Operator 4: benchmark decontamination by SimHash over item-sized windows.

Words are runs of ASCII letters and digits (A-Z lower-cased) and non-ASCII
bytes; features are 5-word shingles, each with the number of its occurrences
as weight. A document is contaminated by an item if one of its windows of as
many words as the item (or the whole document, if it is shorter) has a weighted
Jaccard similarity, sum of least over sum of largest weights, of at least 0.8.

1. *Windows.* Only a window that holds a shingle of some item can be similar at
   all, so windows are fingerprinted around such places, for the sizes of the
   items that hold the shingle; elsewhere the similarity is 0. Every place of
   every text is looked at.
2. *Fingerprints.* 64 bits; each is the sign of the weighted sum over shingles,
   taken for all starts at once from running sums.
3. *Multi-index.* Fingerprints of items of one size are indexed by 8 blocks of 8
   bits. A fingerprint within ``RADIUS`` = 22 bits of an item's has a block
   within 22 // 8 = 2 bits of it, so looking every block up with that tolerance
   finds all items within the radius; the full distance is then checked.
   Unrelated windows pass at 1 %.
4. *Without fingerprints.* The sign of a sum says little where few or repeated
   shingles decide it (sums tie at 0). Pairs of which the item has under
   ``DISTINCT`` shingles or a repeated one, or the window a repeated one or fewer
   shingles than the item, skip the fingerprints: of them, all windows with enough
   places whose shingle is the item's (without which 0.8 is out of reach) are
   verified. In the other pairs every shingle counts once; at similarity 0.8
   a bit then differs with probability 0.152 at most, and more than 22 of 64 with
   probability 4e-5 (exact sums of random signs up to 300 shingles, the normal
   limit above).
5. *Verification.* Survivors are compared by exact weighted-shingle similarity.
   The best window (then the earliest) of a document and item is returned.

Documents stay where they are: no shuffle. Items are sent to the tasks in blocks
of at most ``BLOCK_ITEMS`` items and about ``BLOCK_BYTES`` bytes, with one pass
over the documents for each block, so a large benchmark needs more passes, not
more memory.

Cases: null or empty texts, and items without words, match nothing. An item of
under 5 words is one shingle, as is a window of its size: it matches the same
words only. Rows with null or repeated ids are judged one by one and reported
under their ids. Equal items each report their match. Other columns are not
looked at. Empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as tc
from .common import parts_for, prepare

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 22
DISTINCT = 9
BLOCKS = 8
BLOCK_ITEMS = 16_384
BLOCK_BYTES = 8 << 20

NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

MATCH = "doc_id long, item_id long, start_word long, n_words long, similarity double, distance int"


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    starts, ends, docs = tc.words(data, offsets, NOT_WORD)
    return tc.word_hashes(data, starts, ends, fold=tc.LOWER), docs


def fingerprint_sums(shingles: np.ndarray) -> np.ndarray:
    """Running sums over shingles of +1 / -1 for each of 64 bits: (n + 1, 64)."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(2 * bits.astype(np.int8) - 1, axis=0, dtype=np.int32, out=out[1:])
    return out


def as_bytes(sums: np.ndarray) -> np.ndarray:
    """Fingerprints (n, 8 bytes) of bit sums; a sum of 0 is a 0 bit."""
    return np.packbits(sums > 0, axis=1, bitorder="little")


@dataclass
class Item:
    item_id: int
    words: int
    shingles: np.ndarray  # distinct, sorted
    weights: np.ndarray
    fingerprint: np.ndarray

    @property
    def exact(self) -> bool:
        """Whether its windows are verified without regard to fingerprints."""
        return len(self.shingles) < DISTINCT or self.weights.max() > 1


POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


#: Windows times items looked up at once.
LOOKED_UP = 1 << 21


def _lists(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, items): items of each byte value, one after the other."""
    return np.concatenate([[0], np.cumsum(near.sum(1))]), np.nonzero(near)[1].astype(np.int32)


class Index:
    """Items of one block, by size in words."""

    def __init__(self, rows: list[tuple[int, str]], radius: int = RADIUS):
        self.radius = radius
        by_size: dict[int, list[Item]] = defaultdict(list)
        for item_id, text in rows:
            data = np.frombuffer((text or "").encode(), np.uint8)
            words, _ = word_hashes(data, np.array([0, len(data)]))
            if len(words):
                every = tc.window_hashes(words, min(SHINGLE, len(words)), len(words) if len(words) < SHINGLE else 0)
                sh, w = np.unique(every, return_counts=True)
                by_size[len(words)].append(Item(item_id, len(words), sh, w, as_bytes(fingerprint_sums(every)[-1:])[0]))
        self.sizes = dict(sorted(by_size.items()))
        self.short = [n for n in self.sizes if n < SHINGLE]
        distance = POPCOUNT[np.arange(256)[:, None] ^ np.arange(256)[None, :]]
        near = distance <= radius // BLOCKS
        #: by size: item fingerprints, and for each block the items near a byte value, as one list with starts
        self.prints = {n: np.array([i.fingerprint for i in items]) for n, items in self.sizes.items()}
        self.tables = {n: [_lists(near[:, p[:, b]]) for b in range(BLOCKS)] for n, p in self.prints.items()}
        self.sieve = {n: _Sieve(np.concatenate([i.shingles for i in items])) for n, items in self.sizes.items()
                      if n < SHINGLE}
        self.exact = {n: np.array([i.exact for i in items]) for n, items in self.sizes.items()}
        held: dict[int, list] = defaultdict(list)
        for n, items in self.sizes.items():
            if n >= SHINGLE:
                for i in items:
                    for h in i.shingles.tolist():
                        held[h].append(n)
        keys = np.array(sorted(held), np.uint64)
        self.long = _Sieve(keys)
        self.sizes_of = [sorted(set(held[k])) for k in keys.tolist()]
        #: by size: shingles of all items, sorted, and the item number of each
        self.holders = {}
        for n, items in self.sizes.items():
            if n >= SHINGLE:
                sh = np.concatenate([i.shingles for i in items])
                order = np.argsort(sh, kind="stable")
                self.holders[n] = sh[order], np.repeat(np.arange(len(items)), [len(i.shingles) for i in items])[order]

    def candidates(self, n: int, prints: np.ndarray):
        """(window, item number, distance) within the radius, of windows for items of n words.

        Windows are looked up a few at a time, so that memory follows the items of the size.
        """
        items, parts = self.prints[n], []
        step = max(1, LOOKED_UP // len(items))
        for first in range(0, len(prints), step):
            some = prints[first:first + step]
            possible = np.zeros((len(some), len(items)), bool)
            for block, (starts, near) in enumerate(self.tables[n]):
                # the items that meet each window in this block: a run of the block's list
                lo = starts[some[:, block]]
                each = starts[some[:, block].astype(np.int64) + 1] - lo
                rows = np.repeat(np.arange(len(some)), each)
                possible[rows, near[np.arange(len(rows)) + np.repeat(lo - (np.cumsum(each) - each), each)]] = True
            window, item = np.nonzero(possible)
            distance = POPCOUNT[some[window] ^ items[item]].sum(1, dtype=np.int32)
            close = distance <= self.radius
            parts.append((window[close] + first, item[close], distance[close]))
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, int),) * 3

    def holding(self, n: int, shingles: np.ndarray):
        """(place, item number) for each place and item of n words that holds its shingle."""
        keys, numbers = self.holders[n]
        first, end = np.searchsorted(keys, shingles), np.searchsorted(keys, shingles, "right")
        each = end - first
        place = np.repeat(np.arange(len(shingles)), each)
        return place, numbers[np.arange(len(place)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first, each)]


class _Sieve:
    """Membership of 64-bit hashes in a fixed set."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = max(16, min(24, int(len(self.keys)).bit_length() + 7))
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[self._slot(self.keys)] = True

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return h >> np.uint64(64 - self.bits)

    def places(self, h: np.ndarray):
        """(places, key numbers) of the members among ``h``."""
        at = np.flatnonzero(self.maybe[self._slot(h)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[k] == h[at]
        return at[same], k[same]


def similarity(window: np.ndarray, item: Item) -> float:
    """Weighted Jaccard similarity of a window's shingles with an item."""
    sh, w = np.unique(window, return_counts=True)
    at = np.minimum(np.searchsorted(item.shingles, sh), len(item.shingles) - 1)
    both = np.minimum(w, item.weights[at])[item.shingles[at] == sh].sum()
    return float(both / (len(window) + item.weights.sum() - both))


def _starts(hits: np.ndarray, span: int, last: int) -> np.ndarray:
    """Starts of the windows of ``span`` shingles that hold a hit; ``last`` is the largest start."""
    delta = np.zeros(last + 2, np.int32)
    np.add.at(delta, np.clip(hits - span + 1, 0, last + 1), 1)
    np.add.at(delta, np.minimum(hits, last) + 1, -1)
    return np.flatnonzero(np.cumsum(delta[:-1]) > 0)


def _repeats(shingles: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` shingles, whether one of them occurs twice in it."""
    n = len(shingles)
    order = np.argsort(shingles, kind="stable")
    again = np.full(n, n)  # the next place of the same shingle
    same = shingles[order[1:]] == shingles[order[:-1]]
    again[order[:-1][same]] = order[1:][same]
    nearest = np.minimum.accumulate(again[::-1])[::-1]
    start = np.arange(n - span + 1)
    return nearest[start] < start + span


def _without_fingerprints(index: Index, n: int, shingles: np.ndarray, hits: np.ndarray, size: int, d: int):
    """The pairs that fingerprints are not used for, of a document's shingles and the items of n words."""
    span, weight = size - SHINGLE + 1, n - SHINGLE + 1
    # similarity s needs an overlap of s / (1 + s) of both weights, and so as many places
    least = int(np.ceil(SIMILARITY / (1 + SIMILARITY) * (span + weight) - 1e-9))
    place, number = index.holding(n, shingles[hits])
    if len(number) < least:
        return []
    enough = np.flatnonzero(np.bincount(number) >= least)
    if not len(enough):
        return []
    any_item = np.full(len(shingles) - span + 1, span < weight) | _repeats(shingles, span)
    out = []
    for q in enough.tolist():
        item, mine = index.sizes[n][q], np.zeros(len(shingles) + 1, np.int32)
        mine[hits[place[number == q]] + 1] = 1
        mine = np.cumsum(mine)
        wanted = mine[span:] - mine[:-span] >= least
        for s in np.flatnonzero(wanted if index.exact[n][q] else wanted & any_item).tolist():
            window = shingles[s:s + span]
            sim = similarity(window, item)
            if sim >= SIMILARITY:
                own = as_bytes(fingerprint_sums(window)[-1:])[0]
                out.append((d, q, n, s, size, sim, int(POPCOUNT[own ^ item.fingerprint].sum())))
    return out


def matches(index: Index, data: np.ndarray, offsets: np.ndarray):
    """(document, item, start, words, similarity, distance) of the best window of each contaminated pair."""
    words, docs = word_hashes(data, offsets)
    out = []
    counts = np.diff(docs)
    grams = tc.window_hashes(words, SHINGLE)
    doc = tc.rows_of(docs)
    place, key = index.long.places(grams)
    whole = doc[place] == doc[np.minimum(place + SHINGLE - 1, len(doc) - 1)] if len(place) else np.zeros(0, bool)
    place, key = place[whole], key[whole]
    todo: dict[tuple[int, int], list] = defaultdict(list)  # (document, size) to places
    for d, p, k in zip(doc[place].tolist(), place.tolist(), key.tolist()):
        for n in index.sizes_of[k]:
            todo[d, n].append(p - int(docs[d]))
    for (d, n), hits in todo.items():
        size = min(n, int(counts[d]))
        span, last = size - SHINGLE + 1, int(counts[d]) - size
        out += _without_fingerprints(index, n, grams[docs[d]:docs[d] + last + span], np.array(hits), size, d)
        starts = _starts(np.array(hits), span, last)
        # each run of starts needs the shingles of its windows
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > span) + 1):
            base = int(docs[d] + run[0])
            local = grams[base:base + int(run[-1] - run[0]) + span]
            sums = fingerprint_sums(local)
            rel = run - run[0]
            out += _verified(index, n, as_bytes(sums[rel + span] - sums[rel]), local, rel, span, d, run, size)
    for n in index.short:
        grams_n = tc.window_hashes(words, n, n)
        place, _ = index.sieve[n].places(grams_n)
        place = place[doc[place] == doc[np.minimum(place + n - 1, len(doc) - 1)]] if len(place) else place
        for p in place.tolist():
            d = int(doc[p])
            local = grams_n[p:p + 1]
            out += _verified(index, n, as_bytes(fingerprint_sums(local)[1:]), local, np.zeros(1, int), 1, d, np.array([p - docs[d]]), n)
    best: dict[tuple[int, int], tuple] = {}
    for d, number, n, start, size, s, distance in out:
        item = index.sizes[n][number]
        old = best.get((d, n, number))
        if old is None or (-s, start) < (-old[4], old[2]):
            best[d, n, number] = (d, item.item_id, start, size, s, distance)
    return list(best.values())


def _verified(index, n, prints, local, rel, span, d, run, size):
    found = []
    for w, number, distance in zip(*index.candidates(n, prints)):
        s = similarity(local[rel[w]:rel[w] + span], index.sizes[n][number])
        if s >= SIMILARITY:
            found.append((d, int(number), n, int(run[w]), size, s, int(distance)))
    return found


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """Lists of (id, text) of at most ``BLOCK_ITEMS`` items and about ``BLOCK_BYTES`` bytes."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").alias("text")).filter(
        F.length("text") > 0)
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(parts_for(2 * n, BLOCK_ITEMS), parts_for(size, BLOCK_BYTES)) if n > BLOCK_ITEMS else parts_for(size, BLOCK_BYTES)
    for b in range(blocks if n else 0):
        rows = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield [(r["item_id"], r["text"]) for r in rows.collect()]


def _find(index: Index):
    def run(batches):
        for batch in batches:
            data, offsets = tc.buffers(batch.column(1))
            ids, rows = batch.column(0).to_pylist(), []
            for i, j in tc.slices(offsets, 4 << 20):
                found = matches(index, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                rows += [(ids[i + m[0]], *m[1:]) for m in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], t) for c, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()))],
                [x.split()[0] for x in MATCH.split(", ")])
    return run


def _clean(index: Index, text_at: int):
    def run(batches):
        for batch in batches:
            data, offsets = tc.buffers(batch.column(text_at))
            keep = np.ones(batch.num_rows, bool)
            for i, j in tc.slices(offsets, 4 << 20):
                for m in matches(index, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]):
                    keep[i + m[0]] = False
            yield batch.filter(pa.array(keep))
    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, start_word, n_words, similarity, distance."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    result = spark.createDataFrame([], MATCH)
    for rows in item_blocks(benchmark):
        result = result.unionByName(texts.mapInArrow(_find(Index(rows)), MATCH))
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a passage of the benchmark."""
    prepare(docs.sparkSession)
    for rows in item_blocks(benchmark):
        docs = docs.mapInArrow(_clean(Index(rows), docs.columns.index(text_col)), docs.schema)
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    """op4: all contaminated documents with their items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
