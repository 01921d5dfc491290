"""Operator 8: substring dedup with difference-cover anchors.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``length`` (13)
consecutive words of one document. Each word covered by a window whose word
sequence also starts in a document with a smaller ``doc_id`` is removed;
windows are judged on the input.

Difference cover: with period 7 and cover {1, 2, 4}, every residue is a
difference of two cover residues. So for any two places i, j there is a shift
d < 7 with i + d and j + d both at cover positions, and two equal runs of 13
words share an anchor, the 7 words from such a place, at the same shift. Hence
only 3 of 7 positions are hashed in the first round:

1. documents are dealt into chunks of a few MB by hash; each chunk sends its
   distinct anchor hashes, as one sorted block per hash range, to that range;
2. a range answers each chunk with the anchors that occur in several documents;
3. *extension*: a chunk takes the 13-word windows that contain such an anchor
   and sends their 96-bit hashes, with the smallest and largest doc_id;
4. a range answers with the smallest doc_id of every window, where it is
   smaller than one in the asking chunk;
5. the chunk removes the covered words.

A passage shared by a third of all documents occurs once in a chunk's block,
however many of the chunk's documents hold it, so no task gathers its holders.
The three passes over the chunks read the same shuffled texts.

Cases: null text has no words. Rows with a null ``doc_id`` neither lose words
nor make others lose them; rows that share a ``doc_id`` are judged each, and do
not make one another lose words. Other columns are not looked at; an empty
table gives an empty result. A document is one unit of work: memory is about 60
bytes a word of the longest document, or of a chunk of ``chunk_bytes``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as tc
from .common import parts_for, prepare, text_bytes

#: Perfect difference sets {residues} by period: each non-zero residue is a difference.
COVERS = {3: (0, 1), 7: (1, 2, 4), 13: (0, 1, 3, 9)}
CHUNK_BYTES = 2 << 20
RANGE_BYTES = 16 << 20


def period_for(length: int) -> int:
    """Largest period that leaves an anchor of at least half a window."""
    return max([p for p in COVERS if length - p + 1 >= max(2, length // 2)], default=1)


class _Chunk:
    """Words of one chunk's documents that have an id."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").combine_chunks()
        self.has_id = np.asarray(ids.is_valid())
        self.ids = np.asarray(ids.fill_null(0), dtype=np.int64)
        self.data, self.offsets = tc.buffers(table.column("text"))
        self.starts, self.ends, self.docs = tc.words(self.data, self.offsets)
        self.doc = tc.rows_of(self.docs)
        self.known = self.has_id[self.doc]

    def hashes(self, seed: int) -> np.ndarray:
        return tc.word_hashes(self.data, self.starts, self.ends, seed)

    def whole(self, k: int) -> np.ndarray:
        """Whether k words from here lie in one document that has an id."""
        n = len(self.doc) - k + 1
        if n <= 0:
            return np.zeros(0, bool)
        return (self.doc[:n] == self.doc[k - 1:]) & self.known[:n]


def _anchors(chunk: _Chunk, hashes: np.ndarray, length: int):
    """Positions and hashes (lowest bit cleared) of the anchors."""
    period = period_for(length)
    width = length - period + 1
    at = np.arange(len(chunk.doc)) - chunk.docs[chunk.doc]
    cover = np.zeros(period, bool)
    cover[list(COVERS.get(period, (0,)))] = True
    whole = chunk.whole(width)
    place = np.flatnonzero(whole & cover[at[:len(whole)] % period])
    return place, _gathered(hashes, place, width, 1) & ~np.uint64(1)


def _gathered(hashes: np.ndarray, place: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of the k words from each place."""
    mult = tc._odd(seed + 7, k)
    out = np.zeros(len(place), np.uint64)
    for t in range(k):
        out += hashes[place + t] * mult[t]
    return tc.mix(out)


def _range_cuts(sorted_hashes: np.ndarray, ranges: int):
    """(range, from, to) of the hash ranges that a sorted hash array touches."""
    part = ((sorted_hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(part, prepend=part[:1] - np.uint64(1) if len(part) else part))
    for i, j in zip(cuts, [*cuts[1:], len(part)]):
        yield int(part[i]), int(i), int(j)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted key columns."""
    new = np.zeros(len(keys[0]), bool)
    if len(new):
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _packed(numbers: np.ndarray) -> bytes:
    """Integers as base, width and differences of the least width that holds them."""
    base = numbers.min()
    delta = (numbers - base).astype(np.uint64)
    kind = np.min_scalar_type(delta.max())
    return np.int64(base).tobytes() + bytes([kind.itemsize]) + delta.astype(kind).tobytes()


def _unpacked(column) -> np.ndarray:
    """All packed integers of a column, in a row."""
    parts = [np.zeros(0, np.int64)]
    for x in column.to_pylist():
        delta = np.frombuffer(x, f"u{x[8]}", offset=9).astype(np.uint64).view(np.int64)
        parts.append(delta + np.frombuffer(x, np.int64, 1))
    return np.concatenate(parts)


def _low(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _arrays(column, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]


def _send_anchors(length: int, ranges: int):
    def run(key, table):
        chunk = _Chunk(table)
        place, h = _anchors(chunk, chunk.hashes(0), length)
        order = np.argsort(h)
        h, ids = h[order], chunk.ids[chunk.doc[place[order]]]
        at = _runs(h)
        rows = []
        if len(at):
            several = np.minimum.reduceat(ids, at) != np.maximum.reduceat(ids, at)
            h = h[at] | several.astype(np.uint64)
            rows = [(r, key[0].as_py(), h[i:j].tobytes()) for r, i, j in _range_cuts(h, ranges)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[], [], []], (pa.int32(), pa.int64(), pa.binary()))],
                        names=["range", "chunk", "hashes"])
    return run


def _answer_anchors(key, table):
    blocks = _arrays(table.column("hashes"), np.uint64)
    chunks = table.column("chunk").to_pylist()
    every = np.concatenate(blocks)
    h = every & ~np.uint64(1)
    order = np.argsort(h)
    s = h[order]
    equal = s[1:] == s[:-1]
    shared = (every[order] & np.uint64(1)).astype(bool)
    shared[1:] |= equal
    shared[:-1] |= equal
    asked = np.empty(len(every), bool)
    asked[order] = shared
    ends = np.cumsum([len(b) for b in blocks])
    rows = [(c, h[e - len(b):e][asked[e - len(b):e]].tobytes()) for c, b, e in zip(chunks, blocks, ends)]
    rows = [r for r in rows if r[1]]
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                    names=["chunk", "hashes"])


def _send_windows(length: int, ranges: int):
    columns = ("hi", "lo", "least", "wide")

    def run(key, table, answers):
        rows = []
        shared = np.sort(np.concatenate([np.zeros(0, np.uint64), *_arrays(answers.column("hashes"), np.uint64)]))
        if table.num_rows and len(shared):
            chunk = _Chunk(table)
            first = chunk.hashes(0)
            place, h = _anchors(chunk, first, length)
            found = shared[np.minimum(np.searchsorted(shared, h), len(shared) - 1)] == h
            hit = np.zeros(len(chunk.doc) + 1, np.int64)
            hit[place[found] + 1] = 1
            seen = np.cumsum(hit)
            whole = chunk.whole(length)
            period = period_for(length)
            s = np.flatnonzero(whole)
            s = s[seen[s + period] > seen[s]]
            hi, lo = _gathered(first, s, length, 2), _low(_gathered(chunk.hashes(1), s, length, 3))
            ids = chunk.ids[chunk.doc[s]]
            order = np.lexsort((lo, hi))
            hi, lo, ids = hi[order], lo[order], ids[order]
            at = _runs(hi, lo)
            if len(at):
                least, most = np.minimum.reduceat(ids, at), np.maximum.reduceat(ids, at)
                hi, lo = hi[at], lo[at]
                rows = [(r, key[0].as_py(), hi[i:j].tobytes(), lo[i:j].tobytes(), _packed(least[i:j]), _packed((most - least)[i:j]))
                        for r, i, j in _range_cuts(hi, ranges)]
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                         *[pa.array([r[2 + c] for r in rows], pa.binary()) for c in range(4)]],
                        names=["range", "chunk", *columns])
    return run


def _answer_windows(key, table):
    his, los = _arrays(table.column("hi"), np.uint64), _arrays(table.column("lo"), np.uint32)
    hi, lo = np.concatenate(his), np.concatenate(los)
    least = _unpacked(table.column("least"))
    most = least + _unpacked(table.column("wide"))
    order = np.lexsort((lo, hi))
    at = _runs(hi[order], lo[order])
    first = np.empty(len(hi), np.int64)
    first[order] = np.repeat(np.minimum.reduceat(least[order], at), np.diff([*at, len(hi)]))
    later = first < most
    rows, e = [], 0
    for c, b in zip(table.column("chunk").to_pylist(), his):
        b, e = slice(e, e + len(b)), e + len(b)
        if later[b].any():
            rows.append((c, hi[b][later[b]].tobytes(), lo[b][later[b]].tobytes(), _packed(first[b][later[b]])))
    return pa.table([pa.array([r[0] for r in rows], pa.int64()),
                     *[pa.array([r[1 + c] for r in rows], pa.binary()) for c in range(3)]],
                    names=["chunk", "hi", "lo", "first"])


def _remove(length: int):
    def run(key, table, answers):
        if not table.num_rows:
            return _result(pa.array([], pa.int64()), [], [], pa.array([], pa.string()), [])
        chunk = _Chunk(table)
        n = len(chunk.doc)
        hi, lo = (np.concatenate([np.zeros(0, t), *_arrays(answers.column(c), t)]) for c, t in (("hi", np.uint64), ("lo", np.uint32)))
        first = _unpacked(answers.column("first"))
        gone = np.zeros(n, bool)
        if len(hi):
            order = np.lexsort((lo, hi))
            hi, lo, first = hi[order], lo[order], first[order]
            s = np.flatnonzero(chunk.whole(length))
            h = _gathered(chunk.hashes(0), s, length, 2)
            left = np.searchsorted(hi, h)
            known = hi[np.minimum(left, len(hi) - 1)] == h
            s, h, left = s[known], h[known], left[known]
            low, ids = _low(_gathered(chunk.hashes(1), s, length, 3)), chunk.ids[chunk.doc[s]]
            later = np.zeros(len(s), bool)
            for step in range(int(np.max(np.diff([*_runs(hi), len(hi)])))):  # 1, but for equal first halves
                i = np.minimum(left + step, len(hi) - 1)
                later |= (hi[i] == h) & (lo[i] == low) & (first[i] < ids)
            cover = np.zeros(n + 1, np.int64)
            cover[s[later]] += 1
            cover[s[later] + length] -= 1
            gone = np.cumsum(cover)[:n] > 0
        return _result(table.column("doc_id"), np.diff(chunk.docs), _per_doc(gone, chunk.docs),
                       kept_text(chunk, ~gone), _spans(gone, chunk.docs))
    return run


def _per_doc(flags: np.ndarray, docs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[docs[1:]] - total[docs[:-1]]


def _spans(gone: np.ndarray, docs: np.ndarray) -> list:
    """Removed word ranges [from, to) of every document."""
    out = [[] for _ in range(len(docs) - 1)]
    cut = np.zeros(len(gone) + 1, bool)
    cut[docs] = True
    before = np.concatenate([[False], gone[:-1]]) if len(gone) else gone
    after = np.concatenate([gone[1:], [False]]) if len(gone) else gone
    begin = np.flatnonzero(gone & (~before | cut[:-1]))
    end = np.flatnonzero(gone & (~after | cut[1:])) + 1
    for d, b, e in zip(np.searchsorted(docs, begin, side="right") - 1, begin, end):
        out[d].append({"start": int(b - docs[d]), "end": int(e - docs[d])})
    return out


def kept_text(chunk: _Chunk, keep: np.ndarray) -> pa.Array:
    """The kept words of every document, joined by one space.

    A kept word that is followed by another in its document has a separator
    byte after it, which becomes the space; all other separators go.
    """
    data = chunk.data.copy()
    data[tc.SPACE[data]] = 0x20
    delta = np.zeros(len(data) + 2, np.int8)
    s, e = chunk.starts[keep], chunk.ends[keep]
    doc = chunk.doc[keep]
    follows = np.concatenate([doc[1:] == doc[:-1], [False]]) if len(doc) else np.zeros(0, bool)
    delta[s] += 1
    delta[e + follows] -= 1
    take = np.cumsum(delta[:-2], dtype=np.int8).astype(bool)
    total = np.concatenate([[0], np.cumsum(take, dtype=np.int64)])
    return tc.strings(data[take], total[chunk.offsets])


def _result(ids, n_words, n_removed, text, spans) -> pa.Table:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), text, pa.array(spans, span)],
                    names=["doc_id", "n_words", "n_removed", "text", "removed"])


def remove_repeats(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text",
                   chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per row: doc_id, n_words, n_removed, text (kept words), removed (word ranges)."""
    prepare(docs.sparkSession)
    total = text_bytes(docs, text_col)
    chunks, ranges = parts_for(total, chunk_bytes), parts_for(total, range_bytes)
    dealt = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("long"))
    by_chunk = dealt.groupBy("chunk")

    shared = (by_chunk.applyInArrow(_send_anchors(length, ranges), "range int, chunk long, hashes binary")
              .groupBy("range").applyInArrow(_answer_anchors, "chunk long, hashes binary"))
    owned = (by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(
        _send_windows(length, ranges), "range int, chunk long, hi binary, lo binary, least binary, wide binary")
        .groupBy("range").applyInArrow(_answer_windows, "chunk long, hi binary, lo binary, first binary"))
    return by_chunk.cogroup(owned.groupBy("chunk")).applyInArrow(
        _remove(length), "doc_id long, n_words long, n_removed long, text string, "
                         "removed array<struct<start:int,end:int>>")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: digest of the kept words of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, unnest(range(0, len(ws) - 12)) AS s, ws FROM w WHERE len(ws) >= 13),
named AS (
  SELECT doc_id, s, md5(array_to_string(ws[s + 1 : s + 13], ' ')) AS h FROM windows),
hits AS (
  SELECT n.doc_id, n.s FROM named n
  JOIN (SELECT h, min(doc_id) AS least FROM named GROUP BY h) o USING (h) WHERE o.least < n.doc_id),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, 13)) AS p FROM hits),
places AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS p FROM w),
kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(p.word, ' ' ORDER BY p.p) AS txt
  FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.p = g.p GROUP BY p.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(txt, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
