import random
import re
from collections import Counter

import numpy as np

from searchlake.llm import decontaminate as D

from .helpers import corpus, docs_frame, lower

WORDS = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def grams(words, k):
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def brute(rows, items):
    """Every window of every document against every item."""
    out = {}
    for at, (_, text) in enumerate(rows):
        w = WORDS.findall(lower(text or ""))
        for q, (item, t) in enumerate(items):
            iw = WORDS.findall(lower(t or ""))
            n, k = min(len(iw), len(w)), min(5, len(iw))
            if not iw or len(w) < k:
                continue
            want, best = Counter(grams(iw, k)), None
            for s in range(len(w) - n + 1):
                have = Counter(grams(w[s:s + n], k))
                both = sum((have & want).values())
                sim = both / (sum(have.values()) + sum(want.values()) - both)
                if sim >= 0.8 and (best is None or sim > best[0]):
                    best = (sim, s, n)
            if best:
                out[at, q] = best
    return out


def fixture(seed):
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice((3, 4, 5, 8, 20, 60))))) for i in range(25)]
    items += [(25, items[5][1]), (26, ""), (27, None), (28, "Rep eat " * 15), (None, "Null item id words " * 4)]
    rows = [r for r in corpus(seed, n=20) if len(r[1] or "") < 5000]
    for i, (item, text) in enumerate(items):
        words = (text or "").split()
        if len(words) >= 50:
            words[rnd.randrange(len(words))] = "edited"
        body = " ".join(rnd.choice(vocabulary) for _ in range(30))
        rows.append((1000 + i, f"{body}. {', '.join(words).upper()}! {body}"))
    rows.append((2000, items[4][1][:-6]))
    rows.append((None, items[5][1]))
    return rows, items


def test_matches_brute_force(spark):
    rows, items = fixture(1)
    df = spark.createDataFrame(items, "item_id long, text string")
    want = Counter((rows[at][0], items[q][0], s, n, round(sim, 6)) for (at, q), (sim, s, n) in brute(rows, items).items())
    got = D.find_contamination(docs_frame(spark, rows, extra=True), df).collect()
    assert Counter((r["doc_id"], r["item_id"], r["start_word"], r["n_words"], round(r["similarity"], 6)) for r in got) == want
    assert len(want) > 20
    clean = {r["doc_id"] for r in D.drop_contaminated(docs_frame(spark, rows, extra=True), df).collect()}
    assert clean == {r[0] for at, r in enumerate(rows) if not any(a == at for a, _ in brute(rows, items))}


def test_items_in_blocks(spark, monkeypatch):
    rows, items = fixture(2)
    df = spark.createDataFrame(items, "item_id long, text string")
    whole = D.find_contamination(docs_frame(spark, rows), df).collect()
    monkeypatch.setattr(D, "BLOCK_BYTES", 600)
    parts = D.find_contamination(docs_frame(spark, rows), df).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, parts)) and len(list(D.item_blocks(df))) > 2


def test_multi_index_finds_all_within_the_radius():
    rnd = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in rnd.integers(0, 10**6, 20))) for i in range(60)]
    index = D.Index(rows)
    prints = rnd.integers(0, 256, (500, 8), dtype=np.uint8)
    prints[:60] = index.prints[20]
    for i in range(60):  # up to 24 flipped bits
        for bit in rnd.choice(64, i % 25, replace=False):
            prints[i, bit // 8] ^= 1 << (bit % 8)
    window, item, distance = index.candidates(20, prints)
    every = D.POPCOUNT[prints[:, None, :] ^ index.prints[20][None]].sum(2)
    assert set(zip(window.tolist(), item.tolist())) == set(map(tuple, np.argwhere(every <= D.RADIUS).tolist()))
    assert (every[window, item] == distance).all()


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    docs = docs_frame(spark, [(1, "one two three four five six")])
    assert D.find_contamination(docs, df).count() == 1
    assert D.find_contamination(docs.limit(0), df).count() == 0 and D.find_contamination(docs, df.limit(0)).count() == 0
    assert D.drop_contaminated(docs, df.limit(0)).count() == 1


def buffers(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])


def test_few_or_repeated_shingles_are_never_missed():
    """Fingerprints of such windows lie beyond the radius in some percent of the pairs."""
    tied = [(i, f"a{i} b{i} " * 15) for i in range(300)]  # two shingles, 13 of each
    found = D.matches(D.Index(tied), *buffers([f"{' '.join(t.split()[:-1])}" for _, t in tied]))
    assert sorted((m[0], m[1]) for m in found) == [(i, i) for i in range(300)]
    assert {round(m[4], 6) for m in found} == {round(25 / 26, 6)}
    # items without repeats; the window ends in one word ten times
    plain = [(i, " ".join(f"w{i}x{j}" for j in range(94))) for i in range(300)]
    found = D.matches(D.Index(plain), *buffers([" ".join(t.split()[:84]) + " z" * 10 for _, t in plain]))
    assert sorted((m[0], m[1]) for m in found) == [(i, i) for i in range(300)]
    assert {m[4] for m in found} == {0.8}
    # five shingles, of which a shorter document holds four
    few = [(i, " ".join(f"w{i}x{j}" for j in range(9))) for i in range(2000)]
    found = D.matches(D.Index(few), *buffers([" ".join(t.split()[:-1]) for _, t in few]))
    assert sorted((m[0], m[1]) for m in found) == [(i, i) for i in range(2000)]


def test_many_items_of_one_size_in_bounded_memory():
    """16,384 items of one size against a document of 5000 windows; the lookup equals a direct comparison."""
    import tracemalloc

    import numpy as np
    from searchlake.llm import decontaminate as D
    random = np.random.default_rng(0)
    index = D.Index([(i, " ".join(f"w{x}" for x in random.integers(0, 400, 12))) for i in range(16_384)])
    prints = random.integers(0, 256, (5000, 8)).astype(np.uint8)
    prints[::500] = index.prints[12][::1639][:10] ^ 1
    tracemalloc.start()
    window, item, distance = index.candidates(12, prints)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20
    got = set(zip(window.tolist(), item.tolist()))
    for w in range(0, 5000, 250):
        apart = D.POPCOUNT[prints[w] ^ index.prints[12]].sum(1)
        assert {i for x, i in got if x == w} == set(np.flatnonzero(apart <= index.radius).tolist())
