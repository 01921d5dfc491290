import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from searchlake.llm import bpe
from searchlake.llm.packing import pack, plan_slots, sequences

from .helpers import corpus, docs_frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("ab 's\n\t.1é "))), max_size=40))
@settings(max_examples=400, deadline=None)
def test_encoder_is_the_tokenizer(text):
    assert bpe.shared(PATH).encode(text).tolist() == ids(text)[:-1]


def test_special_strings_and_odd_space():
    for text in ("a <|endoftext|> b", "a  b　c", "a\x1c b", "  a  ", "\n\n b", "it's we'll I'M", "中文 text 12", "a​ b"):
        assert bpe.shared(PATH).encode(text).tolist() == ids(text)[:-1]


@pytest.mark.parametrize("size", [8, 64])
def test_pack(spark, size):
    rows = corpus(6) + [(3, "again"), (3, "again")]
    got = pack(docs_frame(spark, rows, extra=True), PATH, size=size, with_ids=True).collect()
    wanted = Counter()
    for i, text in rows:
        every = ids(text)
        head = len(every) % size or size
        cuts = [0, *range(head, len(every) + 1, size)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted[i, piece, a, b - a, zlib.crc32(np.array(every[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == wanted
    filled = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r["length"] for r in got)
    assert len(filled) <= -(-total // size) * 1.05 + 2


def plain_best_fit(lengths, size):
    free, n = [], 0
    for x in sorted(lengths, reverse=True):
        fits = [s for s in free if s >= x]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - x)
        else:
            n += 1
            free.append(size - x)
    return n


def test_plan_equals_best_fit_decreasing():
    rnd = random.Random(4)
    for _ in range(40):
        size = rnd.choice((10, 50, 100))
        counts = {rnd.randrange(1, size + 1): rnd.randrange(1, 30) for _ in range(rnd.randrange(1, 15))}
        plan = plan_slots(counts, size)
        used = set()
        for length, n in counts.items():
            runs = plan[length]
            for (rank, first, each, _), nxt in zip(runs, [*(r[0] for r in runs[1:]), n]):
                used.update(first + k // each for k in range(nxt - rank))
        assert len(used) == plain_best_fit([x for x, n in counts.items() for _ in range(n)], size)


def test_one_length_and_sequences(spark):
    rows = [(i, "same text") for i in range(2000)]
    packed = pack(docs_frame(spark, rows), PATH, size=32, with_ids=True)
    each = 32 // len(ids("same text"))
    got = sequences(packed).collect()
    assert len(got) == -(-2000 // each)
    assert all(np.frombuffer(r["ids"], "<u4").tolist() in (ids("same text") * each, ids("same text") * (2000 % each)) for r in got)


def test_empty_table(spark):
    assert pack(docs_frame(spark, [(1, "a")]).limit(0), PATH).collect() == []


def test_rank_over_salts(spark, monkeypatch):
    """A frequent length is ranked in many salts, without gaps."""
    from searchlake.llm import packing
    monkeypatch.setattr(packing, "LEAST_PER_SALT", 7)
    df = spark.range(500).selectExpr("id doc_id", "0 piece", "0L start", "case when id % 10 = 0 then 5L else 3L end length", "id ids_crc32")
    got = packing.ranked(df, {5: 50, 3: 450}).collect()
    assert sorted(r["rank"] for r in got if r["length"] == 5) == list(range(50))
    assert sorted(r["rank"] for r in got if r["length"] == 3) == list(range(450))
