import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from searchlake.llm.token_counts import MARK, Counter, count_tokens, read_vocabulary

from .helpers import corpus, docs_frame

PATH = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = read_vocabulary(PATH)
COUNTER = Counter(VOCABULARY)
TOKENIZER = Tokenizer(models.Unigram(VOCABULARY, unk_id=0, byte_fallback=True))


def expected(text, tokenizer=TOKENIZER):
    return len(tokenizer.encode(MARK + text.replace(" ", MARK)).ids) if text else 0


@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("the an  \n▁<0xA>"))), max_size=40))
@settings(max_examples=500, deadline=None)
def test_counts_are_the_tokenizers(text):
    assert COUNTER.count(text) == expected(text)


def test_ties_and_unknowns_in_small_vocabularies():
    rnd = random.Random(3)
    for trial in range(150):
        pieces = {"".join(rnd.choice("abc▁") for _ in range(rnd.randrange(1, 4))) for _ in range(rnd.randrange(1, 9))}
        vocabulary = [("<unk>", 0.0)] + [(p, -rnd.random() if trial % 3 == 0 else float(-rnd.randrange(1, 5))) for p in sorted(pieces)]
        counter, tokenizer = Counter(vocabulary), Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
        for _ in range(40):
            text = "".join(rnd.choice("abcd▁ ") for _ in range(rnd.randrange(1, 12)))
            assert counter.count(text) == expected(text, tokenizer), (vocabulary, text)


def test_operator(spark):
    rows = corpus(9) + [(800, "日本 x" * 6000), (801, "z" * 30_000)]
    got = count_tokens(docs_frame(spark, rows, extra=True), PATH).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(((i, expected(t or "")) for i, t in rows), key=key)
    assert count_tokens(docs_frame(spark, rows).limit(0), PATH).collect() == []
