import numpy as np
import pytest
from pyspark.sql import functions as F

from searchlake.llm import language_id as L

from .helpers import docs_frame

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return L.train(docs, usable=F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


def test_held_out_accuracy(spark):
    got = L.query(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out AND lang IS NOT NULL")
    n, right, low, high = held.agg(F.count(F.lit(1)), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert n > 200 and right / n > 0.97 and 0 <= low and high <= 1
    assert got.filter("NOT accepted").count() < 0.01 * got.count()


def test_undetermined(spark, model):
    texts = [None, "", " \n", "12 34 !!", "...", "日本語", "ñ", "a", "the of and " * 50_000]
    df = docs_frame(spark, list(enumerate(texts)), extra=True)
    got = {r["doc_id"]: r for r in L.predict_language(df, model).collect()}
    assert [got[i]["lang_pred"] == "und" for i in range(9)] == [True] * 5 + [False] * 4
    assert all(got[i]["score"] == 0 and not got[i]["accepted"] for i in range(5))
    assert got[8]["lang_pred"] == "en" and got[8]["row"] == "x-row" and got[8]["text"] == texts[8]


def test_prediction_is_the_mean_of_embeddings(model):
    """Vectorised prediction against one n-gram at a time."""
    texts = ["Der Hund, die Katze 12", "le chat", "É", "x y z", "ab\tcd\n" * 30, "", "la casa de"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    best, score, accepted = L.predictor(model)(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for i, r in enumerate(raw):
        if not r:
            assert best[i] == -1
            continue
        one, s, ok = L.predictor(model)(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert one[0] == best[i] and abs(s[0] - score[i]) < 1e-6 and ok[0] == accepted[i]
        grams, _ = L.subwords(np.frombuffer(r, np.uint8), np.array([0, len(r)]), len(model.logits) - 1)
        inside = np.concatenate([g[g < len(model.logits) - 1] for g in grams])
        assert len(inside) == sum(max(0, len(r) + 2 - k + 1) for k in L.ORDERS)
        z = (model.logits[inside].astype(float).mean(0) + model.bias) / model.temperature
        assert int(z.argmax()) == best[i]
        likely = model.typical[inside, best[i]].astype(float).mean() + 4 * model.spread / len(inside) ** 0.5
        assert accepted[i] == (score[i] >= model.threshold and likely >= model.floor)


def test_no_labels_and_empty_table(spark):
    df = docs_frame(spark, [(1, "some text"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    nothing = L.train(df)
    assert [tuple(r)[-3:] for r in L.predict_language(df, nothing).collect()] == [("und", 0.0, True), ("und", 0.0, False)]
    assert L.predict_language(df.limit(0), nothing).collect() == []


def test_repeated_and_null_ids_train(spark):
    rows = [(None, "le chat est la", "fr"), (1, "le chat est la", "fr"), (1, "le chat est la", "fr"), (2, "the cat is there", "en"), (3, "", "en"), (4, None, "fr")]
    model = L.train(docs_frame(spark, rows))
    assert model.languages == ["en", "fr"]


def test_examples_count_whole_texts():
    """A long text counts as prediction does; its cut is a further example."""
    import pyarrow as pa
    buckets = 1 << 15
    texts = ["le chat " * 3, "".join(f"the word {i} " for i in range(2000)) + "der Hund und die Katze"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["fr", "en"]), pa.array(texts)], ["doc_id", "lang", "text"])
    got = [r for b in L._examples(buckets, 4096)([batch]) for r in b.to_pylist()]
    assert [(r["doc_id"], r["whole"]) for r in got] == [(1, True), (2, True), (2, False)]
    for r, text in zip(got, texts):
        data = np.frombuffer(text.encode(), np.uint8)
        grams, _ = L.subwords(data, np.array([0, len(data)]), buckets)
        want = np.bincount(np.concatenate(grams), minlength=buckets + 1)[:buckets]
        have = np.zeros(buckets)
        have[np.frombuffer(r["ids"], np.uint32)] = np.frombuffer(r["counts"], np.uint16)
        assert (have == want).all()
    assert 64 <= np.frombuffer(got[2]["counts"], np.uint16).sum() < 2 * 4096 + 4


def test_threshold_rejects_the_stated_share_of_held_whole_texts():
    """Cuts are neither held out nor trained on with a held text; of 400 held texts two lie below the threshold."""
    random = np.random.default_rng(1)
    examples = []
    for i in range(2000):
        label = int(random.integers(0, 5))
        ids = np.unique(np.append(random.integers(0, 40, 12), 40 + (label if random.random() < 0.7 else random.integers(0, 5)))).astype(np.uint32)
        examples.append((i, "abcde"[label], True, ids, np.ones(len(ids), np.float32)))
        examples.append((i, "abcde"[label], False, ids[:1], np.ones(1, np.float32)))
    model = L.fit(examples, 128, epochs=30, reject_rate=0.005)
    held = [e for e in examples if e[2]][::5]
    z = np.array([(model.logits[e[3]].mean(0) + model.bias) / model.temperature for e in held], np.float64)
    score = np.sort((np.exp(z - z.max(1, keepdims=True)) / np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True)).max(1))
    assert score[2] < 0.5 and abs(model.threshold - score[2]) < 1e-6


OTHERS = [
    "Alla människor är födda fria och lika i värde och rättigheter. De är utrustade med förnuft och samvete och bör handla gentemot varandra.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
    "جميع الناس يولدون أحرارا متساوين في الكرامة والحقوق وقد وهبوا عقلا وضميرا",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván.",
    "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_rejects_what_it_has_not_learned(spark, sf):
    """Other scripts, other languages and noise go, held-out text of the learned languages stays."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = L.train(docs, usable=~held)
    assert 1e-3 < model.temperature < 1e3 and np.isfinite(model.floor)
    random = np.random.default_rng(3)
    keys = list("abcdefghijklmnopqrstuvwxyz    ")
    noise = ["".join(random.choice(keys, int(random.integers(50, 500)))) for _ in range(60)]
    noise += [" ".join("%08x" % x for x in random.integers(0, 2**32, 30)) for _ in range(20)]
    noise += ["".join(chr(x) for x in random.integers(0x4E00, 0x9FFF, 100)) for _ in range(20)]
    strange = L.predict_language(docs_frame(spark, list(enumerate(noise + OTHERS * 4))), model).collect()
    assert sum(r["accepted"] for r in strange) < 0.1 * len(strange)
    assert sum(r["accepted"] for r in strange[len(noise):]) == 0
    known = L.predict_language(docs.filter(held & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")), model)
    n, out = known.agg(F.count(F.lit(1)), F.count_if(~F.col("accepted"))).first()
    assert n > 200 and out <= 0.01 * n


def test_many_languages_in_bounded_blocks():
    """Sums taken in blocks equal those taken at once."""
    random = np.random.default_rng(0)
    table = random.normal(size=(65, 50)).astype(np.float32)
    rows, docs = random.integers(0, 65, 10_000), np.array([0, 1, 2, 5000, 5001, 10_000])
    want = np.add.reduceat(table[rows].astype(float), docs[:-1], axis=0)
    before, L.GATHERED = L.GATHERED, 50 * 7
    try:
        assert np.allclose(L._sums(table, rows, docs), want, atol=1e-3)
    finally:
        L.GATHERED = before


def test_all_right_has_a_finite_temperature():
    scores = np.array([[9.0, 0.0], [0.0, 8.0], [7.0, -1.0]] * 30)
    t = L._temperature(scores, scores.argmax(1))
    assert 1e-3 < t < 1e3 and L._temperature(scores[:, :1], np.zeros(90, int)) == 1.0 and L._temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0
