"""Operator 1: language ID by averaged hashed subword embeddings.

A text's features are its byte n-grams (3 and 4 bytes, ASCII and Latin-1 letters
lower-cased, digits and white space folded, one space before and after the
text), hashed into ``buckets`` (a power of two) rows of an embedding table. The
mean of the rows goes through a linear softmax over the languages seen in
training. Table and softmax are trained together by stochastic gradient descent
in numpy, in one task, from a sample of at most ``sample`` labelled rows; the driver
receives the trained model only. That bound is the only one: n-grams are counted over whole texts, and every row is
predicted from its whole text. So that short texts are learned too, a text longer
than a hashed length of ``cut_bytes`` >> 0 to 6 (64 at least) gives one cut of this
length and of a hashed place as a further training example.

Calibration: a fifth of the sample, whole texts, is kept from training, with its
cuts. A temperature is fitted to it, with targets short of 1 so that the fit is
finite even if all are right; ``score`` is then the probability that the prediction
is right. A text is accepted if it has a letter and passes two bars:

* ``threshold``, the score under which ``reject_rate`` of the kept rows lie, rounded
  down to whole rows (4 of 800; none of fewer than 200), at most 0.5.
* ``floor``, against texts of no learned language, which a softmax cannot tell. The
  typicality of a text is the mean log-probability of its n-grams among those of the
  predicted language's training texts, plus an allowance of 4 standard errors for its
  length; ``strange_rate`` of the kept rows lie within one standard deviation (of all
  of them) of ``floor``, or under it. N-grams that training never saw are what other scripts, other languages and noise consist of.

Prediction multiplies table and softmax once into one row of logits per bucket, with
the log-probabilities beside it (2 x buckets x languages floats, sent with the task),
so a task only hashes, gathers and adds; there is no shuffle. Rows are gathered in
blocks bounded by bytes x languages, also inside a long text.

Cases: null text, or text without a letter: ``und``, score 0, not accepted.
Without any labelled row there is nothing to reject by: every text is ``und`` with
score 0, and accepted if it has a letter. The sample takes the rows of smallest hash
of each language, languages in equal parts (of more than ``sample`` languages the
most frequent); rows that share a ``doc_id`` give one example, the least text and
language of them. Languages of equal score: the first by name. Texts of any length
are read whole. An id that is no number is an error in training. Other columns are
not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc
from .common import prepare, stage

ORDERS = (3, 4)
FOLD = tc.LOWER.copy()
FOLD[tc.SPACE] = 0x20
FOLD[ord("0"):ord("9") + 1] = ord("0")
#: Standard errors by which a text's typicality may be below its language's.
ALLOWANCE = 4.0
#: Numbers gathered from the tables at once.
GATHERED = 1 << 22
LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # buckets + 1 rows (the last is zero), one column per language
    bias: np.ndarray
    temperature: float
    threshold: float
    typical: np.ndarray | None = None  # as ``logits``: log-probability of the bucket in each language
    spread: float = 0.0  # standard deviation of the log-probabilities inside a text
    floor: float = -np.inf


def subwords(data: np.ndarray, offsets: np.ndarray, buckets: int):
    """For each order: bucket of the n-gram from each place; ``buckets`` where it would leave its text.

    Also the document offsets in these arrays.
    """
    n = len(offsets) - 1
    at = np.arange(len(data)) + tc.rows_of(offsets) + 1
    text = np.full(len(data) + n + 1, 0x20, np.uint8)
    text[at] = FOLD[data]
    text[1:][(text[:-1] == 0xC3) & (text[1:] >= 0x80) & (text[1:] <= 0x9E) & (text[1:] != 0x97)] |= 0x20
    begin = offsets[:-1] + np.arange(n)
    docs = np.append(begin, len(text))
    stop = np.append(docs[1:-1] + 1, docs[-1:]) if n else docs[:0]  # after the space that follows the text
    wide = text.astype(np.uint32)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    out = []
    for order in ORDERS:
        m = max(0, len(text) - order + 1)
        h = np.full(m, order * 0x9E3779B1 % 2**32, np.uint32)
        for k in range(order):
            h = (h ^ wide[k:k + m]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        got = np.full(len(text), buckets, np.uint32)
        got[:m] = h >> shift
        # the last places of a text reach into the next one
        for k in range(1, order):
            late = stop - order + k
            got[late[(late >= docs[:-1]) & (late < docs[1:])]] = buckets
        out.append(got)
    return out, docs


def _examples(buckets: int, cut_bytes: int):
    """Bucket counts of each whole text, and of a cut of each longer one (``whole`` false)."""
    def run(batches):
        for batch in batches:
            rows = []
            for doc, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                parts = [(True, raw)]
                place = int(tc.mix(np.array([doc], np.int64).view(np.uint64))[0])
                most = max(64, cut_bytes >> place % 7)
                if len(raw) > most:
                    start = (place >> 8) % (len(raw) - most)
                    parts.append((False, raw[start:start + most]))
                for whole, part in parts:
                    data = np.frombuffer(part, np.uint8)
                    counts = np.zeros(buckets + 1, np.int64)
                    grams, _ = subwords(data, np.array([0, len(data)]), buckets)
                    for got in grams:
                        counts += np.bincount(got, minlength=buckets + 1)
                    ids = np.flatnonzero(counts[:buckets])
                    # counts of 16 bits where they fit
                    each = counts[ids].astype(np.uint16 if len(ids) and counts[ids].max() < 1 << 16 else np.float32)
                    rows.append((doc, lang, whole, ids.astype(np.uint32).tobytes(), each.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.string(), pa.bool_(), pa.binary(), pa.binary()))], ["doc_id", "lang", "whole", "ids", "counts"])
    return run


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Divisor of the scores with the least cross entropy, 1 for one language or no row.

    The targets are (m + 1) / (m + 2) of m rows, not 1, so the best divisor is never 0.
    """
    m, k = scores.shape
    if not m or k < 2:
        return 1.0
    target = np.full((m, k), 1 / (m + 2) / (k - 1))
    target[np.arange(m), labels] = (m + 1) / (m + 2)

    def loss(t: float) -> float:
        z = scores / t
        z = z - z.max(1, keepdims=True)
        return float(-(target * (z - np.log(np.exp(z).sum(1, keepdims=True)))).sum(1).mean())
    low, high = np.log(1e-4), np.log(1e4)
    for _ in range(40):  # the loss has one minimum
        a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
        low, high = (low, b) if loss(np.exp(a)) <= loss(np.exp(b)) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(examples: list[tuple[int, str, bool, np.ndarray, np.ndarray]], buckets: int, dim: int = 16, epochs: int = 5,
        rate: float = 0.5, reject_rate: float = 0.005, seed: int = 0, strange_rate: float = 0.0025) -> Model:
    """Train on (id, language, whole, bucket ids, counts); a fifth of the whole texts calibrates."""
    languages = sorted({e[1] for e in examples})
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / dim, 1 / dim, (buckets + 1, dim)).astype(np.float32)
    table[buckets] = 0
    out, bias = np.zeros((dim, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    which = {x: i for i, x in enumerate(languages)}
    examples = sorted((e for e in examples if len(e[3])), key=lambda e: (e[0], not e[2]))
    texts = sorted({e[0] for e in examples})
    kept = set(texts[::5]) if len(texts) >= 50 else set()
    row = lambda e: (which[e[1]], e[3], (e[4] / e[4].sum()).astype(np.float32))
    held = [row(e) for e in examples if e[2] and (e[0] in kept or not kept)]
    train = [row(e) for e in examples if e[0] not in kept]
    steps, step = max(1, epochs * len(train)), 0
    for _ in range(epochs):
        for i in random.permutation(len(train)):
            label, ids, weight = train[i]
            lr = np.float32(rate * (1 - step / steps))
            mean = weight @ table[ids]
            error = _softmax(mean @ out + bias)
            error[label] -= 1
            back = out @ error
            out -= lr * np.outer(mean, error)
            bias -= lr * error
            table[ids] -= lr * len(ids) ** np.float32(0.5) * np.outer(weight, back)
            step += 1
    logits = table @ out
    scores = np.array([w @ logits[ids] + bias for _, ids, w in held], np.float64).reshape(len(held), len(languages))
    labels = np.array([r[0] for r in held], int)
    temperature = _temperature(scores, labels)
    right = np.sort(_softmax(scores / temperature).max(1)) if held else np.ones(1)

    seen = np.zeros((buckets + 1, len(languages)))
    for e in examples:
        if e[2] and e[0] not in kept:
            seen[e[3], which[e[1]]] += e[4]
    typical = np.log((seen + 0.5) / (seen[:buckets].sum(0) + 0.5 * buckets)).astype(np.float32)
    typical[buckets] = 0
    total = [float(e[4].sum()) for e in examples if e[2] and (e[0] in kept or not kept)]
    means = np.array([w @ typical[ids, c] for (_, ids, w), c in zip(held, scores.argmax(1) if held else [])])
    inside = [w @ (typical[ids, c] - m) ** 2 for (_, ids, w), c, m in zip(held, scores.argmax(1) if held else [], means)]
    spread = float(np.sqrt(np.mean(inside))) if held else 0.0
    allowed = np.sort(means + ALLOWANCE * spread / np.sqrt(total)) if held else np.full(1, -np.inf)
    # the tail of a few hundred rows is uncertain, by about the rows' own deviation
    floor = float(allowed[int(strange_rate * len(held))] - (allowed.std() if held else 0.0)) - 1e-3
    return Model(languages, logits, bias, temperature, float(min(0.5, right[int(reject_rate * len(held))])), typical, spread, floor)


def _fitted(buckets: int):
    """Train in one task; one row with the model."""
    def run(batches):
        examples = []
        for batch in batches:
            for doc, lang, whole, ids, counts in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(ids, np.uint32)
                counts = np.frombuffer(counts, np.uint16 if len(counts) == 2 * len(ids) else np.float32)
                examples.append((doc, lang, whole, ids, counts))
        m = fit(examples, buckets)
        yield pa.RecordBatch.from_pylist([{
            "languages": m.languages, "logits": m.logits.tobytes(), "bias": m.bias.tobytes(), "temperature": m.temperature,
            "threshold": m.threshold, "typical": m.typical.tobytes(), "spread": m.spread, "floor": m.floor}], pa.schema([
                ("languages", pa.list_(pa.string())), ("logits", pa.binary()), ("bias", pa.binary()), ("temperature", pa.float64()),
                ("threshold", pa.float64()), ("typical", pa.binary()), ("spread", pa.float64()), ("floor", pa.float64())]))
    return run


def train(docs: DataFrame, usable: Column | None = None, sample: int = 4000, cut_bytes: int = 4096, buckets: int = 1 << 15,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on at most ``sample`` rows that have a language, a letter and ``usable``."""
    prepare(docs.sparkSession)
    rows = docs.filter(F.lit(True) if usable is None else usable).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    counts = stage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(sample), "languages")
    n_languages = counts.count()
    if not n_languages:
        return _untrained(buckets)
    each = max(1, sample // n_languages)
    # a language's rows of smallest hash; a filter leaves about four times as many as are wanted, of any
    # number of rows, so that the ranking below is small
    u = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) * F.lit(2.0**-53)
    near = (rows.select("doc_id", "lang", u.alias("u")).join(F.broadcast(counts), "lang")
            .filter(F.col("u") * F.col("n") < 4 * each + 40).dropDuplicates(["doc_id", "lang"]))
    order = Window.partitionBy("lang").orderBy("u", "doc_id")
    chosen = (near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= each)
              .select("doc_id", "lang").dropDuplicates(["doc_id"]).limit(sample))
    texts = (rows.join(F.broadcast(chosen), ["doc_id", "lang"]).filter(F.col("text").rlike(r"\p{L}"))
             .groupBy("doc_id", "lang").agg(F.min("text").alias("text")))
    examples = texts.mapInArrow(_examples(buckets, cut_bytes), "doc_id long, lang string, whole boolean, ids binary, counts binary")
    # at most ``sample`` texts, so one task holds them; only the model comes to the driver
    got = examples.repartition(1).mapInArrow(_fitted(buckets), "languages array<string>, logits binary, bias binary, temperature double, "
                                             "threshold double, typical binary, spread double, floor double").collect()
    if not got or not got[0]["languages"]:
        return _untrained(buckets)
    r = got[0]
    shape = (buckets + 1, len(r["languages"]))
    return Model(list(r["languages"]), np.frombuffer(r["logits"], np.float32).reshape(shape), np.frombuffer(r["bias"], np.float32),
                 r["temperature"], r["threshold"], np.frombuffer(r["typical"], np.float32).reshape(shape), r["spread"], r["floor"])


def _untrained(buckets: int) -> Model:
    return Model([], np.zeros((buckets + 1, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.5)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def _sums(table: np.ndarray, rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Sum of the table's ``rows`` for each document, at most ``GATHERED`` numbers at a time."""
    out = np.zeros((len(docs) - 1, table.shape[1]))
    step = max(1, GATHERED // max(1, table.shape[1]))
    for p in range(0, len(rows), step):
        q = min(len(rows), p + step)
        first, last = np.searchsorted(docs, p, "right") - 1, np.searchsorted(docs, q, "left")
        out[first:last] += np.add.reduceat(table[rows[p:q]], np.maximum(docs[first:last], p) - p, axis=0)
    return out


def predictor(model: Model):
    """Function of (bytes, offsets) to (language numbers, scores, accepted); -1 is undetermined."""
    buckets, k = len(model.logits) - 1, len(model.languages)
    table = model.logits if model.typical is None else np.concatenate([model.logits, model.typical], axis=1)

    def predict(data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        best, score = np.full(n, -1), np.zeros(n)
        letters = has_letter(data, offsets)
        if not n or not k:
            return best, score, letters
        grams, docs = subwords(data, offsets, buckets)
        total, count = np.zeros((n, table.shape[1])), np.zeros(n)
        for got in grams:
            total += _sums(table, got, docs)
            count += np.add.reduceat((got < buckets).astype(np.int64), docs[:-1])
        mean = total / np.maximum(count, 1)[:, None]
        p = _softmax((mean[:, :k] + model.bias) / model.temperature)
        best[letters] = p[letters].argmax(1)
        score[letters] = p[letters].max(1)
        accepted = letters & (score >= model.threshold)
        if model.typical is not None:
            likely = mean[np.arange(n), k + np.maximum(best, 0)] + ALLOWANCE * model.spread / np.sqrt(np.maximum(count, 1))
            accepted &= likely >= model.floor
        return best, score, accepted
    return predict


def _predict(model: Model, text_at: int, keep: int):
    predict = predictor(model)
    names = pa.array([*model.languages, "und"], pa.string())

    def run(batches):
        for batch in batches:
            data, offsets = tc.buffers(batch.column(text_at))
            parts = [(np.zeros(0, int), np.zeros(0), np.zeros(0, bool))]
            for i, j in tc.slices(offsets, 1 << 20):
                parts.append(predict(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
            best, score, accepted = (np.concatenate(x) for x in zip(*parts))
            found = np.where(best < 0, len(model.languages), best)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], names.take(pa.array(found)), pa.array(score), pa.array(accepted)],
                [*batch.schema.names[:keep], *ADDED])
    return run


ADDED = ("lang_pred", "score", "accepted")


def predict_language(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all) with lang_pred, score and accepted, which replace input columns of these names."""
    prepare(docs.sparkSession)
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    read = carry if text_col in carry else [*carry, text_col]
    inner = docs.select(*[F.col(f"`{c}`") for c in read])
    schema = T.StructType([*inner.schema.fields[:len(carry)], *(T.StructField(n, t) for n, t in zip(
        ADDED, (T.StringType(), T.DoubleType(), T.BooleanType())))])
    return inner.mapInArrow(_predict(model, read.index(text_col), len(carry)), schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: language of every document; a third of the labels is held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = train(docs, usable=~held_out)
    return predict_language(docs.select("doc_id", "text"), model, carry=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")
