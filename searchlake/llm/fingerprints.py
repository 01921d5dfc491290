"""Operator 11: document fingerprints by a homomorphic multiset hash (DataFrame functions only).

A text is the multiset of its paragraphs (split at ``\\n``; an empty text is one
empty paragraph). A paragraph is hashed to a wide vector, a text's fingerprint is
the sum of the vectors of its paragraphs, lane by lane, modulo powers of two:

* ``STRONG`` lanes modulo 2**48, from the SHA-256 of the paragraph. Texts with equal
  multisets of paragraphs have equal lanes in any order of the paragraphs; others have
  equal lanes with a chance of 2**-240.
* ``LANES`` lanes modulo 2**16: each ``WORDS``-word shingle of the paragraph (words
  are runs outside ``[\\x20\\x09-\\x0D]``; a paragraph of fewer words is one shingle,
  one without words none) adds +1 or -1 to each, by a bit of its MD5.

Sums can be continued: :func:`plus` and :func:`minus` insert and delete paragraphs
by the fingerprints of the inserted and deleted text alone. The second lanes make
fingerprints comparable: with random signs the mean of (a - b)**2 over the lanes
estimates the squared distance of the multisets of shingles, and of a**2 its squared
size. ``likeness`` is 1 - sum (a - b)**2 / (sum a**2 + sum b**2), not under 0: 1 for
equal multisets, about 2/3 after a third of a long text is replaced, about 0 for
unrelated texts (standard deviation 1 / sqrt(LANES), 0.09). Lanes are read as
signed, so they tell sizes apart up to 32,767 copies of one shingle.

Distribution. Rows are told apart by a 128-bit hash of id and text. Only keys are
range-sorted to find each document's successor (:func:`dense_index`); texts are
shuffled once by key, the starts that replace others' ends once, and the lanes are
summed where the texts are then, in Spark's hash aggregation, one row a shingle.
Repeated rows are combined before the shuffle.

Cases: null text is empty. A null id comes after all others, and is returned as
null. Documents that share an id are ordered by their hash. Rows that share id and
text are one document with one successor, and come back as often as they were.
The only document of a table is its own successor. A text of any length is hashed
whole. Two texts without words have likeness 1. Other columns are not looked at. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlake.operators.ids import dense_index

from .common import stage

WORDS = 3
STRONG = 5
#: Hex digits of a strong lane.
DIGITS = 12
LANES = 128
WHITE = r"[\x20\x09-\x0D]+"
#: Bits j and j + 32 of a 64-bit half are counted in one 64-bit sum.
PAIR = (1 << 32) + 1
HALF = (1 << 32) - 1


def _word(hex_: Column, at: int | Column, digits: int) -> Column:
    """``digits`` hex digits from place ``at`` (from 1) as a signed number."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.conv(F.substring(hex_, at, F.lit(digits)), 16, -10).cast("long")


def paragraphs(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def shingles(text: Column) -> Column:
    """All shingles of a text, paragraph by paragraph."""
    words = F.transform(paragraphs(text), lambda p: F.filter(F.split(p, WHITE, -1), lambda w: w != ""))
    of = lambda w: (F.when(F.size(w) >= WORDS, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - WORDS, F.lit(0))), lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(WORDS)])))
        .when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>")))
    return F.flatten(F.transform(words, of))


def strong_lanes(text: Column) -> Column:
    """Sums over the paragraphs, one for each strong lane."""
    hashed = F.transform(paragraphs(text), lambda p: F.sha2(p, 256))
    lanes = F.transform(hashed, lambda h: F.array(*[_word(h, i * DIGITS + 1, DIGITS) for i in range(STRONG)]))
    zero = F.array_repeat(F.lit(0).cast("long"), STRONG)
    return F.aggregate(lanes, zero, lambda a, b: F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit((1 << 4 * DIGITS) - 1))))


def texts_fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` (which tell the rows apart) and ``fp``, the fingerprint as bytes."""
    strong = F.transform(strong_lanes(F.col(f"`{text_col}`")), lambda x: F.lpad(F.hex(x), DIGITS, "0"))
    # both are computed once a text, below the explode
    rows = texts.select(*keys, F.unhex(F.array_join(strong, "")).alias("strong"), shingles(F.col(f"`{text_col}`")).alias("shingles"))
    rows = rows.select(*keys, "strong", F.explode_outer("shingles").alias("shingle"))
    named = [f"`{k}`" for k in keys] + ["strong"]
    halves = rows.withColumn("md5", F.md5(F.col("shingle").cast("binary"))).selectExpr(
        *named, "cast(shingle is not null as bigint) as one",
        *[f"coalesce(cast(conv(substring(md5, {1 + 16 * h}, 16), 16, -10) as bigint), 0L) as h{h}" for h in (0, 1)])
    sums = halves.groupBy(*keys, "strong").agg(F.sum("one").alias("total"), *[
        F.expr(f"sum(shiftrightunsigned(h{h}, {j}) & {PAIR}L) as s{h}_{j}") for h in (0, 1) for j in range(32)])
    # bits 0 to 31 of a half are counted in the low word of a sum, 32 to 63 in the high one
    count = lambda h, bit: f"s{h}_{bit}" if bit < 32 else f"shiftrightunsigned(s{h}_{bit - 32}, 32)"
    lanes = ", ".join(f"lpad(hex((2 * ({count(h, bit)} & {HALF}L) - total) & 65535), 4, '0')" for h in (0, 1) for bit in range(64))
    return sums.selectExpr(*named[:-1], f"concat(strong, unhex(concat({lanes}))) as fp")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint as hex) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       F.monotonically_increasing_id().alias("at"))
    return texts_fingerprints(rows, ["doc_id", "at"]).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"))


def lanes_of(fp: Column) -> tuple[Column, Column]:
    """Strong lanes (0 to 2**48 - 1) and likeness lanes (0 to 2**16 - 1) of a fingerprint in hex."""
    at = lambda n, first, digits: F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: _word(fp, i * digits + first, digits))
    return at(STRONG, 1, DIGITS), at(LANES, 1 + DIGITS * STRONG, 4)


def _combined(a: Column, b: Column, sign: int) -> Column:
    def part(x: Column, y: Column, digits: int) -> Column:
        sums = F.zip_with(x, y, lambda p, q: (p + F.lit(sign) * q).bitwiseAND(F.lit((1 << 4 * digits) - 1)))
        return F.array_join(F.transform(sums, lambda v: F.lower(F.lpad(F.hex(v), digits, "0"))), "")
    return F.concat(*[part(x, y, digits) for x, y, digits in zip(lanes_of(a), lanes_of(b), (DIGITS, 4))])


def plus(fp: Column, inserted: Column) -> Column:
    """Fingerprint (hex) after the paragraphs fingerprinted as ``inserted`` join the text."""
    return _combined(fp, inserted, 1)


def minus(fp: Column, deleted: Column) -> Column:
    """Fingerprint (hex) after the paragraphs fingerprinted as ``deleted`` leave the text."""
    return _combined(fp, deleted, -1)


def signed_lanes(lanes: Column) -> Column:
    """The likeness lanes, two bytes each, as signed numbers."""
    return F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)),
                       lambda i: (_word(F.hex(F.substring(lanes, i * 2 + 1, F.lit(2))), 1, 4) + 32768).bitwiseAND(F.lit(0xFFFF)) - 32768)


def lane_likeness(a: Column, b: Column) -> Column:
    """Likeness of two arrays of signed lanes."""
    square = lambda lanes: F.aggregate(lanes, F.lit(0).cast("long"), lambda s, x: s + x * x)
    apart = square(F.zip_with(a, b, lambda x, y: (x - y + 32768).bitwiseAND(F.lit(0xFFFF)) - 32768))
    size = square(a) + square(b)
    return F.when(size == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - apart.cast("double") / size))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints in hex, 0 to 1."""
    return lane_likeness(*[signed_lanes(F.unhex(F.substring(fp, DIGITS * STRONG + 1, 4 * LANES))) for fp in (a, b)])


def successors(keyed: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, n, rows, next1, next2) of the distinct documents of (doc_id, k1, k2, n), by falling id."""
    distinct = stage(keyed.groupBy("doc_id", "k1", "k2", "n").agg(F.count(F.lit(1)).alias("rows")), "fingerprint-keys")
    placed = stage(dense_index(distinct, [F.col("doc_id").desc_nulls_last(), F.col("k1"), F.col("k2")], start=0, name="place"), "fingerprint-order")
    total = max(1, placed.count())
    after = placed.select(F.pmod(F.col("place") - 1, F.lit(total)).alias("place"), F.col("k1").alias("next1"), F.col("k2").alias("next2"))
    return stage(placed.join(after, "place").select("doc_id", "k1", "k2", "n", "rows", "next1", "next2"), "successors")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its fingerprint, that of the edited text, and likenesses.

    The edited text replaces the last third of the code points by the first as many
    (or all) of the next document by falling id.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(1), F.col("doc_id").isNull(), "text", "doc_id")})
    links = successors(rows.select("doc_id", "k1", "k2", F.length("text").cast("long").alias("n")))
    if links.filter(F.col("rows") > 1).limit(1).count():
        rows = rows.dropDuplicates(["k1", "k2"])  # combined before the shuffle, also of a hot row

    # both uses of the texts read the same columns, so that one exchange serves both
    texts = rows.select("k1", "k2", "text")
    starts = links.join(texts.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), "text"), ["next1", "next2"]).select(
        "k1", "k2", "doc_id", "n", "next1", "next2", "rows", F.expr("substring(text, 1, cast(n div 3 as int))").alias("start"))
    both = texts.join(starts, ["k1", "k2"]).select(
        "k1", "k2", "doc_id", "n", "next1", "next2", "rows", "text",
        F.concat(F.expr("substring(text, 1, cast(n - n div 3 as int))"), "start").alias("edited"))
    keys = ["k1", "k2", "doc_id", "n", "next1", "next2", "rows", "sha"]
    versions = both.select(*keys[:-1], F.unhex(F.sha2("edited", 256)).alias("sha"), F.array("text", "edited").alias("texts")).select(
        *keys, F.posexplode("texts").alias("which", "text"))
    each = texts_fingerprints(versions, [*keys, "which"]).groupBy(*keys).agg(
        *[F.max(F.when(F.col("which") == at, F.col("fp"))).alias(name) for at, name in enumerate(("fp", "edited_fp"))])
    each = stage(each, "fingerprints")
    after = each.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.substring("fp", DIGITS * STRONG // 2 + 1, 2 * LANES).alias("next_lanes"))
    lanes = signed_lanes(F.substring("fp", DIGITS * STRONG // 2 + 1, 2 * LANES))
    return (each.join(after, ["next1", "next2"])
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
            .select("doc_id", F.col("n").alias("n_chars"), F.lower(F.hex("sha")).alias("edited_sha256"),
                    F.lower(F.hex("fp")).alias("fingerprint"), F.lower(F.hex("edited_fp")).alias("edited_fingerprint"),
                    lane_likeness(lanes, signed_lanes(F.substring("edited_fp", DIGITS * STRONG // 2 + 1, 2 * LANES))).alias("near_edited"),
                    lane_likeness(lanes, signed_lanes(F.col("next_lanes"))).alias("near_next")))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: fingerprints of all documents, of their edited texts, and likenesses."""
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    """The same numbers in DuckDB SQL."""
    strong = ", ".join(f"(sum(('0x' || sha256(p)[{i * DIGITS + 1}:{(i + 1) * DIGITS}])::BIGINT) % {1 << 4 * DIGITS})::BIGINT" for i in range(STRONG))
    # bit j of a half is bit j % 32 of its low word (j under 32) or high word
    word = lambda h, bit: f"w{2 * h + (0 if bit >= 32 else 1)}"
    signs = ", ".join(f"sum(2 * (({word(h, bit)} >> {bit % 32}) & 1) - 1)::BIGINT" for h in (0, 1) for bit in range(64))
    wrapped = "((x + 32768) & 65535) - 32768"
    square = lambda a: f"list_sum([x * x FOR x IN {a}])"

    def near(a: str, b: str) -> str:
        apart = square(f"[{wrapped.replace('x', '(z[1] - z[2])')} FOR z IN list_zip({a}, {b})]")
        size = f"({square(a)} + {square(b)})"
        return f"CASE WHEN {size} = 0 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - ({apart})::DOUBLE / {size}::DOUBLE) END"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars,
         coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS after,
         coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_id
  FROM documents WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT *, substr(text, 1, n_chars - n_chars // 3) || substr(after, 1, n_chars // 3) AS edited FROM d),
v AS (SELECT doc_id, 0 AS which, text FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
p AS (SELECT doc_id, which, unnest(string_split(text, chr(10))) AS p FROM v),
strong AS (SELECT doc_id, which, [{strong}] AS strong FROM p GROUP BY ALL),
words AS (
  SELECT doc_id, which, list_filter(regexp_split_to_array(p, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM p),
shingles AS (
  SELECT doc_id, which, md5(unnest(CASE WHEN len(w) >= {WORDS}
    THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS m FROM words),
halves AS (
  SELECT doc_id, which, ('0x' || m[1:8])::BIGINT AS w0, ('0x' || m[9:16])::BIGINT AS w1,
         ('0x' || m[17:24])::BIGINT AS w2, ('0x' || m[25:32])::BIGINT AS w3 FROM shingles),
sums AS (SELECT doc_id, which, [{signs}] AS s FROM halves GROUP BY ALL),
f AS (
  SELECT doc_id, which, strong, [{wrapped} FOR x IN coalesce(s, list_resize([]::BIGINT[], {LANES}, 0))] AS s,
  FROM strong LEFT JOIN sums USING (doc_id, which)),
t AS (
  SELECT doc_id, which, s, array_to_string([printf('%0{DIGITS}x', x) FOR x IN strong], '')
    || array_to_string([printf('%04x', x & 65535) FOR x IN s], '') AS fp FROM f)
SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
       {near('a.s', 'b.s')} AS near_edited, {near('a.s', 'c.s')} AS near_next
FROM e JOIN t a ON a.doc_id = e.doc_id AND a.which = 0 JOIN t b ON b.doc_id = e.doc_id AND b.which = 1
JOIN t c ON c.doc_id = e.next_id AND c.which = 0
"""


SQL = _sql()
