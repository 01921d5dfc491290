"""Small fixtures for the training-data operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Column names that operators use inside.
CLASHING = ["row", "id", "h1", "h2", "key", "n", "salt", "rank", "chunk", "label", "gone", "every", "kept", "hub", "size",
            "score", "lang_pred", "n_lines", "n_dropped", "norm", "h", "sha", "order", "noise", "good", "range", "count"]


def docs_frame(spark, rows, extra=False):
    """(doc_id, text[, lang]) rows as a documents table, with clashing extra columns on request."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(f"x-{c}") for c in CLASHING})
    return df


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def corpus(seed=0, n=60, vocabulary=400):
    """Random texts with exact copies, near copies, shared passages and lines, odd and empty texts."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéñ") for _ in range(rnd.randrange(2, 9))) for _ in range(vocabulary)]
    passage = " ".join(rnd.choice(words) for _ in range(40))
    line = "This Line is found in several documents " + rnd.choice(words)
    out = []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.choice((0, 1, 2, 5, 12, 13, 14, 80, 200)))]
        kind = rnd.randrange(8)
        if kind == 0 and out:
            out.append((i, rnd.choice(out)[1]))
            continue
        if kind == 1 and out:
            copy = (rnd.choice(out)[1] or "").split(" ")
            if len(copy) > 30:
                copy[rnd.randrange(len(copy))] = "changed"
            out.append((i, " ".join(copy)))
            continue
        if kind == 2:
            text[len(text) // 2:len(text) // 2] = passage.split(" ")
        body = " ".join(text)
        if kind == 3:
            body = f"{body}\n \t{line}  \nend\n{line.upper()}"
        if kind == 4:
            body = body.replace(" ", "\n\t ", 3)
        out.append((i, body))
    return out + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, None), (None, passage), (None, line), (n + 4, "A"), (n + 5, "long " * 30_000)]
