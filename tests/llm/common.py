"""Tables that the tests share."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

SYLLABLES = "the an er in re on at en nd ti es or te of ed is it al ar st to nt ha le".split()


def prose(seed: int, n: int = 60) -> str:
    """Invented prose, a full stop now and then."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]
    text = " ".join(f"{w}." if i % 9 == 8 else w for i, w in enumerate(words))
    return text[0].upper() + text[1:] + "."


def frame(spark, rows, schema=DOCS):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, columns with names that operators use."""
    long_text = " ".join(prose(i) for i in range(400))
    rows = [
        (1, prose(1)), (2, None), (3, ""), (4, " \n\t"), (None, prose(5)), (None, None), (7, long_text), (8, long_text + " "),
        (9, prose(1)), (9, prose(1)), (9, prose(1)), (10, "x"), (11, "é ▁ \0 𐍈 ́"), (12, prose(1).replace(" ", "  ")),
        (None, prose(5)),
    ]
    names = ["row_key", "_c0", "_row_key", "_n_chars", "score", "spans", "items", "code", "word", "n", "posterior", "_text_bytes"]
    schema = DOCS + "".join(f", {n} string" for n in names)
    return frame(spark, rows, schema), rows


def empty(spark):
    return frame(spark, [])
