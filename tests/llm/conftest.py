import random

import pytest


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeated rows and clashing extra columns."""
    rng = random.Random(4)
    voc = [f"w{i}é" for i in range(300)]
    text = lambda n: " ".join(rng.choice(voc) for _ in range(n))
    long = text(30_000)
    same = text(120)
    rows = [(0, same, "en", "a"), (1, same, "en", "a"), (1, same, "en", "a"), (2, None, "en", "b"), (3, "", None, None),
            (4, " \t\n\x0b\f\r", "de", "b"), (5, long, None, "c"), (6, "one", "xx", None), (None, same, "en", "a"),
            (None, None, None, None), (7, "é" * 50_000, "en", "c"), (8, text(400), "en", "a"), (9, text(400) + " " + same, "en", "b")]
    rows = [(*r, len(r[1] or ""), 1, 2.0, "x", -1, "y") for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int, "
                                       "score double, shard string, n int, _text string").repartition(3)


def plain_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
