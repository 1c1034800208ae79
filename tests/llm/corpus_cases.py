"""Rows that the corpus tests share."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, blank and very long texts, repeated rows and ids.
EDGE = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one", "en", None, 3),
        (4, "one", "en", None, 3), (None, "one two three four", "en", "a", 3), (None, None, "en", "a", None),
        (7, "ba na " * 30000, "de", "a", 5), (8, "ba na " * 30000 + "x", "de", "b", 5)]


def docs_df(spark, rows, extra=""):
    return spark.createDataFrame(rows, DOC + extra)


def random_docs(n, seed=0, vocab=60, length=40):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)] + ["É", "naïve", "A!B", "x,y"]
    return [(i, " ".join(r.choice(words) for _ in range(r.randrange(length))), "en", f"s{r.randrange(3)}", 0) for i in range(n)]
