"""Randomised differential test: Spark's cleaning chain and tokenisers
against the Python statement of the rules on seeded random strings made of
the characters the rules care about."""

import random
import re

from lexisift.functions import cleaning as C
from lexisift.functions import tokens as T

from test_cleaning import rules_in_python

PIECES = ["/", "*", "/*", "*/", "//", "#", '"', "'", '"""', "'''", "\\", "\\\"", "\\'", "<!--", "-->",
          "\n", "\n\n\n", " ", "  ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\xa0", " ", "　", "\x85",
          "a", "bc", "x1", "_y", "42", "é", "ß", "def", "int", ";", "{", "}", "(", ")", "+", "=", "http://e.com"]


def _random_texts(n=600, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_clean_and_tokens_match_python(spark):
    texts = _random_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    rows = df.select("id", C.clean_text("t").alias("c"), T.code_tokens("t").alias("k"),
                     T.word_tokens("t").alias("w")).collect()
    code_pat = re.compile(T.CODE_TOKEN_PATTERN)
    word_pat = re.compile(r"\w{2,}")          # a maximal run of two or more word characters
    for r in rows:
        t = texts[r.id]
        assert r.c == rules_in_python(t), (repr(t), r.c)
        assert r.k == code_pat.findall(t), repr(t)
        assert r.w == word_pat.findall(t.lower()), repr(t)
