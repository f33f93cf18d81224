"""Text expressions against Python's own string methods."""

import pytest
from pyspark.sql import functions as F

from pairloom.functions import text as X

SPACES = [chr(i) for i in range(0x110000) if chr(i).isspace()]
NOT_SPACES = [chr(0x200B), chr(0xFEFF), chr(0x180E)]
TEXTS = [
    "", " ", "a", "a b a", "A a", "İSTANBUL", "ΟΔΟΣ ΑΣ", "ẞ STRASSE", "ÉÀ", "ǅ", "Σ", "AΣB",
    *[f"{s}x{s}y{s}" for s in SPACES], *[f"{c}x{c}" for c in NOT_SPACES], "end.\n\nNext, end.", "a\x1cb\x85c" + chr(0xA0) + "d",
]


def evaluate(spark, rows, *columns):
    schema = ", ".join(f"c{i} string" for i in range(len(rows[0])))
    numbered = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, "i int, " + schema)
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_white_space_is_pythons():
    assert sorted(X.WHITESPACE) == SPACES and len(SPACES) == 29


def test_strip_and_tokens(spark):
    got = evaluate(spark, [(t,) for t in TEXTS], X.strip("c0"), X.tokens("c0"), X.is_blank("c0"), X.word_count("c0"))
    for text, (stripped, words, blank, count) in zip(TEXTS, got):
        assert stripped == text.strip(), repr(text)
        assert words == text.lower().split(), repr(text)
        assert blank == (not text.strip())
        assert count == len(text.split())


def test_token_set_has_no_repeats(spark):
    [(words,)] = evaluate(spark, [("b a B a. A",)], X.token_set("c0"))
    assert words == ["b", "a", "a."]


def test_jaccard(spark):
    pairs = [(a, b) for a in TEXTS for b in TEXTS[:12]]
    got = evaluate(spark, pairs, X.jaccard("c0", "c1"), X.jaccard("c1", "c0"))
    for (a, b), (there, back) in zip(pairs, got):
        x, y = set(a.lower().split()), set(b.lower().split())
        assert there == back == (len(x & y) / len(x | y) if x and y else 0.0)


@pytest.mark.parametrize("value", [0.0, 0.125, 0.375, 0.005, 0.015, 0.85, 0.999, 1.0, 1234.5678, 0.045, 2 / 3])
def test_two_decimals(spark, value):
    assert spark.range(1).select(X.two_decimals(F.lit(value))).first()[0] == f"{value:.2f}"


def test_null_text(spark):
    null = F.lit(None).cast("string")
    row = spark.range(1).select(
        X.is_blank(null), X.jaccard(null, F.lit("a")), X.or_default(null, "d"), X.mentions(null, lowered=("a",))
    ).first()
    assert tuple(row) == (True, None, "d", False)


def test_length_ratio_of_empty_chosen(spark):
    assert evaluate(spark, [("", "abc")], X.length_ratio("c0", "c1")) == [(3.0,)]


def test_random_texts(spark):
    import random

    rng = random.Random(7)
    letters = "abcXYZ.,'-0189\u00e9\u00df\u00c9\u0394\u03c9\u0416\u044f\u8a9e"
    texts = [
        "".join(rng.choice(SPACES) if rng.random() < 0.3 else rng.choice(letters) for _ in range(rng.randrange(30)))
        for _ in range(1500)
    ]
    pairs = list(zip(texts, texts[1:] + texts[:1]))
    got = evaluate(spark, pairs, X.strip("c0"), X.tokens("c0"), X.jaccard("c0", "c1"))
    for (a, b), (stripped, words, similarity) in zip(pairs, got):
        x, y = set(a.lower().split()), set(b.lower().split())
        assert (stripped, words) == (a.strip(), a.lower().split())
        assert similarity == (len(x & y) / len(x | y) if x and y else 0.0)


def test_null_overlap_in_either_null_mode(spark):
    null = F.lit(None).cast("string")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert spark.range(1).select(X.jaccard(null, F.lit("a")), X.word_count(null)).first() == (None, None)
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
