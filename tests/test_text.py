import re
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alertflow.functions import text as txt

TERMS = ["fire", "flood", "a1", "storm"]
ALPHABET = "afireloduts1 ,.-_\n\tÉéİK 　"


def column(spark, values, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    rows = df.select("i", *[e.alias(f"c{n}") for n, e in enumerate(expressions)]).orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def test_blank_agrees_with_python_for_every_character(spark):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and chr(c).isspace()]
    near = [chr(c) for c in (0x200B, 0x180E, 0x2060, 0xFEFF, 0x21, 0x7F, 0x1B)]
    values = chars + near + ["", "  ", "\n\n", " a", "a\n", " x　", "".join(chars)]
    got = column(spark, [*values, None], txt.is_blank(F.col("text")))
    assert [g[0] for g in got] == [v.strip() == "" for v in values] + [True]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=40))
def test_term_functions_agree_with_python_for_short_and_long_lists(spark, values):
    text = F.col("text")
    many = TERMS + [f"zz{i}" for i in range(5_001)]
    got = column(
        spark,
        values,
        txt.tokens(text),
        txt.count_terms(text, TERMS),
        txt.count_terms(text, many),
        txt.first_term(text, TERMS),
        txt.first_term(text, many),
        txt.normalize(text),
    )
    for value, (tokens, few_count, many_count, few_first, many_first, normal) in zip(values, got):
        expected = re.findall("[a-z0-9]+", value.lower().replace("İ", "i̇"))
        hits = [t for t in expected if t in TERMS]
        assert tokens == expected
        assert few_count == many_count == len(hits)
        assert few_first == many_first == (hits[0] if hits else None)
        assert normal == " ".join(expected)


def test_term_lists_are_checked():
    with pytest.raises(ValueError, match="empty"):
        txt.count_terms(F.lit("x"), [])
    with pytest.raises(ValueError, match="tokens"):
        txt.first_term(F.lit("x"), ["two words"])


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab1", min_size=1, max_size=5), min_size=1, max_size=40), st.text("ab1 ", max_size=20))
def test_the_regex_finds_exactly_the_listed_tokens(terms, text):
    found = [m.group(1) for m in re.finditer(txt._whole_token(txt._checked(sorted(terms))), text)]
    assert found == [t for t in text.split() if t in terms]


def test_previews_cut_by_characters(spark):
    values = ["x" * 60, "x" * 61, "é" * 61, "short", None]
    got = column(spark, values, txt.preview_ellipsis(F.col("text")), txt.preview(F.col("text")))
    assert [g[0] for g in got] == ["x" * 60, "x" * 60 + "...", "é" * 60 + "...", "short", None]
    assert [g[1] for g in got] == ["x" * 50, "x" * 50, "é" * 50, "short", None]


def test_token_cap(spark):
    values = [" ".join(f"w{i}" for i in range(n)) for n in (0, 511, 512, 513)]
    words = txt.tokens(F.col("text"))
    got = column(spark, values, F.size(txt.first_tokens(words)))
    assert [g[0] for g in got] == [0, 511, 512, 512]
