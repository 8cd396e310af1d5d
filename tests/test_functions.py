from __future__ import annotations

import datetime as dt
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperlake.functions import dates, identity, text, vectors

TEXTS = st.lists(
    st.one_of(st.none(), st.sampled_from(["null", " null ", "NULL", "", "  "]), st.text(
        alphabet=st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=20)),
    min_size=1,
    max_size=60,
)


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def evaluate(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_clean_text_edges(spark):
    given_ = ["a ", " null ", "null", "NULL", "Null", "  ", "\t", None]
    got = evaluate(column(spark, given_), text.clean_text(F.col("c")))
    assert got == ["a", "null", None, None, "Null", None, "\t", None]


@settings(max_examples=8, deadline=None)
@given(values=TEXTS)
def test_clean_text_is_idempotent_but_for_padded_nulls(spark, values):
    df = column(spark, values)
    once = evaluate(df, text.clean_text(F.col("c")))
    twice = evaluate(df, text.clean_text(text.clean_text(F.col("c"))))
    assert all(a == b or a in text.NULL_SPELLINGS for a, b in zip(once, twice))


def test_doi_forms(spark):
    forms = ["10.1038/s4", "10.1038/a b", "10.123/x", "doi:10.1038/x", "10.1038/", " 10.1038/x", None]
    got = evaluate(column(spark, forms), text.doi_is_valid(F.col("c")))
    assert got == [True, True, False, False, False, False, False]


def test_title_length_counts_trimmed_characters(spark):
    titles = ["0123456789", "012345678", "  012345678  ", "éééééééééé", None]
    assert evaluate(column(spark, titles), text.long_enough(F.col("c"), 10)) == [
        True, False, False, True, None,
    ]


def test_truncate_counts_characters(spark):
    assert evaluate(column(spark, ["ñandú", "ab", None]), text.truncate(F.col("c"), 3)) == ["ñan", "ab", None]


def test_embedding_text_skips_nulls(spark):
    df = spark.createDataFrame([(0, "t", None, "f")], "i int, a string, b string, c string")
    assert evaluate(df, text.embedding_text(F.col("a"), F.col("b"), F.col("c"))) == ["t f"]


def python_id(title, authors, date):
    content = f"{(title or '').lower().strip()}||{(authors or '').lower().strip()}||{date or ''}"
    return hashlib.sha256(content.encode()).hexdigest()


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(st.tuples(
    st.one_of(st.none(), st.text(alphabet="aBcÄé \t\n\r\x0b\x0c\x85\xa0 　", max_size=12)),
    st.one_of(st.none(), st.text(alphabet="xYz; ", max_size=12)),
    st.sampled_from([None, "", "2024-1-5", "2024-01-05"]),
), min_size=1, max_size=50))
def test_paper_id_equals_python(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, a string, d string")
    got = evaluate(df, identity.paper_id(F.col("t"), F.col("a"), F.col("d")))
    assert got == [python_id(*r) for r in rows]


def test_record_hash_sees_a_value_move(spark):
    df = spark.createDataFrame([(0, "x", None), (1, None, "x")], "i int, a string, b string")
    first, second = evaluate(df, identity.record_hash(F.col("a"), F.col("b")))
    assert first != second


def test_pdf_path_needs_a_url(spark):
    df = column(spark, ["http://x", "", None])
    path = identity.pdf_object_path("b", F.lit("arxiv"), F.lit(dt.date(2024, 3, 1)), F.lit("id"), F.col("c"))
    assert evaluate(df, path) == ["s3://b/raw_pdfs/arxiv/2024/03/01/id.pdf", None, None]


def test_lookback_is_inclusive_and_open_ended(spark):
    days = [dt.date(2024, 2, 22), dt.date(2024, 2, 23), dt.date(2030, 1, 1), None]
    inside = dates.within_lookback(F.col("c"), dt.date(2024, 3, 1), 7)
    assert evaluate(column(spark, days, "date"), inside) == [False, True, True, None]


def test_first_day_of_the_window(spark):
    assert dates.first_day(spark, dt.date(2024, 3, 1), 7) == dt.date(2024, 2, 23)
    assert dates.first_day(spark, None, 0) == spark.sql("select current_date()").first()[0]


@pytest.mark.parametrize("a,b", [([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([3.0], [-3.0])])
def test_cosine_and_normalize(spark, a, b):
    df = spark.createDataFrame([(0, a, b)], "i int, a array<float>, b array<float>")
    scale = np.linalg.norm(a) * np.linalg.norm(b)
    expected = float(np.dot(a, b) / scale) if scale else 0.0
    (score,) = evaluate(df, vectors.cosine(F.col("a"), F.col("b")))
    assert score == pytest.approx(expected) and abs(score) <= 1 + 1e-12
    (unit,) = evaluate(df, vectors.l2_normalize(F.col("a")))
    norm = np.linalg.norm(a)
    assert unit == pytest.approx(list(np.array(a) / norm) if norm else a)
