import hashlib
import unicodedata
import uuid

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T

SAMPLES = [
    "", " ", "  ", "a  b\n\nc", "Page 1 of 3", "From: a\nTo: b\nbody", "test@example.com +421900123456", "café",
    "x" * 49, "x" * 50, "x" * 200, "x" * 201, "line\n", "\U0001f600 astral", "photo: eaten\nrest", "\x1cedge\x1f",
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(SAMPLES)), "id int, text string")


def values(rows, column):
    return [r[0] for r in rows.orderBy("id").select(column).collect()]


def test_strip_and_words_follow_python(rows):
    assert values(rows, T.strip(F.col("text"))) == [s.strip() for s in SAMPLES]
    assert values(rows, T.token_estimate(F.col("text"))) == [len(s.split()) for s in SAMPLES]
    assert values(rows, T.words(F.col("text"))) == [s.split() for s in SAMPLES]


def test_nfc_of_jvm_and_python_agree(rows):
    want = [unicodedata.normalize("NFC", s) for s in SAMPLES]
    assert values(rows, T.nfc(F.col("text"))) == want
    assert values(rows, T.nfc_python(F.col("text"))) == want


def test_normalize_modes(spark):
    df = spark.createDataFrame([(0, "From: a\nTo: b\n x  y\n\nPage 1 of 3 café "), (1, None)], "id int, text string")
    assert values(df, T.normalize(F.col("text"))) == ["x y café", None]
    assert values(df, T.normalize(F.col("text"), "literal"))[0] == "From: a\nTo: b\n x  y\n\nPage 1 of 3 café"
    assert values(df, T.normalize(F.col("text"), collapse=False))[0].count("\n") == 2


def test_pii_risk(spark):
    df = spark.createDataFrame([(0, "call +421900123456 or a@b.sk now"), (1, "plain"), (2, None)], "id int, text string")
    assert values(df, T.pii_risk(F.col("text"))) == [0.4, 0.0, 0.0]
    assert values(df, T.pii_risk(F.col("text"), "literal")) == [0.0, 0.0, 0.0]


def test_line_count_and_limits(spark):
    df = spark.createDataFrame([(0, "Line\n" * 10), (1, "L\n" * 1001), (2, "")], "id int, text string")
    assert values(df, T.line_count(F.col("text"))) == [11, 1002, 1]
    assert values(df, T.requires_split(F.col("text"), 1000, 1000)) == [False, True, False]


def test_summary_fallback(spark):
    df = spark.createDataFrame([(0, "x" * 201, " "), (1, "x" * 200, None), (2, "t", "s")], "id int, text string, summary string")
    got = values(df, T.summary_or_preview(F.col("summary"), F.col("text")))
    assert got == ["x" * 200 + "...", "x" * 200, "s"]


def test_uuid5_and_expected_ids(spark):
    h = hashlib.sha1(b"x").hexdigest()
    df = spark.createDataFrame([(0, h), (1, h + '"'), (2, "short")], "id int, v string")
    assert values(df, T.uuid5(F.col("v"))) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, v)) for v in (h, h + '"', "short")]
    assert values(df, T.expected_id(F.col("v"))) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, h)), h + '"', "short"]


def test_paths(spark):
    df = spark.createDataFrame([(0, "/r/Cat/x.PDF"), (1, "/r/y.docx"), (2, "/other/z")], "id int, p string")
    assert values(df, T.category_of(F.col("p"), "/r")) == ["Cat", "root", None]
    assert values(df, T.suffix(F.col("p"))) == [".pdf", ".docx", ""]
    assert [(e.parent, e.child) for e in values(df, T.path_edges(F.col("p")))[1]] == [("", "/r"), ("/r", "/r/y.docx")]


def test_replies_and_tags(spark):
    df = spark.createDataFrame([(0, '```json\n{"a": 1}\n```'), (1, "no json")], "id int, v string")
    assert values(df, F.try_variant_get(T.json_of_reply(F.col("v")), "$.a", "int")) == [1, None]
    assert values(spark.createDataFrame([(0, "a, b,, c ")], "id int, v string"), T.tags_of(F.col("v"))) == [["a", "b", "c"]]
