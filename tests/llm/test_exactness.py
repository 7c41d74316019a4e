"""Hashes that structure can't fool, linear parsing, odd rows of the pipeline, and whole small tables against plain Python."""

import hashlib
import os
import re
import time
import unicodedata

import corpus_pipeline
import pytest
import regex
from pyspark.sql import functions as F
from test_llm_operators import SCHEMA, line_brute, near_brute, suffix_brute

from docloom.llm import lines, near, queries
from docloom.llm.html import blocks_of, classify, main_text, settle
from docloom.llm.suffixes import remove_repeats
from docloom.llm.words import blocks, word_hashes

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def thue_morse(letters):
    """Two words that differ in every letter; sums of powers modulo 2 ** 64 can't tell them apart."""
    x, y = "a", "b"
    while len(x) < letters:
        x, y = x + y, y + x
    return x, y


def test_words_are_told_apart():
    for n in (8, 64, 256, 512, 1024, 2048, 4096):
        x, y = thue_morse(n)
        assert len(set(word_hashes(f"{x} {y} {x} {x[:-1]}".encode())[1].tolist())) == 3
    text = ("word " * 300_000 + "y" * 2_000_000 + " end\tof it").encode()
    pieces = [p for _, ps in blocks([b"a", text, b"B c"]) for p in ps]
    assert b"".join(pieces) == b"a" + text + b"b c"
    assert sum(len(word_hashes(p)[0]) for p in pieces) == 1 + 300_004 + 2


@pytest.mark.parametrize("letters", [1024, 2048])
def test_words_of_one_polynomial_hash_are_not_one_word(spark, letters):
    x, y = thue_morse(letters)
    docs = [(1, f"{x} b c d e"), (2, f"{y} b c d e"), (3, f"{x} {y} b c d e {x}"), (4, f"{y.upper()} b c d e")]
    df = spark.createDataFrame(docs, SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.near_components(df).collect()}
    assert got == near_brute(docs) and got[4][1] == 2 and got[2][1] == 2
    assert {r.doc_id: r.text for r in lines.dedup_lines(df).collect()} == line_brute(docs)
    found = remove_repeats(df)
    assert {r.doc_id: (r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found.collect()} == suffix_brute(docs, 100)


def test_tags_are_read_as_html_reads_them():
    assert main_text("<article><p>a</p><script src=/a/>var leaked=1;</script><p>b</p></article>") == "a\nb"
    assert main_text("<article><p title=it's>Text of it</p></article>") == "Text of it"
    assert [b.linked for b in blocks_of("<p><a href=https://e.com/>x</a> y</p>")] == [1]
    inside = '<p class="social-history">History.</p><h2 class="search-results">Results</h2><p>The sign © is old.</p><p><a href="/">One sentence that is a link as a whole and longer than a short one.</a></p>'
    assert main_text(f"<article><p>First one.</p>{inside}<p>Last one.</p></article>").count("\n") == 5
    assert main_text("a < b &lt; c <br/>d") == "" and blocks_of("a < b &lt; c <br/>d")[0].text == "a < b < c d"
    assert blocks_of('x<a b="') [0].text == "x" and blocks_of("") == []


@pytest.mark.parametrize(
    "page",
    ["<a " * 3_500_000, '<a x="' * 500_000, "<span>" * 100_000 + "</p>" * 100_000, "<li><div>" + "<span>" * 100_000 + "<li></li>" * 100_000,
     "<!--" * 500_000, "<" * 500_000, "<script>" * 200_000, "<p><span>" * 100_000],
)
def test_very_long_pages_take_linear_time(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 20


@needs_data
def test_main_text_of_all_pages(spark):
    """The pages' articles taken by patterns that know how these pages are made."""
    import html

    def article(page):
        inner = re.search(r"<article>(.*?)</article>", page or "", re.S)[1]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", inner)
        folded = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\s*/?>", " ", p))).split()) for p in parts]
        return "\n".join(p for p in folded if p)

    rows = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op6_html(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.text, r.n_chars, r.url) == (article(rows[r.page_id].html), len(r.text), rows[r.page_id].url)


@needs_data
def test_most_blocks_are_judged_by_words_links_and_neighbours(spark):
    by = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        found = blocks_of(r.html)
        classify(found)
        for b, _ in zip(found, settle(found)):
            by[b.why] = by.get(b.why, 0) + 1
    assert by.get("marks", 0) < 0.1 * sum(by.values())


@needs_data
def test_fingerprints_of_all_documents(spark):
    """Classes, lengths, edits and likeness against Python's own folding and composition."""
    nfc = lambda t: unicodedata.normalize("NFC", t)
    canonical = lambda t: regex.sub(r"[ \t\n\x0b\f\r\x85\p{Z}]+", " ", nfc(nfc(t).casefold())).strip(" ")
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())[::-1]
    got = {r.doc_id: r for r in queries.op4_fingerprints(spark, SF).collect()}
    assert len(got) == len(docs)
    classes = {}
    for k, (d, text) in enumerate(docs):
        after_id, after = docs[(k + 1) % len(docs)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_next == float(canonical(text) == canonical(after)) == float(r.fingerprint == got[after_id].fingerprint)
        assert r.near_edited == float(canonical(text) == canonical(edited)) == float(r.fingerprint == r.edited_fingerprint)
        classes.setdefault(canonical(text), set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in classes.values()) and len({next(iter(x)) for x in classes.values()}) == len(classes)


@needs_data
def test_components_of_all_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op8_near(spark, SF).collect()}
    assert got == near_brute(docs)


@needs_data
def test_repeats_of_all_documents(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op7_suffixes(spark, SF).collect()}
    want = suffix_brute(docs, 100)
    assert got == {d: (n, gone, len(runs), hashlib.sha256(kept).hexdigest()) for d, (n, gone, runs, kept) in want.items()}


def test_pipeline_of_odd_rows(spark, tmp_path):
    line = "the cat of the house and a dog that is in it with all of their food and water on day "
    text = "\n".join(f"{line}{k} " + " ".join(f"w{k}x{j}" for j in range(40)) for k in range(6))
    rows = [(None, text), (7, text + "\nmore of it"), (7, text), (7, None), (8, ""), (9, " ".join(f"z{k % 997}q{k}" for k in range(40_000)))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, uid string, kept boolean"
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or ""), 1, "u", None) for d, t in rows], schema)
    for name, table in (("some", docs), ("none", docs.limit(0))):
        docs = table
        for stage_name, stage in corpus_pipeline.STAGES:
            out = str(tmp_path / name / stage_name)
            stage(spark, docs, str(tmp_path)).write.parquet(out)
            found = spark.read.parquet(out)
            if stage_name != "packing":
                assert found.columns == table.columns
            docs = found
        ids = {r.doc_id for r in docs.select(F.col("doc_id")).collect()}
        assert ids == ({None, 7, 9} if name == "some" else set())  # 7 keeps a line of its own


def test_a_key_held_by_most_lines(spark):
    """A third of all lines share all but one word; a word stands in every line."""
    docs = [(k, f"all rights reserved by the house of books number n{k}\nword of day d{k} is v{k % 50}") for k in range(400)]
    docs += [(1000 + k, f"here stands {k} alone") for k in range(400)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    tuning = lines.Tuning(group=1 << 11, hot=50, split=200, large=64, leaders=2, best=1, most=2)
    assert {r.doc_id: r.text for r in lines.dedup_lines(df, tuning=tuning).collect()} == line_brute(docs)


def test_very_long_texts_of_native_operators(spark):
    """Words without a repeat, a notice at the end, one word without a space, one line repeated."""
    from docloom.llm import licenses, quality

    prose = " ".join(f"w{k}x" for k in range(60_000))
    docs = [(1, prose + "\nReleased under the MIT License."), (2, "y" * 500_000), (3, "one line of it\n" * 10_000)]
    df = spark.createDataFrame(docs, SCHEMA)
    got = {r.doc_id: r for r in quality.quality_rules(df).collect()}
    assert (got[1].n_words, got[1].n_repeat_words, got[1].n_dup_lines, got[1].kept) == (60_005, 0, 0, True)
    assert (got[2].n_words, got[2].word_chars, got[2].base_failed) == (1, 500_000, True)
    assert (got[3].n_repeat_words, got[3].n_dup_lines) == (40_000, 9_999)
    assert [(r.doc_id, r.place, r.license) for r in licenses.scan_licenses(df).collect()] == [(1, 1, "MIT")]
