"""The registered queries where they once did less than the whole job."""

import random
import textwrap

import corpus_pipeline
from test_llm_operators import SCHEMA, line_brute

from docloom.llm import licenses, queries
from docloom.llm.html import main_text


def test_short_lines_take_part(spark, tmp_path):
    rnd = random.Random(11)
    words = [f"w{k}" for k in range(12)]
    line = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9)))
    docs = [(k, "\n".join([line(), "All rights reserved.", "", line()])) for k in range(60)]
    docs += [(100 + k, t) for k, t in enumerate(["a b c d", "d c b A", "a b c e", "a b c d e", "one", "ONE", "two", "\n\n"])]
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    want = line_brute(docs)
    found = {r.doc_id: r for r in queries.op3_lines(spark, str(tmp_path)).collect()}
    assert {d: r.text for d, r in found.items()} == want
    assert sum("All rights reserved." in t for t in want.values()) == 1
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id: r.text for r in corpus_pipeline.lines(spark, table, str(tmp_path)).collect()} == want


def test_article_is_one_feature():
    long = "This is the paragraph that has many of the words that are in the list and so it is kept as the text of the page for all of it. " * 2
    teaser = f"<body><article><p>Teaser.</p></article><div><p>{long}</p><p>Short one.</p><p>{long}</p></div></body>"
    assert main_text(teaser).split("\n") == ["Teaser.", long.strip(), "Short one.", long.strip()]
    links = '<p><a href="/">One</a> <a href="/">two</a></p>'
    poor = "bleanou ndoring onstanin thhashen inorhe stedon tionndre thntsh whorre"
    page = f"<body><article><p>{long}</p><p>{poor}</p><p>{long}</p>{links}<p>More:</p>{links}</article><p>{poor}</p></body>"
    assert main_text(page).split("\n") == [long.strip(), poor, long.strip()]


def test_licences_over_lines_and_inside_them(spark):
    prose = "Some words of the story that stand before and after it, and go on for a while in the same line"
    tail = " ".join(f"x{k}" for k in range(400))
    texts, want = [], []
    for k, (name, text) in enumerate(licenses.FULL_TEXTS):
        texts.append(f"{prose}\n\n" + textwrap.fill(text, 78) + "\n\n" + tail)
        want.append((k, 2, name))
    n = len(texts)
    texts.append("The MIT License (MIT)\n\nCopyright (c) 2020 A. B.\n\n" + textwrap.fill(licenses.FULL_TEXTS[8][1], 78))
    texts.append(f"{prose}. Licensed under CC BY 4.0. {prose}\n{prose}")
    texts.append(f"{prose}\n{prose}\nof the story")
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = sorted((r.doc_id, r.place, r.license) for r in licenses.scan_licenses(df).collect())
    assert got == want + [(n, -1, "MIT"), (n + 1, 0, "CC-BY-4.0")]
