"""The pipeline's stages, each against brute force on its own input."""

import random

import corpus_pipeline
from test_llm_operators import line_brute, near_brute, suffix_brute


def test_stages(spark, tmp_path):
    rnd = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("ar", "es", "ion", "the", "und")]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n)) + "."
    passage = line(60)
    docs = [(k, "\n".join(line(rnd.randint(10, 30)) for _ in range(5))) for k in range(40)]
    docs += [(100 + k, docs[k][1] + " more") for k in range(5)]
    docs += [(200 + k, line(40) + " " + passage + " " + line(40)) for k in range(4)]
    docs += [(300, None), (301, "short"), (302, "#x $y " * 60), (303, docs[0][1])]
    folder = str(tmp_path / "documents.parquet")
    rows = [(d, t, "en", "src", len(t or "")) for d, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(folder)
    table = spark.read.parquet(folder)
    held, texts = [sorted(docs)], []
    for name, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, str(tmp_path))
        table.write.parquet(str(tmp_path / name))
        table = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert table.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            found = sorted((r.doc_id, r.text) for r in table.collect())
            assert all(r.n_chars == len(r.text) for r in table.collect())
            held.append(found)
        texts.append(name)
    assert texts == ["quality_rules", "line_dedup", "near_dedup", "passage_dedup", "packing"]
    read, good, lined, near, cut = held
    assert {d for d, _ in read} - {d for d, _ in good} == {300, 301, 302}
    assert dict(lined) == line_brute(good)
    assert {d for d, _ in near} == {d for d, (_, root, kept) in near_brute(lined).items() if kept}
    assert dict(near).items() <= dict(lined).items()
    assert dict(cut) == {d: kept.decode("utf-8", "ignore") for d, (_, _, _, kept) in suffix_brute(near, 100).items()}
    assert {r.doc_id for r in table.select("doc_id").distinct().collect()} == {d for d, _ in cut}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == table.count()
