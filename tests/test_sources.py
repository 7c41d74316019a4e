import io
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from docloom.cli import main
from docloom.operators.store import VectorStore
from docloom.plans import corpus as C
from docloom.schemas import POINT
from docloom.sources import files as S
from docloom.sources.parsers import DocxParser, MsgParser, ParserRegistry, PdfParser, RtfParser


def docx(*paragraphs):
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{body}</w:body></w:document>")
    return out.getvalue()


def pdf(text):
    stream = zlib.compress(f"BT /F1 12 Tf ({text}) Tj T* [(sec) -20 (ond)] TJ ET".encode())
    return b"%PDF-1.4\n1 0 obj <<>>\nstream\n" + stream + b"\nendstream\nendobj"


def msg(body, subject):
    """A compound file with two small streams."""
    names = ["Root Entry", "__substg1.0_1000001F", "__substg1.0_0037001F"]
    data = [body.encode("utf-16-le"), subject.encode("utf-16-le")]
    minis, starts, mini_fat = b"", [], []
    for d in data:
        starts.append(len(minis) // 64)
        n = max(1, -(-len(d) // 64))
        mini_fat += [len(mini_fat) + k + 1 for k in range(n - 1)] + [0xFFFFFFFE]
        minis += d.ljust(n * 64, b"\0")
    minis = minis.ljust(-(-len(minis) // 512) * 512, b"\0")
    sectors = len(minis) // 512
    fat = [0xFFFFFFFD, 0xFFFFFFFE, 0xFFFFFFFE] + [3 + k + 1 for k in range(sectors - 1)] + [0xFFFFFFFE]
    entries = b""
    for k, name in enumerate(names):
        raw = name.encode("utf-16-le")
        e = raw.ljust(64, b"\0") + struct.pack("<HBB", len(raw) + 2, 5 if k == 0 else 2, 1)
        right = 2 if k == 1 else 0xFFFFFFFF
        e += struct.pack("<III", 0xFFFFFFFF, right, 1 if k == 0 else 0xFFFFFFFF) + b"\0" * 36
        e += struct.pack("<IQ", 3 if k == 0 else starts[k - 1], len(minis) if k == 0 else len(data[k - 1]))
        entries += e
    pack = lambda xs: struct.pack(f"<{len(xs)}I", *xs).ljust(512, b"\xff")
    head = bytes.fromhex("d0cf11e0a1b11ae1") + b"\0" * 16 + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + b"\0" * 10
    head += struct.pack("<IIIIIIII", 1, 1, 0, 4096, 2, 1, 0xFFFFFFFE, 0) + struct.pack("<I", 0) + b"\xff" * 432
    return head + pack(fat) + entries.ljust(512, b"\0") + pack(mini_fat) + minis


def test_parsers():
    assert DocxParser().parse(docx("one", "two &amp; three")) == {"text": "one\ntwo & three"}
    assert PdfParser().parse(pdf("first \\(x\\)")) == {"text": "first (x)\nsecond"}
    assert MsgParser().parse(msg("Telo správy", "Predmet")) == {"text": "Telo správy", "subject": "Predmet"}
    rtf = rb"{\rtf1\ansi\ansicpg1250{\fonttbl{\f0 Arial;}}\f0 \'9eiados\u357? x\par y}"
    assert RtfParser().parse(rtf) == {"text": "žiadosť x\ny"}


def test_registry():
    registry = ParserRegistry()
    assert isinstance(registry.get(".DOCX"), DocxParser)
    with pytest.raises(ValueError, match="No parser found"):
        registry.get(".xyz")


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "in"
    (root / "CategoryA").mkdir(parents=True)
    (root / "CategoryA" / "a.docx").write_bytes(docx("This is the text of a file, mail x@y.sk or +421900123456.", "and more"))
    (root / "CategoryA" / "copy.docx").write_bytes(docx("This is the text of a file, mail x@y.sk or +421900123456.", "and more"))
    (root / "b.pdf").write_bytes(pdf("hi"))
    (root / "bad.docx").write_bytes(b"no zip")
    (root / "c.txt").write_text("plain")
    (root / "UPPER.PDF").write_bytes(pdf("upper"))
    return root


def test_ingest_and_inventory(spark, tree):
    names = lambda df: {r.path.rsplit("/", 1)[-1] for r in df.select("path").collect()}
    assert names(S.ingest(spark, str(tree))) == {"a.docx", "copy.docx", "b.pdf", "bad.docx"}
    assert "UPPER.PDF" in names(S.ingest(spark, str(tree), any_case=True))
    rows = {r.path.rsplit("/", 1)[-1]: r for r in S.inventory(spark, str(tree)).collect()}
    assert rows["UPPER.PDF"].suffix == ".pdf" and rows["c.txt"].size_bytes == 5 and rows["c.txt"].error is None
    snippets = {r.path.rsplit("/", 1)[-1]: r.snippet for r in S.snippets(S.all_files(spark, str(tree))).collect()}
    assert snippets["c.txt"] == "plain" and snippets["bad.docx"] == "no zip"


def test_pipeline_to_search(spark, tree, tmp_path):
    class Reader:
        def read(self, contents):
            return [" scanned text that is long enough to be worth keeping " for _ in contents]

    out = str(tmp_path / "records")
    done = C.run_pipeline(spark, str(tree), out, ocr_backend=Reader())
    assert {r.path.rsplit("/", 1)[-1] for r in done.dead.collect()} == {"bad.docx"}
    records = S.read_jsonl(spark, out, pattern="*.json").collect()
    assert len(records) == 2
    by = {r.category: r for r in records}
    a = by["CategoryA"]
    assert a.language == "en" and a.token_estimate >= 5 and 0 < a.pii_risk <= 1 and a.hash_sha1 == a.hash_content and a.line_count == 2
    assert a.is_duplicate and a.source.endswith("copy.docx")
    assert by["root"].ocr and by["root"].text.startswith("scanned")
    taxonomy = C.analyze(spark, out, str(tmp_path / "taxonomy"))
    assert taxonomy["categories"]["overview"] == {"CategoryA": 1, "root": 1}
    assert (tmp_path / "taxonomy" / "taxonomy_rag.json").exists()
    store = VectorStore(spark, str(tmp_path / "vectors"))
    for _ in range(2):  # loading the same folder again replaces its points
        stats = C.load_folder(spark, out, store)
        assert (stats.total, stats.uploaded, stats.failed, stats.success_rate) == (2, 2, 0, 100.0)
        assert store.stats()["points_count"] == 2
    engine = C.RetrievalEngine(store)
    hits = engine.search("text of a file", ["x"], limit=5).collect()
    assert hits[0].text.startswith("This is the text") and not hits[0].was_boosted
    assert engine.search("  ").count() == 0
    truth = spark.createDataFrame([("text of a file", a.hash_content)], "query string, expected_doc_id string")
    _, total = engine.evaluate(truth, 1, 5)
    assert total.first().recall_at_1 == 1.0
    assert engine.search_summary("scanned", limit=1).count() == 1
    assert C.extract_metadata(spark, str(tree), str(tmp_path / "meta")).count() == 6


def test_full_pipeline_of_the_command_line(spark, tree, tmp_path, capsys):
    records, vectors = str(tmp_path / "records"), str(tmp_path / "vectors")
    (tree / "b.pdf").write_bytes(pdf("a text about visas"))
    assert main(["full-pipeline", "-i", str(tree), "--preprocessed", records, "--taxonomy-out", str(tmp_path / "taxonomy"), "--store", vectors]) == 0
    said = capsys.readouterr().out
    assert '"total_categories": 2' in said and 'categories {"CategoryA": 1, "root": 1}' in said and "2 of 2 uploaded (100.0 %)" in said
    assert main(["taxonomy-analyze", "--preprocessed", records]) == 0
    assert main(["vector-load", records, "--store", vectors, "--collection", "again"]) == 0
    assert "2 of 2 uploaded" in capsys.readouterr().out
    assert VectorStore(spark, vectors, "again").read().count() == 2


def point(k, word):
    payload = {"text": word, "source": "s", "tags": [], "is_duplicate": False}
    return (f"p{k}", [1.0, float(k)], [0.0, 1.0], payload)


def test_store_versions(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path), "c", retry_delay=0.0)
    assert store.create(2) and not store.create(2) and store.read().count() == 0
    rows = lambda *given: spark.createDataFrame([point(*g) for g in given], POINT)
    assert store.upsert(rows(*[(k, "old") for k in range(200)])) == 200
    before = store.folders()
    assert store.upsert(rows((3, "new"), (500, "more"))) == 2
    after = store.folders()
    assert len({b for b in after if before.get(b) != after[b]}) <= 2  # other buckets stay as they were
    held = {r.id: r.payload.text for r in store.read().collect()}
    assert len(held) == 201 and held["p3"] == "new" and held["p4"] == "old" and held["p500"] == "more"
    # Another writer takes the version between this one's reading and writing: it merges anew.
    points, other, calls = store._points, VectorStore(spark, str(tmp_path), "c"), []

    def slow(folders):
        calls.append(1)
        if len(calls) == 1:
            other.upsert(rows((600, "theirs")))
        return points(folders)

    store._points = slow
    assert store.upsert(rows((601, "mine"))) == 1 and len(calls) == 2
    store._points = points
    assert store.read().where("id in ('p600', 'p601')").count() == 2
    assert store.upsert(rows()) == 0 and store.drop() and not store.exists()


def test_ground_truth(spark, tmp_path):
    path = tmp_path / "truth.csv"
    path.write_text('query,expected_doc_id\n"a, b", x \n,y\nq,\nz,"""abc"\n')
    assert [tuple(r) for r in S.read_ground_truth(spark, str(path)).collect()] == [("a, b", "x"), ("z", '"abc')]
    assert S.read_ground_truth(spark, str(path), clean=True).collect()[1].expected_doc_id == "abc"
    ids = S.with_point_ids(S.read_ground_truth(spark, str(path))).collect()
    assert ids[0].expected_doc_id == "x"


def test_raw_metadata_and_sorted_files(spark, tmp_path):
    import docloom

    folder = tmp_path / "m"
    (folder / "deep").mkdir(parents=True)
    (folder / "b.json").write_text('{"nazov_suboru": "one",\n "tagy": ["x"]}')
    (folder / "a.json").write_text('[{"nazov_suboru": "two"}, {"nazov_suboru": "three"}]')
    (folder / "deep" / "c.jsonl").write_text('{"nazov_suboru": "four"}\n\n{"nazov_suboru": "five"}\n')
    rows = S.load_raw_metadata(spark, str(folder)).collect()
    assert {r.nazov_suboru: r.path.rsplit("/", 1)[-1] for r in rows} == {"one": "b.json", "two": "a.json", "three": "a.json", "four": "c.jsonl", "five": "c.jsonl"}
    assert [r.path.rsplit("/", 1)[-1] for r in S.sorted_files(spark, str(folder)).collect()] == ["a.json", "b.json", "c.jsonl"]
    S.save_ground_truth(spark.createDataFrame([("q", "a" * 40), ("r", "x")], "query string, expected_doc_id string"), str(tmp_path / "truth"))
    saved = {r.query: r.expected_doc_id for r in S.read_ground_truth(spark, str(tmp_path / "truth")).collect()}
    assert saved["r"] == "x" and len(saved["q"]) == 36
    assert docloom.VectorStore is VectorStore and "analyze" in docloom.__all__


def test_jsonl(spark, tmp_path):
    folder = tmp_path / "j"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"text": "t", "tags": ["x"]}\nnot json\n')
    rows = S.read_jsonl(spark, str(folder)).orderBy(F.col("text").asc_nulls_last()).collect()
    assert rows[0].text == "t" and rows[0].path.endswith("a.jsonl") and rows[1]._corrupt == "not json"
    docs = spark.createDataFrame([("h", 1, "old"), ("h", 2, "new")], "hash_sha1 string, seq int, text string")
    S.write_jsonl(docs, str(tmp_path / "o"), "seq")
    assert [r.text for r in spark.read.json(str(tmp_path / "o")).collect()] == ["new"]
