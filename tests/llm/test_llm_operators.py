"""Each operator against a brute-force version, on small rows with the odd cases in them."""

import hashlib
import random
import re
import struct
from dataclasses import replace

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docloom.llm import fingerprints, licenses, lines, near, quality, urls
from docloom.llm.bpe import encode_decode
from docloom.llm.html import extract_main_text, main_text
from docloom.llm.lines import dedup_lines
from docloom.llm.packing import pack_sequences
from docloom.llm.suffixes import remove_repeats
from docloom.llm.tokens import ByteBpe, WordBpe, pack_ids

SCHEMA = "doc_id long, text string"
ODD = [(900, None), (901, ""), (902, " \n"), (903, "x" * 5000), (903, "twice"), (903, "twice"), (None, "no id"), (904, "\u00e9\U0001f600 <|endoftext|> \u0130")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({"uid": F.lit("x"), "row": F.lit(1), "token": F.lit(None).cast("int")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0d]+", low)


def mixed_texts(seed, n=300, most=40):
    rnd = random.Random(seed)
    parts = ["a", "b", "the", "  ", "\n", " ", "\n\n", "\t", "e\u0301", "\u00e9", "'s", "'", "!!", "<|endoftext|>", "<|startoftext|>", "\u00df", "\u0130", "\x1c", "\u00a0", "123", "\u4e2d", "\U0001f600", "ing", "\u03a3", "\r\n", "\u0085"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, most))) for _ in range(n)]


def test_encoders_equal_the_library():
    byte, word, small = ByteBpe(), WordBpe(), WordBpe(leaf=3, part=4)
    rnd = random.Random(1)
    long = ["".join(rnd.choice("theinaorsnd") for _ in range(rnd.randint(50, 600))) + "!!'s12" for _ in range(60)]
    for text in mixed_texts(2) + long:
        assert byte.encode(text) == pack_ids(byte.full.encode(text, add_special_tokens=False).ids)
        ids = word.full.encode(text, add_special_tokens=False).ids
        want = (pack_ids(ids), word.full.decode(ids, skip_special_tokens=False))
        assert word.encode_decode(text) == want and small.encode_decode(text) == want


def test_unsplit_text_in_five_alphabets():
    bpe, rnd = WordBpe(), random.Random(2)
    joins = []
    join = bpe.join
    bpe.join = lambda *given: joins.append(1) or join(*given)
    for letters in ("theinaorsnd", "\u03b1\u03b2\u03b3\u03b4\u03b5", "\u0430\u0431\u0432\u0433\u0434\u0435", "\u4e2d\u6587\u5b57\u65e5\u672c", "\u0627\u0628\u062a\u062b"):
        text = "".join(rnd.choice(letters) for _ in range(100_000))
        ids = bpe.full.encode(text, add_special_tokens=False).ids
        joins.clear()
        assert bpe.encode_decode(text) == (pack_ids(ids), bpe.full.decode(ids, skip_special_tokens=False))
        assert len(joins) >= 31


def test_bpe_rows(spark, odd, empty):
    bpe = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in encode_decode(odd).collect())
    ids = [(d, bpe.encode(t or "", add_special_tokens=False).ids) for d, t in ODD]
    assert got == sorted((str(d), pack_ids(i), bpe.decode(i, skip_special_tokens=False)) for d, i in ids)
    assert encode_decode(empty).count() == 0


def test_packing(spark, odd, empty):
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(3)
    texts = [(k, " ".join(rnd.choice(["alpha", "beta", "gamma"]) for _ in range(rnd.randint(0, 90)))) for k in range(120)]
    df = spark.createDataFrame(texts, SCHEMA).repartition(4)
    pieces = pack_sequences(df, size=64, open_windows=3).collect()
    by, windows = {}, {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
        windows.setdefault(p.sequence_id, []).append(p)
    for doc, text in texts:
        ids = bpe.encode(text, add_special_tokens=False).ids + [1]
        parts = sorted(by[doc], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in parts) == struct.pack(f"<{len(ids)}I", *ids)
        assert [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        assert {p.doc_tokens for p in parts} == {len(ids)}
    sizes = []
    for parts in windows.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        sizes.append(sum(p.length for p in parts))
    short = [s for s in sizes if s != 64]
    assert all(s & (s - 1) == 0 for s in short) and len(short) == len(set(short)) <= 6
    assert sum(p.length for p in pack_sequences(odd).collect()) > len(ODD)
    assert pack_sequences(empty).count() == 0


def test_quality_against_python(spark, odd, empty):
    rnd = random.Random(4)
    texts = ["\n".join(" ".join(rnd.choice("the of and cat dog #x a&b AB".split()) for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(0, 8))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for r in quality.quality_rules(df).collect():
        text = texts[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0d]+", text)
        windows = {}
        for k in range(len(w) - 2):
            windows.setdefault(tuple(w[k : k + 3]), []).append(k)
        repeated = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(repeated))
        assert (r.n_symbols, r.n_dup_lines) == (len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 50 or 2 * len(repeated) > len(w))
        assert not (r.base_failed and r.kept)
    rows = quality.quality_rules(odd).collect()
    assert len(rows) == len(ODD) and not any(r.kept for r in rows)
    assert quality.quality_rules(empty).count() == 0
    assert quality.keep_good(odd).columns == odd.columns


def test_rule_order_never_changes_verdicts(spark):
    texts = [(k, ("word " * 60 if k % 2 else "AB #x " * 60) + str(k)) for k in range(20)]
    df = quality.base_metrics(spark.createDataFrame(texts, SCHEMA))
    a = [r[0] for r in df.select(quality.cascade(quality.RULES)).collect()]
    b = [r[0] for r in df.select(quality.cascade(quality.RULES[::-1])).collect()]
    assert a == b


def line_brute(docs, percent=75):
    lines, by_token, gone = [], {}, {}
    for d, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            w = frozenset(words_of(line))
            lines.append(w)
            if not w:
                continue
            both = {}
            for x in w:
                for j in by_token.get(x, ()):
                    both[j] = both.get(j, 0) + 1
            if any(100 * n >= percent * (len(w) + len(lines[j]) - n) for j, n in both.items()):
                gone.setdefault(d, set()).add(k)
            for x in w:
                by_token.setdefault(x, []).append(len(lines) - 1)
    return {d: "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone.get(d, ())) for d, t in docs}


def test_lines_against_brute_force(spark, odd, empty):
    rnd = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    docs = []
    for k in range(100):
        made = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 60))) for _ in range(rnd.randint(0, 4))]
        if docs and rnd.random() < 0.6:
            old = rnd.choice(rnd.choice(docs)[1].split("\n")).split(" ")
            for _ in range(rnd.randint(0, 1 + len(old) // 6)):
                old[rnd.randrange(len(old))] = rnd.choice(vocabulary)
            made.append(" ".join(old))
        docs.append((k, "\n".join(made)))
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    want = line_brute(docs)
    assert {r.doc_id: r.text for r in dedup_lines(df).collect()} == want
    # Every token hot, groups split, small groups; then few leaders and candidates: the second round has work.
    few = lines.Tuning(group=1 << 12, hot=10, split=20)
    for tuning in (few, replace(few, large=2, leaders=1, best=1, most=1), replace(few, hot=1 << 12, large=2, leaders=1, best=1, most=1)):
        assert {r.doc_id: r.text for r in dedup_lines(df, tuning=tuning).collect()} == want
    assert dedup_lines(odd).count() == len(ODD) and dedup_lines(empty).count() == 0
    same = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "x\nA b c d e")], SCHEMA)
    assert sorted(r.text for r in dedup_lines(same).collect()) == ["", "", "x\nA b c d e"]
    carried = dedup_lines(odd, carry=True).select("row.*")
    assert carried.columns == ["doc_id", "uid", "row", "token"]


def test_fingerprints(spark, odd, empty, monkeypatch):
    docs = [(1, "Stra\u00dfe  a"), (2, "STRASSE\ta"), (3, "e\u0301"), (4, "\u00e9"), (5, "other " * 20), (9, None)]
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint == got[4].fingerprint
    order = sorted(docs, reverse=True)
    for k, (d, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[d].n_chars == len(text)
        assert got[d].near_next == float(got[d].fingerprint == got[order[(k + 1) % len(order)][0]].fingerprint)
    assert got[4].near_edited == 1.0 and got[5].near_edited == 0.0
    assert fingerprints.fingerprint_documents(odd).count() == len(ODD)
    assert fingerprints.fingerprint_documents(empty).count() == 0
    # Few hash values: buckets with different texts are told apart by their bytes.
    monkeypatch.setattr(fingerprints, "wide_hash", lambda c, words: F.substring(F.md5(c), 1, 1))
    many = [(k, f"text {k % 40}") for k in range(80)]
    rows = fingerprints.fingerprint_documents(spark.createDataFrame(many, SCHEMA)).collect()
    assert len({(r.fingerprint, many[r.doc_id][1]) for r in rows}) == len({r.fingerprint for r in rows}) == 40


def suffix_brute(docs, depth):
    seen, out = set(), {}
    for d, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - depth + 1):
            w = data[p : p + depth]
            if w in seen:
                gone[p : p + depth] = b"\1" * depth
            seen.add(w)
        runs = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out[d] = (len(data), sum(gone), runs, bytes(x for x, g in zip(data, gone) if not g))
    return out


@pytest.mark.parametrize("depth,anchor,letters", [(24, 6, "ab"), (100, 40, "abc "), (30, 10, "a\u00e9")])
def test_suffixes_against_brute_force(spark, depth, anchor, letters):
    rnd = random.Random(depth)
    pool = ["".join(rnd.choice(letters) for _ in range(rnd.randint(20, 200))) for _ in range(12)]
    docs = [(k, "".join(rnd.choice(pool)[: rnd.randint(1, 200)] for _ in range(rnd.randint(0, 5)))) for k in range(120)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in remove_repeats(df, depth=depth, anchor=anchor).collect()}
    assert got == suffix_brute(docs, depth)


def test_suffixes_of_odd_rows(spark, odd, empty):
    rows = remove_repeats(odd, carry=True)
    assert rows.count() == len(ODD) and remove_repeats(empty).count() == 0
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(1_200_000))
    docs = [(0, long), (1, long[500_000:900_000] + "x" + long[1_000_000:1_100_000])]
    got = {r.doc_id: r.n_removed for r in remove_repeats(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {0: 0, 1: 500_000}


def near_brute(docs, percent=75, k=5):
    sets, parent = {}, {}
    for d, text in docs:
        w = words_of(text)
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
        parent[d] = d

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = top(a), top(b)
                    parent[max(x, y)] = min(x, y)
    return {d: (len(s), top(d), top(d) == d) for d, s in sets.items()}


def test_near_against_brute_force(spark, monkeypatch):
    rnd = random.Random(6)
    docs = []
    for _ in range(2):
        base = [f"{rnd.choice('abcdef')}{rnd.randint(0, 99)}" for _ in range(120)]
        for _ in range(110):
            text = list(base)
            for _ in range(rnd.randint(0, 12)):
                text[rnd.randrange(len(text))] = rnd.choice(["q", "r", str(rnd.random())])
            docs.append((len(docs), " ".join(text)))
    docs += [(1000 + k, t) for k, t in enumerate(["", "  ", None, "a", "A", "a b c", "a b c d e", "A b c d E", "a b c d e f"])]
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    want = near_brute(docs)
    for followers in (4096, 32):
        monkeypatch.setattr(near, "FOLLOWERS", followers)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.near_components(df).collect()}
        assert got == want


def test_near_of_odd_rows(spark, odd, empty):
    rows = near.near_components(odd, carry=True)
    assert rows.count() == len(ODD) and sum(r.kept for r in rows.collect()) == len(ODD) - 1
    assert near.near_components(empty).count() == 0
    word = "y" * 1_500_000
    docs = spark.createDataFrame([(1, f"{word} b c d e"), (2, f"{word.upper()} b c d e"), (3, "z" * 1_500_000 + " b c d e")], SCHEMA)
    assert {r.doc_id: r.component_id for r in near.near_components(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_urls(spark):
    pages = [
        (1, "https://A.Example.COM/en/7?x#y"), (2, "http://m.example.com/en/8"), (3, "http://example.net/de/8"), (4, "x.net/de/"),
        (5, None), (6, "http://sub.casino-win.example.com/fr/"), (7, "http://notcasino-win.example.com/fr/"),
        (8, "http://a.org/es/#"), (9, "//x://h/p://q"), (9, "http://other.net/de/1"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df).collect())
    assert got == [
        (1, "a.example.com", "/en/7", "example.com/en/7", "allow"), (2, "m.example.com", "/en/8", "com/en/", "block"),
        (3, "example.net", "/de/8", "example.net/de/8", "block"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "sub.casino-win.example.com", "/fr/", None, "block"), (7, "notcasino-win.example.com", "/fr/", None, "allow"),
        (8, "a.org", "/es/", "org/es/", "block"), (9, "h", "/p://q", None, "allow"), (9, "other.net", "/de/1", "net/de/", "allow"),
    ]
    hosts = spark.createDataFrame([(k, f"http://h{k}.site/") for k in range(400)], "page_id long, url string")
    listed = [f"h{k}.site" for k in range(0, 400, 7)] + ["absent.site"]
    for given in (listed, spark.createDataFrame([(x, 1) for x in listed], "name string, row int")):
        rows = urls.judge_urls(hosts, rules=[], listed=given).collect()
        assert {r.page_id for r in rows if r.verdict == "block"} == set(range(0, 400, 7))
    assert urls.judge_urls(df.limit(0)).count() == 0 and urls.judge_urls(df, rules=[], listed=[]).where("verdict = 'block'").isEmpty()
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("host", "path", "verdict", "key", "listed")])
    assert sorted(tuple(r) for r in urls.judge_urls(clash).collect()) == got
    long = spark.createDataFrame([(1, "http://" + "a." * 3000 + "casino-win.example.com/x" + "y" * 500_000)], "page_id long, url string")
    assert [(r.verdict, len(r.path)) for r in urls.judge_urls(long).collect()] == [("block", 500_002)]


def test_a_million_listed_keys_go_through_the_cascade(spark):
    pages = spark.range(1_500_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), "id", F.lit(".site/")).alias("url"))
    listed = spark.range(0, 3_000_000, 3).select(F.concat(F.lit("h"), "id", F.lit(".site")).alias("name"))
    judged = urls.judge_urls(pages, rules=[], listed=listed)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" in plan
    assert judged.where((F.col("verdict") == "block") != (F.col("page_id") % 3 == 0)).count() == 0
    assert judged.where("verdict = 'block'").count() == 500_000


def test_licenses(spark, odd, empty):
    texts = [
        "prose that goes on for a while\nReleased under the MIT License.\nand then some more of it", "licensed under CC BY-NC 4.0", "This work is licensed under the GNU General Public License, version 2.",
        "Licensed fishing is allowed here.", "\n".join(licenses.TEMPLATES[11][1].split(". ")), "Released under an MIT License",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = sorted((r.doc_id, r.place, r.license) for r in licenses.scan_licenses(df).collect())
    assert got == [(0, 1, "MIT"), (1, 0, "CC-BY-NC-4.0"), (2, 0, "GPL-2.0-only"), (4, 0, "MIT")]
    assert licenses.scan_licenses(odd).count() == 0 and licenses.scan_licenses(empty).count() == 0


def test_html(spark):
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav><!-- no --><div class="ad">Buy</div>'
        '<article><header><h1>Head &amp; line</h1></header><p>One <b>bold<br>text.<p>Two &lt;3</p><script>var t="</p>";</script>'
        '<div class="comments"><p>First!</p></div><aside>See also</aside></article><footer>&copy; x</footer></body></html>'
    )
    assert main_text(page) == "Head & line\nOne bold text.\nTwo <3"
    long = "This is the paragraph that has many of the words that are in the list and so it is kept as the text of the page for all of it. " * 2
    loose = f'<body><div id="cookie-notice">We use cookies</div><h2>Title</h2><p>{long}</p><p>Short one.</p><p>{long}</p><div id="comments"><p>{long}</p></div><form>Name</form></body>'
    assert main_text(loose).split("\n") == ["Title", long.strip(), "Short one.", long.strip()]
    assert main_text("") == ""
    rows = spark.createDataFrame([(1, "u", page), (1, None, None), (None, "v", "<p>")], "page_id long, url string, html string")
    got = extract_main_text(rows).collect()
    assert [r.n_chars for r in got] == [len(main_text(page)), 0, 0]
