"""Licence texts inside prose, with edits, and many in one text."""

import random
import textwrap
import time

from docloom.llm import licenses as L


def bigrams(words):
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def dice(passage, template):
    a, b = bigrams(L.words_in(passage)), L.bigrams_of(template)
    return 2 * len(a & b) / (len(a) + len(b))


def test_planted_texts_with_edits(spark):
    rnd = random.Random(7)
    prose = lambda n: " ".join(f"word{rnd.randint(0, 500)}" for _ in range(n))
    docs, want = [], {}
    for k in range(60):
        lines, places = [], []
        for _ in range(rnd.randint(1, 4)):
            name, text = rnd.choice(L.FULL_TEXTS)
            words = text.split()
            for _ in range(len(words) // 40):
                words[rnd.randrange(len(words))] = "changed"
            lines += [prose(80), prose(90)]
            places.append((len(lines), name))
            lines += textwrap.wrap(" ".join(words), 70)
        docs.append((k, "\n".join([*lines, prose(70)])))
        want[k] = places
    got = {}
    for r in L.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        if r.place >= 0 and len(r.passage) > 90:
            got.setdefault(r.doc_id, []).append(r)
    for k, places in want.items():
        found = sorted(got.get(k, []), key=lambda r: r.place)
        assert len(found) == len(places), (k, places, [(r.place, r.license) for r in found])
        for r, (place, name) in zip(found, places):
            # An edit may take a version: then the kind is what is left to tell.
            assert r.license.split("-")[0] == name.split("-")[0] and abs(r.place - place) <= 1
            assert abs(r.dice - max(dice(r.passage, t) for n, t in L.FULL_TEXTS if n == r.license)) < 1e-9


def test_many_texts_in_one(spark):
    mit = textwrap.fill(L.FULL_TEXTS[8][1], 78)
    text = "\n\n".join(f"Component number {k} by someone else here\n{mit}" for k in range(300))
    began = time.perf_counter()
    found = L.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert len(found) == len({r.place for r in found}) == 300 and {r.license for r in found} == {"MIT"}
    assert time.perf_counter() - began < 60
