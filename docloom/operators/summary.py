"""Summaries made of a document's own sentences, weighed by how rare their words are in all documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.terms import words_of
from docloom.scratch import written

#: Documents and words of a block at most; a document of more words is a block of its own.
DOCUMENTS, WORDS = 4096, 1 << 20


def sentences_of(text: Column) -> Column:
    """Sentences and lines of a text, without white space around them."""
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])\s+", "$1\n")
    return F.filter(F.transform(F.split(lines, r"\n"), lambda s: F.trim(s)), lambda s: s != "")


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, sentences as lists of words) as blocks: each word is a number in the block's list of terms.

    A block has the keys, how many sentences each document and how many words each sentence has, all words' numbers, and for
    each term in how many of the block's documents it stands.
    """
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 33
    for batch in batches:
        sentences = batch.column(1)
        words_before = sentences.values.offsets.to_numpy()[sentences.offsets.to_numpy()]
        a = 0
        while a < batch.num_rows:
            z = int(np.searchsorted(words_before, words_before[a] + WORDS, side="right")) - 1
            z = min(max(z, a + 1), a + DOCUMENTS, batch.num_rows)
            some = sentences.slice(a, z - a)
            inner = some.flatten()
            coded = inner.flatten().dictionary_encode()
            per_doc, per_sentence = np.diff(some.offsets.to_numpy()), np.diff(inner.offsets.to_numpy())
            code = coded.indices.to_numpy().astype(np.int64)
            doc = np.repeat(np.repeat(np.arange(z - a), per_doc), per_sentence)
            n = max(len(coded.dictionary), 1)
            df = np.bincount(np.unique(doc * n + code) % n, minlength=len(coded.dictionary))
            lists = [batch.column(0).slice(a, z - a), pa.array(per_doc, pa.int32()), pa.array(per_sentence, pa.int32()), coded.indices, coded.dictionary, pa.array(df[: len(coded.dictionary)], pa.int32())]
            boxed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *boxed], names=["block", "keys", "per_doc", "per_sentence", "codes", "terms", "df"])
            block, a = block + 1, z


def weighed_words(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """Blocks of documents (keys, per_doc, per_sentence, codes, terms, idf), idf = floor(1000 * ln((documents + 1) / (df + 1))) for each of its terms.

    Words are counted where the documents lie: what is shuffled are the distinct words of each block, and blocks once. Rows
    of equal keys are one document, sentence by sentence.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, F.transform(sentences_of(text), words_of).alias("w"))
    if docs.groupBy(key).count().where("count > 1").limit(1).count():
        none = F.array().cast("array<string>")
        both = lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(F.coalesce(x, none), F.coalesce(y, none)))
        rows = rows.groupBy(key).agg(F.collect_list("w").alias("w")).select(key, F.aggregate("w", F.array().cast("array<array<string>>"), both).alias("w"))
    shape = f"block long, keys array<{kind}>, per_doc array<int>, per_sentence array<int>, codes array<int>, terms array<string>, df array<int>"
    blocks = written(rows.mapInArrow(packed, shape), "blocks")
    n = docs.count()
    each = blocks.select("block", F.posexplode(F.arrays_zip("terms", "df")).alias("place", "x")).select("block", "place", F.col("x.terms").alias("term"), F.col("x.df").alias("n"))
    df = each.groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.floor(1000 * F.log((F.lit(float(n)) + 1) / (F.col("df") + 1)))
    known = each.join(df, "term").select("block", "place", idf.alias("idf"))
    listed = known.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "idf"))), lambda x: x["idf"]).alias("idf"))
    return blocks.drop("df").join(listed, "block", "left")


class Block:
    """A block's documents: tf * idf of their distinct words, and the score of every sentence that has a word."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        lists = {c: batch.column(c)[at].values for c in ("keys", "per_doc", "per_sentence", "codes", "terms")}
        idf = batch.column("idf")[at].values
        self.keys, self.terms = lists["keys"], lists["terms"]
        self.per_doc, per_sentence, code = (lists[c].to_numpy() for c in ("per_doc", "per_sentence", "codes"))
        n = max(len(self.terms), 1)
        self.first = np.cumsum(self.per_doc) - self.per_doc  # a document's first sentence
        doc_of = np.repeat(np.arange(len(self.keys)), self.per_doc)
        sentence = np.repeat(np.arange(len(per_sentence)), per_sentence)
        pair, back, tf = np.unique(doc_of[sentence] * n + code, return_inverse=True, return_counts=True)
        self.doc, self.term = pair // n, pair % n
        self.weight = tf * (idf.to_numpy() if idf is not None else np.zeros(n, np.int64))[self.term]
        in_sentence, one = np.unique(sentence * n + code, return_index=True)
        self.words, self.word_of = in_sentence % n, in_sentence // n
        self.starts = np.flatnonzero(np.r_[True, np.diff(self.word_of) > 0]) if len(in_sentence) else np.zeros(0, np.int64)
        self.sentence = self.word_of[self.starts]
        self.sizes = np.diff(np.r_[self.starts, len(in_sentence)])
        sums = np.add.reduceat(self.weight[back[one]], self.starts) if len(in_sentence) else np.zeros(0)
        self.score = np.trunc(sums / (self.sizes + 3)).astype(np.int64)
        self.sentence_doc = doc_of[self.sentence]
        self.place = self.sentence - self.first[self.sentence_doc]  # of a sentence in its document


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield Block(batch, at)


def scored(words: DataFrame, key: str) -> DataFrame:
    """(key, s, score) from weighed words: a sentence's score is the sum of tf * idf over its distinct words, divided by three more than them."""

    def task(batches):
        for b in blocks_of(batches):
            yield pa.RecordBatch.from_arrays([b.keys.take(pa.array(b.sentence_doc)), pa.array(b.place.astype(np.int32)), pa.array(b.score)], names=[key, "s", "score"])

    return words.mapInArrow(task, f"{key} {words.schema['keys'].dataType.elementType.simpleString()}, s int, score long")


def telling(key: str, sentences: int, alike: int, tags: int):
    """Tasks of weighed words that give (key, taken, tags) of each document with a word."""

    def task(batches):
        for b in blocks_of(batches):
            rank = np.empty(len(b.terms), np.int64)
            names = b.terms.to_pylist()
            rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
            order = np.lexsort((rank[b.term], -b.weight, b.doc))
            first_pair = np.searchsorted(b.doc, np.arange(len(b.keys) + 1))
            best = np.lexsort((b.place, -b.score, b.sentence_doc))
            first_best = np.searchsorted(b.sentence_doc, np.arange(len(b.keys) + 1))
            docs, taken_of, tags_of = [], [], []
            for d in np.flatnonzero(np.diff(first_pair)):
                taken: list[tuple[int, set]] = []
                for x in best[first_best[d] : first_best[d + 1]]:
                    mine = set(b.words[b.starts[x] : b.starts[x] + b.sizes[x]].tolist())
                    shared = [(len(mine & other), len(other)) for _, other in taken]
                    if not any(100 * both >= alike * (len(mine) + size - both) for both, size in shared):
                        taken.append((int(b.place[x]), mine))
                    if len(taken) >= sentences:
                        break
                docs.append(d)
                taken_of.append(sorted(place for place, _ in taken))
                tags_of.append([names[t] for t in b.term[order[first_pair[d] : min(first_pair[d] + tags, first_pair[d + 1])]]])
            columns = [b.keys.take(pa.array(docs, pa.int64())), pa.array(taken_of, pa.list_(pa.int32())), pa.array(tags_of, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "taken", "tags"])

    return task


def summaries(docs: DataFrame, key: str, text: Column, sentences: int = 3, alike: int = 50, tags: int = 5) -> DataFrame:
    """(key, summary, tags) of every row; keys tell rows apart.

    The sentences with the highest scores are taken, ties by place, unless they share ``alike`` per cent of their words or
    more with one taken before; they stand in the order of the text. tags are the words with the highest tf * idf. Words
    are counted in blocks of documents; texts are shuffled once, to the sentences taken. A text without words has an empty
    summary and no tags.
    """
    kind = docs.schema[key].dataType.simpleString()
    found = weighed_words(docs, key, text).mapInArrow(telling(key, sentences, alike, tags), f"{key} {kind}, taken array<int>, tags array<string>")
    none = F.array().cast("array<string>")
    rows = docs.select(key, text.alias("_text")).join(found, key, "left")
    # Bound to a name by a list of one, so that the text is cut once.
    pick = lambda all_of: F.transform(F.coalesce("taken", F.array().cast("array<int>")), lambda s: F.get(all_of, s))
    chosen = F.transform(F.array(sentences_of(F.col("_text"))), pick)[0]
    return rows.select(key, F.array_join(chosen, " ").alias("summary"), F.coalesce("tags", none).alias("tags"))
