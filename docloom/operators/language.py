"""Language detection by character trigrams counted in texts whose language is known."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.scratch import written

#: Languages of a model at most.
LANGUAGES = 1000
#: Texts, and letters, that are counted at a time; trigrams of a model that travels to all tasks at most.
TEXTS, LETTERS, HELD = 512, 1 << 21, 1 << 18


def letters_of(text: Column) -> Column:
    """The letters of a text, words parted by one space, with a space at both ends; null without a letter."""
    letters = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " "))
    return F.when(letters != "", F.concat(F.lit(" "), letters, F.lit(" ")))


def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, gram, n) of rows (key, letters), a row for each trigram of each key of some texts; a trigram is three code points of 21 bits."""
    for batch in batches:
        texts, a = batch.column(1).to_pylist(), 0
        while a < batch.num_rows:
            z, size = a + 1, len(texts[a])
            while z < min(batch.num_rows, a + TEXTS) and size + len(texts[z]) <= LETTERS:
                size, z = size + len(texts[z]), z + 1
            keys = batch.column(0).slice(a, z - a).dictionary_encode(null_encoding="encode")
            some, a = texts[a:z], z
            points = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)
            alphabet, letter = np.unique(points, return_inverse=True)
            row = np.repeat(np.arange(len(some)), [len(t) for t in some])
            inside = row[2:] == row[:-2]
            key, m = keys.indices.to_numpy()[row[:-2][inside]].astype(np.int64), len(alphabet)
            first, second, third = (letter[n : len(letter) - 2 + n][inside].astype(np.int64) for n in range(3))
            if m**3 * len(keys.dictionary) < 1 << 62:
                found, n = np.unique(((key * m + first) * m + second) * m + third, return_counts=True)
                found, third = np.divmod(found, m)
                found, second = np.divmod(found, m)
                key, first = np.divmod(found, m)
            else:  # an alphabet of very many signs
                found, n = np.unique(np.stack([key, first, second, third]), axis=1, return_counts=True)
                key, first, second, third = found
            point = alphabet.astype(np.int64)
            gram = (point[first] << 42) | (point[second] << 21) | point[third]
            yield pa.RecordBatch.from_arrays([keys.dictionary.take(pa.array(key)), pa.array(gram), pa.array(n.astype(np.int64))], names=[batch.schema.names[0], "gram", "n"])


def counts_of(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, gram, n), counted where the texts lie: a key's rows of a trigram are still to be added up."""
    rows = docs.select(key, letters_of(text).alias("letters")).where("letters is not null")
    return rows.mapInArrow(trigrams, f"`{key}` {docs.schema[key].dataType.simpleString()}, gram long, n long")


class LanguageModel:
    """How often each trigram stands in each language: a table (gram, counts by language), and a total a language.

    A trigram's score in a language is floor(1000 * ln((its count + 1) / (all of the language's + distinct trigrams))), whole
    numbers, so that sums don't depend on their order. Trigrams that the model hasn't seen count as 0 everywhere.
    """

    def __init__(self, table: DataFrame, totals: dict[str, int], distinct: int):
        self.table, self.totals, self.distinct = table, totals, distinct

    @staticmethod
    def fit(docs: DataFrame, lang: str, text: Column) -> LanguageModel:
        """Rows without a language are left out. The driver sees a number for each language."""
        seen = counts_of(docs.where(F.col(lang).isNotNull()), lang, text).groupBy(lang, "gram").agg(F.sum("n").alias("n"))
        seen = written(seen, "trigrams")
        totals = {r[0]: r[1] for r in seen.groupBy(lang).agg(F.sum("n")).orderBy(lang).limit(LANGUAGES + 1).collect()}
        if len(totals) > LANGUAGES:
            raise ValueError(f"more than {LANGUAGES} languages")
        names = sorted(totals)
        each = [F.coalesce(F.sum(F.when(F.col(lang) == name, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, name in enumerate(names)]
        rows = seen.groupBy("gram").agg(*(each or [F.count("*").alias("n0")]))
        table = written(rows.select("gram", F.array(*[F.col(f"n{i}") for i in range(len(names))]).cast("array<long>").alias("counts")), "model")
        return LanguageModel(table, totals, table.count())

    def detect(self, docs: DataFrame, key: str, text: Column) -> DataFrame:
        """(key, detected, score, margin) of every row; keys tell rows apart.

        detected is the language of the highest score, ties by name, "unknown" without a letter; score is that of all
        trigrams together, margin how far the next language stays behind. Each text's trigrams are counted where it lies.
        """
        names = sorted(self.totals)
        score = lambda count, name: F.floor(1000 * F.log((count + 1) / F.lit(float(self.totals[name] + self.distinct))))
        at = lambda i: F.coalesce(F.get("counts", F.lit(i)), F.lit(0)).cast("double")
        known = self.table.select("gram", *[score(at(i), name).alias(f"k{i}") for i, name in enumerate(names)])
        known = F.broadcast(known) if self.distinct <= HELD else known
        sums = [F.sum(F.col("n") * F.coalesce(f"k{i}", score(F.lit(0.0), name))).alias(f"s{i}") for i, name in enumerate(names)]
        found = counts_of(docs, key, text).join(known, "gram", "left").groupBy(key).agg(*(sums or [F.count("*").alias("s")]))
        ranked = F.sort_array(F.array(*[F.struct((-F.col(f"s{i}")).alias("s"), F.lit(name).alias("name")) for i, name in enumerate(names)])) if names else None
        if ranked is None:
            return docs.select(key, F.lit("unknown").alias("detected"), *[F.lit(None).cast("long").alias(c) for c in ("score", "margin")])
        best = found.select(key, ranked.alias("r")).select(
            key, F.get("r", F.lit(0))["name"].alias("detected"), (-F.get("r", F.lit(0))["s"]).alias("score"),
            (F.get("r", F.lit(1))["s"] - F.get("r", F.lit(0))["s"]).alias("margin"),
        )
        return docs.select(key).join(best, key, "left").withColumn("detected", F.coalesce("detected", F.lit("unknown")))
