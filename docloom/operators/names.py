"""Names from a table found in texts: word n-grams joined with the names by equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of the table that tells which words may begin a name. More names only mean more words that the join turns down.
BITS = 1 << 20
#: Unicode's words and what lies between them.
RUNS = r"(?U)\w+|\W+"


def names_table(spark: SparkSession, names: list[tuple[str, list[str]]]) -> DataFrame:
    """(name, variant) of a list in the form of the gazetteer."""
    rows = [(name, variant) for name, variants in names for variant in variants]
    return spark.createDataFrame(rows, "name string, variant string")


def runs(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(RUNS), F.lit(0))


def is_word(run: Column) -> Column:
    return run.rlike(r"(?U)^\w")


def trimmed(names: DataFrame) -> DataFrame:
    """(name, gram, words, first) of names (name, variant): lower case, from the first word to the last."""
    inner = F.regexp_replace(F.lower("variant"), r"(?U)^\W+|\W+$", "")
    rows = names.select("name", inner.alias("gram")).where("gram <> ''").distinct()
    return rows.select("name", "gram", ((F.size(runs(F.col("gram"))) + 1) / 2).cast("int").alias("words"), runs(F.col("gram"))[0].alias("first"))


def place_of(word: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(bits))


def beginnings(grams: DataFrame, bits: int = BITS) -> Column:
    """Bits of the first words of names as an array of longs, the value of a scalar subquery: its size is fixed."""
    place = place_of(F.col("first"), bits)
    each = grams.select(place.alias("p")).distinct().select(F.expr("p div 64").alias("i"), F.expr("shiftleft(1L, CAST(p % 64 AS INT))").alias("b"))
    some = each.groupBy("i").agg(F.bit_or("b").alias("b"))
    every = grams.sparkSession.range(bits // 64).withColumnRenamed("id", "i").join(some, "i", "left")
    table = every.agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("t"))
    return table.select(F.col("t.b").alias("bits")).scalar()


def mentions(docs: DataFrame, names: DataFrame, text: Column, *keys: str, longest: bool = False, bits: int = BITS) -> DataFrame:
    """(keys, name, gram, start, words) for every place where a name's variant stands in the text as whole words.

    names: (name, variant), any number of them; case doesn't matter, white space and punctuation inside a variant do. A text
    is cut into words and what lies between; n-grams of the lengths in use that begin with a word that begins a name are
    joined with the names by equality, so the plan doesn't grow with the list and the join goes the way that sizes ask
    for. With longest, a mention inside a longer one is left out; keys must then tell documents apart.
    """
    grams = trimmed(names)
    most = grams.agg(F.max("words")).first()[0] or 1  # a number
    # Each step is bound to a name by a list of one, so that it is computed once.
    bound = lambda r: F.struct(r.alias("r"), F.when(is_word(r[0]), 1).otherwise(2).alias("at"))
    count = lambda b: F.floor((F.size(b["r"]) - b["at"]) / 2).cast("int")
    ahead = lambda b, i: F.struct(i.alias("start"), F.slice(b["r"], b["at"] + 2 * i, F.lit(2 * most - 1)).alias("runs"))
    spans = lambda b: F.transform(F.sequence(F.lit(0), count(b)), lambda i: ahead(b, i))
    some = F.filter(F.array(runs(text)), lambda r: (F.size(r) > 1) | is_word(F.get(r, F.lit(0))))
    each = docs.select(*keys, F.explode(F.flatten(F.transform(F.transform(some, bound), spans))).alias("a"))
    place = place_of(F.col("a.runs")[0], bits)
    long = F.get(beginnings(grams, bits), F.floor(place / 64).cast("int"))
    each = each.where(F.getbit(long, F.pmod(place, F.lit(64)).cast("int")) == 1)
    lengths = F.sequence(F.lit(1), F.floor((F.size("a.runs") + 1) / 2).cast("int"))
    grown = each.select(*keys, "a", F.explode(lengths).alias("words"))
    spoken = grown.select(*keys, "a.start", "words", F.array_join(F.slice("a.runs", F.lit(1), 2 * F.col("words") - 1), "").alias("gram"))
    found = spoken.join(grams.select("name", "gram"), "gram").select(*keys, "name", "gram", "start", "words")
    if not longest:
        return found
    before = Window.partitionBy(*keys).orderBy("start", F.desc("words")).rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("words")
    # Equal places are one place: several names may share a variant.
    spots = found.select(*keys, "start", "words").distinct().withColumn("_end", F.max(end).over(before))
    kept = spots.where(F.col("_end").isNull() | (F.col("_end") < end)).drop("_end")
    return found.join(kept, [*keys, "start", "words"]).select(*keys, "name", "gram", "start", "words")


def names_of(docs: DataFrame, names: DataFrame, text: Column, *keys: str, longest: bool = False) -> DataFrame:
    """Distinct (keys, name): the names that stand in each document."""
    return mentions(docs, names, text, *keys, longest=longest).select(*keys, "name").distinct()
