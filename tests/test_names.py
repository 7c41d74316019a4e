"""Names found in texts by joining n-grams, against regular expressions."""

import random
import re

from pyspark.sql import functions as F

from docloom.functions.gazetteer import gazetteer
from docloom.operators import names as N
from docloom.operators import taxonomy as X

LIST = [("york", ["York"]), ("new york", ["New York", "NYC"]), ("city", ["New York City"]), ("us", ["u.s. of a", "usa"]), ("odd", ["(zürich)"]), ("ll", ["a_b", "x-y z"])]
WORDS = ["new", "york", "York", "city", "City", "nyc", "u.s. of a", "usa", "USA", "a_b", "a b", "x-y z", "x-y", "zürich", "Zürichs", "yorks", "the"]


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def by_regex(text, names):
    inner = lambda v: re.sub(r"^\W+|\W+$", "", v.lower())
    return {name for name, words in names for w in words if re.search(rf"\b{re.escape(inner(w))}\b", (text or "").lower())}


def test_names_against_regular_expressions(spark):
    rnd = random.Random(3)
    texts = [rnd.choice(["", " ", "-"]) + rnd.choice([" ", ", ", "\n", "  "]).join(rnd.choices(WORDS, k=rnd.randint(0, 12))) for _ in range(300)] + [None, "", "!?"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    table = N.names_table(spark, LIST)
    want = {(i, n) for i, t in enumerate(texts) for n in by_regex(t, LIST)}
    assert {tuple(r) for r in N.names_of(docs, table, F.col("text"), "id").collect()} == want
    # A table of bits in which everything is set only leaves more to the join.
    assert {tuple(r) for r in N.mentions(docs, table, F.col("text"), "id", bits=64).select("id", "name").distinct().collect()} == want


def test_longest_mentions(spark):
    docs = spark.createDataFrame([(1, "New York City, new york and York."), (2, "York New York")], "id long, text string")
    got = N.mentions(docs, N.names_table(spark, LIST), F.col("text"), "id", longest=True)
    assert sorted((r.id, r.start, r.name) for r in got.collect()) == [(1, 0, "city"), (1, 3, "new york"), (1, 6, "york"), (2, 0, "york"), (2, 1, "new york")]
    every = N.mentions(docs, N.names_table(spark, LIST), F.col("text"), "id")
    assert every.count() == 9
    none = N.mentions(docs, N.names_table(spark, LIST).limit(0), F.col("text"), "id")
    assert none.count() == 0 and N.mentions(docs.limit(0), N.names_table(spark, LIST), F.col("text"), "id").count() == 0


def test_the_plan_does_not_grow_with_the_names(spark):
    docs = spark.createDataFrame([(1, "name 7 and 99999 of them, Slovenská republika")], "id long, text string")
    table = lambda n: spark.range(n).select(F.concat(F.lit("n"), "id").alias("name"), F.concat(F.lit("name "), "id").alias("variant"))
    few, all_of = (N.names_of(docs, table(n), F.col("text"), "id") for n in (10, 100_000))
    assert abs(len(plan(all_of)) - len(plan(few))) < 100
    assert [r.name for r in all_of.collect()] == ["n7"]


def test_counts_of_a_list_and_of_a_table_are_equal(spark):
    texts = ["Slovakia a Česko", "ČESKÁ REPUBLIKA, ukulele", "", None, "poland poland"]
    docs = spark.createDataFrame([(t, "c", "s") for t in texts], "text string, category string, summary string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    listed, joined = X.counters(docs), X.counters(docs, N.names_table(spark, gazetteer()))
    assert rows(listed) == rows(joined) and ("country", "česko", 2) in rows(joined)
    many = gazetteer() + [(f"n{i}", [f"name {i}"]) for i in range(300)]
    assert rows(X.counters(docs, many)) == rows(listed)
    assert rows(X.region_rollup(docs)) == rows(X.region_rollup(docs, many))
    levels = {(r.level, r.region): (r.n, r.n_documents) for r in X.region_rollup(docs).where("category is null and country is null").collect()}
    assert levels == {
        ("total", None): (4, 3), ("region", "európska_únia"): (4, 3), ("region", "európa_mimo_eú"): (0, 0),
        ("region", "severná_amerika"): (0, 0), ("region", "ázia"): (0, 0), ("region", "ostatné"): (0, 0),
    }
