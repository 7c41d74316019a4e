"""Corpus taxonomy: counts over categories, tags, countries, sources and languages, and their hierarchies."""

from __future__ import annotations

import re
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.gazetteer import OTHER, REGIONS, gazetteer
from docloom.operators.names import names_of, names_table
from docloom.operators.terms import LatentModel, counted
from docloom.scratch import written

#: Keywords of each group of tags.
TAG_GROUPS = {
    "legal_documents": ["zákon", "vyhláška", "nariadenie", "smernica"],
    "procedures": ["žiadosť", "pobyt", "víza", "proces"],
    "institutions": ["úrad", "ministerstvo", "polícia", "ambasáda"],
    "documents": ["doklad", "certifikát", "potvrdenie", "vyhlásenie"],
}


def names_in(text: Column, names: list[tuple[str, list[str]]] | None = None) -> Column:
    """Names with a variant standing in the text as whole words, whatever the case; each name once.

    The text is split into words once. A name's pattern is only searched for where the first word of one of its
    variants is among them.
    """
    names = gazetteer() if names is None else names
    whole = lambda words: rf"(?U)\b({'|'.join(map(re.escape, words))})\b"
    firsts = lambda words: sorted({re.match(r"\w+", w.lower())[0] for w in words})
    listed = lambda words: F.array(*map(F.lit, words))
    none = F.array().cast("array<string>")
    low = F.lower(F.coalesce(text, F.lit("")))

    def found(pair: Column) -> Column:
        each = [
            F.when(F.arrays_overlap(pair["hits"], listed(firsts(words))) & pair["low"].rlike(whole([w.lower() for w in words])), F.lit(name))
            for name, words in names
        ]
        return F.when(F.size(pair["hits"]) > 0, F.array_compact(F.array(*each))).otherwise(none)

    every = listed(firsts([w for _, words in names for w in words]))
    split = lambda t: F.struct(t.alias("low"), F.array_intersect(F.split(t, r"(?U)\W+"), every).alias("hits"))
    # Each step is bound to a name by a list of one, so that it is computed once.
    return F.transform(F.transform(F.array(low), split), found)[0]


def with_defaults(docs: DataFrame) -> DataFrame:
    """The columns that the taxonomy reads, with its defaults; rows without text and summary leave."""
    have = lambda c, kind: F.col(c) if c in docs.columns else F.lit(None).cast(kind)
    rows = docs.select(
        F.coalesce(have("text", "string"), F.lit("")).alias("text"),
        F.coalesce(have("summary", "string"), F.lit("")).alias("summary"),
        F.filter(F.coalesce(have("tags", "array<string>"), F.array().cast("array<string>")), lambda t: t != "").alias("tags"),
        F.coalesce(have("category", "string"), F.lit("Unknown")).alias("category"),
        F.coalesce(have("source", "string"), F.lit("Unknown")).alias("source"),
        F.coalesce(have("language", "string"), F.lit("unknown")).alias("language"),
    )
    return rows.where("not (text = '' and summary = '')")


#: Names of a list that are searched for one by one; more are made a table.
LISTED = 200

Names = list[tuple[str, list[str]]] | DataFrame | None


def text_of() -> Column:
    """What is searched for names."""
    return T.strip(F.concat_ws(" ", "text", "summary"))


def names_by_document(rows: DataFrame, names: Names, *keys: str) -> DataFrame:
    """Distinct (keys, name) of rows with the taxonomy's columns: a name for each document in which it stands."""
    if isinstance(names, DataFrame):
        return names_of(rows, names, text_of(), *keys)
    if names is not None and len(names) > LISTED:
        return names_of(rows, names_table(rows.sparkSession, names), text_of(), *keys)
    return rows.select(*keys, F.explode(names_in(text_of(), names)).alias("name"))


def counters(docs: DataFrame, names: Names = None) -> DataFrame:
    """(dimension, key, n) of all five counters.

    Tags count once for each occurrence, countries once for each document. With a short list of names, such as the
    countries, all comes from one scan and one shuffle; a table of names, of any length, is joined with the words.
    """
    rows = with_defaults(docs)
    if isinstance(names, DataFrame) or names is not None and len(names) > LISTED:
        each = names_by_document(rows.withColumn("_doc", F.monotonically_increasing_id()), names, "_doc")
        found = each.groupBy(F.lit("country").alias("dimension"), F.col("name").alias("key")).agg(F.count("*").alias("n"))
        return counters(docs, []).unionByName(found)
    item = lambda dim, key: F.struct(F.lit(dim).alias("dimension"), key.alias("key"))
    of = lambda dim, keys: F.transform(keys, lambda k: item(dim, k))
    one = F.array(item("category", F.col("category")), item("source", F.col("source")), item("language", F.col("language")))
    items = F.concat(one, of("tag", F.col("tags")), of("country", names_in(text_of(), names)))
    return rows.select(F.explode(items).alias("x")).groupBy("x.dimension", "x.key").agg(F.count("*").alias("n"))


def ranked(counts: DataFrame, dimension: str, limit: int | None = None) -> DataFrame:
    """(key, n) of one dimension, most frequent first, ties by key."""
    out = counts.where(F.col("dimension") == dimension).select("key", "n").orderBy(F.desc("n"), "key")
    return out.limit(limit) if limit is not None else out


def tag_bands(counts: DataFrame) -> DataFrame:
    band = F.when(F.col("n") >= 10, "high").when(F.col("n") >= 3, "medium").otherwise("low")
    return counts.where("dimension = 'tag'").select(band.alias("band"), "key", "n")


def regions() -> list[tuple[str, str]]:
    return [(name, region) for region, names in REGIONS.items() for name in names]


def region(name: str) -> Column:
    """The region of a country; the lookup is a literal map of fixed size."""
    lookup = F.create_map(*[F.lit(x) for pair in regions() for x in pair])
    return F.coalesce(F.element_at(lookup, F.col(name)), F.lit(OTHER))


def by_region(counts: DataFrame) -> DataFrame:
    """(region, country, n)."""
    return counts.where("dimension = 'country'").select(region("key").alias("region"), F.col("key").alias("country"), "n")


#: What a row of the roll-up sums, by the columns that it is grouped by.
LEVELS = {
    ("region", "country", "category"): "category of country", ("region", "country"): "country", ("region", "category"): "category of region",
    ("region",): "region", (): "total",
}


def region_rollup(docs: DataFrame, names: Names = None) -> DataFrame:
    """(level, region, country, category, n, n_documents): countries by region and category, with all subtotals.

    n sums the documents of each country, n_documents counts documents once, however many countries of a region they
    name. Regions that no document names are there with 0, and so is the total. One pass over the texts; the pairs of a
    document and a country, not the texts, are shuffled once by document, then summed by country before the subtotals.
    """
    rows = with_defaults(docs).withColumn("_doc", F.monotonically_increasing_id())
    named = names_by_document(rows, names, "_doc", "category").withColumn("region", region("name"))
    # The first row of a document in each region, and the first of all, stand for it once.
    order = lambda *by: F.row_number().over(Window.partitionBy("_doc", *by).orderBy("name"))
    marked = named.withColumns({"_once": (order("region") == 1).cast("long"), "_any": (F.row_number().over(Window.partitionBy("_doc").orderBy("region", "name")) == 1).cast("long")})
    pairs = marked.groupBy("region", F.col("name").alias("country"), "category").agg(
        F.count("*").alias("n"), F.sum("_once").alias("once"), F.sum("_any").alias("any")
    )
    every = rows.sparkSession.createDataFrame([(r,) for r in REGIONS], "region string").select(
        "region", *[F.lit(None).cast("string").alias(c) for c in ("country", "category")], *[F.lit(0).cast("long").alias(c) for c in ("n", "once", "any")]
    )
    sums = pairs.unionByName(every).groupingSets([[F.col(c) for c in level] for level in LEVELS], "region", "country", "category").agg(
        F.grouping_id().alias("_set"), F.sum("n").alias("n"), F.sum("once").alias("once"), F.sum("any").alias("any")
    )
    number = {level: sum(1 << (2 - i) for i, c in enumerate(("region", "country", "category")) if c not in level) for level in LEVELS}
    label = F.create_map(*[F.lit(x) for level, name in LEVELS.items() for x in (number[level], name)])
    once = F.when(F.col("_set") == number[()], F.col("any")).when(F.col("_set").isin(number[("region",)], number[("region", "category")]), F.col("once")).otherwise(F.col("n"))
    out = sums.select(F.element_at(label, F.col("_set").cast("int")).alias("level"), "region", "country", "category", "n", once.alias("n_documents"))
    # The rows that keep empty regions show at the levels of regions and above only.
    return out.where("n > 0 or level in ('region', 'total')")


def statistics(counts: DataFrame) -> DataFrame:
    of = lambda dim: F.count_if(F.col("dimension") == dim)
    tag = F.col("dimension") == "tag"
    return counts.agg(
        of("category").alias("total_categories"),
        of("tag").alias("total_tags"),
        of("country").alias("total_countries"),
        of("source").alias("total_sources"),
        F.count_if(tag & (F.col("n") == 1)).alias("unique_tags"),
        F.count_if(tag & (F.col("n") >= 5)).alias("common_tags"),
    )


def category_values(docs: DataFrame, what: str) -> DataFrame:
    """Distinct (category, value) pairs; what: tags or source."""
    rows = with_defaults(docs)
    value = F.explode("tags") if what == "tags" else F.col("source")
    return rows.select("category", value.alias("value")).distinct()


def source_edges(docs: DataFrame) -> DataFrame:
    """Distinct (parent, child) prefixes of the source paths."""
    rows = with_defaults(docs).select("source").distinct()
    return rows.select(F.explode(T.path_edges(F.col("source"))).alias("e")).select("e.parent", "e.child").distinct()


def tag_groups(counts: DataFrame, groups: dict[str, list[str]] = TAG_GROUPS, top: int = 100) -> DataFrame:
    """(group, tag): the top tags whose lower case holds a keyword of the group; a tag may be in several."""
    tags = ranked(counts, "tag", top)
    hits = []
    for group, keys in groups.items():
        any_key = F.lit(False)
        for key in keys:
            any_key = any_key | F.contains(F.lower("key"), F.lit(key))
        hits.append(F.when(any_key, F.lit(group)))
    return tags.select(F.explode(F.array_compact(F.array(*hits))).alias("group"), F.col("key").alias("tag"), "n")


def file_counts(docs: DataFrame) -> DataFrame:
    """total, corrupt, empty and valid rows; the original's processed count is the total."""
    bad = F.col("_corrupt").isNotNull() if "_corrupt" in docs.columns else F.lit(False)
    empty = (F.coalesce("text", F.lit("")) == "") & (F.coalesce("summary", F.lit("")) == "") & ~bad
    return docs.agg(
        F.count("*").alias("total"),
        F.count_if(bad).alias("corrupt"),
        F.count_if(empty).alias("empty"),
        F.count_if(~bad & ~empty).alias("valid"),
    )


def lists_of(pairs: DataFrame, key: str, value: str, most: int) -> tuple[dict[str, list], bool]:
    """The first values of each key, for the first keys, most of each, and whether there were more.

    Values are ranked where they lie before any meet.
    """
    order = Window.partitionBy(key).orderBy(value)
    some = pairs.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most + 1)
    rows = some.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias("v")).orderBy(key).limit(most + 1).collect()
    return {r[0]: r.v[:most] for r in rows[:most]}, len(rows) > most or any(len(r.v) > most for r in rows)


def taxonomy_document(docs: DataFrame, names: Names = None, most: int = 10_000, counts: DataFrame | None = None) -> dict:
    """The whole taxonomy as nested dicts, a report: of each list the first most entries.

    What may be longer is there as tables: counters(), category_values(), source_edges(), tag_tree(). bounded tells whether
    any list of the report was cut. counts: counters() of the same documents, if they are there already.
    """
    counts = written(counters(docs, names), "counts") if counts is None else counts
    top = lambda dim, n=most: {r.key: r.n for r in ranked(counts, dim, n).collect()}
    bands: dict[str, dict] = {"high": {}, "medium": {}, "low": {}}
    for r in tag_bands(counts).orderBy(F.desc("n"), "key").limit(most).collect():
        bands[r.band][r.key] = r.n
    places: dict[str, dict] = {region: {} for region in REGIONS}
    for r in by_region(counts).orderBy(F.desc("n"), "country").limit(most).collect():
        places[r.region][r.country] = r.n
    (tags, cut_tags), (sources, cut_sources) = (lists_of(category_values(docs, what), "category", "value", most) for what in ("tags", "source"))
    tree, cut_tree = lists_of(source_edges(docs), "parent", "child", most)
    categories = top("category")
    files = file_counts(docs if "summary" in docs.columns else docs.withColumn("summary", F.lit(""))).first()
    stats = statistics(counts).first().asDict()
    longest = counts.groupBy("dimension").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    return {
        "metadata": {
            "total_documents": files.total, "empty_documents": files.empty, "generated_at": datetime.now(UTC).isoformat(),
            "bounded": longest > most or cut_tags or cut_sources or cut_tree,
        },
        "categories": {
            "overview": categories,
            "detailed": {c: {"count": n, "tags": tags.get(c, []), "sources": sources.get(c, [])} for c, n in categories.items()},
        },
        "tags": {"overview": top("tag", 100), "by_frequency": bands},
        "countries": {"overview": top("country"), "by_region": places},
        "sources": {"overview": top("source"), "hierarchy": tree},
        "languages": top("language"),
        "statistics": stats,
    }


def rag_document(taxonomy: dict) -> dict:
    """The part of a taxonomy that retrieval prompts use."""
    tags = list(taxonomy["tags"]["overview"])
    return {
        "categories": list(taxonomy["categories"]["overview"]),
        "top_tags": tags[:50],
        "countries": list(taxonomy["countries"]["overview"]),
        "tag_hierarchy": {g: [t for t in tags if any(k in t.lower() for k in keys)] for g, keys in TAG_GROUPS.items()},
        "country_groups": taxonomy["countries"]["by_region"],
    }


def tag_clusters(docs: DataFrame, k: int, key: str, tags_col: str = "tags", dims: int = 16, seed: int = 1) -> DataFrame:
    """(key, cluster): k-means over the directions of the documents' tf-idf vectors; documents without a telling tag have none.

    Vectors have ``dims`` components at most, however many tags there are, so neither the driver nor a task holds a
    vocabulary; the driver holds k centres.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    counts = written(counted(docs, key, F.col(tags_col)), "tags")
    points = LatentModel.fit(counts, key, dims, min_df=1, seed=seed).embed(counts, key)
    rows = written(points.select(key, array_to_vector("vector").alias("features")), "features")
    fitted = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)
    return docs.select(key).join(fitted.transform(rows).select(key, "cluster"), key, "left")
