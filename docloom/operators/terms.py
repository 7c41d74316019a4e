"""Terms of documents: counts, dense ids, tf-idf, and their main directions by a randomised decomposition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.scratch import drop_table, small_batches, written

#: Directions beside those asked for, which make the first ones exact; 64 signs at most come from one hash.
EXTRA, WIDEST = 8, 64
#: Documents of a task that makes blocks, if there are as many as cores; after so many terms of documents a block is full; words
#: that are counted and terms that are multiplied at a time, but those of one document are never cut.
DOCUMENTS, TERMS, WORDS, PAIRS = 1 << 15, 1 << 22, 1 << 21, 1 << 17
#: Terms of documents in a row of a table, and its documents at most, whose numbers are 16 bits wide.
ROW, MANY = 1 << 19, (1 << 15) - 1
#: Bytes of the vectors that a task holds of a part of the terms, and terms whose vectors stand in a row.
SLAB, SOME = 1 << 27, 1 << 12
#: Rows of a table are so large that few make a row group. A group is what a reader decodes at once, and a writer looks at its
#: size after each row instead of after a hundred.
LARGE_ROWS = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\W+"), lambda w: w != "")


def counted(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    """(key, term, tf) of an array of terms in each row; null and empty terms are none."""
    each = docs.select(key, F.explode(terms).alias("term")).where("term <> ''")
    return each.groupBy(key, "term").agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, documents: int, min_df: int = 1, n: Column | None = None) -> DataFrame:
    """(term, term_id, df, idf): ids are dense and follow the order of the terms; idf = ln((documents + 1) / (df + 1)).

    A row of counts is a document with that term, or n of them.

    Terms are sorted over all partitions and numbered where they lie: the driver sees the size of each partition, never
    a term.
    """
    spark = counts.sparkSession
    found = counts.groupBy("term").agg((F.count("*") if n is None else F.sum(n)).alias("df")).where(F.col("df") >= min_df)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = found.repartitionByRange(parts, "term").sortWithinPartitions("term")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = written(ordered.select("*", F.spark_partition_id().alias("part"), place.alias("place")), "terms")
    sizes = placed.groupBy("part").count()
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    idf = F.log((F.lit(float(documents)) + 1) / (F.col("df") + 1))
    return placed.join(before, "part").select("term", (F.col("before") + F.col("place")).alias("term_id"), "df", idf.alias("idf"))


def tf_idf(docs: DataFrame, key: str, terms: Column) -> tuple[DataFrame, DataFrame]:
    """((key, term_id, tf, weight), vocabulary): weight = tf * idf, a row for each term of a document."""
    counts = written(counted(docs, key, terms), "counts")
    words = vocabulary(counts, docs.count())
    return counts.join(words, "term").select(key, "term_id", "tf", (F.col("tf") * F.col("idf")).alias("weight")), words


def signs(ids: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A row of +1 and -1 for each term, from its id alone."""
    x = ids.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    out = np.empty((len(x), width))
    for n in range(width):
        out[:, n] = (x >> np.uint64(n)) & np.uint64(1)
    out *= 2
    out -= 1
    return out


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, terms, how often each or null) as blocks: a term is a number in the block's list of terms.

    A block has the keys of its documents that have a term, how many terms each has, all their numbers and counts, and for
    each term in how many of the block's documents it stands.
    """
    from pyspark import TaskContext

    block, some, held = TaskContext.get().partitionId() << 33, [], 0
    for batch in batches:
        before, a = batch.column(1).offsets.to_numpy(), 0
        while a < batch.num_rows:
            z = max(int(np.searchsorted(before, before[a] + WORDS, side="right")) - 1, a + 1)
            if before[z] > before[a]:
                some.append(tallied(batch.slice(a, z - a)))
                held += len(some[-1][2])
            if held >= TERMS:
                yield from block_of(block, some)
                block, some, held = block + 1, [], 0
            a = z
    if some:
        yield from block_of(block, some)


def tallied(rows: pa.RecordBatch) -> tuple:
    """(keys, terms of each document, their numbers, counts, list of terms) of rows (key, terms, how often each or null)."""
    coded = rows.column(1).flatten().dictionary_encode()
    n = len(coded.dictionary)
    doc = np.repeat(np.arange(rows.num_rows), np.diff(rows.column(1).offsets.to_numpy()))
    pair, back = np.unique(doc * n + coded.indices.to_numpy(), return_inverse=True)
    times = rows.column(2).flatten()
    tf = np.bincount(back, times.to_numpy() if len(times) else None).astype(np.int32)
    sizes = np.bincount(pair // n, minlength=rows.num_rows)
    full = np.flatnonzero(sizes)
    return rows.column(0).take(pa.array(full)), sizes[full].astype(np.int32), (pair % n).astype(np.int32), tf, coded.dictionary


def block_of(block: int, some: list[tuple]) -> Iterator[pa.RecordBatch]:
    """A block in rows of about ROW terms of documents; its list of terms stands in the first."""
    keys, sizes, codes, tf, terms = zip(*some)
    coded = pa.concat_arrays(terms).dictionary_encode()
    new, at = coded.indices.to_numpy(), np.cumsum([0, *map(len, terms)])
    code = np.concatenate([new[a + c] for a, c in zip(at, codes)])
    df = np.bincount(code, minlength=len(coded.dictionary)).astype(np.int32)
    keys, sizes, tf, terms, df = pa.concat_arrays(keys), np.concatenate(sizes), np.concatenate(tf), coded.dictionary, pa.array(df)
    for docs, mine, _ in pieces(sizes, ROW):
        lists = [keys.slice(docs.start, docs.stop - docs.start), *map(pa.array, (sizes[docs], code[mine], tf[mine])), terms, df]
        yield row_of(lists, ["keys", "sizes", "codes", "tf", "terms", "df"], block)
        terms, df = terms[:0], df[:0]


def row_of(lists: list[pa.Array], names: list[str], block: int | None = None) -> pa.RecordBatch:
    boxed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
    return pa.RecordBatch.from_arrays(boxed if block is None else [pa.array([block], pa.int64()), *boxed], names=names if block is None else ["block", *names])


def bags(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    """Blocks of documents with the counts of their terms, made where the documents lie; see packed(). Rows of equal keys are one document."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, F.coalesce(F.filter(terms, lambda t: t != ""), F.array().cast("array<string>")).alias("t"))
    if docs.groupBy(key).count().where("count > 1").limit(1).count():
        rows = rows.groupBy(key).agg(F.flatten(F.collect_list("t")).alias("t"))
    # As few tasks as give large blocks: the fewer blocks, the fewer times a term is sent on.
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-docs.count() // DOCUMENTS))
    return blocks_made(rows.coalesce(tasks).select(key, "t", F.array().cast("array<long>").alias("n")), kind)


def bags_of_counts(counts: DataFrame, key: str) -> DataFrame:
    """The blocks of (key, term, tf)."""
    each = counts.groupBy(key).agg(F.collect_list(F.struct("term", F.col("tf").cast("long").alias("tf"))).alias("t"))
    return blocks_made(each.select(key, "t.term", "t.tf"), counts.schema[key].dataType.simpleString())


def blocks_made(rows: DataFrame, kind: str) -> DataFrame:
    shape = f"block long, keys array<{kind}>, sizes array<int>, codes array<int>, tf array<int>, terms array<string>, df array<int>"
    with small_batches(rows.sparkSession):
        return written(rows.mapInArrow(packed, shape), "bags", LARGE_ROWS)


def terms_of(blocks: DataFrame) -> DataFrame:
    """(block, place, term, n) of each block's list of terms."""
    return blocks.select("block", F.posexplode(F.arrays_zip("terms", "df")).alias("place", "x")).select("block", "place", F.col("x.terms").alias("term"), F.col("x.df").alias("n"))


def with_terms(blocks: DataFrame, known: DataFrame, of, shape: str) -> DataFrame:
    """What ``of`` makes of each block and of its rows (block, place, ...) of known, whose terms are all that is left of it."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(of(Bag(left, right), right)), schema=like)

    like = to_arrow_schema(StructType.fromDDL(shape))
    left = blocks.select(F.col("block").alias("of"), "keys", "sizes", "codes", "tf").groupBy("of")
    return left.cogroup(known.groupBy("block")).applyInArrow(task, shape)


class Bag:
    """A block's documents: the places of their terms in right, and how often each stands there."""

    def __init__(self, left: pa.Table, right: pa.Table):
        keys, sizes, code, tf = (left.column(c).combine_chunks().flatten() for c in ("keys", "sizes", "codes", "tf"))
        self.keys, sizes, code, tf = keys, *(x.to_numpy() for x in (sizes, code, tf))
        new = np.full(int(code.max()) + 1, -1, np.int32)
        new[right.column("place").to_numpy()] = np.arange(right.num_rows)
        code = new[code]
        kept = code >= 0
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
        full = np.flatnonzero(sizes)  # documents with a term that is known
        self.keys, self.sizes, self.code = self.keys.take(pa.array(full)), sizes[full], code[kept]
        self.tf = tf[kept]


def pieces(sizes: np.ndarray, most: int = PAIRS, many: int | None = None) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """(documents, their terms, start of each) of about ``most`` terms at a time, and of ``many`` documents at most."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        first = ends[a] - sizes[a]
        z = max(int(np.searchsorted(ends, first + most, side="right")), a + 1)
        z = z if many is None else min(z, a + many)
        yield slice(a, z), slice(first, ends[z - 1]), ends[a:z] - sizes[a:z] - first
        a = z


def products(sizes: np.ndarray, code: np.ndarray, weights: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Each document's sum of weight * row of the table over its terms."""
    out = np.empty((len(sizes), table.shape[1]))
    for docs, terms, starts in pieces(sizes):
        out[docs] = np.add.reduceat(table[code[terms]] * weights[terms, None], starts, axis=0)
    return out


def located(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """(block, row, keys, sizes, codes, tf, ids, idf) of blocks of documents: their terms that are among words, by ids that rise in each row.

    A document stands in one row, and every row has at most MANY of them; those with no such term are left out.
    """

    def known_only(bag, right):
        ids, idf = (right.column(c).to_numpy() for c in ("term_id", "idf"))
        order = np.argsort(ids)
        code = np.empty(len(ids), np.int32)
        code[order] = np.arange(len(ids))
        code, ids, idf = code[bag.code], ids[order], idf[order]
        for row, (docs, mine, _) in enumerate(pieces(bag.sizes, ROW, MANY)):
            used, new = np.unique(code[mine], return_inverse=True)
            lists = [bag.sizes[docs].astype(np.int32), new.astype(np.int32), bag.tf[mine], ids[used], idf[used]]
            keys = bag.keys.slice(docs.start, docs.stop - docs.start)
            found = row_of([keys, *map(pa.array, lists)], ["keys", "sizes", "codes", "tf", "ids", "idf"], right.column("block")[0].as_py())
            yield found.add_column(1, "row", pa.array([row], pa.int32()))

    known = terms_of(blocks).join(words, "term").select("block", "place", "term_id", "idf")
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    shape = f"block long, row int, keys array<{kind}>, sizes array<int>, codes array<int>, tf array<int>, ids array<long>, idf array<double>"
    return with_terms(blocks, known, known_only, shape)


def lists_in(batch: pa.RecordBatch, at: int, *names: str) -> tuple[np.ndarray, ...]:
    return tuple(batch.column(c)[at].values.to_numpy() for c in names)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(terms of each document, their places, weights, ids of all terms) of each row; no document is empty, each has length one."""
    for at in range(batch.num_rows):
        sizes, code, tf, ids, idf = lists_in(batch, at, "sizes", "codes", "tf", "ids", "idf")
        w = (1 + np.log(tf)) * idf[code]
        w /= np.repeat(lengths(sizes, w), sizes)
        yield sizes, code, w, ids


def lengths(sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.sqrt(np.add.reduceat(weights * weights, np.cumsum(sizes) - sizes))


def cut(sizes: np.ndarray, code: np.ndarray, tf: np.ndarray, ids: np.ndarray, parts: int) -> Iterator[tuple]:
    """(part, places of its terms in it, documents of each, their numbers, how often each) of a row's terms, for each part."""
    part = ids % parts
    order = np.argsort(part, kind="stable")  # ids rise in a part
    new = np.empty(len(ids), np.int32)
    new[order] = np.arange(len(ids))
    code = new[code]
    pairs = np.argsort(code, kind="stable")
    n = np.bincount(code, minlength=len(ids))
    doc, tf = np.repeat(np.arange(len(sizes), dtype=np.int16), sizes)[pairs], tf[pairs]
    terms, ends = np.searchsorted(part[order], np.arange(parts + 1)), np.r_[0, np.cumsum(n)]
    places = (ids[order] // parts).astype(np.int32)
    for p, (a, z) in enumerate(zip(terms[:-1], terms[1:])):
        mine = slice(ends[a], ends[z])
        yield p, places[a:z], n[a:z].astype(np.int32), doc[mine], tf[mine]


def flat(rows: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(rows).ravel())


def projected(sizes: np.ndarray, code: np.ndarray, weights: np.ndarray, ids: np.ndarray, width: int, seed: int) -> np.ndarray:
    return products(sizes, code, weights, signs(ids, width, seed))


def gram(rows: DataFrame, width: int, of) -> np.ndarray:
    """Sum of x' x over the matrices that ``of`` makes of each batch: each task sums its own, width^2 numbers meet."""

    def task(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for x in of(batch):
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["g"])

    each = rows.mapInArrow(task, "g array<double>").select(F.posexplode("g").alias("at", "x"))
    out = np.zeros(width * width)
    for r in each.groupBy("at").agg(F.sum("x").alias("x")).collect():
        out[r.at] = r.x
    return out.reshape(width, width)


def whitening(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions scaled by 1 / root of their weight, roots), of those that carry any, heaviest first."""
    values, vectors = np.linalg.eigh(g)
    keep = np.flatnonzero(values > max(values.max(initial=0), 0) * 1e-10)[::-1]
    roots = np.sqrt(values[keep])
    return vectors[:, keep] / roots, roots


class LatentModel:
    """Directions of a documents x terms matrix in which it varies most.

    Terms are dealt to parts by their ids; slabs are (part, start, idf, v), the vectors of some neighbouring terms of a part, which
    ``final`` turns into directions.
    """

    def __init__(self, blocks: DataFrame, rows: DataFrame, words: DataFrame, slabs: DataFrame, parts: int, size: int, final: np.ndarray):
        self.blocks, self.rows, self.words, self.slabs = blocks, rows, words, slabs
        self.parts, self.size, self.final, self.dims = parts, size, final, final.shape[1]

    @staticmethod
    def fit(counts: DataFrame, key: str, dims: int = 32, min_df: int = 2, seed: int = 1) -> LatentModel:
        """From (key, term, tf). Weights are (1 + ln tf) * idf, each document's of length one.

        See fit_bags().
        """
        return LatentModel.fit_bags(bags_of_counts(counts, key), dims, min_df, seed, spent=True)

    @staticmethod
    def fit_bags(blocks: DataFrame, dims: int = 32, min_df: int = 2, seed: int = 1, spent: bool = False) -> LatentModel:
        """From blocks of documents, see bags().

        A randomised decomposition: documents are projected on random signs of their terms, the projections made
        orthonormal by their Gram matrix, terms projected back on them, and the small matrix that remains decomposed.
        Terms are dealt to parts, as many as there are cores or as make SLAB bytes of vectors each. Shuffled are the blocks, the
        terms of documents, and each document's projection once for every part; no vector of a term is. The driver sees matrices
        of (dims + EXTRA)^2 numbers. Terms in fewer than min_df documents are left out. With spent, the table of blocks is deleted
        when the model has what embed_bags() of these very blocks needs; nothing else can read them then.
        """
        spark, width = blocks.sparkSession, min(dims + EXTRA, WIDEST)
        documents = blocks.agg(F.sum(F.size("keys"))).first()[0] or 0
        words = written(vocabulary(terms_of(blocks), documents, min_df, F.col("n")), "vocabulary")
        n = words.count()
        parts = max(1, min(n, max(spark.sparkContext.defaultParallelism, -(-n * width * 8 // SLAB))))
        size, words = -(-n // parts), words.where("idf > 0").select("term", "term_id", "idf")
        with small_batches(spark):
            rows = written(located(blocks, words), "matrix", LARGE_ROWS)
            if spent:
                drop_table(blocks)
            turn, _ = whitening(gram(rows, width, lambda batch: (projected(*x, width, seed) for x in rows_of(batch))))
        k = turn.shape[1]

        def tiles(batches):
            for batch in batches:
                for at, x in enumerate(rows_of(batch)):
                    sizes, code, tf, ids, idf = lists_in(batch, at, "sizes", "codes", "tf", "ids", "idf")
                    q = flat(projected(*x, width, seed) @ turn / lengths(sizes, (1 + np.log(tf)) * idf[code])[:, None])
                    for part, *lists in cut(sizes, code, tf, ids, parts):
                        if len(lists[0]):
                            found = row_of([q, *map(pa.array, lists)], ["q", "places", "n", "docs", "tf"])
                            yield found.add_column(0, "part", pa.array([part], pa.int32()))

        def back(batches):
            sums = {}  # of one part, if each has a task of its own
            for batch in batches:
                for at, part in enumerate(batch.column("part").to_pylist()):
                    if part not in sums:
                        sums[part] = np.zeros(size, np.int64), np.zeros((size, k))
                    df, v = sums[part]
                    q, places, n, docs, tf = lists_in(batch, at, "q", "places", "n", "docs", "tf")
                    q, f = q.reshape(-1, k), 1 + np.log(tf)
                    df[places] += n
                    for terms, mine, starts in pieces(n):
                        v[places[terms]] += np.add.reduceat(q[docs[mine]] * f[mine, None], starts, axis=0)
            for part, (df, v) in sums.items():
                for a in range(0, size, SOME):
                    idf = np.log((documents + 1) / (df[a : a + SOME] + 1))
                    found = row_of([pa.array(idf), flat(v[a : a + SOME] * idf[:, None])], ["idf", "v"])
                    yield found.add_column(0, "start", pa.array([a], pa.int32())).add_column(0, "part", pa.array([part], pa.int32()))

        with small_batches(spark):
            dealt = rows.mapInArrow(tiles, "part int, q array<double>, places array<int>, n array<int>, docs array<short>, tf array<int>")
            sums = dealt.repartitionById(parts, "part").mapInArrow(back, "part int, start int, idf array<double>, v array<double>")
            slabs = written(sums, "directions", LARGE_ROWS)
            final, _ = whitening(gram(slabs, k, lambda batch: (x.values.to_numpy().reshape(-1, k) for x in batch.column("v"))))
        return LatentModel(blocks, rows, words, slabs, parts, size, final[:, :dims])

    def embed(self, counts: DataFrame, key: str) -> DataFrame:
        """(key, vector of length one) of (key, term, tf); documents with none of the model's terms, or only those in all, have none."""
        return self.embed_bags(bags_of_counts(counts, key), key)

    def embed_bags(self, blocks: DataFrame, key: str) -> DataFrame:
        """embed() of blocks of documents, see bags().

        What is shuffled are the terms of documents and the model, by parts of the terms, then each document's sum over the terms of
        each part; these are added up in the order of the parts, so documents with the same terms get the same vector.
        """
        spark, kind = blocks.sparkSession, blocks.schema["keys"].dataType.elementType.simpleString()
        if not self.dims:  # fitted on nothing
            return blocks.where(F.lit(False)).select(F.col("keys")[0].alias(key), F.array().cast("array<double>").alias("vector"))
        parts, size, final, dims = self.parts, self.size, self.final, self.dims
        rows = self.rows if blocks is self.blocks else located(blocks, self.words)

        def tiles(batches):
            for batch in batches:
                for at in range(batch.num_rows):
                    keys, which = batch.column("keys")[at].values, [batch.column(c).slice(at, 1) for c in ("block", "row")]
                    sizes, code, tf, ids = lists_in(batch, at, "sizes", "codes", "tf", "ids")
                    for part, *lists in cut(sizes, code, tf, ids, parts):
                        if not part or len(lists[0]):  # keys go with the first part
                            found = row_of([keys[: 0 if part else None], *map(pa.array, lists)], ["keys", "places", "n", "docs", "tf"])
                            first = [pa.array([part], pa.int32()), *which, pa.array([len(keys)], pa.int32())]
                            yield pa.RecordBatch.from_arrays([*first, *found.columns], names=["part", "block", "row", "many", *found.schema.names])

        def products_of(batches):
            last, table = None, None
            for batch in batches:
                for at, (part, side) in enumerate(zip(batch.column("part").to_pylist(), batch.column("side").to_pylist())):
                    if part != last:
                        last, table = part, np.zeros((size, dims))
                    if not side:
                        (idf, v), a = lists_in(batch, at, "idf", "v"), batch.column("start")[at].as_py()
                        table[a : a + len(idf)] = v.reshape(len(idf), -1) @ final * idf[:, None]
                        continue
                    places, n, docs, tf = lists_in(batch, at, "places", "n", "docs", "tf")
                    out = np.zeros((batch.column("many")[at].as_py(), dims))
                    order = np.argsort(docs, kind="stable")
                    each = np.bincount(docs, minlength=len(out))
                    some = np.flatnonzero(each)
                    out[some] = products(each[some], np.repeat(np.arange(len(n)), n)[order], (1 + np.log(tf))[order], table[places])
                    found = row_of([batch.column("keys")[at].values, flat(out)], ["keys", "x"])
                    first = [batch.column(c).slice(at, 1) for c in ("block", "row", "part")]
                    yield pa.RecordBatch.from_arrays([*first, *found.columns], names=["block", "row", "part", "keys", "x"])

        def added(batches):
            last, keys, x = None, None, None
            for batch in batches:
                for at, now in enumerate(zip(batch.column("block").to_pylist(), batch.column("row").to_pylist())):
                    more = batch.column("x")[at].values.to_numpy()
                    if now == last:
                        x += more
                        continue
                    if last is not None:
                        yield unit(keys, x.reshape(-1, dims))
                    last, keys, x = now, pa.concat_arrays([batch.column("keys")[at].values]), more.copy()
            if last is not None:
                yield unit(keys, x.reshape(-1, dims))

        def unit(keys, x):
            size = np.sqrt((x * x).sum(axis=1))
            some = np.flatnonzero(size > 0)
            lists = vectors(np.zeros(len(some), np.int64), x[some] / size[some, None]).column(1)
            return pa.RecordBatch.from_arrays([keys.take(pa.array(some)), lists], names=[key, "vector"])

        ints = "places array<int>, n array<int>, docs array<short>, tf array<int>"
        dealt = rows.mapInArrow(tiles, f"part int, block long, row int, many int, keys array<{kind}>, {ints}")
        both = dealt.withColumn("side", F.lit(1)).unionByName(self.slabs.withColumn("side", F.lit(0)), allowMissingColumns=True)
        met = both.repartitionById(parts, "part").sortWithinPartitions("part", "side")
        sums = met.mapInArrow(products_of, f"block long, row int, part int, keys array<{kind}>, x array<double>")
        whole = sums.repartition("block", "row").sortWithinPartitions("block", "row", "part")
        with small_batches(spark):
            return written(whole.mapInArrow(added, f"{key} {kind}, vector array<double>"), "vectors")


def vectors(ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * rows.shape[1])
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))], names=["term_id", "v"])


def tag_tree(docs: DataFrame, key: str, tags: Column, percent: int = 80) -> DataFrame:
    """(child, parent, n_child, n_parent, n_both): each tag below the tag that subsumes it most closely; roots have no parent.

    A tag subsumes another if it stands in at least ``percent`` per cent of its documents and in more documents, or as many
    and comes first by name: an order, so there are no cycles. Of several the one in fewest documents is the parent, then
    the one it shares most documents with, then the first by name. Pairs are made within documents only, of a tag and
    those more frequent, so a document with t tags gives at most t * (t - 1) / 2.
    """
    each = written(counted(docs, key, tags).select(key, "term"), "tags")
    df = written(each.groupBy("term").agg(F.count("*").alias("n")), "frequencies")
    rows = each.join(df, "term")
    low = rows.select(key, F.col("term").alias("child"), F.col("n").alias("n_child"))
    high = rows.select(key, F.col("term").alias("parent"), F.col("n").alias("n_parent"))
    above = (F.col("n_parent") > F.col("n_child")) | ((F.col("n_parent") == F.col("n_child")) & (F.col("parent") < F.col("child")))
    both = low.join(high, key).where(above).groupBy("child", "parent", "n_child", "n_parent").agg(F.count("*").alias("n_both"))
    fit = both.where(100 * F.col("n_both") >= percent * F.col("n_child"))
    nearest = fit.groupBy("child").agg(F.min(F.struct("n_parent", (-F.col("n_both")).alias("m"), "parent")).alias("p"))
    return df.join(nearest, F.col("term") == F.col("child"), "left").select(
        F.col("term").alias("child"), "p.parent", F.col("n").alias("n_child"), "p.n_parent", (-F.col("p.m")).alias("n_both")
    )


def tree_paths(edges: DataFrame, most: int = 64) -> DataFrame:
    """(tag, path, depth): every tag with its ancestors, root first. A level a round; a tree is as deep as its longest chain."""
    level = written(edges.where("parent is null").select(F.col("child").alias("tag"), F.array("child").alias("path")), "level")
    found = level
    for _ in range(most):
        below = edges.join(level.select(F.col("tag").alias("parent"), "path"), "parent").select(F.col("child").alias("tag"), F.concat("path", F.array("child")).alias("path"))
        level = written(below, "level")
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found.select("tag", "path", F.size("path").alias("depth"))
