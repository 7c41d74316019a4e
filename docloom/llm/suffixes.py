"""Exact removal of repeated passages: groups of equal windows, refined by passes, in place of a radix sort of suffixes.

Only the first ``depth`` bytes of a suffix count, so suffixes need not be ordered: passes split them into groups by hashes of
ever more of their bytes, groups of one leave, and what is equal at full depth is exactly the repeated windows. No
suffix is ordered by digits. Passes:

1. Every window of ``depth`` bytes holds an anchor: the k-byte string of least hash in it, leftmost
   among equals. The choice depends on the window's bytes alone, so equal windows have equal anchors at
   equal places. Windows that follow each other mostly share one; suffixes are grouped by anchor, a row
   for each run of windows. Anchors that occur once leave.
2. Runs with the same anchor are grouped by all bytes they cover. If every run of an anchor is equal,
   the runs after the first are repeats as a whole.
3. Where an anchor has different runs, each is cut into blocks of windows at fixed distances from the
   anchor, and blocks are grouped by the bytes that all their windows share, then by all they cover.
4. Only where blocks differ there are their windows compared one by one, at full depth.

Each task first does all this for its own rows, and sends on one row for each digit, so a passage that
stands in a third of all documents costs a row a task and not a row a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.shared import drop_table, materialise, released, with_uid
from docloom.llm.words import U, eights, hash_spans, mix

#: Bytes hashed at a time, and bytes of text whose runs a task compares before it sends rows on.
BLOCK = 1 << 18
GROUP = 32 << 20
LOW = U((1 << 21) - 1)

#: Windows of a block of pass 3.
STEP = 8
LONE, MARK, SPAN, NEED = 1, 2, 3, 4
RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
#: place packs the first window's start (from bit 24), the number of windows after it (9 bits), the anchor's
#: distance from it (9 bits) and the kind (3 bits); run is the end of a span, else a hash of the bytes covered.
ROWS = "key long, run long, uid long, place long"


class Rolling:
    """Hash of every substring of one length of a block: sums of byte values times powers of an odd base.

    It only names anchors. Whether what stands around two anchors is equal is told by other hashes.
    """

    def __init__(self, seed: int, most: int):
        rng = np.random.default_rng(seed)
        base = int(rng.integers(1 << 62, 1 << 63)) | 1
        self.values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
        self.up = self.powers(base, most)
        self.down = self.powers(pow(base, -1, 1 << 64), most)

    @staticmethod
    def powers(base: int, most: int) -> np.ndarray:
        p = np.full(most, base, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)

    def of(self, data: np.ndarray, k: int) -> np.ndarray:
        s = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=s[1:])
        n = len(data) - k + 1
        return mix((s[k:] - s[:n]) * self.down[:n])


class Runs:
    """Finds the runs of windows with one anchor in a block of pieces."""

    def __init__(self, depth: int, k: int):
        self.depth, self.k = depth, k
        self.rolling = Rolling(1, BLOCK + 2 * depth + 2)

    def of(self, pieces: list[bytes]) -> tuple[np.ndarray, ...]:
        """(piece, lo, hi, anchor's distance from lo, its hash, hash of the bytes covered) of each run of
        windows that start at lo to hi."""
        depth, k, wide = self.depth, self.k, self.depth - self.k + 1
        joined = b"".join(pieces)
        lens = np.array([len(p) for p in pieces])
        ends = np.cumsum(lens)
        keys = self.rolling.of(np.frombuffer(joined, np.uint8), k)
        least = (keys & ~LOW) | np.arange(len(keys), dtype=np.uint64)  # the place breaks ties, leftmost first
        step = 1
        while 2 * step <= wide:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < wide:
            least = np.minimum(least[: len(least) - (wide - step)], least[wide - step :])
        at = np.arange(len(least))
        start = np.flatnonzero(np.repeat(ends, lens)[: len(least)] - at >= depth)
        if not len(start):
            e = np.zeros(0, np.int64)
            return e, e, e, e, e.astype(np.uint64), e.astype(np.uint64)
        anchor = (least[start] & LOW).astype(np.int64)
        cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(start) != 1)) + 1
        lo, hi = start[np.r_[0, cut]], start[np.r_[cut - 1, len(start) - 1]]
        anchor = anchor[np.r_[0, cut]]
        run = hash_spans(eights(joined), lo, hi + depth - lo, 7) ^ mix((anchor - lo).astype(np.uint64) * U(0x9E3779B97F4A7C15) + U(1))
        piece = np.searchsorted(ends, lo, side="right")
        first = (ends - lens)[piece]
        return piece, lo - first, hi - first, anchor - lo, keys[anchor], mix(run)


def merged(uid: np.ndarray, lo: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of each uid joined; any order, spans of one length or nested rarely."""
    if not len(uid):
        return uid, lo, end
    o = np.lexsort((lo, uid))
    uid, lo, end = uid[o], lo[o], end[o]
    new = np.ones(len(uid), bool)
    new[1:] = (uid[1:] != uid[:-1]) | (lo[1:] > end[:-1])
    st = np.flatnonzero(new)
    return uid[st], lo[st], np.maximum.reduceat(end, st)


def out_batch(kind: int, key, run, uid, lo, count=0, at=0) -> pa.RecordBatch:
    n = len(uid)
    long = lambda x: np.full(n, x, np.int64) if np.isscalar(x) else x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)
    place = (long(lo) << 24) | (long(count) << 12) | (long(at) << 3) | kind
    return pa.RecordBatch.from_arrays([pa.array(long(x)) for x in (key, run, uid, place)], names=["key", "run", "uid", "place"])


def batches_of(n: int, most: int = 50_000):
    return [slice(a, min(n, a + most)) for a in range(0, n, most)]


def compared(uid, lo, hi, at, key, run, depth: int):
    """Rows of a task's runs: repeats become spans at once, what may have more equals is sent on.

    All by document and place; a key with one run is sent as it is, one with several as a mark and its runs
    as needs. Rows that only pass through get keys of their own, spread by document and place.
    """
    spread = lambda u, a: mix(u.astype(np.uint64) * U(0x9E3779B97F4A7C15) + a.astype(np.uint64))
    o = np.lexsort((run, key))  # stable: documents and places stay in order
    uid, lo, hi, at, key, run = uid[o], lo[o], hi[o], at[o], key[o], run[o]
    again = np.zeros(len(uid), bool)
    again[1:] = (key[1:] == key[:-1]) & (run[1:] == run[:-1])
    spans = merged(uid[again], lo[again], hi[again] + depth)
    uid, lo, hi, at, key, run = (x[~again] for x in (uid, lo, hi, at, key, run))
    heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    count = np.diff(np.r_[heads, len(key)])
    several = np.repeat(count > 1, count)
    marks = key[heads[count > 1]]
    for part in batches_of(len(spans[0])):
        u, a, b = (x[part] for x in spans)
        yield out_batch(SPAN, spread(u, a), b, u, a)
    for part in batches_of(len(marks)):
        yield out_batch(MARK, marks[part], 0, np.zeros(len(marks[part]), np.int64), 0)
    for which, kind in ((~several, LONE), (several, NEED)):
        u, a, b, d, q, r = (x[which] for x in (uid, lo, hi, at, key, run))
        if kind == NEED:
            q, r = spread(u, a), np.zeros(len(u), np.int64)
        for part in batches_of(len(u)):
            yield out_batch(kind, q[part], r[part], u[part], a[part], (b - a)[part], d[part])


def grouped_runs(depth: int, k: int):
    """Passes 1 and 2 within a task."""

    def compare(runs: Runs, docs: list[tuple[int, bytes]]):
        docs.sort(key=lambda d: d[0])
        found, pieces, owner, base, size = [], [], [], [], 0

        def hash_block():
            nonlocal pieces, owner, base, size
            if sum(map(len, pieces)) >= depth:
                piece, lo, hi, at, key, run = runs.of(pieces)
                shift = np.array(base)[piece]
                lo, hi = (lo + shift).astype(np.int32), (hi + shift).astype(np.int32)
                found.append((np.array(owner)[piece], lo, hi, at.astype(np.int32), key, run))
            pieces, owner, base, size = [], [], [], 0

        for uid, data in docs:
            for a in range(0, max(1, len(data) - depth + 1), BLOCK):
                part = data[a : a + BLOCK + depth - 1]
                if len(part) < depth:
                    continue
                if size and size + len(part) > BLOCK + depth:
                    hash_block()
                pieces.append(part)
                owner.append(uid)
                base.append(a)
                size += len(part)
        hash_block()
        docs.clear()  # from here on only the runs are needed
        if found:
            columns = [np.concatenate(x) for x in zip(*found)]
            found.clear()
            rows = compared(*columns, depth)
            del columns
            yield from rows

    def task(batches):
        runs, docs, size = Runs(depth, k), [], 0
        for batch in batches:
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer().to_pybytes()
                docs.append((uid, data))
                size += len(data)
                if size >= GROUP:
                    yield from compare(runs, docs)
                    docs, size = [], 0
        yield from compare(runs, docs)

    return task


def block_rows(depth: int):
    """Pass 3 within a task: blocks of the runs asked for. A block's windows start STEP * n to
    STEP * n + STEP - 1 bytes before the anchor; those of its run that exist are compared."""

    def compare(rows: list, keys: list, runs: list):
        if rows:
            uid, lo, hi = np.array(rows, np.int64).T
            key, run = (np.frombuffer(b"".join(x), np.uint64) for x in (keys, runs))
            o = np.lexsort((lo, uid))
            yield from compared(uid[o], lo[o], hi[o], np.zeros(len(o), np.int64), key[o], run[o], depth)

    def task(batches):
        rows, keys, runs = [], [], []
        for batch in batches:
            for uid, text, needs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_buffer().to_pybytes()
                v = needs.values
                for lo, hi, at in zip(v.field("lo").to_pylist(), v.field("hi").to_pylist(), v.field("at").to_pylist()):
                    anchor = lo + at
                    for n in range((anchor - hi) // STEP, at // STEP + 1):
                        near = anchor - STEP * n
                        first, last = max(lo, near - STEP + 1), min(hi, near)
                        # What all windows of a whole block share, and where it stands to the anchor.
                        keys.append(xxhash.xxh3_64_digest(data[near : near - STEP + 1 + depth], n))
                        runs.append(xxhash.xxh3_64_digest(data[first : last + depth], (near - first) * STEP + last - first))
                        rows.append((uid, first, last))
                if len(rows) >= 500_000:
                    yield from compare(rows, keys, runs)
                    rows, keys, runs = [], [], []
        yield from compare(rows, keys, runs)

    return task


def window_rows(depth: int):
    """Pass 4 within a task: windows of the blocks asked for, by a 128-bit hash of their bytes."""

    def compare(uid: list, at: list, digests: list):
        if not uid:
            return
        u, p = np.array(uid, np.int64), np.array(at, np.int64)
        w = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        o = np.lexsort((p, u, w[:, 1], w[:, 0]))
        u, p, w = u[o], p[o], w[o]
        again = np.zeros(len(u), bool)
        again[1:] = (w[1:] == w[:-1]).all(axis=1)
        spans = merged(u[again], p[again], p[again] + depth)
        for part in batches_of(len(spans[0])):
            a, b, c = (x[part] for x in spans)
            yield out_batch(SPAN, mix(a.astype(np.uint64) + b.astype(np.uint64)), c, a, b)
        u, p, w = u[~again], p[~again], w[~again]
        for part in batches_of(len(u)):
            yield out_batch(LONE, np.ascontiguousarray(w[part, 0]), np.ascontiguousarray(w[part, 1]), u[part], p[part])

    def task(batches):
        uid, at, digests = [], [], []
        for batch in batches:
            for u, text, needs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_buffer().to_pybytes()
                lows, highs = needs.values.field("lo").to_pylist(), needs.values.field("hi").to_pylist()
                for lo, hi in zip(lows, highs):
                    for p in range(lo, hi + 1):
                        digests.append(xxhash.xxh3_128_digest(data[p : p + depth]))
                    at.extend(range(lo, hi + 1))
                    uid.extend([u] * (hi + 1 - lo))
                if len(uid) >= 1_000_000:
                    yield from compare(uid, at, digests)
                    uid, at, digests = [], [], []
        yield from compare(uid, at, digests)

    return task


def cut_spans(carry: bool):
    """Spans of each document joined, and its bytes without them; with carry also as text, and the row."""

    def task(batches):
        for batch in batches:
            n_bytes, n_removed, all_spans, left = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                data = text.as_buffer().to_pybytes()
                runs: list[list[int]] = []
                if spans.is_valid:
                    v = spans.values
                    for lo, end in sorted(zip(v.field("lo").to_pylist(), v.field("hi").to_pylist())):
                        if runs and lo <= runs[-1][1]:
                            runs[-1][1] = max(end, runs[-1][1])
                        else:
                            runs.append([lo, end])
                kept, at = [], 0
                for lo, end in runs:
                    kept.append(data[at:lo])
                    at = end
                kept.append(data[at:])
                n_bytes.append(len(data))
                n_removed.append(sum(b - a for a, b in runs))
                all_spans.append([{"start": a, "end": b} for a, b in runs])
                left.append(b"".join(kept))
            columns = {
                "doc_id": batch.column(0),
                "n_bytes": pa.array(n_bytes, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "spans": pa.array(all_spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(left, pa.binary()),
            }
            if carry:
                columns["text"] = pa.array([x.decode("utf-8", "ignore") for x in left], pa.string())
                columns["row"] = batch.column(3)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return task


def unpacked(rows: DataFrame) -> DataFrame:
    """uid, key, run and kind, lo, count, at from place."""
    bits = lambda shift, n: F.shiftright("place", shift).bitwiseAND((1 << n) - 1).cast("int")
    return rows.select(
        "key", "run", "uid", bits(0, 3).alias("kind"), bits(3, 9).alias("at"), bits(12, 9).alias("count"),
        F.shiftright("place", 24).cast("int").alias("lo"),
    )


def told_apart(rows: DataFrame, depth: int) -> DataFrame:
    """Across tasks: (verdict, uid, lo, hi, at). Spans pass, needs pass; of a key with one run only, all but
    the first are spans; the runs of a key with several become needs. hi: a span's end, else the last window."""
    rows = unpacked(rows)
    alike = Window.partitionBy("key", F.col("kind") >= SPAN)
    lone, first = F.col("kind") == LONE, F.struct("uid", "lo")
    told = rows.select(
        "*",
        F.min(F.when(lone, F.col("run"))).over(alike).alias("least"),
        F.max(F.when(lone, F.col("run"))).over(alike).alias("most"),
        F.max("kind").over(alike).alias("top"),
        F.min(F.when(lone, first)).over(alike).alias("head"),
    )
    differ = (F.col("least") != F.col("most")) | (F.col("top") == MARK)
    verdict = (
        F.when(F.col("kind") >= SPAN, F.col("kind"))
        .when(lone & differ, F.lit(NEED))
        .when(lone & (first != F.col("head")), F.lit(SPAN))
    )
    last = F.col("lo") + F.col("count")
    hi = F.when(F.col("kind") == SPAN, F.col("run").cast("int")).when(lone & ~differ, last + depth).otherwise(last)
    return told.select(verdict.alias("verdict"), "uid", "lo", hi.alias("hi"), "at").where("verdict is not null")


def asked(found: DataFrame) -> DataFrame:
    needs = F.collect_list(F.struct("lo", "hi", "at")).alias("needs")
    return found.where(F.col("verdict") == NEED).groupBy("uid").agg(needs)


def remove_repeats(
    docs: DataFrame,
    *,
    depth: int = 100,
    anchor: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """Remove each byte covered by a depth-byte string that also starts earlier.

    Earlier: in a document with a smaller id, or before in the same document. Overlaps count, matches
    never cross documents, strings are judged on the input and not on what is left.

    Columns: doc_id, n_bytes, n_removed, spans (array of start, end: maximal removed runs), kept
    (binary: the remaining UTF-8 bytes), with carry text (kept without cut
    characters) and row, a struct of the other input columns. See the module for the method. Strings are told apart by
    128 bits of hash (of the anchor and of all bytes covered, or xxh3 of the window).

    Null texts count as empty and texts under depth bytes lose nothing. Null ids come before all
    others; rows that share an id are documents of their own in an order that a hash of their texts fixes. An empty
    table gives no rows. Other columns are not read.
    """
    if not 1 < anchor < depth - STEP or depth > 500:
        raise ValueError("anchor must lie between 1 and depth - STEP, depth is at most 500")
    rows = with_uid(docs, id_col, text_col, carry).where("uid is not null")
    kept = ["row"] if carry else []
    local = rows.select("uid", "text").mapInArrow(released(grouped_runs(depth, anchor)), ROWS)
    runs = materialise(told_apart(local, depth), "runs")
    of_runs = rows.select("uid", "text").join(asked(runs), "uid").select("uid", "text", "needs")
    blocks = materialise(told_apart(of_runs.mapInArrow(released(block_rows(depth)), ROWS), depth), "blocks")
    of_blocks = rows.select("uid", "text").join(asked(blocks), "uid").select("uid", "text", "needs")
    windows = unpacked(of_blocks.mapInArrow(released(window_rows(depth)), ROWS))
    equal = Window.partitionBy("key", "run", F.col("kind") == SPAN)
    first = F.struct("uid", "lo")
    repeats = windows.select("kind", "run", "uid", "lo", F.min(first).over(equal).alias("head")).select(
        "uid",
        "lo",
        F.when(F.col("kind") == SPAN, F.col("run").cast("int"))
        .when(first != F.col("head"), F.col("lo") + depth)
        .alias("hi"),
    )
    spans = (
        runs.unionByName(blocks)
        .where(F.col("verdict") == SPAN)
        .select("uid", "lo", "hi")
        .unionByName(repeats.where("hi is not null"))
        .groupBy("uid")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    )
    spans = materialise(spans, "spans")
    drop_table(runs)
    drop_table(blocks)
    schema = RESULT + (", text string, row " + rows.schema["row"].dataType.simpleString() if carry else "")
    return rows.join(spans, "uid", "left").select("doc_id", "text", "spans", *kept).mapInArrow(released(cut_spans(carry)), schema)
