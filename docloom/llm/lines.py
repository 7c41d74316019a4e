"""Near-duplicate lines by an exact set-similarity join."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import drop_table, materialise, released, small_batches, with_uid
from docloom.llm.words import SPREAD, U, blocks, new_seed, stir, word_hashes

#: Counters for token frequency, at least and at most, so many bytes of the table's files for each; a byte each once they are summed.
#: CHUNK of them travel in a row. Up to DENSE are held by a task while it counts, else only those that it meets.
LEAST, MOST, BYTES, CHUNK, DENSE = 1 << 20, 1 << 26, 320, 1 << 16, 1 << 22
#: Bytes of text whose tokens are sorted at a time; pairs of records that are compared at a time.
PART, PAIRS_AT_ONCE = 1 << 20, 1 << 18
#: Tokens from which a line has a wide signature of WORDS words of 64 bits beside that of four.
WIDE, WORDS = 160, 16
RECORDS, GONE, OPEN = 0, 1, 2
BLOBS = "bucket long, kind int, data binary"
FOUND = "uid long, line int, other long, other_line int, apart int, more boolean"
#: The arrays of a blob of records; after them stand the wide signatures of those of WIDE tokens or more.
FIELDS = [("token", "<u4"), ("s0", "<u8"), ("s1", "<u8"), ("s2", "<u8"), ("s3", "<u8"), ("low", "<u4"), ("high", "<u4"),
          ("other", "<u8"), ("uid", "<i8"), ("line", "<u4"), ("size", "<u4"), ("place", "<u4")]
LINES = [("uid", "<i8"), ("line", "<u4")]


@dataclass(frozen=True)
class Tuning:
    """What decides time and memory, never results."""

    #: Bytes of text whose lines a task compares before it sends records on, and whose records make a bucket.
    group: int = 16 << 20
    #: A token seen more often than this, and than CROWD times what a counter holds on average, makes no group of its
    #: own: groups are of it and one more token.
    hot: int = 1 << 12
    #: If both are seen more often than this, the group's records are dealt to blocks that are compared two by two.
    split: int = 1 << 20
    #: In a group of more than large records each is first compared with the earliest leaders.
    large: int = 2048
    leaders: int = 16
    #: Candidates kept for a record of a group: the earliest where some are so near that they will hold, else the nearest.
    best: int = 2
    most: int = 16


def passed(marks: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many of marks each start has behind it or at its place; both ascend, and marks are few."""
    return np.repeat(np.arange(len(marks) + 1), np.diff(np.r_[0, np.searchsorted(start, marks), len(start)]))


def tokens_of(texts: list[bytes], seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, line in it, hash) of every word."""
    docs, lines, words = [], [], []
    begun: dict[int, int] = {}  # newlines in the earlier pieces of a long text
    for first, pieces in blocks(texts):
        data = b"\n".join(pieces)
        ends = np.cumsum([len(p) + 1 for p in pieces])
        start, h = word_hashes(data, seed)
        breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        piece = passed(ends, start)
        before = np.searchsorted(breaks, np.r_[0, ends[:-1]])[piece]
        line = passed(breaks, start) - before
        held = begun.get(first, 0)
        docs.append((piece + first).astype(np.int32))
        lines.append((line + np.where(piece == 0, held, 0)).astype(np.int32))
        words.append(h)
        begun[first] = held + pieces[0].count(b"\n")
    if not docs:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint64)
    if len(docs) == 1:
        return docs[0], lines[0], words[0]
    return np.concatenate(docs), np.concatenate(lines), np.concatenate(words)


def texts_by_size(batches, most: int):
    """Lists of (uid, text as bytes) of about most bytes."""
    rows, size = [], 0
    for batch in batches:
        for uid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_buffer().to_pybytes()
            if rows and size + len(data) > most:
                yield rows
                rows, size = [], 0
            rows.append((uid, data))
            size += len(data)
    if rows:
        yield rows


#: So many times the average of all counters a token must be seen to be told from those that share its counter.
CROWD = 16


def counters_for(size: int) -> int:
    """How many counters a table of so many bytes gets: a power of two."""
    return min(MOST, max(LEAST, 1 << max(0, size // BYTES).bit_length()))


def bytes_of(docs: DataFrame) -> int:
    """About how many bytes a table has, those of the files it is read from. It only sizes the counters; 0 without files."""
    spark, total = docs.sparkSession, 0
    for file in docs.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return total


def tallied(cells, counters: int, size=lambda: 0):
    """Rows (chunk, cells of it that were met, their counts, bytes of text) of arrays of cells; the text counts with the first."""
    total, some = np.zeros(counters if counters <= DENSE else 0, np.int64), []
    for x in cells:
        if counters <= DENSE:
            np.add.at(total, x, 1)
            continue
        some.append(np.unique(x, return_counts=True))
        if len(some) == 8:
            some = [merged(some)]
    if counters <= DENSE:
        cell = np.flatnonzero(total)
        count = total[cell]
    else:
        cell, count = merged(some) if some else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    cuts = np.searchsorted(cell, np.arange(0, counters + CHUNK, CHUNK))
    for nth, k in enumerate(np.flatnonzero(np.diff(cuts))):
        s = slice(cuts[k], cuts[k + 1])
        data = np.minimum(count[s], 0xFFFFFFFF).astype("<u4").tobytes()
        columns = [pa.array([k], pa.int32()), pa.array([(cell[s] % CHUNK).astype("<u2").tobytes()], pa.binary()), pa.array([data], pa.binary()), pa.array([0 if nth else size()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "cells", "counts", "size"])


def merged(some: list) -> tuple[np.ndarray, np.ndarray]:
    cell, back = np.unique(np.concatenate([c for c, _ in some]), return_inverse=True)
    total = np.zeros(len(cell), np.int64)
    np.add.at(total, back, np.concatenate([n for _, n in some]))
    return cell, total


def count_tokens(counters: int, seed: int):
    def task(batches):
        size = 0

        def cells():
            nonlocal size
            for rows in texts_by_size(batches, PART):
                size += sum(len(t) for _, t in rows)
                for _, pieces in blocks([t for _, t in rows]):
                    yield (word_hashes(b"\n".join(pieces), seed)[1] & U(counters - 1)).astype(np.int64)

        yield from tallied(cells(), counters, lambda: size)

    return task


def sum_chunks(batches):
    """Rows (chunk, ranks of its counters, their sum): a rank is eight times the logarithm, in a byte."""
    total: dict[int, np.ndarray] = {}
    sizes: dict[int, int] = {}
    for b in batches:
        for k, cells, counts, size in zip(*(b.column(c).to_pylist() for c in range(4))):
            sizes[k] = sizes.get(k, 0) + size
            mine = total.setdefault(k, np.zeros(CHUNK, np.int64))
            mine[np.frombuffer(cells, "<u2")] += np.frombuffer(counts, "<u4")
    for k, mine in total.items():
        ranks = np.minimum(np.ceil(8 * np.log2(np.maximum(mine, 1))), 255).astype(np.uint8)
        # A counter that was met once has rank 0 as one that wasn't: bits of those met stand beside the ranks.
        columns = [pa.array([k], pa.int32()), pa.array([ranks.tobytes()], pa.binary()), pa.array([np.packbits(mine > 0, bitorder="little").tobytes()], pa.binary()), pa.array([int(mine.sum())], pa.int64()), pa.array([sizes[k]], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "ranks", "met", "total", "size"])


@dataclass(frozen=True)
class Tallies:
    """Ranks of all counters, a bit for each that was met, and the sum of all: MOST bytes and MOST bits at most.

    seed is that of the hashes by which tokens have their counters, size the bytes of text.
    """

    ranks: np.ndarray
    met: np.ndarray
    total: int
    seed: int
    size: int = 0

    def rank(self, word: np.ndarray) -> np.ndarray:
        return self.ranks[(word & U(len(self.ranks) - 1)).astype(np.int64)]

    def has(self, word: np.ndarray) -> np.ndarray:
        cell = (word & U(len(self.ranks) - 1)).astype(np.int64)
        return (self.met[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)

    def seen(self, word: np.ndarray) -> np.ndarray:
        """How often a token was seen, with those that share its counter: up to a ninth more."""
        return np.exp2(self.rank(word) / 8.0)

    def split(self, tuning: Tuning) -> float:
        """The count from which a pair of hot tokens is dealt to blocks: no less than what one token's group may have."""
        return max(tuning.split, self.hot(tuning))

    def hot(self, tuning: Tuning) -> float:
        """The count from which a token is hot: well above what tokens that share a counter have together."""
        return max(tuning.hot, CROWD * self.total / len(self.ranks))


def counted(rows: DataFrame, count, counters: int, seed: int) -> Tallies:
    """All counters of rows that tasks count."""
    ranks, met, total, size = np.zeros(counters, np.uint8), np.zeros(counters // 8, np.uint8), 0, 0
    chunks = rows.mapInArrow(released(count), "chunk int, cells binary, counts binary, size long")
    chunks = chunks.repartition("chunk").mapInArrow(sum_chunks, "chunk int, ranks binary, met binary, total long, size long")
    for r in chunks.collect():  # a byte and a bit for each counter
        ranks[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(bytes(r.ranks), np.uint8)
        met[r.chunk * CHUNK // 8 : (r.chunk + 1) * CHUNK // 8] = np.frombuffer(bytes(r.met), np.uint8)
        total += r.total
        size += r.size
    return Tallies(ranks, met, total, seed, size)


def by_rarity(texts: list[bytes], tallies: Tallies):
    """(text, line, token) without repeats, each line's tokens from rare to frequent, ties by hash."""
    doc, line, word = tokens_of(texts, tallies.seed)
    if not len(doc):
        return doc, line, word
    nth = np.cumsum(np.r_[0, (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])]).astype(np.uint64)
    rank = tallies.rank(word).astype(np.uint64)
    # Sorted as one number of 64 bits: line, rank, as many bits of the hash as there is room for, place.
    places, room = len(word).bit_length(), 56 - int(nth[-1]).bit_length() - len(word).bit_length()
    o = None
    if room > 8:
        key = (((nth << U(8)) | rank) << U(room) | (word >> U(64 - room))) << U(places)
        key |= np.arange(len(word), dtype=np.uint64)
        key.sort()
        o = (key & U((1 << places) - 1)).astype(np.int64)
        key >>= U(places)
        w = word[o]
        if ((key[1:] == key[:-1]) & (w[1:] != w[:-1])).any():
            o = None  # these bits of hash don't tell two words of a line apart
    if o is None:
        w = word[np.lexsort((word, rank, nth))]
    word = w  # lines stay in their order
    new = np.r_[True, (nth[1:] != nth[:-1]) | (word[1:] != word[:-1])]
    return doc[new], line[new], word[new]


def packed(columns: dict[str, np.ndarray], fields, wide: np.ndarray | None = None) -> bytes:
    """Arrays as one compressed string; uids as steps."""
    parts = [np.array([len(columns["uid"])], "<i8").tobytes()]
    for name, kind in fields:
        x = columns[name]
        parts.append((np.diff(x, prepend=0) if name == "uid" else x).astype(kind, copy=False).tobytes())
    if wide is not None:
        parts.append(wide.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(blobs: list[bytes], fields) -> dict[str, np.ndarray]:
    """The arrays of several blobs, which are taken from the list; "wide" holds the wide signatures in the order of their records."""
    out: dict[str, list[np.ndarray]] = {name: [] for name, _ in fields}
    wide = []
    unpack = zstandard.ZstdDecompressor()
    blobs.reverse()
    while blobs:
        data, at = unpack.decompress(blobs.pop()), 8
        n = int(np.frombuffer(data, "<i8", 1)[0])
        for name, kind in fields:
            x = np.frombuffer(data, kind, n, at)
            out[name].append(np.cumsum(x) if name == "uid" else x.copy())
            at += x.nbytes
        wide.append(np.frombuffer(data, "<u8", -1, at).copy() if at < len(data) else np.zeros(0, "<u8"))
    # One array after the other, so that all of them aren't held twice.
    found = {name: np.concatenate(x) if (x := out.pop(name)) else np.zeros(0, kind) for name, kind in fields}
    return found | {"wide": np.concatenate(wide).reshape(-1, WORDS) if wide else np.zeros((0, WORDS), "<u8")}


def blob_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    bucket, kind, data = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int64()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], names=["bucket", "kind", "data"]
    )


class Lines:
    """Distinct lines of a group: heads of their tokens, sizes, hashes and signatures."""

    def __init__(self, doc: np.ndarray, line: np.ndarray, word: np.ndarray):
        self.word = word
        self.head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])])
        self.size = np.diff(np.r_[self.head, len(doc)])
        self.doc, self.line = doc[self.head], line[self.head]
        self.a = np.add.reduceat(stir(word), self.head)
        self.b = np.add.reduceat(stir(word ^ SPREAD), self.head)

    def signatures(self) -> list[np.ndarray]:
        """Parity of the tokens in each of 256 cells."""
        bit, of = U(1) << ((self.word >> U(56)) & U(63)), (self.word >> U(62)).astype(np.int8)
        return [np.bitwise_xor.reduceat(np.where(of == k, bit, U(0)), self.head) for k in range(4)]

    def wide(self) -> tuple[np.ndarray, np.ndarray]:
        """(row of each line's wide signature, the signatures): parity of the tokens in each of 64 * WORDS cells."""
        long = np.flatnonzero(self.size >= WIDE)
        row = np.zeros(len(self.size), np.int64)
        row[long] = np.arange(len(long))
        owner, at = ranges(self.head[long], self.head[long] + self.size[long])
        word = self.word[at]
        cells = owner * (64 * WORDS) + (word >> U(54)).astype(np.int64)
        odd = (np.bincount(cells, minlength=len(long) * 64 * WORDS) & 1).astype(np.uint8)
        return row, np.packbits(odd, bitorder="little").view("<u8").reshape(-1, WORDS)


def ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) for every j from start[i] to end[i] - 1."""
    n = np.maximum(end - start, 0)
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def keys_of(lines: Lines, keep: np.ndarray, tallies: Tallies, percent: int, tuning: Tuning):
    """(line, key, place, whether it is the line's first) of every record of the lines to keep.

    A prefix token makes a record. A hot one makes a record with each of the tokens that its line would have as a prefix
    after it: of two similar lines whose first common token is hot, the second common token is among those of both.
    """
    head, size, word = lines.head, lines.size, lines.word
    width = size - -(-percent * size // 100) + 1
    seen = tallies.seen
    chosen = np.flatnonzero(keep)
    i, at = ranges(head[chosen], head[chosen] + width[chosen])
    owner = chosen[i]
    place = at - head[owner]
    often = seen(word[at]) > tallies.hot(tuning)
    alone = often & (size[owner] == 1)
    plain = np.flatnonzero(~often | alone)
    out = [(owner[plain], np.where(alone[plain], stir(word[at[plain]]), word[at[plain]]), place[plain], place[plain] == 0)]
    hots = np.flatnonzero(often & ~alone)
    if len(hots):
        i, at2 = ranges(at[hots] + 1, head[owner[hots]] + width[owner[hots]] + 1)
        x = hots[i]
        own, second = owner[x], at2 - head[owner[x]]
        key = stir(word[at[x]] ^ stir(word[at2] + SPREAD))
        first = (place[x] == 0) & (second == 1)
        parts = 1 + (np.minimum(seen(word[at[x]]), seen(word[at2])) / tallies.split(tuning)).astype(np.int64)
        one = parts == 1
        out.append((own[one], key[one], second[one] - 1, first[one]))
        if not one.all():
            own, key, second, first, parts = (z[~one] for z in (own, key, second, first, parts))
            mine = (lines.a[own] % parts.astype(np.uint64)).astype(np.int64)
            i, other = ranges(np.zeros(len(own), np.int64), parts)
            low, high = np.minimum(mine[i], other), np.maximum(mine[i], other)
            cell = stir(key[i] ^ (low * parts[i] + high + 1).astype(np.uint64))
            out.append((own[i], cell, second[i] - 1, first[i] & (other == mine[i])))
    return tuple(np.concatenate(z) for z in zip(*out))


def records(tallies: Tallies, percent: int, buckets: int, tuning: Tuning, only: Tallies | None = None):
    """Blobs of the records of each distinct line of a task. A line that equals an earlier one of its task is gone.

    only: counters of keys; then records whose key's counter wasn't met are left out, and what is gone.
    """

    def task(batches):
        for rows in texts_by_size(batches, tuning.group):
            rows.sort(key=lambda r: r[0])
            found, first, size = [], 0, 0
            for k, (_, text) in enumerate(rows):
                size += len(text)
                if size >= PART or k + 1 == len(rows):
                    doc, line, word = by_rarity([t for _, t in rows[first : k + 1]], tallies)
                    found.append((doc + np.int32(first), line, word))
                    first, size = k + 1, 0
            uids = np.array([u for u, _ in rows], np.int64)
            rows.clear()
            doc, line, word = (np.concatenate(x) for x in zip(*found))
            found.clear()
            if not len(doc):
                continue
            lines = Lines(doc, line, word)
            o = np.lexsort((lines.b, lines.a))  # stable: earlier lines first
            same = np.r_[False, (lines.a[o][1:] == lines.a[o][:-1]) & (lines.b[o][1:] == lines.b[o][:-1])]
            keep = np.ones(len(o), bool)
            keep[o[same]] = False
            gone = np.flatnonzero(~keep)
            if len(gone) and only is None:
                data = packed({"uid": uids[lines.doc[gone]], "line": lines.line[gone]}, LINES)
                yield blob_rows([(int(uids[0] % buckets), GONE, data)])
            owner, key, place, whole = keys_of(lines, keep, tallies, percent, tuning)
            if only is not None:
                x = np.flatnonzero(only.has(key))
                if not len(x):
                    continue
                owner, key, place, whole = owner[x], key[x], place[x], whole[x]
            bucket = ((key & U(0xFFFFFFFF)) % U(buckets)).astype(np.int64)
            o = np.argsort((bucket << 32) | owner) if buckets < 1 << 31 else np.lexsort((owner, bucket))
            owner, key, place, whole, bucket = owner[o], key[o], place[o], whole[o], bucket[o]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            signs = lines.signatures()
            row, wide = lines.wide()
            out, held = [], 0
            for a, b in zip(cuts[:-1], cuts[1:]):
                x, w = owner[a:b], whole[a:b]
                columns = {"token": key[a:b] >> U(32), "low": lines.a[x] & U(0xFFFFFFFF), "uid": uids[lines.doc[x]], "line": lines.line[x], "size": lines.size[x], "place": place[a:b]}
                columns |= {f"s{k}": s[x] for k, s in enumerate(signs)}
                columns |= {"high": np.where(w, (lines.a[x] >> U(32)) | U(1), U(0)), "other": np.where(w, lines.b[x], U(0))}
                out.append((int(bucket[a]), RECORDS, packed(columns, FIELDS, wide[row[x[lines.size[x] >= WIDE]]])))
                held += len(out[-1][2])
                if held > 4 << 20:
                    yield blob_rows(out)
                    out, held = [], 0
            if out:
                yield blob_rows(out)

    return task


def listed_keys(batch: pa.RecordBatch, tallies: Tallies, percent: int, tuning: Tuning):
    """(row, key) of all records of a table (uid, line, tokens)."""
    n = np.diff(batch.column(2).offsets.to_numpy())
    word = batch.column(2).flatten().to_numpy().view(np.uint64)
    nth = np.repeat(np.arange(batch.num_rows, dtype=np.int32), n)
    o = np.lexsort((word, word >> U(28), tallies.rank(word), nth))
    lines = Lines(nth[o], np.zeros(len(o), np.int32), word[o])
    owner, key, _, _ = keys_of(lines, np.ones(len(lines.head), bool), tallies, percent, tuning)
    return lines.doc[owner], key


def count_keys(tallies: Tallies, percent: int, tuning: Tuning):
    """As count_tokens(), of the keys of lines given by their tokens, in as many counters."""
    counters = len(tallies.ranks)

    def task(batches):
        yield from tallied(((listed_keys(b, tallies, percent, tuning)[1] & U(counters - 1)).astype(np.int64) for b in batches), counters)

    return task


def open_lines(tallies: Tallies, percent: int, buckets: int, tuning: Tuning):
    """Blobs (uid, line) of the lines of a table (uid, line, tokens), for every bucket that has records of them."""

    def task(batches):
        for b in batches:
            row, key = listed_keys(b, tallies, percent, tuning)
            bucket = ((key & U(0xFFFFFFFF)) % U(buckets)).astype(np.int64)
            uid, line = b.column(0).to_numpy(), b.column(1).to_numpy()
            out = []
            for k in np.unique(bucket):
                x = np.unique(row[bucket == k])
                out.append((int(k), OPEN, packed({"uid": uid[x], "line": line[x]}, LINES)))
            if out:
                yield blob_rows(out)

    return task


def by_line(uid: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The order of lines; as one number of 64 bits where ids and lines have the room."""
    if len(uid) and int(uid.max()) - int(uid.min()) < 1 << 40 and int(line.max()) < 1 << 24:
        return np.argsort(((uid - uid.min()).astype(np.uint64) << U(24)) | line.astype(np.uint64))
    return np.lexsort((line, uid))


class Group:
    """Records of a bucket, sorted by token and size, without those of equal lines but the first."""

    def __init__(self, c: dict[str, np.ndarray]):
        wide = c.pop("wide")
        row = np.cumsum(c["size"] >= WIDE) - 1
        key = (c["token"].astype(np.uint64) << U(32)) | c["size"].astype(np.uint64)
        full = c["s0"] ^ c["s1"] ^ c["s2"] ^ c["s3"]
        # By token, size and hash; numbers of 64 bits are sorted first, then what they leave equal.
        near = (key & U(0xFFFFFFFF00000000)) | (np.minimum(key & U(0xFFFFFFFF), U(0xFFFF)) << U(16)) | (c["low"] >> np.uint32(16)).astype(np.uint64)
        o = np.argsort(near)
        near = near[o]
        tie = near[1:] == near[:-1]
        some = np.flatnonzero(np.r_[False, tie] | np.r_[tie, False])
        x = o[some]
        o[some] = x[np.lexsort((x, full[x], c["low"][x], key[x], near[some]))]
        del near, tie, some, x
        key, full = key[o], full[o]
        # Neighbours that are equal so far are compared by all hashes.
        x = np.flatnonzero((key[1:] == key[:-1]) & (full[1:] == full[:-1])) + 1
        this, before = o[x], o[x - 1]
        equal = np.ones(len(x), bool)
        for name in ("low", "high", "other", "s1", "s2", "s3"):
            equal &= c[name][this] == c[name][before]
        new = np.ones(len(o), bool)
        new[x[equal]] = False
        first = np.ones(len(o), bool)
        some = np.flatnonzero(~new | ~np.r_[new[1:], True])  # members of classes of two or more
        if len(some):
            head = np.flatnonzero(new[some])
            nth = np.cumsum(new[some]) - 1
            uid, line = c["uid"][o[some]], c["line"][o[some]]
            least = np.minimum.reduceat(uid, head)[nth]
            line = np.where(uid == least, line, np.uint32(0xFFFFFFFF))
            first[some] = (uid == least) & (line == np.minimum.reduceat(line, head)[nth])
        #: Lines that equal an earlier one: judged where the record has the whole hashes.
        later = o[~first]
        later = later[c["high"][later] > 0]
        self.gone = c["uid"][later], c["line"][later]
        o = o[first]
        # One column after the other, so that all of them aren't held twice.
        self.c, self.key, self.full = {k: c.pop(k)[o] for k in list(c)}, key[first], full[first]
        self.size, self.place = self.c["size"].astype(np.int64), self.c["place"].astype(np.int64)
        self.wide, self.row = wide, row[o]
        self.rank = np.empty(len(o), np.int64)  # place among the records in the order of their lines
        self.rank[by_line(self.c["uid"], self.c["line"])] = np.arange(len(o))

    def room(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """The most tokens that only one of two similar lines may have."""
        both = self.size[i] + self.size[j]
        return both - 2 * (-(-percent * both // (100 + percent)))

    def close(self, i: np.ndarray, j: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
        """Whether so near that the pair will most likely hold: well below the room, or one token exchanged."""
        room = self.room(i, j, percent)
        return apart <= np.minimum(room, np.maximum(2, 2 * room // 5))

    def alike(self, i: np.ndarray, j: np.ndarray, percent: int):
        """Pairs that pass the place filter and the signatures' bound, with their least distance."""
        both = self.size[i] + self.size[j]
        need = -(-percent * both // (100 + percent))
        ok = np.minimum(self.size[i] - self.place[i], self.size[j] - self.place[j]) >= need
        i, j, room = i[ok], j[ok], (both - 2 * need)[ok]
        ok = np.bitwise_count(self.full[i] ^ self.full[j]) <= room  # all four words folded into one
        i, j, room = i[ok], j[ok], room[ok]
        apart = sum(np.bitwise_count(self.c[f"s{k}"][i] ^ self.c[f"s{k}"][j]).astype(np.int64) for k in range(4))
        x = np.flatnonzero((self.size[i] >= WIDE) & (self.size[j] >= WIDE))
        if len(x):
            apart[x] = np.bitwise_count(self.wide[self.row[i[x]]] ^ self.wide[self.row[j[x]]]).sum(axis=1, dtype=np.int64)
        ok = apart <= room
        return i[ok], j[ok], apart[ok]

    def reach(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each record the first and the end of the records of its token whose sizes are near enough."""
        token = self.key & U(0xFFFFFFFF00000000)
        low = np.searchsorted(self.key, token | (-(-percent * self.size // 100)).astype(np.uint64), side="left")
        most = np.minimum(100 * self.size // percent, 0xFFFFFFFF).astype(np.uint64)
        return low, np.searchsorted(self.key, token | most, side="right")

    def earlier(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether j's line stands before i's."""
        ok = self.rank[j] < self.rank[i]
        same = np.flatnonzero((self.c["uid"][i] == self.c["uid"][j]) & (self.c["line"][i] == self.c["line"][j]))
        ok[same] = False
        return ok

    def found(self, i, j, apart, more) -> tuple[np.ndarray, ...]:
        return self.c["uid"][i], self.c["line"][i], self.c["uid"][j], self.c["line"][j], apart, more

    def candidates(self, percent: int, tuning: Tuning, which: np.ndarray | None = None):
        """Earlier candidates of each line; with which, all candidates of the lines marked."""
        n = len(self.key)
        low, high = self.reach(percent)
        if which is None:
            # First the earliest lines of each token, where many have it: a group of like lines needs no other.
            token = self.key >> U(32)
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            counts = np.diff(np.r_[starts, n])
            large = counts > tuning.large
            done = np.zeros(n, bool)
            for a, b in zip(starts[large], (starts + counts)[large]):
                members = a + np.argsort(self.rank[a:b])
                lead = members[: tuning.leaders]
                i, j = np.repeat(members, len(lead)), np.tile(lead, b - a)
                ok = self.earlier(i, j)
                i, j, apart = self.alike(i[ok], j[ok], percent)
                close = self.close(i, j, apart, percent)
                i, j, apart = i[close], j[close], apart[close]
                p = np.lexsort((self.rank[j], i))
                i, j, apart = i[p], j[p], apart[p]
                one = np.r_[True, i[1:] != i[:-1]][: len(i)]
                done[i] = True
                yield self.found(i[one], j[one], apart[one], np.ones(int(one.sum()), bool))
            wanted = np.flatnonzero(~done)
        else:
            wanted = np.flatnonzero(which)
        # Where all records are wanted, each pair is met once, from its shorter line.
        half = len(wanted) == n
        begin = np.arange(n) + 1 if half else low
        work = np.cumsum(high[wanted] - begin[wanted])
        at = 0
        while at < len(wanted):
            upto = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + PAIRS_AT_ONCE)))
            part = wanted[at:upto]
            at = upto
            i, j = ranges(begin[part], high[part])
            i, j, apart = self.alike(part[i], j, percent)
            ok = self.earlier(i, j)
            if half:
                swap = self.rank[j] > self.rank[i]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
            else:
                i, j, apart = i[ok], j[ok], apart[ok]
            if which is None and len(i):
                # Near ones in their order, so that all tokens of a line choose alike; then the others by distance.
                close = self.close(i, j, apart, percent)
                o = np.lexsort((self.rank[j], np.where(close, 0, 1 + apart), i))
                i, j, apart, close = i[o], j[o], apart[o], close[o]
                starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
                counts = np.diff(np.r_[starts, len(i)])
                nth = np.arange(len(i)) - np.repeat(starts, counts)
                kept = np.where(close[starts], tuning.best, tuning.most)
                more, best = np.repeat(counts > kept, counts), nth < np.repeat(kept, counts)
                yield self.found(i[best], j[best], apart[best], more[best])
            elif len(i):
                yield self.found(i, j, apart, np.zeros(len(i), bool))


def pair_up(percent: int, only_open: bool, tuning: Tuning):
    """Rows FOUND of blobs sorted by bucket: lines that equal an earlier one (other is null), and candidates.

    only_open: all candidates, of the lines only that have a blob OPEN in the bucket.
    """

    def rows(uid, line, other=None, other_line=None, apart=None, more=None):
        for k in range(0, len(uid), 50_000):
            s = slice(k, k + 50_000)
            n = len(uid[s])
            given = lambda x, t: pa.nulls(n, t) if x is None else pa.array(x[s].astype(t.to_pandas_dtype()), t)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [given(uid, pa.int64()), given(line, pa.int32()), given(other, pa.int64()), given(other_line, pa.int32()), given(apart, pa.int32()), given(more, pa.bool_())],
                names=["uid", "line", "other", "other_line", "apart", "more"],
            )

    def process(blobs: dict[int, list[bytes]]):
        if blobs[GONE] and not only_open:
            c = unpacked(blobs[GONE], LINES)
            yield from rows(c["uid"], c["line"])
        if not blobs[RECORDS] or (only_open and not blobs[OPEN]):
            return
        group = Group(unpacked(blobs[RECORDS], FIELDS))
        which = None
        if only_open:
            o = unpacked(blobs[OPEN], LINES)
            pairs = set(zip(o["uid"].tolist(), o["line"].tolist()))
            near = np.flatnonzero(np.isin(group.c["uid"], o["uid"]))
            which = np.zeros(len(group.key), bool)
            which[near] = [p in pairs for p in zip(group.c["uid"][near].tolist(), group.c["line"][near].tolist())]
        else:
            yield from rows(*group.gone)
        for found in group.candidates(percent, tuning, which):
            yield from rows(*found)

    def task(batches):
        last, blobs = None, {RECORDS: [], GONE: [], OPEN: []}
        for b in batches:
            for k in range(b.num_rows):
                bucket = b.column(0)[k].as_py()
                if bucket != last:
                    yield from process(blobs)
                    last, blobs = bucket, {RECORDS: [], GONE: [], OPEN: []}
                blobs[b.column(1)[k].as_py()].append(b.column(2)[k].as_py())
        yield from process(blobs)

    return task


def line_sets(seed: int):
    """(uid, line, tokens) of the lines asked for of each text."""

    def task(batches):
        for b in batches:
            out = []
            for uid, text, asked in zip(*(b.column(c).to_pylist() for c in range(3))):
                lines = text.encode().split(b"\n") if len(asked) > 1 or asked[0] else [text.encode().split(b"\n", 1)[0]]
                asked = sorted(asked)
                doc, _, word = tokens_of([lines[k] for k in asked], seed)
                o = np.lexsort((word, doc))
                doc, word = doc[o], word[o]
                new = np.r_[True, (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])]
                doc, word = doc[new], word[new].view(np.int64)
                ends = np.searchsorted(doc, np.arange(len(asked) + 1))
                out += [(uid, k, word[ends[n] : ends[n + 1]]) for n, k in enumerate(asked)]
                if len(out) > 5000:
                    yield set_rows(out)
                    out = []
            if out:
                yield set_rows(out)

    return task


def set_rows(out) -> pa.RecordBatch:
    uid, line, tokens = zip(*out)
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, tokens)]).astype(np.int32)), pa.array(np.concatenate(tokens)))
    return pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(line, pa.int32()), lists], names=["uid", "line", "tokens"])


def asked_sets(pairs: DataFrame, texts: DataFrame, seed: int, few: bool = False) -> DataFrame:
    """Token sets of all lines in pairs. few: most likely few lines, whose list may be broadcast if its size allows."""
    lines = pairs.select("uid", "line").unionByName(pairs.select(F.col("other").alias("uid"), F.col("other_line").alias("line")))
    asked = lines.groupBy("uid").agg(F.collect_set("line").alias("asked"))
    # Else the same kind of join at every size: texts meet their lines where ids are dealt.
    asked = materialise(asked, "asked") if few else asked.hint("merge")
    some = texts.select("uid", "text").join(asked, "uid").select("uid", "text", "asked")
    return materialise(some.mapInArrow(released(line_sets(seed)), "uid long, line int, tokens array<long>"), "line-sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(uid, line) of those of pairs whose whole token sets are similar enough."""
    other = sets.select(F.col("uid").alias("other"), F.col("line").alias("other_line"), F.col("tokens").alias("others"))
    both = F.size(F.array_intersect("tokens", "others"))
    return (
        pairs.select("uid", "line", "other", "other_line").join(sets, ["uid", "line"]).join(other, ["other", "other_line"])
        .select("uid", "line", both.alias("both"), (F.size("tokens") + F.size("others")).alias("all"))
        .where(100 * F.col("both") >= percent * (F.col("all") - F.col("both")))
        .select("uid", "line").distinct()
    )


def drop_lines(carry: bool):
    def task(batches):
        for b in batches:
            texts, lines, gone = [], [], []
            for text, drop in zip(b.column("text").to_pylist(), b.column("drop").to_pylist()):
                if drop:
                    parts, out = text.split("\n"), set(drop)
                    text = "\n".join([p for k, p in enumerate(parts) if k not in out])
                    lines.append(len(parts))
                    gone.append(len(out))
                else:
                    lines.append(text.count("\n") + 1)
                    gone.append(0)
                texts.append(text)
            columns = [b.column("doc_id"), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())]
            names = ["doc_id", "n_lines", "n_removed", "text"]
            if carry:
                columns.append(b.column("row"))
                names.append("row")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return task


def dedup_lines(
    docs: DataFrame,
    *,
    percent: int = 75,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    tuning: Tuning = Tuning(),
) -> DataFrame:
    """Remove each line that resembles an earlier line of the corpus.

    A line's tokens are its distinct words (ASCII letters lower-cased, split at ASCII white space). A line with a word
    goes if an earlier one (smaller id, or before in the same document; itself removed or not) has Jaccard similarity of
    percent (51 to 100) or more with it. Lines without a word stay.

    1. Tokens are counted over all lines, in counters whose number follows the input, and ordered by their counter, rare
       ones first, then by hash. Two similar lines share one of their first size - ceil(percent * size) + 1 tokens, so each distinct line
       of a task makes a record for each of these. Records are dealt to buckets by token and travel many to a row.
    2. Of equal lines (128 bits of hash over all tokens, of which records that aren't a line's first carry 32 beside the
       parities of 256 cells) all but the first are gone: those of one task before anything
       is sent, others where their first tokens meet. Other lines of a token are compared by length, by place and by
       a bound from the parities of 256 cells, of 1024 for long lines. Of each line the most alike candidates are kept.
    3. Candidates are verified on whole token sets, the most alike one first. For a line that had more candidates than
       were kept and none that holds, all of them are verified.

    A very frequent token, one seen 4096 times and sixteen times as often as a counter's tokens are on average, makes no group of its own: lines that have it meet by it and one more token, and where both
    are frequent, blocks of such lines meet two by two. So a task's memory is bounded by tuning.group bytes of text and
    by 2 * tuning.split records of a group, from some hundred GB of text on by 32 times the average of a counter, and no
    pair is lost.

    Columns: doc_id, n_lines, n_removed, text (the other lines joined by newlines), with
    carry row, a struct of the other input columns.

    Null texts count as empty. Null ids come first, rows that share an id are documents of their own in an
    order that a hash of their texts fixes. An empty table gives no rows. A line may be as long as a text: it needs memory in
    proportion to its words.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be 51 to 100")
    rows = with_uid(docs, id_col, text_col, carry).where("uid is not null")
    with small_batches(docs.sparkSession):
        drop = lines_to_drop(docs, rows, percent, tuning)
    out = rows.join(drop.hint("merge"), "uid", "left").select("doc_id", "text", "drop", *(["row"] if carry else []))
    schema = "doc_id long, n_lines long, n_removed long, text string"
    if carry:
        schema += ", row " + rows.schema["row"].dataType.simpleString()
    return out.mapInArrow(released(drop_lines(carry)), schema)


def lines_to_drop(docs: DataFrame, rows: DataFrame, percent: int, tuning: Tuning) -> DataFrame:
    """(uid, the lines that go) of rows (uid, text), which are those of docs."""
    spark = docs.sparkSession
    short = rows.select("uid", "text")
    counters, seed = counters_for(bytes_of(docs)), new_seed()
    tallies = counted(short, count_tokens(counters, seed), counters, seed)
    buckets = max(1, math.ceil(tallies.size / tuning.group))
    # Many buckets share a partition, one after the other, where there are more of them than partitions.
    partitions = min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = short.mapInArrow(released(records(tallies, percent, buckets, tuning)), BLOBS)
    in_buckets = lambda blobs: blobs.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    found = materialise(in_buckets(made).mapInArrow(released(pair_up(percent, False, tuning)), FOUND), "found")
    gone = found.where("other is null").select("uid", "line").distinct()
    pairs = found.where("other is not null").groupBy("uid", "line", "other", "other_line").agg(
        F.min("apart").alias("apart"), F.max("more").alias("more")
    )
    pairs = materialise(pairs.join(gone, ["uid", "line"], "left_anti"), "pairs")
    sets = asked_sets(pairs, rows, seed)
    best = pairs.groupBy("uid", "line").agg(F.min(F.struct("apart", "other", "other_line")).alias("b"), F.max("more").alias("more"))
    near = materialise(verified(best.select("uid", "line", "b.other", "b.other_line"), sets, percent), "near")
    left = pairs.join(near, ["uid", "line"], "left_anti")
    near = near.unionByName(materialise(verified(left, sets, percent), "near"))
    undecided = materialise(best.where("more").select("uid", "line").join(near, ["uid", "line"], "left_anti"), "open")
    if not undecided.isEmpty():
        theirs = sets.join(undecided, ["uid", "line"], "left_semi")
        # Records of other keys than theirs can't bring them a partner.
        only = counted(theirs, count_keys(tallies, percent, tuning), counters, seed)
        marks = theirs.mapInArrow(open_lines(tallies, percent, buckets, tuning), BLOBS)
        some = short.mapInArrow(released(records(tallies, percent, buckets, tuning, only)), BLOBS)
        again = in_buckets(some.unionByName(marks)).mapInArrow(released(pair_up(percent, True, tuning)), FOUND)
        more = materialise(again.select("uid", "line", "other", "other_line").distinct(), "pairs")
        more_sets = asked_sets(more, rows, seed, few=True)
        near = near.unionByName(materialise(verified(more, more_sets, percent), "near"))
        drop_table(more_sets)
    drop_table(sets)
    drop_table(pairs)
    drop = gone.unionByName(near).groupBy("uid").agg(F.collect_set("line").alias("drop"))
    drop = materialise(drop, "drop")
    drop_table(found)
    return drop
