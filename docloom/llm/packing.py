"""Packing of tokenised documents into fixed windows."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import materialise, released
from docloom.llm.tokens import ByteBpe

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, is_open boolean, ids binary"
)
ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("is_open", pa.bool_()),
        ("ids", pa.binary()),
    ]
)
#: Rows of pieces that a task holds before it sends them on, and partitions merged by one task of a round.
BATCH = 2000
FAN_IN = 16


class Packer:
    """Bounded-space best fit: at most ``open_windows`` windows stand open.

    A piece goes to the open window that it fills best. Where none has room, the fullest is topped up
    with the head of the piece (documents may be cut) and emitted. Pieces are
    (doc_id, start, doc_tokens, ids) with ids as bytes of 4 each.
    """

    def __init__(self, size: int, open_windows: int, next_id: Callable[[], int]):
        self.size, self.most, self.next_id = size, open_windows, next_id
        self.windows: list[tuple[int, list]] = []  # (room, pieces), least room first
        self.rows: list[tuple] = []

    def emit(self, pieces: list, is_open: bool = False) -> None:
        at, sequence = 0, self.next_id()
        for doc, start, total, ids in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, total, sequence, at, is_open, ids))
            at += n

    def add(self, doc, start: int, total: int, ids: bytes) -> None:
        size = self.size
        while len(ids) >= 4 * size:
            self.emit([(doc, start, total, ids[: 4 * size])])
            start, ids = start + size, ids[4 * size :]
        while ids:
            n = len(ids) // 4
            best = next((k for k, (room, _) in enumerate(self.windows) if room >= n), None)
            if best is not None:
                room, pieces = self.windows.pop(best)
                pieces.append((doc, start, total, ids))
                if room == n:
                    self.emit(pieces)
                else:
                    self.put(room - n, pieces)
                return
            if len(self.windows) < self.most:
                self.put(size - n, [(doc, start, total, ids)])
                return
            room, pieces = self.windows.pop(0)  # the fullest
            self.emit(pieces + [(doc, start, total, ids[: 4 * room])])
            start, ids = start + room, ids[4 * room :]

    def put(self, room: int, pieces: list) -> None:
        k = next((k for k, (r, _) in enumerate(self.windows) if r > room), len(self.windows))
        self.windows.insert(k, (room, pieces))

    def leave_open(self) -> None:
        for _, pieces in self.windows:
            self.emit(pieces, True)
        self.windows = []

    def finish(self) -> None:
        """Fill the fullest windows from the emptiest; cut what remains at powers of two, which need no padding."""
        heap = [(room, k, pieces) for k, (room, pieces) in enumerate(self.windows)]
        self.windows = []
        heapq.heapify(heap)
        while len(heap) > 1:
            room, k, pieces = heapq.heappop(heap)
            if not room:
                self.emit(pieces)
                continue
            far = max(range(len(heap)), key=lambda i: (heap[i][0], heap[i][1]))
            r, j, donor = heap[far]
            doc, start, total, ids = donor.pop()
            take = min(room, len(ids) // 4)
            rest = ids[: len(ids) - 4 * take]
            pieces.append((doc, start + len(rest) // 4, total, ids[len(rest) :]))
            if rest:
                donor.append((doc, start, total, rest))
            if donor:
                heap[far] = (r + take, j, donor)
            else:
                heap.pop(far)
            heapq.heapify(heap)
            heapq.heappush(heap, (room - take, k, pieces))
        for room, _, pieces in heap:
            left = self.size - room
            while left:
                want = 1 << (left.bit_length() - 1)
                left -= want
                part = []
                while want:
                    doc, start, total, ids = pieces.pop(0)
                    n = min(want, len(ids) // 4)
                    part.append((doc, start, total, ids[: 4 * n]))
                    if 4 * n < len(ids):
                        pieces.insert(0, (doc, start + n, total, ids[4 * n :]))
                    want -= n
                self.emit(part)

    def take(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.rows and len(self.rows) >= least:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t.type) for c, t in zip(zip(*self.rows), ARROW)], schema=ARROW
            )
            self.rows = []


def numbered(level: int) -> Callable[[], int]:
    """Sequence ids that no other task of any round gives: round, partition, count."""
    first = (level << 56) | (TaskContext.get().partitionId() << 32)
    count = iter(range(1 << 32))
    return lambda: first + next(count)


def pack_sequences(
    docs: DataFrame,
    *,
    size: int = 2048,
    open_windows: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
) -> DataFrame:
    """Pack every document's tokens, then end_id, into sequences of at most size tokens.

    Bounded-space online packing: each task tokenises the rows of its input split and packs them by
    best fit into at most open_windows open windows; nothing is shuffled. What stands open at a task's
    end (at most open_windows * size ids) is merged by the same packer over FAN_IN tasks at a time,
    round after round, until one task is left; it cuts its last window at powers of two. So every
    sequence has size tokens, save the last few whose lengths are distinct powers of two: no padding.

    Returns a row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary,
    little-endian unsigned 32-bit). Sequence ids are unique, not dense.

    Null texts count as empty and give the end id alone. Every row is a document of its own: null and
    repeated ids are packed as they come. An empty table gives no rows. Other columns are not read. A very long text is
    cut over as many sequences as it needs; its ids are held once by the task that tokenises it.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = end_id.to_bytes(4, "little")

    def first(batches):
        enc, packer = ByteBpe(tokenizer), Packer(size, open_windows, numbered(0))
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode(text.as_py()) + end
                packer.add(doc, 0, len(ids) // 4, ids)
                yield from packer.take(BATCH)
        packer.leave_open()
        yield from packer.take(1)

    def merge(level: int, last: bool):
        def again(batches):
            packer = Packer(size, open_windows, numbered(level))
            for batch in batches:
                for row in batch.to_pylist():
                    packer.add(row["doc_id"], row["start"], row["doc_tokens"], row["ids"])
                    yield from packer.take(BATCH)
            if last:
                packer.finish()
            else:
                packer.leave_open()
            yield from packer.take(1)

        return again

    table = materialise(rows.mapInArrow(released(first), PIECES), "packed")
    done, level = [table.where("not is_open")], 0
    tasks = table.where("is_open").agg(F.count_distinct("sequence_id")).first()[0] // open_windows + 1
    while True:
        level += 1
        tasks = -(-tasks // FAN_IN)
        left = table.where("is_open").drop("is_open")
        left = left.repartition(tasks) if tasks > 1 else left.coalesce(1)
        table = materialise(left.mapInArrow(merge(level, tasks == 1), PIECES), "packed")
        done.append(table.where("not is_open"))
        if tasks == 1:
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("is_open")
