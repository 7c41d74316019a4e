"""Words of many texts at a time, as 64-bit hashes.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A word's hash mixes its length and then
its bytes, eight at a time, through a permutation of 64 bits after each step, so that it isn't linear in the bytes;
words over LONG bytes are hashed by xxh3. Two different words have the same hash with a probability of 2 ** -64: over
words that occur by chance, and, as every run of an operator draws a seed that no text can know, over those that
someone has made to collide.
"""

from __future__ import annotations

import re
import secrets

import numpy as np
import xxhash

U = np.uint64
SPREAD = U(0x9E3779B97F4A7C15)
#: Bytes of text that a task hashes at a time. A longer text is cut between words.
BLOCK = 1 << 19
LONG = 256
WHITE = re.compile(rb"[\x20\x09-\x0D]")
#: 0 for a byte of white space, 1 for any other.
INSIDE = bytes(0 if b in b"\x20\x09\x0a\x0b\x0c\x0d" else 1 for b in range(256))
#: The first n bytes of eight, little end first.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(29))


def stir(x: np.ndarray) -> np.ndarray:
    """A permutation of 64 bits in which each bit of x reaches every other."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(29)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(32)
    return x


def eights(data: bytes) -> np.ndarray:
    """The eight bytes from every place of data, zeros beyond its end."""
    return np.ndarray((len(data) + 1,), np.dtype("<u8"), data + bytes(8), 0, (1,))


def hash_spans(held: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the size bytes from each start, of what eights() gave."""
    most = int(size.max(initial=0))
    if most < len(size):  # few sizes, many words
        h = stir(np.arange(most + 1, dtype=np.uint64) * SPREAD + U(seed))[size]
    else:
        h = stir(size.astype(np.uint64) * SPREAD + U(seed))
    h = stir(h ^ (held[start] & FIRST[np.minimum(size, 8)]))
    more = np.flatnonzero(size > 8)
    done = 8
    while len(more):
        left = size[more] - done
        h[more] = stir(h[more] ^ (held[start[more] + done] & FIRST[np.minimum(left, 8)]))
        more, done = more[left > 8], done + 8
    return h


def new_seed() -> int:
    """A seed for one run: it goes to the tasks with their functions, so a task that is run again has the same."""
    return secrets.randbits(64)


def word_hashes(data: bytes, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of a block that is in lower case."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = np.frombuffer(data.translate(INSIDE), np.int8)
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edge[::2], edge[1::2] - edge[::2]
    if not len(start):
        return start, np.zeros(0, np.uint64)
    long = np.flatnonzero(size > LONG)
    h = hash_spans(eights(data), start, np.minimum(size, LONG), seed)
    for k in long:
        h[k] = xxhash.xxh3_64_intdigest(data[start[k] : start[k] + size[k]], seed)
    return start, h


def blocks(texts: list[bytes]):
    """(number of the first text, pieces in lower case); a text longer than a block is cut between words."""
    block, first, size = [], 0, 0
    for n, text in enumerate(texts):
        text = text.lower()
        if size and size + len(text) + 1 > BLOCK:
            yield first, block
            block, size = [], 0
        if not block:
            first = n
        at = 0
        while len(text) - at >= BLOCK:
            # The last white space of the next block's bytes, or where a longer word ends.
            cut = max(text.rfind(c, at + 1, at + BLOCK) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut < 0:
                end = WHITE.search(text, at + 1)
                cut = end.start() if end else len(text)
            yield n, [text[at:cut]]
            at = cut
        block.append(text[at:] if at else text)
        size += len(text) - at + 1
    if block:
        yield first, block
