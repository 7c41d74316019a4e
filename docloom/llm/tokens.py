"""Exact encoders of the public tokenizers. Ids are bytes: little-endian unsigned 32-bit."""

from __future__ import annotations

import base64
import json
import os
import re
import struct
from concurrent.futures import ThreadPoolExecutor

import public_tokenizers
import regex
from tokenizers import Tokenizer, models

#: Pieces held by a worker's cache, and the longest piece it holds.
CACHE_PIECES = 500_000
CACHE_CHARS = 48
#: Characters of unsplit text that are encoded in one go at most, and from which on parts are encoded in threads.
PART, IN_THREADS = 4096, 1 << 14
THREADS = 4
#: Ends a word in the rank table of word_bpe_49k.
WORD_END = b"\xff"
#: Characters that NFC leaves alone, whose lower case needs no context, and that aren't white space.
PLAIN = re.compile("[!-~\u00a1-\u02ff]+")
#: Fixed value: the pattern of word_bpe_49k.json.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def pack_ids(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ByteBpe:
    """byte_bpe_50k.json as tokenizers encodes with add_special_tokens=False.

    Texts go through the rank file of the same vocabulary, which gives equal ids; texts with a special
    token's string, and all texts where that file is missing, go through tokenizers itself.
    """

    def __init__(self, path: str | None = None, ranks: str | None = None):
        self.path = path or public_tokenizers.path("byte_bpe_50k.json")
        self.full = Tokenizer.from_file(self.path)
        with open(self.path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        ranks = ranks or (public_tokenizers.path("byte_bpe_50k.tiktoken") if path is None else None)
        self.quick = None
        if ranks and os.path.exists(ranks):
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.quick = tiktoken.Encoding(
                "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            )

    def encode(self, text: str) -> bytes:
        if self.quick is None or any(s in text for s in self.special):
            return pack_ids(self.full.encode(text, add_special_tokens=False).ids)
        return self.quick.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


class WordBpe:
    """word_bpe_49k.json: BPE with word ends over lower-cased text whose white space is dropped.

    encode() gives ids, decode() what the library's decode(ids, skip_special_tokens=False) gives: it
    has no decoder, so token strings joined by single spaces.

    Text is cut at spaces and newlines, which no token crosses. A word longer than ``leaf`` characters without
    such a cut is encoded by tree concatenation: it is halved until no part is longer than PART, parts are encoded
    separately (those of a long word in threads, while the library holds no lock), and pairs of neighbours are joined
    level by level: a window around the join is encoded anew and grown until its first and last token are
    those that the halves had there. Neighbouring tokens of a BPE encoding depend on each other
    alone, so from that point on both sides stand as they were and the join is exact.
    """

    def __init__(self, path: str | None = None, leaf: int = 16, part: int = PART):
        self.path = path or public_tokenizers.path("word_bpe_49k.json")
        self.leaf, self.part = leaf, part
        self.full = Tokenizer.from_file(self.path)
        self.full.no_truncation()
        self.full.no_padding()
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.suffix = spec["model"]["end_of_word_suffix"]
        vocab = spec["model"]["vocab"]
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.spec = spec
        self.bare_model = self.one_word = None
        self.cache: dict[str, tuple[bytes, str]] = {}

    def ranked(self):
        """The same merges as a rank table over bytes, where a byte that UTF-8 never has ends a word.

        Ids 0-255 are bytes, 256-511 bytes at a word's end, and every later id is one merge in order;
        so ids serve as ranks, and each word's end joins its last byte before anything else merges.
        """
        import tiktoken

        # The printable bytes that stand for themselves in byte-level vocabularies.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}
        ranks: dict[bytes, int] = {}
        for token, i in self.spec["model"]["vocab"].items():
            ends = token.endswith(self.suffix)
            ranks[bytes(byte[c] for c in token.removesuffix(self.suffix)) + WORD_END * ends] = i
        return tiktoken.Encoding("word_bpe", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})

    def pieces(self, new: list[str]) -> list[tuple[bytes, str]]:
        """Pieces without spaces. Those of plain letters and signs go through the rank table word by
        word; the rest, where normalisation or classes could differ, through the library."""
        if self.one_word is None:
            self.one_word = self.ranked()._core_bpe.encode_single_piece
        out, odd = [], []
        for p in new:
            if PLAIN.fullmatch(p) and "<|" not in p:
                low = p.lower()
                words = [low] if low.isalpha() else WORDS.findall(low)
                out.append(self.pair([i for w in words for i in self.one_word(w.encode() + WORD_END)]))
            else:
                odd.append(len(out))
                out.append(None)
        if odd:
            for k in odd:
                out[k] = self.pair(self.full.encode(new[k], add_special_tokens=False).ids)
        return out

    def pair(self, ids: list[int]) -> tuple[bytes, str]:
        return pack_ids(ids), " ".join([self.token[i] for i in ids])

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """(ids as bytes, decoded text) of a whole text."""
        cache = self.cache
        parts = text.replace("\n", " ").split(" ")
        found = list(map(cache.get, parts))
        if None in found:
            new = {p for p, got in zip(parts, found) if got is None}
            new.discard("")
            long = {p for p in new if len(p) > self.leaf}
            new = list(new - long)
            extra = {"": (b"", "")} | {p: self.pair(self.tree_piece(p)) for p in long}
            if new:
                extra.update(zip(new, self.pieces(new)))
                if len(cache) + len(new) > CACHE_PIECES:
                    cache.clear()
                cache.update((p, extra[p]) for p in new if len(p) <= CACHE_CHARS)
            found = [extra[p] if got is None else got for p, got in zip(parts, found)]
        return b"".join([x for x, _ in found]), " ".join([y for x, y in found if x])

    # --- tree concatenation ---------------------------------------------------------------

    def bare(self):
        """The same merges without the word end, for what isn't the end of a word."""
        if self.bare_model is None:
            m = self.spec["model"]
            merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in m["merges"]]
            self.bare_model = Tokenizer(models.BPE(vocab=m["vocab"], merges=merges))
        return self.bare_model

    def fragment(self, text: str, ends_word: bool) -> list[int]:
        model = self.full.model if ends_word else self.bare().model
        return [t.id for t in model.tokenize(text)] if text else []

    def tree_piece(self, piece: str) -> list[int]:
        """Ids of a long piece: special tokens first, then the library's own pre-tokenizer."""
        for s, i in self.special.items():
            if s in piece:
                out: list[int] = []
                for k, part in enumerate(piece.split(s)):
                    out += ([i] if k else []) + (self.tree_piece(part) if part else [])
                return out
        words = self.full.pre_tokenizer.pre_tokenize_str(self.full.normalizer.normalize_str(piece))
        return [i for word, _ in words for i in self.tree(word)]

    def tree(self, word: str) -> list[int]:
        n = len(word)
        if n <= self.leaf:
            return self.fragment(word, True)
        parts = 2
        while parts * self.part < n:
            parts *= 2
        cuts = [n * k // parts for k in range(parts + 1)]
        pieces = [word[a:b] for a, b in zip(cuts, cuts[1:])]
        if n < IN_THREADS:
            level = [self.fragment(p, k + 1 == parts) for k, p in enumerate(pieces)]
        else:
            bare = self.bare()
            encode = lambda p: bare.encode_batch_fast([p], add_special_tokens=False)[0].ids
            with ThreadPoolExecutor(THREADS) as pool:
                level = [*pool.map(encode, pieces[:-1]), self.fragment(pieces[-1], True)]
        while len(level) > 1:
            last = len(level) - 1
            level = [self.join(level[k], level[k + 1], k + 1 == last) for k in range(0, len(level), 2)]
        return level[0]

    def join(self, left: list[int], right: list[int], ends_word: bool) -> list[int]:
        w = 8
        while True:
            a, b = left[-w:], right[:w]
            all_left, all_right = w >= len(left), w >= len(right)
            text = "".join([self.token[i] for i in a + b])
            end = ends_word and all_right
            if end:
                text = text.removesuffix(self.suffix)
            new = self.fragment(text, end)
            if (all_left or new[0] == a[0]) and (all_right or new[-1] == b[-1]):
                return left[: len(left) - len(a)] + new + right[len(b) :]
            w *= 2
