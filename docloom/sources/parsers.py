"""Text of binary documents by the standard library alone, and the registry of parsers."""

from __future__ import annotations

import io
import re
import struct
import xml.etree.ElementTree as ET
import zipfile
import zlib
from typing import Protocol

WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


class Parser(Protocol):
    suffixes: tuple[str, ...]

    def parse(self, content: bytes) -> dict: ...


class DocxParser:
    """Paragraphs of the body, joined by newlines; tables and headers are left out."""

    suffixes = (".docx",)

    def parse(self, content: bytes) -> dict:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            body = ET.fromstring(z.read("word/document.xml")).find(f"{WORD}body")
        paragraphs = [] if body is None else body.findall(f"{WORD}p")
        return {"text": "\n".join(self.paragraph(p) for p in paragraphs)}

    @staticmethod
    def paragraph(p: ET.Element) -> str:
        out = []
        for e in p.iter():
            if e.tag == f"{WORD}t":
                out.append(e.text or "")
            elif e.tag == f"{WORD}tab":
                out.append("\t")
            elif e.tag in (f"{WORD}br", f"{WORD}cr"):
                out.append("\n")
        return "".join(out)


class PdfParser:
    """Strings shown by a file's content streams, plain or deflated. Fonts with own encodings need more."""

    suffixes = (".pdf",)
    STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)
    SHOWN = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]+>|T\*|Td|TD|'|\"|ET|Tj|TJ", re.S)
    ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}

    def parse(self, content: bytes) -> dict:
        if not content.startswith(b"%PDF"):
            raise ValueError("not a PDF")
        pages = []
        for raw in self.STREAM.findall(content):
            try:
                raw = zlib.decompress(raw)
            except zlib.error:
                pass
            if b"BT" in raw and (b"Tj" in raw or b"TJ" in raw):
                pages.append(self.text_of(raw))
        return {"text": "\n".join(p for p in pages if p)}

    def text_of(self, raw: bytes) -> str:
        out = []
        for token in self.SHOWN.findall(raw):
            if token[:1] == b"(":
                plain = re.sub(rb"\\([0-7]{1,3}|.)", self.unescape, token[1:-1], flags=re.S)
                out.append(plain.decode("cp1252", "replace"))
            elif token[:1] == b"<":
                digits = re.sub(rb"\s", b"", token[1:-1])
                out.append(bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()).decode("cp1252", "replace"))
            elif token in (b"T*", b"Td", b"TD", b"'", b'"', b"ET") and out and out[-1] != "\n":
                out.append("\n")
        return "".join(out).strip()

    def unescape(self, m: re.Match) -> bytes:
        x = m[1]
        return bytes([int(x, 8) & 255]) if x[:1].isdigit() else self.ESCAPES.get(x, b"" if x == b"\n" else x)


class MsgParser:
    """Body and subject of a mail message kept as a compound file."""

    suffixes = (".msg",)
    FREE = 0xFFFFFFFA

    def parse(self, content: bytes) -> dict:
        streams = self.streams(content)

        def text(tag: str) -> str | None:
            if (raw := streams.get(f"__substg1.0_{tag}001F")) is not None:
                return raw.decode("utf-16-le", "replace")
            if (raw := streams.get(f"__substg1.0_{tag}001E")) is not None:
                return raw.decode("cp1252", "replace")
            return None

        return {"text": text("1000") or "", "subject": text("0037")}

    def streams(self, data: bytes) -> dict[str, bytes]:
        """Streams of the root storage by name."""
        if data[:8] != bytes.fromhex("d0cf11e0a1b11ae1"):
            raise ValueError("not a compound file")
        size, small = 1 << struct.unpack_from("<H", data, 30)[0], 1 << struct.unpack_from("<H", data, 32)[0]
        start, cutoff, mini_start = (struct.unpack_from("<I", data, at)[0] for at in (48, 56, 60))
        sector = lambda n: data[(n + 1) * size : (n + 2) * size]
        tables = [n for n in struct.unpack_from("<109I", data, 76) if n < self.FREE]
        more = struct.unpack_from("<I", data, 68)[0]
        while more < self.FREE:
            ids = struct.unpack(f"<{size // 4}I", sector(more))
            tables += [n for n in ids[:-1] if n < self.FREE]
            more = ids[-1]
        fat = [x for n in tables for x in struct.unpack(f"<{size // 4}I", sector(n))]

        def chain(n: int, links: list[int], read) -> bytes:
            out = []
            while n < self.FREE and len(out) <= len(links):
                out.append(read(n))
                n = links[n]
            return b"".join(out)

        folder = chain(start, fat, sector)
        entries = [folder[k : k + 128] for k in range(0, len(folder), 128)]
        head = lambda e: struct.unpack_from("<I", e, 116)[0]
        length = lambda e: struct.unpack_from("<I", e, 120)[0]
        name = lambda e: e[: max(0, struct.unpack_from("<H", e, 64)[0] - 2)].decode("utf-16-le", "replace")
        minis = chain(head(entries[0]), fat, sector)
        mini_table = chain(mini_start, fat, sector)
        mini_fat = list(struct.unpack(f"<{len(mini_table) // 4}I", mini_table))
        out, todo, seen = {}, [struct.unpack_from("<I", entries[0], 76)[0]], set()
        while todo:
            k = todo.pop()
            if k >= len(entries) or k in seen:
                continue
            seen.add(k)
            e = entries[k]
            todo += struct.unpack_from("<II", e, 68)
            if e[66] == 2:
                n = length(e)
                part = lambda m: minis[m * small : (m + 1) * small]
                out[name(e)] = (chain(head(e), mini_fat, part) if n < cutoff else chain(head(e), fat, sector))[:n]
        return out


class RtfParser:
    """Plain text of rich text: control words dropped, characters by code page or Unicode escape."""

    suffixes = (".rtf",)
    TOKEN = re.compile(r"\\u(-?\d+) ?\??|\\'([0-9a-fA-F]{2})|\\([a-z]+)(-?\d+)? ?|\\(.)|([{}])|[\r\n]+|([^\\{}\r\n]+)", re.S)
    #: Groups that hold no text.
    HIDDEN = {"fonttbl", "colortbl", "stylesheet", "info", "pict", "object", "header", "footer", "themedata", "datastore"}

    def parse(self, content: bytes) -> dict:
        raw = content.decode("latin-1")
        if not raw.lstrip().startswith("{\\rtf"):
            raise ValueError("not rich text")
        page = re.search(r"\\ansicpg(\d+)", raw)
        codec = f"cp{page[1]}" if page else "cp1252"
        out, stack, hidden = [], [], False
        for m in self.TOKEN.finditer(raw):
            number, code, word, _, other, brace, text = m.groups()
            if brace == "{":
                stack.append(hidden)
            elif brace == "}":
                hidden = stack.pop() if stack else False
            elif word in self.HIDDEN or other == "*":
                hidden = True
            elif hidden:
                continue
            elif number is not None:
                out.append(chr(int(number) % 65536))
            elif code is not None:
                out.append(bytes.fromhex(code).decode(codec, "replace"))
            elif word in ("par", "line", "row"):
                out.append("\n")
            elif word in ("tab", "cell"):
                out.append("\t")
            elif other in ("\\", "{", "}"):
                out.append(other)
            elif other == "~":
                out.append("\u00a0")
            elif text:
                out.append(text)
        return {"text": "".join(out).strip()}


class ParserRegistry:
    """Parser of a suffix, whatever its case; the first that was registered wins."""

    def __init__(self, parsers: list[Parser] | None = None):
        self.parsers = [PdfParser(), DocxParser(), MsgParser()] if parsers is None else list(parsers)

    def register(self, parser: Parser) -> None:
        self.parsers.append(parser)

    def get(self, suffix: str) -> Parser:
        for parser in self.parsers:
            if suffix.lower() in parser.suffixes:
                return parser
        raise ValueError(f"No parser found for {suffix}")
