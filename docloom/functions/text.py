"""Scalar functions over text as column expressions: they stay in the JVM and in generated code."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space as Python knows it, as members of a class of characters.
SPACE_SET = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = f"[{SPACE_SET}]"
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: E-mail addresses and telephone numbers, mail headers, page footers.
EMAIL = r"[\p{L}\p{M}\p{N}_.-]+@[\p{L}\p{M}\p{N}_.-]+"
PHONE = r"\+?\d{6,}"
HEADER = r"(?i)(from|sent|to|subject):.+?\n"
FOOTER = r"Page \d+ of \d+"
#: Namespace of DNS names for version-5 UUIDs.
DNS = "6ba7b8109dad11d180b400c04fd430c8"


def strip(text: Column) -> Column:
    """Without white space at both ends, Unicode's included; trim() knows spaces only."""
    return F.btrim(text, F.lit(SPACES))


def blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def words(text: Column) -> Column:
    """Words between white space; an empty array for blank text."""
    bare = strip(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, rf"{SPACE}+"))


def token_estimate(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE_SET}]+")).cast("int")


def nfc(text: Column) -> Column:
    """Unicode composition by the JVM's own library, which Spark ships for collations."""
    composed = F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(text, F.lit("")), F.lit(False)
    )
    return F.when(text.isNotNull(), composed)


def nfc_python(text: Column) -> Column:
    """Python's own composition, for checking nfc() and for sessions without that library."""

    @F.pandas_udf("string")
    def compose(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return compose(text)


def normalize(text: Column, mode: str = "intended", collapse: bool = True) -> Column:
    """Clean text of mail headers, page footers and loose white space, in composed Unicode.

    intended: header lines go first (they end at a newline), then footers, then composition; white space
    is folded last, unless collapse is off (line counts need newlines). literal: the patterns as the
    original service shipped them, with doubled backslashes, which match next to nothing.
    """
    if mode == "literal":
        out = F.regexp_replace(text, r"Page \\d+ of \\d+", "")
        out = F.regexp_replace(out, r"\\s+", " ")
        return strip(F.regexp_replace(nfc(out), r"(?i)(from|sent|to|subject):.+?\\n", ""))
    if mode != "intended":
        raise ValueError(f"unknown mode {mode}")
    out = F.regexp_replace(text, HEADER, "")
    out = nfc(F.regexp_replace(out, FOOTER, ""))
    return strip(F.regexp_replace(out, rf"{SPACE}+", " ") if collapse else out)


def pii_risk(text: Column, mode: str = "intended", tokens: Column | None = None) -> Column:
    """E-mail addresses and long digit runs per word, to four places; over 1 where words are few.

    tokens: the text's token_estimate(), where it is at hand already.
    """
    text = F.coalesce(text, F.lit(""))
    email, phone = (EMAIL, PHONE) if mode == "intended" else (r"[\\w.-]+@[\\w.-]+", r"\\+?\\d{6,}")
    hits = F.regexp_count(text, F.lit(email)) + F.regexp_count(text, F.lit(phone))
    return F.bround(hits / F.greatest(token_estimate(text) if tokens is None else tokens, F.lit(1)), 4)


def size_bytes_text(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def line_count(text: Column) -> Column:
    """Newlines and one: a newline at the end adds a line, empty text has one."""
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("int")


def requires_split(text: Column, max_bytes: int = 8_000_000, max_lines: int = 1000) -> Column:
    return (size_bytes_text(text) > max_bytes) | (line_count(text) > max_lines)


def needs_ocr(text: Column, least: int = 50) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))) < least


def suffix(path: Column) -> Column:
    """Lower-case extension with its dot; empty without one, and for names that begin with their only dot."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def category_of(path: Column, root: str) -> Column:
    """First folder below root, or "root" for a file directly in it; null outside root."""
    base = root.rstrip("/") + "/"
    parts = F.split(F.substr(path, F.lit(len(base) + 1)), "/")
    return F.when(path.startswith(base), F.when(F.size(parts) > 1, parts[0]).otherwise("root"))


def preview(text: Column, chars: int, mark: str = "...") -> Column:
    return F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit(mark))).otherwise(text)


def summary_or_preview(summary: Column, text: Column, chars: int = 200) -> Column:
    """The summary, or where that is blank the start of the text."""
    return F.when(blank(summary), preview(text, chars)).otherwise(summary)


def uuid5(name: Column) -> Column:
    """Version-5 UUID of a name in the DNS namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(DNS)), name.cast("binary")))
    variant = F.lpad(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)), 2, "0")
    return F.lower(
        F.concat_ws(
            "-",
            F.substring(h, 1, 8),
            F.substring(h, 9, 4),
            F.concat(F.lit("5"), F.substring(h, 14, 3)),
            F.concat(variant, F.substring(h, 19, 2)),
            F.substring(h, 21, 12),
        )
    )


def point_id(content_hash: Column, path: Column) -> Column:
    """Id of a document: from its content hash, or from its path where that is missing."""
    return uuid5(F.when(F.coalesce(content_hash, F.lit("")) != "", content_hash).otherwise(path))


def expected_id(value: Column) -> Column:
    """Ground-truth ids are content hashes of 40 characters; anything else stands for itself."""
    return F.when(F.length(value) == 40, uuid5(value)).otherwise(value)


def json_of_reply(reply: Column) -> Column:
    """A language model's reply without its code fences, as a variant; null where it is no JSON."""
    return F.try_parse_json(F.trim(F.regexp_replace(F.regexp_replace(reply, "```json", ""), "```", "")))


def tags_of(value: Column) -> Column:
    """Tags given as one string: split at commas, trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(value, ","), strip), lambda t: t != "")


def path_edges(path: Column) -> Column:
    """(parent, child) for every prefix of a path; an absolute path's root parent is empty."""
    parts = F.split(path, "/")
    steps = F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))
    join = lambda k: F.array_join(F.slice(parts, 1, k), "/")
    return F.transform(steps, lambda k: F.struct(join(k).alias("parent"), join(k + 1).alias("child")))


#: Keywords in a lower-cased query, and the tags they add.
QUERY_TAGS = [
    (("poplatok",), ("poplatok",)),
    (("pobyt",), ("pobyt", "prechodný pobyt", "trvalý pobyt")),
    (("žiadosť",), ("žiadosť",)),
    (("poistenie",), ("poistenie",)),
    (("dokumenty", "doklady"), ("dokumenty",)),
    (("víza", "visa"), ("víza",)),
]


def tags_of_query(query: Column, rules=QUERY_TAGS) -> Column:
    low = F.lower(query)
    none = F.array().cast("array<string>")
    found = []
    for keys, tags in rules:
        hit = F.lit(False)
        for key in keys:
            hit = hit | F.contains(low, F.lit(key))
        found.append(F.when(hit, F.array(*map(F.lit, tags))).otherwise(none))
    return F.concat(*found)
