"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import drop_table, materialise

SPACE = " \t\n\u000b\f\r"
GAP = r"[\x20\x09-\x0D]+"

#: Words of the text; none for null.
WORDS = rf"IF(btrim(_t, '{SPACE}') = '', CAST(array() AS array<string>), split(btrim(_t, '{SPACE}'), '{GAP}'))".replace(
    "\\", "\\\\"
)
#: Words within three-word windows that occur twice or more. Windows are first sorted as 33 bits of hash
#: above 31 bits of place; those with an equal neighbour are then compared as text, so the count is exact.
REPEATED = """
transform(array(_w), w ->
  transform(array(IF(size(w) < 3, CAST(array() AS array<bigint>), sort_array(transform(sequence(0, size(w) - 3), i ->
      (shiftleft(shiftrightunsigned(xxhash64(w[i], w[i + 1], w[i + 2]), 31), 31) | CAST(i AS bigint)))))), s ->
    transform(array(sort_array(transform(
        filter(s, (x, j) -> shiftrightunsigned(x, 31) = shiftrightunsigned(get(s, j - 1), 31)
                         OR shiftrightunsigned(x, 31) = shiftrightunsigned(get(s, j + 1), 31)),
        x -> named_struct('k', concat_ws(' ', w[CAST(x & 2147483647 AS int)], w[CAST(x & 2147483647 AS int) + 1],
                                         w[CAST(x & 2147483647 AS int) + 2]), 'i', CAST(x & 2147483647 AS int))))), c ->
      aggregate(
        array_sort(transform(filter(c, (x, j) -> x.k = get(c, j - 1).k OR x.k = get(c, j + 1).k), x -> x.i)),
        named_struct('n', 0L, 'last', -3),
        (a, i) -> named_struct('n', a.n + least(3, i - a.last), 'last', i),
        a -> a.n))[0])[0])[0]
"""
#: Lines with a word that equal an earlier line.
DUP_LINES = f"""
transform(array(filter(split(_t, '\\\\n'), x -> btrim(x, '{SPACE}') <> '')), l -> CAST(size(l) - size(array_distinct(l)) AS bigint))[0]
"""


@dataclass(frozen=True)
class Rule:
    """reject: SQL over _t (text), _w (words), _lines (lines with a word) and the base columns; true rejects."""

    name: str
    reject: str


#: Rules for texts that pass the base rules. Bounds are wide: a clean text of any language passes.
RULES = [
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > _n_lines"),
    Rule("few_letters", "5 * size(filter(_w, x -> x rlike '\\\\p{L}')) < 3 * n_words"),
    Rule("capitals", "2 * regexp_count(_t, '\\\\p{Lu}') > regexp_count(_t, '\\\\p{L}')"),
    Rule("ellipses", "10 * regexp_count(_t, '(\\\\.\\\\.\\\\.|\\u2026)[ \\\\t\\\\r]*(\\\\n|$)') > 4 * _n_lines"),
    Rule("bullets", "10 * regexp_count(_t, '(?m)^[ \\\\t]*[-*\\u2022\\u2023\\u25CF]') > 9 * _n_lines"),
]


def base_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its text's words and the counts that the rules build on."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    rows = rows.withColumn("_w", F.expr(WORDS))
    rows = rows.select(
        "*",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.expr("CAST(regexp_count(_t, '[#*$%&|<>]') AS bigint)").alias("n_symbols"),
        F.expr(DUP_LINES).alias("n_dup_lines"),
        F.expr(REPEATED).alias("n_repeat_words"),
        F.expr(f"CAST(size(filter(split(_t, '\\\\n'), x -> btrim(x, '{SPACE}') <> '')) AS bigint)").alias("_n_lines"),
    )
    return rows.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


#: How often a rule is evaluated on each row of the sample to time it.
REPEATS = 16


def order_rules(rows: DataFrame, rules: list[Rule], sample_rows: int = 1000, seed: int = 7) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) by share per second, from a sample of about sample_rows rows.

    The sample is drawn and written by the tasks that scan the table. A rule's cost is the time of a job that
    evaluates it REPEATS times on each row of the sample, less that of a job with a rule that costs nothing. The
    order decides how soon most bad rows are out, never which rows pass.
    """
    total = rows.count()
    if not total or len(rules) < 2:
        return [(r, 0.0, 0.0) for r in rules]
    part = rows.select("doc_id", "_t").sample(fraction=min(1.0, sample_rows / total), seed=seed)
    sample = materialise(base_metrics(part, "doc_id", "_t").drop("doc_id"), "sample")
    often = sample.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def measured(reject: str) -> tuple[float, float]:
        job = often.agg(F.count("*"), F.count_if(F.expr(f"({reject}) AND _k > 0")))
        began = time.perf_counter()
        n, bad = job.first()
        return time.perf_counter() - began, bad / max(n, 1)

    nothing = "n_words < 0"
    measured(nothing)  # the first job also starts what all share
    free = measured(nothing)[0]
    found = []
    for rule in rules:
        seconds, share = measured(rule.reject)
        found.append((rule, max(seconds - free, 1e-3), share))
    drop_table(sample)
    return sorted(found, key=lambda x: -(x[2] + 1e-6) / x[1])


def cascade(ordered: list[Rule]) -> Column:
    """True if no rule rejects; a rule is evaluated only where all before it passed."""
    kept = F.lit(True)
    for rule in reversed(ordered):
        kept = F.when(F.coalesce(F.expr(rule.reject), F.lit(False)), F.lit(False)).otherwise(kept)
    return kept


def quality_rules(
    docs: DataFrame, *, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 1000
) -> DataFrame:
    """Counts of every whole text and the verdict of the rules, one row for each row, without a shuffle.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.
    Base rules come first; a cascade of further rules judges what passes them. Each rule's cost and
    selectivity are measured on a sample of sample_rows rows and rules are ordered by rejection per cost.

    Null and empty texts have no words: every count is 0, base_failed is true, kept false. Null and
    repeated ids are passed on, equal rows get equal verdicts; an empty table gives no rows; other
    columns are not read. A very long text takes memory in proportion to its words, in one task.
    """
    rows = base_metrics(docs, id_col, text_col)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    ordered = [r for r, _, _ in order_rules(plain, rules, sample_rows)]
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(ordered)).alias("kept"),
    )


def keep_good(docs: DataFrame, *, rules: list[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that the base rules and the cascade keep."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col(text_col).alias("_t"))
    judged = quality_rules(whole, rules=rules, text_col="_t")
    return judged.where("kept").select(*[F.col(f"doc_id.`{c}`").alias(c) for c in docs.columns])


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)
), dup AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1
), rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM dup GROUP BY doc_id),
b AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines, t, w
  FROM d LEFT JOIN rep USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines
            OR 5 * len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) < 3 * n_words
            OR 2 * len(regexp_extract_all(t, '\p{Lu}')) > len(regexp_extract_all(t, '\p{L}'))
            OR 10 * len(regexp_extract_all(t, '(\.\.\.|…)[ \t\r]*(\n|$)')) > 4 * n_lines
            OR 10 * len(regexp_extract_all(t, '(?m)^[ \t]*[-*•‣●]')) > 9 * n_lines) AS kept
FROM b
"""
