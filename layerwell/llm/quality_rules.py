"""Quality rules: line-first cleaning.

Every line that holds a word is judged by itself: boilerplate (stock phrases of
licences, cookie and copyright notices, or a line the document already had),
navigation (a row of short items between separators), symbols (mostly marks
instead of words), shouting (capital words ending in exclamation marks), and
punctuation (a longer line in which no sentence ends). Failing lines are
removed; a document that thereby loses too much of its text is rejected.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerwell.llm.common import WHITE_SPACE, batch_of, columns, gram_hashes, mapped

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
MAX_LOST = 30  # per cent of the code points in words
LONG_LINE = 8  # more words than this must hold the end of a sentence

# Fixed values. The patterns are kept to what both Python's and RE2's syntax allow.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
SENTENCE_END = ".!?…:;\"'”’»)]" + "。！？；：」』）．" + "।॥" + "؟۔؛" + "։" + "።፧" + "។" + "။"
BOILERPLATE = (
    r"licen[sc]ed under|apache license|mit license|creative commons|all rights reserved|copyright \(c\)|©"
    r"|terms of (use|service)|privacy policy|cookie policy|we use cookies|accept (all )?cookies"
    r"|enable javascript|sign up for|subscribe to our|click here|lorem ipsum|log in to"
)
_BOILERPLATE = re.compile(BOILERPLATE)


# What str.split() takes for white space besides WHITE_SPACE.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACES = re.compile("[" + WHITE_SPACE + "]+")


def split_words(text: str) -> list[str]:
    """Words between ASCII white space."""
    if _OTHER_SPACE.search(text):
        return [w for w in _SPACES.split(text) if w]
    return text.split()


def line_verdict(line: str, words: list[str], chars: int, earlier: bool) -> str | None:
    """Why a line with words (of ``chars`` code points) is removed, or None."""
    low = line.lower()
    if earlier or _BOILERPLATE.search(low):
        return "boilerplate"
    if sum(map(words.count, SEPARATORS)) * 4 > len(words):
        return "navigation"
    if sum(map(line.count, SYMBOLS)) * 8 > chars:
        return "symbols"
    if line.count("!") * 2 > len(words) and line == line.upper() and line != low:
        return "shouting"
    if len(words) > LONG_LINE and not any(w[-1] in SENTENCE_END for w in words):
        return "punctuation"
    return None


def repeated_words(words: list[str]) -> int:
    """Words inside runs of three words that occur more than once."""
    if len(words) < 4:
        return 0
    # hash() is salted, but these hashes never leave the process.
    grams = gram_hashes(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), 3)
    _, which, counts = np.unique(grams, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def clean(text: str | None) -> tuple[dict, str]:
    """Measures and verdict of one text, and the text without failing lines."""
    text = text or ""
    words, kept, seen, dup_lines, chars, lost, removed = [], [], set(), 0, 0, 0, 0
    for line in text.split("\n"):
        why = None
        if own := split_words(line):
            size = sum(map(len, own))
            earlier = line in seen
            why = line_verdict(line, own, size, earlier)
            seen.add(line)
            words += own
            dup_lines += earlier
            chars += size
        if why:
            removed += 1
            lost += size
        else:
            kept.append(line)
    repeated = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED * len(words)
    row = {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
        "base_failed": failed,
        "kept": not failed and 100 * lost <= MAX_LOST * chars,
        "n_lines_removed": removed,
        "lost_chars": lost,
    }
    return row, "\n".join(kept)


MEASURES = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
    "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean",
    "n_lines_removed": "long", "lost_chars": "long",
}
_ARROW = {"long": pa.int64(), "boolean": pa.bool_()}


def judge_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the measures, base_failed and kept, n_lines_removed and
    lost_chars. Null and empty texts have no words and fail; no row is dropped.
    Lines are compared as they are, so two lines that differ in spaces differ.
    Rows may repeat; other columns are ignored."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [clean(t)[0] for t in batch.column("text").to_pylist()]
        return batch_of(
            ["doc_id", *MEASURES],
            [batch.column("doc_id"), *([r[c] for r in rows] for c in MEASURES)],
            [None, *(_ARROW[t] for t in MEASURES.values())],
        )

    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return mapped(rows, step, "doc_id long, " + ", ".join(f"{c} {t}" for c, t in MEASURES.items()))


def clean_documents(docs: DataFrame) -> DataFrame:
    """The kept documents without their failing lines, with all their columns;
    n_chars, where there is one, is the length of what is left."""
    names = docs.columns
    text_at = names.index("text")
    count_at = names.index("n_chars") if "n_chars" in names else None

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        done = [clean(t) for t in batch.column(text_at).to_pylist()]
        chosen = [i for i, (row, _) in enumerate(done) if row["kept"]]
        if not chosen:
            return None
        left = [done[i][1] for i in chosen]
        arrays = list(batch.take(pa.array(chosen)).columns)
        arrays[text_at] = pa.array(left, batch.schema.field(text_at).type)
        if count_at is not None:
            arrays[count_at] = pa.array([len(t) for t in left]).cast(batch.schema.field(count_at).type)
        return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return mapped(docs, step, docs.schema)


def _sql_list(text: str) -> str:
    return "[" + ", ".join("'" + c.replace("'", "''") + "'" for c in text) + "]"


_SPLIT = "list_filter(regexp_split_to_array({0}, '[ \\x09-\\x0D]+'), lambda w: w <> '')"


def _count(column: str, marks: str) -> str:
    return f"(length({column}) - length(translate({column}, '{marks}', '')))"


ORACLE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body,
         {_SPLIT.format("coalesce(text, '')")} AS words
  FROM documents
), grams AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM docs)
), twice AS (
  SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1
), repeats AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid
), lines AS (
  SELECT rid, n, line, {_SPLIT.format("line")} AS own,
         row_number() OVER (PARTITION BY rid, line ORDER BY n) > 1 AS earlier
  FROM (SELECT rid, unnest(string_split(body, chr(10))) AS line,
               generate_subscripts(string_split(body, chr(10)), 1) AS n FROM docs)
), judged AS (
  SELECT rid, earlier, list_sum(list_transform(own, lambda w: length(w))) AS chars,
         earlier OR regexp_matches(lower(line), '{BOILERPLATE}')
         OR len(list_filter(own, lambda w: list_contains({_sql_list(SEPARATORS)}, w))) * 4 > len(own)
         OR {_count("line", SYMBOLS)} * 8 > list_sum(list_transform(own, lambda w: length(w)))
         OR ({_count("line", "!")} * 2 > len(own) AND line = upper(line) AND line <> lower(line))
         OR (len(own) > {LONG_LINE} AND len(list_filter(own,
             lambda w: list_contains({_sql_list(SENTENCE_END)}, right(w, 1)))) = 0) AS fails
  FROM lines WHERE len(own) > 0
), per_doc AS (
  SELECT rid, sum(earlier::INT) AS dups, sum(fails::INT) AS removed,
         coalesce(sum(chars) FILTER (fails), 0) AS lost
  FROM judged GROUP BY rid
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         {_count("body", SYMBOLS)}::BIGINT AS n_symbols,
         coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         coalesce(removed, 0)::BIGINT AS n_lines_removed, coalesce(lost, 0)::BIGINT AS lost_chars
  FROM docs LEFT JOIN repeats USING (rid) LEFT JOIN per_doc USING (rid)
)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)
       AND 100 * lost_chars <= {MAX_LOST} * word_chars AS kept
FROM measured
"""
