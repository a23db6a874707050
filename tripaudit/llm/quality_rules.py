"""Line-first quality rules (operator 4).

Every line that has a word is judged by punctuation, navigation and
boilerplate rules. Failing lines are removed, and a document that loses more
than half of its line characters is rejected, as is one that fails the base
rules (too few words, or too many of them in repeated windows).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
#: Base rules: fewest words; window of words; largest share of words in repeated windows, in percent.
LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30
#: A line needs an end of a sentence somewhere; written alike for Python and RE2.
SENTENCE = r"""[.!?\x{2026}][)\]"'\x{201D}\x{00BB}]*([\x20\x09-\x0D]|$)"""
#: Separators of menus, between blanks.
SEPARATOR = r"[\x20\x09][|>\x{00BB}\x{203A}\x{2022}][\x20\x09]"
BOILERPLATE = (
    r"(?i)(all rights reserved|privacy policy|terms of (use|service)|cookie policy|we use cookies|accept cookies|enable javascript"
    r"|javascript is (disabled|required)|subscribe to our newsletter|sign up for our newsletter|share this (article|page|post)|skip to (main )?content|powered by)"
)
#: Least counts before a line counts as symbols, shouting or a menu; and words for each of them.
LEAST_MARKS, LEAST_SEPARATORS, WORDS_PER_MARK, WORDS_PER_SEPARATOR = 5, 3, 4, 5
#: A document is rejected if more than this percentage of its line characters goes.
MOST_REMOVED = 50


def _python(pattern: str) -> re.Pattern:
    return re.compile(re.sub(r"\\x\{([0-9A-F]{4})\}", r"\\u\1", pattern))


_SENTENCE, _SEPARATOR, _BOILERPLATE = map(_python, (SENTENCE, SEPARATOR, BOILERPLATE))
_EDGE = SPACE


def failed_rule(line: str) -> str | None:
    """The first rule that a line (trimmed, with a word) fails, or None."""
    if not _SENTENCE.search(line):
        return "punctuation"
    n = len(line.encode().split())
    symbols, shouts = sum(map(line.count, SYMBOLS)), line.count("!!")
    if symbols >= LEAST_MARKS and WORDS_PER_MARK * symbols > n or shouts >= LEAST_MARKS and WORDS_PER_MARK * shouts > n:
        return "punctuation"
    menu = len(_SEPARATOR.findall(line))
    if menu >= LEAST_SEPARATORS and WORDS_PER_SEPARATOR * menu > n:
        return "navigation"
    return "boilerplate" if _BOILERPLATE.search(line) else None


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text, the first included."""
    grams = list(zip(*(words[k:] for k in range(window)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    count = Counter(grams)
    total, end = 0, 0
    for at, gram in enumerate(grams):
        if count[gram] > 1:
            total += at + window - max(at, end)
            end = at + window
    return total


def judge(text: str | None) -> dict:
    """Base counts, the verdict and the cleaned text of one document."""
    text = "" if text is None else text
    words = text.encode().split()
    lines = text.split("\n")
    seen: set[str] = set()
    kept, dup, chars, gone = [], 0, 0, Counter()
    for line in lines:
        bare = line.strip(_EDGE)
        if not bare:
            kept.append(line)
            continue
        dup += line in seen
        seen.add(line)
        chars += len(bare)
        if rule := failed_rule(bare):
            gone[rule] += len(bare)
        else:
            kept.append(line)
    n, repeats, removed = len(words), repeated_words(words), sum(gone.values())
    base = n < LEAST_WORDS or 100 * repeats > MOST_REPEATED * n
    return {
        "n_words": n, "word_chars": len(text) - sum(map(text.count, SPACE)), "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": dup, "n_repeat_words": repeats,
        "base_failed": base, "kept": not base and 100 * removed <= MOST_REMOVED * chars, "line_chars": chars, "removed_chars": removed, "clean_text": "\n".join(kept),
    }


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, line_chars long, removed_chars long"


def line_rules(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, the counts and verdicts, and clean_text if asked for.

    A null text has no words: it fails the base rules and its clean text is
    empty. Repeated rows are judged alike; other columns are ignored; empty
    input gives no rows. A document without lines loses nothing.
    """
    fields = f"{COUNTS}, clean_text string" if with_text else COUNTS
    names = [x.split()[0] for x in fields.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    types = [kinds[x.split()[1]] for x in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([x[c] for x in found], k) for c, k in zip(names, types, strict=True))], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {fields}")


#: DuckDB: the same for the columns of the contract.
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
grams AS (
  SELECT rid, unnest(range(1, len(ws) - {WINDOW - 2})) AS p, ws FROM w WHERE len(ws) >= {WINDOW}
), texts AS (SELECT rid, p, array_to_string(ws[p : p + {WINDOW - 1}], ' ') AS g FROM grams),
rep AS (SELECT rid, p FROM texts QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT q) AS n_repeat_words FROM (SELECT rid, unnest(range(p, p + {WINDOW})) AS q FROM rep) GROUP BY rid),
lines AS (
  SELECT rid, i, line, regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS bare
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
), marked AS (
  SELECT *, len(regexp_extract_all(bare, '[^\x20\x09-\x0D]+')) AS n, len(regexp_extract_all(bare, '[#*$%&|<>]')) AS symbols, len(regexp_extract_all(bare, '!!')) AS shouts,
    len(regexp_extract_all(bare, '{SEPARATOR}')) AS menu, row_number() OVER (PARTITION BY rid, line ORDER BY i) > 1 AS dup
  FROM lines WHERE bare <> ''
), judged AS (
  SELECT rid, dup, length(bare) AS chars,
    NOT regexp_matches(bare, '{SENTENCE.replace("'", "''")}') OR (symbols >= {LEAST_MARKS} AND {WORDS_PER_MARK} * symbols > n) OR (shouts >= {LEAST_MARKS} AND {WORDS_PER_MARK} * shouts > n)
    OR (menu >= {LEAST_SEPARATORS} AND {WORDS_PER_SEPARATOR} * menu > n) OR regexp_matches(bare, '{BOILERPLATE}') AS bad
  FROM marked
), by_doc AS (
  SELECT rid, count(*) FILTER (dup) AS n_dup_lines, sum(chars) AS line_chars, coalesce(sum(chars) FILTER (bad), 0) AS removed_chars FROM judged GROUP BY rid
), counted AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(coalesce(line_chars, 0) AS BIGINT) AS line_chars, CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars
  FROM d JOIN w USING (rid) LEFT JOIN by_doc USING (rid) LEFT JOIN covered USING (rid)
)
SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND 100 * removed_chars <= {MOST_REMOVED} * line_chars AS kept
FROM counted
"""
