"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import WORD, documents, query, words, written

#: Rows on which cost and selectivity of the rules are measured; only the order depends on them.
SAMPLE_ROWS = 2000
#: Words in a window that counts as repeated.
WINDOW = 8

#: A document is rejected if any of these holds: SQL over the text and the columns of ``measures``.
RULES: dict[str, str] = {
    # Symbols: one for every two words.
    "symbols": "2 * n_symbols > n_words",
    # Shouting: more than half of the letters are capitals.
    "capitals": r"2 * regexp_count(text, r'\p{Lu}') > regexp_count(text, r'\p{L}')",
    # Exclamation marks: at the end of more than a third of the words.
    "exclaimed": r"3 * regexp_count(text, r'!(?=[\x20\x09-\x0D]|$)') > n_words",
    # No prose: words with a letter are less than two thirds.
    "letters": r"3 * regexp_count(text, r'[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*') < 2 * n_words",
    # Word length: shorter than 2 or longer than 20 characters on average.
    "word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
    # Stuttering: more than a third of the words equal the next one.
    "stutter": "3 * n_stutters > n_words",
    # Lines that stand there again: more than a third.
    "repeated_lines": r"3 * n_dup_lines > regexp_count(text, r'\n') + 1",
}


def _repeat_words(of: str) -> list[tuple[str, str]]:
    """Words covered by windows of 8 words that occur again in the text (SQL over array ``of``).

    Window hashes come from pairs of pairs of word hashes.  A text without equal windows is
    settled by comparing counts; only others sort their windows to find where the equal ones are.
    """
    at = "get({0}, cast(i + {1} as int))"

    def paired(name: str, step: int, reach: int) -> str:
        both = f"{at.format(name, 0)}, {at.format(name, step)}"
        return (
            f"if(size({of}) < {reach}, array(), "
            f"transform(sequence(0, greatest(size({of}) - {reach}, 0)), i -> xxhash64({both})))"
        )

    return [
        ("_h1", f"transform({of}, w -> xxhash64(w))"),
        ("_h2", paired("_h1", 1, 2)),
        ("_h4", paired("_h2", 2, 4)),
        ("_h8", paired("_h4", 4, WINDOW)),
        (
            "_again",
            "if(size(array_distinct(_h8)) = size(_h8), cast(null as array<struct<h:bigint,i:int>>), "
            "array_sort(transform(_h8, (h, i) -> struct(h as h, i as i))))",
        ),
        (
            "_starts",
            "array_sort(transform(filter(_again, (x, j) -> "
            "(j > 0 and get(_again, j - 1).h = x.h) or get(_again, j + 1).h = x.h), x -> x.i))",
        ),
        (
            "n_repeat_words",
            f"coalesce(aggregate(_starts, struct(cast(0 as bigint) as n, -{WINDOW} as last), "
            f"(a, p) -> struct(a.n + least({WINDOW}, p - a.last) as n, p as last), a -> a.n), 0L)",
        ),
    ]


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts that the rules use.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with
    a word that equal an earlier one), ``n_stutters`` (words equal to the next one), ``n_repeat_words`` (words in 8-word windows found twice or
    more) and ``base_failed`` (fewer than 20 words, or over 30 % of them repeated).  A null text
    has no words.  Columns of ``df`` with these names are replaced.
    """
    made = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    made = made.withColumn("_words", words(F.col("_text")))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    made = made.withColumn("_lines", lines)
    for name, sql in _repeat_words("_words"):
        made = made.withColumn(name, F.expr(sql))
    made = made.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_stutters": F.size(F.expr("filter(_words, (w, i) -> w = get(_words, i + 1))")),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    dropped = ["_text", "_words", "_lines", "_h1", "_h2", "_h4", "_h8", "_again", "_starts"]
    return made.withColumn("base_failed", failed).drop(*dropped)


def rule_order(measured: DataFrame, rules: Mapping[str, str], rows: int) -> list[str]:
    """Names of the rules, the one with most rejections per second of a sample first.

    The sample (at most ``rows`` rows) is written once; each rule's time is that of its own pass
    over it.  Order changes the time of the cascade, never its verdict.
    """
    sample = written(measured.limit(rows), "rule-sample")
    sample.count()

    def timed(rule: Column) -> tuple[float, int]:
        began = time.perf_counter()
        hits = sample.agg(F.count_if(rule).alias("n")).first()["n"]
        return time.perf_counter() - began, hits

    idle = min(timed(F.lit(False))[0] for _ in range(2))
    gain = {}
    for name, rule in rules.items():
        seconds, hits = timed(F.expr(rule))
        gain[name] = hits / max(seconds - idle, 1e-3)
    return sorted(rules, key=lambda name: (-gain[name], name))


def cascade(rules: Sequence[Column]) -> Column:
    """True if no rule rejects; a rule is evaluated only if none before it rejected."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(rule, F.lit(False)).otherwise(verdict)
    return verdict


def quality_rules(
    df: DataFrame, rules: Mapping[str, str] = RULES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``df`` with the measures and ``kept``: not ``base_failed`` and rejected by no rule.

    Rules see the column ``text``; a rule that is null does not reject.  Texts that are null or
    empty fail by their number of words.  An empty table gives an empty result.
    """
    fields = measures(df)
    order = rule_order(fields, rules, sample_rows)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade([F.expr(rules[n]) for n in order]))
    return fields.withColumn("kept", kept)


OP1_COLUMNS = [
    "doc_id",
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "kept",
]

OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT rid, i, array_to_string(w[i:i+7], ' ') AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
again AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, s) AS n FROM win) WHERE n > 1),
gaps AS (
  SELECT rid, least(8, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), 8)) AS g FROM again),
rep AS (SELECT rid, sum(g)::BIGINT AS n FROM gaps GROUP BY rid),
m AS (
  SELECT doc_id, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_stutters,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR 2 * n_symbols > n_words
    OR 2 * len(regexp_extract_all(text, '\p{Lu}')) > len(regexp_extract_all(text, '\p{L}'))
    OR 3 * (len(regexp_extract_all(text, '![\x20\x09-\x0D]')) + regexp_matches(text, '!$')::INT) > n_words
    OR 3 * len(regexp_extract_all(text, '[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*')) < 2 * n_words
    OR 3 * n_stutters > n_words
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 3 * n_dup_lines > len(regexp_extract_all(text, '\n')) + 1) AS kept
FROM b
"""

@query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark, folder):
    """Measures and verdict of every document."""
    return quality_rules(documents(spark, folder)).select(*OP1_COLUMNS)
