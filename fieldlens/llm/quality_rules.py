"""Line-first cleaning of documents with DataFrame functions only.

Every line is judged on its own: navigation bars, symbol and shouting noise, boilerplate phrases, and lines without any sentence mark. Failing
lines are removed; a document that loses more than ``max_loss`` of its word characters is rejected. Repeated lines are counted, not removed.
Document-level base rules (word count, share of repeated 3-word windows) come first.

Null and empty texts have no words and no lines, so the base rule on the word count rejects them. Documents with a null id are kept as rows.
Equal rows are judged separately and alike. Other columns pass through ``judge`` unless they bear the name of a result column, which wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
#: Fixed phrases of web boilerplate, matched without regard to case.
BOILERPLATE = (r"(?i)\b(accept (all )?cookies|cookie policy|privacy policy|terms of (use|service)|all rights reserved|enable javascript|"
               r"lorem ipsum|sign up for our newsletter|click here to|skip to (main )?content)\b")
NAVIGATION = r"^(?:[^|»>›·•]*[|»>›·•]){3}"
SENTENCE_MARK = r"[.!?:;…。！？؟।]"

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_chars", "clean_text")


def _length_without(text: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(text, kept, ""))


def line_fails(line: Column) -> Column:
    """True for a line that navigation, noise, boilerplate or punctuation rules remove. Lines without words never fail."""
    chars, symbols = F.length(line), _length_without(line, NOT_SYMBOL)
    shouts = F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))
    return (line.rlike(NAVIGATION) | (symbols * 20 > chars) | (shouts * 20 > chars) | line.rlike(BOILERPLATE)
            | ((chars > 40) & ~line.rlike(SENTENCE_MARK)))


def judge(docs: DataFrame, *, text: str = "text", min_words: int = 50, max_repeat_pct: int = 50, max_loss_pct: int = 50) -> DataFrame:
    """``docs`` with the measures of each text, ``base_failed``, ``kept`` and ``clean_text``, the lines that passed.

    ``n_repeat_words`` counts words inside a 3-word window that occurs twice or more in the text. Windows are sorted within the row, so
    the cost is n log n in the words of one document and there is no shuffle."""
    own = [c for c in docs.columns if c.lower() not in RESULT]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = docs.select(*[F.col(f"`{c}`") for c in own], F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("_words"),
                      F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"),
                      _length_without(body, NOT_SYMBOL).cast("long").alias("n_symbols"))
    out = out.select("*", F.size("_words").cast("long").alias("n_words"),
                     F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
                     (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                     F.sort_array(F.transform(F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))), lambda w, i: F.struct(
                         w.alias("a"), F.get("_words", i + 1).alias("b"), F.get("_words", i + 2).alias("c"), i.alias("i")))).alias("_sorted"))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    out = out.select("*", F.sort_array(F.transform(F.filter("_sorted", lambda x, j: same(x, F.get("_sorted", j - 1))
                                                            | same(x, F.get("_sorted", j + 1))), lambda x: x["i"])).alias("_at"))
    out = out.select("*", F.aggregate(F.transform("_at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - p, F.lit(3)))),
                                      F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"),
                     F.filter("_lines", lambda x: ~line_fails(x)).alias("_good"))
    out = out.select("*", _length_without(F.array_join("_good", "\n"), SPACE).cast("long").alias("kept_chars"),
                     F.array_join("_good", "\n").alias("clean_text"),
                     ((F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)).alias("base_failed"))
    kept = ~F.col("base_failed") & ((F.col("word_chars") - F.col("kept_chars")) * 100 <= F.col("word_chars") * max_loss_pct)
    return out.select(*[F.col(f"`{c}`") for c in own], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      kept.alias("kept"), "kept_chars", "clean_text")


def op8(docs: DataFrame) -> DataFrame:
    """The digest of every document."""
    return judge(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                       "base_failed", "kept")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT w.doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM w, unnest(range(1, len(ws) - 1)) AS r(i)),
p AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
n AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM p, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
l AS (SELECT doc_id, t, ls, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             list_filter(ls, lambda x: NOT (regexp_matches(x, '^(?:[^|»>›·•]*[|»>›·•]){3}')
               OR length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) * 20 > length(x)
               OR (length(x) - length(replace(x, '!!', ''))) * 20 > length(x)
               OR regexp_matches(x, '(?i)\b(accept (all )?cookies|cookie policy|privacy policy|terms of (use|service)|all rights reserved|enable javascript|lorem ipsum|sign up for our newsletter|click here to|skip to (main )?content)\b')
               OR (length(x) > 40 AND NOT regexp_matches(x, '[.!?:;…。！？؟।]')))) AS good FROM w),
b AS (SELECT l.*, coalesce(n.n, 0) AS n_repeat_words,
             length(regexp_replace(array_to_string(good, chr(10)), '[\x20\x09-\x0D]+', '', 'g')) AS kept_chars
      FROM l LEFT JOIN n ON l.doc_id = n.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND (word_chars - kept_chars) * 100 <= word_chars * 50 AS kept
FROM b
"""


def good_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected documents; of the others the lines that failed are gone. All columns stay, whatever their names."""
    # A column that is not deterministic keeps the filter above the steps; pushed down, it would repeat them for every word.
    judged = judge(docs.select(F.struct("*").alias("_row"), F.col("text"))).withColumn("_place", F.monotonically_increasing_id())
    judged = judged.filter(F.col("kept") & (F.col("_place") >= 0))
    cut = F.col("kept_chars") < F.col("word_chars")
    text = F.when(cut, F.col("clean_text")).otherwise(F.col("text"))
    new = {"text": text} | ({"n_chars": F.when(cut, F.length("clean_text")).otherwise(F.col("_row.n_chars")).cast("long")} if "n_chars" in docs.columns else {})
    return judged.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])
