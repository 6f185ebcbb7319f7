"""Line-first cleaning of documents, in DataFrame functions only.

Each line meets the line rules; failing lines are removed; a document that loses too much of its
text is rejected. Beside that verdict stand word statistics of the whole text.

Every row is judged alone, so nothing is shuffled and no key can be hot. Repeated three-word
windows are found by sorting short hashes of the windows of a document (a superset of the repeats),
then by comparing the words of those candidates; cost is n log n in the words of a document.

Defined cases: a null text counts as an empty one; an empty text has no words, fails the base rule
and is not kept; repeated rows give repeated results; columns other than ``doc_id`` and ``text``
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: A line fails ``navigation`` if it holds two of these separators.
NAVIGATION = r"(\||»|•)[^|»•]*(\||»|•)"
#: A line fails ``punctuation`` if it holds this many doubled marks after words, or closes no sentence.
DOUBLED = r"([!?#*$%&]{2,}[^!?#*$%&]*){3}"
CLOSED = r"[.!?…:;)\"'”»\]][\x20\x09-\x0D]*$"
#: A line fails ``boilerplate`` if it says one of these.
BOILERPLATE = (
    r"(?i)(cookie|privacy policy|terms of (use|service)|all rights reserved|enable javascript|subscribe now|"
    r"sign up for|log in to|click here|read more|share (this|on)|lorem ipsum|skip to content)"
)
MIN_WORDS = 50
#: A document is rejected when the kept lines hold under this share (percent) of its characters outside white space.
MIN_KEPT_PERCENT = 50


def _solid(text: Column) -> Column:
    """Code points outside white space."""
    return F.length(F.regexp_replace(text, SPACE, ""))


def line_fails(line: Column) -> Column:
    """Whether a line with words breaks a rule. Lines without words are dropped unjudged."""
    return line.rlike(NAVIGATION) | line.rlike(DOUBLED) | ~line.rlike(CLOSED) | line.rlike(BOILERPLATE)


def clean_lines(docs: DataFrame) -> DataFrame:
    """``doc_id``, the statistics, ``clean_text`` (kept lines) and the verdict ``kept``."""
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    split = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    split = split.select(
        "doc_id", "body", F.array_remove(F.split("body", SPACE, -1), "").alias("words"), F.filter(F.split("body", "\n", -1), has_word).alias("lines")
    )
    at = lambda i: F.get("words", i)
    low = F.lit(0x7FFFFFFF).cast("long")
    key = lambda i: F.shiftleft(F.xxhash64(at(i), at(i + 1), at(i + 2)), 31).bitwiseOR(i.cast("long"))
    keyed = split.withColumns({
        "keys": F.sort_array(F.when(F.size("words") > 2, F.transform(F.sequence(F.lit(0), F.size("words") - 3), key)).otherwise(F.array().cast("array<bigint>"))),
        "good": F.filter("lines", lambda x: ~line_fails(x)),
    })
    same = lambda x, i: F.shiftright(F.get("keys", i), 31) == F.shiftright(x, 31)
    keyed = keyed.withColumn("maybe", F.transform(
        F.filter("keys", lambda x, i: F.coalesce(same(x, i - 1), F.lit(False)) | F.coalesce(same(x, i + 1), F.lit(False))),
        lambda x: x.bitwiseAND(low).cast("int"),
    ))
    window = lambda p: F.struct(F.concat_ws(" ", at(p), at(p + 1), at(p + 2)).alias("w"), p.alias("p"))
    keyed = keyed.withColumn("windows", F.sort_array(F.transform("maybe", window)))
    equal = lambda x, i: F.coalesce(F.get("windows", i)["w"] == x["w"], F.lit(False))
    keyed = keyed.withColumn("starts", F.sort_array(F.transform(F.filter("windows", lambda x, i: equal(x, i - 1) | equal(x, i + 1)), lambda x: x["p"])))
    fresh = lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get("starts", i - 1), F.lit(-3)))
    n_words, repeats = F.size("words").cast("long"), F.col("n_repeat_words")
    out = keyed.select(
        "doc_id",
        n_words.alias("n_words"),
        _solid(F.col("body")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(F.transform("starts", fresh), F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
        F.array_join("good", "\n").alias("clean_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("good").cast("long").alias("n_kept_lines"),
    )
    out = out.withColumn("kept_chars", _solid(F.col("clean_text")).cast("long"))
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * repeats > 50 * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (100 * F.col("kept_chars") >= MIN_KEPT_PERCENT * F.col("word_chars")))


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_kept_lines", "kept_chars", "base_failed", "kept")


def query(spark, sf_dir: str) -> DataFrame:
    return clean_lines(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(*COLUMNS)


_SOLID = "length(regexp_replace({}, '[\\x20\\x09-\\x0D]+', '', 'g'))"
_BAD = " OR ".join(f"regexp_matches(x, {chr(39)}{p.replace(chr(39), chr(39) * 2)}{chr(39)})" for p in (NAVIGATION, DOUBLED, BOILERPLATE))
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (SELECT rid, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS win FROM d, unnest(generate_series(1, len(words) - 2)) AS u(p)),
r AS (SELECT rid, p, p - coalesce(lag(p) OVER (PARTITION BY rid ORDER BY p), -5) AS gap
  FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, win) AS n FROM w) WHERE n > 1),
rep AS (SELECT rid, sum(least(3, gap)) AS n FROM r GROUP BY rid),
j AS (SELECT *, list_filter(lines, lambda x: NOT ({_BAD} OR NOT regexp_matches(x, '{CLOSED.replace("'", "''")}'))) AS good FROM d),
s AS (SELECT rid, doc_id, len(words)::BIGINT AS n_words, {_SOLID.format('body')}::BIGINT AS word_chars,
    (length(body) - length(translate(body, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines, len(good)::BIGINT AS n_kept_lines,
    {_SOLID.format("coalesce(array_to_string(good, chr(10)), '')")}::BIGINT AS kept_chars FROM j),
t AS (SELECT s.*, coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM s LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM t)
SELECT {', '.join(COLUMNS[:-1])}, NOT base_failed AND 100 * kept_chars >= {MIN_KEPT_PERCENT} * word_chars AS kept FROM b
"""
