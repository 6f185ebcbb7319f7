"""How five document filters interact: every order of application, step by step.

A document's failures are a mask of five bits. Documents are counted into cells of (part, mask), at
most 32 a part; all orders are then worked out from the cells. A recursive query extends each filter
prefix by a filter not used so far, joins the part's mask cells, carries the bits applied, and gives
the step's figures at each level: 325 prefixes a part stand for the 600 steps of the 120 orders.

Only doc_id, part, mask and a SHA-256 of the text are shuffled. A document fails ``E`` if a smaller
``doc_id`` has its text: each text's least id is aggregated inside tasks first, so a text with many
copies is a few rows before it meets in one place; so are repeated rows before labels are joined.

Defined cases: a null text is an empty one, a null source the part ''; a null ``doc_id`` neither fails
``E`` nor makes others fail; equal ids with equal text don't fail each other; repeated rows count
again; an id with several labels is good (toxic) if any of them says so; labels of null ids and
null labels count for nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwarden.functions import sizing

SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "[#$%&*|]"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 50, 65, 5
FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def text_mask(body: Column) -> Column:
    """Bits of the filters A to D that a text fails; the first filter is the lowest bit."""
    words = F.array_remove(F.split(body, SPACE, -1), "")
    size, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(body) - F.length(F.translate(body, CAPITALS, ""))
    fails = (size < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * size, 100 * capitals > MAX_CAPITAL_PERCENT * F.length(body), body.rlike(MARKS))
    return sum((F.when(x, 1 << k).otherwise(0) for k, x in enumerate(fails)), F.lit(0))


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask``, ``n``, ``good``, ``toxic``: documents, and those labelled good or toxic."""
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text_mask(body).alias("mask"), F.unhex(F.sha2(body, 256)).alias("same"))
    rows = rows.groupBy("doc_id", "part", "mask", "same").agg(F.count(F.lit(1)).alias("n"))
    told = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    named = rows.where("doc_id IS NOT NULL").join(told, "doc_id", "left").select(
        "doc_id", "part", "mask", "same", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    # Of each text, part and label: all rows, and those of the least id. The mask depends on the text.
    grouped = named.groupBy("same", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("least"))
    grouped = sizing.cut_lineage(grouped, "audit_texts")
    first = grouped.groupBy("same").agg(F.min("least.doc_id").alias("first"))
    split = grouped.join(first, "same").withColumn("own", F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0))
    copy = 1 << FILTERS.index("E")
    cells = split.select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("own").alias("n")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("own")).alias("n"))
    )).alias("cell")).select("part", "good", "toxic", "cell.*")
    unnamed = rows.where("doc_id IS NULL").select("part", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "mask", "n")
    return cells.unionByName(unnamed).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def _sum(counts: str, condition: str) -> str:
    """Documents of the cells whose mask ``m`` meets the condition."""
    return f"aggregate(sequence(0, {(1 << len(FILTERS)) - 1}), CAST(0 AS BIGINT), (a, m) -> a + IF({condition}, {counts}[m], 0))"


_LETTERS = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << k})" for k, x in enumerate(FILTERS))
_HERE, _GONE = "(m & bit) <> 0 AND (m & applied) = 0", "(m & bit) <> 0 AND (m & applied) <> 0"
WALK = f"""
WITH RECURSIVE walk(part, prefix, letter, step, bits, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
  SELECT part, '', '', 0, 0, {_sum('n', 'true')}, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM {{cells}}
  UNION ALL
  SELECT part, concat(prefix, letter), letter, step + 1, applied | bit,
    {_sum('n', '(m & (applied | bit)) = 0')}, {_sum('n', _HERE)}, {_sum('n', _GONE)}, {_sum('n', 'm = bit')}, {_sum('good', _HERE)}, {_sum('toxic', _HERE)}
  FROM (
    SELECT w.part, w.prefix, w.step, w.bits AS applied, c.n, c.good, c.toxic, next.letter, next.bit
    FROM walk w JOIN {{cells}} c ON w.part = c.part
      LATERAL VIEW explode(filter(array({_LETTERS}), f -> (f.bit & w.bits) = 0)) AS next
  )
)
SELECT part, prefix, letter, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost FROM walk WHERE step > 0
"""


def prefix_steps(cells: DataFrame) -> DataFrame:
    """One row per part and filter prefix, with the figures of its last step."""
    spark = cells.sparkSession
    filled = lambda x: F.transform(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1)), lambda m: F.coalesce(F.col("by_mask")[m][x], F.lit(0)))
    wide = cells.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("by_mask"))
    wide = sizing.cut_lineage(wide.select("part", *(filled(x).alias(x) for x in ("n", "good", "toxic"))), "audit_cells")
    limit = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")  # 325 rows a part, however many parts there are
    try:
        return sizing.cut_lineage(spark.sql(WALK, cells=wide), "audit_steps")
    finally:
        spark.conf.set(_ROW_LIMIT, limit)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``filter_order``, ``step`` and the figures of that step, for every order of the filters."""
    steps = prefix_steps(sizing.cut_lineage(mask_cells(docs, labels), "audit_masks"))
    n = len(FILTERS)
    orders = steps.where(F.col("step") == n).select("part", F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    orders = orders.withColumn("prefix", F.col("filter_order").substr(F.lit(1), F.col("step")))
    rows = orders.join(steps.drop("step"), ["part", "prefix"])
    total = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return rows.join(total, ["part", "letter"]).select("part", "filter_order", "step", *COUNTS)


def query(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS words FROM documents),
told AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(words) < {MIN_WORDS} THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * (length(body) - length(translate(body, '{CAPITALS}', ''))) > {MAX_CAPITAL_PERCENT} * length(body) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(body, '{MARKS}') THEN 8 ELSE 0 END)
    + (CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END) AS mask
  FROM d LEFT JOIN told ON d.doc_id = told.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT chr(65 + k::INT) AS letter, (1 << k)::BIGINT AS bit FROM range({len(FILTERS)}) AS r(k)),
o AS (SELECT '' AS filter_order, 0::BIGINT AS bits UNION ALL SELECT filter_order || letter, bits | bit FROM o, f WHERE (bits & bit) = 0),
s AS (
  SELECT filter_order, step::INT AS step, 1::BIGINT << (ascii(filter_order[step]) - 65) AS bit,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1::BIGINT << (ascii(filter_order[i]) - 65))), 0)::BIGINT AS applied
  FROM o, range(1, {len(FILTERS) + 1}) AS r(step) WHERE length(filter_order) = {len(FILTERS)}),
t AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN (mask & (applied | bit)) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & applied) = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM t
"""
