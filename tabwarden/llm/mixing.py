"""Mix sources to target weights by systematic sampling.

Targets are words per source: weights share all words, no source gets over ``CAP`` times its own,
and what a source cannot take is shared again by weight. Each document then expects
``target / source_size`` copies. Within a source the expected copies are prefix-summed, one offset
is added, and a document is emitted once per whole number its stretch of the sum crosses.

Documents stand in order of size (to the top four bits), then of a hash, so that every range of
sizes gives its share. A prefix sum is cut into pieces of (source, size class, hash part): sums run
inside pieces, and pieces are chained over one row each. A source with a third of all rows, or many
documents of one size, is spread over many pieces. Expected copies are whole billionths, so sums do
not depend on their order and reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own, the last in order;
a source of size 0 has target 0 and emits nothing; repeated rows are separate documents; an empty
table gives an empty result; the plan holds only its own columns, ``emit`` returns the columns of
its input. The number of sources is that of a configuration: one row each passes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwarden.llm.quality_rules import SPACE

WEIGHTS = (5, 2, 1)
CAP = 3
UNIT = 1_000_000_000
SEED = "mix"


def size_of(text: Column) -> Column:
    """Words of a text."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source``, ``source_size`` in; ``weight``, ``target`` and whole billionths of copies a document added.

    Sources are put in order of size by weight. Going up, a source is full if its share of what the
    smaller ones left is at least its cap; the full ones come first. The rest share what is left.
    """
    ranked = sizes.withColumn("nr", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nr") % len(weights) + 1).cast("int"))
    rows = ranked.select("source", "source_size", weight.cast("decimal(38,0)").alias("weight"), F.col("source_size").cast("decimal(20,0)").alias("own"), "nr")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy((F.col("source_size") / F.col("weight").cast("double")), "nr")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        (F.sum("own").over(everything) - F.coalesce(F.sum(F.col("own") * cap).over(before), F.lit(0))).cast("decimal(24,0)").alias("left"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast("decimal(10,0)").alias("open"),
    )
    full = (F.col("own") * cap).cast("decimal(24,0)") * F.col("open") <= F.col("weight").cast("decimal(10,0)") * F.col("left")
    rows = rows.withColumn("full", full)
    spare = F.max(F.when(~F.col("full"), F.col("left"))).over(everything)
    shared = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    level = (F.col("weight").cast("double") * spare.cast("double")) / shared.cast("double")
    rows = rows.withColumn("target", F.when(F.col("full"), (F.col("source_size") * cap).cast("double")).otherwise(level))
    units = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long")
    return rows.select("source", "source_size", "target", units.alias("units"))


def _offset(source: Column, seed: str) -> Column:
    """The random offset of a source, in billionths: a hash of seed and source."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\u0000")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % UNIT


def plan(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: str = SEED, carry: Column | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` (words), for each document.

    ``carry``: a column of the input (a struct, for example) to pass along.
    """
    kept = [] if carry is None else [carry.alias("carry")]
    rows = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"), *kept)
    bits = F.length(F.bin("size"))
    rows = rows.withColumns({
        "class": (bits * 16 + F.call_function("shiftright", F.col("size"), F.greatest(bits - 4, F.lit(0)))).cast("int"),
        "hash": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
        "source_key": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")),
    })
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    sources = sources.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("source_key"), "source_size", "target", "units", _offset(F.col("source"), seed).alias("offset"))
    piece = ["source_key", "class", "part"]
    rows = rows.withColumn("part", F.substring("hash", 1, 2))
    pieces = rows.groupBy(*piece).agg(F.count(F.lit(1)).alias("n")).join(sources, "source_key")
    ahead = Window.partitionBy("source_key").orderBy("class", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum((F.col("n") * F.col("units")).cast("decimal(38,0)")).over(ahead), F.lit(0))
    pieces = pieces.withColumn("start", ((before + F.col("offset")) % UNIT).cast("long")).drop("offset", "n")
    nth = F.row_number().over(Window.partitionBy(*piece).orderBy("hash", "size", "tie"))
    # Pieces are few next to rows, but no bound on them is known: the planner chooses the join.
    summed = rows.join(pieces, piece).withColumn("end", F.col("start") + nth * F.col("units"))
    crossed = F.expr(f"end div {UNIT} - (end - units) div {UNIT}")
    return summed.select("doc_id", "size", "source_size", "target", crossed.alias("copies"), (crossed * F.col("size")).alias("taken"), *(["carry"] if kept else []))


def emit(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mixed documents: each row of the input as many times as its copies say, same columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    chosen = plan(docs, weights, cap, seed, whole).where("copies > 0")
    return chosen.select(F.explode(F.array_repeat("carry", F.col("copies").cast("int"))).alias("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("copies")


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS hash FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nr FROM s),
w AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][nr % {len(WEIGHTS)} + 1]::HUGEINT AS weight FROM r),
l AS (SELECT *, sum(source_size::HUGEINT) OVER () - coalesce(sum({CAP} * source_size::HUGEINT) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spare,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w WINDOW o AS (ORDER BY source_size::DOUBLE / weight::DOUBLE, nr)),
f AS (SELECT *, {CAP} * source_size::HUGEINT * open <= weight * spare AS is_full FROM l),
t AS (SELECT source, source_size, CASE WHEN is_full THEN ({CAP} * source_size)::DOUBLE
    ELSE (weight::DOUBLE * (max(CASE WHEN NOT is_full THEN spare END) OVER ())::DOUBLE) / (sum(CASE WHEN NOT is_full THEN weight END) OVER ())::DOUBLE END AS target FROM f),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE * {UNIT})::BIGINT ELSE 0 END AS units,
    ('0x' || substr(md5('{SEED}:' || coalesce(source, chr(0))), 1, 8))::BIGINT % {UNIT} AS off FROM t),
c AS (SELECT doc_id, size, hash, u.*, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) AS class
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source),
e AS (SELECT *, off::HUGEINT + units::HUGEINT * row_number() OVER (PARTITION BY source ORDER BY class, hash, size) AS upto FROM c)
SELECT doc_id, size, source_size, target, ((upto // {UNIT} - (upto - units) // {UNIT}) * size)::BIGINT AS taken FROM e
"""
