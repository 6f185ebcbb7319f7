"""Rules over urls, looked up in a Bloom filter cascade, in DataFrame functions only.

A cascade holds a list of keys exactly, for one universe of keys. Level 1 is a Bloom filter of the
listed keys; level 2 holds the unlisted keys that level 1 lets through; level 3 the listed keys that
level 2 lets through; and so on until a level lets nothing through. Over that universe the answer is
exact, and asking it takes a few bit tests on literals: no join, no shuffle.

The universe is every key that some url of the corpus can ask for: each host suffix at a dot, with
each path prefix as long as some rule's path; and each label of a host. It is aggregated map-side
(a host with a third of the pages is one key per task) and written to the shared folder.

Filter sizes follow the list and grow only with the logarithm of the universe. They are checked
against ``MAX_FILTER_BYTES`` before they become literals; a longer list raises.

Defined cases: null urls and urls without ``://`` have an empty host and path and match nothing;
an empty path matches no rule that has one; repeated rows give repeated results; further columns
are ignored; an empty table or an empty list gives filters that hold nothing.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwarden.functions import sizing

#: (verdict, rule): host, then the start of the path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Host labels that are blocked where no rule fits.
BLOCKED_LABELS = ("adult-x", "free-bets", "casino", "free-casino", "xxx", "warez")
MAX_FILTER_BYTES = 64 << 20


@dataclass(frozen=True)
class Level:
    seed: int
    bits: int
    hashes: int
    words: tuple[int, ...]


def _positions(key: Column, seed: int, bits: int, hashes: int) -> list[Column]:
    """Bit positions of a key; every level hashes the key anew, so no two keys collide at all levels."""
    return [F.pmod(F.xxhash64(F.lit(seed * 64 + i), key), F.lit(bits)) for i in range(hashes)]


def contains(level: Level, key: Column) -> Column:
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")  # folded to one literal
    hit = lambda p: F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(63).cast("int")) == 1
    found = F.lit(True)
    for p in _positions(key, level.seed, level.bits, level.hashes):
        found = found & hit(p)
    return found


def member(levels: list[Level], key: Column) -> Column:
    """Exact membership over the universe: the first level that misses decides, by its parity."""
    answer = F.lit(len(levels) % 2 == 1)
    for depth in range(len(levels), 0, -1):
        answer = F.when(contains(levels[depth - 1], key), answer).otherwise(F.lit(depth % 2 == 0))
    return answer


def _level(keys: DataFrame, n: int, seed: int, fpp: float) -> Level:
    """One Bloom filter of ``n`` keys. Only its words (bits / 64 of them) reach the driver."""
    hashes = max(1, round(math.log2(1 / fpp)))
    bits = 64 * math.ceil(max(1, n) * math.log2(math.e) * math.log2(1 / fpp) / 64)
    if bits > 8 * MAX_FILTER_BYTES:
        raise ValueError(f"a filter of {n} keys needs {bits // 8} bytes; the limit is {MAX_FILTER_BYTES}: split the list")
    spots = keys.select(F.explode(F.array(*_positions(F.col("key"), seed, bits, hashes))).alias("p"))
    rows = spots.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int"))).alias("m")).collect()
    words = [0] * (bits // 64)
    for w, m in rows:
        words[w] = m
    return Level(seed, bits, hashes, tuple(words))


def build(universe: DataFrame) -> list[Level]:
    """Cascade over a stored table of distinct ``key`` and ``listed``."""
    sizes = dict(universe.groupBy("listed").count().collect())
    holds, others = universe.where("listed"), universe.where("NOT listed")
    n, rest = sizes.get(True, 0), sizes.get(False, 0)
    if not n:
        return []
    levels: list[Level] = []
    fpp = min(0.5, n / (math.sqrt(2) * max(1, rest)))
    while n:
        levels.append(_level(holds, n, len(levels) + 1, fpp))
        holds, others = others.where(contains(levels[-1], F.col("key"))), holds
        n, fpp = holds.count(), 0.5
    return levels


def split_url(pages: DataFrame) -> DataFrame:
    """``page_id``, ``host`` (A-Z lower-cased), ``path``."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    parts = pages.select("page_id", rest.alias("rest"))
    parts = parts.select("page_id", F.regexp_extract("rest", r"^[^/?#]*", 0).alias("raw"), F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))
    return parts.select("page_id", F.translate("raw", string.ascii_uppercase, string.ascii_lowercase).alias("host"), "path")


def _labels() -> Column:
    return F.split("host", r"\.")


def candidates(rules) -> Column:
    """Rule keys a url can match, best first: longest key, then longest host."""
    lengths = sorted({len(r) - len(r.split("/")[0]) for _, r in rules})
    suffix = lambda i: F.array_join(F.slice(_labels(), i, F.size(_labels())), ".")
    hosts = F.transform(F.sequence(F.lit(1), F.size(_labels())), lambda i: suffix(i))
    keys = lambda h: F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")),
        lambda n: F.struct((F.length(h) + n).alias("size"), F.length(h).alias("host_size"), F.concat(h, F.expr("path").substr(F.lit(1), n)).alias("key")),
    )
    return F.transform(F.sort_array(F.flatten(F.transform(hosts, keys)), asc=False), lambda x: x["key"])


def _stored_universe(asked: DataFrame, listed: list[str], name: str) -> DataFrame:
    keys = asked.select(F.explode("asked").alias("key")).distinct()
    wanted = asked.sparkSession.createDataFrame([(k,) for k in sorted(set(listed))], "listed_key string")
    marked = keys.join(wanted, keys["key"] == wanted["listed_key"], "left")
    return sizing.cut_lineage(marked.select("key", F.col("listed_key").isNotNull().alias("listed")), name)


def judge(pages: DataFrame, rules=RULES, blocked_labels=BLOCKED_LABELS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null where none fits), ``verdict``."""
    urls = split_url(pages).withColumn("asked", candidates(rules) if rules else F.array().cast("array<string>"))
    rule_keys = _stored_universe(urls, [r for _, r in rules], "rule_keys")
    listed = build(rule_keys)
    of = {v: [r for w, r in rules if w == v] for v in ("allow", "block")}
    blocked = build(sizing.cut_lineage(rule_keys.where("listed").select("key", F.col("key").isin(of["block"]).alias("listed")), "rule_sides"))
    labels = build(_stored_universe(urls.select(_labels().alias("asked")), list(blocked_labels), "label_keys"))
    found = urls.withColumn("rule", F.get(F.filter("asked", lambda k: member(listed, k)), F.lit(0)))
    bad_label = F.exists(_labels(), lambda x: member(labels, x))
    verdict = (
        F.when(F.col("rule").isNotNull(), F.when(member(blocked, F.col("rule")), "block").otherwise("allow"))
        .when(bad_label, "block").otherwise("allow")
    )
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


_RULE_ROWS = ", ".join(f"('{v}', '{r}', '{r.split('/')[0]}', '{r[len(r.split('/')[0]):]}')" for v, r in RULES)
ORACLE = rf"""
WITH rules(verdict, rule, rhost, rpath) AS (VALUES {_RULE_ROWS}),
u AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT rid, rules.*, row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, length(rhost) DESC) AS k
  FROM p, rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, m.rule, CASE WHEN m.rule IS NOT NULL THEN m.verdict
    WHEN list_has_any(string_split(host, '.'), [{', '.join(f"'{x}'" for x in BLOCKED_LABELS)}]) THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN m ON p.rid = m.rid AND m.k = 1
"""
