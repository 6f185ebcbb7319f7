"""Reply trees to training conversations.

A message names its parent. Self-joins that double the distance they cover give every message its
depth and the sum of scores above it, in as many rounds as the depth has binary digits. Leaves are
ranked by the mean score of their branch; the best of each tree are walked up again through the
stored jumps, largest first, and each path is formatted as one conversation.

Format: ``<|im_start|>role\\ntext<|im_end|>\\n`` per message. Control strings inside roles and texts
are broken by a backslash behind their first character; strings that are broken already get one
more, so taking one away restores the text exactly. The loss mask is a list of (start, end) in code
points, one per assistant message, around its escaped text alone.

State during the rounds is narrow (no texts) and is written to the shared folder after each round.
A path is one output row, as large as its texts. Hot trees: joins are on (tree, message), and the
rank of a tree's leaves is cut to the wanted number inside tasks before rows meet.

Defined cases: null texts and roles are empty; an unknown parent makes a root; messages on a cycle
or below one reach no root and are left out; of messages with the same id in one tree the smallest
(parent, role, text, score) counts; of branches with equal means the one with the smallest leaf ranks first, and a score
that is no number ranks above all numbers; a null score is 0; repeated rows are one message; a null tree is a tree, and a null message of a tree is one message
that none can answer, since a null parent makes a root; turns without a number come last in
``from_turns``; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwarden.functions import sizing

START, END = "<|im_start|>", "<|im_end|>"
#: What is broken inside texts: an opening character, then one of these bodies.
CONTROL = r"\|[A-Za-z0-9_]+\|>|/?s>|/?INST\]|</?SYS>>|/SYS>>|SYS>>"
_BREAK, _MEND = rf"([<\[])(\\*)({CONTROL})", rf"([<\[])\\(\\*)({CONTROL})"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BREAK, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _MEND, "$1$2$3")


def escape_role(role: Column) -> Column:
    """A role ends at the first line feed, so its own become ``\\n``."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    held = F.replace(F.replace(role, F.lit("\\\\"), F.lit("\x00")), F.lit("\\n"), F.lit("\n"))
    return unescape(F.replace(held, F.lit("\x00"), F.lit("\\")))


def _wrapped(name: str) -> Column:
    """A key for joins that is never null: a structure, whose null field equals another one."""
    return F.struct(F.col(name).alias("key"))


def _jumps(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Per message depth and score sum of its way up; and tables of jumps of 1, 2, 4, … messages.

    Only messages whose way up is not yet known to its end take part in a round.
    """
    now = sizing.cut_lineage(nodes.select("tree", "msg", F.col("parent").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("depth")), "tree0")
    steps, rounds = [now], math.ceil(math.log2(now.count() + 1)) + 1
    done, open_ = now.where("up IS NULL"), now.where("up IS NOT NULL")
    for k in range(1, rounds + 1):  # what is open after that hangs on a cycle
        if open_.isEmpty():
            break
        above = done.unionByName(open_).select("tree", F.col("msg").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"), F.col("depth").alias("depth2"))
        longer = open_.join(above, ["tree", "up"]).select("tree", "msg", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"), (F.col("depth") + F.col("depth2")).alias("depth"))
        steps.append(sizing.cut_lineage(longer, f"tree{k}"))
        done, open_ = done.unionByName(steps[-1].where("up IS NULL")), steps[-1].where("up IS NOT NULL")
    return done, steps


def branches(messages: DataFrame, top: int = 1) -> tuple[DataFrame, DataFrame]:
    """Paths of the ``top`` branches of each tree: (``tree``, ``leaf``, ``rank``, ``pos``, ``msg``), and the messages used."""
    own = messages.groupBy("tree", "msg").agg(F.min(F.struct("parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("m"))
    own = sizing.cut_lineage(own.select("tree", "msg", "m.*"), "messages")
    ids = own.select(F.col("tree").alias("in_tree"), F.col("msg").alias("known"))
    nodes = own.select("tree", "msg", "parent", "score").join(ids, F.col("tree").eqNullSafe(F.col("in_tree")) & (F.col("parent") == F.col("known")), "left")
    nodes = nodes.select(_wrapped("tree").alias("tree"), _wrapped("msg").alias("msg"), F.when(F.col("known").isNotNull(), _wrapped("known")).alias("parent"), "score")
    reach, steps = _jumps(nodes)
    leaves = reach.join(steps[0].where("up IS NOT NULL").select("tree", F.col("up").alias("msg")).distinct(), ["tree", "msg"], "left_anti")
    order = Window.partitionBy("tree").orderBy((F.col("total") / F.col("depth")).desc(), "msg")
    walk = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    walk = walk.select("tree", F.col("msg").alias("leaf"), "rank", "msg", F.col("depth").alias("len"))
    for k in range(len(steps) - 1, -1, -1):
        jump = steps[k].where("up IS NOT NULL").select("tree", "msg", F.col("up").alias("over"))
        if k == len(steps) - 1 and k:
            continue  # nobody is that deep
        reach_k = 1 << k
        near = F.struct("msg", F.least("len", F.lit(reach_k).cast("long")).alias("len"), (F.col("base") + F.greatest(F.lit(0).cast("long"), F.col("len") - reach_k)).alias("base"))
        far = F.struct(F.col("over").alias("msg"), (F.col("len") - reach_k).alias("len"), F.col("base"))
        if "base" not in walk.columns:
            walk = walk.withColumn("base", F.lit(0).cast("long"))
        walk = walk.join(jump, ["tree", "msg"], "left")
        walk = walk.withColumn("part", F.explode(F.when(F.col("len") > reach_k, F.array(near, far)).otherwise(F.array(near)))).select("tree", "leaf", "rank", "part.*")
    return walk.select(F.col("tree.key").alias("tree"), F.col("leaf.key").alias("leaf"), "rank", F.col("base").alias("pos"), F.col("msg.key").alias("msg")), own


def format_paths(paths: DataFrame, own: DataFrame) -> DataFrame:
    """``tree``, ``leaf``, ``rank``, ``formatted``, ``loss`` (spans)."""
    keys = {"tree": _wrapped("tree"), "msg": _wrapped("msg")}
    turns = paths.withColumns(keys).join(own.withColumns(keys), ["tree", "msg"]).select(
        F.col("tree.key").alias("tree"), "leaf", "rank", F.struct("pos", F.col("role").alias("role"), escape_role(F.col("role")).alias("head"), escape(F.col("text")).alias("body")).alias("turn")
    )
    joined = turns.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    shown = F.transform("turns", lambda x: F.concat(F.lit(START), x["head"], F.lit("\n"), x["body"], F.lit(END), F.lit("\n")))
    joined = joined.withColumn("shown", shown)
    # where each message ends: a running sum, kept as a growing list of one entry per message
    spans = F.transform(
        F.arrays_zip("turns", F.transform("shown", lambda x: F.length(x)).alias("size")), lambda x: F.struct(x["turns"].alias("turn"), x["size"].alias("size"))
    )
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss"))
    tail = len(END) + 1

    def step(acc, x):
        end = acc["at"] + x["size"] - tail
        return F.struct(
            (acc["at"] + x["size"]).alias("at"),
            F.when(x["turn"]["role"] == "assistant", F.concat(acc["loss"], F.array(F.struct((end - F.length(x["turn"]["body"])).alias("start"), end.alias("end"))))).otherwise(acc["loss"]).alias("loss"),
        )

    return joined.select("tree", "leaf", "rank", F.array_join("shown", "").alias("formatted"), F.aggregate(spans, first, step, lambda a: a["loss"]).alias("loss"))


def parse(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text) and ``learned`` (text under the mask) taken back from formatted rows."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda x: x != "")
    role_size = lambda x: F.length(F.substring_index(x, "\n", 1))
    turn = lambda x: F.struct(
        unescape_role(x.substr(F.lit(len(START) + 1), role_size(x) - len(START))).alias("role"),
        unescape(x.substr(role_size(x) + 2, F.length(x))).alias("text"),
    )
    learned = F.array_join(F.transform("loss", lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return formatted.withColumns({"turns": F.transform(pieces, turn), "learned": learned})


def write(messages: DataFrame, path: str, top: int = 1) -> None:
    format_paths(*branches(messages, top)).write.parquet(path)


def from_turns(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before (by turn, role, text; no turn last)."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    nr = F.row_number().over(order).cast("long")
    rows = conversations.select(F.col("conv_id").alias("tree"), nr.alias("msg"), "role", "text")
    return rows.withColumns({"parent": F.when(F.col("msg") > 1, F.col("msg") - 1), "score": F.when(F.col("role") == "assistant", 1.0).otherwise(0.0)})


#: The conversation that the query adds: its texts look like another template's marks.
EXTRA_ID, EXTRA_TEXT = -7, "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(EXTRA_ID, 0, "user", EXTRA_TEXT), (EXTRA_ID, 1, "assistant", EXTRA_TEXT)], "conv_id bigint, turn bigint, role string, text string")
    path = sizing.run_dir(spark, "chats")
    write(from_turns(given.unionByName(extra)), path)
    back = parse(spark.read.parquet(path))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESC = "regexp_replace({}, '" + _BREAK + r"', '\1\\\2\3', 'g')"
ORACLE = rf"""
WITH c AS (SELECT conv_id, turn, role AS raw_role, text AS raw_text, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT {EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}' UNION ALL SELECT {EXTRA_ID}, 1, 'assistant', '{EXTRA_TEXT}')),
e AS (SELECT *, replace(replace({_ESC.format('role')}, '\', '\\'), chr(10), '\n') AS head, {_ESC.format('text')} AS body FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, raw_role NULLS FIRST, raw_text NULLS FIRST)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, raw_role NULLS FIRST, raw_text NULLS FIRST)) AS loss_sha256,
  sum(length(head) + length(body) + {len(START) + len(END) + 2})::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
