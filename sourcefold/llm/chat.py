"""Chat formatting of reply trees.

Messages form trees by their parents. Self-joins give every message its ancestor 1, 2, 4 ... steps up, with the sum
of the scores on the way, so after log n joins each leaf knows the score of its whole branch. Branches are ranked by
mean score within their tree; only the chosen ones are written out, by the same ancestors: a leaf stands for itself,
and each join doubles the part of its path that is known. So a tree costs rows for its messages and for the branches
that are chosen, not for all of its paths, and no row ever holds more than one step.

Template: each turn is `<|start|>` role, a newline, text, `<|end|>` and a newline. Inside roles and texts backslashes
are doubled and a backslash goes into every control string after its first character, so that none is left, and
taking the escapes out gives the text back exactly.

Defined cases: null roles and texts are empty; a message whose parent is missing is a root; messages on a cycle have
no root and are left out; rows that repeat a message count once; ties between branches go to the longer, then to the smaller leaf; null scores
and those that are no finite numbers count as 0; empty tables give empty results; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

START, END = "<|start|>", "<|end|>\n"
#: A backslash goes in after the first character of each of these.
CONTROL = r"([<\[])(?=\||/?s>|/?INST\]|</?SYS>>)"
TURN = r"^<\|start\|>((?:[^\\\n]|\\[\s\S])*+)\n([\s\S]*)$"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def ancestors(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(jumps, leaves): for k = 0, 1, 2 ... (tree, node, to), to 2 ** k steps above; and (tree, leaf, total, turns), the branches from a root.

    messages: (tree, node, parent, score), each node once in its tree; a null or non-finite score counts as 0. What still has an ancestor when all
    messages could have been passed stands on a cycle, or hangs from one, and has no branch.
    """
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0))
    nodes = messages.select("tree", "node", "parent", F.when(F.isnan(score) | (F.abs(score) == float("inf")), 0.0).otherwise(score).alias("total"))
    keys = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    state = stored(nodes.join(keys, nodes.tree.eqNullSafe(keys._t) & (nodes.parent == keys._n), "left").select("tree", "node", F.col("_n").alias("to"), "total", F.lit(1).cast("long").alias("turns")))
    above = state.where("to IS NOT NULL").select("tree", "node", "to")
    parents = above.select(F.col("tree").alias("_t"), F.col("to").alias("_n")).distinct()
    leaves = state.join(parents, state.tree.eqNullSafe(parents._t) & (state.node == parents._n), "left_anti").select(F.col("tree").alias("_lt"), F.col("node").alias("_ln"))
    jumps, step, size = [], 1, state.count()
    while step <= size and not above.isEmpty():
        jumps.append(above)
        hop = state.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("to").alias("_to"), F.col("total").alias("_s"), F.col("turns").alias("_c"))
        # the rows that have reached a root aren't dealt again
        open_ = state.where("to IS NOT NULL")
        met = open_.join(hop, open_["tree"].eqNullSafe(hop["_t"]) & (open_["to"] == hop["_n"])).select("tree", "node", F.col("_to").alias("to"), (F.col("total") + F.col("_s")).alias("total"), (F.col("turns") + F.col("_c")).alias("turns"))
        state = stored(state.where("to IS NULL").union(met))
        above = state.where("to IS NOT NULL").select("tree", "node", "to")
        step *= 2
    ends = state.where("to IS NULL")
    return jumps, ends.join(leaves, ends.tree.eqNullSafe(F.col("_lt")) & (ends.node == F.col("_ln")), "left_semi").select("tree", F.col("node").alias("leaf"), "total", "turns")


def ranked(leaves: DataFrame, top: int) -> DataFrame:
    """(tree, leaf, score, rank): the `top` branches by falling mean score of their messages, then longer, then smaller leaf; each task passes on `top` of a tree at most."""
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("turns"), "leaf")
    return leaves.withColumn("score", F.col("total") / F.col("turns")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("tree", "leaf", "score", "rank")


def paths(leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """leaves (tree, leaf, ...) with a row for every message on the path to the root (node); up: its steps above the leaf."""
    found = leaves.withColumns({"node": F.col("leaf"), "up": F.lit(0).cast("long")})
    for k, jump in enumerate(jumps):
        hop = jump.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("to").alias("_to"))
        more = found.join(hop, found.tree.eqNullSafe(hop._t) & (found.node == hop._n)).withColumns({"node": F.col("_to"), "up": F.col("up") + 2**k}).select(*found.columns)
        found = stored(found.union(more))
    return found


def formatted(turns: Column, loss_roles: list[str]) -> tuple[Column, Column]:
    """From an array of structs (role, text) in order: the conversation, and the spans under the loss mask (start, end), in code points."""
    done = F.transform(turns, lambda t: F.struct(t["role"].alias("plain"), F.replace(escaped(t["role"]), F.lit("\n"), F.lit("\\\n")).alias("role"), escaped(t["text"]).alias("text")))
    text = F.array_join(F.transform(done, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))), "")
    none = F.array().cast("array<struct<start: int, end: int>>")

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + len(START) + F.length(t["role"]) + 1
        end = start + F.length(t["text"])
        return F.struct((end + len(END)).alias("at"), F.when(t["plain"].isin(loss_roles), F.array_append(state["spans"], F.struct(start.alias("start"), end.alias("end")))).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate(done, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda s: s["spans"])
    return text, spans


def conversations(messages: DataFrame, *, top: int = 1, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(tree, leaf, score, rank, conversation, loss) of the `top` branches of each tree.

    messages: (tree, node, parent, role, text, score); parents are nodes of the same tree, null for a root.
    """
    messages = messages.dropDuplicates(["tree", "node"])
    jumps, leaves = ancestors(messages)
    rows = paths(stored(ranked(leaves, top)), jumps)
    own = messages.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(own, rows.tree.eqNullSafe(own._t) & (rows.node == own._n))
    turns = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    out = rows.groupBy("tree", "leaf", "score", "rank").agg(turns.alias("turns"))
    text, spans = formatted(F.col("turns"), list(loss_roles))
    return out.select("tree", "leaf", "score", "rank", text.alias("conversation"), spans.alias("loss"))


def read_back(conversation: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.split(conversation, r"<\|end\|>\n", -1)
    turns = F.slice(parts, 1, F.size(parts) - 1)
    return F.transform(turns, lambda p: F.struct(unescaped(F.regexp_extract(p, TURN, 1)).alias("role"), unescaped(F.regexp_extract(p, TURN, 2)).alias("text")))


def under_mask(conversation: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(conversation, s["start"] + 1, s["end"] - s["start"]))), "")


def chain(turns: DataFrame) -> DataFrame:
    """The messages of linear conversations (conv_id, turn, role, text): each row replies to the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.withColumn("node", F.row_number().over(order))
    return rows.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def op5_reply_trees(spark, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = conversations(chain(given.unionByName(planted)))
    back = out.select(F.col("tree").alias("conv_id"), "conversation", read_back(F.col("conversation")).alias("turns"), under_mask(F.col("conversation"), F.col("loss")).alias("learned"))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), digest.alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.length("conversation").cast("long").alias("formatted_chars"))


OP5_SQL = r"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (
  SELECT *, regexp_replace(regexp_replace(replace(text, '\', '\\'), '([<\[])(\||/?s>|/?INST\])', '\1\\\2', 'g'), '<(</?SYS>>)', '<\\\1', 'g') AS e FROM every)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(e) + length(role) + length('<|start|><|end|>') + 2)::BIGINT AS formatted_chars
FROM esc GROUP BY conv_id
"""
