"""Reply trees as training conversations.

Messages form trees by parent links. Self-joins of jump pointers (parent, grandparent, four up, ...) give each message its
depth and the score of its branch in as many rounds as the depth has bits; the best leaves of a tree are ranked by mean
score, and the same pointers, from the longest down, list the messages from each chosen leaf to its root once each.

A turn is written as ``<s>[INST] role\\ntext\\n</s>\\n``, an answer with ``[/INST]`` for ``[INST]``. Inside a text each of the
control strings ``<s> </s> [INST] [/INST]`` gets one more backslash in front, which reading takes away again; roles have
backslashes, line ends and the first signs of control strings escaped. The loss mask holds the spans of the answers' texts in code points.

Null roles and texts count as empty. Null conversation ids are one conversation; equal turns are ordered by role and text,
repeated rows count each. A parent that is not there makes a root; messages in a cycle have no root and are reported by
``paths`` as nothing. An empty table gives no rows; other columns are ignored.
"""
from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.scratch import settle

CONTROL = r"(</?s>|\[/?INST\])"
ANSWER = "assistant"


def escape(text):
    return F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")


def unescape(text):
    return F.regexp_replace(text, r"\\(\\*)" + CONTROL, "$1$2")


ROLE_ESCAPES = {"\n": "\\n", "<": "\\l", "[": "\\b"}


def escape_role(role):
    role = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    for sign, written in ROLE_ESCAPES.items():
        role = F.replace(role, F.lit(sign), F.lit(written))
    return role


def unescape_role(role):
    """Escapes are pairs read from the left, so cutting at each escaped backslash leaves pieces that hold the others alone."""
    def plain(piece):
        for sign, written in ROLE_ESCAPES.items():
            piece = F.replace(piece, F.lit(written), F.lit(sign))
        return piece
    return F.array_join(F.transform(F.split(role, r"\\\\"), plain), "\\")


def chain(rows):
    """Messages of linear conversations (conv_id, turn, role, text): each replies to the one before, scored by length."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "turn", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return numbered.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                           "role", "text", F.length(F.coalesce("text", F.lit(""))).cast("double").alias("score"))


def _pair(left, right, node):
    """Same tree, and the right one's node is the left one's ``node``."""
    return F.col(f"{left}.tree").eqNullSafe(F.col(f"{right}.tree")) & (F.col(f"{left}.{node}") == F.col(f"{right}.node"))


def paths(messages, branches=1):
    """``(tree, leaf, node, depth)`` of the best branches of each tree; messages have tree, node, parent and score."""
    nodes = settle(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")
    known = nodes.select("tree", "node")
    state = settle(nodes.alias("l").join(known.alias("r"), _pair("l", "r", "parent"), "left").select(
        "l.tree", "l.node", F.col("r.node").alias("up"), "l.score", F.when(F.col("r.node").isNull(), 0).otherwise(1).alias("depth")),
        "jumps")
    parents = state.where(F.col("up").isNotNull()).select("tree", F.col("up").alias("node"))
    leaves = known.join(parents.withColumnRenamed("tree", "t").withColumnRenamed("node", "n"),
                        F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
    jumps, most = [], nodes.count()
    while (1 << len(jumps)) <= max(most, 1) and state.where(F.col("up").isNotNull()).limit(1).count():
        jumps.append(state)
        # Messages that have reached their root take no part in further rounds.
        open_, done = state.where(F.col("up").isNotNull()), state.where(F.col("up").isNull())
        state = settle(done.unionByName(open_.alias("l").join(state.alias("r"), _pair("l", "r", "up"), "left").select(
            "l.tree", "l.node", "r.up", (F.col("l.score") + F.coalesce("r.score", F.lit(0.0))).alias("score"),
            (F.col("l.depth") + F.coalesce("r.depth", F.lit(0))).alias("depth"))), "jumps")
    best = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / (F.col("depth") + 1)), F.desc("depth"), "node")
    rooted = state.where(F.col("up").isNull()).select("tree", "node", "score", "depth")
    ranked = rooted.alias("l").join(leaves.alias("r"), _pair("l", "r", "node"), "left_semi").withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    chosen = settle(ranked.select("tree", F.col("node").alias("leaf"), "node", "depth"), "paths")
    for k in range(len(jumps) - 1, -1, -1):
        above = chosen.alias("l").join(jumps[k].where(F.col("up").isNotNull()).alias("r"), _pair("l", "r", "node")).select(
            "l.tree", "l.leaf", F.col("r.up").alias("node"), (F.col("l.depth") - (1 << k)).alias("depth"))
        chosen = settle(chosen.unionByName(above), "paths")
    return chosen


def format_paths(messages, chosen):
    """``(tree, leaf, formatted, loss)``: one text per path and the spans (start, end) of its answers."""
    role, text = F.coalesce("l.role", F.lit("")), F.coalesce("l.text", F.lit(""))
    turns = messages.alias("l").join(chosen.alias("r"), _pair("l", "r", "node")).select(
        "r.tree", "r.leaf", "r.depth", role.alias("role"), text.alias("text"))
    mark = F.when(F.col("role") == ANSWER, F.lit("<s>[/INST] ")).otherwise(F.lit("<s>[INST] "))
    written = turns.select("tree", "leaf", "depth", (F.col("role") == ANSWER).alias("answer"),
                           F.concat(mark, escape_role(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"))
    size = F.length("head") + F.length("body") + 6
    before = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = written.withColumn("start", (F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")).cast("long"))
    whole = placed.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct(
        "depth", F.concat("head", "body", F.lit("\n</s>\n")).alias("piece"), "start",
        (F.col("start") + F.length("body")).alias("end"), "answer"))).alias("turns"))
    return whole.select("tree", "leaf", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                        F.transform(F.filter("turns", lambda t: t["answer"]),
                                    lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss"))


def read_turns(formatted):
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, r"\n</s>\n"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape_role(F.regexp_extract(p, r"\A<s>\[/?INST\] ([^\n]*)\n", 1)).alias("role"),
        unescape(F.regexp_replace(p, r"\A<s>\[/?INST\] [^\n]*\n", "")).alias("text")))


def read_loss(formatted, loss):
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def conversations(rows, branches=1):
    """Formatted conversations of a table of turns: conv_id, formatted, loss."""
    messages = settle(chain(rows), "messages")
    return format_paths(messages, paths(messages, branches)).select(F.col("tree").alias("conv_id"), "formatted", "loss")
