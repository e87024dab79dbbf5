"""Reply trees as conversations.

Self-joins that double their reach find each message's root, depth and summed score, branches are
ranked by score, and the messages of each chosen branch become one text with a loss mask.

Defined results: a null text or role is empty; a message whose parent is missing is a root; rows
repeated in full are messages of their own when they come from ``turns_as_tree``, while a repeated
(tree, node) in ``format_trees`` is refused by no check and gives one turn per row. All messages of the
null tree are one conversation, as in a GROUP BY. Messages whose
parents run in a circle have no root and belong to no branch. Ties of score go to the smaller node.
An empty table gives no rows. Other columns are ignored. Texts of any length are kept whole; the texts of one
conversation have to fit in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertflow.llm.common import together, written

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """A backslash more between ``<`` and ``|``, so no control string is left; undone by ``unescape``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _one_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))


def _any_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def turns_as_tree(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as messages, each replying to the turn before it.

    Equal turn numbers are ordered by role, then text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return numbered.select(
        F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def _keyed(messages: DataFrame) -> DataFrame:
    """``messages`` with the tree inside a struct, which is never null: joins by equality keep the null tree."""
    return messages.withColumn("tree", F.struct(F.col("tree").alias("id")))


def branches(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """(tree, leaf, node, position): the messages of the ``keep`` best branches of each tree, or of all.

    ``messages`` has tree, node, parent and score. Reach doubles with each self-join, so their number
    is the logarithm of the longest branch; nothing of a tree meets in one task.
    """
    return _branches(_keyed(messages), keep).withColumn("tree", F.col("tree.id"))


def _branches(messages: DataFrame, keep: int | None) -> DataFrame:
    """``branches`` of messages that are keyed, with their keyed trees."""
    base = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = base.select("tree", F.col("node").alias("parent")).distinct().withColumn("_known", F.lit(True))
    jump = base.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("_known"), F.col("parent")).alias("up"), "score"
    )
    jumps, open_up = [written(jump, "jumps")], F.col("up").isNotNull()
    longest = messages.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    # A message at its root is done: only the others are joined again, so a long tree costs short ones nothing.
    # In a circle there is always a message further up, so the longest tree ends the doubling too.
    while 2 ** (len(jumps) - 1) <= longest and not jumps[-1].filter(open_up).isEmpty():
        left = jumps[-1].filter(open_up)
        above = together(*jumps).filter(~open_up).unionByName(left).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("score").alias("_more")
        )
        jump = left.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("_up").alias("up"), (F.col("score") + F.col("_more")).alias("score")
        )
        jumps.append(written(jump, "jumps"))
    done = together(*jumps).filter(~open_up)
    parents = base.select("tree", F.col("parent").alias("node")).distinct()
    leaves = done.join(parents, ["tree", "node"], "left_anti")
    if keep is not None:
        best = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
        leaves = leaves.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= keep)
    found = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("position"))
    paths = [written(found, "paths")]
    for k, step in enumerate(jumps[:-1]):
        reached = together(*paths).join(step.filter(open_up).select("tree", "node", "up"), ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("position") - 2**k).alias("position")
        )
        paths.append(written(reached, "paths"))
    return together(*paths)


def format_trees(messages: DataFrame, keep: int | None = None, learn: str = "assistant") -> DataFrame:
    """(tree, leaf, formatted, loss_spans): one conversation per branch.

    ``loss_spans`` holds (start, length) in code points of ``formatted`` for each text of the role
    ``learn``. A conversation is one row and so has to fit into a task.
    """
    messages = _keyed(messages)
    texts = messages.select(
        "tree", "node", F.coalesce("role", F.lit("")).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text")
    )
    turn = _branches(messages, keep).join(texts, ["tree", "node"])
    head = F.concat(F.lit(START), escape(_one_line(F.col("role"))), F.lit("\n"))
    turn = turn.select(
        "tree", "leaf", "position", F.concat(head, "text", F.lit(f"{END}\n")).alias("piece"),
        F.length(head).alias("_head"), F.length("text").alias("_text"), (F.col("role") == learn).alias("_learn"),
    )
    before = Window.partitionBy("tree", "leaf").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    turn = turn.withColumn("_at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    rows = turn.groupBy("tree", "leaf").agg(
        F.array_sort(F.collect_list(F.struct("position", "_at", "piece", "_head", "_text", "_learn"))).alias("turns")
    )
    spans = F.transform(
        F.filter("turns", lambda t: t["_learn"]),
        lambda t: F.struct((t["_at"] + t["_head"]).cast("long").alias("start"), t["_text"].cast("long").alias("length")),
    )
    return rows.select(
        F.col("tree.id").alias("tree"), "leaf", F.concat_ws("", F.transform("turns", lambda t: t["piece"])).alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(START) + 1)), "\n", 1)
        text = F.substr(piece, F.length(role) + len(START) + 2)
        return F.struct(_any_line(unescape(role)).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.concat_ws(
        "",
        F.transform(
            spans,
            lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
    )
