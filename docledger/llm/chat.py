"""Conversations from reply trees, as text with a loss mask.

Messages name the message they answer. Self-joins of doubling reach enumerate
the paths from root to leaf: round k joins each message's ancestor 2**k away
with that ancestor's own, so a chain of n messages takes log2(n) rounds and a
narrow row per message and round. Paths are ranked by the sum of their scores;
the chosen leaf's ancestors are then collected by the same tables in reverse.

Template, a fixed format: a turn is ``<s>`` and
``[INST] text [/INST]`` for a user, ``[OUT] text</s>`` for an assistant,
``[ROLE name] text [/ROLE]`` for any other role (name URL-encoded), each with a
line break after it. Inside a text a control string gets a backslash after its
bracket (one more, where it already has some), which no control string has, and
``unescape`` takes it away again.

Defined results: null or empty text is an empty turn; a null role is the role
with the empty name; a parent that does not exist makes its message a root;
messages on a cycle have no root and no path; of equal scores the smallest leaf
wins; repeated messages with one id count once each as separate rows of the
query's own numbering; an empty table gives no rows; further columns are
ignored. One conversation is one output string, so the longest conversation must
fit in a row, whichever way it is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docledger.session import checkpoint

_CONTROL = r"(?=/?(?:INST|OUT|ROLE|s))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])(\\*)" + _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])\\(\\*)" + _CONTROL, r"$1$2")


def opening(role: Column) -> Column:
    name = F.concat(F.lit("<s>[ROLE "), F.url_encode(F.coalesce(role, F.lit(""))), F.lit("] "))
    return F.when(role == "user", F.lit("<s>[INST] ")).when(role == "assistant", F.lit("<s>[OUT] ")).otherwise(name)


def closing(role: Column) -> Column:
    return F.when(role == "user", F.lit(" [/INST]\n")).when(role == "assistant", F.lit("</s>\n")).otherwise(
        F.lit(" [/ROLE]\n")
    )


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Level k: for each message the one 2**k above it, and score and length up to there."""
    own = nodes.select("conv_id", "node_id", "parent_id", "score")
    above = own.select(F.col("conv_id").alias("c"), F.col("node_id").alias("p"))
    linked = own.join(above, own["conv_id"].eqNullSafe(above["c"]) & (own["parent_id"] == above["p"]), "left")
    level = checkpoint(
        linked.select("conv_id", "node_id", F.col("p").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("steps"))
    )
    levels = [level]
    everyone = level.count()
    climbing = F.col("up").isNotNull()
    while level.where(climbing).limit(1).count() and 1 << (len(levels) - 1) <= everyone:
        far = level.select(
            F.col("conv_id").alias("c"), F.col("node_id").alias("n"), F.col("up").alias("far"),
            F.col("total").alias("more"), F.col("steps").alias("further"),
        )
        below = level.where(climbing)  # what has reached its root is kept as it is
        joined = below.join(far, below["conv_id"].eqNullSafe(far["c"]) & (below["up"] == far["n"]))
        raised = joined.select(
            "conv_id", "node_id", F.col("far").alias("up"),
            (F.col("total") + F.col("more")).alias("total"), (F.col("steps") + F.col("further")).alias("steps"),
        )
        level = checkpoint(raised.unionByName(level.where(~climbing)))
        levels.append(level)
    return levels


def chosen_paths(messages: DataFrame, every_branch: bool = False) -> DataFrame:
    """conv_id, path_id (the leaf), position (from 0 at the root), role and text of each chosen path.

    ``messages``: conv_id, node_id (unique within conv_id), parent_id, role,
    text, score. By default the branch with the highest sum of scores of each
    conversation, with ``every_branch`` all of them.
    """
    nodes = messages.select(
        "conv_id", "node_id", "parent_id", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
    )
    levels = _jumps(nodes)
    reached = levels[-1].where(F.col("up").isNull())
    parents = levels[0].where(F.col("up").isNotNull()).select(
        F.col("conv_id").alias("c"), F.col("up").alias("p")
    ).distinct()
    leaves = reached.join(parents, reached["conv_id"].eqNullSafe(parents["c"]) & (reached["node_id"] == parents["p"]), "left_anti")
    if every_branch:
        chosen = leaves.select("conv_id", F.col("node_id").alias("path_id"), "steps")
    else:
        best = F.min(F.struct((-F.col("total")).alias("rank"), F.col("node_id"), "steps"))
        chosen = leaves.groupBy("conv_id").agg(best.alias("best")).select(
            "conv_id", F.col("best.node_id").alias("path_id"), F.col("best.steps").alias("steps")
        )
    members = chosen.select("conv_id", "path_id", F.col("path_id").alias("node_id"), (F.col("steps") - 1).alias("position"))
    for k in reversed(range(len(levels))):
        jump = levels[k].where(F.col("up").isNotNull()).select(
            F.col("conv_id").alias("c"), F.col("node_id").alias("n"), "up"
        )
        above = members.join(
            jump, members["conv_id"].eqNullSafe(jump["c"]) & (members["node_id"] == jump["n"])
        ).select("conv_id", "path_id", F.col("up").alias("node_id"), (F.col("position") - (1 << k)).alias("position"))
        members = checkpoint(members.unionByName(above))
    said = nodes.select(F.col("conv_id").alias("c"), F.col("node_id").alias("n"), "role", "text")
    return members.join(said, members["conv_id"].eqNullSafe(said["c"]) & (members["node_id"] == said["n"])).select(
        "conv_id", "path_id", "position", "role", "text"
    )


def formatted(paths: DataFrame) -> DataFrame:
    """conv_id, path_id, formatted and loss_spans (code points, end exclusive) of each path."""
    role, text = F.col("role"), F.coalesce("text", F.lit(""))
    pieces = paths.select(
        "conv_id", "path_id", "position", "role",
        opening(role).alias("open"), escape(text).alias("body"), closing(role).alias("close"),
    )
    before = W.partitionBy("conv_id", "path_id").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    length = F.length("open") + F.length("body") + F.length("close")
    placed = pieces.withColumn("at", F.coalesce(F.sum(length).over(before), F.lit(0)))
    start = F.col("at") + F.length("open")
    turn = F.struct(
        "position", F.concat("open", "body", "close").alias("piece"), (F.col("role") == "assistant").alias("trained"),
        start.alias("start"), (start + F.length("body")).alias("end"),
    )
    turns = placed.groupBy("conv_id", "path_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.transform(
        F.filter("turns", lambda t: F.coalesce(t["trained"], F.lit(False))), lambda t: F.struct(t["start"], t["end"])
    )
    return turns.select(
        "conv_id", "path_id", F.array_join(F.col("turns.piece"), "").alias("formatted"), spans.alias("loss_spans")
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""

    def turn(piece: Column) -> Column:
        user, assistant = piece.startswith("[INST] "), piece.startswith("[OUT] ")
        name = F.regexp_extract(piece, r"^\[ROLE ([^\]]*)\] ", 1)
        role = F.when(user, "user").when(assistant, "assistant").otherwise(F.url_decode(name))
        front = F.when(user, 7).when(assistant, 6).otherwise(F.length(name) + 8)
        back = F.when(user, 9).when(assistant, 5).otherwise(9)
        body = F.substring(piece, front + 1, F.length(piece) - front - back)
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    pieces = F.split(text, "<s>")
    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def masked_text(text: Column, spans: Column) -> Column:
    """All text under the mask, unescaped."""
    parts = F.transform(spans, lambda s: unescape(F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return F.array_join(parts, "")
