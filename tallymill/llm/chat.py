"""Reply trees as formatted conversations (operator 6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymill.llm.tables import stored

# The marks of the template. A turn is `### role`, a line break, the text, `</turn>`, a line break.
OPEN, BREAK, CLOSE = "### ", "\n", "</turn>\n"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """Neither mark can occur in the result, because both ``#`` and ``<`` are replaced."""
    for sign, code in (("\\", "\\b"), ("#", "\\h"), ("<", "\\l")):
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """Undo :func:`escaped`. Every backslash starts a code, so the order of replacing is safe if it ends with it."""
    for sign, code in (("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\n"), F.lit("\n")))


def reply_paths(nodes: DataFrame) -> DataFrame:
    """``tree, leaf, distance, node`` for every node on the path from each leaf up to its root.

    ``nodes`` has ``tree, node, parent``; ``node`` is unique in its tree. A null parent, one that is
    not in the tree, and the node itself make a node a root. Nodes that hang on a cycle have no root and are left out.

    Ancestors are found by iterative self-joins that double the distance, so the number of joins is the logarithm
    of the depth. Each leaf's path is then enumerated by the binary digits of the distances. All rows carry ids only.
    """
    links = nodes.select("tree", "node", F.col("parent").alias("up")).where("parent <> node")
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    same = lambda left, right: left.eqNullSafe(right)
    jump = stored(links.join(known, same(F.col("tree"), F.col("t")) & (F.col("up") == F.col("n"))).select("tree", "node", "up"), "up")
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    jumps = []
    while (1 << len(jumps)) < largest and not jump.isEmpty():
        jumps.append(jump)
        to = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("further"))
        doubled = jump.join(to, same(F.col("tree"), F.col("t")) & (F.col("up") == F.col("n")))
        jump = stored(doubled.select("tree", "node", F.col("further").alias("up")), "up")
    # Who still has an ancestor at least as far away as the tree has nodes, walks in a circle.
    circling = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    first = jumps[0] if jumps else jump
    parents = first.select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    both = same(F.col("tree"), F.col("t")) & (F.col("node") == F.col("n"))
    leaves = nodes.select("tree", "node").join(parents, both, "left_anti").join(circling, both, "left_anti")
    paths = leaves.select("tree", F.col("node").alias("leaf"), F.lit(0).cast("long").alias("distance"), "node")
    for power in reversed(range(len(jumps))):
        to = jumps[power].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        farther = F.struct((F.col("distance") + (1 << power)).alias("distance"), F.col("up").alias("node"))
        here = F.struct("distance", "node")
        step = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, farther))
        paths = paths.join(to, both, "left").select("tree", "leaf", F.explode(step).alias("s")).select("tree", "leaf", "s.*")
    return paths


def formatted(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """Each chosen root-to-leaf path of every reply tree as one conversation.

    ``nodes``: ``tree, node, parent, role, text, score``; see :func:`reply_paths`. A null role, text or score
    counts as empty or 0. The branches of a tree are ranked by the sum of their scores, ties by the
    smaller leaf; ``best`` keeps that many of each tree, None all.

    Returns ``tree, leaf, rank, score, n_turns, formatted, loss_spans``. ``loss_spans`` are the
    ``start, end`` (code points, end exclusive) of the texts of :data:`LOSS_ROLE` within ``formatted``.
    :func:`turns_of` reads the turns back. A tree without a leaf gives no row, no trees give none.
    """
    content = nodes.select(
        F.col("tree").alias("t"),
        F.col("node").alias("n"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    same = F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))
    paths = reply_paths(nodes)
    if best is not None:
        # Branches are ranked by their nodes' scores alone; texts are joined to the chosen ones only.
        sums = paths.join(content.select("t", "n", "score"), same).groupBy("tree", "leaf").agg(F.sum("score").alias("sum"))
        place = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("sum").desc(), "leaf"))
        chosen = sums.withColumn("place", place).where(F.col("place") <= best).select(F.col("tree").alias("of"), F.col("leaf").alias("end"))
        paths = paths.join(chosen, F.col("tree").eqNullSafe(F.col("of")) & (F.col("leaf") == F.col("end"))).select(*paths.columns)
    turns = paths.join(content, same).groupBy("tree", "leaf").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("at"), "role", "text"))).alias("turns"),
        F.sum("score").alias("score"),
    )
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf"))
    turns = turns.withColumn("rank", rank)
    pieces = F.transform(
        "turns",
        lambda turn: F.struct(
            F.concat(F.lit(OPEN), _escaped_role(turn["role"]), F.lit(BREAK)).alias("head"),
            escaped(turn["text"]).alias("text"),
            (turn["role"] == LOSS_ROLE).alias("loss"),
        ),
    )
    # The running length and the spans so far are folded over the turns.
    start = F.struct(F.lit(0).alias("length"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(state, piece):
        begin = state["length"] + F.length(piece["head"])
        end = begin + F.length(piece["text"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(CLOSE)).alias("length"),
            F.when(piece["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], F.lit(CLOSE))), "")
    return turns.withColumn("pieces", pieces).select(
        "tree",
        "leaf",
        "rank",
        "score",
        F.size("turns").cast("long").alias("n_turns"),
        whole.alias("formatted"),
        F.aggregate("pieces", start, add)["spans"].alias("loss_spans"),
    )


def turns_of(text: Column) -> Column:
    """``array<struct<role, text>>`` read back from a formatted conversation."""
    pieces = F.split(text, CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(
        pieces,
        lambda piece: F.struct(
            _unescaped_role(F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), BREAK, 1)).alias("role"),
            unescaped(F.substr(piece, F.instr(piece, BREAK) + 1)).alias("text"),
        ),
    )


def under_loss(text: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped and joined."""
    return unescaped(F.array_join(F.transform(spans, lambda s: F.substr(text, s["start"] + 1, s["end"] - s["start"])), ""))


def chains(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` as reply trees in which every turn answers the one before it.

    Turns are ordered by number (null first), then role and text, so that repeated numbers are turns of their own.
    The score of a node is the length of its text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return conversations.select(F.col("conv_id").alias("tree"), node.alias("node"), "role", "text").select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.length("text").alias("score"),
    )
