"""Chat formatting over reply trees, in DataFrame functions.

Nodes name their parents. Self-joins double the distance that each node's pointer jumps, so paths
of any length are walked in as many rounds as the logarithm of the longest has: first up to the
root, adding up scores, then, for the best leaves of each tree, back along the stored jumps, which
yields every node of a chosen path once. A path becomes one conversation.

A turn is ``<|im_start|>role`` and a newline, the text, ``<|im_end|>`` and a newline. Control
strings inside a text get one backslash after their first character, and one more if they have
some there already; taking one away restores the text.

Defined cases: null text is empty, a null role too; rows without a conversation id form one
conversation; of rows with one node id the smallest (parent, role, text) counts; an unknown parent
makes a root; a cycle raises an error; an empty table gives an empty result; other columns are not
read. Branches of equal score go by the smaller leaf id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plaintlens.llm.common import written

#: What follows the first character of a control string: of this template and of other common ones.
CONTROL = r"([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|</?SYS>>|/?INST\])"
START, END = "<|im_start|>", "<|im_end|>"
TURN = r"(?s)<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def chosen_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, node, parent, role, text, score) -> (tree, leaf, depth, role, text).

    One row for each node on the paths from the roots to the ``branches`` best leaves of each tree
    by the sum of scores. Depths start at 1.
    """
    base = written(
        nodes.groupBy("tree", "node")
        .agg(F.min(F.struct("parent", "role", "text", "score")).alias("own"))
        .select("tree", "node", "own.*"),
        "reply-nodes",
    )
    parents = base.select("tree", F.col("node").alias("parent"), F.col("node").alias("jump"))
    state = written(
        base.join(parents, ["tree", "parent"], "left").select(
            "tree", "node", "jump", F.col("score").alias("total"), F.lit(1).alias("depth")
        ),
        "reply-jumps",
    )
    most = base.count().bit_length() + 1
    levels = []
    while not (further := state.filter("jump IS NOT NULL").select("tree", "node", "jump")).isEmpty():
        if len(levels) > most:
            raise ValueError("a reply tree has a cycle")
        levels.append(further)
        ahead = state.select(
            "tree",
            F.col("node").alias("jump"),
            F.col("jump").alias("next"),
            F.col("total").alias("more"),
            F.col("depth").alias("deeper"),
        )
        # nodes that have reached their root are done
        moved = state.join(ahead, ["tree", "jump"]).select(
            "tree",
            "node",
            F.col("next").alias("jump"),
            (F.col("total") + F.col("more")).alias("total"),
            (F.col("depth") + F.col("deeper")).alias("depth"),
        )
        state = written(state.filter("jump IS NULL").unionByName(moved), "reply-jumps")
    inner = base.select("tree", F.col("parent").alias("node")).filter("node IS NOT NULL")
    best = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
    leaves = state.join(inner.distinct(), ["tree", "node"], "left_anti")
    leaves = leaves.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= branches)
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node")
    for level in reversed(levels):
        up = paths.join(level, ["tree", "node"]).select("tree", "leaf", F.col("jump").alias("node"))
        paths = written(paths.unionByName(up), "reply-paths")
    return (
        paths.join(state.select("tree", "node", "depth"), ["tree", "node"])
        .join(base.select("tree", "node", "role", "text"), ["tree", "node"])
        .select("tree", "leaf", "depth", "role", "text")
    )


def formatted(paths: DataFrame) -> DataFrame:
    """(tree, leaf, formatted, loss): one conversation a path; ``loss`` lists the (start, length)
    of assistant texts in code points, counted from 1."""
    head = F.concat(F.lit(START), F.url_encode(F.coalesce("role", F.lit(""))), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    turns = paths.select("tree", "leaf", "depth", "role", head.alias("head"), body.alias("body"))
    piece = F.concat("head", "body", F.lit(END + "\n"))
    before = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offset = F.coalesce(F.sum(F.length(piece)).over(before), F.lit(0))
    placed = turns.select(
        "tree",
        "leaf",
        "depth",
        piece.alias("piece"),
        F.when(
            F.col("role") == "assistant",
            F.struct(
                (offset + F.length("head") + 1).cast("int").alias("start"),
                F.length("body").alias("length"),
            ),
        ).alias("span"),
    )
    rows = placed.groupBy("tree", "leaf").agg(
        F.sort_array(F.collect_list(F.struct("depth", "piece", "span"))).alias("turns")
    )
    return rows.select(
        "tree",
        "leaf",
        F.concat_ws("", F.col("turns.piece")).alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss"),
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """Turns and loss text of formatted conversations, as a reader of the format finds them."""
    role = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(1))
    text = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(2))
    turns = F.arrays_zip(role.alias("role"), text.alias("text"))
    told = F.transform(
        turns, lambda t: F.concat(F.url_decode(t.role), F.lit("\n"), unescape(t.text), F.lit("\n"))
    )
    under = F.transform(
        "loss", lambda s: unescape(F.substring(F.col("formatted"), s.start, s.length))
    )
    loss = F.concat_ws("", under)
    return conversations.select(
        "tree",
        "leaf",
        F.size(role).cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", told), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def turns_as_tree(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as chains of replies, each turn's parent the one before.

    Turns with one number follow each other by role and text.
    """
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "turn", "role", "text"
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return rows.withColumn("node", F.row_number().over(order).cast("long")).select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(1.0).alias("score"),
    )


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation, formatted and read back."""
    digests = read_back(formatted(chosen_paths(turns_as_tree(conversations))))
    conv_id = F.when(F.col("tree") != "", F.col("tree")).cast("long").alias("conv_id")
    return digests.select(conv_id, *digests.columns[2:])


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The table and conversation -7, whose turns hold control strings of another template."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
