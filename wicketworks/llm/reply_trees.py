"""Conversations for chat training out of reply trees: the best root-to-leaf paths, formatted with a loss mask.

Everything is DataFrame code. Paths are found by self-joins that double their reach: level k holds,
for every post, its ancestor 2^k steps up and the sums over the posts on the way. A tree of
depth d takes log2(d) levels, a leaf reaches its root in as many joins, and a chosen path
unfolds into exactly its posts, so the work does not grow with the square of the depth.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wicketworks.llm.common import keyed_hash
from wicketworks.operators.skew import join_keys
from wicketworks.operators.windows import row_numbers
from wicketworks.session import materialize

ESCAPE = "\\"


class Template(NamedTuple):
    """Marks of a turn, and all strings that must not occur inside a text.

    Each control string begins with one of ``<`` and ``[`` and has no second such letter behind an ordinary one.
    """

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    controls: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )

    def broken(self) -> str:
        """Pattern of the first letter of every control string, wherever one stands."""
        rest: dict[str, list[str]] = {}
        for control in self.controls:
            rest.setdefault(control[0], []).append("".join(f"\\x{ord(c):02x}" for c in control[1:]))
        return "|".join(f"\\x{ord(first):02x}(?={'|'.join(tails)})" for first, tails in rest.items())


CHAT = Template()


def escaped(text: Column, template: Template = CHAT) -> Column:
    """The text without any control string: a backslash breaks each one, and backslashes are doubled."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, template.broken(), "$0\\\\")


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given: each backslash goes and the letter behind it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turn(template: Template, role: str, text: str, loss_role: str) -> list[Column]:
    """The head of a turn with its role (URL-encoded, so it has neither line ends nor marks), its body, and its mask."""
    name = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    head = F.concat(F.lit(template.opening), F.url_encode(name), F.lit("\n"))
    return [head.alias("head"), escaped(F.col(f"`{text}`"), template).alias("body"), (name == loss_role).alias("masked")]


def _with_length(turns: DataFrame, template: Template) -> DataFrame:
    return turns.withColumn("length", (F.length("head") + F.length("body") + len(template.closing)).cast("long"))


def _levels(links: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Tables of (node, up, score, length) for 1, 2, 4, ... steps; and the nodes that lead into a circle, if any.

    The sums cover the node itself and the posts below ``up``. A walk of as many steps as there are posts
    meets one twice, so whoever still has an ancestor there leads into a circle.
    """
    n, levels = links.count(), []
    level = materialize(links.where("up IS NOT NULL").select("node", "up", "score", "length"), "tree-level")
    while not level.isEmpty():
        if 2 ** len(levels) >= n:
            return levels, level.select("node")
        levels.append(level)
        above = level.toDF("_node", "_up", "_score", "_length")
        climbed = level.join(above, F.col("up") == F.col("_node")).select(
            "node", F.col("_up").alias("up"), (F.col("score") + F.col("_score")).alias("score"),
            (F.col("length") + F.col("_length")).alias("length"),
        )
        level = materialize(climbed, "tree-level")
    return levels, None


def _branches(links: DataFrame, levels: list[DataFrame], circles: DataFrame | None) -> DataFrame:
    """One row per leaf: (leaf, root, tie, score, length, n_turns); the score is the mean over the path."""
    parents = links.where("up IS NOT NULL").select(F.col("up").alias("node")).distinct()
    leaves = links.join(parents, "node", "left_anti")
    if circles is not None:
        leaves = leaves.join(circles, "node", "left_anti")
    rows = leaves.select(
        F.col("node").alias("leaf"), F.col("node").alias("cur"), "tie",
        F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("length"), F.lit(1).cast("long").alias("n_turns"),
    )
    for k in reversed(range(len(levels))):
        step = levels[k].toDF("_node", "_up", "_score", "_length")
        zero = F.lit(0)
        rows = rows.join(step, F.col("cur") == F.col("_node"), "left").select(
            "leaf", F.coalesce("_up", "cur").alias("cur"), "tie",
            (F.col("score") + F.coalesce("_score", zero)).alias("score"),
            (F.col("length") + F.coalesce("_length", zero)).alias("length"),
            (F.col("n_turns") + F.when(F.col("_up").isNotNull(), 2**k).otherwise(0)).alias("n_turns"),
        )
    root = links.select(F.col("node").alias("cur"), F.col("score").alias("_score"), F.col("length").alias("_length"))
    return rows.join(root, "cur").select(
        "leaf", F.col("cur").alias("root"), "tie", ((F.col("score") + F.col("_score")) / F.col("n_turns")).alias("score"),
        (F.col("length") + F.col("_length")).alias("length"), "n_turns",
    )


def _unfolded(chosen: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The posts of each chosen path: (leaf, node, steps above the leaf, characters below it in the conversation).

    Every distance is reached once, by its binary digits from the highest down.
    """
    rows = chosen.select("leaf", F.col("leaf").alias("cur"), F.lit(0).cast("long").alias("steps"), F.lit(0).cast("long").alias("below"))
    for k in reversed(range(len(levels))):
        step = levels[k].select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("length").alias("_length"))
        here = F.struct(F.col("cur"), F.col("steps"), F.col("below"))
        there = F.struct(F.col("_up").alias("cur"), (F.col("steps") + 2**k).alias("steps"), (F.col("below") + F.col("_length")).alias("below"))
        both = F.when(F.col("_up").isNull(), F.array(here)).otherwise(F.array(here, there))
        joined = rows.join(step, F.col("cur") == F.col("_node"), "left")
        rows = joined.select("leaf", F.explode(both).alias("_p")).select("leaf", "_p.*")
    return rows.withColumnRenamed("cur", "node")


def _formatted(turns: DataFrame, links: DataFrame, template: Template, best: int) -> DataFrame:
    """``turns``: (node, head, body, masked, length, kept); ``links``: (node, up, tie, score, length)."""
    levels, circles = _levels(links)
    ranked = _branches(links, levels, circles).withColumn(
        "rank", F.row_number().over(W.partitionBy("root").orderBy(F.col("score").desc(), "tie", "leaf"))
    )
    chosen = materialize(ranked.where(F.col("rank") <= best).drop("tie"), "branches")
    posts = _unfolded(chosen, levels).join(turns, "node").select(
        "leaf", "kept",
        F.struct((-F.col("steps")).alias("place"), "below", "length", "head", "body", "masked").alias("post"),
    )
    gathered = posts.groupBy("leaf").agg(
        F.array_sort(F.collect_list("post")).alias("_posts"), F.min_by("kept", F.col("post.place")).alias("kept")
    )

    def span(post: Column) -> Column:
        start = F.col("length") - post["below"] - post["length"] + F.length(post["head"])
        return F.struct(start.alias("start"), (start + F.length(post["body"])).alias("end"))

    written = F.transform("_posts", lambda p: F.concat(p["head"], p["body"], F.lit(template.closing)))
    joined = gathered.join(chosen, "leaf")
    return joined.select(
        "kept.*", "rank", "score", "n_turns",
        F.array_join(written, "").alias("text"),
        F.transform(F.filter("_posts", lambda p: p["masked"]), span).alias("loss_spans"),
    )


def format_trees(
    posts: DataFrame, best: int = 1, template: Template = CHAT, loss_role: str = "assistant", keep: Sequence[str] = ("id",)
) -> DataFrame:
    """The ``best`` root-to-leaf paths of each reply tree, one formatted conversation each.

    ``posts`` has id, parent, role, text and score. Branches of a tree rank by the mean score of their
    posts, ties by the leaf's id, then by a hash of its text. Returns the ``keep`` columns of the root, ``rank`` from 1,
    ``score``, ``n_turns``, ``text``, and ``loss_spans``: start and end, in code points, of each text of ``loss_role``.

    A parent that is null or not in the table makes a root. A null role or text is empty, a null or NaN score is 0.
    A post without id has no replies. Of several posts with one id the first by hash of text, then role, gets the replies; the
    others are leaves. Posts that lead into a circle have no root and no conversation. Other columns, whatever
    their names, are not looked at; an empty table gives an empty one. A conversation is one row, so it is
    limited by the length of a string; no other group is held by a task.
    """
    score = F.nanvl(F.coalesce(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0))
    turns = posts.select(
        F.monotonically_increasing_id().alias("node"), F.col("id"), F.col("parent"), score.alias("score"),
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
        keyed_hash(0, F.col("text"), F.col("role")).alias("hash"), *_turn(template, "role", "text", loss_role),
    )
    turns = materialize(_with_length(turns, template), "turns")
    first = turns.where("id IS NOT NULL").groupBy(F.col("id").alias("parent")).agg(F.min_by("node", F.struct("hash", "node")).alias("up"))
    links = turns.join(first, "parent", "left").select("node", "up", F.struct("id", "hash").alias("tie"), "score", "length")
    return _formatted(turns, materialize(links, "links"), template, best)


def format_chains(
    rows: DataFrame, key: str, order: str, template: Template = CHAT, loss_role: str = "assistant"
) -> DataFrame:
    """Each group of rows (role, text) as one conversation in the order of ``order``: a tree with a single branch.

    Every row answers the one before it in its group; rows alike in ``order`` come by role, then by a hash of their text, and
    repeated rows each count. A null key is a group of its own, a null order comes first. Returns ``key`` and the columns of
    ``format_trees``, whose other rules hold. Rows are numbered without holding a group in one task.
    """
    turns = rows.select(
        F.monotonically_increasing_id().alias("node"), F.struct(F.col(f"`{key}`")).alias("kept"),
        F.col(f"`{order}`").alias("place"), F.col("role").alias("named"), keyed_hash(0, F.col("text")).alias("hash"),
        *_turn(template, "role", "text", loss_role),
    )
    turns = materialize(_with_length(turns, template), "turns")
    placed = turns.select("node", F.col(f"kept.`{key}`").alias("chain"), "place", "named", "hash", "length")
    numbered = materialize(row_numbers(placed, ["chain"], ["place", "named", "hash", "node"], "n"), "numbered")
    before = numbered.select("chain", (F.col("n") + 1).alias("n"), F.col("node").alias("up"))
    links = join_keys(numbered, before, ["chain", "n"], "left").select(
        "node", "up", F.col("node").alias("tie"), F.lit(0.0).alias("score"), "length"
    )
    return _formatted(turns, materialize(links, "links"), template, 1)


def read_back(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """``formatted`` with ``turns`` (role, text) parsed from its text and ``loss_texts`` cut out by its mask, both unescaped.

    The mask is applied to the text in four bytes a code point, so that a cut does not count from the start.
    """
    parts = F.split("text", "".join(f"\\x{ord(c):02x}" for c in template.closing))

    def turn(part: Column) -> Column:
        role = F.substring_index(F.substr(part, F.lit(len(template.opening) + 1)), "\n", 1)
        body = F.substr(part, F.length(role) + len(template.opening) + 2)
        return F.struct(F.url_decode(role).alias("role"), unescaped(body).alias("text"))

    def cuts(wide: Column) -> Column:
        def cut(span: Column) -> Column:
            start, length = span["start"].cast("int"), (span["end"] - span["start"]).cast("int")
            return unescaped(F.decode(F.substr(wide, start * 4 + 1, length * 4), "UTF-32"))

        return F.transform("loss_spans", cut)

    # The wide text stands in an array, so that it is made once and not for every span.
    wide = F.array(F.encode("text", "UTF-32"))
    return formatted.withColumns(
        {"turns": F.transform(F.slice(parts, 1, F.col("n_turns").cast("int")), turn), "loss_texts": F.get(F.transform(wide, cuts), F.lit(0))}
    )
