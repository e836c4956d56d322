"""Per-match samples: team vector, player matrix, ball sequence and label.

Arrays come in chunks (see ``sequences``): chunk 0 holds everything for any match of
ordinary length, and an oversized match continues in rows with higher chunk numbers.
``start`` is the number of elements before a chunk. No result depends on the chunk size:
batches number matches, shapes add up a match's chunks, positions count from ``start``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketworks.functions.arrays import pad, prefix
from wicketworks.operators.aggregates import CHUNK_ROWS, sequences
from wicketworks.operators.ordering import hash_unit
from wicketworks.operators.skew import join_keys
from wicketworks.operators.windows import row_numbers
from wicketworks.session import materialize

# Stage windows in overs, and balls per over.
WINDOW_OVERS = [20, 25, 30, 35, 40, 45]
EARLY_WINDOW_OVERS = [5, 10, 15, 20, 25, 30, 35, 40, 45]
BALLS_PER_OVER = 6

# Rounds of the permutation that orders an epoch.
EPOCH_ROUNDS = 24


def align(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner join of keyed collections: the keys all of them have."""
    return reduce(lambda a, b: a.join(b, key), tables)


def build_samples(
    balls: DataFrame,
    teams: DataFrame,
    players: DataFrame,
    key: str,
    ball_order: Sequence[str],
    ball_features: Sequence[str],
    team_features: Sequence[str],
    player_order: Sequence[str],
    player_features: Sequence[str],
    label: str,
    drop_last: int = 1,
    chunk_rows: int = CHUNK_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """(key, chunk, start, label, team, players, balls, n_balls) for the keys all three tables have.

    The label is that of the first ball; the last ``drop_last`` balls are left out. The team
    vector and the label stand in every chunk row of a match.
    """
    heads = balls.groupBy(key).agg(
        F.min_by(label, F.struct(*ball_order)).alias("label"),
        F.greatest(F.count(F.lit(1)) - drop_last, F.lit(0)).alias("n_balls"),
        F.count(F.lit(1)).alias("_n_rows"),
    )
    vector = F.array(*[F.col(f"`{f}`").cast("double") for f in team_features])
    sizes = players.groupBy(key).agg(F.count(F.lit(1)).alias("_n_players"))
    heads = align([heads, teams.select(key, vector.alias("team")), sizes], key)
    last = F.floor((F.greatest("_n_rows", "_n_players") - 1) / chunk_rows).cast("int")
    heads = heads.withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))

    ball_seq = sequences(balls, [key], ball_order, ball_features, chunk_rows, group_rows)
    player_seq = sequences(players, [key], player_order, player_features, chunk_rows, group_rows)
    # Left joins from the keys, not a full join, which would forget where the rows of bucketed tables lie.
    bodies = heads.join(ball_seq.select(key, "chunk", F.col("rows").alias("balls")), [key, "chunk"], "left")
    bodies = bodies.join(player_seq.select(key, "chunk", F.col("rows").alias("players")), [key, "chunk"], "left")
    empty = F.array().cast("array<array<double>>")
    left = F.col("n_balls") - F.col("chunk") * chunk_rows
    samples = bodies.select(
        key,
        "chunk",
        (F.col("chunk") * chunk_rows).alias("start"),
        "label",
        "team",
        F.coalesce("players", empty).alias("players"),
        prefix(F.coalesce("balls", empty), left).alias("balls"),
        "n_balls",
    )
    return samples.where(_holds_rows())


def _holds_rows() -> Column:
    """Chunk 0 stays even when it is empty, later chunks only where they hold something."""
    return (F.col("chunk") == 0) | (F.size("balls") > 0) | (F.size("players") > 0)


def split_of(key: str | Column, seed: int = 42) -> Column:
    """train / val / test for 80 / 10 / 10 percent of the keys in expectation."""
    draw = hash_unit(key, seed, 100)
    return F.when(draw < 80, "train").when(draw < 90, "val").otherwise("test")


def split_exact(keys: DataFrame, key: str, seed: int = 42, group_rows: int | None = None) -> DataFrame:
    """80 / 10 / 10 with exact sizes: keys ranked by hash, held-out sizes rounded up."""
    drawn = keys.select(key).distinct().withColumn("_draw", hash_unit(key, seed, 2**32))
    total = drawn.agg(F.count(F.lit(1))).scalar()
    held_out = F.ceil(total * F.lit(0.2))
    test = F.ceil(held_out * F.lit(0.5))
    ranked = row_numbers(drawn, [], ["_draw", key], "_rank", group_rows)
    split = (
        F.when(F.col("_rank") <= test, "test")
        .when(F.col("_rank") <= held_out, "val")
        .otherwise("train")
    )
    return ranked.select(key, split.alias("split"))


def augment(
    samples: DataFrame,
    windows: Sequence[int] = WINDOW_OVERS,
    unit: int = BALLS_PER_OVER,
) -> DataFrame:
    """One sample per window, holding the first ``window * unit`` balls, or all if there are fewer.

    A narrow transformation: other columns, the split included, are carried along.
    """
    staged = samples.withColumn("window", F.explode(F.array(*[F.lit(int(w)) for w in windows])))
    wanted = F.col("window") * unit - F.col("start")
    return (
        staged.withColumn("balls", prefix(F.col("balls"), wanted))
        .withColumn("n_balls", F.least(F.col("n_balls"), F.col("window") * unit))
        .where(_holds_rows())
    )


def assign_batches(
    samples: DataFrame,
    order: Sequence[str],
    batch_size: int,
    split: str = "split",
    group_rows: int | None = None,
) -> DataFrame:
    """0-based batch number inside each split, in the given order.

    Rows with chunks are numbered by their first chunk, so a batch holds ``batch_size`` samples
    however many chunks they have; ``order`` must then identify a sample. They are stored with their batch, as padding
    reads them more than once.
    """
    whole = "chunk" not in samples.columns
    heads = samples if whole else samples.where("chunk = 0").select(split, *order)
    numbered = row_numbers(heads, [split], order, "_n", group_rows)
    numbered = numbered.withColumn("batch_id", F.floor((F.col("_n") - 1) / batch_size)).drop("_n")
    return numbered if whole else materialize(join_keys(samples, numbered, [split, *order]), "batched")


def epoch_batches(
    numbered: DataFrame,
    batch_size: int,
    epoch: int | Column = 0,
    number: str = "number",
    split: str = "split",
    seed: int = 42,
    rounds: int = EPOCH_ROUNDS,
) -> DataFrame:
    """``place`` and ``batch_id`` of every sample in one epoch, from its 0-based number inside its split.

    The order of an epoch is a permutation keyed by seed and epoch, reckoned from the number alone: no sort and no
    exchange of samples. In each round a number and its mirror image about a drawn point change places or stay together, by a
    bit that both see, so that every place is taken once whatever the size of the split. Rows with chunks keep the
    place of their sample; rows without a number have none.
    """
    key = F.concat_ws(":", F.lit(seed).cast("string"), (F.lit(epoch) if isinstance(epoch, int) else epoch).cast("string"))
    keyed = numbered.withColumn("_key", key)
    groups = keyed.groupBy(F.col(split).alias("_of"), F.col("_key").alias("_for")).agg((F.max(number) + 1).alias("_size"))
    # One row per split and epoch: the points of its rounds are drawn here, once, and not again for every sample.
    sized = groups.groupBy("_of").agg(F.max("_size").alias("_size"), F.collect_list("_for").alias("_for"))
    sized = sized.select("_of", "_size", F.explode("_for").alias("_for"))

    def turn(r: Column) -> Column:
        drawn = F.concat_ws(":", "_for", r.cast("string"))
        point = F.conv(F.substring(F.md5(drawn), 1, 15), 16, 10).cast("bigint")
        return F.struct(F.pmod(point, "_size").alias("point"), F.concat(drawn, F.lit(":")).alias("drawn"))

    turns = sized.withColumn("_turns", F.transform(F.sequence(F.lit(0), F.lit(rounds - 1)), turn))

    def step(place: Column, turn: Column) -> Column:
        mirror = F.pmod(turn["point"] - place, F.col("_size"))
        bit = F.md5(F.concat(turn["drawn"], F.greatest(place, mirror).cast("string"))) >= "8"
        return F.when(bit, mirror).otherwise(place)

    drawn = keyed.join(turns, F.col(split).eqNullSafe(F.col("_of")) & (F.col("_key") == F.col("_for")))
    placed = drawn.withColumn("place", F.aggregate("_turns", F.col(number).cast("bigint"), step))
    return placed.withColumn("batch_id", F.floor(F.col("place") / batch_size)).drop("_key", "_of", "_for", "_size", "_turns")


def pad_batches(
    samples: DataFrame, array: str, width: int, key: Sequence[str], batch: Sequence[str] = ("split", "batch_id")
) -> DataFrame:
    """Zero-pad the sequences of a batch to the longest one in it (a batch is a bounded group).

    Chunks are padded one by one, and a sample that ends before the longest one gets the chunks that
    it lacks, filled with zeros and with its other arrays empty.
    """
    longest = samples.groupBy(*batch, "chunk").agg(F.max(F.size(array)).alias("padded_length"), F.max("start").alias("start"))
    longest = materialize(longest, "longest")
    zeros = F.array_repeat(F.lit(0.0), width)
    padded = samples.join(longest.drop("start"), [*batch, "chunk"])
    if not longest.where("chunk > 0").isEmpty():  # otherwise every sample is one chunk, and none is lacking
        heads = samples.where("chunk = 0").drop("chunk", "start").join(longest.where("chunk > 0"), list(batch))
        lacking = join_keys(heads, samples.select(*key, "chunk"), [*key, "chunk"], "left_anti")
        empty = [c for c, kind in samples.dtypes if kind.startswith("array<array") and c != "team"]
        lacking = lacking.withColumns({c: F.array().cast(samples.schema[c].dataType) for c in empty})
        padded = padded.unionByName(lacking)
    return padded.withColumn(array, pad(F.col(array), F.col("padded_length"), zeros))


def input_shapes(samples: DataFrame, key: Sequence[str]) -> DataFrame:
    """Team width, most player rows of a sample, player columns and ball columns."""

    def width(array: str) -> Column:
        return F.max(F.coalesce(F.size(F.try_element_at(F.col(array), F.lit(1))), F.lit(0)))

    per_sample = samples.groupBy(*key).agg(
        F.max(F.size("team")).alias("team_width"),
        F.sum(F.size("players")).cast("int").alias("player_rows"),
        width("players").alias("player_columns"),
        width("balls").alias("ball_columns"),
    )
    names = ["team_width", "player_rows", "player_columns", "ball_columns"]
    return per_sample.agg(*[F.max(n).alias(n) for n in names])


def explode_rows(samples: DataFrame, keys: Sequence[str], array: str, names: Sequence[str]) -> DataFrame:
    """A sequence back to one named row per element, with its 0-based position."""
    rows = samples.select(*keys, F.col("start").cast("int").alias("_start"), F.posexplode(array).alias("_i", "_v"))
    return rows.select(
        *keys,
        (F.col("_start") + F.col("_i")).alias("position"),
        *[F.col("_v")[i].alias(n) for i, n in enumerate(names)],
    )
