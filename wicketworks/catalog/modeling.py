"""Sample preparation, metrics, selection and profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from wicketworks.catalog import proxies as P
from wicketworks.catalog.registry import query, rounded
from wicketworks.catalog.relations import hash_sql
from wicketworks.catalog.sources import split_sql
from wicketworks.operators import frequent, metrics, modeling, profile, samples
from wicketworks.operators.aggregates import CHUNK_ROWS, sequences
from wicketworks.operators.windows import row_numbers
from wicketworks.session import scratch_path

_SEQ = f"({P.SEQUENCES}) AS s"
_POS = f"""SELECT conv_id, turn, n_chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
    count(*) OVER (PARTITION BY conv_id) AS total FROM {_SEQ}"""


def _sum_of(array, i):
    return F.aggregate(array, F.lit(0.0), lambda acc, row: acc + row[i]).cast("bigint")


def _conversation_samples(t, drop_last=1, chunk_rows=CHUNK_ROWS):
    """Conversations as balls, documents as teams, benchmark-shaped players: all keyed by conv_id."""
    turns = t.sql(P.SEQUENCES).withColumn("won", (F.col("role") == "user").cast("int"))
    teams = t.documents.select(
        F.col("doc_id").alias("conv_id"), F.col("n_chars"), F.length("lang").alias("lang_length")
    )
    players = t.lineitem.select(F.col("l_orderkey").alias("conv_id"), "l_linenumber", "l_quantity")
    return samples.build_samples(
        turns, teams, players, "conv_id", ["turn"], ["turn", "n_chars"], ["n_chars", "lang_length"],
        ["l_linenumber", "l_quantity"], ["l_linenumber", "l_quantity"], "won", drop_last, chunk_rows,
    )


@query(
    "m01_build_samples",
    f"""SELECT p.conv_id, max(CASE WHEN p.pos = 1 AND c.role = 'user' THEN 1 ELSE 0 END) AS label,
        max(p.total) - 1 AS n_balls, CAST(sum(CASE WHEN p.pos < p.total THEN p.n_chars ELSE 0 END) AS BIGINT) AS ball_chars,
        max(d.n_chars) AS team_chars, max(l.n_players) AS n_players, max(l.quantity) AS player_quantity
        FROM ({_POS}) AS p
        JOIN {{conversations}} AS c ON p.conv_id = c.conv_id AND p.turn = c.turn
        JOIN {{documents}} AS d ON d.doc_id = p.conv_id
        JOIN (SELECT l_orderkey, count(*) AS n_players, CAST(sum(l_quantity) AS BIGINT) AS quantity
              FROM {{lineitem}} GROUP BY l_orderkey) AS l ON l.l_orderkey = p.conv_id
        GROUP BY p.conv_id""",
)
def _(t):
    return _conversation_samples(t).select(
        "conv_id", "label", "n_balls", _sum_of("balls", 1).alias("ball_chars"),
        F.col("team")[0].cast("bigint").alias("team_chars"), F.size("players").cast("bigint").alias("n_players"),
        _sum_of("players", 1).alias("player_quantity"),
    )


_SAMPLE_CONTENTS = f"""WITH k AS (SELECT DISTINCT c.conv_id FROM {{conversations}} AS c
          WHERE c.conv_id IN (SELECT doc_id FROM {{documents}}) AND c.conv_id IN (SELECT l_orderkey FROM {{lineitem}}))
        SELECT p.conv_id, 'ball' AS part, CAST(pos - 1 AS INTEGER) AS position, CAST(turn AS DOUBLE) AS first,
               CAST(n_chars AS DOUBLE) AS second
        FROM ({_POS}) AS p JOIN k ON k.conv_id = p.conv_id WHERE pos < total
        UNION ALL
        SELECT l_orderkey, 'player', CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) - 1 AS INTEGER),
               CAST(l_linenumber AS DOUBLE), CAST(l_quantity AS DOUBLE) FROM {{lineitem}} JOIN k ON k.conv_id = l_orderkey
        UNION ALL
        SELECT doc_id, 'team', 0, CAST(n_chars AS DOUBLE), CAST(length(lang) AS DOUBLE) FROM {{documents}} JOIN k ON k.conv_id = doc_id"""


def _sample_contents(t, chunk_rows=CHUNK_ROWS):
    done = _conversation_samples(t, chunk_rows=chunk_rows)
    names = ["first", "second"]
    parts = [
        samples.explode_rows(done, ["conv_id"], array, names).withColumn("part", F.lit(part))
        for array, part in (("balls", "ball"), ("players", "player"))
    ]
    team = done.where("chunk = 0").select(
        "conv_id", F.lit(0).alias("position"), *[F.col("team")[i].alias(n) for i, n in enumerate(names)], F.lit("team").alias("part")
    )
    return parts[0].unionByName(parts[1]).unionByName(team)


@query("m01_sample_contents", _SAMPLE_CONTENTS)
def _(t):
    return _sample_contents(t)


@query("m01_sample_contents_in_small_chunks", _SAMPLE_CONTENTS)
def _(t):
    return _sample_contents(t, chunk_rows=2)


@query("m02_hash_split", f"SELECT o_orderkey, {split_sql('o_orderkey')} AS split FROM {{orders}}")
def _(t):
    return t.orders.select("o_orderkey", samples.split_of("o_orderkey").alias("split"))


@query(
    "m02_exact_split",
    f"""SELECT o_orderkey, CASE WHEN n <= ceil(ceil(total * 0.2) * 0.5) THEN 'test' WHEN n <= ceil(total * 0.2) THEN 'val'
        ELSE 'train' END AS split
        FROM (SELECT o_orderkey, count(*) OVER () AS total,
                     row_number() OVER (ORDER BY {hash_sql('o_orderkey', 42, 2**32)}, o_orderkey) AS n FROM {{orders}}) AS x""",
)
def _(t):
    return samples.split_exact(t.orders, "o_orderkey")


_WINDOWS = [1, 2, 3]


def _augmented(t):
    seq = sequences(t.sql(P.SEQUENCES), ["conv_id"], ["turn"], ["turn", "n_chars"])
    whole = seq.select(
        "conv_id", "chunk", "start", F.col("rows").alias("balls"), F.array().cast("array<array<double>>").alias("players"),
        F.size("rows").cast("bigint").alias("n_balls"), samples.split_of("conv_id").alias("split"),
    )
    return samples.augment(whole, _WINDOWS, unit=2)


_AUGMENTED = f"""SELECT conv_id, w.k AS "window", least(max(total), w.k * 2) AS n_balls,
    CAST(sum(CASE WHEN pos <= w.k * 2 THEN n_chars ELSE 0 END) AS BIGINT) AS chars, {split_sql('conv_id')} AS split
    FROM ({_POS}) AS p CROSS JOIN (VALUES (1), (2), (3)) AS w(k) GROUP BY conv_id, w.k"""


@query("m03_stage_prefixes", f'SELECT conv_id, "window", n_balls, chars FROM ({_AUGMENTED}) AS a')
def _(t):
    return _augmented(t).select("conv_id", "window", "n_balls", _sum_of("balls", 1).alias("chars"))


@query(
    "m04_stage_prefixes_per_split",
    f"""SELECT split, "window", count(*) AS n_samples, CAST(sum(n_balls) AS BIGINT) AS n_balls FROM ({_AUGMENTED}) AS a
        GROUP BY split, "window" """,
)
def _(t):
    counted = _augmented(t).groupBy("split", "window")
    return counted.agg(F.count_if(F.col("chunk") == 0).alias("n_samples"), F.sum(F.size("balls")).alias("n_balls"))


_PADDED = f"""SELECT conv_id, split, batch_id, n_balls, max(n_balls) OVER (PARTITION BY split, batch_id) AS padded_length, chars
        FROM (SELECT conv_id, split, CAST(floor((row_number() OVER (PARTITION BY split ORDER BY conv_id) - 1) / 4) AS BIGINT) AS batch_id,
                     n_balls, chars
              FROM (SELECT conv_id, {split_sql('conv_id')} AS split, count(*) AS n_balls,
                           CAST(sum(n_chars) AS BIGINT) AS chars FROM {_SEQ} GROUP BY conv_id) AS g) AS b"""


def _padded(t, chunk_rows=CHUNK_ROWS):
    seq = sequences(t.sql(P.SEQUENCES), ["conv_id"], ["turn"], ["turn", "n_chars"], chunk_rows)
    named = seq.select("conv_id", "chunk", "start", F.col("rows").alias("balls"), samples.split_of("conv_id").alias("split"))
    batched = samples.assign_batches(named, ["conv_id"], 4)
    own = batched.groupBy("conv_id").agg(F.sum(F.size("balls")).alias("n_balls"))
    padded = samples.pad_batches(batched, "balls", 2, ["conv_id"]).groupBy("conv_id", "split", "batch_id").agg(
        F.sum(F.size("balls")).alias("padded_length"), F.sum(_sum_of("balls", 1)).alias("chars")
    )
    return padded.join(own, "conv_id")


@query("m05_padded_batches", _PADDED)
def _(t):
    return _padded(t)


@query("m05_padded_batches_in_small_chunks", _PADDED)
def _(t):
    return _padded(t, chunk_rows=2)


@query(
    "m05_batches_of_two_epochs",
    f"""WITH RECURSIVE s AS (
        SELECT o_orderkey, split, row_number() OVER (PARTITION BY split ORDER BY o_orderkey) - 1 AS x, count(*) OVER (PARTITION BY split) AS n
        FROM (SELECT o_orderkey, {split_sql('o_orderkey')} AS split FROM {{orders}}) AS k
    ), w AS (
        SELECT o_orderkey, split, n, epoch, x, 0 AS r FROM s CROSS JOIN (VALUES (0), (1)) AS e(epoch)
        UNION ALL
        SELECT o_orderkey, split, n, epoch, CASE WHEN md5(t || ':' || greatest(x, p)) >= '8' THEN p ELSE x END, r + 1
        FROM (SELECT *, ((CAST('0x' || substr(md5(t), 1, 15) AS BIGINT) % n - x) % n + n) % n AS p
              FROM (SELECT *, '42:' || epoch || ':' || r AS t FROM w WHERE r < {samples.EPOCH_ROUNDS}) AS a) AS b
    )
    SELECT o_orderkey, split, epoch, x AS place, x // 16 AS batch_id FROM w WHERE r = {samples.EPOCH_ROUNDS}""",
)
def _(t):
    named = t.orders.select("o_orderkey", samples.split_of("o_orderkey").alias("split"))
    numbered = row_numbers(named, ["split"], ["o_orderkey"], "number").withColumn("number", F.col("number") - 1)
    # Numbering leaves a whole split to few tasks; the rounds of an epoch cost far more than dealing the numbers anew.
    numbered = numbered.repartition("split", "number")
    epochs = numbered.withColumn("epoch", F.explode(F.array(F.lit(0), F.lit(1))))
    return samples.epoch_batches(epochs, 16, F.col("epoch")).drop("number")


_SHAPES = """SELECT 2 AS team_width, CAST(max(n) AS INTEGER) AS player_rows, 2 AS player_columns, 2 AS ball_columns
       FROM (SELECT count(*) AS n FROM {lineitem} WHERE l_orderkey IN (SELECT conv_id FROM {conversations})
             AND l_orderkey IN (SELECT doc_id FROM {documents}) GROUP BY l_orderkey) AS x"""


@query("m06_input_shapes", _SHAPES)
def _(t):
    return samples.input_shapes(_conversation_samples(t), ["conv_id"])


@query("m06_input_shapes_in_small_chunks", _SHAPES)
def _(t):
    return samples.input_shapes(_conversation_samples(t, chunk_rows=2), ["conv_id"])


_EXPLODED = f"SELECT conv_id, CAST(pos - 1 AS INTEGER) AS position, CAST(turn AS DOUBLE) AS turn, CAST(n_chars AS DOUBLE) AS n_chars FROM ({_POS}) AS p"


@query("m07_explode_to_rows", _EXPLODED)
def _(t):
    seq = sequences(t.sql(P.SEQUENCES), ["conv_id"], ["turn"], ["turn", "n_chars"])
    return samples.explode_rows(seq, ["conv_id"], "rows", ["turn", "n_chars"])


@query("m07_explode_small_chunks_to_rows", _EXPLODED)
def _(t):
    seq = sequences(t.sql(P.SEQUENCES), ["conv_id"], ["turn"], ["turn", "n_chars"], chunk_rows=2)
    return samples.explode_rows(seq, ["conv_id"], "rows", ["turn", "n_chars"])


def _scored(t):
    return metrics.predict(t.sql(P.SCORED))


_PRED = f"(SELECT doc_id, label, probability, CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS prediction FROM ({P.SCORED}) AS s0) AS s"
_COUNTS = """CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn"""


def _safe(a: str, b: str) -> str:
    return f"round(coalesce(({a}) / nullif({b}, 0), 0), 8)"


_SCORES = f"""{_safe('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {_safe('tp', 'tp + fp')} AS precision,
    {_safe('tp', 'tp + fn')} AS recall, {_safe('2 * tp', '2 * tp + fp + fn')} AS f1"""


def _round8(df, names=("accuracy", "precision", "recall", "f1")):
    return df.withColumns({n: F.round(n, 8) for n in names})


@query("e01_threshold", f"SELECT doc_id, prediction FROM {_PRED}")
def _(t):
    return _scored(t).select("doc_id", "prediction")


@query(
    "e02_accuracy_percent",
    f"SELECT round(100 * avg(CASE WHEN label = prediction THEN 1 ELSE 0 END), 6) AS accuracy_percent FROM {_PRED}",
)
def _(t):
    return metrics.accuracy_percent(_scored(t)).select(F.round("accuracy_percent", 6).alias("accuracy_percent"))


@query("e03_binary_scores", f"SELECT {_SCORES} FROM (SELECT {_COUNTS} FROM {_PRED}) AS c")
def _(t):
    return _round8(metrics.binary_scores(_scored(t)))


@query(
    "e03_binary_scores_per_group",
    f"SELECT lang, {_SCORES} FROM (SELECT lang, {_COUNTS} FROM {_PRED} JOIN {{documents}} AS d ON d.doc_id = s.doc_id GROUP BY lang) AS c",
)
def _(t):
    scored = _scored(t).join(t.documents.select("doc_id", "lang"), "doc_id")
    return _round8(metrics.binary_scores(scored, ["lang"]))


def _staged_sql(windows):
    values = ", ".join(f"({w})" for w in windows)
    return f"""SELECT w.k AS "window", {_COUNTS}
        FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS n FROM {_PRED}) AS s
        CROSS JOIN (VALUES {values}) AS w(k) WHERE n <= w.k * 6 GROUP BY w.k"""


_STAGED = _staged_sql(samples.WINDOW_OVERS)


@query("e04_staged_scores", f'SELECT "window", {_SCORES} FROM ({_STAGED}) AS c')
def _(t):
    return _round8(metrics.staged_scores(_scored(t), ["doc_id"]))


@query(
    "e05_confusion_matrix",
    f"""SELECT g.a AS actual, g.p AS predicted, count(s.doc_id) AS n
        FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS g(a, p)
        LEFT JOIN {_PRED} ON s.label = g.a AND s.prediction = g.p GROUP BY g.a, g.p""",
)
def _(t):
    return metrics.confusion_matrix(_scored(t))


def _report_row(name, precision, recall, f1, support):
    return (
        f"SELECT '{name}' AS class, round({precision}, 8) AS precision, round({recall}, 8) AS recall, "
        f"round({f1}, 8) AS f1, CAST({support} AS BIGINT) AS support FROM v"
    )


_ACC = "(tp + tn) / (tp + fp + fn + tn)"


def _weighted(key):
    return f"({key}0 * (tn + fp) + {key}1 * (tp + fn)) / (tp + fp + fn + tn)"


@query(
    "e06_classification_report",
    f"""WITH v AS (SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
          coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f0, coalesce(tp / nullif(tp + fp, 0), 0) AS p1,
          coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
        FROM (SELECT {_COUNTS} FROM {_PRED}) AS c)
        {_report_row('Loss', 'p0', 'r0', 'f0', 'tn + fp')} UNION ALL {_report_row('Win', 'p1', 'r1', 'f1', 'tp + fn')}
        UNION ALL {_report_row('accuracy', _ACC, _ACC, _ACC, 'tp + fp + fn + tn')}
        UNION ALL {_report_row('macro avg', '(p0 + p1) / 2', '(r0 + r1) / 2', '(f0 + f1) / 2', 'tp + fp + fn + tn')}
        UNION ALL {_report_row('weighted avg', _weighted('p'), _weighted('r'), _weighted('f'), 'tp + fp + fn + tn')}""",
)
def _(t):
    report = metrics.classification_report(_scored(t), ("Loss", "Win"))
    return _round8(report, ("precision", "recall", "f1"))


_POINTS = f"""SELECT threshold, p, n, sum(p) OVER (ORDER BY threshold DESC) AS tp, sum(n) OVER (ORDER BY threshold DESC) AS fp,
    sum(p) OVER () AS all_p, sum(n) OVER () AS all_n
    FROM (SELECT probability AS threshold, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
          FROM {_PRED} GROUP BY probability) AS g"""


@query(
    "e07_roc_points",
    f"""SELECT threshold, round(CAST(fp AS DOUBLE) / CAST(all_n AS DOUBLE), 8) AS fpr,
        round(CAST(tp AS DOUBLE) / CAST(all_p AS DOUBLE), 8) AS tpr FROM ({_POINTS}) AS q
        UNION ALL SELECT NULL, 0, 0""",
)
def _(t):
    return _round8(metrics.roc_points(_scored(t)), ("fpr", "tpr"))


@query(
    "e08_area_under_curve",
    f"""SELECT round(CAST(sum(n * (2 * tp - p)) AS DOUBLE) / 2 / CAST(max(all_p) AS DOUBLE) / CAST(max(all_n) AS DOUBLE), 8) AS auc
        FROM ({_POINTS}) AS q""",
)
def _(t):
    return metrics.area_under_curve(_scored(t)).select(F.round("auc", 8).alias("auc"))


_LOSS = "-(label * greatest(ln(probability), -100) + (1 - label) * greatest(ln(1 - probability), -100))"


@query("e09_cross_entropy", f"SELECT round(avg({_LOSS}), 8) AS loss FROM {_PRED}")
def _(t):
    return metrics.cross_entropy(_scored(t)).select(F.round("loss", 8).alias("loss"))


@query(
    "e09_cross_entropy_of_batches",
    f"""SELECT round(avg(loss), 8) AS loss FROM (SELECT b, avg({_LOSS}) AS loss FROM
        (SELECT *, floor((row_number() OVER (ORDER BY doc_id) - 1) / 16) AS b FROM {_PRED}) AS x GROUP BY b) AS y""",
)
def _(t):
    scored = _scored(t).withColumn("split", F.lit("test"))
    batched = samples.assign_batches(scored, ["doc_id"], 16)
    loss = metrics.cross_entropy(batched, batch=["split", "batch_id"])
    return loss.select(F.round("loss", 8).alias("loss"))


@query(
    "e10_metrics_table",
    f"""SELECT CAST("window" AS STRING) || ' overs' AS stage, {_SCORES} FROM ({_STAGED}) AS c
        UNION ALL SELECT 'Overall', {_SCORES} FROM (SELECT {_COUNTS} FROM {_PRED}) AS d""",
)
def _(t):
    return _round8(metrics.metrics_table(_scored(t), ["doc_id"]))


_HISTORY = f"""SELECT *, row_number() OVER (ORDER BY epoch) AS i,
    min(val_loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
    FROM ({P.HISTORY}) AS h"""
_MARKED = f"""SELECT epoch, val_loss, improved, i - max(CASE WHEN improved = 1 THEN i END) OVER (ORDER BY epoch) AS since_best
    FROM (SELECT *, CASE WHEN best_before IS NULL OR val_loss < best_before THEN 1 ELSE 0 END AS improved FROM ({_HISTORY}) AS a) AS b"""


@query("e11_training_history", f"SELECT epoch, val_loss, improved, since_best FROM ({_MARKED}) AS m")
def _(t):
    return metrics.training_history(t.sql(P.HISTORY)).select("epoch", "val_loss", "improved", "since_best")


@query(
    "e11_early_stop",
    f"""WITH m AS ({_MARKED}), s AS (SELECT coalesce(min(CASE WHEN since_best >= 10 THEN epoch END), max(epoch)) AS stop_epoch FROM m)
        SELECT stop_epoch, epoch AS best_epoch, val_loss AS best_loss FROM m, s WHERE epoch <= stop_epoch
        ORDER BY val_loss, epoch LIMIT 1""",
)
def _(t):
    return metrics.early_stop(t.sql(P.HISTORY))


# One-hot groups of orders: an unpenalised fit predicts exactly the mean label of each group.
GROUPS = 5


def grouped_orders(t, groups=GROUPS):
    """Orders with their label, split and group, and a 0/1 column for every group but the first."""
    group = F.col("o_custkey") % groups
    features = {f"g{i}": (group == i).cast("double") for i in range(1, groups)}
    chosen = t.orders.select(
        "o_orderkey", (F.col("o_totalprice") > 150000).cast("int").alias("label"), samples.split_of("o_orderkey").alias("split"),
        *[c.alias(n) for n, c in features.items()],
    )
    return chosen, list(features)


def fit_groups(data, features):
    train = modeling.weighted(data.where("split = 'train'"), features)
    return modeling.baseline_classifier(features, weightCol="weight", tol=1e-12, maxIter=500).fit(train)


def grouped_sql(groups=GROUPS):
    return f"""SELECT o_orderkey, o_custkey % {groups} AS g, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS label,
        {split_sql('o_orderkey')} AS split FROM {{orders}}"""


_GROUP_MEANS = f"""WITH o AS ({grouped_sql()}), m AS (SELECT g, avg(label) AS p FROM o WHERE split = 'train' GROUP BY g)"""


@query("e12_baseline_classifier", f"{_GROUP_MEANS} SELECT o_orderkey, label, round(p, 4) AS probability FROM o JOIN m ON o.g = m.g WHERE split = 'test'")
def _(t):
    data, features = grouped_orders(t)
    scored = modeling.score(fit_groups(data, features), data.where("split = 'test'"), ["o_orderkey", "label"])
    return scored.withColumn("probability", F.round("probability", 4))


@query(
    "e13_parameter_search",
    f"""{_GROUP_MEANS} SELECT CAST(50 AS BIGINT) AS n_trials,
        round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 5) AS unpenalised_loss FROM o JOIN m ON o.g = m.g WHERE split = 'val'""",
)
def _(t):
    data, features = grouped_orders(t)
    trials = modeling.parameter_search(data, features)
    table = t.spark.createDataFrame([(x.trial, x.params["regParam"], x.val_loss) for x in trials], "trial INT, penalty DOUBLE, val_loss DOUBLE")
    return table.agg(
        F.count("val_loss").alias("n_trials"), F.round(F.max(F.when(F.col("penalty") == 0, F.col("val_loss"))), 5).alias("unpenalised_loss")
    )


@query("e14_batch_scoring", f"{_GROUP_MEANS} SELECT o_orderkey, split, label, round(p, 4) AS probability FROM o JOIN m ON o.g = m.g")
def _(t):
    data, features = grouped_orders(t)
    path = modeling.save_model(fit_groups(data, features), scratch_path(t.spark, "model"))
    scored = modeling.score(modeling.load_model(path), data, ["o_orderkey", "split", "label"])
    return scored.withColumn("probability", F.round("probability", 4))


def _profile_sql(table, columns):
    parts = []
    for name, kind, numeric in columns:
        number = f"CAST({name} AS DOUBLE)"
        shown = f"CAST({name} AS STRING)"
        low, high = f"min({name})", f"max({name})"
        parts.append(
            f"SELECT '{name}' AS \"column\", '{kind}' AS type, count({name}) AS n, count(*) - count({name}) AS missing, "
            f"count(DISTINCT {name}) AS n_distinct, "
            + (
                f"CAST(CAST({low} AS DOUBLE) AS STRING) AS min_value, CAST(CAST({high} AS DOUBLE) AS STRING) AS max_value, "
                f"round(avg({number}), 4) AS mean, round(stddev({number}), 4) AS stddev, "
                f"CAST(quantile_disc({name}, 0.25) AS DOUBLE) AS q1, CAST(quantile_disc({name}, 0.5) AS DOUBLE) AS median, "
                f"CAST(quantile_disc({name}, 0.75) AS DOUBLE) AS q3"
                if numeric
                else f"{low} AS min_value, {high} AS max_value, NULL AS mean, NULL AS stddev, NULL AS q1, NULL AS median, NULL AS q3"
            )
            + f" FROM {table}"
        )
    return " UNION ALL ".join(parts)


@query(
    "e15_column_profile",
    _profile_sql(
        "{lineitem}",
        [("l_orderkey", "bigint", True), ("l_partkey", "bigint", True), ("l_suppkey", "bigint", True), ("l_linenumber", "int", True),
         ("l_quantity", "double", True), ("l_extendedprice", "double", True), ("l_discount", "double", True), ("l_tax", "double", True),
         ("l_returnflag", "string", False), ("l_linestatus", "string", False), ("l_shipdate", "timestamp_ntz", False)],
    ),
)
def _(t):
    # More steps than rows, so that the quartiles are exact and can be compared.
    return profile.column_profile(t.lineitem, exact_distinct=True, accuracy=5_000_000, digits=4)


@query(
    "e16_top_values",
    """SELECT "column", value, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank
       FROM (SELECT 'p_brand' AS "column", p_brand AS value, count(*) AS n FROM {part} GROUP BY p_brand
             UNION ALL SELECT 'p_type', p_type, count(*) FROM {part} GROUP BY p_type
             UNION ALL SELECT 'p_size', CAST(p_size AS STRING), count(*) FROM {part} GROUP BY p_size) AS c) AS r WHERE rank <= 5""",
)
def _(t):
    return profile.top_values(t.part, ["p_brand", "p_type", "p_size"], 5)


@query(
    "e16_correlations",
    """SELECT 'l_quantity' AS left_column, 'l_extendedprice' AS right_column, round(corr(l_quantity, l_extendedprice), 6) AS corr FROM {lineitem}
       UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) FROM {lineitem}
       UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM {lineitem}""",
)
def _(t):
    return profile.correlations(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"], digits=6)


@query(
    "e16_duplicate_rows",
    """SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS copies FROM {lineitem}
       GROUP BY l_orderkey, l_linenumber, l_returnflag HAVING count(*) > 1""",
)
def _(t):
    return profile.duplicate_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"))


_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINE_VALUES = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS STRING) AS value, count(*) AS n FROM {{lineitem}} GROUP BY {c}" for c in _LINE_COLUMNS
)


@query(
    "e16_frequent_values_of_all_columns",
    f"""SELECT "column", value, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS LAST) AS rank
        FROM ({_LINE_VALUES}) AS c) AS r WHERE rank <= 5""",
)
def _(t):
    return frequent.frequent_values(t.lineitem, _LINE_COLUMNS)


@query(
    "e16_correlations_of_all_columns",
    " UNION ALL ".join(
        f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({a}, {b}), 6) AS corr FROM {{lineitem}}"
        for a, b in combinations(_LINE_COLUMNS[:8], 2)
    ),
)
def _(t):
    return frequent.correlation_matrix(t.lineitem, digits=6)
