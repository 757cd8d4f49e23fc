"""Predict delayed flights from schedule columns with a random forest: trees grown from grouped
counts, or Spark ML's.

Nothing known only after departure is used: no actual times, delays or causes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import floor, pi

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions.numeric import asc, desc, ratio
from skyledger.operators.running import running_sums
from skyledger.operators.sampling import row_hash
from skyledger.operators.scoring import dense_rank_by, over_all
from skyledger.operators.topk import top_k
from skyledger.operators.trees import (
    Forest,
    Growth,
    grow,
    importances,
    mean_attributions,
    scores,
)
from skyledger.session import small_methods, write_shared
from skyledger.sources.sinks import write_table

# Model inputs in order, with the names used in reports.
FEATURES = {
    "carrier_enc": "Carrier",
    "origin_enc": "Origin Airport",
    "dest_enc": "Dest Airport",
    "distance": "Distance (mi)",
    "hour_of_day": "Hour of Day",
    "hour_sin": "Hour (sin)",
    "hour_cos": "Hour (cos)",
    "day_of_week": "Day of Week",
    "dow_sin": "DoW (sin)",
    "dow_cos": "DoW (cos)",
    "month": "Month",
    "month_sin": "Month (sin)",
    "month_cos": "Month (cos)",
    "day_of_month": "Day of Month",
    "quarter": "Quarter",
    "is_weekend": "Is Weekend",
}
# Training rows that a forest is fitted on, at most about; every row is split, scored and evaluated.
FIT_ROWS = 200_000
TEST_SHARE = 0.2
SEED = 42
OTHER_AIRPORT = "OTHER"
# Rows around the cut of the split that are put in order, and equal rows made at once.
CUT_ROWS, COPIES = 100_000, 10_000
KEY_DIGITS = 32
# Sorts after any hexadecimal key.
PAST_ALL_KEYS = "~"
# Columns of a modelling row; their hash decides on which side of the split it falls.
MODELLED = (
    "carrier_code", "origin", "dest", "distance", "hour_of_day", "day_of_week", "month",
    "day_of_month", "quarter", "is_weekend", "is_delayed",
)


def modelling_rows(flights: DataFrame) -> DataFrame:
    """Flights with a known outcome, each with the hash of its columns as ``key``."""
    known = flights.filter(
        F.col("arr_delay_minutes").isNotNull() & F.col("is_delayed").isNotNull()
    )
    return known.select(*MODELLED, row_hash(MODELLED).alias("key"))


def group_airports(rows: DataFrame, column: str, keep: int = 50) -> DataFrame:
    """Add ``<column>_grp``: the code for the ``keep`` busiest airports, OTHER for the rest."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    busiest = top_k(counts, [*desc("n"), *asc(column)], keep).select(
        F.col(column), F.lit(True).alias("is_busy")
    )
    # Written, so that the rows read so far are counted once.
    busiest, _ = write_shared(busiest, "busiest")
    joined = rows.join(F.broadcast(busiest), column, "left")
    group = F.when(F.col("is_busy"), F.col(column)).otherwise(F.lit(OTHER_AIRPORT))
    return joined.withColumn(f"{column}_grp", group).drop("is_busy")


def add_cycles(rows: DataFrame) -> DataFrame:
    """Sine and cosine of hour, weekday and month, so that their ends meet."""

    def turn(column: str, period: int) -> Column:
        return F.lit(2 * pi) * F.col(column) / F.lit(float(period))

    return rows.withColumns(
        {
            "hour_sin": F.sin(turn("hour_of_day", 24)),
            "hour_cos": F.cos(turn("hour_of_day", 24)),
            "dow_sin": F.sin(turn("day_of_week", 7)),
            "dow_cos": F.cos(turn("day_of_week", 7)),
            "month_sin": F.sin(turn("month", 12)),
            "month_cos": F.cos(turn("month", 12)),
        }
    )


def _codes(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Number the values of a column alphabetically, null last. There are few: carriers, or
    the airports kept.

    They are written, so that Spark joins by the size of their file. Of an aggregate it knows no
    size but that of the rows beneath, and would shuffle all of these.
    """
    values = rows.select(F.col(column).alias("__value")).distinct()
    number = (dense_rank_by(*asc("__value")) - 1).cast("double")
    codes, _ = write_shared(values.select("__value", number.alias(name)), "codes")
    return rows.join(codes, F.col(column).eqNullSafe(F.col("__value")), "left").drop("__value")


def engineer(rows: DataFrame, keep: int = 50) -> DataFrame:
    """The sixteen feature columns, ``label`` and ``key``; rows with a missing feature are dropped."""
    coded = group_airports(group_airports(rows, "origin", keep), "dest", keep)
    for column, name in (
        ("carrier_code", "carrier_enc"), ("origin_grp", "origin_enc"), ("dest_grp", "dest_enc"),
    ):
        coded = _codes(coded, column, name)
    coded = coded.withColumn("label", F.col("is_delayed").cast("double"))
    # Cycles are missing where hour, weekday or month is.
    known = coded.dropna(subset=[f for f in FEATURES if f in coded.columns] + ["label", "key"])
    return add_cycles(known).select(*FEATURES, "label", "key")


def _cuts(rows: DataFrame, share: float, bound: int) -> dict[float, tuple[str, int, int]]:
    """By label: the digits that the keys around the cut begin with, rows below these, and rows wanted.

    Each round counts the rows that begin with the digits so far by three digits more, at most
    4,096 counts a label, until at most ``bound`` rows are left or the digits are a whole key.
    """
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    cuts = {label: ("", 0, floor(n * share)) for label, n in totals.items()}
    todo, length = set(cuts), 0
    while todo and length < KEY_DIGITS:
        length += 3
        within = reduce(Column.__or__, [_at_cut(label, cuts[label][0]) for label in todo])
        prefix = F.substring("key", 1, length).alias("prefix")
        counts = rows.filter(within).groupBy("label", prefix).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("label").orderBy("prefix"))
        wanted = F.create_map(*[F.lit(x) for k in todo for x in (k, cuts[k][2] - cuts[k][1])])
        found = counts.withColumn("upto", upto).filter(
            (F.col("upto") - F.col("n") <= wanted[F.col("label")]) & (F.col("upto") > wanted[F.col("label")])
        )
        hits = {r.label: r for r in found.collect()}
        for label in list(todo):
            _, before, want = cuts[label]
            if label not in hits:  # all rows are wanted
                cuts[label] = (PAST_ALL_KEYS, before, want)
                todo.remove(label)
                continue
            hit = hits[label]
            cuts[label] = (hit.prefix, before + hit.upto - hit.n, want)
            if hit.n <= bound:
                todo.remove(label)
    return cuts


def _at_cut(label: float, prefix: str) -> Column:
    return (F.col("label") == label) & F.col("key").startswith(prefix)


def mark_test(rows: DataFrame, share: float = TEST_SHARE, bound: int = CUT_ROWS) -> DataFrame:
    """Add ``is_test``: of each label the rows with the lowest keys, ``share`` of them exactly.

    Only rows whose keys begin like the cut's are put in order, ``bound`` of them at most or, if
    more rows are equal, one with their number. Rows with equal keys are equal.
    """
    cuts = _cuts(rows, share, bound)
    if not cuts:
        return rows.withColumn("is_test", F.lit(False))
    at_cut = reduce(Column.__or__, [_at_cut(label, cut[0]) for label, cut in cuts.items()])
    below = reduce(
        Column.__or__,
        [(F.col("label") == label) & (F.col("key") < cut[0]) for label, cut in cuts.items()],
    )
    left = F.create_map(*[F.lit(x) for k, (_, before, want) in cuts.items() for x in (k, want - before)])
    equal = rows.filter(at_cut).groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(
        Window.partitionBy("label").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    )
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES))).alias("chunk")
    last = F.least(F.col("n"), (F.col("chunk") + 1) * COPIES)
    copies = F.explode(F.sequence(F.col("chunk") * COPIES + 1, last)).alias("copy")
    ordered = (
        equal.withColumn("before", upto - F.col("n"))
        .select("*", chunk)
        .select("*", copies)
        .withColumn("is_test", F.col("before") + F.col("copy") <= left[F.col("label")])
    )
    at_cut_rows, _ = write_shared(ordered.select(*rows.columns, "is_test"), "cut")
    return rows.filter(~at_cut).withColumn("is_test", below).union(at_cut_rows)


def prepare(flights: DataFrame, test_share: float = TEST_SHARE) -> DataFrame:
    """Engineered rows, each marked for training or test, written to shared storage once.

    Training reads it many times over; it has as many partitions as its size asks for. The mark is
    a comparison with the key that is written, apart from the rows around the cut.
    """
    with small_methods(flights.sparkSession):
        rows, _ = write_shared(engineer(modelling_rows(flights)), "delay-model-rows")
    return assemble(mark_test(rows, test_share))


def assemble(rows: DataFrame) -> DataFrame:
    """Add the ``features`` vector; the three codes are marked as categories."""
    assembler = VectorAssembler(
        inputCols=list(FEATURES), outputCol="features", handleInvalid="skip"
    )
    return assembler.transform(rows)


def split(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    return prepared.filter(~F.col("is_test")), prepared.filter(F.col("is_test"))


def fit_rows(train: DataFrame, bound: int = FIT_ROWS) -> DataFrame:
    """About ``bound`` rows, those whose last key digits lie under a threshold; all if fewer."""
    digits = F.conv(F.substring("key", 25, 8), 16, 10).cast("bigint")
    total = train.agg(F.count(F.lit(1))).scalar()
    return train.filter(digits * total < F.lit(bound * 2**32))


def balanced(train: DataFrame) -> DataFrame:
    """Add weights that give both labels the same total. The counts are two rows."""
    counts = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(over_all())
    weights = counts.select("label", ratio(total, F.lit(2) * F.col("n")).alias("weight"))
    return train.join(F.broadcast(weights), "label")


def train_forest(
    train: DataFrame,
    trees: int = 500,
    depth: int = 18,
    min_leaf: int = 50,
    seed: int = SEED,
) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt",
        maxBins=64,
        seed=seed,
    )
    return forest.fit(balanced(fit_rows(train)))


def score(model: RandomForestClassificationModel, rows: DataFrame) -> DataFrame:
    """(label, prediction, probability of delay) per row."""
    return model.transform(rows).select(
        "label", "prediction", vector_to_array("probability")[1].alias("probability")
    )


def tree_inputs(rows: DataFrame) -> DataFrame:
    """Features as trees take them: sines and cosines to nine digits, so that equal angles are equal.

    No sine or cosine of these lies halfway between two roundings, so plain arithmetic rounds it as
    ``F.round`` does, without a decimal for each value.
    """
    cycles = [f for f in FEATURES if f.endswith(("_sin", "_cos"))]
    return rows.withColumns(
        {f: F.floor(F.col(f) * F.lit(1e9) + F.lit(0.5)).cast("double") / F.lit(1e9) for f in cycles}
    )


def grow_forest(train: DataFrame, growth: Growth = Growth()) -> Forest:
    """Trees grown from counts over all training rows; both labels weigh the same in total."""
    return grow(tree_inputs(train.select(*FEATURES, "label", "key")), list(FEATURES), growth)


def trees_scorer(forest: Forest) -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``probability`` and ``prediction`` (above a half)."""

    def add(rows: DataFrame) -> DataFrame:
        found = tree_inputs(rows).withColumn("probability", scores(forest))
        return found.withColumn("prediction", (F.col("probability") > 0.5).cast("double"))

    return add


def node_table(spark: SparkSession, forest: Forest) -> DataFrame:
    """The forest's nodes, with the names of the features they split by."""
    names = F.array(*map(F.lit, FEATURES.values()))
    return forest.table(spark).withColumn("feature", F.get(names, F.col("feature")))


def tree_importance(spark: SparkSession, forest: Forest) -> DataFrame:
    """Gini importance per feature, from the node table."""
    found = importances(forest.table(spark), list(FEATURES.values()), forest.weights)
    return found.orderBy(*desc("importance"), *asc("feature"))


def attribution_summary(rows: DataFrame, forest: Forest) -> DataFrame:
    """Mean size and mean of each feature's Shapley value in the score of all rows."""
    named = F.create_map(*[F.lit(x) for pair in FEATURES.items() for x in pair])
    found = mean_attributions(tree_inputs(rows), forest)
    return found.withColumn("feature", named[F.col("feature")]).orderBy(
        *desc("mean_size"), *asc("feature")
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """All four cells with counts and percentages, from one pass."""
    cells = [(float(label), float(guess)) for label in (0, 1) for guess in (0, 1)]
    counts = scored.agg(
        *[
            F.count_if((F.col("label") == label) & (F.col("prediction") == guess)).alias(
                f"c{label:.0f}{guess:.0f}"
            )
            for label, guess in cells
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(int(label)).alias("label"),
                F.lit(int(guess)).alias("prediction"),
                F.col(f"c{label:.0f}{guess:.0f}").alias("count"),
            )
            for label, guess in cells
        ]
    )
    total = F.sum("count").over(over_all())
    return counts.select(F.inline(rows)).withColumn(
        "pct", ratio(F.col("count"), total) * F.lit(100.0)
    )


def curve_counts(scored: DataFrame, *keys: str) -> DataFrame:
    """Per distinct score and group: label counts, and those of all scores not below it."""
    counts = scored.groupBy(*keys, F.col("probability").alias("threshold")).agg(
        F.count_if(F.col("label") == 1).alias("hits"),
        F.count_if(F.col("label") == 0).alias("misses"),
    )
    counts, _ = write_shared(counts, "scores")
    order = [*(F.col(k).asc() for k in keys), F.col("threshold").desc()]
    running = running_sums(counts, order, ["hits", "misses"])
    totals = counts.groupBy(*keys).agg(
        F.sum("hits").alias("all_hits"), F.sum("misses").alias("all_misses")
    )
    if not keys:
        return running.withColumns({"all_hits": totals.select("all_hits").scalar(),
                                    "all_misses": totals.select("all_misses").scalar()})
    groups = Window.partitionBy().orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns(
        {f"{c}_before": F.coalesce(F.sum(f"all_{c}").over(groups), F.lit(0)) for c in ("hits", "misses")}
    )
    totals, _ = write_shared(totals, "totals")
    return running.join(totals, list(keys)).withColumns(
        {f"{c}_so_far": F.col(f"{c}_so_far") - F.col(f"{c}_before") for c in ("hits", "misses")}
    )


def roc_curve(scored: DataFrame, *keys: str) -> DataFrame:
    """ROC points per group of ``keys``, one for each distinct score, from the highest down."""
    return curve_counts(scored, *keys).select(
        *keys,
        "threshold",
        ratio(F.col("misses_so_far"), F.col("all_misses")).alias("false_positive_rate"),
        ratio(F.col("hits_so_far"), F.col("all_hits")).alias("true_positive_rate"),
    )


def area_under(scored: DataFrame, *keys: str) -> DataFrame:
    """Area under the ROC curve: label pairs in the right order, ties for half."""
    doubled = F.col("misses") * (F.lit(2) * F.col("hits_so_far") - F.col("hits"))
    pairs = F.lit(2) * F.max("all_hits") * F.max("all_misses")
    return curve_counts(scored, *keys).groupBy(*keys).agg(
        ratio(F.sum(doubled), pairs).alias("roc_auc")
    )


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support for each class."""
    cells = confusion_matrix(scored)

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("count")).otherwise(0))

    sums = cells.agg(
        *[
            agg
            for k in (0, 1)
            for agg in (
                total((F.col("label") == k) & (F.col("prediction") == k)).alias(f"right{k}"),
                total(F.col("prediction") == k).alias(f"guessed{k}"),
                total(F.col("label") == k).alias(f"support{k}"),
            )
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                ratio(F.col(f"right{k}"), F.col(f"guessed{k}")).alias("precision"),
                ratio(F.col(f"right{k}"), F.col(f"support{k}")).alias("recall"),
                F.col(f"support{k}").alias("support"),
            )
            for k, name in enumerate(["On-time", "Delayed"])
        ]
    )
    both = F.col("precision") + F.col("recall")
    f1 = F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"), both)
    return sums.select(F.inline(rows)).withColumn("f1", f1)


def metrics(scored: DataFrame) -> DataFrame:
    """One row: accuracy; precision, recall and F1 of the delayed class; ROC area."""
    report = class_report(scored)
    delayed = F.col("class") == "Delayed"
    right = F.sum(F.col("recall") * F.col("support"))
    main = report.agg(
        ratio(right, F.sum("support")).alias("accuracy"),
        F.max(F.when(delayed, F.col("precision"))).alias("precision"),
        F.max(F.when(delayed, F.col("recall"))).alias("recall"),
        F.max(F.when(delayed, F.col("f1"))).alias("f1"),
    )
    area = area_under(scored).scalar()
    return main.withColumn("roc_auc", area)


def save_metrics(one_row: DataFrame, path: str) -> None:
    write_table(one_row, path, "csv")


def feature_importance(
    spark: SparkSession, model: RandomForestClassificationModel
) -> DataFrame:
    """Gini importance per feature; sixteen numbers that the model already holds."""
    values = model.featureImportances.toArray().tolist()
    rows = list(zip(FEATURES.values(), values, strict=True))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        *desc("importance"), *asc("feature")
    )


def late_share_scorer(train: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A plain scorer to evaluate beside the forest: the late share by carrier and hour.

    Returns a function that adds ``probability`` and ``prediction`` (above the overall share).
    """
    by = ["carrier_enc", "hour_of_day"]
    rates, _ = write_shared(train.groupBy(*by).agg(F.avg("label").alias("probability")), "rates")
    overall = train.agg(F.avg("label")).scalar()

    def add(rows: DataFrame) -> DataFrame:
        found = rows.join(rates, by, "left").withColumn("overall", overall)
        share = F.coalesce("probability", "overall")
        return found.withColumns(
            {"probability": share, "prediction": (share > F.col("overall")).cast("double")}
        ).drop("overall")

    return add


def forest_scorer(model: RandomForestClassificationModel) -> Callable[[DataFrame], DataFrame]:
    def add(rows: DataFrame) -> DataFrame:
        scored = model.transform(assemble(rows.drop("features")))
        return scored.withColumn("probability", vector_to_array("probability")[1])

    return add


def with_next(rows: DataFrame) -> DataFrame:
    """Add ``next``: the features of the row with the next key, of the first row for the last.

    Rows are dealt by the first three digits of their keys. The first row of each of these at most
    4,096 parts comes after the last row of the part before. Rows with equal keys are equal.
    """
    values = F.struct(*FEATURES)
    dealt = rows.withColumn("prefix", F.substring("key", 1, 3))
    heads = dealt.groupBy("prefix").agg(F.min_by(values, "key").alias("head"))
    ring = Window.partitionBy().orderBy("prefix")
    first = F.first("head").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select("prefix", F.coalesce(F.lead("head").over(ring), first).alias("after"))
    following = F.lead(values).over(Window.partitionBy("prefix").orderBy("key"))
    return (
        dealt.withColumn("next", following)
        .join(F.broadcast(after), "prefix")
        .withColumn("next", F.coalesce("next", "after"))
        .drop("after", "prefix")
    )


def permutation_importance(
    scorer: Callable[[DataFrame], DataFrame], test: DataFrame
) -> DataFrame:
    """Drop in ROC area when one feature is shuffled, for every feature in one job.

    Rows stand in a ring in the order of their keys, which are hashes; the shuffled value of a
    feature is the next row's. Each row is scored once as it is and once per feature with that
    feature replaced.
    """
    kinds = {f: test.schema[f].dataType for f in FEATURES}
    rows = with_next(test.select("label", "key", *[F.col(f).cast("double") for f in FEATURES]))
    rows = rows.select(
        "label", *FEATURES, *[F.col("next")[f].alias(f"next_{f}") for f in FEATURES]
    )

    def variant(replaced: str | None) -> Column:
        inputs = [F.col(f"next_{f}" if f == replaced else f).alias(f) for f in FEATURES]
        return F.struct(F.lit(FEATURES.get(replaced, "")).alias("feature"), *inputs)

    variants = F.array(variant(None), *[variant(f) for f in FEATURES])
    exploded = rows.select("label", F.inline(variants)).withColumns(
        {f: F.col(f).cast(kind) for f, kind in kinds.items()}
    )
    scored = scorer(exploded).select("feature", "label", "probability")
    with small_methods(test.sparkSession):
        areas = area_under(scored, "feature")
    base = F.max(F.when(F.col("feature") == "", F.col("roc_auc"))).over(over_all())
    return (
        areas.withColumn("importance", base - F.col("roc_auc"))
        .filter(F.col("feature") != "")
        .select("feature", "importance")
        .orderBy(*desc("importance"), *asc("feature"))
    )
