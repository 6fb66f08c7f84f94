"""One query per operator, over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retourlens.functions.scalar import days_between, parse_date, truncate
from retourlens.operators import decisions, ensemble, features, folds, metrics, models, search, tables
from retourlens.operators.encoders import RobustScaler
from retourlens.plans import training
from retourlens.plans.feature_table import (
    FEATURES,
    FeatureConfig,
    build_features,
    build_features_stacked,
)
from retourlens.session import scratch_path, settle, settle_all
from retourlens.sources import orders
from retourlens.sources.checked import infer_schema, read_checked
from retourlens.sources.sales import sales
from retourlens.sources.stored import store_by_id

Query = Callable[[SparkSession, str], DataFrame]

ID = "order_item_id"
FOLD_SEED, STRATIFIED_SEED, HOLDOUT_SEED = 7, 1001, 11
# Thresholds at which supported and unsupported keys both occur at sf0.01.
MIXED = features.Support(brand=1600, item=20, user=26, price=387, pair=3)
STAND_INS = ["ce_brand", "ce_user", "ce_price"]
DEAR = 53
FLAGS = ["was_delivered", "is_discounted", *[f"type_{t}" for t in features.ITEM_TYPES]]
# Small settings of the slow learners, so that a check ends in good time.
QUICK = {"trees": 5, "depth": 4, "epochs": 2}


def _rows(spark, sf_dir, *columns) -> DataFrame:
    return sales(spark, sf_dir, ID, "is_unknown", *columns)


def _priced(spark, sf_dir, *columns) -> DataFrame:
    return features.rounded_price(_rows(spark, sf_dir, "item_price", *columns))


def stack_splits(spark, sf_dir):
    known, unknown = tables.split(_rows(spark, sf_dir, "item_id", "returned"))
    stacked = tables.stack_splits(known, unknown)
    return stacked.select(ID, "item_id", "returned", "is_unknown")


def _order_files(spark, sf_dir):
    """Both splits written as order files and read again, the second without labels."""
    known, unknown = tables.split(sales(spark, sf_dir))
    empty = {"user_title": F.lit(None).cast("string"), "user_state": F.lit(None).cast("string")}
    read = []
    for rows, schema in ((known, orders.ORDER_SCHEMA), (unknown, orders.UNLABELLED_SCHEMA)):
        path = scratch_path(spark, "orders")
        rows.withColumns(empty).select(*schema.names).write.option("header", True).option("compression", "gzip").csv(path)
        read.append(orders.read_orders(spark, path, schema))
    return read


def csv_roundtrip(spark, sf_dir):
    """Orders of both files, features and predictions through files and back."""
    known, unknown = _order_files(spark, sf_dir)
    paths = [scratch_path(spark, name) for name in ("features", "predictions")]
    raw = known.unionByName(unknown, allowMissingColumns=True)
    orders.write_features(features.was_delivered(features.rounded_price(raw)), paths[0])
    table = orders.read_features(spark, paths[0])
    scored = decisions.with_tau(table).withColumnRenamed("tau", "score")
    orders.write_predictions(scored, paths[1])
    back = orders.read_predictions(spark, paths[1]).withColumnRenamed("score", "stored_score")
    kept = table.select(
        ID, "order_date", "delivery_date", "item_id", "item_size", "item_color", "brand_id",
        "item_price", "user_id", "user_dob", "user_reg_date", "returned", "was_delivered",
    )
    return kept.join(back, ID)


def orders_quarantine(spark, sf_dir):
    """Labelled orders in a file with prices, dates and brands made bad on purpose: what is accepted, and why others are not."""
    known, _ = tables.split(sales(spark, sf_dir))
    spoiled = {
        "item_price": F.when(F.col(ID) % 97 == 0, "n/a").otherwise(F.col("item_price").cast("string")),
        "order_date": F.when(F.col(ID) % 89 == 0, "1996-02-30").otherwise(F.col("order_date").cast("string")),
        "brand_id": F.when(F.col(ID) % 83 != 0, F.col("brand_id")),
        "user_title": F.lit(None).cast("string"), "user_state": F.lit(None).cast("string"),
    }
    path = scratch_path(spark, "spoiled-orders")
    known.withColumns(spoiled).select(*orders.ORDER_SCHEMA.names).write.option("header", True).option("compression", "gzip").csv(path)
    found = read_checked(spark, path, orders.ORDER_SCHEMA)
    accepted = found.rows.select(F.lit("accepted").alias("reason"), ID)
    number = F.get_json_object("line", f"$.{ID}").cast("long").alias(ID)
    rejected = found.rejected.select(F.explode("reasons").alias("reason"), number)
    every = found.rejected.select(F.lit("rejected").alias("reason"), number)
    return accepted.union(rejected).union(every).groupBy("reason").agg(F.count("*").alias("n_rows"), F.sum(ID).alias("sum_ids"))


def inferred_types(spark, sf_dir):
    """Types found in the files of both splits, and how they differ from the declared ones."""
    known, unknown = tables.split(sales(spark, sf_dir))
    rows = []
    for split, table in (("known", known), ("unknown", unknown.drop("returned"))):
        path = scratch_path(spark, "orders-to-infer")
        table.drop("is_unknown").write.option("header", True).option("compression", "gzip").csv(path)
        seen = infer_schema(spark, path)
        rows += [(split, f.name, f.dataType.simpleString(), f.nullable) for f in seen]
    return spark.createDataFrame(rows, "split string, name string, type string, has_gaps boolean")


def rekey_unknown(spark, sf_dir):
    rows = _rows(spark, sf_dir, "item_id", "brand_id")
    return tables.rekey(rows.where("is_unknown")).select(ID, "item_id", "brand_id")


def _encoder(make, columns, support, prepare=None):
    def query(spark, sf_dir):
        rows = _rows(spark, sf_dir, "returned", *columns)
        encoder = make(support)
        encoded = encoder.fit_transform(prepare(rows) if prepare else rows)
        return encoded.select(ID, encoder.output)

    return query


def _feature(step, columns, *outputs, prepare=None):
    def query(spark, sf_dir):
        rows = _rows(spark, sf_dir, *columns)
        return step(prepare(rows) if prepare else rows).select(ID, *outputs)

    return query


def _sized(rows):
    return features.normalised_size_text(rows)


def _numbered(rows):
    return features.numeric_size(_sized(rows))


def price_scaled(spark, sf_dir):
    """Prices of a brand in units of their spread; brands have many prices, so medians are selected."""
    rows = _rows(spark, sf_dir, "brand_id", "item_price")
    scaler = RobustScaler(["brand_id"], "item_price", "scaled_price", digits=6, select_over=500)
    return scaler.transform(rows).select(ID, "scaled_price")


def _features_ready(spark, sf_dir, config=FeatureConfig()):
    return build_features_stacked(sales(spark, sf_dir), config)


def feature_table(spark, sf_dir):
    return _features_ready(spark, sf_dir)


def feature_table_hot_groups(spark, sf_dir):
    """Both forms of every group value: busy users and items are joined."""
    config = FeatureConfig(support=MIXED, max_group_rows=30, max_item_bytes=0)
    return _features_ready(spark, sf_dir, config)


def feature_table_large_catalogue(spark, sf_dir):
    """Rows are shuffled to their items, as for a catalogue too big to broadcast."""
    return _features_ready(spark, sf_dir, FeatureConfig(support=MIXED, max_item_bytes=0))


def feature_table_two_files(spark, sf_dir):
    known, unknown = _order_files(spark, sf_dir)
    return build_features(known, unknown, FeatureConfig(support=MIXED))


def feature_table_gaps(spark, sf_dir):
    """Group values of rows that lack an item, a user, a price, a size or a colour."""
    rows = sales(spark, sf_dir)
    gaps = {"item_id": 11, "user_id": 13, "item_price": 5, "item_size": 7, "item_color": 17}
    lacking = rows.withColumns({c: F.when(F.col(ID) % n != 0, F.col(c)) for c, n in gaps.items()})
    table = build_features_stacked(lacking, FeatureConfig(support=MIXED))
    return table.select(
        ID, "is_discounted", "ce_item", "ce_user", "size_item_ce", "colour_item_ce", "count_user", "customer_value",
        *[f"type_{t}" for t in features.ITEM_TYPES],
    )


def date_parts(spark, sf_dir):
    rows = _rows(spark, sf_dir, "order_date", "user_reg_date")
    texts = rows.select(ID, *[F.col(c).cast("string").alias(c) for c in ("order_date", "user_reg_date")])
    parsed = texts.select(
        ID, parse_date("order_date").alias("order_date"),
        parse_date("user_reg_date", strict=False).alias("user_reg_date"),
    )
    return parsed.withColumn("days", days_between("user_reg_date", "order_date"))


def kfold_assign(spark, sf_dir):
    known, _ = tables.split(_rows(spark, sf_dir))
    return folds.kfold(known, 10, FOLD_SEED).select(ID, "fold")


def stratified_folds(spark, sf_dir):
    known, _ = tables.split(_rows(spark, sf_dir, "returned"), label=None)
    return folds.stratified_folds(known, "returned", 5, STRATIFIED_SEED).select(ID, "fold")


def holdout(spark, sf_dir):
    known, _ = tables.split(_rows(spark, sf_dir))
    return folds.holdout(known, 0.2, HOLDOUT_SEED).select(ID, "is_test")


def _user_scored(spark, sf_dir, *columns) -> DataFrame:
    """Rounded price and the user's return rate as score, both splits."""
    rows = _priced(spark, sf_dir, "user_id", "returned", *columns)
    return features.user_encoder().fit_transform(rows).withColumnRenamed("ce_user", "score")


def _decided(spark, sf_dir) -> DataFrame:
    scored = _user_scored(spark, sf_dir)
    return decisions.warn(scored.where("not is_unknown"))


def _stand_in_scores(spark, sf_dir) -> DataFrame:
    """Brand, user and price rates of all rows, as three columns."""
    rows = _priced(spark, sf_dir, "brand_id", "user_id", "returned")
    encoders = [features.brand_encoder(), features.user_encoder(), features.price_encoder()]
    fitted = settle_all({e.output: _fit_on_known(spark, sf_dir, e) for e in encoders})
    for encoder in encoders:
        rows = encoder.transform(rows, fitted[encoder.output])
    return rows


def _fit_on_known(spark, sf_dir, encoder) -> DataFrame:
    columns = [*encoder.keys, "is_unknown", "returned"]
    rows = sales(spark, sf_dir, *columns)
    if "item_price" in columns:
        rows = features.rounded_price(rows)
    return encoder.fit(rows.where("not is_unknown"))


def _long(rows: DataFrame, *keep: str) -> DataFrame:
    """Three stand-in score columns as ``model, score`` rows."""
    return rows.unpivot([ID, *keep], STAND_INS, "model", "score")


def _known_long(spark, sf_dir) -> DataFrame:
    known = _stand_in_scores(spark, sf_dir).where("not is_unknown")
    return _long(folds.kfold(known, 10, FOLD_SEED), "fold", "returned")


def roc_curve(spark, sf_dir):
    return metrics.roc_curve(_user_scored(spark, sf_dir).where("not is_unknown"))


def auc(spark, sf_dir):
    return metrics.auc(_user_scored(spark, sf_dir).where("not is_unknown"))


def auc_gaps(spark, sf_dir):
    """Rows without a score, or with one that is no number, are left out."""
    known = _user_scored(spark, sf_dir).where("not is_unknown")
    gaps = F.when(F.col(ID) % 10 == 0, None).when(F.col(ID) % 10 == 1, F.lit(float("nan"))).otherwise(F.col("score"))
    return metrics.auc(known.withColumn("score", gaps))


def auc_by_model(spark, sf_dir):
    return metrics.auc(_known_long(spark, sf_dir), by=["fold", "model"])


def best_model(spark, sf_dir):
    """Per fold the stand-in with the largest AUC; names settle ties."""
    rated = auc_by_model(spark, sf_dir)
    place = F.array_position(F.array(*[F.lit(m) for m in STAND_INS]), F.col("model"))
    return metrics.best_by_metric(rated.withColumn("place", place), "model", "auc", "place", ["fold"])


def best_fold(spark, sf_dir):
    scored = folds.kfold(_user_scored(spark, sf_dir).where("not is_unknown"), 10, FOLD_SEED)
    return ensemble.best_fold(metrics.auc(scored, by=["fold"]))


def mean_ensemble(spark, sf_dir):
    mean = ensemble.mean_ensemble(_long(_stand_in_scores(spark, sf_dir)))
    return mean.select(ID, F.round("score", 10).alias("score"))


def merged_scores(spark, sf_dir):
    rows = _stand_in_scores(spark, sf_dir)
    parts = [rows.select(ID, F.col(c).alias("score")) for c in STAND_INS]
    return ensemble.merge_scores(parts, STAND_INS)


def mean_ensemble_auc(spark, sf_dir):
    known = _stand_in_scores(spark, sf_dir).where("not is_unknown")
    mean = F.round((F.col("ce_brand") + F.col("ce_user") + F.col("ce_price")) / 3, 10)
    return metrics.auc(known.select("returned", mean.alias("score")))


def greedy_ensemble(spark, sf_dir):
    known = settle(_known_long(spark, sf_dir), "stand-ins")
    labels = known.select(ID, "returned").distinct()
    scores = known.select("fold", "model", ID, "score")
    return ensemble.greedy_ensemble(scores, labels, STAND_INS).table(spark)


def fold_average(spark, sf_dir):
    """Unknown rows as scored by the models of ten folds, each a little apart."""
    unknown = _stand_in_scores(spark, sf_dir).where("is_unknown").select(ID, F.col("ce_user").alias("score"))
    by_fold = unknown.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(9))))
    mean = ensemble.average_folds(by_fold.withColumn("score", F.col("score") + (F.col("fold") - 4) / 100))
    return mean.select(ID, F.round("score", 10).alias("score"))


def out_of_fold(spark, sf_dir):
    known = _stand_in_scores(spark, sf_dir).where("not is_unknown")
    scores = _long(folds.kfold(known, 10, FOLD_SEED), "fold")
    base = _priced(spark, sf_dir, "returned").where("not is_unknown")
    joined = ensemble.out_of_fold(scores, base)
    return joined.withColumn("score", F.round("score", 10))


def tau(spark, sf_dir):
    return decisions.with_tau(_priced(spark, sf_dir)).select(ID, "tau")


def warn(spark, sf_dir):
    return _decided(spark, sf_dir).select(ID, "warn")


def warn_negative_prices(spark, sf_dir):
    """Prices lowered by 40; at -10 there is no break-even point and no warning."""
    lowered = _user_scored(spark, sf_dir).withColumn("item_price", F.col("item_price") - 40)
    return decisions.warn(lowered).select(ID, "warn")


def count_warned(spark, sf_dir):
    return tables.count_flagged(_decided(spark, sf_dir), "warn", "n_warned")


def revenue(spark, sf_dir):
    return decisions.revenue(_decided(spark, sf_dir)).select(ID, "revenue")


def error_cost(spark, sf_dir):
    return decisions.error_cost(_decided(spark, sf_dir)).select(ID, "error_cost")


def head_rows(spark, sf_dir):
    """The first ten decided rows, the label last."""
    decided = tables.drop(_decided(spark, sf_dir), ["user_id", "is_unknown"])
    named = tables.rename(decided, {"score": "prediction"})
    return tables.head(tables.reorder(named, last="returned"), 10, [ID])


def revenue_sweep(spark, sf_dir):
    return decisions.revenue_sweep(_user_scored(spark, sf_dir).where("not is_unknown"))


def cost_sweep(spark, sf_dir):
    return decisions.cost_sweep(_user_scored(spark, sf_dir).where("not is_unknown"))


def best_multiplier(spark, sf_dir):
    return tables.best_rows(revenue_sweep(spark, sf_dir), "revenue")


def best_cost_multiplier(spark, sf_dir):
    return tables.best_rows(cost_sweep(spark, sf_dir), "error_cost")


def calibration(spark, sf_dir):
    table = metrics.calibration(_user_scored(spark, sf_dir).where("not is_unknown"))
    return table.withColumns({c: F.round(c, 10) for c in ("mean_score", "observed_rate")})


def decide_unknown(spark, sf_dir):
    scored = _user_scored(spark, sf_dir).where("is_unknown").select(ID, "score")
    return decisions.decide(_priced(spark, sf_dir), scored)


def decide_stored(spark, sf_dir):
    """Decisions from prices and scores that are both stored by id."""
    scored = _user_scored(spark, sf_dir).where("is_unknown").select(ID, "score")
    prices = store_by_id(_priced(spark, sf_dir).select(ID, "item_price"), "prices", 16)
    return decisions.decide(prices, store_by_id(scored, "user_scores", 16))


def cost_summary(spark, sf_dir):
    return decisions.cost_summary(_decided(spark, sf_dir))


def confusion(spark, sf_dir):
    return decisions.confusion(_decided(spark, sf_dir))


def _training(spark, sf_dir, k=3):
    return training.training_tables(_features_ready(spark, sf_dir), k)


def _model_scores(cfg):
    """Scores of the first fold's rows and of all unknown rows."""

    def query(spark, sf_dir):
        train, unknown = _training(spark, sf_dir)
        scorer = models.fit_scorer(cfg, train.where("fold != 0"))
        test = models.score(scorer, train.where("fold = 0"), ID)
        return test.unionByName(models.score(scorer, unknown, ID))

    return query


def _binary_features(spark, sf_dir, label="returned"):
    """Flags of every row, assembled into a vector; ``dear`` is a second label,
    whose sides differ by majority (the forest merges leaves that agree)."""
    rows = sales(spark, sf_dir, ID, "is_unknown", "returned", "item_id", "item_price", "item_size", "delivery_date")
    flagged = features.is_discounted(features.was_delivered(features.rounded_price(rows)))
    typed = features.type_dummies(features.classify_items(_sized(flagged)))
    dear = F.when(F.col("item_price") >= DEAR, 1).otherwise(0)
    return models.assemble(typed.withColumn("dear", dear), FLAGS, label)


def assembled_vectors(spark, sf_dir):
    """The vector of each row, taken apart again."""
    values = vector_to_array("features")
    table = _binary_features(spark, sf_dir).where("not is_unknown")
    return table.select(ID, "label", *[values[i].alias(c) for i, c in enumerate(FLAGS)])


def _stump(spark, sf_dir, est, label):
    table = settle(_binary_features(spark, sf_dir, label), "flags")
    return est.fit(table.where("not is_unknown")), table


def forest_stump(spark, sf_dir):
    """One tree of one split, on all rows: the best split by impurity, scored by its leaves."""
    est = models.forest(models.ForestConfig(trees=1, depth=1, columns="all")).setBootstrap(False)
    model, table = _stump(spark, sf_dir, est, "dear")
    return models.score(lambda df: models.class_one(model, df), table, ID).withColumn("score", F.round("score", 10))


def boosted_stump(spark, sf_dir):
    """One boosting step of one split: leaves hold means of -1 and 1, scores follow by the logistic link."""
    cfg = models.GbtConfig(trees=1, depth=1, row_sample=1.0, column_sample=1.0)
    model, table = _stump(spark, sf_dir, models.gbt(cfg), "returned")
    return models.score(lambda df: models.class_one(model, df), table, ID).withColumn("score", F.round("score", 10))


def stump_importance(spark, sf_dir):
    est = models.forest(models.ForestConfig(trees=1, depth=1, columns="all")).setBootstrap(False)
    return models.importance(_stump(spark, sf_dir, est, "dear")[0], FLAGS, 1)


def importance_order(spark, sf_dir):
    """The five features of the most importance, in order; names settle ties."""
    est = models.forest(models.ForestConfig(trees=1, depth=1, columns="all")).setBootstrap(False)
    return models.importance(_stump(spark, sf_dir, est, "dear")[0], FLAGS, 5)


def truncated(spark, sf_dir):
    """Ten times the price without its fraction."""
    return _rows(spark, sf_dir, "item_price").select(ID, truncate(F.col("item_price") * 10).alias("tenths"))


def random_search(spark, sf_dir):
    """Both tree families over five stratified folds; few draws of small trees."""
    train, _ = _training(spark, sf_dir)
    train = settle(folds.stratified_folds(train.drop("fold"), k=5, seed=STRATIFIED_SEED), "stratified")
    space = {"maxDepth": [2, 4], "minInstancesPerNode": [2, 4]}
    families = {
        "forest": models.forest(models.ForestConfig(trees=QUICK["trees"])),
        "boosted": models.gbt(models.GbtConfig(trees=QUICK["trees"])),
    }
    found = [
        search.random_search(est, space, train, n_iter=2, folds=5)[2].withColumn("family", F.lit(name))
        for name, est in families.items()
    ]
    return found[0].unionByName(found[1])


def feature_importance(spark, sf_dir):
    """Importances of the whole forest, all its trees at their full depth."""
    train, _ = _training(spark, sf_dir)
    return models.forest_importance(models.ForestConfig(), train, FEATURES)


def _zoo(spark, sf_dir):
    """All twenty models at their own settings on all folds."""
    train, unknown = _training(spark, sf_dir, training.CV_FOLDS)
    return training.model_zoo(train, unknown, models.zoo_configs(), range(training.CV_FOLDS), parallelism=4)


def _covered_zoo(spark, sf_dir):
    """The five models and two folds that the SQL twin of ``zoo_coverage`` lists."""
    train, unknown = _training(spark, sf_dir, 2)
    picked = {n: models.lighter(c, **QUICK) for n, c in models.zoo_configs().items()}
    few = {n: picked[n] for n in ("nn_01", "xgb_00", "xgb_08", "rf_00", "rf_04")}
    return training.model_zoo(train, unknown, few, range(2), parallelism=4)


def model_zoo(spark, sf_dir):
    return training.zoo_aucs(_zoo(spark, sf_dir))


def zoo_coverage(spark, sf_dir):
    """What each model of each fold scored: rows, rows of another fold, and scores that are no probability."""
    zoo = _covered_zoo(spark, sf_dir)
    known = zoo.long_test().select("fold", "model", ID, "score").withColumn("split", F.lit("known"))
    scored = known.unionByName(zoo.long_unknown().withColumn("split", F.lit("unknown")))
    fold = folds.kfold(_rows(spark, sf_dir), 2, 1001).select(ID, F.col("fold").alias("own"))
    other = (F.col("split") == "known") & (F.col("fold") != F.col("own"))
    return scored.join(fold, ID).groupBy("split", "fold", "model").agg(
        F.count("*").alias("n_rows"), F.count_if(other).alias("n_other_fold"),
        F.count_if(F.col("score").isNull() | ~F.col("score").between(0, 1)).alias("n_no_probability"),
        F.sum(ID).alias("sum_ids"),
    )


def zoo_submission(spark, sf_dir):
    """Features to warnings for unknown rows through zoo and ensembles; no row moves after it is scored."""
    result = training.ensemble_folds(_zoo(spark, sf_dir))
    return decisions.warn(result.unknown).select(ID, "warn")


def _encoder_queries() -> dict[str, Query]:
    made = {}
    for suffix, support in (("", features.Support()), ("_mixed", MIXED)):
        made[f"ce_brand{suffix}"] = _encoder(features.brand_encoder, ["brand_id"], support)
        made[f"ce_item{suffix}"] = _encoder(features.item_encoder, ["item_id"], support)
        made[f"ce_user{suffix}"] = _encoder(features.user_encoder, ["user_id"], support)
        made[f"ce_price{suffix}"] = _encoder(
            features.price_encoder, ["item_price"], support, features.rounded_price
        )
        made[f"colour_item_ce{suffix}"] = _encoder(
            features.colour_encoder, ["item_id", "item_color"], support, features.corrected_colour
        )
        made[f"size_item_ce{suffix}"] = _encoder(
            features.size_encoder, ["item_id", "item_size"], support, _sized
        )
    return made


def _feature_queries() -> dict[str, Query]:
    f = features
    size, user_item = ["item_id", "item_size"], ["user_id", "item_id"]
    return {
        "is_discounted": _feature(
            f.is_discounted, ["item_id", "item_price"], "is_discounted", prepare=f.rounded_price
        ),
        "orders_per_day": _feature(f.orders_per_day, ["user_id", "order_date"], "orders_per_day"),
        "multi_colour_per_day": _feature(
            f.multi_colour_per_day, [*user_item, "item_color"], "multi_colour_per_day"
        ),
        "colour_fix": _feature(f.corrected_colour, ["item_color"], "item_color"),
        "count_item_user": _feature(f.count_item_user, user_item, "count_item_user"),
        "customer_value": _feature(
            f.customer_value, ["user_id", "item_price"], "customer_value", prepare=f.rounded_price
        ),
        "count_user_new_user": _feature(
            lambda rows: f.new_user(f.count_user(rows)), ["user_id"], "count_user", "new_user"
        ),
        "size_text": _feature(_sized, ["item_size"], "item_size"),
        "item_type": _feature(f.classify_items, size, "type", prepare=_sized),
        "type_dummies": _feature(
            lambda rows: f.type_dummies(f.classify_items(rows)),
            size,
            *[f"type_{t}" for t in f.ITEM_TYPES],
            prepare=_sized,
        ),
        "size_numeric": _feature(_numbered, ["item_size"], "item_size"),
        "size_normalised": _feature(f.normalised_size, size, "item_size", prepare=_numbered),
        "was_delivered": _feature(f.was_delivered, ["delivery_date"], "was_delivered"),
        "latest_order": _feature(f.latest_order, ["user_id", "order_date"], "latest_order"),
        "ordered_item_recently": _feature(
            f.ordered_item_recently, [*user_item, "order_date"], "ordered_item_recently"
        ),
        "membership_age": _feature(
            f.membership_age, ["order_date", "user_reg_date"], "membership_age_days"
        ),
        "time_to_delivery": _feature(
            f.time_to_delivery, ["order_date", "delivery_date"], "time_to_delivery_days"
        ),
        "assumed_age": _feature(f.assumed_age, ["order_date", "user_dob"], "assumed_age"),
    }


def all_queries() -> dict[str, Query]:
    direct = [
        stack_splits, csv_roundtrip, orders_quarantine, inferred_types, rekey_unknown, feature_table, feature_table_hot_groups,
        feature_table_large_catalogue, feature_table_two_files, feature_table_gaps, date_parts, kfold_assign, stratified_folds, holdout, roc_curve,
        auc, auc_gaps, auc_by_model, best_model, best_fold, mean_ensemble, merged_scores, mean_ensemble_auc,
        greedy_ensemble, fold_average, out_of_fold, tau, warn, warn_negative_prices, count_warned, revenue, error_cost,
        head_rows, revenue_sweep, cost_sweep, best_multiplier, best_cost_multiplier, calibration,
        decide_unknown, decide_stored, cost_summary, confusion, assembled_vectors, forest_stump, boosted_stump, stump_importance,
        importance_order, truncated, price_scaled,
        random_search, feature_importance, model_zoo, zoo_coverage,
        zoo_submission,
    ]
    learners = {
        "gbt_scores": models.GbtConfig(),
        "forest_scores": models.ForestConfig(),
        "mlp_scores": models.MlpConfig(scale=True),
    }
    scored = {n: _model_scores(models.lighter(c, **QUICK)) for n, c in learners.items()}
    return {**_encoder_queries(), **_feature_queries(), **{q.__name__: q for q in direct}, **scored}
