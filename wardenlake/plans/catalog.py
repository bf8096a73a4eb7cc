"""Every operator as a query on the test tables. Each takes (spark, sf_dir)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardenlake.config import DEFAULTS, SearchSpace
from wardenlake.functions.hashing import hash_key, unit_interval
from wardenlake.functions.storage import materialize, new_folder, spread
from wardenlake.models import training
from wardenlake.models.stages import soft_vote
from wardenlake.operators import cost, drift, explain, features, metrics, profile, projections, reference_profile, sampling, scoring
from wardenlake.operators import smote, thresholds
from wardenlake.operators.kernel_shapley import kernel_shapley_values
from wardenlake.plans import runs
from wardenlake.schema import COMPONENTS, KEY
from wardenlake.sources import bindings, registry, reports
from wardenlake.sources.quarantine import load_with_quarantine
from wardenlake.sources.transactions import load_transactions, read_partition, write_partitions
from wardenlake.streaming import scoring as streams

QUERIES = {}
NUMERIC = ["Time", "Amount", "V1", "V2"]
# Published coefficients, so that scoring can be checked without a fitted model.
INTERCEPT = -4.0
COEFFICIENTS = {"Time": 1e-7, "Amount": 0.02, "V1": 0.003, "V2": -0.01, "V3": 0.5}
LINEAR = {"Time": 1e-7, "Amount": 0.02, "V1": 0.003, "V2": -0.01}


def query(function):
    QUERIES[function.__name__] = function
    return function


def r6(*columns: str):
    return [F.round(c, 6).alias(c) for c in columns]


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    """Round every DOUBLE column but the kept ones."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


def by_day(tx: DataFrame) -> DataFrame:
    """Means of the numeric columns of every day that has transactions."""
    return tx.groupBy(F.floor(F.col("Time") / 86_400).alias(KEY)).agg(*[F.avg(c).alias(c) for c in NUMERIC])


def decided(spark: SparkSession, sf_dir: str, threshold: float | None = None) -> DataFrame:
    scored = bindings.scored_transactions(spark, sf_dir)
    rule = projections.argmax_prediction("score") if threshold is None else projections.apply_threshold("score", threshold)
    return scored.withColumn("prediction", rule)


# ---- scans, projections, filters -------------------------------------------------------------


@query
def scan_transactions(spark, sf_dir):
    return rounded(bindings.transactions(spark, sf_dir))


@query
def project_features(spark, sf_dir):
    return rounded(projections.project_features(bindings.transactions(spark, sf_dir)))


@query
def align_schema(spark, sf_dir):
    return rounded(projections.align_schema(bindings.transactions(spark, sf_dir)))


def _gappy_records(spark, sf_dir):
    gap = F.when(F.col("tx_id") % 5 != 0, F.col("V1"))
    return bindings.with_missing_amounts(spark, sf_dir).withColumn("V1", gap)


@query
def record_defaults(spark, sf_dir):
    accepted, _ = projections.record_defaults(_gappy_records(spark, sf_dir))
    return accepted.select("tx_id", *r6("Time", "Amount", "V1", "V2", "V28"))


@query
def record_rejects(spark, sf_dir):
    _, rejected = projections.record_defaults(_gappy_records(spark, sf_dir))
    return rejected.select("tx_id", *r6("Time", "Amount"))


@query
def filter_class(spark, sf_dir):
    return rounded(projections.filter_class(bindings.transactions(spark, sf_dir), 1))


@query
def apply_threshold(spark, sf_dir):
    scored = bindings.scored_transactions(spark, sf_dir)
    return scored.select("tx_id", "score", projections.apply_threshold("score", 0.3).alias("prediction"))


@query
def label_text(spark, sf_dir):
    return decided(spark, sf_dir).select(
        "tx_id",
        projections.label_text("prediction").alias("prediction_label"),
        projections.label_text("prediction", "Fraud", "Legit").alias("short_label"),
        F.round(projections.complement("score"), 6).alias("legitimate_probability"),
    )


@query
def preview_head(spark, sf_dir):
    return rounded(projections.preview(bindings.transactions(spark, sf_dir), 5))


@query
def preview_tail(spark, sf_dir):
    return rounded(projections.preview(bindings.transactions(spark, sf_dir), 5, last=True))


# ---- profiles --------------------------------------------------------------------------------


@query
def class_balance(spark, sf_dir):
    return rounded(profile.class_balance(bindings.transactions(spark, sf_dir)))


@query
def fraud_share(spark, sf_dir):
    return rounded(profile.fraud_share(bindings.transactions(spark, sf_dir)))


@query
def null_total(spark, sf_dir):
    return profile.null_total(bindings.with_missing_amounts(spark, sf_dir))


@query
def null_counts(spark, sf_dir):
    return profile.null_counts(bindings.with_missing_amounts(spark, sf_dir))


@query
def table_shape(spark, sf_dir):
    split = sampling.stratified_split(bindings.transactions(spark, sf_dir))
    return profile.table_shape(split, by="split")


@query
def describe_by_class(spark, sf_dir):
    return rounded(profile.describe_by_class(bindings.transactions(spark, sf_dir)))


@query
def mean_by_class(spark, sf_dir):
    return rounded(profile.mean_by_class(bindings.transactions(spark, sf_dir)))


@query
def correlation_matrix(spark, sf_dir):
    wide = bindings.wide_transactions(spark, sf_dir).drop("tx_id")
    return rounded(profile.correlation_matrix(wide))


@query
def correlation_with_gaps(spark, sf_dir):
    tx = bindings.with_missing_amounts(spark, sf_dir)
    return rounded(profile.correlation_matrix(tx, [*NUMERIC, "Class"]))


@query
def amount_density(spark, sf_dir):
    density = profile.amount_density(bindings.transactions(spark, sf_dir))
    return density.select("Class", *r6("x"), F.round("density", 9).alias("density"))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(decided(spark, sf_dir))


@query
def flag_summary(spark, sf_dir):
    return scoring.flag_summary(decided(spark, sf_dir))


# ---- splits, samples, oversampling -----------------------------------------------------------


@query
def stratified_split(spark, sf_dir):
    return sampling.stratified_split(bindings.transactions(spark, sf_dir)).select("tx_id", "Class", "split")


@query
def plain_split(spark, sf_dir):
    tx = bindings.transactions(spark, sf_dir)
    return sampling.stratified_split(tx, stratify=False).select("tx_id", "Class", "split")


@query
def stratified_folds(spark, sf_dir):
    return sampling.stratified_folds(bindings.transactions(spark, sf_dir)).select("tx_id", "Class", "fold")


@query
def seeded_sample(spark, sf_dir):
    return rounded(sampling.seeded_sample(bindings.transactions(spark, sf_dir), 500))


@query
def class_weights(spark, sf_dir):
    return rounded(sampling.class_weights(bindings.transactions(spark, sf_dir)))


@query
def row_weights(spark, sf_dir):
    weighted = sampling.with_class_weights(bindings.transactions(spark, sf_dir))
    return weighted.select("tx_id", "Class", *r6("weight"))


def _scaled_vectors(spark, sf_dir):
    scaled = features.standard_scale(bindings.transactions(spark, sf_dir))
    return scaled.select("tx_id", "Class", F.array(F.round("Time", 6), F.round("Amount", 6), "V1", "V2").alias("x"))


@query
def smote_neighbors(spark, sf_dir):
    minority = _scaled_vectors(spark, sf_dir).where("Class = 1")
    return smote.nearest_neighbors(minority).select("id", "neighbor", *r6("distance"), "rank")


@query
def smote_neighbors_approximate(spark, sf_dir):
    """Of all rows with 28 components, where the exact search would compare nearly all pairs."""
    wide = bindings.wide_transactions(spark, sf_dir).select("tx_id", F.array(*COMPONENTS).alias("x"))
    usable = wide.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c)))
    return smote.nearest_neighbors(usable, method="approximate").select("id", "neighbor", *r6("distance"), "rank")


@query
def smote_oversample(spark, sf_dir):
    made = smote.smote(_scaled_vectors(spark, sf_dir))
    cells = [F.round(F.col("x")[i], 6).alias(f"f{i}") for i in range(4)]
    return made.select("source_id", "copy_no", "neighbor_id", "Class", *cells)


# ---- preparation -----------------------------------------------------------------------------


@query
def impute_median(spark, sf_dir):
    return features.impute_median(bindings.with_missing_amounts(spark, sf_dir)).select("tx_id", *r6("Amount", "V1"))


@query
def winsorize(spark, sf_dir):
    return features.winsorize(bindings.transactions(spark, sf_dir)).select("tx_id", *r6("Amount"))


@query
def outlier_counts(spark, sf_dir):
    tx = bindings.transactions(spark, sf_dir)
    return features.outlier_counts(tx, features.upper_caps(tx))


@query
def standard_scale(spark, sf_dir):
    return features.standard_scale(bindings.transactions(spark, sf_dir)).select("tx_id", *r6(*NUMERIC))


@query
def feature_matrix(spark, sf_dir):
    """Fitted on the training part, applied to all rows: no test row shapes the statistics."""
    split = sampling.stratified_split(bindings.with_missing_amounts(spark, sf_dir))
    assembler = training.get_preprocessor(split)
    made = assembler.fit(split.where("split = 'train'")).transform(split)
    cells = vector_to_array("features")
    return made.select("tx_id", "split", *[F.round(cells[i], 6).alias(f"f{i}") for i in range(4)])


# ---- evaluation ------------------------------------------------------------------------------


@query
def binary_metrics(spark, sf_dir):
    return rounded(metrics.binary_metrics(decided(spark, sf_dir)))


@query
def cv_fold_metrics(spark, sf_dir):
    folds = sampling.stratified_folds(decided(spark, sf_dir))
    return rounded(metrics.binary_metrics(folds, by="fold"))


@query
def cv_summary(spark, sf_dir):
    folds = sampling.stratified_folds(decided(spark, sf_dir))
    return rounded(training.cross_val_summary(training.fold_scores(folds)))


@query
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(bindings.scored_transactions(spark, sf_dir)))


@query
def pr_auc(spark, sf_dir):
    return rounded(metrics.pr_auc(bindings.scored_transactions(spark, sf_dir)))


@query
def roc_curve(spark, sf_dir):
    return rounded(metrics.roc_curve(bindings.scored_transactions(spark, sf_dir)), "threshold")


@query
def pr_curve(spark, sf_dir):
    return rounded(metrics.pr_curve(bindings.scored_transactions(spark, sf_dir)), "threshold")


@query
def calculate_metrics(spark, sf_dir):
    return rounded(metrics.calculate_metrics(decided(spark, sf_dir)))


@query
def classification_report(spark, sf_dir):
    return rounded(metrics.classification_report(decided(spark, sf_dir)))


@query
def compare_models(spark, sf_dir):
    strict = metrics.binary_metrics(decided(spark, sf_dir, 0.6)).withColumn("model", F.lit("strict"))
    lenient = metrics.binary_metrics(decided(spark, sf_dir, 0.4)).withColumn("model", F.lit("lenient"))
    return rounded(metrics.compare_models(strict.unionByName(lenient), ["strict", "lenient"]))


@query
def optimal_threshold_f1(spark, sf_dir):
    return rounded(thresholds.find_optimal_threshold(bindings.scored_transactions(spark, sf_dir), metric="f1"))


@query
def optimal_threshold_mcc(spark, sf_dir):
    return rounded(thresholds.find_optimal_threshold(bindings.scored_transactions(spark, sf_dir), metric="mcc"))


@query
def threshold_curve(spark, sf_dir):
    return rounded(thresholds.threshold_curve(bindings.scored_transactions(spark, sf_dir)))


@query
def financial_cost(spark, sf_dir):
    return rounded(cost.compute_financial_cost(bindings.scored_transactions(spark, sf_dir)))


@query
def cost_curve(spark, sf_dir):
    return rounded(cost.cost_curve(bindings.scored_transactions(spark, sf_dir)))


@query
def best_cost_threshold(spark, sf_dir):
    return rounded(cost.best_cost_threshold(bindings.scored_transactions(spark, sf_dir)))


# ---- drift -----------------------------------------------------------------------------------


@query
def psi(spark, sf_dir):
    found = drift.compute_psi(*bindings.early_and_late(spark, sf_dir), NUMERIC)
    return rounded(found.withColumn("psi_band", drift.psi_band()))


@query
def ks_statistic(spark, sf_dir):
    return rounded(drift.ks_statistic(*bindings.early_and_late(spark, sf_dir), NUMERIC))


@query
def detect_drift(spark, sf_dir):
    return drift.detect_drift(*bindings.early_and_late(spark, sf_dir), NUMERIC)


@query
def profile_drift(spark, sf_dir):
    """The late half against a profile of the early half on disk."""
    early, late = bindings.early_and_late(spark, sf_dir)
    profile = reference_profile.write_profile(early, new_folder(spark), NUMERIC)
    return reference_profile.detect_drift_from_profile(profile, late)


@query
def detect_drift_exact(spark, sf_dir):
    """Exact p-values on the days' totals of the early and the late half, samples of some dozen days."""
    early, late = (by_day(part) for part in bindings.early_and_late(spark, sf_dir))
    return drift.detect_drift(early, late, NUMERIC, p_method="exact")


@query
def drift_summary(spark, sf_dir):
    requested = [*NUMERIC, "V3"]
    found = drift.detect_drift(*bindings.early_and_late(spark, sf_dir), requested)
    summary = rounded(drift.drift_summary(found, requested))
    return summary.withColumn("drifted_features", F.array_join("drifted_features", ","))


# ---- explanation -----------------------------------------------------------------------------


def _linear_phi(spark, sf_dir):
    return explain.linear_contributions(bindings.transactions(spark, sf_dir), LINEAR)


@query
def shap_long(spark, sf_dir):
    return rounded(explain.beeswarm(_linear_phi(spark, sf_dir), bindings.transactions(spark, sf_dir), 3))


@query
def shap_topn(spark, sf_dir):
    return rounded(explain.global_importance(_linear_phi(spark, sf_dir), 10))


@query
def shap_row(spark, sf_dir):
    return rounded(explain.row_contributions(_linear_phi(spark, sf_dir), 7))


@query
def shap_permutation(spark, sf_dir):
    """Hybrid rows scored with a linear margin, for which the result is known in closed form."""
    rows = bindings.transactions(spark, sf_dir).select("tx_id", F.array(*LINEAR).alias("x"))

    def margin(table):
        cells = vector_to_array("features")
        return table.withColumn("score", sum((F.lit(b) * cells[i] for i, b in enumerate(LINEAR.values())), F.lit(0.0)))

    background = explain.background_rows(rows, DEFAULTS.shap_permutations, 43)
    return rounded(explain.shapley_values(rows, background, margin, list(LINEAR), DEFAULTS.shap_permutations))


@query
def shap_kernel(spark, sf_dir):
    """All coalitions of the four features against 100 background rows; a linear margin's values are known in closed form."""
    rows = bindings.transactions(spark, sf_dir).select("tx_id", F.array(*LINEAR).alias("x"))

    def margin(table):
        cells = F.col("cells")
        return table.withColumn("score", sum((F.lit(b) * cells[i] for i, b in enumerate(LINEAR.values())), F.lit(0.0)))

    background = explain.background_rows(rows, DEFAULTS.shap_permutations, 43)
    return rounded(kernel_shapley_values(rows, background, margin, list(LINEAR), most_background=DEFAULTS.shap_permutations))


# ---- registry --------------------------------------------------------------------------------


def _entries(spark, sf_dir, threshold=None, suffix=""):
    """One registry entry per fold, with the fold's metrics."""
    folds = sampling.stratified_folds(decided(spark, sf_dir, threshold))
    rated = metrics.binary_metrics(folds, by="fold")
    last = folds.groupBy("fold").agg(F.max("Time").alias("last"))
    name = F.concat(F.lit("fold_"), F.col("fold").cast("string"))
    values = F.create_map(*[x for m in ("f1", "precision", "recall") for x in (F.lit(m), F.col(m))])
    return rated.join(last, "fold").select(
        name.alias("version"),
        F.timestamp_micros((F.col("last") * 1000000).cast("long")).alias("registered_at"),
        values.alias("metrics"),
        F.create_map(F.lit("threshold"), F.lit(str(threshold))).alias("params"),
        F.concat(F.lit("models/"), name, F.lit(suffix)).alias("model_path"),
        F.array(F.lit("fold")).alias("tags"),
        F.lit("").alias("notes"),
    )


def _flat(entries):
    got = [F.round(F.col("metrics")[m], 6).alias(m) for m in ("f1", "precision", "recall")]
    micros = F.unix_micros("registered_at").alias("registered_us")
    return entries.select("version", micros, *got, "model_path", F.array_join("tags", ",").alias("tags"))


@query
def registry_list(spark, sf_dir):
    return _flat(registry.list_versions(_entries(spark, sf_dir)))


@query
def registry_get(spark, sf_dir):
    return _flat(registry.get_version(_entries(spark, sf_dir), "fold_3"))


@query
def registry_insert(spark, sf_dir):
    known = _entries(spark, sf_dir).where("version < 'fold_3'")
    return _flat(registry.upsert(known, _entries(spark, sf_dir, 0.3, "_b").where("version > 'fold_1'")))


@query
def registry_upsert(spark, sf_dir):
    known = _entries(spark, sf_dir).where("version < 'fold_3'")
    new = _entries(spark, sf_dir, 0.3, "_b").where("version > 'fold_1'")
    return _flat(registry.upsert(known, new, overwrite=True))


@query
def registry_compare(spark, sf_dir):
    return rounded(registry.compare_versions(_entries(spark, sf_dir), ["fold_1", "fold_0", "absent"]))


@query
def registry_best(spark, sf_dir):
    return rounded(registry.best_version(_entries(spark, sf_dir), "f1"))


@query
def model_info(spark, sf_dir):
    entries = _entries(spark, sf_dir)
    both = registry.model_info(entries, "models/fold_2").unionByName(registry.model_info(entries, "models/none"))
    return both.select("model_path", "status", "version", F.round(F.col("metrics")["f1"], 6).alias("f1"))


# ---- scoring ---------------------------------------------------------------------------------


@query
def score_batch(spark, sf_dir):
    return rounded(scoring.score_with_coefficients(bindings.transactions(spark, sf_dir), INTERCEPT, COEFFICIENTS))


@query
def soft_vote_scores(spark, sf_dir):
    scored = bindings.scored_transactions(spark, sf_dir)
    for i, name in enumerate(("lr", "rf", "gbt")):
        scored = scored.withColumn(name, unit_interval(hash_key("tx_id", 100 + i)))
    voted = scored.withColumn("ensemble_fraud_proba", soft_vote({"lr": 1.0, "rf": 2.0, "gbt": 2.0}))
    prediction = projections.argmax_prediction("ensemble_fraud_proba").alias("ensemble_prediction")
    return voted.select("tx_id", *r6("lr", "rf", "gbt", "ensemble_fraud_proba"), prediction)


@query
def windowed_flags(spark, sf_dir):
    return _periods(scoring.windowed_flags(decided(spark, sf_dir)))


def _periods(counts):
    text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")}
    return counts.withColumns(text)


# ---- streams ---------------------------------------------------------------------------------


class PublishedModel:
    """The published coefficients behind a fitted model's interface."""

    def transform(self, df: DataFrame) -> DataFrame:
        scored = scoring.logistic_score(df, INTERCEPT, COEFFICIENTS)
        both = array_to_vector(F.array(1.0 - F.col("score"), F.col("score")))
        return scored.withColumns({"prediction": projections.argmax_prediction("score"), "probability": both})


def _events_stream(spark, sf_dir):
    """The events as a stream of files, whether the table is a directory of parts or a single file."""
    path = f"{sf_dir}/events.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return stream.parquet(path)
    return stream.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _stream_folders(spark):
    root = new_folder(spark)
    return f"{root}/out", f"{root}/checkpoint"


def _finish(started):
    started.awaitTermination()
    if started.exception() is not None:
        raise started.exception()


def _streamed_transactions(spark, sf_dir):
    start = bindings.table(spark, sf_dir, "events").select(F.min(bindings.epoch_micros("ts"))).first()[0]
    return bindings.as_transactions(_events_stream(spark, sf_dir), F.lit(start))


@query
def streamed_scores(spark, sf_dir):
    """The batch scoring code on a stream."""
    out, checkpoint = _stream_folders(spark)
    _finish(streams.score_stream(PublishedModel(), _streamed_transactions(spark, sf_dir), out, checkpoint, list(COEFFICIENTS)))
    return rounded(spark.read.parquet(out))


@query
def streamed_flags(spark, sf_dir):
    """All periods, added up over the micro-batches."""
    out, checkpoint = _stream_folders(spark)
    flagged = _events_stream(spark, sf_dir).select("ts", (F.col("value") >= 100).cast("int").alias("prediction"))
    _finish(streams.flag_rate_stream(flagged, out, checkpoint))
    return _periods(streams.read_flag_rates(spark, out))


@query
def streamed_drift(spark, sf_dir):
    """The whole table as one micro-batch against its early half."""
    out, checkpoint = _stream_folders(spark)
    early, _ = bindings.early_and_late(spark, sf_dir)
    _finish(streams.drift_stream(early, _streamed_transactions(spark, sf_dir), out, checkpoint, NUMERIC))
    return streams.read_drift(spark, out)


# ---- sinks and sources -----------------------------------------------------------------------


def _csv(df: DataFrame) -> str:
    path = f"{new_folder(df.sparkSession)}/csv"
    df.repartition(3).write.option("header", True).csv(path)
    return path


@query
def csv_round_trip(spark, sf_dir):
    """Written as CSV in several files and loaded again."""
    tx = bindings.transactions(spark, sf_dir)
    return rounded(load_transactions(spark, _csv(tx)).select(tx.columns))


@query
def csv_upload_scores(spark, sf_dir):
    """An uploaded CSV keeps its columns beside the scores."""
    records = bindings.transactions(spark, sf_dir).drop("Class")
    return rounded(runs.predict_run(spark, PublishedModel(), _csv(records), list(COEFFICIENTS)))


def _broken_csv(spark, sf_dir):
    """The transactions as CSV in several files, with cells that are no numbers in one line of seven and one of eleven."""
    tx = bindings.transactions(spark, sf_dir)
    broken = {
        "Amount": F.when(F.col("tx_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("Amount").cast("string")),
        "Time": F.when(F.col("tx_id") % 11 == 0, F.lit("?")).otherwise(F.col("Time").cast("string")),
    }
    return _csv(tx.withColumns(broken))


@query
def csv_quarantine(spark, sf_dir):
    """The lines that load, cell by cell."""
    accepted, _ = load_with_quarantine(spark, _broken_csv(spark, sf_dir), f"{new_folder(spark)}/parts")
    return rounded(accepted.select(bindings.transactions(spark, sf_dir).columns))


@query
def csv_rejects(spark, sf_dir):
    """The lines that don't, and why."""
    _, rejects = load_with_quarantine(spark, _broken_csv(spark, sf_dir), f"{new_folder(spark)}/parts")
    return rejects.select(F.substring_index("line", ",", 1).cast("long").alias("tx_id"), "reason")


@query
def partition_round_trip(spark, sf_dir):
    """Train and test rows from the directories they were written to."""
    path = f"{new_folder(spark)}/parts"
    write_partitions(sampling.stratified_split(bindings.transactions(spark, sf_dir)), path)
    parts = [read_partition(spark, path, part).withColumn("split", F.lit(part)) for part in ("train", "test")]
    return parts[0].unionByName(parts[1]).select("tx_id", "Class", "split")


def _reported(spark, save) -> DataFrame:
    path = f"{new_folder(spark)}/report"
    save(path)
    return reports.read_reports(spark, path, "parquet").drop("report", "model_name", "generated_at", "reference_period", "current_period")


@query
def metrics_report(spark, sf_dir):
    return _reported(spark, lambda path: reports.save_metrics_report(calculate_metrics(spark, sf_dir), "Published", path, "parquet"))


@query
def cost_report(spark, sf_dir):
    return _reported(spark, lambda path: reports.save_cost_report(cost_curve(spark, sf_dir), "Published", path, "parquet"))


@query
def drift_report(spark, sf_dir):
    return _reported(spark, lambda path: reports.save_drift_report(detect_drift(spark, sf_dir), path, fmt="parquet"))


@query
def registry_life_cycle(spark, sf_dir):
    """One entry per fold: registered with wrong metrics in one fold, refused, overwritten, one deleted. A commit each."""
    kept = registry.ModelRegistry(spark, f"{new_folder(spark)}/registry")
    entries = materialize(_entries(spark, sf_dir))
    wrong = F.create_map(F.lit("f1"), F.lit(-1.0))
    kept.register_all(entries.withColumn("metrics", F.when(F.col("version") == "fold_1", wrong).otherwise(F.col("metrics"))))
    kept.register_all(entries.withColumn("metrics", wrong))
    kept.register_all(entries.where("version = 'fold_1'"), overwrite=True)
    kept.delete("fold_0")
    return _flat(kept.list_versions())


@query
def score_single_published(spark, sf_dir):
    record = bindings.transactions(spark, sf_dir).orderBy(F.desc("Amount"), "tx_id").limit(1)
    return rounded(scoring.predict_single(spark, PublishedModel(), record, list(COEFFICIENTS)))


# ---- fitted models ---------------------------------------------------------------------------


def _landed_split(spark, sf_dir):
    return materialize(spread(sampling.stratified_split(bindings.transactions(spark, sf_dir))))


def _train_test(spark, sf_dir):
    """The split lands in the shared folder; training reads one part, evaluation the other."""
    tx = _landed_split(spark, sf_dir)
    return tx.where("split = 'train'").drop("split"), tx.where("split = 'test'").drop("split")


def _test_metrics(model, test, name):
    return rounded(runs.evaluate_model(model, test, name)[0])


@query
def baseline_regression(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _test_metrics(training.train_baseline(train), test, "baseline")


@query
def champion_forest(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _test_metrics(training.train_champion(train), test, "champion")


@query
def boosted_trees(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _test_metrics(training.train_boosted(train), test, "boosted")


@query
def plain_forest(spark, sf_dir):
    tx = _landed_split(spark, sf_dir)
    train = tx.where("split = 'train'").drop("split")
    return rounded(training.accuracy_by_split(training.plain_forest(train).fit(train), tx))


@query
def member_predictions(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return training.member_predictions(training.train_voting_ensemble(train), test)


@query
def feature_importance(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return training.feature_importance(training.train_champion(train), train)


@query
def cross_validation(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    return rounded(training.fold_scores(training.cross_validate(train, training.baseline(train))))


@query
def random_search(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    estimator = training.champion(train)
    return training.random_search(train, estimator, SearchSpace().forest, training.forest_params)[2]


@query
def score_fitted_model(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return rounded(scoring.score_batch(training.train_baseline(train), test, NUMERIC))


@query
def score_single(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    record = test.orderBy(F.desc("Amount"), "tx_id").limit(1)
    return rounded(scoring.predict_single(spark, training.train_baseline(train), record, NUMERIC))


@query
def explain_forest(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    phi = runs.explain_run(training.train_champion(train), test, method="tree")
    return explain.global_importance(phi)
