"""Reduction and balancing (F4-F7), classification (G1-G11), anomaly scores (G12-G15) and alert building (I13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilake import knowledge as kb
from vigilake.operators import anomaly as A
from vigilake.operators import classes as L
from vigilake.operators import classify as G
from vigilake.operators import features as X
from vigilake.operators.balancing import smote, synthetic_rows
from vigilake.operators.scaling import apply_pca
from vigilake.plans.flows import balance_features, detect_and_respond
from vigilake.session import staged, staging_path
from vigilake.sources import sinks
from vigilake.workload import fixtures as fx
from vigilake.workload.feature_queries import W, fx_events
from vigilake.workload.fixtures import r6, sql_r6
from vigilake.workload.registry import query

COLUMNS = fx.vector_columns()

# Fitted results have no SQL form. Beside each such query stands one that derives properties which must hold for any fit,
# with the same figures computed in SQL.
VECTORS_SQL = """
v as (select vec_id as id, case when label = 0 then 'benign' else concat('attack_', cast(label as varchar)) end as label from embeddings)"""
SIZES_SQL = f"{VECTORS_SQL}, c as (select label, count(*) as n from v group by label), top as (select max(n) as most from c)"


# --- F ------------------------------------------------------------------------------------
@query("f04_principal_components")
def f04_principal_components(spark, sf_dir):
    reduced, _ = apply_pca(fx.vectors(spark, sf_dir), COLUMNS, n_components=8)
    return reduced


@query("f04_explained_variance")
def f04_explained_variance(spark, sf_dir):
    _, components = apply_pca(fx.vectors(spark, sf_dir), COLUMNS, variance_threshold=0.95)
    ratios = components.analysis()["explained_variance_ratio"]
    return spark.createDataFrame([(i + 1, r) for i, r in enumerate(ratios)], "component int, explained double")


@query("f04_component_properties", f"""
with v as (select {", ".join(f"cast(embedding[{i + 1}] as double) as {c}" for i, c in enumerate(COLUMNS))} from embeddings)
select cast(i as int) as component, count(*) as n, true as centred, true as variance_is_share
from v, (select range as i from range(1, 9)) k group by i""")
def f04_component_properties(spark, sf_dir):
    rows = staged(fx.vectors(spark, sf_dir), "vectors")
    reduced, components = apply_pca(rows, COLUMNS, n_components=8)
    total = sum(rows.agg(*[F.var_samp(c) for c in COLUMNS]).first())
    shares = components.analysis()["explained_variance_ratio"]
    sides = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.col(f"PC{i + 1}").alias("v"), F.lit(shares[i] * total).alias("due"))
                      for i in range(8)])
    return reduced.select(F.explode(sides).alias("s")).groupBy("s.component").agg(
        F.count(F.lit(1)).alias("n"), (F.abs(F.avg("s.v")) < 1e-6).alias("centred"),
        (F.abs(F.var_samp("s.v") - F.first("s.due")) < 1e-6 * total).alias("variance_is_share"))


@query("f05_segment_property", f"""
with {SIZES_SQL} select label, most - n as synthetic, most - n as inside from c, top where most > n""")
def f05_segment_property(spark, sf_dir):
    """A synthetic row lies between two rows of its class, hence inside the box of the class in every coordinate."""
    rows = staged(fx.vectors(spark, sf_dir), "vectors")
    added = synthetic_rows(rows, COLUMNS)
    bounds = rows.groupBy("label").agg(*[f(c).alias(f"{n}_{c}") for c in COLUMNS for f, n in ((F.min, "low"), (F.max, "high"))])
    inside = None
    for c in COLUMNS:
        held = F.col(c).between(F.col(f"low_{c}") - 1e-9, F.col(f"high_{c}") + 1e-9)
        inside = held if inside is None else inside & held
    return added.join(bounds, "label").groupBy("label").agg(F.count(F.lit(1)).alias("synthetic"), F.count_if(inside).alias("inside"))


@query("f05_oversampled_counts", f"""
with {SIZES_SQL}
select label, false as is_synthetic, n from c
union all select label, true, most - n from c, top where most > n""")
def f05_oversampled_counts(spark, sf_dir):
    resampled = smote(fx.vectors(spark, sf_dir), COLUMNS)
    return resampled.groupBy("label", "is_synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("f06_distribution_change", f"""
with {SIZES_SQL} select label, n as samples_before, most as samples_after, most - n as synthetic_created from c, top""")
def f06_distribution_change(spark, sf_dir):
    before = fx.vectors(spark, sf_dir)
    return L.distribution_change(before, smote(before, COLUMNS))


@query("f07_balanced_components")
def f07_balanced_components(spark, sf_dir):
    balanced, _ = balance_features(fx.vectors(spark, sf_dir), COLUMNS, n_components=8)
    return balanced


@query("f07_balanced_counts", f"""
with {SIZES_SQL} select label, most as n from c, top""")
def f07_balanced_counts(spark, sf_dir):
    return f07_balanced_components(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# --- G: classification --------------------------------------------------------------------
@query("g01_label_codes", f"""
with {VECTORS_SQL} select id, label, cast(dense_rank() over (order by label) - 1 as double) as label_index from v""")
def g01_label_codes(spark, sf_dir):
    encoded, _ = G.encode_labels(fx.vectors(spark, sf_dir).select("id", "label"))
    return encoded


@query("g02_stratified_split", f"""
with {SIZES_SQL} select label, cast(ceil(n * 0.2) as bigint) as test_rows, n - cast(ceil(n * 0.2) as bigint) as train_rows from c""")
def g02_stratified_split(spark, sf_dir):
    split = L.stratified_split(fx.vectors(spark, sf_dir).select("id", "label"))
    return split.groupBy("label").agg(F.count_if("is_test").alias("test_rows"), F.count_if(~F.col("is_test")).alias("train_rows"))


@query("g03_class_weights", f"""
with {SIZES_SQL}, t as (select sum(n) as total, count(*) as classes from c)
select id, label, {sql_r6("total / (classes * n)", "weight")} from v join c using (label), t""")
def g03_class_weights(spark, sf_dir):
    weighted = L.balanced_weights(fx.vectors(spark, sf_dir).select("id", "label"))
    return weighted.select("id", "label", r6("weight"))


@query("g04_forest_predictions")
def g04_forest_predictions(spark, sf_dir):
    split = L.stratified_split(fx.vectors(spark, sf_dir))
    model, labels = G.fit_forest(split.filter(~F.col("is_test")), COLUMNS)
    predicted = G.predict_threats(model, split.filter("is_test"), labels)
    return predicted.select("id", "label", "predicted_label", "confidence", "probabilities")


@query("g04_prediction_properties", f"""
with {SIZES_SQL} select label, cast(ceil(n * 0.2) as bigint) as n, cast(ceil(n * 0.2) as bigint) as consistent from c""")
def g04_prediction_properties(spark, sf_dir):
    """Every test row once, probabilities that sum to 1, and the label of the largest one."""
    predicted = g04_forest_predictions(spark, sf_dir)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    names = [r["label"] for r in fx.vectors(spark, sf_dir).select("label").distinct().orderBy("label").collect()]
    at = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("predicted_label")).cast("int")
    holds = (F.abs(total - 1) < 1e-9) & (F.element_at("probabilities", at) == F.col("confidence")) & (
        F.col("confidence") == F.array_max("probabilities"))
    return predicted.groupBy("label").agg(F.count_distinct("id").alias("n"), F.count_if(holds).alias("consistent"))


CONFUSION_SQL = f"p as ({fx.PREDICTIONS_SQL}), cc as (select label, prediction, count(*) as n from p group by all)"
REPORT_SQL = f"""
{CONFUSION_SQL},
cls as (select label as class from p union select prediction from p),
r0 as (select class, coalesce((select sum(n) from cc where label = class), 0) as support,
         coalesce((select sum(n) from cc where prediction = class), 0) as predicted,
         coalesce((select sum(n) from cc where label = class and prediction = class), 0) as hits from cls),
rep as (select class, cast(support as bigint) as support, cast(hits as bigint) as hits,
          case when predicted = 0 then 0 else hits / predicted end as precision_,
          case when support = 0 then 0 else hits / support end as recall_,
          case when support + predicted = 0 then 0 else 2 * hits / (support + predicted) end as f1 from r0)"""


@query("g05_overall_metrics", f"""
with {REPORT_SQL}, o as (select sum(hits) / sum(support) as accuracy, avg(precision_) as precision_macro, avg(recall_) as recall_macro,
  avg(f1) as f1_macro, sum(precision_ * support) / sum(support) as precision_weighted,
  sum(recall_ * support) / sum(support) as recall_weighted, sum(f1 * support) / sum(support) as f1_weighted,
  cast(sum(support) as bigint) as support from rep)
select support, {", ".join(sql_r6(c) for c in ["accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted",
                                                "recall_weighted", "f1_weighted"])} from o""")
def g05_overall_metrics(spark, sf_dir):
    metrics = G.overall_metrics(G.class_report(fx.predictions(spark, sf_dir)))
    return metrics.select("support", *[r6(c) for c in metrics.columns if c != "support"])


@query("g06_confusion_matrix", f"""
with {CONFUSION_SQL}, cls as (select label as class from p union select prediction from p)
select a.class as label, b.class as prediction, coalesce(n, 0) as n
from cls a cross join cls b left join cc on cc.label = a.class and cc.prediction = b.class""")
def g06_confusion_matrix(spark, sf_dir):
    return G.confusion_matrix(fx.predictions(spark, sf_dir))


@query("g07_class_report", f"""
with {REPORT_SQL} select class, {sql_r6("precision_", "precision")}, {sql_r6("recall_", "recall")}, {sql_r6("f1")}, support from rep""")
def g07_class_report(spark, sf_dir):
    report = G.class_report(fx.predictions(spark, sf_dir))
    return report.select("class", r6("precision"), r6("recall"), r6("f1"), "support")


@query("g08_fold_sizes", f"""
with {SIZES_SQL} select label, cast(f.fold as int) as fold, n // 5 + cast(f.fold < n % 5 as bigint) as n
from c, (select range as fold from range(5)) f where n // 5 + cast(f.fold < n % 5 as bigint) > 0""")
def g08_fold_sizes(spark, sf_dir):
    folds = L.stratified_folds(fx.vectors(spark, sf_dir).select("id", "label"))
    return folds.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("g08_cross_validation")
def g08_cross_validation(spark, sf_dir):
    return G.cross_validate(fx.vectors(spark, sf_dir), COLUMNS)


@query("g10_training_summary", f"""
with {SIZES_SQL}
select cast(sum(ceil(n * 0.2)) as bigint) as test_rows, cast(5 as bigint) as folds, true as summary_follows, true as in_range
from c""")
def g10_training_summary(spark, sf_dir):
    """The whole training flow: its test rows, its folds, and a summary that follows from the fold scores."""
    result = G.train_and_evaluate(fx.vectors(spark, sf_dir), COLUMNS)
    scores = result["cv_scores"].agg(F.count(F.lit(1)).alias("folds"), F.avg("f1_macro").alias("mean"), F.stddev_pop("f1_macro").alias("std"),
                                     F.min(F.least("f1_macro", "accuracy")).alias("low"), F.max(F.greatest("f1_macro", "accuracy")).alias("high"))
    follows = (F.abs(F.col("cv_f1_mean") - F.col("mean")) < 1e-9) & (F.abs(F.col("cv_f1_std") - F.col("std")) < 1e-9)
    one_row = result["metrics"].select(F.col("support").alias("test_rows"), F.lit(1).alias("one")).join(
        result["cv_summary"].withColumn("one", F.lit(1)), "one").join(scores.withColumn("one", F.lit(1)), "one")
    return one_row.select("test_rows", "folds", follows.alias("summary_follows"),
                          ((F.col("low") >= 0) & (F.col("high") <= 1)).alias("in_range"))


@query("g09_importance_properties", "select cast(10 as bigint) as n, true as in_order, true as shares")
def g09_importance_properties(spark, sf_dir):
    top = g09_feature_importance(spark, sf_dir).withColumn("place", F.row_number().over(Window.orderBy(F.desc("importance"))))
    ahead = F.lag("importance").over(Window.orderBy("place"))
    return top.withColumn("ok", F.coalesce(ahead >= F.col("importance"), F.lit(True))).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("ok").alias("in_order"),
        ((F.sum("importance") <= 1 + 1e-9) & (F.min("importance") >= 0)).alias("shares"))


@query("g09_feature_importance")
def g09_feature_importance(spark, sf_dir):
    model, _ = G.fit_forest(fx.vectors(spark, sf_dir), COLUMNS)
    return G.top_features(model, COLUMNS, spark)


@query("g11_reloaded_model")
def g11_reloaded_model(spark, sf_dir):
    """Predictions of a forest that went through storage (A8)."""
    rows = fx.vectors(spark, sf_dir)
    model, labels = G.fit_forest(rows, COLUMNS)
    path = staging_path(spark, "forest")
    sinks.save_model(model, path, {"labels": labels, "columns": COLUMNS})
    loaded, metadata = sinks.load_model(spark, path)
    return G.predict_threats(loaded, rows, metadata["labels"]).select("id", "label", "predicted_label", "confidence")


@query("g11_reload_properties", f"with {SIZES_SQL} select sum(n)::bigint as n, sum(n)::bigint as same from c")
def g11_reload_properties(spark, sf_dir):
    """A stored and reloaded forest predicts what the one in memory predicts."""
    rows = fx.vectors(spark, sf_dir)
    model, labels = G.fit_forest(rows, COLUMNS)
    path = staging_path(spark, "forest")
    sinks.save_model(model, path, {"labels": labels, "columns": COLUMNS})
    loaded, metadata = sinks.load_model(spark, path)
    kept = ["id", "predicted_label", "probabilities"]
    own = G.predict_threats(model, rows, labels).select(*kept)
    again = G.predict_threats(loaded, rows, metadata["labels"]).select("id", *[F.col(c).alias(f"again_{c}") for c in kept[1:]])
    same = (F.col("predicted_label") == F.col("again_predicted_label")) & (F.col("probabilities") == F.col("again_probabilities"))
    return own.join(again, "id").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("same"))


# --- G: anomalies -------------------------------------------------------------------------
@query("g12_anomaly_scores")
def g12_anomaly_scores(spark, sf_dir):
    rows = fx.vectors(spark, sf_dir)
    detector = A.train_detector(rows, COLUMNS, label="label")
    flagged = A.detect_anomalies(detector["model"].score(rows), detector["threshold"])
    return flagged.select("id", "label", "anomaly_score", "is_anomaly")


@query("g12_score_properties", f"with {SIZES_SQL} select label, n, n as consistent from c")
def g12_score_properties(spark, sf_dir):
    """Scores are not negative, and a row is flagged exactly where its score is above the threshold."""
    rows = fx.vectors(spark, sf_dir)
    detector = A.train_detector(rows, COLUMNS, label="label")
    flagged = A.detect_anomalies(detector["model"].score(rows), detector["threshold"])
    holds = (F.col("anomaly_score") >= 0) & (F.col("is_anomaly") == (F.col("anomaly_score") > F.lit(detector["threshold"])))
    return flagged.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(holds).alias("consistent"))


@query("g12_landmark_properties", f"with {SIZES_SQL} select label, n, n as consistent, n as coded from c")
def g12_landmark_properties(spark, sf_dir):
    """The same of the nonlinear encoder, whose code is kept."""
    rows = fx.vectors(spark, sf_dir)
    detector = A.train_detector(rows, COLUMNS, label="label", nonlinear=True)
    flagged = A.detect_anomalies(detector["model"].score(rows, latent="code"), detector["threshold"])
    holds = (F.col("anomaly_score") >= 0) & (F.col("is_anomaly") == (F.col("anomaly_score") > F.lit(detector["threshold"])))
    coded = (F.size("code") == A.LATENT_WIDTH) & F.forall("code", lambda v: v.isNotNull() & ~F.isnan(v))
    return flagged.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(holds).alias("consistent"), F.count_if(coded).alias("coded"))


@query("g13_threshold", f"select {sql_r6('quantile_cont(score, 0.95)', 'threshold')} from ({fx.PREDICTIONS_SQL}) p")
def g13_threshold(spark, sf_dir):
    threshold = A.determine_threshold(fx.predictions(spark, sf_dir), 95.0, "score")
    return spark.createDataFrame([(threshold,)], "t double").select(r6("t", "threshold"))


@query("g14_flagged_rate", f"""
with p as ({fx.PREDICTIONS_SQL}), q as (select quantile_cont(score, 0.95) as t from p)
select count(*) as total, count(case when score > t then 1 end) as anomalies,
  {sql_r6("count(case when score > t then 1 end) / count(*)", "rate")} from p, q""")
def g14_flagged_rate(spark, sf_dir):
    rows = fx.predictions(spark, sf_dir)
    flagged = A.detect_anomalies(rows, A.determine_threshold(rows, 95.0, "score"), "score")
    return A.anomaly_rate(flagged).select("total", "anomalies", r6("rate"))


@query("g15_split_errors")
def g15_split_errors(spark, sf_dir):
    return A.train_detector(fx.vectors(spark, sf_dir), COLUMNS, label="label")["errors"]


@query("g15_split_sizes", f"with {SIZES_SQL} select n, true as two_parts from c where label = 'benign'")
def g15_split_sizes(spark, sf_dir):
    """Training and validation part hold every benign row once."""
    return g15_split_errors(spark, sf_dir).agg(F.sum("n").alias("n"), (F.count(F.lit(1)) == 2).alias("two_parts"))


# --- I13: from detections to alerts -------------------------------------------------------
def training_rows(spark, sf_dir) -> DataFrame:
    """Feature rows with an id and a label: windows far above the average in one feature count as attacks."""
    matrix = X.feature_matrix(fx_events(spark, sf_dir), W)
    watched = {"severity_mean": "lateral_movement", "avg_dst_port": "exfiltration", "event_count": "ddos"}
    stats = matrix.agg(*[F.avg(c) for c in watched], *[F.stddev_pop(c) for c in watched]).first()
    label = F.lit("benign")
    for i, (column, name) in enumerate(watched.items()):
        label = F.when(F.col(column) > stats[i] + stats[i + len(watched)], name).otherwise(label)
    return matrix.withColumns({"label": label, "id": F.xxhash64("pod", "window_start")})


@query("i13_alerts_from_detections")
def i13_alerts_from_detections(spark, sf_dir):
    events = fx_events(spark, sf_dir).withColumn("namespace", F.lit("prod"))
    columns = [*X.TEMPORAL, *X.TRAFFIC, *X.SYSCALL, *X.BEHAVIOUR]
    planned = detect_and_respond(events, training_rows(spark, sf_dir), columns, W)
    return planned.select("alert_id", "pod", "namespace", "threat_type", "confidence_score", "risk_level", "mitre_technique",
                          "predicted_next_stage", "anomaly_score", "received_at", "status", F.size("actions").alias("action_count"))


@query("i13_alert_properties", """
select true as attack_or_anomaly, true as statuses_follow, true as actions_follow""")
def i13_alert_properties(spark, sf_dir):
    """Every alert names an attack or an anomaly, and status and actions follow from its confidence."""
    alerts = i13_alerts_from_detections(spark, sf_dir)
    below = F.col("confidence_score") < kb.CONFIDENCE_THRESHOLD
    return alerts.agg(
        F.coalesce(F.bool_and(F.col("threat_type") != "benign"), F.lit(True)).alias("attack_or_anomaly"),
        F.coalesce(F.bool_and((F.col("status") == "below_threshold") == below), F.lit(True)).alias("statuses_follow"),
        F.coalesce(F.bool_and((F.col("action_count") == 0) == below), F.lit(True)).alias("actions_follow"))
