"""The catalog's queries in ANSI SQL, for an independent engine on the same tables."""

from __future__ import annotations

import itertools

from wardenlake.plans.catalog import COEFFICIENTS, INTERCEPT, LINEAR, NUMERIC
from wardenlake.plans.newton_sql import fitted_scores
from wardenlake.schema import COMPONENTS, FEATURES

TX = """tx AS (
  SELECT event_id AS tx_id,
         (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events))::DOUBLE / 1000000.0::DOUBLE AS Time,
         user_id::DOUBLE AS V1, json_extract(props, '$.k')::DOUBLE AS V2, value AS Amount,
         CASE WHEN event_type = 'error' AND value >= 100 THEN 1 ELSE 0 END AS Class, ts
  FROM events)"""


def unit(text: str, start: int = 1) -> str:
    return f"(('0x' || substr(md5({text}), {start}, 8))::BIGINT / 4294967296.0::DOUBLE)"


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in columns)


SCORED = f"""{TX}, scored AS (
  SELECT *, CASE WHEN score > 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction FROM (
    SELECT *, floor(1000.0::DOUBLE * (0.55::DOUBLE * {unit("tx_id::VARCHAR || '|42'")} + 0.35::DOUBLE * Class + 0.05::DOUBLE))
              / 1000.0::DOUBLE AS score FROM tx))"""
GAPS = f"""{TX}, gaps AS (SELECT tx_id, Time, V1, V2, CASE WHEN tx_id % 17 <> 0 THEN Amount END AS Amount, Class FROM tx)"""
TX_ROWS = f"tx_id, {r6('Time')}, V1, V2, {r6('Amount')}, Class"


def ratio(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0), 0.0)"


RATES = f"""
  round({ratio('tp + tn', 'tp + fp + fn + tn')}, 6) + 0.0 AS accuracy,
  round({ratio('tp', 'tp + fp')}, 6) + 0.0 AS precision,
  round({ratio('tp', 'tp + fn')}, 6) + 0.0 AS recall,
  round({ratio('2 * tp', '2 * tp + fp + fn')}, 6) + 0.0 AS f1,
  round({ratio('tp::DOUBLE * tn - fp::DOUBLE * fn',
               'sqrt((tp + fp)::DOUBLE * (tp + fn)::DOUBLE * (tn + fp)::DOUBLE * (tn + fn)::DOUBLE)')}, 6) + 0.0 AS mcc"""


def counts(prediction: str = "prediction") -> str:
    return f"""count(*) FILTER (WHERE Class = 1 AND {prediction} = 1) AS tp,
      count(*) FILTER (WHERE Class = 0 AND {prediction} = 1) AS fp,
      count(*) FILTER (WHERE Class = 1 AND {prediction} = 0) AS fn,
      count(*) FILTER (WHERE Class = 0 AND {prediction} = 0) AS tn"""


def at(threshold: float) -> str:
    return f"(CASE WHEN score >= {threshold}::DOUBLE THEN 1 ELSE 0 END)"


SPLIT = f"""split AS (
  SELECT *, CASE WHEN place <= round(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY Class ORDER BY md5(tx_id::VARCHAR || '|42')) AS place,
           count(*) OVER (PARTITION BY Class) AS n FROM %s))"""
FOLDS = """folds AS (
  SELECT *, (ntile(5) OVER (PARTITION BY Class ORDER BY md5(tx_id::VARCHAR || '|42')) - 1)::INTEGER AS fold FROM scored)"""

POINTS = """points AS (
  SELECT score AS threshold, sum(Class)::DOUBLE AS pos, sum(1 - Class)::DOUBLE AS neg FROM scored GROUP BY score),
 upto AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM points
          WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
 whole AS (SELECT sum(pos) AS p, sum(neg) AS n FROM points)"""
CURVE = f"{SCORED}, {POINTS}"
AREAS = """SELECT round(sum(neg * (tp + tp - pos) / 2) / (any_value(p) * any_value(n)), 6) + 0.0 AS roc_auc,
  round(sum(pos * (tp / (tp + fp) + coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0), 1.0)) / 2) / any_value(p), 6) + 0.0 AS pr_auc
  FROM upto, whole"""

GRID = """grid AS (
  SELECT CASE WHEN i = 199 THEN 0.99::DOUBLE ELSE 0.01::DOUBLE + i * ((0.99::DOUBLE - 0.01::DOUBLE) / 199.0::DOUBLE) END AS threshold
  FROM range(200) t(i))"""
SWEEP = f"""{SCORED}, {GRID}, sweep AS (
  SELECT threshold, {counts('(CASE WHEN score >= threshold THEN 1 ELSE 0 END)')} FROM grid, scored GROUP BY threshold)"""


def optimal(metric: str) -> str:
    return f"""WITH {SWEEP}, rated AS (SELECT threshold, {RATES} FROM sweep),
      exact AS (SELECT threshold, {RATES.replace('round(', '(').replace(', 6)', ')')} FROM sweep)
      SELECT round(e.threshold, 6) + 0.0 AS optimal_threshold, r.{metric} AS best_score, '{metric}' AS metric_optimised,
             r.precision, r.recall, r.f1, r.mcc
      FROM exact e JOIN rated r USING (threshold) ORDER BY e.{metric} DESC, e.threshold LIMIT 1"""




def cents(amount: str) -> str:
    """Half-up on the decimal text of the number, which is how Spark rounds."""
    return f"round(({amount})::VARCHAR::DECIMAL(38, 16), 2)::DOUBLE + 0.0"


MISSED, ALARMS, SAVED = "fn * 122.21::DOUBLE * 0.75::DOUBLE", "fp * 15.0::DOUBLE", "tp * 122.21::DOUBLE * 0.25::DOUBLE"
COSTS = f"""tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
  {cents(MISSED)} AS fn_cost_usd, {cents(ALARMS)} AS fp_cost_usd, {cents(SAVED)} AS tp_savings_usd,
  {cents(f'{MISSED} + {ALARMS}')} AS total_cost_usd, {cents(f'{SAVED} - ({MISSED} + {ALARMS})')} AS net_benefit_usd,
  122.21::DOUBLE AS avg_fraud_amount, 15.0::DOUBLE AS investigation_cost, 0.25::DOUBLE AS fraud_recovery_rate"""

HALVES = f"""{TX}, sided AS (SELECT *, Time >= (SELECT max(Time) / 2 FROM tx) AS cur FROM tx),
 long AS ({' UNION ALL '.join(f"SELECT cur, '{c}' AS feature, {c} AS value FROM sided" for c in NUMERIC)})"""
PSI = """edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS cuts
  FROM long WHERE NOT cur GROUP BY feature),
 bins AS (SELECT feature, cuts[i] AS lo, cuts[i + 1] AS hi, i = len(cuts) - 1 AS is_last
          FROM (SELECT feature, cuts, unnest(range(1, len(cuts))) AS i FROM edges)),
 sizes AS (SELECT feature, count(*) FILTER (WHERE NOT cur) AS nr, count(*) FILTER (WHERE cur) AS nc FROM long GROUP BY feature),
 binned AS (
  SELECT b.feature, b.lo, count(*) FILTER (WHERE NOT cur) AS r, count(*) FILTER (WHERE cur) AS c
  FROM bins b LEFT JOIN long l ON l.feature = b.feature AND l.value >= b.lo AND (l.value < b.hi OR (b.is_last AND l.value <= b.hi))
  GROUP BY b.feature, b.lo),
 shares AS (SELECT feature, r / (nr + 1e-8::DOUBLE) + 1e-8::DOUBLE AS r, c / (nc + 1e-8::DOUBLE) + 1e-8::DOUBLE AS c
            FROM binned JOIN sizes USING (feature)),
 psi AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY feature)"""
KS = """steps AS (SELECT feature, value, count(*) FILTER (WHERE NOT cur) AS r, count(*) FILTER (WHERE cur) AS c FROM long GROUP BY 1, 2),
 cdf AS (SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc FROM steps
         WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
 ks AS (SELECT feature, max(cr) AS n_ref, max(cc) AS n_cur, max(abs(cr::DOUBLE / nr - cc::DOUBLE / nc)) AS d FROM cdf JOIN
        (SELECT feature, sum(r) AS nr, sum(c) AS nc FROM steps GROUP BY feature) USING (feature) GROUP BY feature),
 tested AS (SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, (
      SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0::DOUBLE * k * k * lam * lam)) FROM range(1, 101) s(k)))) END AS p
   FROM (SELECT *, d * sqrt(n_ref::DOUBLE * n_cur::DOUBLE / (n_ref + n_cur)::DOUBLE) AS lam FROM ks))"""
DRIFT = f"""{HALVES}, {PSI}, {KS}, drift AS (
  SELECT feature, round(d, 6) + 0.0 AS ks_statistic, round(p, 6) + 0.0 AS ks_pvalue, p < 0.05 AS ks_drift_detected,
         round(psi, 6) + 0.0 AS psi, psi >= 0.1 AS psi_drift_detected,
         CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END AS psi_band,
         (p < 0.05 OR psi >= 0.1) AS drift_detected
  FROM tested JOIN psi USING (feature))"""
# the whole table as the current side, against its early half
WHOLE_LONG = f"""long AS ({' UNION ALL '.join(
    f"SELECT false AS cur, '{c}' AS feature, {c} AS value FROM sided WHERE NOT cur UNION ALL SELECT true, '{c}', {c} FROM sided"
    for c in NUMERIC)})"""
STREAMED_DRIFT = DRIFT[: DRIFT.index("long AS")] + WHOLE_LONG + DRIFT[DRIFT.index(", edges AS"):]

PHI = f"""{TX}, phi AS ({' UNION ALL '.join(
    f"SELECT tx_id, '{c}' AS feature, {c} AS value, {b}::DOUBLE * ({c} - (SELECT avg({c}) FROM tx)) AS phi FROM tx"
    for c, b in LINEAR.items())}),
 means AS (SELECT feature, avg(abs(phi)) AS mean_abs_phi FROM phi GROUP BY feature),
 ranked AS (SELECT feature, mean_abs_phi, (row_number() OVER (ORDER BY mean_abs_phi DESC, feature))::INTEGER AS rank FROM means)"""

MARGIN = " + ".join([f"({INTERCEPT}::DOUBLE)"] + [f"({b}::DOUBLE) * {c if c in NUMERIC else '0.0::DOUBLE'}" for c, b in COEFFICIENTS.items()])
PUBLISHED = f"""WITH {TX}, s AS (SELECT tx_id, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({MARGIN}))) AS p FROM tx)
  SELECT tx_id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction_class,
         CASE WHEN p > 0.5 THEN 'Fraudulent' ELSE 'Legitimate' END AS prediction_label,
         round(p, 6) + 0.0 AS fraud_probability, round(1.0::DOUBLE - p, 6) + 0.0 AS legitimate_probability FROM s"""

ONCE = f"""{TX}, {SPLIT % 'tx'}, given AS (SELECT *, 0 AS held, split AS part FROM split), {fitted_scores('given')}"""
FITTED = f"""SELECT tx_id, prediction AS prediction_class, CASE WHEN prediction = 1 THEN 'Fraudulent' ELSE 'Legitimate' END AS prediction_label,
  round(score, 6) + 0.0 AS fraud_probability, round(1.0::DOUBLE - score, 6) + 0.0 AS legitimate_probability FROM fitted"""
HELD_OUT = f"""{TX}, {SPLIT % 'tx'}, {FOLDS.replace('FROM scored', "FROM split WHERE split = 'train'")},
 given AS (SELECT f.*, k.held, CASE WHEN f.fold = k.held THEN 'test' ELSE 'train' END AS part
   FROM folds f, (SELECT i::INTEGER AS held FROM range(5) t(i)) k), {fitted_scores('given')}"""

SCALED = f"""{TX}, z AS (SELECT tx_id, Class,
    round((Time - (SELECT avg(Time) FROM tx)) / (SELECT stddev_pop(Time) FROM tx), 6) AS a,
    round((Amount - (SELECT avg(Amount) FROM tx)) / (SELECT stddev_pop(Amount) FROM tx), 6) AS b, V1 AS c, V2 AS d FROM tx),
 rare AS (SELECT * FROM z WHERE Class = 1),
 near AS (SELECT * FROM (
    SELECT p.tx_id AS id, q.tx_id AS neighbor,
           sqrt((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) + (p.c - q.c) * (p.c - q.c) + (p.d - q.d) * (p.d - q.d)) AS distance,
           row_number() OVER (PARTITION BY p.tx_id ORDER BY (p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b)
             + (p.c - q.c) * (p.c - q.c) + (p.d - q.d) * (p.d - q.d), q.tx_id) AS rank
    FROM rare p, rare q WHERE p.tx_id <> q.tx_id) WHERE rank <= 5)"""
SMOTE = f"""{SCALED}, sizes AS (SELECT (count(*) - 2 * sum(Class))::BIGINT AS missing, sum(Class)::BIGINT AS n FROM z),
 work AS (SELECT r.*, missing // n + CASE WHEN row_number() OVER (ORDER BY md5(tx_id::VARCHAR || '|42')) <= missing % n THEN 1 ELSE 0 END AS copies
          FROM rare r, sizes),
 copies AS (SELECT *, unnest(range(1, copies + 1)) AS copy_no FROM work),
 draws AS (SELECT *, tx_id::VARCHAR || '|' || copy_no::VARCHAR || '|42' AS k FROM copies),
 picks AS (SELECT *, {unit('k')} AS u, 1 + floor({unit('k', 9)} * 5)::INTEGER AS pick FROM draws)"""


def versions(threshold: float | None = None, suffix: str = "") -> str:
    rule = "prediction" if threshold is None else at(threshold)
    return f"""SELECT 'fold_' || fold AS version, (max(Time) * 1000000.0::DOUBLE)::BIGINT AS registered_us,
      {counts(rule)}, 'models/fold_' || fold || '{suffix}' AS model_path, 'fold' AS tags FROM folds GROUP BY fold"""


ENTRY = f"version, registered_us, f1, precision, recall, model_path, tags"
RATED = f"SELECT version, registered_us, model_path, tags, {RATES} FROM"
ENTRIES = f"{SCORED}, {FOLDS}, entries AS ({RATED} ({versions()}))"
NEWER = f"newer AS ({RATED} ({versions(0.3, '_b')}) WHERE version > 'fold_1')"

ORACLE = {
    "scan_transactions": f"WITH {TX} SELECT {TX_ROWS} FROM tx",
    "project_features": f"WITH {TX} SELECT tx_id, {r6('Time')}, V1, V2, {r6('Amount')} FROM tx",
    "align_schema": f"""WITH {TX} SELECT tx_id, {', '.join(
        f"round({c}, 6) + 0.0 AS {c}" if c in NUMERIC else f"0.0::DOUBLE AS {c}" for c in FEATURES)} FROM tx""",
    "record_defaults": f"""WITH {GAPS} SELECT tx_id, {r6('Time', 'Amount')},
        CASE WHEN tx_id % 5 <> 0 THEN V1 ELSE 0.0 END AS V1, V2, 0.0::DOUBLE AS V28 FROM gaps WHERE Amount IS NOT NULL""",
    "record_rejects": f"WITH {GAPS} SELECT tx_id, {r6('Time', 'Amount')} FROM gaps WHERE Amount IS NULL",
    "filter_class": f"WITH {TX} SELECT {TX_ROWS} FROM tx WHERE Class = 1",
    "apply_threshold": f"WITH {SCORED} SELECT tx_id, score, {at(0.3)} AS prediction FROM scored",
    "label_text": f"""WITH {SCORED} SELECT tx_id, CASE WHEN prediction = 1 THEN 'Fraudulent' ELSE 'Legitimate' END AS prediction_label,
        CASE WHEN prediction = 1 THEN 'Fraud' ELSE 'Legit' END AS short_label,
        round(1.0::DOUBLE - score, 6) + 0.0 AS legitimate_probability FROM scored""",
    "preview_head": f"WITH {TX} SELECT {TX_ROWS} FROM tx ORDER BY tx_id LIMIT 5",
    "preview_tail": f"WITH {TX} SELECT {TX_ROWS} FROM tx ORDER BY tx_id DESC LIMIT 5",
    "class_balance": f"""WITH {TX} SELECT Class, count(*) AS n_rows,
        round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM tx), 6) + 0.0 AS pct FROM tx GROUP BY Class""",
    "fraud_share": f"""WITH {TX} SELECT count(*) AS n_rows, sum(Class)::BIGINT AS n_fraud,
        round(100.0::DOUBLE * sum(Class) / count(*), 6) + 0.0 AS fraud_pct FROM tx""",
    "null_total": f"WITH {GAPS} SELECT (count(*) - count(Amount))::BIGINT AS n_missing FROM gaps",
    "null_counts": f"WITH {GAPS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS n_present, count(*) - count({c}) AS n_missing FROM gaps"
        for c, t in {"tx_id": "bigint", "Time": "double", "V1": "double", "V2": "double", "Amount": "double", "Class": "int"}.items()
    ),
    "table_shape": f"WITH {TX}, {SPLIT % 'tx'} SELECT split, count(*) AS n_rows, 6::BIGINT AS n_columns FROM split GROUP BY split",
    "describe_by_class": f"""WITH {TX} SELECT Class, count(Amount) AS n, round(avg(Amount), 6) + 0.0 AS mean,
        round(stddev_samp(Amount), 6) + 0.0 AS std, round(min(Amount), 6) + 0.0 AS min,
        round(quantile_cont(Amount, 0.25), 6) + 0.0 AS q25, round(quantile_cont(Amount, 0.5), 6) + 0.0 AS q50,
        round(quantile_cont(Amount, 0.75), 6) + 0.0 AS q75, round(max(Amount), 6) + 0.0 AS max FROM tx GROUP BY Class""",
    "mean_by_class": f"WITH {TX} SELECT Class, {', '.join(f'round(avg({c}), 6) + 0.0 AS {c}' for c in NUMERIC)} FROM tx GROUP BY Class",
    "correlation_matrix": "WITH wide AS (SELECT "
    + ", ".join(f"embedding[{i + 1}]::DOUBLE AS {c}" for i, c in enumerate(COMPONENTS))
    + ", CASE WHEN label = 0 THEN 1 ELSE 0 END AS Class FROM embeddings), one AS (SELECT "
    + ", ".join(f"corr({a}, {b}) AS c_{a}_{b}" for a, b in itertools.combinations([*COMPONENTS, "Class"], 2))
    + " FROM wide) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
        + ("1.0::DOUBLE" if a == b else f"round(c_{a}_{b}, 6) + 0.0" if i < j else f"round(c_{b}_{a}, 6) + 0.0")
        + " AS corr FROM one"
        for (i, a), (j, b) in itertools.product(enumerate([*COMPONENTS, "Class"]), repeat=2)
    ),
    "correlation_with_gaps": f"WITH {GAPS} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {'max(1.0::DOUBLE)' if a == b else f'round(corr({a}, {b}), 6) + 0.0'} AS corr FROM gaps"
        for a, b in itertools.product([*NUMERIC, "Class"], repeat=2)
    ),
    "amount_density": f"""WITH {TX}, s AS (SELECT Class, count(*) AS n, stddev_samp(Amount) * power(count(*)::DOUBLE, -0.2::DOUBLE) AS h
        FROM tx GROUP BY Class), g AS (SELECT i * (1000.0::DOUBLE / 199.0::DOUBLE) AS x FROM range(200) t(i))
        SELECT Class, round(x, 6) + 0.0 AS x,
          round(sum(exp(-0.5::DOUBLE * ((x - Amount) / h) * ((x - Amount) / h)) / (n * h * sqrt(2.0::DOUBLE * pi()))), 9) + 0.0 AS density
        FROM tx JOIN s USING (Class), g GROUP BY Class, x""",
    "confusion_matrix": f"WITH {SCORED} SELECT {counts()} FROM scored",
    "flag_summary": f"""WITH {SCORED} SELECT count(*) AS total_transactions, sum(prediction)::BIGINT AS total_flagged_frauds FROM scored""",
    "stratified_split": f"WITH {TX}, {SPLIT % 'tx'} SELECT tx_id, Class, split FROM split",
    "plain_split": f"WITH {TX}, {(SPLIT % 'tx').replace('PARTITION BY Class', '')} SELECT tx_id, Class, split FROM split",
    "stratified_folds": f"WITH {SCORED}, {FOLDS} SELECT tx_id, Class, fold FROM folds",
    "seeded_sample": f"WITH {TX} SELECT {TX_ROWS} FROM tx ORDER BY md5(tx_id::VARCHAR || '|42') LIMIT 500",
    "class_weights": f"""WITH {TX} SELECT Class, count(*) AS n_rows,
        round((SELECT count(*) FROM tx)::DOUBLE / (2 * count(*)), 6) + 0.0 AS weight FROM tx GROUP BY Class""",
    "row_weights": f"""WITH {TX} SELECT tx_id, Class,
        round((count(*) OVER ())::DOUBLE / (2 * count(*) OVER (PARTITION BY Class)), 6) + 0.0 AS weight FROM tx""",
    "smote_neighbors": f"WITH {SCALED} SELECT id, neighbor, round(distance, 6) + 0.0 AS distance, rank::INTEGER AS rank FROM near",
    "smote_oversample": f"""WITH {SMOTE} SELECT p.tx_id AS source_id, p.copy_no, q.tx_id AS neighbor_id, 1 AS Class,
        {', '.join(f'round(p.{v} + u * (q.{v} - p.{v}), 6) + 0.0 AS f{i}' for i, v in enumerate('abcd'))}
        FROM picks p JOIN near ON near.id = p.tx_id AND near.rank = p.pick JOIN rare q ON q.tx_id = near.neighbor""",
    "impute_median": f"""WITH {GAPS} SELECT tx_id, round(coalesce(Amount, (SELECT quantile_cont(Amount, 0.5) FROM gaps)), 6) + 0.0 AS Amount,
        V1 FROM gaps""",
    "winsorize": f"WITH {TX} SELECT tx_id, round(least(Amount, (SELECT quantile_cont(Amount, 0.999) FROM tx)), 6) + 0.0 AS Amount FROM tx",
    "outlier_counts": f"WITH {TX} SELECT count(*) AS Amount FROM tx WHERE Amount > (SELECT quantile_cont(Amount, 0.999) FROM tx)",
    "standard_scale": f"""WITH {TX} SELECT tx_id, V1, V2, {', '.join(
        f'round(({c} - (SELECT avg({c}) FROM tx)) / (SELECT stddev_pop({c}) FROM tx), 6) + 0.0 AS {c}' for c in ('Time', 'Amount'))} FROM tx""",
    "feature_matrix": f"""WITH {GAPS}, {SPLIT % 'gaps'}, filled AS (SELECT tx_id, split, Time, V1, V2,
          coalesce(Amount, (SELECT quantile_cont(Amount, 0.5) FROM split WHERE split = 'train')) AS Amount FROM split),
        capped AS (SELECT tx_id, split, Time, V1, V2,
          least(Amount, (SELECT quantile_cont(Amount, 0.999) FROM filled WHERE split = 'train')) AS Amount FROM filled),
        stats AS (SELECT avg(Time) AS mt, stddev_pop(Time) AS st, avg(Amount) AS ma, stddev_pop(Amount) AS sa FROM capped WHERE split = 'train')
        SELECT tx_id, split, round((Time - mt) / st, 6) + 0.0 AS f0, round((Amount - ma) / sa, 6) + 0.0 AS f1, V1 AS f2, V2 AS f3
        FROM capped, stats""",
    "binary_metrics": f"WITH {SCORED}, m AS (SELECT {counts()} FROM scored) SELECT *, {RATES} FROM m",
    "cv_fold_metrics": f"WITH {SCORED}, {FOLDS}, m AS (SELECT fold, {counts()} FROM folds GROUP BY fold) SELECT *, {RATES} FROM m",
    "cv_summary": f"""WITH {SCORED}, {FOLDS}, m AS (SELECT fold, {counts()} FROM folds GROUP BY fold),
        s AS (SELECT {ratio('2 * tp', '2 * tp + fp + fn')} AS f1 FROM m)
        SELECT round(avg(f1), 6) + 0.0 AS mean, round(2.0 * stddev_pop(f1), 6) + 0.0 AS spread FROM s""",
    "roc_auc": f"WITH {CURVE} SELECT roc_auc FROM ({AREAS})",
    "pr_auc": f"WITH {CURVE} SELECT pr_auc FROM ({AREAS})",
    "roc_curve": f"""WITH {CURVE} SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL SELECT threshold, round(fp / n, 6) + 0.0, round(tp / p, 6) + 0.0 FROM upto, whole""",
    "pr_curve": f"""WITH {CURVE} SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS recall, 1.0::DOUBLE AS precision
        UNION ALL SELECT threshold, round(tp / p, 6) + 0.0, round(tp / (tp + fp), 6) + 0.0 FROM upto, whole""",
    "calculate_metrics": f"""WITH {CURVE}, m AS (SELECT {counts()} FROM scored), a AS ({AREAS})
        SELECT m.*, {RATES}, roc_auc, pr_auc FROM m, a""",
    "classification_report": f"""WITH {SCORED}, m AS (SELECT {counts()} FROM scored), c AS (
          SELECT '0' AS class, {ratio('tn', 'tn + fn')} AS precision, {ratio('tn', 'tn + fp')} AS recall,
                 {ratio('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM m
          UNION ALL SELECT '1', {ratio('tp', 'tp + fp')}, {ratio('tp', 'tp + fn')}, {ratio('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM m),
        r AS (SELECT * FROM c
          UNION ALL SELECT 'accuracy', {ratio('tp + tn', 'tp + fp + fn + tn')}, {ratio('tp + tn', 'tp + fp + fn + tn')},
                 {ratio('tp + tn', 'tp + fp + fn + tn')}, tp + fp + fn + tn FROM m
          UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM c
          UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), sum(support)::BIGINT FROM c)
        SELECT class, {r6('precision', 'recall', 'f1')}, support::BIGINT AS support FROM r""",
    "compare_models": f"""WITH {SCORED}, s AS (SELECT {RATES} FROM (SELECT {counts(at(0.6))} FROM scored)),
        l AS (SELECT {RATES} FROM (SELECT {counts(at(0.4))} FROM scored)) """
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, s.{m} AS strict, l.{m} AS lenient FROM s, l" for m in ("accuracy", "precision", "recall", "f1", "mcc")
    ),
    "optimal_threshold_f1": optimal("f1"),
    "optimal_threshold_mcc": optimal("mcc"),
    "threshold_curve": f"WITH {SWEEP} SELECT round(threshold, 6) + 0.0 AS threshold, tp, fp, fn, tn, {RATES} FROM sweep",
    "financial_cost": f"WITH {SCORED}, m AS (SELECT {counts(at(0.5))} FROM scored) SELECT 0.5::DOUBLE AS threshold, {COSTS} FROM m",
    "cost_curve": f"WITH {SWEEP} SELECT round(threshold, 6) + 0.0 AS threshold, {COSTS} FROM sweep",
    "best_cost_threshold": f"""WITH {SWEEP} SELECT round(threshold, 6) + 0.0 AS threshold, {COSTS} FROM sweep
        ORDER BY net_benefit_usd DESC, sweep.threshold LIMIT 1""",
    "psi": f"""WITH {HALVES}, {PSI} SELECT feature, round(psi, 6) + 0.0 AS psi,
        CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END AS psi_band FROM psi""",
    "ks_statistic": f"""WITH {HALVES}, {KS} SELECT feature, n_ref::BIGINT AS n_ref, n_cur::BIGINT AS n_cur,
        round(d, 6) + 0.0 AS ks_statistic FROM ks""",
    "detect_drift": f"WITH {DRIFT} SELECT * FROM drift",
    "profile_drift": f"WITH {DRIFT} SELECT * FROM drift",
    "drift_summary": f"""WITH {DRIFT} SELECT count(*) FILTER (WHERE drift_detected) AS n_drifted, 5::BIGINT AS n_requested,
        round(count(*) FILTER (WHERE drift_detected) / 5.0::DOUBLE, 6) + 0.0 AS drift_ratio,
        coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drift_detected), '') AS drifted_features FROM drift""",
    "shap_topn": f"WITH {PHI} SELECT feature, {r6('mean_abs_phi')}, rank FROM ranked WHERE rank <= 10",
    "shap_row": f"""WITH {PHI} SELECT tx_id, feature, {r6('value')}, round(phi.phi, 6) + 0.0 AS phi FROM phi
        WHERE tx_id = 7 ORDER BY abs(phi.phi) DESC, feature LIMIT 15""",
    "shap_long": f"""WITH {PHI} SELECT feature, tx_id, {r6('value')}, round(phi.phi, 6) + 0.0 AS phi, rank FROM phi
        JOIN ranked USING (feature) WHERE rank <= 3""",
    "shap_permutation": f"""WITH {TX}, base AS (SELECT * FROM tx ORDER BY md5(tx_id::VARCHAR || '|43') LIMIT 100) """
    + " UNION ALL ".join(
        f"SELECT tx_id, '{c}' AS feature, round({b}::DOUBLE * ({c} - (SELECT avg({c}) FROM base)), 6) + 0.0 AS phi FROM tx"
        for c, b in LINEAR.items()
    ),
    "registry_list": f"WITH {ENTRIES} SELECT {ENTRY} FROM entries",
    "registry_get": f"WITH {ENTRIES} SELECT {ENTRY} FROM entries WHERE version = 'fold_3'",
    "registry_insert": f"""WITH {ENTRIES}, {NEWER}, known AS (SELECT * FROM entries WHERE version < 'fold_3')
        SELECT {ENTRY} FROM known UNION ALL SELECT {ENTRY} FROM newer WHERE version NOT IN (SELECT version FROM known)""",
    "registry_upsert": f"""WITH {ENTRIES}, {NEWER}, known AS (SELECT * FROM entries WHERE version < 'fold_3')
        SELECT {ENTRY} FROM newer UNION ALL SELECT {ENTRY} FROM known WHERE version NOT IN (SELECT version FROM newer)""",
    "registry_compare": f"WITH {ENTRIES} "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, max({m}) FILTER (WHERE version = 'fold_1') AS fold_1,
        max({m}) FILTER (WHERE version = 'fold_0') AS fold_0 FROM entries"""
        for m in ("f1", "precision", "recall")
    ),
    "registry_best": f"WITH {ENTRIES} SELECT version, f1 AS value FROM entries ORDER BY f1 DESC, registered_us, version LIMIT 1",
    "model_info": f"""WITH {ENTRIES} SELECT model_path, 'found' AS status, version, f1 FROM entries WHERE version = 'fold_2'
        UNION ALL SELECT 'models/none', 'not_found', NULL, NULL""",
    "score_batch": PUBLISHED,
    "streamed_scores": PUBLISHED,
    "streamed_flags": """WITH h AS (SELECT date_trunc('hour', ts) AS start, count(*) AS n, count(*) FILTER (WHERE value >= 100) AS f
          FROM events GROUP BY 1)
        SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(start + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
          n AS total_transactions, f AS total_flagged_frauds FROM h""",
    "streamed_drift": f"WITH {STREAMED_DRIFT} SELECT *, 0::BIGINT AS batch_id FROM drift",
    "soft_vote_scores": f"""WITH {TX}, m AS (SELECT tx_id, {unit("tx_id::VARCHAR || '|100'")} AS lr, {unit("tx_id::VARCHAR || '|101'")} AS rf,
          {unit("tx_id::VARCHAR || '|102'")} AS gbt FROM tx),
        v AS (SELECT *, (1.0::DOUBLE * lr + 2.0::DOUBLE * rf + 2.0::DOUBLE * gbt) / 5.0::DOUBLE AS ensemble_fraud_proba FROM m)
        SELECT tx_id, {r6('lr', 'rf', 'gbt')}, round(ensemble_fraud_proba, 6) + 0.0 AS ensemble_fraud_proba,
          CASE WHEN v.ensemble_fraud_proba > 0.5 THEN 1 ELSE 0 END AS ensemble_prediction FROM v""",
    "windowed_flags": f"""WITH {SCORED} SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
        strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS total_transactions,
        sum(prediction)::BIGINT AS total_flagged_frauds FROM scored GROUP BY date_trunc('hour', ts)""",
}

SCORES_BESIDE = f"""WITH {TX}, s AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({MARGIN}))) AS p FROM tx)
  SELECT tx_id, {r6('Time')}, V1, V2, {r6('Amount')}, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction_class,
         CASE WHEN p > 0.5 THEN 'Fraudulent' ELSE 'Legitimate' END AS prediction_label,
         round(p, 6) + 0.0 AS fraud_probability, round(1.0::DOUBLE - p, 6) + 0.0 AS legitimate_probability FROM s"""

ORACLE |= {
    "csv_round_trip": ORACLE["scan_transactions"],
    "shap_kernel": ORACLE["shap_permutation"],
    "csv_upload_scores": SCORES_BESIDE,
    "csv_quarantine": ORACLE["scan_transactions"] + " WHERE tx_id % 7 <> 0 AND tx_id % 11 <> 0",
    "csv_rejects": """SELECT event_id AS tx_id, 'not a number: ' || CASE WHEN event_id % 77 = 0 THEN 'Time, Amount'
        WHEN event_id % 7 = 0 THEN 'Amount' ELSE 'Time' END AS reason FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0""",
    "partition_round_trip": ORACLE["stratified_split"],
    "metrics_report": ORACLE["calculate_metrics"],
    "cost_report": ORACLE["cost_curve"],
    "drift_report": ORACLE["detect_drift"],
    "registry_life_cycle": f"WITH {ENTRIES} SELECT {ENTRY} FROM entries WHERE version <> 'fold_0'",
    "baseline_regression": f"""WITH RECURSIVE {ONCE}, scored AS (SELECT * FROM fitted), {POINTS},
        m AS (SELECT {counts()} FROM scored), a AS ({AREAS}) SELECT m.*, {RATES}, roc_auc, pr_auc, 'baseline' AS model FROM m, a""",
    "cross_validation": f"""WITH RECURSIVE {HELD_OUT}, m AS (SELECT held, {counts()} FROM fitted GROUP BY held)
        SELECT held AS fold, round({ratio('2 * tp', '2 * tp + fp + fn')}, 6) + 0.0 AS score FROM m""",
    "score_fitted_model": f"WITH RECURSIVE {ONCE} {FITTED}",
    "score_single": f"""WITH RECURSIVE {ONCE} {FITTED}
        WHERE tx_id = (SELECT tx_id FROM split WHERE split = 'test' ORDER BY Amount DESC, tx_id LIMIT 1)""",
    "score_single_published": f"SELECT * FROM ({PUBLISHED}) WHERE tx_id = (SELECT event_id FROM events ORDER BY value DESC, event_id LIMIT 1)",
}
