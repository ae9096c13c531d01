"""Splits, fitted transformations, training and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.functions.numeric import half_up
from galewright.operators import forest, importance, newton, prepare, sampling, training
from galewright.operators.scoring import LinearModel, batch_score as score_batches, score_linear as score_expressions
from galewright.plans.projecting import tier
from galewright.plans.quality import rounded
from galewright.plans.registration import CONTACTS, TIER, share_sql, digest_sql, query, with_sql
from galewright.session import materialize
from galewright.sources.fixtures import contacts


def _ranked(source: str, salt: str, name: str) -> str:
    return (
        f"{name} AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {digest_sql('contact_key', salt)}, contact_key) AS r_{name}, "
        f"count(*) OVER (PARTITION BY y) AS n_{name} FROM {source})"
    )


@query(
    "stratified_split",
    with_sql(CONTACTS, _ranked("contacts", "42", "o")) + "SELECT contact_key, y, CASE WHEN r_o <= ceil(n_o * 20 / 100.0) THEN 'test' ELSE 'train' END AS split FROM o",
)
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = contacts(spark, sf).select("contact_key", "y")
    return sampling.stratified_split(rows, "contact_key", "y")


@query("hash_split", with_sql(CONTACTS) + f"SELECT contact_key, CASE WHEN {share_sql('contact_key', 42, 0.2)} THEN 'test' ELSE 'train' END AS split FROM contacts")
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hash_split(contacts(spark, sf).select("contact_key"), "contact_key", 0.2)


@query(
    "nested_split",
    with_sql(CONTACTS, _ranked("contacts", "42", "o"), "t AS (SELECT * FROM o WHERE r_o > ceil(n_o * 20 / 100.0))", _ranked("t", "42-inner", "i"))
    + """SELECT contact_key, y, CASE WHEN r_i <= ceil(n_i * 33 / 100.0) THEN 'validation' ELSE 'train' END AS split FROM i
      UNION ALL SELECT contact_key, y, 'test' FROM o WHERE r_o <= ceil(n_o * 20 / 100.0)""",
)
def nested_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.nested_split(contacts(spark, sf).select("contact_key", "y"), "contact_key", "y")


_JOBS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]


@query(
    "one_hot",
    with_sql(CONTACTS) + "SELECT contact_key, " + ", ".join(f"CASE WHEN job = '{j}' THEN 1 ELSE 0 END AS \"job_{j}\"" for j in _JOBS) + " FROM contacts",
)
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Without the HOUSEHOLD segment, which is then unknown and encoded as all zeros."""
    return prepare.one_hot(contacts(spark, sf).select("contact_key", "job"), "job", _JOBS).drop("job")


@query(
    "index_category",
    with_sql(CONTACTS, "f AS (SELECT job, row_number() OVER (ORDER BY job) - 1 AS job_index FROM contacts WHERE job <> 'HOUSEHOLD' GROUP BY job)")
    + "SELECT contact_key, CAST(job_index AS BIGINT) AS job_index FROM contacts LEFT JOIN f USING (job)",
)
def index_category(spark: SparkSession, sf: str) -> DataFrame:
    rows = contacts(spark, sf).select("contact_key", "job")
    fitted = prepare.fit_categories(rows.filter(F.col("job") != "HOUSEHOLD"), "job")
    return prepare.index_category(rows, "job", fitted).drop("job")


_GAPS = "gaps AS (SELECT contact_key, NULLIF(pdays, -1) AS pdays, CASE WHEN balance >= 0 THEN balance END AS balance, NULLIF(job, 'BUILDING') AS job FROM contacts)"


@query(
    "impute",
    with_sql(CONTACTS, _GAPS)
    + """SELECT contact_key, ROUND(COALESCE(pdays, (SELECT avg(pdays) FROM gaps)), 6) AS pdays, ROUND(COALESCE(balance, (SELECT avg(balance) FROM gaps)), 6) AS balance,
      COALESCE(job, (SELECT job FROM gaps WHERE job IS NOT NULL GROUP BY job ORDER BY count(*) DESC, job LIMIT 1)) AS job FROM gaps""",
)
def impute(spark: SparkSession, sf: str) -> DataFrame:
    gaps = contacts(spark, sf).select(
        "contact_key",
        F.nullif(F.col("pdays"), F.lit(-1)).alias("pdays"),
        F.when(F.col("balance") >= 0, F.col("balance")).alias("balance"),
        F.nullif(F.col("job"), F.lit("BUILDING")).alias("job"),
    )
    return rounded(prepare.impute(gaps, ["pdays", "balance"], ["job"]), "pdays", "balance")


@query(
    "standard_scale",
    with_sql(CONTACTS)
    + """SELECT contact_key, ROUND((balance - avg(balance) OVER ()) / stddev_pop(balance) OVER (), 6) AS balance_z,
      ROUND((duration - avg(duration) OVER ()) / stddev_pop(duration) OVER (), 6) AS duration_z, CAST(0 AS DOUBLE) AS constant_z FROM contacts""",
)
def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    rows = contacts(spark, sf).select("contact_key", "balance", "duration", F.lit(7).alias("constant"))
    scaled = prepare.standard_scale(rows, ["balance", "duration", "constant"])
    return rounded(scaled.select("contact_key", "balance_z", "duration_z", "constant_z"), "balance_z", "duration_z", "constant_z")


@query(
    "class_weights",
    with_sql(CONTACTS)
    + """SELECT contact_key, y, ROUND(count(*) OVER () / (CAST((SELECT count(DISTINCT y) FROM contacts) AS DOUBLE) * count(*) OVER (PARTITION BY y)), 6) AS class_weight FROM contacts""",
)
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(prepare.with_class_weight(contacts(spark, sf).select("contact_key", "y"), "y"), "class_weight")


def contact_model() -> LinearModel:
    return LinearModel(
        -1.2713,
        {"balance": 0.00053, "duration": 0.00321, "campaign": -0.117},
        {"housing": {"yes": -0.433}, "job": {"BUILDING": 0.219, "MACHINERY": -0.171}},
    )


_CONTACT_SCORE = """1 / (1 + exp(-(CAST(-1.2713 AS DOUBLE) + balance * CAST(0.00053 AS DOUBLE) + duration * CAST(0.00321 AS DOUBLE) + campaign * CAST(-0.117 AS DOUBLE)
  + CASE WHEN housing = 'yes' THEN CAST(-0.433 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
  + CASE job WHEN 'BUILDING' THEN CAST(0.219 AS DOUBLE) WHEN 'MACHINERY' THEN CAST(-0.171 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)))"""
_PREDICTED = f"CASE WHEN {_CONTACT_SCORE} >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction"


@query("score_linear", with_sql(CONTACTS) + f"SELECT contact_key, ROUND({_CONTACT_SCORE}, 6) AS score, {_PREDICTED} FROM contacts")
def score_linear(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_expressions(contacts(spark, sf), contact_model())
    return scored.select("contact_key", half_up("score").alias("score"), "prediction")


@query("batch_score", with_sql(CONTACTS) + f"SELECT contact_key, {_PREDICTED} FROM contacts")
def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    model = contact_model()
    return score_batches(contacts(spark, sf), lambda: model, model.inputs).select("contact_key", "prediction")


# Training runs on a label that follows from the features, as the fixture's own label is close to random.
_CATEGORICAL = ["job", "housing", "loan", "duration_bucket"]
_NUMERIC = ["balance", "duration", "campaign", "previous"]


def with_signal(spark: SparkSession, sf: str) -> DataFrame:
    drive = F.col("duration") + F.col("campaign") * 40 + F.when(F.col("housing") == "no", F.lit(120)).otherwise(F.lit(0))
    label = F.when(drive + F.col("balance") / 20 > 560, F.lit(1)).otherwise(F.lit(0))
    return tier(spark, sf).withColumn("label", label)


def parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """train / validation / test, each read once from a written table."""
    wanted = with_signal(spark, sf).select("contact_key", "label", *_CATEGORICAL, *_NUMERIC)
    split = materialize(sampling.nested_split(wanted, "contact_key", "label"), "training")
    return {n: split.filter(F.col("split") == n).drop("split") for n in ("train", "validation", "test")}


_DRIVE = "duration + campaign * 40 + CASE WHEN housing = 'no' THEN 120 ELSE 0 END"
_WITH_SIGNAL = f"labelled AS (SELECT *, CASE WHEN {_DRIVE} + balance / CAST(20 AS DOUBLE) > 560 THEN 1 ELSE 0 END AS label FROM tier)"
# The training part: all but the first fifth of each class in digest order.
_TRAINED = f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {digest_sql('contact_key', 42)}, contact_key) AS r, count(*) OVER (PARTITION BY label) AS n FROM labelled),
trained AS (SELECT * FROM numbered WHERE r > ceil(n * 20 / 100.0)),
weighed AS (SELECT *, CAST(label AS DOUBLE) * count(*) OVER () / (2 * sum(label) OVER ()) AS wy FROM trained)"""
_LABEL_SUMS = " UNION ALL ".join(
    [
        "SELECT '(intercept)' AS feature, ROUND(sum(wy), 3) AS fitted FROM weighed",
        *[f"SELECT concat('{c}=', {c}), ROUND(sum(wy), 3) FROM weighed GROUP BY {c}" for c in _CATEGORICAL],
        *[f"SELECT '{c}', ROUND(sum(wy * z), 3) FROM (SELECT wy, ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z FROM weighed)" for c in _NUMERIC],
    ]
)


@query("train_logistic", with_sql(CONTACTS, TIER, _WITH_SIGNAL, _TRAINED) + _LABEL_SUMS)
def train_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """The score equations of the fitted model: at the optimum each feature's sum equals that of the labels."""
    p = parts(spark, sf)
    train = p["train"].unionByName(p["validation"])
    design = newton.Design.fitted(train, _CATEGORICAL, _NUMERIC)
    rows = newton.design_rows(train, design, "label")
    model = newton.fit_many(rows, design, [1.0])[0]
    return newton.score_equations(model, rows, 1.0).withColumn("fitted", half_up("fitted", 3))


def _floor_sql(part: str, name: str) -> str:
    """Rows and positives of a part, and the weighted F1 of guessing its larger class."""
    return f"""{name} AS (SELECT count(*) AS row_count, CAST(sum(label) AS BIGINT) AS positives,
      2 * power(greatest(sum(label), count(*) - sum(label)), 2) / (count(*) * CAST(count(*) + greatest(sum(label), count(*) - sum(label)) AS DOUBLE)) AS majority_f1 FROM {part})"""


_PARTS = f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {digest_sql('contact_key', 42)}, contact_key) AS r, count(*) OVER (PARTITION BY label) AS n FROM labelled),
test AS (SELECT * FROM numbered WHERE r <= ceil(n * 20 / 100.0)),
rest AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {digest_sql('contact_key', '42-inner')}, contact_key) AS ri, count(*) OVER (PARTITION BY label) AS ni FROM numbered WHERE r > ceil(n * 20 / 100.0)),
validation AS (SELECT * FROM rest WHERE ri <= ceil(ni * 33 / 100.0))"""


def _against_majority(part: DataFrame, weighted_f1: float) -> DataFrame:
    """A part's size, what guessing its larger class scores there, and whether the model beats that."""
    larger = F.greatest("positives", F.col("row_count") - F.col("positives"))
    counts = part.agg(F.count(F.lit(1)).alias("row_count"), F.sum("label").alias("positives"))
    floor = 2 * larger * larger / (F.col("row_count") * (F.col("row_count") + larger).cast("double"))
    return counts.withColumn("majority_f1", half_up(floor)).withColumn("beats_majority", F.lit(weighted_f1) > floor)


def _metric(rows: DataFrame, name: str) -> float:
    return rows.filter(F.col("metric") == name).first()["value"]


_FLOOR_COLUMNS = "row_count, positives, ROUND(majority_f1, 6) AS majority_f1, TRUE AS beats_majority"


@query("train_forest", with_sql(CONTACTS, TIER, _WITH_SIGNAL, _PARTS, _floor_sql("test", "f")) + f"SELECT {_FLOOR_COLUMNS} FROM f")
def train_forest(spark: SparkSession, sf: str) -> DataFrame:
    """The forest on the test part, against guessing the larger class."""
    p = parts(spark, sf)
    train = p["train"].unionByName(p["validation"])
    model = forest.fit_forest(train, "label", _CATEGORICAL, _NUMERIC)
    found = training.evaluate(model.apply(p["test"]), "label", "test_")
    return _against_majority(p["test"], _metric(found, "test_weighted_f1"))


_TUNED: dict[tuple[str, str], training.TuningResult] = {}


def _tuned(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], training.TuningResult]:
    """The parts, and the search over them; one application searches the same tables once."""
    p, key = parts(spark, sf), (spark.sparkContext.applicationId, sf)
    if key not in _TUNED:
        _TUNED[key] = training.tune(p["train"], p["validation"], "label", _CATEGORICAL, _NUMERIC, training.draw_trials(20, seed=42))
    return p, _TUNED[key]


@query(
    "tune_model",
    with_sql(CONTACTS, TIER, _WITH_SIGNAL, _PARTS, _floor_sql("validation", "f"))
    + f"SELECT CAST(20 AS BIGINT) AS trials, CAST(20 AS BIGINT) AS ranked, {_FLOOR_COLUMNS} FROM f",
)
def tune_model(spark: SparkSession, sf: str) -> DataFrame:
    """All trials are ranked; the best is held against guessing the larger class of the validation part."""
    p, result = _tuned(spark, sf)
    row = result.table.agg(F.count(F.lit(1)).alias("trials"), F.count("weighted_f1").alias("ranked"), F.max("weighted_f1").alias("best")).first()
    found = _against_majority(p["validation"], row["best"])
    return found.select(F.lit(row["trials"]).cast("bigint").alias("trials"), F.lit(row["ranked"]).cast("bigint").alias("ranked"), "*")


@query(
    "refit_best",
    with_sql(CONTACTS, TIER, _WITH_SIGNAL, _PARTS, _floor_sql("rest", "f"), _floor_sql("test", "g"))
    + f"SELECT 'training_weighted_f1' AS metric, {_FLOOR_COLUMNS} FROM f UNION ALL SELECT 'test_weighted_f1', {_FLOOR_COLUMNS} FROM g",
)
def refit_best(spark: SparkSession, sf: str) -> DataFrame:
    """The best trial fitted again on training and validation rows, on these and on the test part."""
    p, result = _tuned(spark, sf)
    train = p["train"].unionByName(p["validation"])
    found = materialize(training.refit_best(result.best, train, p["test"], "label", _CATEGORICAL, _NUMERIC)[1], "refit")
    sides = [
        _against_majority(part, _metric(found, name)).select(F.lit(name).alias("metric"), "*")
        for part, name in ((train, "training_weighted_f1"), (p["test"], "test_weighted_f1"))
    ]
    return sides[0].unionByName(sides[1])


_PERMUTED = {"balance": "balance", "duration": "duration", "campaign": "campaign", "housing": "housing", "job": "job"}
_VERSIONS = ", ".join(f"CASE WHEN column_name = '{c}' THEN next_{c} ELSE {c} END AS {c}" for c in _PERMUTED)
_NEXT = ", ".join(f"COALESCE(lead({c}) OVER w, first_value({c}) OVER w) AS next_{c}" for c in _PERMUTED)


@query(
    "top_importances",
    with_sql(
        CONTACTS,
        "flagged AS (SELECT *, CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS y_flag FROM contacts)",
        f"given AS (SELECT *, {_NEXT} FROM flagged WINDOW w AS (ORDER BY {digest_sql('contact_key', 42)}, contact_key))",
        f"versions AS (SELECT column_name, y_flag, {_VERSIONS} FROM given CROSS JOIN (VALUES (':none'), {', '.join(f'({c!r})' for c in _PERMUTED)}) v(column_name))",
        f"scored AS (SELECT column_name, y_flag, CAST({_CONTACT_SCORE} >= 0.5 AS INT) AS prediction FROM versions)",
        """cells AS (SELECT column_name, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (y_flag = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (y_flag = 0 AND prediction = 1) AS DOUBLE) AS fp,
      CAST(count(*) FILTER (y_flag = 1 AND prediction = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (y_flag = 0 AND prediction = 0) AS DOUBLE) AS tn FROM scored GROUP BY column_name)""",
        "f1s AS (SELECT column_name, (COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) * (tp + fn) + COALESCE(2 * tn / NULLIF(2 * tn + fp + fn, 0), 0) * (tn + fp)) / n AS weighted_f1 FROM cells)",
    )
    + """SELECT column_name, ROUND(weighted_f1, 6) AS weighted_f1, ROUND((SELECT weighted_f1 FROM f1s WHERE column_name = ':none') - weighted_f1, 6) AS importance
      FROM f1s WHERE column_name <> ':none' ORDER BY importance DESC, column_name LIMIT 3""",
)
def top_importances(spark: SparkSession, sf: str) -> DataFrame:
    """The three columns whose exchange costs the contact model most of its weighted F1."""
    model = contact_model()
    rows = contacts(spark, sf).withColumn("y_flag", F.when(F.col("y") == "yes", 1).otherwise(0))
    found = importance.permutation_importance(rows, "contact_key", "y_flag", list(_PERMUTED), lambda df: score_expressions(df, model))
    named = rounded(found, "weighted_f1", "importance")
    return named.orderBy(F.col("importance").desc(), "column_name").limit(3)


@query(
    "batch_score_forest",
    with_sql(CONTACTS, TIER, _WITH_SIGNAL, _PARTS) + "SELECT contact_key, label, TRUE AS score_decides FROM test",
)
def batch_score_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of the test part is scored, and its prediction is what its probability says."""
    p = parts(spark, sf)
    model = forest.fit_forest(p["train"].unionByName(p["validation"]), "label", _CATEGORICAL, _NUMERIC)
    scored = model.apply(p["test"])
    decided = F.col("score").between(0, 1) & ((F.col("prediction") == 1) == (F.col("score") > 0.5))
    return scored.select("contact_key", "label", decided.alias("score_decides"))
