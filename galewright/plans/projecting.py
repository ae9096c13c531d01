"""Projections, filters, sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.functions import rules
from galewright.operators import project
from galewright.operators.aggregates import count_by, to_rows
from galewright.operators.sampling import hash_sample
from galewright.plans.registration import CONTACTS, RATIO, SCORED, TIER, share_sql, query, with_sql
from galewright.sources.fixtures import contacts, scored_events, table


def tier(spark: SparkSession, sf: str) -> DataFrame:
    return rules.presets()["v1_tier"].apply(contacts(spark, sf))


@query("select_columns", with_sql(CONTACTS) + "SELECT contact_key, age, job, balance, y FROM contacts")
def select_columns(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["age", "job", "balance"]
    return contacts(spark, sf).select("contact_key", *wanted, "y")


@query(
    "derive_column",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, ROUND(l_extendedprice * (1 - l_discount), 6) AS net_price, "
    "ROUND(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS gross_price FROM lineitem",
)
def derive_column(spark: SparkSession, sf: str) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    derived = table(spark, sf, "lineitem").withColumns({"net_price": F.round(net, 6), "gross_price": F.round(net * (1 + F.col("l_tax")), 6)})
    return derived.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "net_price", "gross_price")


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").drop("o_orderstatus", "o_orderpriority")


@query("star_except", with_sql(SCORED) + "SELECT * EXCLUDE (inference_timestamp) FROM scored")
def star_except(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("SELECT * EXCEPT (inference_timestamp) FROM {scored}", scored=scored_events(spark, sf))


@query("reorder_metadata_last", with_sql(SCORED) + "SELECT event_id, job, balance, y_flag, prediction, model_version, inference_timestamp FROM scored")
def reorder_metadata_last(spark: SparkSession, sf: str) -> DataFrame:
    return project.reorder_metadata_last(scored_events(spark, sf), ["prediction", "model_version", "inference_timestamp"])


@query("filter_range", with_sql(CONTACTS) + "SELECT * FROM contacts WHERE age >= 18")
def filter_range(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).filter(F.col("age") >= rules.MINIMUM_AGE)


@query("filter_in_list", with_sql(CONTACTS) + "SELECT * FROM contacts WHERE job IN ('BUILDING', 'MACHINERY')")
def filter_in_list(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).filter(F.col("job").isin("BUILDING", "MACHINERY"))


_MODEL_INPUTS = {"age_group": "string", "contact_intensity": "double", "was_previously_contacted": "int", "recency_score": "double"}


@query("require_columns", with_sql(CONTACTS, RATIO) + f"SELECT {', '.join(_MODEL_INPUTS)} FROM ratio")
def require_columns(spark: SparkSession, sf: str) -> DataFrame:
    featured = rules.presets()["v2_ratio"].apply(contacts(spark, sf))
    checked = project.require_columns(featured, _MODEL_INPUTS)
    return checked.withColumns({c: F.round(c, 6) for c in ("contact_intensity", "recency_score")})


@query(
    "filter_not_null",
    with_sql(SCORED) + "SELECT event_id, NULLIF(y_flag, 0) AS y_flag FROM scored WHERE NULLIF(y_flag, 0) IS NOT NULL",
)
def filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    late = scored_events(spark, sf).select("event_id", F.nullif(F.col("y_flag"), F.lit(0)).alias("y_flag"))
    return late.filter(F.col("y_flag").isNotNull())


@query("hash_sample", with_sql(SCORED) + f"SELECT * FROM scored WHERE {share_sql('event_id', 42, 0.2)}")
def sample(spark: SparkSession, sf: str) -> DataFrame:
    return hash_sample(scored_events(spark, sf), "event_id", 0.2)


@query(
    "compound_predicate",
    with_sql(CONTACTS)
    + """SELECT contact_key, CASE WHEN (balance < 0 OR (housing = 'yes' AND loan = 'yes')) AND NOT y = 'yes' THEN 1 ELSE 0 END AS at_risk
      FROM contacts""",
)
def compound_predicate(spark: SparkSession, sf: str) -> DataFrame:
    risky = ((F.col("balance") < 0) | (rules.yes("housing") & rules.yes("loan"))) & ~rules.yes("y")
    return contacts(spark, sf).select("contact_key", rules.flag(risky).alias("at_risk"))


SLICES = ["job", "balance_tier", "duration_bucket", "try_cast(financial_stress AS INT) = 1", "was_previously_contacted = 1"]


@query(
    "slice_predicates",
    with_sql(CONTACTS, TIER)
    + """SELECT slice_key, slice_value, count(*) AS row_count, CAST(sum(y_flag) AS BIGINT) AS positives FROM (
        SELECT ':all' AS slice_key, ':all' AS slice_value, y_flag FROM tier
        UNION ALL SELECT 'job', job, y_flag FROM tier
        UNION ALL SELECT 'balance_tier', balance_tier, y_flag FROM tier
        UNION ALL SELECT 'duration_bucket', duration_bucket, y_flag FROM tier
        UNION ALL SELECT 'try_cast(financial_stress AS INT) = 1',
          COALESCE(CAST(TRY_CAST(financial_stress AS INT) = 1 AS VARCHAR), 'null'), y_flag FROM tier
        UNION ALL SELECT 'was_previously_contacted = 1', CAST(was_previously_contacted = 1 AS VARCHAR), y_flag FROM tier)
      GROUP BY slice_key, slice_value""",
)
def slice_predicates(spark: SparkSession, sf: str) -> DataFrame:
    sliced = project.slice_rows(tier(spark, sf), SLICES)
    return sliced.groupBy("slice_key", "slice_value").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("y_flag").alias("positives")
    )


@query(
    "stamp_metadata",
    with_sql(SCORED)
    + """SELECT event_id, prediction, 'contact-model' AS model_name, 'champion' AS model_alias, '3' AS model_version,
      inference_timestamp AS scored_at FROM scored""",
)
def stamp_metadata(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_events(spark, sf).select("event_id", "prediction", "inference_timestamp")
    stamped = project.stamp_metadata(scored, "contact-model", "champion", "3", F.col("inference_timestamp"))
    return stamped.drop("inference_timestamp")


@query(
    "split_by_dtype",
    with_sql(CONTACTS)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS kind, count({c}) AS non_null FROM contacts"
        for c, k in {
            "contact_key": "numeric", "age": "numeric", "balance": "numeric", "duration": "numeric", "campaign": "numeric",
            "pdays": "numeric", "previous": "numeric", "job": "categorical", "housing": "categorical", "loan": "categorical",
            "y": "categorical",
        }.items()
    ),
)
def split_by_dtype(spark: SparkSession, sf: str) -> DataFrame:
    rows = contacts(spark, sf)
    categorical, numeric = project.split_by_dtype(rows)
    kinds = dict.fromkeys(categorical, "categorical") | dict.fromkeys(numeric, "numeric")
    counted = rows.agg(*[F.count(c).alias(c) for c in kinds])
    cells = {c: F.struct(F.lit(k).alias("kind"), F.col(c).alias("non_null")) for c, k in kinds.items()}
    return to_rows(counted, [], cells, "column_name")


@query(
    "features_without_label",
    with_sql(CONTACTS, TIER) + "SELECT f.contact_key, age_group, balance_tier, y_flag FROM tier f",
)
def features_without_label(spark: SparkSession, sf: str) -> DataFrame:
    features, labels = project.features_without_label(tier(spark, sf), "contact_key", ["age_group", "balance_tier"], "y_flag")
    return features.join(labels, "contact_key")


@query("order_by", "SELECT o_orderpriority, o_orderstatus, count(*) AS row_count FROM orders GROUP BY ALL ORDER BY 1, 2")
def order_by(spark: SparkSession, sf: str) -> DataFrame:
    return count_by(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus").orderBy("o_orderpriority", "o_orderstatus")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query("limit_sample", with_sql(SCORED) + "SELECT * FROM scored ORDER BY event_id LIMIT 5000")
def limit_sample(spark: SparkSession, sf: str) -> DataFrame:
    return scored_events(spark, sf).orderBy("event_id").limit(5000)


_PART_A = "SELECT contact_key, job, balance, 'kept' AS origin FROM contacts WHERE job <> 'BUILDING'"
_PART_B = "SELECT contact_key, job, balance + 2000 AS balance, 'changed' AS origin FROM contacts WHERE job = 'BUILDING'"


@query("union_by_name", with_sql(CONTACTS) + f"{_PART_A} UNION ALL {_PART_B}")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    rows = contacts(spark, sf)
    kept = rows.filter(F.col("job") != "BUILDING").select("contact_key", "job", "balance", F.lit("kept").alias("origin"))
    changed = rows.filter(F.col("job") == "BUILDING").select(
        F.lit("changed").alias("origin"), (F.col("balance") + 2000).alias("balance"), "contact_key", "job"
    )
    return kept.unionByName(changed)


@query(
    "union_all",
    with_sql(CONTACTS)
    + """SELECT 'all' AS version, count(*) AS row_count FROM contacts UNION ALL
      SELECT 'adults' AS version, count(*) AS row_count FROM contacts WHERE age >= 18""",
)
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """SELECT 'all' AS version, count(*) AS row_count FROM {contacts} UNION ALL
           SELECT 'adults' AS version, count(*) AS row_count FROM {contacts} WHERE age >= 18""",
        contacts=contacts(spark, sf),
    )


@query("distinct_rows", with_sql(CONTACTS) + "SELECT DISTINCT job, housing, loan, y FROM contacts")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf).select("job", "housing", "loan", "y").distinct()
