"""Queries: imputation, scaling, one-hot encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwarden.catalog import frames as fr
from tabwarden.functions import sizing
from tabwarden.operators import clean, encode


def _training_part(df):
    """Encoders are fitted on part of the customers, so later ones bring unknown categories."""
    return df.where(F.col("n_name") < "NATION_5")


def feature_groups(spark, d):
    frame = fr.churn(spark, d)
    numeric, categorical = clean.feature_groups(clean.feature_frame(frame, fr.LABEL), both=True)
    cells = [
        F.struct(F.lit(c).alias("feature"), F.lit(kind).alias("kind"), F.col(c).alias("present"))
        for kind, names in (("numerical", numeric), ("categorical", categorical))
        for c in names
    ]
    return frame.agg(*[F.count(c).alias(c) for c in (*numeric, *categorical)]).select(F.inline(F.array(*cells)))


def impute_median(spark, d):
    frame = fr.churn(spark, d)
    fits = encode.fit_numeric(frame, ["c_acctbal"])
    return frame.select(fr.KEY, F.round(encode.imputed("c_acctbal", fits["c_acctbal"]), 4).alias("c_acctbal"))


def impute_scale(spark, d):
    frame = sizing.cut_lineage(fr.churn(spark, d).select(fr.KEY, *fr.NUMERIC), "churn")
    fits = encode.fit_numeric(frame, fr.NUMERIC)
    scaled = encode.impute_and_scale(frame, fr.NUMERIC, fits)
    return scaled.withColumns({c: F.round(c, 6) for c in fr.NUMERIC})


def _one_hot(spark, d, drop_first):
    frame = fr.churn(spark, d)
    categories = encode.fit_categories(_training_part(frame), fr.CATEGORICAL)
    return encode.one_hot_rows(frame, [fr.KEY], fr.CATEGORICAL, categories, drop_first)


def one_hot_linear(spark, d):
    return _one_hot(spark, d, True)


def one_hot_tree(spark, d):
    return _one_hot(spark, d, False)


def one_hot_null_and_nan(spark, d):
    """A missing segment and the text ``nan`` are two categories with an output each."""
    k, segment = F.col("c_custkey"), F.col("c_mktsegment")
    frame = fr.table(spark, d, "customer").select("c_custkey", F.when(k % 5 == 1, "nan").when(k % 5 > 1, segment).alias("segment"))
    return encode.one_hot_rows(frame, ["c_custkey"], ["segment"], encode.fit_categories(frame, ["segment"]), False)


def encoder_metadata(spark, d):
    return encode.cardinality(encode.fit_categories(fr.churn(spark, d), fr.CATEGORICAL))


def encoder_outputs(spark, d):
    categories = encode.fit_categories(fr.churn(spark, d), fr.CATEGORICAL)
    return encode.output_names(fr.NUMERIC, categories, drop_first=True)


QUERIES = {
    f.__name__: f
    for f in (feature_groups, impute_median, impute_scale, one_hot_linear, one_hot_tree, one_hot_null_and_nan, encoder_metadata, encoder_outputs)
}

_LONG = fr.CHURN_SQL + """, long AS (
    SELECT c_custkey, n_name, 'c_mktsegment' AS feature, c_mktsegment AS category FROM churn
    UNION ALL SELECT c_custkey, n_name, 'n_name', n_name FROM churn
    UNION ALL SELECT c_custkey, n_name, 'last_priority', last_priority FROM churn),
  cats AS (SELECT DISTINCT feature, category FROM long{where}),
  kept AS (SELECT * FROM cats WHERE (feature, category) NOT IN (SELECT (feature, min(category)) FROM cats GROUP BY feature))"""
_CATS = _LONG.replace("{where}", " WHERE n_name < 'NATION_5'")
_ALL_CATS = _LONG.replace("{where}", "")


def _scale(c):
    return f"round((coalesce({c}, m_{c}) - (SELECT avg(coalesce({c}, m_{c})) FROM churn, med)) / (SELECT stddev_pop(coalesce({c}, m_{c})) FROM churn, med), 6) AS {c}"


_MED = "med AS (SELECT " + ", ".join(f"quantile_cont({c}::DOUBLE, 0.5) AS m_{c}" for c in fr.NUMERIC) + " FROM churn)"

ORACLES = {
    "feature_groups": f"WITH {fr.CHURN_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{k}' AS kind, count({c}) AS present FROM churn"
        for k, cs in (("numerical", [fr.KEY, *fr.NUMERIC]), ("categorical", fr.CATEGORICAL))
        for c in cs
    ),
    "impute_median": f"""WITH {fr.CHURN_SQL} SELECT c_custkey,
        round(coalesce(c_acctbal, (SELECT quantile_cont(c_acctbal, 0.5) FROM churn)), 4) AS c_acctbal FROM churn""",
    "impute_scale": f"WITH {fr.CHURN_SQL}, {_MED} SELECT c_custkey, {', '.join(_scale(c) for c in fr.NUMERIC)} FROM churn, med",
    "one_hot_linear": f"WITH {_CATS} SELECT c_custkey, feature || '_' || category AS output, 1.0::DOUBLE AS value FROM long JOIN kept USING (feature, category)",
    "one_hot_tree": f"WITH {_CATS} SELECT c_custkey, feature || '_' || category AS output, 1.0::DOUBLE AS value FROM long JOIN cats USING (feature, category)",
    "one_hot_null_and_nan": """SELECT c_custkey, 'segment_' || CASE c_custkey % 5 WHEN 0 THEN 'nan' WHEN 1 THEN '''nan''' ELSE c_mktsegment END AS output,
        1.0::DOUBLE AS value FROM customer""",
    "encoder_metadata": f"WITH {_ALL_CATS} SELECT feature, count(*) AS categories, count(*) - 1 AS linear_outputs, count(*) AS tree_outputs FROM cats GROUP BY feature",
    "encoder_outputs": f"WITH {_ALL_CATS} SELECT 1 AS block, feature, feature || '_' || category AS output FROM kept UNION ALL "
    + " UNION ALL ".join(f"SELECT 0, '{c}', '{c}' FROM (SELECT count(*) FROM churn)" for c in fr.NUMERIC),
}
