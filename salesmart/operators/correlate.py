"""One-hot Pearson correlation of a measure with a categorical dimension.

The reference one-hot encodes (measure, dimension) and takes the dense
Pearson matrix. For indicator columns the matrix follows from a handful of
sufficient statistics, so no one-hot rows are ever materialised:

* per dimension value v: n_v (rows), m_v (rows with a measure), S_v (sum);
* over all rows: N, m, S, and the population variance of the measure.

corr(y, I_v)  = (mean_v - mean) * sqrt(p_v / (1 - p_v)) / sd_y,  p_v = m_v / m
corr(I_v, I_w) = -sqrt(q_v q_w / ((1 - q_v)(1 - q_w))),          q_v = n_v / N
diagonal       = 1 when the column varies, else NULL.

Pairs involving the measure use only rows where it is present (pairwise
complete, like pandas); a NULL dimension value is an all-zero indicator row.
One scan and one group-by per dimension: the groups become one row that holds
the k+1 features, and its cells are exploded from it, so the facts are never
read again. The matrix has (k+1)^2 rows by definition; more than ``max_values``
distinct values are an error, never a cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numeric import money, round4


MAX_VALUES = 1000


def group_moments(df: DataFrame, dim: str, measure: str = "sales") -> DataFrame:
    """v, n_v, m_v, s_v, q_v per value of ``dim`` (exact decimal sums, combined map-side)."""
    y = money(F.col(measure).cast("double"))
    return df.groupBy(F.col(dim).alias("v")).agg(
        F.count(F.lit(1)).alias("n_v"), F.count(measure).alias("m_v"),
        F.sum(y).alias("s_v"), F.sum(y * y).alias("q_v"))


def _features(groups: DataFrame, dim: str, measure: str, max_values: int) -> DataFrame:
    """One row: mean, sd and ``features``, the measure (pos 0) and one indicator per value."""
    # At most max_values + 2 groups (one may be the NULL value) meet in this task.
    row = groups.limit(max_values + 2).agg(
        F.sum("n_v").alias("N"), F.sum("m_v").alias("m"), F.sum("s_v").alias("S"), F.sum("q_v").alias("Q"),
        F.array_sort(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("v", "n_v", "m_v", "s_v")))).alias("g"))
    mean = F.col("S").cast("double") / F.col("m")
    var = F.col("Q").cast("double") / F.col("m") - mean * mean
    none = F.lit(None).cast("double")
    head = F.struct(F.lit(measure).alias("feature"), F.lit(0).cast("bigint").alias("pos"),
                    F.lit(True).alias("is_measure"), none.alias("q"), none.alias("p"), none.alias("mean_v"))
    values = F.transform("g", lambda x, i: F.struct(
        F.concat(F.lit(f"{dim}_"), x["v"].cast("string")).alias("feature"),
        (i + 1).cast("bigint").alias("pos"), F.lit(False).alias("is_measure"),
        (x["n_v"] / F.col("N")).alias("q"), (x["m_v"] / F.col("m")).alias("p"),
        (x["s_v"].cast("double") / x["m_v"]).alias("mean_v")))
    features = F.when(F.size("g") > max_values, F.raise_error(F.lit(
        f"more than {max_values} values of {dim}: pass max_values"))).otherwise(F.concat(F.array(head), values))
    return row.select(mean.alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("sd"), features.alias("features"))


def _pair_r(a: str, b: str):
    def c(side, name):
        return F.col(f"{side}_{name}")

    def measure_vs(ind):
        p = c(ind, "p")
        ok = (c(ind, "sd") > 0) & (p > 0) & (p < 1)
        return F.when(ok, (c(ind, "mean_v") - c(ind, "mean")) * F.sqrt(p / (F.lit(1.0) - p))
                      / c(ind, "sd"))

    qa, qb = c(a, "q"), c(b, "q")
    varies_a = (qa > 0) & (qa < 1)
    varies_b = (qb > 0) & (qb < 1)
    same = c(a, "pos") == c(b, "pos")
    both_measure = c(a, "is_measure") & c(b, "is_measure")
    return (F.when(both_measure, F.when(c(a, "sd") > 0, F.lit(1.0)))
             .when(c(a, "is_measure"), measure_vs(b))
             .when(c(b, "is_measure"), measure_vs(a))
             .when(same, F.when(varies_a, F.lit(1.0)))
             .when(varies_a & varies_b,
                   -F.sqrt(qa * qb / ((F.lit(1.0) - qa) * (F.lit(1.0) - qb)))))


def corr_matrix(groups: DataFrame, dim: str, measure: str = "sales", max_values: int = MAX_VALUES) -> DataFrame:
    """C2+C3 from ``group_moments`` rows: long-form matrix with its masked upper triangle.

    Columns: feature_x, feature_y, pos_x, pos_y, r, r_upper (r above the
    diagonal, 0.0 on and below it - the heat-map mask of the reference).
    """
    row = _features(groups, dim, measure, max_values)
    pairs = row.select("mean", "sd", "features", F.explode("features").alias("x")).select(
        "mean", "sd", "x", F.explode("features").alias("y"))
    names = ("feature", "pos", "is_measure", "q", "p", "mean_v")
    pairs = pairs.select(*[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "xy" for c in names],
                         *[F.col(c).alias(f"{side}_{c}") for side in "xy" for c in ("mean", "sd")])
    r = round4(_pair_r("x", "y"))
    return pairs.select(
        F.col("x_feature").alias("feature_x"), F.col("y_feature").alias("feature_y"),
        F.col("x_pos").alias("pos_x"), F.col("y_pos").alias("pos_y"), r.alias("r"),
        F.when(F.col("x_pos") < F.col("y_pos"), r).otherwise(F.lit(0.0)).alias("r_upper"))


def one_hot_corr(df: DataFrame, dim: str, measure: str = "sales", max_values: int = MAX_VALUES) -> DataFrame:
    """C1+C2+C3 on a flat frame."""
    return corr_matrix(group_moments(df, dim, measure), dim, measure, max_values)


def one_hot(df: DataFrame, dim: str, values: list[str]) -> DataFrame:
    """``df`` with ``dim`` replaced by one 0/1 column ``<dim>_<value>`` per value; NULL is 0 in all.

    The values are given, so no job runs to find them; a value not listed is an error, never a row of zeros.
    """
    listed = F.col(dim).isNull() | F.col(dim).isin(values)
    bad = F.raise_error(F.concat(F.lit(f"value of {dim} that is not listed: "), F.col(dim).cast("string"))).cast("int")
    return df.select(*[F.col(c) for c in df.columns if c != dim], *[
        F.when(listed, F.coalesce(F.col(dim) == v, F.lit(False)).cast("int")).otherwise(bad).alias(f"{dim}_{v}")
        for v in values])
