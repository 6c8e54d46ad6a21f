"""Readable findings from clustered, flagged and projected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsledger.operators.aggregate import contrast, group_share, rate_by_cluster
from obsledger.operators.reshape import align
from obsledger.operators.stats import scalar_row
from obsledger.operators.timeline import top_k


def cluster_insights(df: DataFrame, cluster: str, cols: Sequence[str], k: int = 3) -> DataFrame:
    """Per cluster: size, share, and its k features furthest from the global mean.

    One pass gives sums per cluster; global means come from the same sums, so
    the data is read once.
    """
    sums = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"),
        *[F.struct(F.sum(c).alias("s"), F.count(c).alias("n")).alias(c) for c in cols])
    every = W.partitionBy()  # one row per cluster
    whole = {c: F.try_divide(F.sum(F.col(c)["s"]).over(every), F.sum(F.col(c)["n"]).over(every)) for c in cols}
    sums = sums.withColumns({**{f"_{c}": v for c, v in whole.items()}, "_size": F.sum("size").over(every)})
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.try_divide(F.col(c)["s"], F.col(c)["n"]).alias("cluster_mean"),
                 F.col(f"_{c}").alias("global_mean")) for c in cols]))
    tall = (sums.select(cluster, "size", (F.col("size") * 100.0 / F.col("_size")).alias("percentage"), rows.alias("r"))
                .select(cluster, "size", "percentage", "r.*")
                .withColumn("difference", F.col("cluster_mean") - F.col("global_mean")))
    return (top_k(tall, [cluster], "feature", "difference", k)
            .withColumn("direction", F.when(F.col("difference") > 0, "alto").otherwise("bajo"))
            .withColumn("deviation_pct", F.try_divide(F.abs("difference"), F.abs("global_mean")) * 100))


def contrast_insights(df: DataFrame, flag: str, cols: Sequence[str], k: int = 3) -> DataFrame:
    """Flagged rows: count, share and the k features that differ most from the other rows."""
    totals = scalar_row(df.agg(F.count_if(F.col(flag) == 1).alias("n"), F.count(F.lit(1)).alias("t")))
    ranked = top_k(contrast(df, flag, cols).withColumn("all", F.lit(1)), ["all"], "feature", "difference", k)
    return ranked.drop("all").select("*", totals["n"].alias("n_flagged"),
                                     (totals["n"] * 100.0 / totals["t"]).alias("flagged_pct"))


def density_insights(df: DataFrame, cluster: str, cols: Sequence[str], k: int = 3):
    """(contrast of noise against clustered rows, sizes of the clusters) for density clusters, noise = -1."""
    noise = df.withColumn("_noise", (F.col(cluster) == -1).cast("int"))
    return (contrast_insights(noise, "_noise", cols, k),
            group_share(df, cluster).where(F.col(cluster) != -1))


def loading_insights(loadings: DataFrame, variance: DataFrame, components: Sequence[str] = ("PC1", "PC2"),
                     k: int = 3) -> DataFrame:
    """The k largest absolute loadings of the first components, their sign and explained share."""
    top = top_k(loadings.where(F.col("component").isin(*components)), ["component"], "feature", "loading", k)
    return (top.join(variance.select("component", "explained_ratio"), "component")
               .withColumn("sign", F.when(F.col("loading") > 0, "positivo").otherwise("negativo")))


def cross_insights(clusters: DataFrame, flags: DataFrame, key: Sequence[str], cluster: str, flag: str) -> DataFrame:
    """Flag rate per cluster after putting both results on the row key, marking clusters above the mean rate."""
    return rate_by_cluster(align(clusters.select(*key, cluster), flags.select(*key, flag), key), cluster, flag)


def comparison_report(ranked: DataFrame, classifier: DataFrame, clusters: DataFrame, flagged: DataFrame,
                      cluster: str = "cluster") -> DataFrame:
    """(section, line) rows: best models, one sentence per cluster, one for the anomalies."""
    best = ranked.where("rank = 1").select(
        F.lit("mejor_modelo_regresion").alias("section"),
        F.format_string("Mejor regresión: %s explica %.2f%% de la varianza (%s)",
                        "model_name", "explained_pct", "grade").alias("line"))
    cls = classifier.select(
        F.lit("clasificacion").alias("section"),
        F.format_string("Mejor clasificador: %s, calidad %s, aciertos %.1f%% (%s)",
                        "model_name", "grade", F.col("accuracy") * 100, "balance").alias("line"))
    named = F.format_string("%s %s", "feature", "direction")
    per_cluster = (
        clusters.groupBy(cluster, "percentage")
        .agg(F.array_sort(F.collect_list(F.struct("rank", named.alias("t")))).alias("f"))
        .select(F.lit("patrones_climaticos").alias("section"),
                F.format_string("Grupo %s, %.1f%% de las filas: %s", F.col(cluster).cast("string"), "percentage",
                                F.array_join(F.col("f.t"), ", ")).alias("line")))
    odd = (
        flagged.groupBy("flagged_pct")
        .agg(F.array_sort(F.collect_list(F.struct("rank", named.alias("t")))).alias("f"))
        .select(F.lit("anomalias_climaticas").alias("section"),
                F.format_string("Filas anómalas, %.1f%% del total: %s", "flagged_pct",
                                F.array_join(F.col("f.t"), ", ")).alias("line")))
    return best.unionByName(cls).unionByName(per_cluster).unionByName(odd)
