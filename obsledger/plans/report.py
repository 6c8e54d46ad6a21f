"""From stored metric rows and findings to the comparison report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.operators import catalogue, insight


def summarise(regression: Mapping[str, DataFrame], classification: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Canonical rows of all models, the summary per type, the ranking, the best classifier, the chart rows."""
    by = ("type", "run_id", "model_name")
    reg = catalogue.canonical_metrics(
        catalogue.combine_metrics(regression, "regression"), catalogue.REGRESSION_METRICS, by)
    cls = catalogue.canonical_metrics(
        catalogue.combine_metrics(classification, "classification"), catalogue.CLASSIFICATION_METRICS, by)
    rows = reg.unionByName(cls)
    return {
        "metrics": rows,
        "summary": catalogue.performance_summary(rows),
        "ranking": catalogue.rank_models(reg),
        "best_classifier": catalogue.best_classifier(cls),
        "series": catalogue.comparison_series(reg),
    }


def report(summary: Mapping[str, DataFrame], findings: Mapping[str, DataFrame]) -> DataFrame:
    """(section, line) rows from a summary and the findings of the unsupervised jobs."""
    return insight.comparison_report(summary["ranking"], summary["best_classifier"],
                                     findings["kmeans_insights"], findings["isolation_insights"])


def as_document(lines: DataFrame) -> DataFrame:
    """One JSON document per section (a handful of lines each)."""
    listed = lines.groupBy("section").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return listed.select("section", F.to_json(F.struct("section", "lines")).alias("document"))
