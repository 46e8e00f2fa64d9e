"""End-to-end run (the reference's main flow), Spark-first.

    python -m tillroll.plans.end_to_end --sf /root/testdata/sf0.01 --out /path/to/output

Stages: dirty fixture -> clean -> customer features -> k-means segments ->
churn forest -> Holt-Winters forecast -> KPI document, report, campaigns ->
BI export.  Every stage output is written once and later stages read the
written tables, which also cuts lineage.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.operators import campaigns, churn, cleaning, features, forecast, kpi, marts, scoring
from tillroll.operators import segments as seg
from tillroll.sources import sinks
from tillroll.sources.csv_io import write_csv
from tillroll.sources.tables import dirty_transactions


def run(spark: SparkSession, sf_dir: str, out: str) -> dict[str, str]:
    out = out.rstrip("/")
    paths = {k: f"{out}/{k}" for k in (
        "cleaned_transactions", "customer_features", "customer_segments", "churn_predictions",
        "churn_action_list", "forecasts", "executive_summary_json", "executive_summary_md",
        "campaigns", "models/kmeans", "models/forest", "bi_export")}

    cleaned = cleaning.clean(dirty_transactions(spark, sf_dir))
    sinks.write_transactions(cleaned, paths["cleaned_transactions"])
    tx = spark.read.parquet(paths["cleaned_transactions"]).drop("TxMonth")

    sinks.write_table(features.customer_features(tx, as_text=False), paths["customer_features"])
    feats = spark.read.parquet(paths["customer_features"])

    km = seg.fit_kmeans(feats)
    scoring.save(km, paths["models/kmeans"])
    sinks.write_table(seg.kmeans_segments(feats, model=km), paths["customer_segments"])
    segments = spark.read.parquet(paths["customer_segments"])

    split = churn.with_split(churn.label(feats))
    rf = churn.fit_forest(split)
    scoring.save(scoring.forest_chain(rf), paths["models/forest"])
    sinks.write_table(churn.predictions_table(churn.forest_scores(split, rf)), paths["churn_predictions"])
    preds = spark.read.parquet(paths["churn_predictions"])
    write_csv(churn.high_risk_list(preds), paths["churn_action_list"])

    fc = forecast.holt_winters_forecast(tx)
    sinks.write_table(fc["table"], paths["forecasts"])
    table = spark.read.parquet(paths["forecasts"])
    summary = forecast.forecast_summary(table.withColumn("_series", F.lit(0)), ["_series"]).drop("_series")

    payload = kpi.payload(tx, segments, preds, summary)
    sinks.write_json_lines(kpi.payload_json(payload), paths["executive_summary_json"])
    kpi.report(payload).coalesce(1).write.mode("overwrite").text(paths["executive_summary_md"])

    copy = campaigns.copy(campaigns.inputs(segments, preds))
    sinks.write_texts(copy, paths["campaigns"], "Slug", "Text")

    sinks.export_marts({"customer_segments": segments, "churn_predictions": preds,
                        "forecasts": table,
                        "monthly_year": marts.monthly_year(tx),
                        "segment_breakdown": seg.segment_breakdown(segments)}, paths["bi_export"])
    return paths


def main(argv=None) -> None:
    from tillroll.session import build_session
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default="local[8]")
    args = ap.parse_args(argv)
    spark = build_session(args.master, shuffle_partitions=8)
    for name, path in run(spark, args.sf, args.out).items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
