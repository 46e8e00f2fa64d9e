"""tillroll: retail transaction analytics expressed as Spark DataFrame plans.

Stages (each a ``DataFrame -> DataFrame`` function, lazily composed):

    sources.tables.transactions      canonical fact rows
    operators.cleaning               de-dup, null/invalid filters, audit
    operators.features               per-customer RFM feature vector
    operators.segments               k-means segmentation + business labels
    operators.churn                  churn label, forest, risk bands, metrics
    operators.forecast               dense daily series, Holt-Winters, ridge
    operators.kpi / campaigns        KPI document, report and campaign text
    operators.marts                  dashboard measures as tables
"""

__version__ = "0.1.0"
