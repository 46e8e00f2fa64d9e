"""End-to-end run at sf0.001 writes every stage output."""

import os

from tests.conftest import SF001
from tillroll.plans.end_to_end import run


def test_end_to_end_writes_all_outputs(spark, tmp_path):
    paths = run(spark, SF001, str(tmp_path / "out"))
    for name, p in paths.items():
        assert os.path.exists(p), name
    seg = spark.read.parquet(paths["customer_segments"])
    feats = spark.read.parquet(paths["customer_features"])
    assert seg.count() == feats.count()
    assert seg.select("CustomerSegment").distinct().count() == 4
    text = spark.read.text(paths["executive_summary_md"]).collect()
    assert text[0].value == "# Executive Summary & Commercial Strategy Report"
    slugs = {d for d in os.listdir(paths["campaigns"]) if d.startswith("Slug=")}
    assert "Slug=high_value_vips" in slugs
