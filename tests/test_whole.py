"""Queries over whole tables: as many rows as their sources ask for. tests/test_queries.py compares each with its SQL."""

import pytest

from episodica.plans import QUERIES
from episodica.sources.tables import table


@pytest.mark.parametrize("name", ["zscore_normalize", "quantile_normalize", "unnormalize_roundtrip", "clip_scale", "digitize"])
def test_all_dimensions(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() == 64 * table(spark, sf_dir, "embeddings").count()


def test_all_rows(spark, sf_dir):
    count = lambda name: QUERIES[name](spark, sf_dir).count()
    events, docs = table(spark, sf_dir, "events"), table(spark, sf_dir, "documents")
    assert count("jaccard_coverage") == events.select("user_id").distinct().count()
    assert count("global_index_lookup") == 2 * events.count()
    assert count("multiphase_plans") == events.count()
    assert count("normalize_tokens") == docs.count()
    assert count("nearest_object") == table(spark, sf_dir, "supplier").count()
