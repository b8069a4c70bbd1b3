"""The bounded sample that language identification learns from."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cdcmart.llm.langid import _dealt


@pytest.mark.parametrize("one_id", [False, True])
def test_sample_is_the_smallest_deals_of_each_label(spark, one_id):
    rows = [("en" if i % 3 else "de", f"text {i % 40} {'x' * (i % 7)}", 5 if one_id else i) for i in range(400)] + [("fr", "un", 1)]
    labelled = (spark.createDataFrame(rows, "lang string, text string, id long")
                .select("lang", "text", F.xxhash64(F.col("id").cast("string"), F.lit(0)).alias("deal")))
    by = defaultdict(list)
    for r in labelled.collect():
        by[r["lang"]].append((r["deal"], r["text"]))
    got = defaultdict(list)
    for r in _dealt(labelled, {lang: len(held) for lang, held in by.items()}, 10):
        got[r["lang"]].append((r["deal"], r["text"]))
    assert {lang: sorted(v) for lang, v in got.items()} == {lang: sorted(v)[:10] for lang, v in by.items()}
