"""Every operator and stage on awkward and on empty tables."""

import corpus_pipeline
import pytest

from docwatch.llm import (
    exact_dedup,
    maxent_lm,
    minhash,
    mixing,
    packing,
    quality_rules,
    sharding,
    substring_dedup,
    token_counts,
    url_filter,
)
from docwatch.session import fresh_path

SMALL = maxent_lm.Shape(classes=4, lookup=512, clustered=128, endings=16, neighbours=32, buckets=64)

ONE_ROW_EACH = {
    "mixing": mixing.mix,
    "quality": quality_rules.judge,
    "exact": exact_dedup.assign_copies,
    "minhash": lambda docs: minhash.near_groups(docs, minhash.MinHash(width=2)),
    "lm": lambda docs: maxent_lm.score_texts(docs, SMALL),
    "sharding": lambda docs: sharding.shard_documents(docs, 4, 64)[0],
    "passages": substring_dedup.without_passages,
}
OTHERS = {
    "packing": lambda docs: packing.pack(docs, packing.public_encoder()),
    "lines": substring_dedup.repeated_units,
    "strip_lines": quality_rules.strip_lines,
    "remove_repeats": substring_dedup.remove_repeats,
}


@pytest.mark.parametrize("name", sorted(ONE_ROW_EACH))
def test_one_row_per_row(awkward, nothing, name):
    assert ONE_ROW_EACH[name](awkward).count() == awkward.count()
    assert ONE_ROW_EACH[name](nothing).count() == 0


@pytest.mark.parametrize("name", sorted(OTHERS))
def test_no_crash(awkward, nothing, name):
    assert len(OTHERS[name](awkward).collect())
    assert OTHERS[name](nothing).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage(spark, awkward, nothing, name, stage):
    result = stage(spark, awkward, "")
    rows = result.collect()
    if name != "packing":
        assert result.columns == awkward.columns
        texts = {r.text for r in awkward.collect()}
        assert {r.text for r in rows} <= texts
    assert stage(spark, nothing, "").count() == 0


def test_urls(spark):
    rules = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "a.net", "/x")]
    urls = [None, "", "no scheme", "HTTP://A.NET/x/1?q=1#f", "http://b.a.net/y", "ftp://net/", "http://net", "s://" + "9" * 9000]
    frame = spark.createDataFrame([(i, u, 1.0, "k") for i, u in enumerate(urls + urls[:3])], "page_id long, url string, host double, bad string")
    empty_labels = spark.createDataFrame([], "url string, bad int")
    got = {r.page_id: r for r in url_filter.judge_urls(frame, empty_labels, rules).collect()}
    assert len(got) == len(urls) + 3
    assert [got[i].rule for i in range(8)] == [None, None, None, "a.net/x", "net/", "net/", None, None]
    assert [(got[i].host, got[i].path) for i in (0, 2, 3, 6)] == [("", ""), ("", ""), ("a.net", "/x/1"), ("net", "")]
    assert {got[i].verdict for i in (0, 1, 2, 6, 7)} == {"allow"}
    assert url_filter.judge_urls(frame.limit(0), empty_labels, rules).count() == 0


def test_token_counts(spark, awkward, nothing):
    path = fresh_path(spark, "tokens")
    token_counts.commit(token_counts.inserts(awkward, "w"), path, "1")
    token_counts.commit(token_counts.inserts(nothing, "w"), path, "2")
    rows = token_counts.totals(spark, path).collect()
    assert sum(r.docs for r in rows) == awkward.count()
    assert any(r.source is None and r.lang is None for r in rows)
