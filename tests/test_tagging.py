import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docwatch.functions import terms
from docwatch.functions.text import leet_form, match_form
from docwatch.operators import tagging
from docwatch.sources.config import Dictionary

ITEM = "id string, title string, text string"


def python_hit(text, term):
    """The matching rule on normalised strings."""
    if any(c in term for c in " -/._") or len(term) >= 6:
        return term in text
    return re.search(rf"\b{re.escape(term)}\b", text) is not None


CASES = [
    ("class focus", "ss"), ("the ss files", "ss"), ("a C2 server", "C2"), ("c25", "C2"),
    ("see cve-2024-1", "CVE-"), ("am 14/88 x", "14/88"), ("x@y", "@"), (" @ ", "@"), ("@x", "@"),
    ("c++ code", "c++"), ("c++x", "c++"), ("#tag x", "#tag"), ("a#tag", "#tag"), ("нато и", "НАТО"),
    ("натовский", "НАТО"), ("Großer AUSTAUSCH", "grosser austausch"), ("ＭＩＴ license", "mit"),
    ("commit", "mit"), ("snake_mit", "mit"), ("mit_x", "mit"), ("licensed", "License"), ("a—b", "a-b"),
    ("it’s", "it's"), ("e\u0301a", "éa"), ("x.y", "x.y"), ("xzy", "x.y"), ("a+b", "+"), ("1+1", "+"),
]


def test_hit_rule(spark):
    rows = spark.createDataFrame([(str(i), "", t) for i, (t, _) in enumerate(CASES)], ITEM)
    texts = tagging.with_match_texts(rows)
    columns = [tagging.term_hit(F.col("match_text"), match_form(k)).alias(f"h{i}") for i, (_, k) in enumerate(CASES)]
    got = {r.id: r for r in texts.select("id", *columns).collect()}
    for i, (text, term) in enumerate(CASES):
        assert got[str(i)][f"h{i}"] == python_hit(match_form(text), match_form(term)), (text, term)


BOOK = Dictionary.from_lists(
    ["b", "a", "vec"],
    {
        "keyword": {"a": ["token", "Secret", " secret ", "x1"], "b": ["mit", "token"]},
        "negative": {"a": ["giveaway"], "vec": ["giveaway"]},
        "exclude": {"b": ["skip this"]},
    },
)


def tag(spark, rows, **kw):
    out = tagging.tag_hybrid(spark.createDataFrame(rows, ITEM), BOOK, **kw)
    return {r.id: (r.topics, r.keywords) for r in out.collect()}


def test_keywords_negatives_excludes(spark):
    got = tag(
        spark,
        [
            ("1", "Token", "a secret"),
            ("2", "t0ken", ""),
            ("3", "token g1ve@way", ""),
            ("4", "mit token", "Skip THIS"),
            ("5", None, None),
            ("6", "mit x1 secretive", ""),
        ],
    )
    assert got["1"] == (["a", "b"], ["token", "Secret", "secret"])  # spellings differ
    assert got["2"] == ([], [])  # digit spellings never tag
    assert got["3"] == (["b"], ["token"])  # terms stay when the topic is dropped
    assert got["4"] == (["a"], ["token"])
    assert got["5"] == ([], [])
    assert got["6"] == (["a", "b"], ["Secret", "secret", "x1", "mit"])


def test_leet_terms_are_read_alike(spark):
    # term and text get the same leet form, so a term with digits is found again
    got = tag(spark, [("1", "token x1", "")])
    assert got["1"][1] == ["token", "x1"]


def test_vectors_add_and_rescue(spark):
    items = [("1", "plain", ""), ("2", "token giveaway", ""), ("3", "giveaway", ""), ("4", "", "")]
    vectors = spark.createDataFrame(
        [("1", [0.45, 0.0]), ("2", [1.0, 0.0]), ("3", [0.45, 0.0]), ("4", [1.0, 0.0])], "id string, vec array<float>"
    )
    anchors = spark.createDataFrame(
        [("vec", 0, [1.0, 0.0]), ("a", 0, [0.5, 0.0]), ("a", 1, [0.0, 1.0]), ("other", 0, [1.0, 0.0])],
        "topic string, ord int, vec array<float>",
    )
    got = tag(spark, items, vectors=vectors, anchors=anchors)
    assert got["1"][0] == ["vec"]  # unknown topics never appear
    assert got["2"][0] == ["a", "b", "vec"]  # strong scores outweigh the negative
    assert got["3"][0] == []  # 0.45 is near but not strong
    assert got["4"][0] == []  # no text, no topics
    keywords_only = tag(spark, items, vectors=vectors, anchors=anchors, method="keywords")
    assert keywords_only["1"][0] == [] and keywords_only["2"][0] == ["b"]
    assert tag(spark, items, vectors=vectors, anchors=anchors, method="embedding") == got
    with pytest.raises(ValueError):
        tag(spark, items, method="other")


def test_min_hits(spark):
    rows = spark.createDataFrame([("1", "token", ""), ("2", "token secret", "")], ITEM)
    got = {r.id: r.topics for r in tagging.tag_keywords(rows, BOOK, min_hits=2).collect()}
    assert got == {"1": [], "2": ["a"]}


def test_large_dictionary_gives_the_same(spark, monkeypatch):
    rows = [("1", "Token", "a secret mit"), ("2", "committed x1", ""), ("3", "mit", "token skip this giveaway")]
    small = tag(spark, rows)
    monkeypatch.setattr(tagging, "INLINE_TERMS", 0)
    assert tag(spark, rows) == small


def test_scores_without_anchors(spark):
    vectors = spark.createDataFrame([("1", [1.0])], "id string, vec array<float>")
    none = spark.createDataFrame([], "topic string, ord int, vec array<float>")
    assert tagging.anchor_scores(vectors, none).count() == 0
    assert tagging.near_topics(vectors, none).count() == 0


def test_repeated_vectors_give_one_row(spark):
    items = spark.createDataFrame([("1", "none", "of the terms")], ITEM)
    vectors = spark.createDataFrame([("1", [1.0, 0.0]), ("1", [0.0, 1.0]), ("1", [1.0, 0.0])], "id string, vec array<float>")
    anchors = spark.createDataFrame([("a", 0, [1.0, 0.0]), ("b", 0, [0.0, 1.0])], "topic string, ord int, vec array<float>")
    rows = tagging.tag_hybrid(items, BOOK, vectors, anchors).collect()
    assert [(r.id, r.topics) for r in rows] == [("1", ["a", "b"])]


def test_dictionary_needs_topics():
    with pytest.raises(ValueError):
        Dictionary.from_lists([" ", ""], {})


def test_tagging_needs_no_shuffle(spark):
    rows = spark.createDataFrame([("1", "Token", "a secret")], ITEM)
    plan = tagging.tag_hybrid(rows, BOOK)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") <= 1


def python_tags(book, match, leet, min_hits=1):
    topics, excluded, negatives, keywords = [], [], [], []
    for t in book.topics:
        out = any(f in match for f in t.exclude_forms())
        hit = sum(python_hit(match, f) for f in t.keyword_forms()) >= min_hits and t.keyword_forms() and not out
        excluded += [t.topic] * out
        topics += [t.topic] * bool(hit)
        negatives += [t.topic] * any(f in leet for f in t.negative_forms())
        keywords += [k for k in t.keywords if hit and leet_form(k) and leet_form(k) in leet]
    return {"topics": topics, "excluded": excluded, "keywords": list(dict.fromkeys(keywords)), "negatives": negatives}


def matcher_of(book, min_hits=1):
    packed = []
    for t in book.topics:
        forms = t.keyword_forms()
        spelled = tuple((f, k) for f, k in ((leet_form(k), k) for k in t.keywords) if f)
        bounded = tuple(not tagging.is_substring_term(f) for f in forms)
        packed.append(terms.TopicForms(t.topic, forms, bounded, t.exclude_forms(), t.negative_forms(), spelled))
    return terms.Matcher(packed, min_hits)


WORDS = st.text(alphabet="ab1_- é漢+.x", min_size=1, max_size=7).filter(str.strip)


@settings(max_examples=200, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=8), st.lists(WORDS, max_size=4), st.lists(WORDS, max_size=3), st.text(alphabet="ab1_- é漢+.x", max_size=60), st.integers(1, 3))
def test_automaton_follows_the_rule(keywords, more, others, text, min_hits):
    lists = {"keyword": {"a": keywords, "b": more}, "exclude": {"b": others[:1]}, "negative": {"a": others, "b": keywords[:1]}}
    book = Dictionary.from_lists(["a", "b", "c"], lists)
    match, leet = match_form(text), leet_form(text)
    assert matcher_of(book, min_hits).tags(match, leet) == python_tags(book, match, leet, min_hits)


def test_word_borders_equal_the_column_rule(spark, monkeypatch):
    book = Dictionary.from_lists(["t"], {"keyword": {"t": [k for _, k in CASES]}})
    rows = spark.createDataFrame([(str(i), "", t) for i, (t, _) in enumerate(CASES)], ITEM)
    small = sorted(map(str, tagging.text_evidence(rows, book).collect()))
    monkeypatch.setattr(tagging, "INLINE_TERMS", 0)
    assert sorted(map(str, tagging.text_evidence(rows, book).collect())) == small
    for fn in (tagging.tag_keywords, tagging.exclude_topics):
        assert fn(rows, book).count() == len(CASES)


def many_terms(n):
    return Dictionary.from_lists(["t", "u"], {"keyword": {"t": [f"term{i}x" for i in range(n)], "u": [f"q{i}" for i in range(n // 10)]}, "negative": {"u": ["term7x"]}})


def test_two_hundred_thousand_terms(spark):
    rows = spark.createDataFrame([("1", "", "a term199999x and term7x, q5"), ("2", "", "nothing q 5")] * 50, ITEM)
    table = spark.createDataFrame(
        [("t", "keyword", i, f"term{i}x") for i in range(200_000)] + [("u", "keyword", 1, "q5")], "topic string, kind string, ord int, term string"
    )
    book = Dictionary.from_table(["t", "u"], table)
    assert book.size == 200_001
    found = tagging.text_evidence(rows, book)
    got = {r.id: (r.topics, r.keywords) for r in found.collect()}
    assert got == {"1": (["t", "u"], ["term7x", "term199999x", "q5"]), "2": ([], [])}
    few = tagging.text_evidence(rows, many_terms(100))
    size = lambda frame: len(frame._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(found) - size(few)) < 50


def test_cost_of_a_text_does_not_follow_topics_it_lacks():
    """All topics share the words, and all but one are excluded."""
    words = [f"shared{i}" for i in range(500)]
    text = " ".join(words) + " unwanted"
    leet = leet_form(text)

    def best(topics):
        names = [f"t{i:03}" for i in range(topics)]
        book = Dictionary.from_lists(names, {"keyword": dict.fromkeys(names, words), "exclude": dict.fromkeys(names[1:], ["unwanted"])})
        matcher = matcher_of(book)
        assert matcher.tags(text, leet) == {"topics": ["t000"], "excluded": names[1:], "keywords": words, "negatives": []}
        spent = []
        for _ in range(5):
            start = time.perf_counter()
            matcher.tags(text, leet)
            spent.append(time.perf_counter() - start)
        return min(spent)

    assert best(400) < 5 * best(2)


def test_cost_of_a_text_does_not_follow_the_dictionary():
    text = " ".join(f"word{i} some more text" for i in range(20_000))

    def cost(book):
        matcher = matcher_of(book)
        best = 1e9
        for _ in range(5):
            start = time.perf_counter()
            matcher.tags(text, text)
            best = min(best, time.perf_counter() - start)
        return best

    assert cost(many_terms(100_000)) < 5 * cost(many_terms(1_000))
