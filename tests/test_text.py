import html
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docwatch.functions import text as tx

def python_clean(s):
    s = re.sub(r"\s+", " ", html.unescape(s)).strip()
    return re.sub("[\u200b-\u200f\ufeff]", "", s)


def python_leet(s):
    return tx.leet_form(s)


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Großer Austausch", "grosser austausch"),
        ("GROẞER AUSTAUSCH", "grosser austausch"),
        ("ﬁne ＦＵＬＬ", "fine full"),
        ("a—b–c ‘d’ “e”", "a-b-c 'd' \"e\""),
        ("  Ünïcode \u00a0", "ünïcode"),
        ("НАТО", "нато"),
        (None, ""),
    ],
)
def test_match_form(one, raw, expected):
    assert one(tx.normalize_for_match, x=raw) == expected
    if raw:
        assert tx.match_form(raw) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("1488", "ia88"), ("T0ken  =\n x", "token = x"), ("P@$$w0rd", "password"), ("ﬁ", "fi")],
)
def test_leet_form(one, raw, expected):
    assert one(tx.normalize_leet, x=raw) == expected
    assert tx.leet_form(raw) == expected


ALPHABET = st.text(
    alphabet="aB9 @$\t\n\u00a0\u2003\u200b\ufeffßẞÄéñ½ﬁΣσςİıЖё—–’“x&;ltgamp#38\u0301\x1f\x85", max_size=40
)


def test_normal_forms_equal_python(spark):
    """Batches of odd strings against the plain Python rules."""

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(ALPHABET, min_size=40, max_size=40))
    def check(texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        got = rows.select(
            "x",
            tx.normalize_for_match(F.col("x")).alias("match"),
            tx.normalize_leet(F.col("x")).alias("leet"),
            tx.clean_text(F.col("x")).alias("clean"),
        ).collect()
        for row in got:
            folded = unicodedata.normalize("NFKC", row.x).casefold()
            assert row.match == folded.translate(str.maketrans(tx.QUOTES_FROM, tx.QUOTES_TO)).strip()
            assert row.leet == python_leet(row.x)
            assert row.clean == python_clean(row.x)

    check()


def test_fast_class_is_right():
    """Every character outside NEEDS_FOLDING folds by lower() and ß -> ss."""
    spelled = re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", tx.NEEDS_FOLDING)
    needs = re.compile(spelled)
    for code in range(0x20, 0x3000):
        ch = chr(code)
        if not needs.search(ch):
            assert unicodedata.normalize("NFKC", ch) == ch
            assert ch.casefold() == ch.lower().replace("ß", "ss")


def test_clean_text_order(one):
    assert one(tx.clean_text, x="a&nbsp;&amp;\u200b  b\ufeff ") == "a & b"
    assert one(tx.clean_text, x=None) == ""


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<p>short</p>", None),
        ("just plain text of enough length &amp; more", "just plain text of enough length & more"),
        (
            "<nav>menu</nav><article><p>First &lt;part&gt;.</p><p>Second</p></article><footer>f</footer>",
            "First <part>.\nSecond",
        ),
        ("<div><script>var a = 1;</script>Only  this\ttext stays</div>", "Only this text stays"),
        ("<nav>everything is in the menu here</nav>", "everything is in the menu here"),
        ("<p><b></b></p><p><i></i></p><p></p>   ", None),
    ],
)
def test_html_to_text(spark, source, expected):
    rows = spark.createDataFrame([(source,)], "x string")
    assert tx.with_html_text(rows, F.col("x"), "t").first().t == expected


def test_text_lines_follow_python(one):
    raw = " a \r\n\n b\u2028c\x0bd\x85"
    assert one(tx.text_lines, x=raw) == [l.strip() for l in raw.splitlines() if l.strip()]
