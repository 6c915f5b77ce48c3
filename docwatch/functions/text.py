"""Text cleaning and normalisation as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwatch.functions.main_text import RAW_ELEMENTS, main_blocks_array
from docwatch.functions.python_text import (
    fold_unicode,
    unescape_html,
    unescape_html_array,
)

# What Python's str.strip() and re \s treat as white space, as a
# plain string (for btrim) and as the inside of a regex class.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WIDE_SPACES = (
    r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
SPACE_CLASS = r"\x{09}-\x{0D}\x{1C}-\x{20}" + WIDE_SPACES
# Runs of white space that aren't a single space already. Java walks a class
# with many ranges slowly, so each branch starts with a test of few ranges.
SPACES_TO_COLLAPSE = (
    rf" (?=[\x{{09}}-\x{{0D}}\x{{1C}}-\x{{20}}\x{{80}}-\x{{FFFF}}])[{SPACE_CLASS}]+"
    rf"|[\x{{09}}-\x{{0D}}\x{{1C}}-\x{{1F}}][{SPACE_CLASS}]*"
    rf"|[\x{{80}}-\x{{FFFF}}](?<=[{WIDE_SPACES}])[{SPACE_CLASS}]*"
)
LINE_BREAK = r"\x{0D}\x{0A}|[\x{0A}-\x{0D}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
ZERO_WIDTH = r"[\x{200B}-\x{200F}\x{FEFF}]"
WORD_CLASS = r"\p{L}\p{N}_"
LEET_FROM = "013457@$"
LEET_TO = "oieastas"
QUOTES_FROM = "—–’‘“”"
QUOTES_TO = "--''\"\""

# Characters outside this class need NFKC or a case rule the JVM's lower() does
# not have. Inside it NFKC changes nothing and casefold is lower() plus ß -> ss.
NEEDS_FOLDING = (
    r"[^\x{00}-\x{7F}](?<![\x{A1}-\x{A7}\x{A9}\x{AB}-\x{AE}\x{B0}\x{B1}\x{B6}\x{B7}\x{BB}"
    r"\x{BF}-\x{FF}\x{0400}-\x{045F}\x{2013}\x{2014}\x{2018}\x{2019}\x{201C}\x{201D}"
    r"\x{2022}\x{20AC}\x{2190}-\x{2193}])"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def unescape(text: Column) -> Column:
    """HTML entities to characters; only rows with an ``&`` reach Python."""
    return F.coalesce(unescape_html(F.when(text.contains("&"), text)), text)


def unescape_array(texts: Column) -> Column:
    has_entity = F.exists(texts, lambda t: t.contains("&"))
    return F.coalesce(unescape_html_array(F.when(has_entity, texts)), texts)


def collapse_spaces(text: Column) -> Column:
    """White space runs to one space, stripped; single spaces aren't touched."""
    return strip(F.regexp_replace(text, SPACES_TO_COLLAPSE, " "))


def drop_zero_width(text: Column) -> Column:
    return F.regexp_replace(text, ZERO_WIDTH, "")


def clean_unescaped(text: Column) -> Column:
    """The part of :func:`clean_text` after the entities; usable in lambdas."""
    return drop_zero_width(collapse_spaces(F.coalesce(text, F.lit(""))))


def clean_text(text: Column) -> Column:
    """Unescape, collapse white space, then delete zero-width characters."""
    return clean_unescaped(unescape(text))


def is_ascii(text: Column) -> Column:
    """As many bytes as characters; cheaper than any look at the characters."""
    return F.octet_length(text) == F.length(text)


def fold_rare(text: Column) -> Column:
    """Folded forms of the rows the JVM can't fold; NULL for all others."""
    return fold_unicode(F.when(~is_ascii(text) & text.rlike(NEEDS_FOLDING), text))


def _each_replaced(text: Column, source: str, target: str) -> Column:
    """translate() by single replacements: a search for a character that isn't
    there costs far less than a walk over all characters."""
    for old, new in zip(source, target):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def match_text(text: Column, folded: Column) -> Column:
    wide = F.coalesce(folded["match"], F.replace(F.lower(text), F.lit("ß"), F.lit("ss")))
    plain = F.when(is_ascii(text), F.lower(text)).otherwise(
        _each_replaced(wide, QUOTES_FROM, QUOTES_TO)
    )
    return strip(F.coalesce(plain, F.lit("")))


def leet_text(text: Column, folded: Column) -> Column:
    plain = F.coalesce(folded["leet"], F.lower(text), F.lit(""))
    return collapse_spaces(_each_replaced(plain, LEET_FROM, LEET_TO))


def normalize_for_match(text: Column) -> Column:
    """NFKC + casefold + plain quotes and dashes, stripped."""
    return match_text(text, fold_rare(text))


def normalize_leet(text: Column) -> Column:
    """NFKC + lower case + digit-for-letter spellings undone, one-line."""
    return leet_text(text, fold_rare(text))


def match_form(term: str) -> str:
    """:func:`normalize_for_match` for one dictionary term."""
    wide = unicodedata.normalize("NFKC", term)
    return wide.translate(str.maketrans(QUOTES_FROM, QUOTES_TO)).casefold().strip()


def leet_form(term: str) -> str:
    """:func:`normalize_leet` for one dictionary term."""
    lowered = unicodedata.normalize("NFKC", term).lower()
    return " ".join(lowered.translate(str.maketrans(LEET_FROM, LEET_TO)).split())


def word_tokens(lowered: Column, min_length: int = 1) -> Column:
    return F.regexp_extract_all(
        lowered, F.lit("[%s]{%d,}" % (WORD_CLASS, min_length)), F.lit(0)
    )


def text_lines(text: Column) -> Column:
    """Stripped, non-empty lines."""
    stripped = F.transform(F.split(text, LINE_BREAK), strip)
    return F.filter(stripped, lambda line: line != "")


# ---- HTML to text -----------------------------------------------------------

MIN_HTML_LENGTH = 30
HTML_TAG = r"<[^>]+>"
BLANKS_TO_COLLAPSE = r"[\t\r\f][ \t\r\f]*| [ \t\r\f]+"
LINES_TO_TRIM = r" ?\n[ \n]*"


def _looks_like_html(source: Column) -> Column:
    return source.contains("<") & source.contains(">")


def _long_enough(source: Column) -> Column:
    return F.when(F.length(source) >= MIN_HTML_LENGTH, source)


def _strip_tags(source: Column) -> Column:
    return F.regexp_replace(source, HTML_TAG, "")


def _tidy_lines(text: Column) -> Column:
    one_spaced = F.regexp_replace(text, BLANKS_TO_COLLAPSE, " ")
    return strip(F.regexp_replace(one_spaced, LINES_TO_TRIM, "\n"))


def with_html_texts(rows: DataFrame, sources: Column, target: str) -> DataFrame:
    """Add ``target``: the readable text of each element of an array column.

    NULL for elements under 30 characters. Markup gives its main text, see
    ``main_text.py``, or all its text if that is empty; anything else is the text
    itself. Only rows with markup reach Python. One column per step, so that no
    step is computed twice.
    """
    quiet = rows.withColumn(
        target,
        F.transform(
            sources,
            lambda s: F.struct(
                _long_enough(s).alias("source"),
                F.when(
                    _looks_like_html(s), F.regexp_replace(_long_enough(s), RAW_ELEMENTS, " ")
                ).alias("markup"),
            ),
        ),
    )
    marked = F.when(F.exists(target, lambda s: s["markup"].isNotNull()), F.col(target)["markup"])
    parted = quiet.withColumn(
        target, F.struct(F.col(target).alias("parts"), main_blocks_array(marked).alias("blocks"))
    )
    lined = parted.withColumn(
        target,
        F.transform(
            F.col(target)["parts"],
            lambda s, i: F.struct(
                s["source"], _tidy_lines(F.get(F.col(target)["blocks"], i)).alias("main")
            ),
        ),
    )
    escaped = lined.withColumn(
        target,
        F.transform(
            target,
            lambda s: F.when(s["main"] != "", s["main"])
            .when(_looks_like_html(s["source"]), _strip_tags(s["source"]))
            .otherwise(s["source"]),
        ),
    )
    plain = escaped.withColumn(target, unescape_array(F.col(target)))
    stripped = plain.withColumn(target, F.transform(target, strip))
    return stripped.withColumn(
        target, F.transform(target, lambda t: F.when(t != "", t))
    )


def with_html_text(rows: DataFrame, source: Column, target: str) -> DataFrame:
    """:func:`with_html_texts` for a single text."""
    texts = with_html_texts(rows, F.array(source), target)
    return texts.withColumn(target, F.get(target, F.lit(0)))


def strip_html_tags(source: Column) -> Column:
    """The plain fallback alone: tags out, entities undone, stripped."""
    enough = _long_enough(source)
    bare = F.when(_looks_like_html(enough), _strip_tags(enough)).otherwise(enough)
    return blank_to_null(strip(unescape(bare)))
