"""Many terms in one pass over a text: an Aho-Corasick automaton for a whole dictionary.

All forms of all topics and kinds are in one automaton per normal form of the text,
built once in a Python worker. A text is read once whatever the number of terms;
what an accepting state holds says which topics a form stands for, and for short
forms what must lie beside it.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import itemgetter, or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TAGS = "struct<topics array<string>, excluded array<string>, keywords array<string>, negatives array<string>>"
_TAGS = pa.struct([(n, pa.list_(pa.string())) for n in ("topics", "excluded", "keywords", "negatives")])


# The same characters as is_word.
WORD_RUN = re.compile(r"\w+")


@dataclass(frozen=True)
class TopicForms:
    """One topic's normalised forms; ``spellings`` are ``(leet form, term)`` in configured order."""

    topic: str
    keywords: Sequence[str]
    bounded: Sequence[bool]
    excludes: Sequence[str]
    negatives: Sequence[str]
    spellings: Sequence[tuple[str, str]]


def is_word(char: str) -> bool:
    """Letters, digits and the underscore, as the word class of the column rules."""
    return char == "_" or unicodedata.category(char)[0] in "LN"


class Automaton:
    """All places of many forms in a text; ``bounded`` forms need a word border on both sides.

    A bounded form of word characters alone stands where it is a whole run of them, so
    these are looked up and not searched for; only other bounded forms need their places.
    """

    def __init__(self, forms: Iterable[tuple[str, bool]]) -> None:
        import ahocorasick

        self.number: dict[tuple[str, bool], int] = {}
        self._runs: dict[str, int] = {}
        self._loose = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self._edged = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self._edges: dict[int, tuple[int, bool, bool]] = {}
        for form, bounded in dict.fromkeys(forms):
            n = self.number[form, bounded] = len(self.number)
            if not bounded:
                self._loose.add_word(form, n)
            elif WORD_RUN.fullmatch(form):
                self._runs[form] = n
            else:
                self._edged.add_word(form, n)
                self._edges[n] = (len(form), is_word(form[0]), is_word(form[-1]))
        for automaton in (self._loose, self._edged):
            if len(automaton):
                automaton.make_automaton()

    def hits(self, text: str | None) -> set[int]:
        """The numbers of the forms in the text."""
        seen: set[int] = set()
        if not text:
            return seen
        if len(self._loose):
            seen.update(map(itemgetter(1), self._loose.iter(text)))
        if self._runs:
            seen.update(self._runs[run] for run in self._runs.keys() & set(WORD_RUN.findall(text)))
        if self._edges:
            seen.update(n for end, n in self._edged.iter(text) if n not in seen and self._stands(text, end, n))
        return seen

    def _stands(self, text: str, end: int, n: int) -> bool:
        length, opens, closes = self._edges[n]
        start, after = end - length, end + 1
        before_word = start >= 0 and is_word(text[start])
        after_word = after < len(text) and is_word(text[after])
        # beside a word character none may follow, beside any other one must
        return before_word != opens and after_word != closes


def _bits(mask: int) -> Iterator[int]:
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


class Matcher:
    """Topics and terms of a text from the forms of a dictionary.

    What a form says of topics is one number with a bit per topic. Spellings are kept by
    topic, so a text meets only those of its own topics, however many share its words.
    """

    def __init__(self, topics: Sequence[TopicForms], min_hits: int) -> None:
        self.names = [t.topic for t in topics]
        self.min_hits = max(min_hits, 1)
        plain = [(f, b) for t in topics for f, b in zip(t.keywords, t.bounded)]
        self.match = Automaton([*plain, *((f, False) for t in topics for f in t.excludes)])
        self.leet = Automaton((f, False) for t in topics for f in (*t.negatives, *(s for s, _ in t.spellings)))
        self.keyword = [0] * len(self.match.number)
        self.exclude = [0] * len(self.match.number)
        self.negative = [0] * len(self.leet.number)
        self.spelling: list[dict[int, list[tuple[int, str]]]] = []
        for i, t in enumerate(topics):
            for form in zip(t.keywords, t.bounded):
                self.keyword[self.match.number[form]] |= 1 << i
            for form in t.excludes:
                self.exclude[self.match.number[form, False]] |= 1 << i
            for form in t.negatives:
                self.negative[self.leet.number[form, False]] |= 1 << i
            spelled: dict[int, list[tuple[int, str]]] = {}
            for place, (form, term) in enumerate(t.spellings):
                spelled.setdefault(self.leet.number[form, False], []).append((place, term))
            self.spelling.append(spelled)
        # the forms are in the automata; only their numbers are needed from here
        self.match.number.clear()
        self.leet.number.clear()

    def tags(self, match: str | None, leet: str | None) -> dict[str, list[str]]:
        found = self.match.hits(match)
        excluded = reduce(or_, map(self.exclude.__getitem__, found), 0)
        topics = self._keyword_topics(found) & ~excluded
        spelled = self.leet.hits(leet)
        negatives = reduce(or_, map(self.negative.__getitem__, spelled), 0)
        terms: dict[str, None] = {}
        for i in _bits(topics):
            own = self.spelling[i]
            terms.update((term, None) for _, term in sorted(x for n in own.keys() & spelled for x in own[n]))
        return {
            "topics": self._named(topics),
            "excluded": self._named(excluded),
            "keywords": list(terms),
            "negatives": self._named(negatives),
        }

    def _keyword_topics(self, found: set[int]) -> int:
        """The topics with enough hits."""
        masks = map(self.keyword.__getitem__, found)
        if self.min_hits == 1:
            return reduce(or_, masks, 0)
        counts = Counter(i for mask in masks for i in _bits(mask))
        return sum(1 << i for i, c in counts.items() if c >= self.min_hits)

    def _named(self, topics: int) -> list[str]:
        return [self.names[i] for i in _bits(topics)]


_BUILT: dict[str, Matcher] = {}


def tagger(topics: Sequence[TopicForms], min_hits: int = 1) -> Callable[[Column, Column], Column]:
    """A column function of the two normal forms of a text, giving ``TAGS``.

    The forms travel with the function, once; a worker builds the automata of a
    dictionary when it first meets it and keeps them for its other tasks.
    """
    packed = pickle.dumps((tuple(topics), min_hits))
    name = hashlib.sha256(packed).hexdigest()

    @F.arrow_udf(TAGS)
    def tags(match: pa.Array, leet: pa.Array) -> pa.Array:
        from docwatch.functions import terms

        if name not in terms._BUILT:
            terms._BUILT.clear()
            terms._BUILT[name] = terms.Matcher(*pickle.loads(packed))
        matcher = terms._BUILT[name]
        return pa.array([matcher.tags(m, t) for m, t in zip(match.to_pylist(), leet.to_pylist())], terms._TAGS)

    return lambda match, leet: tags(match, leet)
