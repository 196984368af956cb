"""Regular expressions shared by every operator.

Character classes are spelled out instead of using ``\\s``, ``\\w`` and ``\\b`` because Java's
shorthands differ from the Unicode behaviour the reference results rely on. The same spelling
is valid in Java and in RE2, so a Spark expression and its SQL check use one pattern.
"""

from __future__ import annotations

import re

# Every character Python treats as white space.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
SPACES = SPACE + "+"
WORD = r"[\p{L}\p{N}_]"

# Patterns and thresholds that must equal the reference's for equal results.
ENTITY = r"&(?:[a-zA-Z]+|#[0-9]+|#x[0-9a-fA-F]+);"
CORPUS_TOKEN = r"[a-zA-Z][a-zA-Z0-9_-]{2,}"
MODEL_TOKEN = WORD + "{2,}"
SOURCE_MARKUP = rf"(?i){ENTITY}|href|nofollow|www"
ARTIFACT_WORDS = (
    "wp",
    "timeincuk",
    "inspirewp",
    "keyassets",
    "figcaption",
    "attachment",
    "webfeedsfeaturedvisual",
)
SHORT_TEXT_MIN = 50
LONG_TEXT_MAX = 1000
SUMMARY_LONG_MIN = 500
COLLECT_MIN = 20
COLLECT_MAX = 5000
FUZZY_THRESHOLD = 90.0
FUZZY_WINDOW = 49

MARKUP_ISSUE = rf"(?i)&(?:amp|#39|lt|gt|quot);|class{SPACE}*=|style{SPACE}*=|<div|<p(?!{WORD})"
TAG = r"<[^>]+>"
CLASS_ATTR = rf"(?i)class{SPACE}*={SPACE}*['\"][^'\"]*['\"]"
STYLE_ATTR = rf"(?i)style{SPACE}*={SPACE}*['\"][^'\"]*['\"]"


def any_of(words: tuple[str, ...]) -> str:
    """Alternation that matches any of the words literally."""
    return "|".join(re.escape(word) for word in words)


def artifact_word(words: tuple[str, ...] = ARTIFACT_WORDS) -> str:
    """A whole word or hyphenated compound that contains one of the artifact words.

    Group 1 holds the hyphens before it. Each run of such characters is tried once, from its start, so the
    search is linear in the text (Java only: RE2 has no look-around).
    """
    inner = r"[\p{L}\p{N}_-]"
    return rf"(?iu)(?<!{inner})(-*+)(?={WORD}){inner}*?(?:{any_of(words)}){inner}*(?<={WORD})"


def holds_artifact_word(words: tuple[str, ...] = ARTIFACT_WORDS) -> str:
    """Any of the artifact words, in whatever they stand; cheaper than the search for the whole word."""
    return rf"(?iu)(?:{any_of(words)})"
