"""Text expressions: every function takes and returns a Spark ``Column``."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import patterns as P


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space become one space; the ends are stripped."""
    return F.btrim(F.regexp_replace(text, P.SPACES, " "))


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` alone removes spaces only)."""
    return F.btrim(text, F.lit(P.SPACE_CHARS))


def dedup_key(text: Column) -> Column:
    """Key of the cleaning step: collapsed white space, lower case."""
    return F.lower(collapse_whitespace(text))


def collection_key(text: Column) -> Column:
    """Key of the collection step: ends stripped, lower case, inner white space kept."""
    return F.lower(strip(text))


def digest(key: Column) -> Column:
    """32-byte stand-in for a long grouping key, so shuffles and sorts never carry whole texts."""
    return F.unhex(F.sha2(key, 256))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def remove_markup(text: Column, words: tuple[str, ...] = P.ARTIFACT_WORDS) -> Column:
    """Replace tags, class/style attributes and artifact words by a space each."""
    for pattern in (P.TAG, P.CLASS_ATTR, P.STYLE_ATTR):
        text = F.regexp_replace(text, pattern, " ")
    if not words:
        return text
    # Texts without any of the words never meet the costly pattern.
    return F.when(_may_hold(text, words) & text.rlike(P.holds_artifact_word(words)), F.regexp_replace(text, P.artifact_word(words), "$1 ")).otherwise(text)


def has_markup(text: Column) -> Column:
    """Basic entities, class/style attributes, ``<div`` or ``<p``; all of them hold one of three characters."""
    return (F.contains(text, F.lit("&")) | F.contains(text, F.lit("=")) | F.contains(text, F.lit("<"))) & text.rlike(P.MARKUP_ISSUE)


def _may_hold(text: Column, words: tuple[str, ...]) -> Column:
    """False only where none of the words can be found: in plain ASCII texts a search for bytes settles that."""
    if not all(word.isascii() for word in words):
        return F.octet_length(text) >= 0
    found = F.octet_length(text) != F.length(text)
    for word in words:
        found = found | F.contains(F.lower(text), F.lit(word.lower()))
    return found


def has_artifact(text: Column, words: tuple[str, ...] = P.ARTIFACT_WORDS) -> Column:
    if not words:
        return F.lit(False)
    return _may_hold(text, words) & text.rlike(P.holds_artifact_word(words)) & text.rlike(P.artifact_word(words))


def has_source_markup(text: Column) -> Column:
    """The corpus report's looser test: any entity, ``href``, ``nofollow`` or ``www``."""
    return text.rlike(P.SOURCE_MARKUP)


def entity_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(P.ENTITY)).cast("bigint")


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def decode_entities(text: Column) -> Column:
    """Full HTML entity decoding.

    Spark has no such function, so rows holding an ampersand go through an Arrow UDF; all
    other rows pass a null to it and keep their text on the JVM side.
    """
    decoded = _unescape(F.when(F.contains(text, F.lit("&")), text))
    return F.coalesce(decoded, text)


def decode_basic_entities(text: Column) -> Column:
    """JVM-only decoding of the five basic entities, ampersand last."""
    # Fixed values.
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def corpus_tokens(text: Column) -> Column:
    """Lower-case ASCII tokens of three or more characters, stopwords included."""
    return F.regexp_extract_all(F.lower(text), F.lit(P.CORPUS_TOKEN), F.lit(0))


def model_tokens(text: Column) -> Column:
    """Lower-case word tokens of two or more characters, the classifier's analyser."""
    return F.regexp_extract_all(F.lower(text), F.lit(P.MODEL_TOKEN), F.lit(0))


def ngrams(tokens: Column, low: int = 1, high: int = 1) -> Column:
    """All n-grams of the token array for n in ``low..high``, joined by a space."""
    if not 1 <= low <= high:
        raise ValueError(f"ngram range must satisfy 1 <= low <= high, got ({low}, {high})")
    parts = []
    grams = tokens
    for n in range(1, high + 1):
        if n > 1:
            # The n-gram at i is the (n-1)-gram at i followed by the token at i + n - 1.
            rest = F.slice(tokens, n, F.greatest(F.size(tokens), F.lit(1)))
            grams = F.filter(
                F.zip_with(grams, rest, lambda left, right: F.concat(left, F.lit(" "), right)),
                lambda gram: gram.isNotNull(),
            )
        if n >= low:
            parts.append(grams)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def safe_class_name(value: Column) -> Column:
    """Class name as used in specs: stripped, lower case, white space as underscores."""
    return F.regexp_replace(F.lower(strip(value)), P.SPACES, "_")


def normalize_topic(topic: Column) -> Column:
    return F.coalesce(dedup_key(topic), F.lit(""))
