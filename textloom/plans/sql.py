"""Pieces of SQL shared by the checks. They run on DuckDB, whose regular expressions are RE2."""

from __future__ import annotations

from textloom.functions import patterns as P
from textloom.functions.source_names import SOURCE_FAMILIES, THEMATIC_NAMES, THEMATIC_PREFIXES
from textloom.plans.catalog import KEYWORDS, SOURCE_CASE


def text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def words(values) -> str:
    return ", ".join(text(value) for value in sorted(values))


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {text(P.SPACES)}, ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {text(f'^{P.SPACES}|{P.SPACES}$')}, '', 'g')"


def key(x: str) -> str:
    return f"lower({collapse(x)})"


def collection_key(x: str) -> str:
    return f"lower({strip(x)})"


def matches(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {text(pattern)})"


def replace_all(x: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({x}, {text(pattern)}, {text(by)}, 'g')"


def found(x: str, pattern: str) -> str:
    return f"regexp_extract_all({x}, {text(pattern)})"


def pct(count: str, total: str, digits: int = 2) -> str:
    return f"coalesce(round(100.0 * ({count}) / nullif({total}, 0), {digits}), 0.0)"


# The markup test without look-ahead: RE2 has none.
MARKUP = rf"(?i)&(?:amp|#39|lt|gt|quot);|class{P.SPACE}*=|style{P.SPACE}*=|<div|<p(?:[^\p{{L}}\p{{N}}_]|$)"


def artifact(listed=P.ARTIFACT_WORDS) -> str:
    """Artifact words without look-around: from the first to the last word character of a
    hyphenated run that holds one of them."""
    run = r"[\p{L}\p{N}_-]*"
    return rf"(?i)(?:{P.WORD}{run}?)?(?:{P.any_of(tuple(listed))})(?:{run}{P.WORD})?"


def without_markup(x: str, listed=P.ARTIFACT_WORDS) -> str:
    for pattern in (P.TAG, P.CLASS_ATTR, P.STYLE_ATTR, artifact(listed)):
        x = replace_all(x, pattern)
    return x


CORPUS = f"SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, text, lang AS label, {SOURCE_CASE} AS source FROM documents"

THEMATIC = (
    "CASE WHEN trim(lower(source)) IN ('', 'unknown') OR starts_with(lower(source), 'huggingface_') THEN false "
    + " ".join(f"WHEN starts_with(lower(source), '{prefix}') THEN true" for prefix in THEMATIC_PREFIXES)
    + f" WHEN contains(lower(source), 'forum') THEN true ELSE lower(source) IN ({words(THEMATIC_NAMES)}) END"
)

_HITS = ", ".join(
    f"len(list_filter(tokens, lambda t: t IN ({words(listed)}))) AS hits_{name}" for name, listed in KEYWORDS.items()
)
_TOTAL = " + ".join(f"hits_{name}" for name in KEYWORDS)
_BEST = f"greatest({', '.join(f'hits_{name}' for name in KEYWORDS)})"

# Keyword hits per class, then the annotated corpus, the review queue and its corrections.
HITS = f"""
 corpus AS ({CORPUS}),
 hits AS (SELECT *, {_HITS} FROM (SELECT *, {found('lower(text)', P.WORD + '+')} AS tokens FROM corpus)),
 scored AS (SELECT *, {_BEST} AS best, {_TOTAL} AS total FROM hits)
"""
ANNOTATED = f"""
{HITS},
 annotated AS (SELECT doc_id, id, text, source,
   CASE WHEN best = 0 THEN 'other_or_offtopic' {' '.join(f"WHEN hits_{name} = best THEN '{name}'" for name in KEYWORDS)} END AS label,
   CASE WHEN best = 0 THEN 0.0::DOUBLE ELSE round(best::DOUBLE / total, 6) END AS confidence,
   CASE WHEN best = 0 THEN 'fallback' ELSE 'keyword' END AS label_source,
   label AS truth FROM scored)
"""
QUEUE = f"""
{ANNOTATED},
 queue AS (SELECT a.id, text, label, confidence, source, label AS suggested_label,
   CASE WHEN l.quality = 1 THEN truth WHEN l.toxic = 1 THEN '  ' ELSE '' END AS corrected_label
   FROM annotated a LEFT JOIN labels l USING (doc_id) WHERE confidence < 0.7)
"""
FAMILIES = SOURCE_FAMILIES
