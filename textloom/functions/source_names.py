"""Expressions over source identifiers, feed addresses and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import strip

# Display names of known feeds, keyed by host without "www.".
FEED_NAMES = {
    "yachtingworld.com": "Yachting World",
    "cruisingworld.com": "Cruising World",
    "sailmagazine.com": "Sail Magazine",
    "48north.com": "48° North",
}

# Sources that count as thematic by name, and prefixes that do.
THEMATIC_NAMES = ("stackexchange_sailing", "sailingforums")
THEMATIC_PREFIXES = ("rss_", "stackexchange_", "topic_bootstrap_", "kaggle_")

# Prefix, display prefix, licence, status.
SOURCE_FAMILIES = (
    ("huggingface_", "HuggingFace / ", "dataset license", "✅"),
    ("stackexchange_", "StackExchange / ", "CC BY-SA 4.0", "✅"),
    ("rss_", "RSS / ", "editorial use", "⚠️"),
    ("topic_bootstrap_", "Topic bootstrap / ", "generated bootstrap", "✅"),
    ("kaggle_", "Kaggle / ", "varies", "✅"),
)
FORUM_LICENSE = ("robots.txt checked", "⚠️")
UNKNOWN_LICENSE = ("unknown", "—")


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def normalize_source(value: Column) -> Column:
    """Lower case, ``&`` spelled out, everything but ASCII letters and digits as one space."""
    spelled = F.replace(F.lower(_text(value)), F.lit("&"), F.lit(" and "))
    return F.btrim(F.regexp_replace(spelled, "[^a-z0-9]+", " "))


def selection_name(label: Column) -> Column:
    """Normalised last non-empty part of a grouped label such as ``Media / docs / Name``."""
    parts = F.filter(
        F.transform(F.split(_text(label), " / "), strip), lambda part: part != ""
    )
    return normalize_source(F.coalesce(F.try_element_at(parts, F.lit(-1)), label))


def url_host(url: Column) -> Column:
    """Network location of a URL, lower case, without a leading ``www.``."""
    host = F.coalesce(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), F.lit(""))
    return F.regexp_replace(host, r"^www\.", "")


def feed_display_name(url: Column) -> Column:
    """Display name of a feed address; the host where no name is known."""
    host = url_host(url)
    name = host
    for known, display in FEED_NAMES.items():
        name = F.when(host == known, F.lit(display)).otherwise(name)
    return name


def feed_short_label(url: Column) -> Column:
    """Looser variant of the review screen: a known host name anywhere in the address counts."""
    address = F.rtrim(F.lower(strip(_text(url))), F.lit("/"))
    host = url_host(address)
    name = F.when(host != "", host).otherwise(F.regexp_replace(address, r"^www\.", ""))
    for known, display in reversed(list(FEED_NAMES.items())):
        name = F.when(F.contains(address, F.lit(known.removesuffix(".com"))), display).otherwise(name)
    return name


def tag_slug(tag: Column) -> Column:
    slug = F.btrim(F.regexp_replace(F.lower(tag), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.when(slug == "", F.lit("tagged")).otherwise(slug)


def dataset_slug(name: Column) -> Column:
    return F.replace(name, F.lit("/"), F.lit("_"))


def is_thematic(source: Column) -> Column:
    name = F.lower(strip(_text(source)))
    by_prefix = F.lit(False)
    for prefix in THEMATIC_PREFIXES:
        by_prefix = by_prefix | name.startswith(prefix)
    return (
        F.when((name == "") | (name == "unknown") | name.startswith("huggingface_"), False)
        .when(by_prefix | F.contains(name, F.lit("forum")), True)
        .otherwise(name.isin(*THEMATIC_NAMES))
    )


def display_name(source: Column) -> Column:
    """Readable name of a source identifier."""
    name = _text(source)
    spaced = F.replace(name, F.lit("_"), F.lit(" "))
    result = F.when(F.contains(F.lower(name), F.lit("forum")), F.concat(F.lit("Forum / "), name)).otherwise(spaced)
    for prefix, title, _, _ in reversed(SOURCE_FAMILIES):
        rest = F.substring(name, len(prefix) + 1, 1 << 30)
        if prefix != "rss_":
            rest = F.replace(rest, F.lit("_"), F.lit(" "))
        result = F.when(name.startswith(prefix), F.concat(F.lit(title), rest)).otherwise(result)
    return result


def _by_family(source: Column, position: int, forum: str, unknown: str) -> Column:
    name = F.lower(_text(source))
    result = F.when(F.contains(name, F.lit("forum")), forum).otherwise(unknown)
    for family in reversed(SOURCE_FAMILIES):
        result = F.when(name.startswith(family[0]), family[position]).otherwise(result)
    return result


def license_type(source: Column) -> Column:
    return _by_family(source, 2, FORUM_LICENSE[0], UNKNOWN_LICENSE[0])


def license_status(source: Column) -> Column:
    return _by_family(source, 3, FORUM_LICENSE[1], UNKNOWN_LICENSE[1])


def topical_fit(source: Column) -> Column:
    """How well a source suits the topic: low, high or medium."""
    high = source.startswith("stackexchange_") | source.startswith("rss_") | (source == "sailingforums")
    return F.when(source.startswith("huggingface_"), "low").when(high, "high").otherwise("medium")
