"""Stopword lists and how a report's set is put together."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from textloom.functions.patterns import CORPUS_TOKEN

# The four lists must equal the reference's for equal token counts.
ENGLISH = frozenset(
    """
    a about above after again against ain all am an and any are aren aren't as at be because been
    before being below between both but by can couldn couldn't d did didn didn't do does doesn
    doesn't doing don don't down during each few for from further had hadn hadn't has hasn hasn't
    have haven haven't having he her here hers herself him himself his how i if in into is isn
    isn't it it's its itself just ll m ma me mightn mightn't more most mustn mustn't my myself
    needn needn't no nor not now o of off on once only or other our ours ourselves out over own re
    s same shan shan't she she's should should've shouldn shouldn't so some such t than that
    that'll the their theirs them themselves then there these they this those through to too under
    until up ve very was wasn wasn't we were weren weren't what when where which while who whom
    why will with won won't wouldn wouldn't y you you'd you'll you're you've your yours yourself
    yourselves
    """.split()
)
MARKUP = frozenset(
    """
    wp p content wp-content wp-content-uploads uploads timeincuk inspirewp attachment
    attachment-medium medium size-medium size-full height width figcaption figure keyassets href
    nofollow www http https com html class entry entry-lead-paragraph lead paragraph strong net
    appeared first alt jpg png style margin bottom display block one get got even also well new
    year time way make made said say go going still yachtingworld cruisingworld sailmagazine
    48north sailingforums continue reading post image photo live site amp img src rel
    """.split()
)
TEMPLATE = frozenset(
    """
    guide guides overview tutorial training note notes community members discuss thread threads
    example examples practical concrete detailed sections recognised recognize reliable uncertain
    explicit implicit summarise summary analyst reviews highlights broader descriptions partial
    appears late article articles cross functional cross-functional learning resources best
    practice practices quality review checklists begins belongs mentions touches present context
    compare compares approaches workflow workflows
    """.split()
)
SUMMARY = frozenset(
    """
    a about above after again against all am an and any are as at be because been before being
    below between both but by can could did do does doing down during each few for from further
    had has have having he her here hers herself him himself his how i if in into is it its itself
    just me more most my myself no nor not now of off on once only or other our ours ourselves out
    over own same she should so some such than that the their theirs them themselves then there
    these they this those through to too under until up very was we were what when where which
    while who whom why will with would you your yours yourself yourselves boat boats sail sailing
    yacht yachts sea also get got one two using used
    """.split()
)
TOPIC_SUFFIXES = frozenset({"basics", "tools", "workflows", "issues", "advanced"})


def report_stopwords(
    topic: str = "",
    classes: Sequence[str] = (),
    extra: Iterable[str] = (),
) -> frozenset[str]:
    """Stopwords of the corpus report: the fixed lists, the topic's own words, extra words,
    and the suffixes of class names that were made from the topic."""
    words = set(ENGLISH | MARKUP | TEMPLATE) | {str(word).lower() for word in extra}
    words.update(re.findall(CORPUS_TOKEN, topic.lower()))
    prefix = "_".join(topic.lower().split()) + "_"
    for name in (str(item).strip().lower() for item in classes):
        suffix = name.split("_", 1)[1] if "_" in name and name.startswith(prefix) else ""
        if suffix in TOPIC_SUFFIXES:
            words.update({suffix, *suffix.split("_")})
    return frozenset(words)
