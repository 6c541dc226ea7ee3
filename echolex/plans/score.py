"""Raw posts to scored posts."""

from echolex.operators.cleaning import clean_posts
from echolex.operators.scoring import with_created_at, with_label, with_language
from echolex.schemas import SCORED_SCHEMA


def score_posts(posts, preset="current", compat=False, scorer="tokens", model=None, max_chars=None, lexicons=None, status=None):
    """Clean, time-stamp, detect the language and label.

    Works on batch and streaming input alike. With no `model` the whole plan
    is native expressions over one scan, without a shuffle. `max_chars` scores
    only the beginning of a text (1000 gives the cut of short-input models).
    `lexicons` and `status` are those of `with_label`.
    """
    cleaned = clean_posts(posts, preset, compat)
    languages = with_language(with_created_at(cleaned), two_way=scorer == "routed")
    labelled = with_label(languages, scorer, max_chars=max_chars, model=model, lexicons=lexicons, status=status)
    return labelled.select(*SCORED_SCHEMA.names, *([status] if status else []))
