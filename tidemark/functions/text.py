"""Text helpers."""

from __future__ import annotations

# Fixed value: the characters after which a new word starts, besides the blank.
WORD_BREAKS = r"""[\t\n\x0B\f\r!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"""

# A private-use character that no text carries; marks the blanks put in below.
_MARK = "\ue000"


def title_case(col: str) -> str:
    """SQL to capitalise each word, where punctuation starts a new word, too
    (`winston-salem` becomes `Winston-Salem`).

    The built-in `initcap` splits at blanks only, so a marked blank is put in after each
    break and taken out again.
    """
    split = f"regexp_replace({col}, r'({WORD_BREAKS})', '$1{_MARK} ')"
    return f"replace(initcap({split}), '{_MARK} ', '')"
