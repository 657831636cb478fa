"""Search tokens, as SQL expression text."""

from __future__ import annotations

# The English stop-word list of full-text search.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so s t can
    will just don should now
    """.split()
)


_DROPPED = ", ".join(f"'{word}'" for word in ("", *STOP_WORDS))


def search_tokens(*parts: str) -> str:
    """Distinct lower-case words of all parts, sorted; NULL parts are skipped."""
    words = f"split(lower(concat_ws(' ', {', '.join(parts)})), r'[^\\p{{L}}\\p{{N}}]+')"
    return f"sort_array(array_except({words}, array({_DROPPED})))"
