"""Parsing of raw text fields, as SQL expression text.

Unparsable text becomes NULL and never fails a job.
"""

from __future__ import annotations

# Text that counts as missing in a CSV file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_MISSING = ", ".join(f"'{token}'" for token in NA_TOKENS)
# Blank, tab, line feed, carriage return, vertical tab, form feed.
_BLANKS = r"' \t\n\r\u000B\u000C'"


def strip(text: str) -> str:
    return f"trim(BOTH {_BLANKS} FROM {text})"


def stripped_or_null(text: str, length: int | None = None) -> str:
    """Stripped text, cut to `length`; NULL when nothing is left."""
    body = strip(text) if length is None else f"substring({strip(text)}, 1, {length})"
    return f"nullif({body}, '')"


def missing_to_null(text: str) -> str:
    return f"CASE WHEN {text} NOT IN ({_MISSING}) THEN {text} END"


def code(text: str) -> str:
    return f"upper({strip(text)})"


def to_number(text: str) -> str:
    """Number or NULL, NaN included. Letters that only Java takes for part of a number
    (type letters, hexadecimal exponents) are spoilt first; blanks around are allowed."""
    return f"try_cast(translate({text}, 'dDfFpP', 'xxxxxx') AS DOUBLE)"


def to_numbers(texts: list[str]) -> str:
    """`to_number` of several texts, as an array; without a letter to spoil in any of them they are read as they stand.

    Whether there is any letter is told by its two cases, much sooner than by a pattern.
    """
    listed, plain = ", ".join(texts), ", ".join(f"try_cast({t} AS DOUBLE)" for t in texts)
    joined = f"concat_ws(' ', {listed})"
    return (
        f"CASE WHEN lower({joined}) <> upper({joined}) "
        f"THEN transform(array({listed}), t -> {to_number('t')}) ELSE array({plain}) END"
    )


def known(number: str) -> str:
    """NaN to NULL."""
    return f"nullif({number}, double('NaN'))"


def whole(number: str) -> str:
    """Truncated toward zero; NULL when it does not fit an INT, like NaN."""
    return f"try_cast({number} AS INT)"


def flag(number: str) -> str:
    return f"coalesce({number} = 1D, FALSE)"


def clock(number: str) -> str:
    """`HHMM` as a number to `HH:MM:00`; 2400 is midnight, minutes over 59 are NULL."""
    n = f"pmod({whole(number)}, 2400)"
    digits = f"CAST(10000 + {n} AS STRING)"
    return (
        f"CASE WHEN {n} % 100 <= 59 THEN "
        f"concat(substring({digits}, 2, 2), ':', substring({digits}, 4, 2), ':00') END"
    )


def to_day(text: str) -> str:
    """`YYYY-MM-DD`, or `M/D/YYYY` with an optional time after a blank.

    A cast reads the first form much sooner than a pattern, but takes more for a date: it counts
    where the date is written back alike, leading zeros aside.
    """
    body = strip(text)
    day = f"try_cast({body} AS DATE)"
    alike = f"replace(CAST({day} AS STRING), '-0', '-') = replace({body}, '-0', '-')"
    return (
        f"CASE WHEN contains({body}, '/') "
        f"THEN try_to_date(substring_index({body}, ' ', 1), 'M/d/y') "
        f"WHEN {day} BETWEEN DATE'1000-01-01' AND DATE'9999-12-31' AND {alike} THEN {day} "
        f"ELSE try_to_date({body}, 'yyyy-M-d') END"
    )
