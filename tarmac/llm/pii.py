"""Operator 5: personal data by patterns, checksums and context words."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import ship, table, text_rows
from tarmac.llm.secretscan import told

KINDS = ("email", "ip", "card", "phone", "iban")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# Digits before a match would have been part of it, so these look-behinds change no match;
# they and the possessive repeats keep the search linear on long runs of digits.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
DIGIT = re.compile("[0-9]")
#: Score of a confirmed span, and what a word of its kind or an unlike one nearby adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT = {
    "email": re.compile(r"e-?mail|contact|write to", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login", re.I),
    "card": re.compile(r"card|visa|mastercard|credit|payment", re.I),
    "phone": re.compile(r"phone|call|mobile|tel\b|fax|contact", re.I),
    "iban": re.compile(r"iban|account|bank|transfer", re.I),
}
UNLIKE = re.compile(r"version|example|order|invoice|serial|isbn", re.I)
REACH, BONUS, MALUS = 40, 0.1, 0.2
SPANS = "array<struct<kind int, start int, end int, score double>>"


def luhn(digits: str) -> bool:
    """Check digit of payment cards."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Check digits of bank accounts."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str):
    """Each `@` with a domain behind it takes the run of name characters before it, back to the last match."""
    last, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        start = at
        if domain:
            while start > last and text[start - 1] in LOCAL:
                start -= 1
        if start < at:
            yield start, domain.end()
            last = domain.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)


def base_and_added(text: str):
    """(kind, start, end) of all confirmed spans."""
    if "@" in text:
        for start, end in emails(text):
            yield 0, start, end
    if DIGIT.search(text) is None:
        return
    for m in IP.finditer(text):
        # without leading zeros first, as there may be thousands of them
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in (part.lstrip("0") for part in m[0].split("."))):
            yield 1, m.start(), m.end()
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield 2, m.start(), m.end()
    for m in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(m[0])) <= 15:
            yield 3, m.start(), m.end()
    for m in IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield 4, m.start(), m.end()


def scored(text: str) -> list[dict]:
    """All spans of a text, sorted by start and kind, with scores from 0 to 1."""
    found = []
    for kind, start, end in base_and_added(text):
        near = text[max(0, start - REACH):start] + " " + text[end:end + REACH]
        name = KINDS[kind]
        score = SCORES[name] + BONUS * bool(CONTEXT[name].search(near)) - MALUS * bool(UNLIKE.search(near))
        found.append({"kind": kind, "start": start, "end": end, "score": round(min(1.0, max(0.0, score)), 3)})
    return sorted(found, key=lambda s: (s["start"], s["kind"]))


_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def _find(batches):
    for batch in batches:
        spans = pa.array((scored(text.as_py()) for text in batch.column("text")), _ARROW_SPANS)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), spans], names=["doc_id", "spans"])


def find_personal_data(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """Per document: doc_id, spans (array of kind, start, end, score, sorted by start and kind).

    Kinds are indexes into KINDS. Patterns propose; part ranges, digit counts, the Luhn check
    of cards and the mod-97 check of IBANs confirm; context words within `REACH` characters move
    the score. Spans that the method adds (IBANs) are left out under `min_score`; those of the
    fixed patterns stay, whatever their score. The default keeps every confirmed span.

    Null text counts as empty and has no spans. Null and repeated doc_ids are rows like others.
    An empty table gives an empty result. Columns other than doc_id and text are not read.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = text_rows(docs).mapInArrow(_find, f"doc_id {kind}, spans {SPANS}")
    added = KINDS.index("iban")
    return found.withColumn("spans", F.filter("spans", lambda s: (s.kind < added) | (s.score >= min_score)))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    return found.select(
        "doc_id", *[number(i).alias(f"n_{KINDS[i]}") for i in range(4)],
        F.sha2(told(F.filter("spans", lambda s: s.kind < 4), KINDS), 256).alias("base_sha256"),
        told(F.col("spans"), KINDS).alias("spans"), (F.size("spans") > 0).alias("found"),
        F.array_join(F.transform("spans", lambda s: s.score.cast("string")), ",").alias("scores"),
    )
