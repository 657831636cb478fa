"""Operator 4: secret scans by patterns and character Markov models, with Spark expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import table, text_rows

ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A run shorter than this fails as a whole, and no later start in it does better.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"[A-Za-z0-9+/_=-]{4,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Mean log-likelihood ratio per character pair from which a token counts as random.
MIN_SCORE = 0.7
#: Pseudo-counts of each pair: random strings start out uniform, identifiers rare.
RANDOM_PRIOR, ORDINARY_PRIOR = 20.0, 0.5


def _spans(text: Column, pattern: str, kind: int, passes: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as structs (start, kind, end, value), in code points.

    Splitting at the pattern gives the texts between the matches, and the lengths of both add
    up to the positions.
    """
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
    )
    empty = F.expr("cast(array() AS array<struct<start int, kind int, end int, value string>>)")

    def step(seen: Column, x: Column) -> Column:
        start = seen.at + F.length(x.gaps)
        end = start + F.length(x.matches)
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x.matches.alias("value"))
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(x.matches.isNotNull(), F.array_append(seen.found, span)).otherwise(seen.found).alias("found"),
        )

    return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda seen: seen.found)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns: assignments with a value of 6 characters or more, access keys, hex runs."""
    assigned = F.filter(
        _spans(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s.value, ASSIGN, 2)) >= 6
    )
    return F.concat(assigned, _spans(text, ACCESS, 1), _spans(text, HEX, 2))


def secret_value(span: Column) -> Column:
    """The secret itself: of an assignment what stands behind the sign."""
    return F.when(span.kind == 0, F.regexp_extract(span.value, ASSIGN, 2)).otherwise(span.value)


def _pairs(values: DataFrame) -> DataFrame:
    """Counts of adjacent characters of the alphabet, at most the square of its size; repeated values are cut up once."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length("value") - 1, F.lit(1))), lambda i: F.substring("value", i, 2))
    wanted = "^[" + ALPHABET.replace("-", "\\-") + "]{2}$"
    return (
        values.groupBy("value").agg(F.count("*").alias("times")).select(F.explode(pairs).alias("pair"), "times")
        .filter(F.col("pair").rlike(wanted)).groupBy("pair").agg(F.sum("times").alias("count"))
    )


def labelled_samples(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Random strings and ordinary identifiers (column value), labelled by the fixed patterns.

    Random: the secrets that the patterns find. Ordinary: all other words, those secrets cut
    out. Both are taken from all documents.
    """
    rows = text_rows(docs)
    found = rows.select(F.explode(base_spans(F.col("text"))).alias("s"))
    # a password may be a plain word: only values with a digit count as random strings
    random = found.select(secret_value(F.col("s")).alias("value")).filter("value rlike '[0-9]'")
    clean = rows.select(
        F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ").alias("text")
    )
    ordinary = clean.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("value"))
    return random, ordinary


def train(random: DataFrame, ordinary: DataFrame) -> list[float]:
    """Log-likelihood ratios of all pairs of the alphabet, a table of fixed size.

    Both are Markov chains of first order. Without random strings that model is uniform.
    """
    counts = [{r["pair"]: r["count"] for r in _pairs(values).collect()} for values in (random, ordinary)]
    n = len(ALPHABET)

    def log_p(pairs: dict[str, int], prior: float) -> list[list[float]]:
        rows = [[pairs.get(a + b, 0) + prior for b in ALPHABET] for a in ALPHABET]
        return [[math.log(c / sum(row)) for c in row] for row in rows]

    a, b = log_p(counts[0], RANDOM_PRIOR), log_p(counts[1], ORDINARY_PRIOR)
    return [a[i][j] - b[i][j] for i in range(n) for j in range(n)]


def score(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio per pair of a token of two characters or more."""
    table_of_ratios = F.split(F.lit(",".join(f"{x:.4f}" for x in model)), ",").cast("array<double>")

    def at(i: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(token, i, 1)) - 1

    total = F.aggregate(
        F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0),
        lambda acc, i: acc + F.element_at(table_of_ratios, (at(i) * len(ALPHABET) + at(i + 1) + 1).cast("int")),
    )
    return total / (F.length(token) - 1)


def scan_secrets(docs: DataFrame, model: list[float] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """Per document: doc_id, spans (array of start, kind, end, value, sorted by start and kind).

    Kinds are indexes into KINDS. The fixed patterns give the base spans. Other tokens of 20
    characters or more that touch no base span are scored by the two Markov models, trained on
    `docs` unless a model is given, and kept from `min_score` on.

    Null text counts as empty and has no spans. Null and repeated doc_ids are rows like others.
    An empty table gives an empty result. Columns other than doc_id and text are not read.
    """
    if model is None:
        model = train(*labelled_samples(docs))
    rows = text_rows(docs).withColumn("base", base_spans(F.col("text")))
    tokens = F.filter(
        _spans(F.col("text"), TOKEN, 3),
        lambda s: ~F.exists("base", lambda b: (b.start < s.end) & (s.start < b.end)) & (score(s.value, model) >= min_score),
    )
    return rows.select("doc_id", F.array_sort(F.concat("base", tokens)).alias("spans"))


def told(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ","
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(told(F.filter("spans", lambda s: s.kind < 3), KINDS), 256).alias("base_sha256"),
        told(F.col("spans"), KINDS).alias("spans"),
    )
