"""Operator 12: fill-in-the-middle transformation, cut at code points found by arithmetic on 64-bit words."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import ship, table, text_rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares of 100 documents that are cut at all, and of these 100 that put the suffix first.
CUT_SHARE, SUFFIX_FIRST_SHARE = 90, 20
#: Bytes of text handled at once; a longer text is handled by itself.
RUN_BYTES = 8_000_000

_ONES = np.uint64(0x0101010101010101)
_TOPS = np.uint64(0x8080808080808080)
_ONE, _SIX, _SEVEN, _EIGHT, _LAST = (np.uint64(n) for n in (1, 6, 7, 8, 56))


def unit_ends(data: np.ndarray) -> np.ndarray:
    """64-bit words with a 1 in each byte that ends a code point; one word per 8 bytes of UTF-8.

    A byte goes on a code point if its top bits are 10. A byte ends one if the next byte starts
    one, so the marks of the starts move down by a byte, the lowest of each word into the word
    before. The last byte ends the last code point, and padding has no marks.
    """
    size = len(data)
    words = np.zeros(-(-size // 8), "<u8")
    words.view(np.uint8)[:size] = data
    starts = ~(words >> _SEVEN & ~(words >> _SIX)) & _ONES
    ends = starts >> _EIGHT
    ends[:-1] |= starts[1:] << _LAST
    if size:
        ends[-1] &= np.uint64((1 << 8 * ((size - 1) % 8)) - 1)
        ends[-1] |= _ONE << np.uint64(8 * ((size - 1) % 8))
    return ends


class Units:
    """Ranks and places of the code points of some bytes of UTF-8."""

    def __init__(self, data: np.ndarray):
        self.ends = unit_ends(data)
        self.upto = np.append(0, np.cumsum(np.bitwise_count(self.ends), dtype=np.int64))

    def before(self, at: np.ndarray) -> np.ndarray:
        """How many code points end before each byte offset."""
        word, inside = at >> 3, (at & 7).astype(np.uint64)
        ends = np.append(self.ends, np.uint64(0))[word]
        return self.upto[word] + np.bitwise_count(ends & ((_ONE << (inside << np.uint64(3))) - _ONE))

    def place(self, rank: np.ndarray) -> np.ndarray:
        """The byte offset behind each rank-th code point, counted from 1; 0 for rank 0."""
        word = np.maximum(np.searchsorted(self.upto, rank) - 1, 0)
        if not len(self.ends):
            return np.zeros(len(rank), np.int64)
        left = (rank - self.upto[word]).astype(np.uint64)
        # byte i of the product counts the marks up to byte i, 8 at most; the first that reaches what is left
        upto = self.ends[word] * _ONES
        reached = (upto | _TOPS) - left * _ONES & _TOPS
        lowest = (reached & -reached) - _ONE  # all bits below the first mark
        return np.where(rank == 0, 0, 8 * word + (np.bitwise_count(lowest) >> 3) + 1)


def _draws(doc_ids) -> np.ndarray:
    """Four unsigned 32-bit numbers for each id; a null id is drawn for as an empty one."""
    raw = b"".join(
        hashlib.sha256(b"1:" if i is None else f"1:{i}".encode()).digest()[:16] for i in doc_ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def _runs(texts: pa.Array):
    """Parts of a text column of about RUN_BYTES, as (first row, bytes, offsets into them)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RUN_BYTES, side="right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def _transformed(doc_ids: pa.Array, texts: pa.Array):
    """Batches n, form, prefix_chars, middle_chars, output of the rows of one batch."""
    for first, data, offsets in _runs(texts):
        units = Units(data)
        rank = units.before(offsets)
        n, rows = np.diff(rank), len(offsets) - 1
        h = _draws(doc_ids.slice(first, rows).to_pylist())
        cuts = np.sort(np.stack([h[:, 0] % (n + 1), h[:, 1] % (n + 1)]), axis=0)
        places = [units.place(rank[:-1] + cut) for cut in cuts]
        raw = data.tobytes()
        forms, prefixes, middles, outputs = [], [], [], []
        for row in range(rows):
            start, end = int(offsets[row]), int(offsets[row + 1])
            text = raw[start:end]
            if not text or h[row, 2] % 100 >= CUT_SHARE or any(s.encode() in text for s in (PREFIX, SUFFIX, MIDDLE)):
                forms.append("plain")
                prefixes.append(None)
                middles.append(None)
                outputs.append(text)
                continue
            # a cut of no code points stands where the text starts
            a, b = (int(p[row]) if cut[row] else start for p, cut in zip(places, cuts))
            prefix, middle, suffix = raw[start:a], raw[a:b], raw[b:end]
            parts = [(PREFIX, prefix), (SUFFIX, suffix)]
            forms.append("spm" if h[row, 3] % 100 < SUFFIX_FIRST_SHARE else "psm")
            if forms[-1] == "spm":
                parts.reverse()
            prefixes.append(int(cuts[0, row]))
            middles.append(int(cuts[1, row] - cuts[0, row]))
            outputs.append(b"".join(sign.encode() + part for sign, part in (*parts, (MIDDLE, middle))))
        yield first, rows, [
            pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
            pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())]


_NAMES = ["n", "form", "prefix_chars", "middle_chars", "output"]


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n, form, prefix_chars, middle_chars, output.

    A text of n code points is cut in three, at places drawn from the digest of its doc_id, and
    put together as `<P>`prefix`<S>`suffix`<M>`middle (psm) or `<S>`suffix`<P>`prefix`<M>`middle
    (spm). Some texts, by the same draw, empty ones and those that hold one of the three signs
    stay as they are (plain), with null prefix_chars and middle_chars.

    Null text counts as empty. Rows with a null doc_id are drawn for as if their id had no
    digits; repeated doc_ids are cut alike if their texts are. An empty table gives an empty
    result. Columns other than doc_id and text are not read. A batch is handled in runs of whole
    texts, so memory follows the longest text.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def transform(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for first, rows, columns in _transformed(ids, batch.column("text")):
                yield pa.RecordBatch.from_arrays([ids.slice(first, rows), *columns], names=["doc_id", *_NAMES])

    return text_rows(docs).mapInArrow(
        transform, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that went in, from the output and its form alone: the parts hold no signs."""
    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, len(first) + 1, 2**31 - 1)
        behind = F.substring(rest, F.instr(rest, second) + len(second), 2**31 - 1)
        return (
            F.substring_index(rest, second, 1), F.substring_index(behind, MIDDLE, 1),
            F.substring(behind, F.instr(behind, MIDDLE) + len(MIDDLE), 2**31 - 1))

    p, s, m = parts(PREFIX, SUFFIX)
    s2, p2, m2 = parts(SUFFIX, PREFIX)
    return F.when(form == "plain", output).when(form == "psm", F.concat(p, m, s)).otherwise(F.concat(p2, m2, s2))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP12_SQL = """
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, text, n,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
        CASE
            WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
            WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm'
        END AS form
    FROM t
), cut AS (
    SELECT *, least(c1, c2) AS p, greatest(c1, c2) AS q FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
    sha256(CASE form
        WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || substr(text, 1, p) || '<S>' || substr(text, q + 1) || '<M>' || substr(text, p + 1, q - p)
        ELSE '<S>' || substr(text, q + 1) || '<P>' || substr(text, 1, p) || '<M>' || substr(text, p + 1, q - p)
    END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM cut
"""
