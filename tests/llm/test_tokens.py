import random
import struct

import public_tokenizers
import regex
import sentencepiece
import tokenizers

from tarmac.llm import memo
from tarmac.llm.tokens import cached_counts, op2_token_counts, token_counts
from tests.conftest import SF_DIR
from tests.llm.conftest import by_id

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_counts_equal_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op2_token_counts(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(model.encode(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)


def test_only_distinct_misses_are_encoded_and_the_cache_is_appended(spark, docs_of, folder):
    version = memo.file_digest(MODEL)
    token_counts(docs_of("a b", "a b", "c"), MODEL, folder).collect()
    assert cached_counts(spark, folder, version).count() == 2
    again = token_counts(docs_of("a b", "d", None), MODEL, folder)
    assert cached_counts(spark, folder, version).count() == 4
    assert again.count() == 3
    assert cached_counts(spark, folder, "another version").count() == 0


def test_odd_rows(odd, no_docs):
    found = by_id(token_counts(odd, MODEL))
    assert sum(map(len, found.values())) == odd.count()
    assert found[5][0]["n_tokens"] == 0 and found[5][0]["n_bytes"] == 0
    assert found[7][0]["over_limit"]
    assert token_counts(no_docs, MODEL).count() == 0


def test_word_ids_equal_the_library():
    words = memo.WordIds(WORDS)
    model = tokenizers.Tokenizer.from_file(WORDS)
    pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    for c in map(chr, range(0x180)):
        if words.PLAIN.fullmatch(c):
            assert words.CUT.findall(c.lower()) == pattern.findall(c.lower())
    parts = [
        " ", "\n", "a", "The", "é", "ß", "İ", "ª", "²", "½", "'s", "'ll", "'", "_", "-", "<s>", "<|endoftext|>", "漢",
        "Σ", "́", "\x00", "\x1c", "\xa0", "9", "0", "(", "ſ", "K", "😀", "Ünï", "  ", "word",
    ]
    rng = random.Random(4)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    for text, ids in zip(texts, words.ids(texts)):
        expected = model.encode(text, add_special_tokens=False).ids
        assert ids == struct.pack(f"<{len(expected)}I", *expected)
