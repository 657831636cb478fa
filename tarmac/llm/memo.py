"""Per-worker tokenizer state: loaded once per Python worker and reused by its tasks.

The memos hold the encodings of single words. They are bounded: a full memo takes no more
words, and is emptied when it no longer knows most of the words that come.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import sys

MEMO_ENTRIES = 300_000
#: Longer words are encoded each time, so that the memo stays small in bytes too.
MEMO_WORD = 60
_tokenizers: dict[tuple[str, str], object] = {}


def file_digest(path: str) -> str:
    """Version of a tokenizer: digest of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


class Memo(dict):
    """Encodings by word; subclasses say how to encode a list of distinct words."""

    def encode_words(self, words: list[str]) -> list:
        raise NotImplementedError

    def encodings(self, words: set[str]) -> dict[str, object]:
        """The encodings of these words; those that are not known yet are encoded once and kept."""
        new = list(words.difference(self))
        found = {word: self[word] for word in words if word in self}
        if len(self) >= MEMO_ENTRIES and len(new) > 0.8 * len(words):
            self.clear()
        room = MEMO_ENTRIES - len(self)
        for i in range(0, len(new), 5000):
            part = dict(zip(new[i:i + 5000], self.encode_words(new[i:i + 5000])))
            found.update(part)
            if i < room:
                self.update((w, e) for w, e in part.items() if len(w) <= MEMO_WORD)
        return found


class PieceCounter:
    """Token counts by a sentencepiece model, of whole texts."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]


def _class(accepted) -> str:
    """A character class of the plain Latin characters that are accepted."""
    return "[" + re.escape("".join(c for c in map(chr, range(0x180)) if accepted(c))) + "]"


class WordIds(Memo):
    """Ids of texts, as little-endian 32-bit bytes, by a tokenizer that cuts lower-case words.

    Latin text is cut here just as the tokenizer's own pattern cuts it, and each distinct word
    goes through the library once per worker. Anything else goes through the library whole, and
    so does every text if the tokenizer's file does not state just the steps that are cut here.
    """

    #: The steps of a file whose words can be cut here (fixed values of the tokenizer's format).
    NORMALIZER = {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
    PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
    WORD_END = "</w>"

    #: Here NFC changes nothing, lower-casing goes letter by letter and white space is plain.
    PLAIN = re.compile("[\t\n\v\f\r -~¡-įı-ſ]*")
    #: Letters, single numbers, the pattern's endings, other marks.
    CUT = re.compile(
        _class(str.isalpha) + "+|" + _class(lambda c: c.isnumeric()) + "|'(?:s|t|re|ve|m|ll|d)|"
        + _class(lambda c: not c.isalnum() and not c.isspace()) + "+"
    )

    def __init__(self, path: str):
        import tokenizers

        self.model = tokenizers.Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.ends = {i for token, i in self.model.get_vocab().items() if token.endswith(self.WORD_END)}
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        self.cuts = (
            steps["normalizer"] == self.NORMALIZER and steps["pre_tokenizer"] == self.PRE_TOKENIZER
            and steps["model"].get("end_of_word_suffix") == self.WORD_END and steps["model"].get("continuing_subword_prefix") is None)

    def encode(self, text: str) -> bytes:
        ids = self.model.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """All words in one text; each ends with the one token that carries the mark of a word's end."""
        ids = self.model.encode(" ".join(words), add_special_tokens=False).ids
        found, start = [], 0
        for i, one in enumerate(ids, 1):
            if one in self.ends:
                found.append(struct.pack(f"<{i - start}I", *ids[start:i]))
                start = i
        return found if len(found) == len(words) and start == len(ids) else [self.encode(w) for w in words]

    def plain(self, text: str) -> bool:
        return self.cuts and self.PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def ids(self, texts: list[str]) -> list[bytes]:
        cut = [self.CUT.findall(text.lower()) if self.plain(text) else None for text in texts]
        known = self.encodings(set().union(*(words for words in cut if words is not None)))
        return [
            self.encode(text) if words is None else b"".join(map(known.__getitem__, words))
            for text, words in zip(texts, cut)
        ]


def worker_tokenizer(kind: str, path: str):
    """This worker's tokenizer of a kind over a file."""
    key = (kind, path)
    if key not in _tokenizers:
        _tokenizers[key] = getattr(sys.modules[__name__], kind)(path)
    return _tokenizers[key]


def chunks(texts: list[str], most: int = 2_000_000):
    """Runs of texts of about so many characters at most, so that memory doesn't follow the batch."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run
