"""Token ids of whole texts by a public word BPE tokenizer, with a bounded cache of words.

The tokenizer normalises (NFC, lower case, white space dropped) and splits by one pattern,
so ids can be found word by word. ASCII and Latin-1 texts take that path; a text with any
other character, or with the name of a special token, goes through the tokenizer whole.
Both give the ids of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: The split pattern of the tokenizer file over ASCII and over Latin-1.
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
LETTERS, NUMBERS, SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")

SEGMENT = 1 << 20
CACHED_WORDS = 250_000


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other
    bytes for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def segments(text: str, least: int = SEGMENT) -> Iterator[str]:
    """A very long text in pieces that end at a blank or line feed: no token spans one."""
    start = 0
    while len(text) - start > least:
        cut = re.compile(r"[ \n]").search(text, start + least)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class WordTokenizer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.cache: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        letters = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(self.letters)
        return b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(letters))

    def segment(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            pattern = None
        elif text.isascii():
            pattern = ASCII
        else:
            try:
                text.encode("latin-1")
                pattern = LATIN
            except UnicodeEncodeError:
                pattern = None
        if pattern is None:
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return b"".join(i.to_bytes(4, "little") for i in ids)
        words = pattern.findall(text.lower())
        new = set(words).difference(self.cache)
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = set(words)
        for word in new:
            self.cache[word] = self.word(word)
        return b"".join(map(self.cache.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(text) <= SEGMENT:
            return self.segment(text)
        return b"".join(map(self.segment, segments(text)))


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str | None = None) -> WordTokenizer:
    """The tokenizer of a file that every executor has, loaded once in a worker; by default
    the public ``word_bpe_49k.json``."""
    if path is None:
        import public_tokenizers
        path = str(public_tokenizers.path("word_bpe_49k.json"))
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
