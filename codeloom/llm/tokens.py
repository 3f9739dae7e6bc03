"""Token ids of whole texts, with every distinct stretch between blanks encoded once per worker."""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

END = 1
# White space as the splitting patterns of the vocabularies know it.
BLANKS = r" \t-\r\x85\xa0  -     　"
# Where a text may be cut without changing its tokens, per vocabulary. Byte-level pieces take one space in front.
STRETCHES = {
    "byte_bpe_50k.json": rf" ?[^{BLANKS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]",
    "word_bpe_49k.json": rf"[^{BLANKS}]+",
}
# Latin letters beyond ASCII that every Unicode version has as letters, that stand for themselves in the normal form, and
# of which the small one is one letter.
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e"
# Stretches of signs and letters of which the vocabulary's own rule for words is plain, and that rule. The library's
# model takes these words in their byte-level form.
PLAIN = {
    "byte_bpe_50k.json": re.compile(rf" ?[!-~{LATIN}]+"),
    "word_bpe_49k.json": re.compile(rf"[!-~{LATIN}]+"),
}
WORDS = {
    "byte_bpe_50k.json": re.compile(
        rf"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z{LATIN}]+| ?[0-9]+| ?[^ \t\n\rA-Za-z0-9{LATIN}]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
    ),
    "word_bpe_49k.json": re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[a-z{LATIN}]+|[0-9]|[^ \t\n\ra-z0-9{LATIN}]+"),
}
# Whole texts that need no cutting into stretches first.
PLAIN_TEXT = {
    "byte_bpe_50k.json": re.compile(rf"[ \t\n\r!-~{LATIN}]*"),
    "word_bpe_49k.json": re.compile(rf"[ \t\n\r!-~{LATIN}]*"),
}
LOWERED = {"word_bpe_49k.json"}
# Byte-level form: signs and letters of Latin-1 stand for themselves, the other bytes for the code points from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BLANK_BYTE = "\u0120"
BYTE_LEVEL = dict(zip([b for b in range(256) if b not in _SHOWN], range(256, 512)))
# Distinct stretches and words a worker remembers, and the longest stretch it remembers, in code points.
REMEMBERED = 200_000
REMEMBERED_WORDS = 500_000
LONGEST = 64
# Code points that are split at a time.
_AT_ONCE = 2_000_000


class _Known(dict):
    """Ids of stretches; one that is not there is encoded and, unless it is long, remembered."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, stretch: str) -> bytes:
        ids = self.encode(stretch)
        if len(stretch) <= LONGEST:
            self[stretch] = ids
        return ids


class Encoder:
    """Ids of the ``tokenizers`` library, without added special tokens.

    Stretches that the vocabulary's own rules never join are encoded by the library once and
    remembered, at most about ``REMEMBERED`` of them; plain ones are cut into the vocabulary's words, which the
    library's model encodes. A text that contains one of the vocabulary's special strings goes through the library as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        name = os.path.basename(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.split = re.compile(STRETCHES[name]).findall
        self.plain, self.words, self.lowered = PLAIN[name].fullmatch, WORDS[name].findall, name in LOWERED
        self.plain_text = PLAIN_TEXT[name].fullmatch
        self.tokenize = self.library.model.tokenize
        self.known = _Known(self._stretch)
        self.known_words = _Known(self._word)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            shown = word.replace(" ", BLANK_BYTE)
        else:
            shown = word.encode().decode("latin-1").translate(BYTE_LEVEL)
        ids = array("H", [t.id for t in self.tokenize(shown)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _stretch(self, stretch: str) -> bytes:
        if not self.plain(stretch):
            return self._whole(stretch)
        words = self.words(stretch.lower() if self.lowered else stretch)
        return b"".join(map(self.known_words.__getitem__, words))

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 16-bit ids of each text; null and empty texts have none."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            waiting.append(text or "")
            size += len(waiting[-1])
            if size >= _AT_ONCE:
                yield from self._group(waiting)
                waiting, size = [], 0
        yield from self._group(waiting)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.known_words) > REMEMBERED_WORDS:
            self.known_words.clear()
        for text in texts:
            if any(s in text for s in self.special):
                yield self._whole(text)
            elif self.plain_text(text):
                yield b"".join(map(self.known_words.__getitem__, self.words(text.lower() if self.lowered else text)))
            else:
                yield b"".join(map(self.known.__getitem__, self.split(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)


def path(name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file: in ``folder``, or in the installed package."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
