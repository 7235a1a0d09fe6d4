"""Token ids of whole texts with a public byte-level tokenizer, inside Spark tasks.

The tokenizer splits text at white space before it merges anything, so the ids of a text are the ids of its words, each
with the blank before it. Words repeat; each worker keeps the ids of those it has met, up to a bound, and asks the
library for the others in batches. The result is the library's for the whole text (tests compare them).
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

from quadrille.llm.words import KEEPERS

#: Words a worker remembers, in two tables, before it starts afresh.
MOST_WORDS = 500_000
_RARE_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f"
_WIDE_SPACE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: ASCII marks that a run of letters can be followed by.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: The printable character that stands for each byte in the tokenizer's vocabulary, by its published rule: printable
#: Latin-1 characters stand for themselves, the other bytes for the characters from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SYMBOLS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
_TWO_SPACES = re.compile(r"\s\s")
_BEFORE_BLANK = re.compile(r"(?<=\S)(?= )")


def spaces_touch(text: str) -> bool:
    """Whether two white space characters stand side by side."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return True
    other = any(c in text for c in _RARE_SPACE) or (not text.isascii() and any(c in text for c in _WIDE_SPACE))
    return bool(other and _TWO_SPACES.search(text))


class _Known(dict):
    """Ids of words after ``lead``, learned as they are met."""

    def __init__(self, encoder: Encoder, lead: str):
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MOST_WORDS:
            self.clear()
        # Letters end where marks begin; an apostrophe may belong to the letters after it.
        letters = word.rstrip(_MARKS)
        if not letters.isalpha():
            ids = self.encoder.ask(self.lead + word)
        elif letters is word or len(letters) == len(word):
            ids = self.encoder.letters(self.lead + word)
        else:
            ids = self[letters] + self.encoder.plain[word[len(letters) :]]
        self[word] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain, self.after_blank = _Known(self, ""), _Known(self, " ")
        self.line_break = self.ask("\n")

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def ask(self, text: str) -> bytes:
        """Ids by the library's whole pipeline."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, word: str) -> bytes:
        """Ids of letters alone, which the pattern of the tokenizer never splits: straight from the library's merges."""
        symbols = word.encode().decode("latin-1").translate(_SYMBOLS)
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def encode(self, text: str) -> bytes:
        first, later = self.plain.__getitem__, self.after_blank.__getitem__
        if spaces_touch(text):
            return b"".join(map(first, _BEFORE_BLANK.split(text)))
        out = []
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(first(words[0]) + b"".join(map(later, words[1:])))
        return self.line_break.join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    return Encoder(path)


KEEPERS.append(encoder)
