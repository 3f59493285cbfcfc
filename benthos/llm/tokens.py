"""Public tokenizers over whole texts, with a bounded cache of words.

`word_bpe_49k` drops white space and never merges across it, so a text's ids are its words' ids
joined; that makes the common case one dictionary lookup a word.  The file's folder is a
parameter (`where`); nothing is copied here.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

#: Words of one generation of the cache, and the longest word that is kept.
CACHE, LONGEST = 400_000, 48
#: ASCII marks that the pre-tokenizer always splits off a letter or digit before or after them.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Below this, lower-casing is letter by letter and every letter is one pre-token with its neighbours.
LATIN = "\u0250"


def _byte_letters() -> dict[int, int]:
    """How byte-level vocabularies spell bytes: printable Latin-1 as itself, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}


BYTES = _byte_letters()


def path_of(name: str, where: str | None = None) -> str:
    if where:
        return f"{where}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes; two generations, so its size is bounded."""

    def __init__(self, name: str = "word_bpe_49k.json", where: str | None = None):
        super().__init__()
        self.tokenizer = cached(_load, path_of(name, where))
        self.direct = self.tokenizer.model.tokenize
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word)
        if out is None:
            core, tail = parts(word)
            if tail:
                out = self[core] + self[tail]
            elif core != word:
                out = self[core]
            elif word.isalpha() and max(word) < LATIN and (word.isascii() or is_normalized("NFC", word)):
                # One pre-token of small Latin letters, which normalising leaves as it is: straight to the model.
                seen = word if word.isascii() else word.encode().decode("latin-1").translate(BYTES)
                out = array("I", [t.id for t in self.direct(seen)]).tobytes()
            else:
                out = array("I", self.tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids).tobytes()
        if len(word) <= LONGEST:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[word] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text; null and empty texts have none."""
        if not text:
            return b""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        return map(self.encode, texts)


def parts(word: str) -> tuple[str, str]:
    """A word's core in lower case (Latin words only) and the marks after it, which never share a token."""
    if "<|" in word:
        return word, ""
    low = word.lower() if word.isascii() or max(word) < LATIN else word
    core = low.rstrip(MARKS)
    if core and len(core) < len(low) and ((last := core[-1].lower()).isalpha() or last.isascii() and last.isdigit()):
        return core, low[len(core) :]
    return low, ""


def byte_bpe(name: str = "byte_bpe_50k.tiktoken", where: str | None = None):
    """The byte-level vocabulary as a tiktoken encoding."""
    import public_tokenizers
    import tiktoken

    with open(path_of(name, where), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_CACHED: dict = {}


def cached(make, *args):
    """One object for each worker process."""
    key = (make.__name__, *args)
    if key not in _CACHED:
        _CACHED[key] = make(*args)
    return _CACHED[key]
