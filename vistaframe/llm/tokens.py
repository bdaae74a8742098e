"""Token ids of whole texts, by a tokenizers vocabulary file."""

from __future__ import annotations

import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

#: Unicode white space, as the tokenizers' own patterns take it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Parts of a text that no vocabulary joins: a run of other characters with one space before it, and white space.
PART = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Parts of a text for vocabularies that drop white space.
WORD_PART = re.compile(f"[^{SPACE}]+")
#: str.split() also cuts at these, which are no white space to a vocabulary.
SEPARATORS = re.compile("[\\x1c-\\x1f]")
#: An ASCII capital and a mark: the two may compose, or the marks after it may be put in order first.
MARKED = re.compile("[A-Z][" + "".join(c for c in map(chr, range(0x300, 0x20000)) if unicodedata.combining(c)) + "]")
#: Parts kept with their ids in each of two generations.
KEPT_PARTS = 1 << 19
LONGEST_KEPT = 64
#: Marks that often close a part. No vocabulary joins them to an ASCII letter or digit before them.
MARKS = ".,;:!?*%&$#|)\""


class Known(dict):
    """Ids of the parts seen lately, as bytes; what is missing is encoded by the library. A part that
    marks close is looked up without them. The older generation is dropped when the newer is full."""

    def __init__(self, library) -> None:
        super().__init__()
        self.library, self.older = library, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            body = part.rstrip(MARKS)
            if len(body) < len(part) and body[-1:].isascii() and body[-1:].isalnum():
                ids = self[body] + self[part[len(body) :]]
            else:
                ids = array("I", self.library.encode(part, add_special_tokens=False).ids).tobytes()
        if len(part) <= LONGEST_KEPT:
            if len(self) >= KEPT_PARTS:
                self.older = self.copy()
                self.clear()
            self[part] = ids
        return ids


def added_tokens(library, any_case: bool) -> re.Pattern:
    """The library's added tokens. Written without flags, so that their common start is searched for as fast as a literal."""
    either = lambda c: f"[{c.lower()}{c.upper()}]" if any_case and c.isascii() and c.isalpha() else re.escape(c)
    return re.compile("|".join("".join(map(either, t.content)) for t in library.get_added_tokens_decoder().values()) or "(?!)")


class Encoder:
    """Ids of texts. As words recur, most parts of a text have been encoded before and are only looked up.

    The pre-tokenizers of the vocabularies cut at every boundary of PART (or of WORD_PART, with drops_space, where ASCII
    case is lost too), so the ids of a text are those of its parts in order; texts of which this may fail go to the library
    whole. Tests hold this against the library's ids of whole texts. Null and empty texts have no ids.
    """

    def __init__(self, path: str, drops_space: bool = False) -> None:
        from tokenizers import Tokenizer

        self.drops_space = drops_space
        library = Tokenizer.from_file(path)
        self.known, self.added = Known(library), added_tokens(library, drops_space)

    def parts(self, text: str) -> list[str]:
        if not self.drops_space:
            return PART.findall(text)
        text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        return WORD_PART.findall(text) if SEPARATORS.search(text) else text.split()

    def whole(self, text: str) -> bool:
        """Whether the parts of a text may have other ids than the whole: the library splits at added tokens before all else, and
        where case is lost it composes letters and marks before that."""
        return bool(self.added.search(text) or self.drops_space and not text.isascii() and MARKED.search(text))

    def ids(self, text: str | None) -> np.ndarray:
        if text and self.whole(text):
            return np.array(self.known.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.parts(text or ""))), "<u4")


@lru_cache(maxsize=4)
def encoder(path: str, drops_space: bool = False) -> Encoder:
    """One for each worker process."""
    return Encoder(path, drops_space)
