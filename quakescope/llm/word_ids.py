"""Ids of whole texts by a ``tokenizers`` file, each distinct piece of a task encoded once.

Vocabularies that drop white space encode a text as the joined ids of its
blank-separated pieces: a blank never takes part in a normalisation, a split
or a merge.  Nor does the place between an ASCII letter and the full stop or
comma that ends a piece, and lower-casing A-Z first changes nothing.  So the
library sees every distinct piece once; the rest are look-ups.  New pieces of
letters only go to the library as one text of many words: each is one
pre-token, whose last id is the one that ends a word.

With ``markers`` a special token's string in a text is its id, as the library
has it by default: pieces that hold one go to it as they were written, since
it finds them before it lower-cases.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from .common import find_words, lower_ascii, text_bytes
from .pieces import CACHE, PieceStore, sums

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_POINT = np.zeros(256, bool)
_POINT[[ord("."), ord(",")]] = True


#: Before a marked piece's bytes in the store; not UTF-8, so no other piece begins so.
_MARKED = b"\xff\xff"


def _letters(text: str) -> bool:
    return text.isalpha() and text.lower().isalpha()


class WordIds:
    def __init__(self, path: str, markers: bool = False, most: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.marking = Tokenizer.from_file(path)
        special = [t.content.encode() for t in self.marking.get_added_tokens_decoder().values() if t.special]
        self.markers = special if markers else []
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.store = PieceStore(self.learn, most)

    def learn(self, pieces: list[bytes]) -> list[list[int]]:
        found: list = [None] * len(pieces)
        for i, p in enumerate(pieces):
            if p.startswith(_MARKED):
                found[i] = self.marking.encode(p[len(_MARKED) :].decode(), add_special_tokens=False).ids
        plain = [i for i, p in enumerate(pieces) if p.isalpha() or found[i] is None and _letters(p.decode())]
        for lo in range(0, len(plain), 1000):
            some = plain[lo : lo + 1000]
            ids = self.tokenizer.encode_batch_fast([b" ".join([pieces[i] for i in some]).decode()], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(some):
                for i, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist()):
                    found[i] = ids[a:b]
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, one in zip(rest, self.tokenizer.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)):
            found[i] = one.ids
        return found

    def marked(self, written: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The words that hold a marker."""
        found, raw = [], written.tobytes() if self.markers else b""
        for marker in self.markers:
            at = raw.find(marker)
            while at >= 0:
                word = int(np.searchsorted(starts, at, "right")) - 1
                if at + len(marker) <= ends[word]:  # else two texts make it
                    found.append(word)
                at = raw.find(marker, at + 1)
        return np.unique(np.array(found, np.int64))

    def encode(self, texts: pa.Array, last: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, ``last`` behind each text's, and each text's count; null counts as empty."""
        written, offsets = text_bytes(texts)
        data = lower_ascii(written)
        starts, ends, first = find_words(data, offsets)
        marked = self.marked(written, starts, ends)
        point = np.zeros(len(ends), bool)
        long = np.flatnonzero(ends - starts > 1)
        point[long] = _POINT[data[ends[long] - 1]] & _LETTER[data[ends[long] - 2]]
        point[marked] = False
        # pieces: a word, or a word and its point; -1 ends a text
        many = 1 + point
        words = np.repeat(np.arange(len(starts)), many)
        second = np.r_[False, words[1:] == words[:-1]] if len(words) else point
        begin = np.where(second, ends[words] - 1, starts[words]).tolist()
        end = np.where(second | ~point[words], ends[words], ends[words] - 1).tolist()
        raw, known = data.tobytes(), self.store.lookup()
        numbers = np.array([known[raw[a:b]] for a, b in zip(begin, end)], np.int64)
        place = np.cumsum(many) - many
        for word in marked.tolist():
            numbers[place[word]] = known[_MARKED + written[starts[word] : ends[word]].tobytes()]
        pieces = np.diff(np.r_[0, np.cumsum(many)][first])
        ids, sizes = self.store.gather(np.insert(numbers, np.cumsum(pieces), -1), last)
        return ids, sums(sizes, pieces + 1)


@functools.lru_cache(maxsize=4)
def word_ids(path: str, markers: bool = False, most: int = CACHE) -> WordIds:
    """One encoder for each vocabulary and worker process, which keeps up to ``most`` distinct pieces."""
    return WordIds(path, markers, most)
