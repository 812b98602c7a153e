"""Ids of whole texts from a tokenizers file, encoded word by word.

The normaliser and the splitting pattern of the word-end BPE file never look across ASCII white
space and lower-case every letter, so a text's ids are those of its lower-cased words in
order.  Words not seen lately go to the library many at a time, in one text, and their ids
are kept, as little-endian bytes of the id width, for all tasks of a Python worker.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np
from tokenizers import Tokenizer

from lodestrata.llm._common import CACHES

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core
KEPT_WORDS = 800_000
KEPT_BYTES = 16 << 20
#: Lower-case ASCII letters or letters from 0x80 on, then ASCII marks other than the apostrophe, which may start an ending.
_LETTERS_MARKS = re.compile(rb"([a-z\x80-\xff]+)([!-&(-/:-@\[-`{-~]+)\Z")
_encoders: dict[tuple[str, bool], "Encoder"] = CACHES.setdefault("encoder", {})


def id_type(vocabulary: int) -> str:
    """The narrowest little-endian unsigned type that holds all ids."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encoder(path: str, special: bool = True) -> "Encoder":
    """The encoder of this process for a tokenizer file."""
    if (path, special) not in _encoders:
        _encoders[path, special] = Encoder(path, special)
    return _encoders[path, special]


def _letters(text: str) -> bool:
    """Whether a word is letters only as the normaliser leaves it (some capitals become a letter and a mark)."""
    return text.isascii() and text.isalpha() or unicodedata.normalize("NFC", text).lower().isalpha()


class Encoder:
    """Encodes batches of UTF-8 texts; ``special`` tells if strings of special tokens become their ids."""

    def __init__(self, path: str, special: bool = True) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.special = special
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = id_type(len(vocabulary))
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = '"Lowercase"' in self.tokenizer.to_str()[:5000] and all(m == m.lower() for m in self.marks)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.size = 0

    def _ids(self, text: str, special: bool) -> np.ndarray:
        self.tokenizer.encode_special_tokens = not special
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _learn(self, words: list[bytes]) -> None:
        """Words of letters only end at the first id that ends a word; so many of them can be one text."""
        texts = [w.decode() for w in words]
        alone = []
        letters = [(w, t) for w, t in zip(words, texts, strict=True) if _letters(t)]
        others = [(w, t) for w, t in zip(words, texts, strict=True) if not _letters(t)]
        if letters:
            ids = self._ids(" ".join(t for _, t in letters), False)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(letters):
                self._cut([w for w, _ in letters], ids, [0, *ends[:-1].tolist()], ends.tolist())
            else:
                others += letters
        marked = [(w, t) for w, t in others if any(m in w for m in self.marks)]
        plain = [(w, t) for w, t in others if not any(m in w for m in self.marks)]
        if plain and self.marks:
            mark = self.marks[-1].decode()
            number = self.tokenizer.token_to_id(mark)
            ids = self._ids(mark.join(t for _, t in plain), True)
            cuts = np.flatnonzero(ids == number)
            if len(cuts) == len(plain) - 1:
                self._cut([w for w, _ in plain], ids, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)])
            else:
                alone = plain
        else:
            alone = plain
        for w, t in marked + alone:
            self.known[w] = self._ids(t, self.special).tobytes()
        self.size += sum(map(len, words))

    def _learn_all(self, words: set[bytes]) -> None:
        """Letters with marks after them are two pieces for the splitting pattern, and so are made of those two."""
        joined, plain = [], set()
        for w in words:
            m = _LETTERS_MARKS.match(w) if self.lower else None
            if m and _letters(m[1].decode()) and not any(x in w for x in self.marks):
                joined.append((w, m[1], m[2]))
                plain.update(m.groups())
            else:
                plain.add(w)
        new = [w for w in plain if w not in self.known]
        for at in range(0, len(new), 2048):
            self._learn(new[at : at + 2048])
        self.known.update((w, self.known[x] + self.known[y]) for w, x, y in joined)

    def _cut(self, words: list[bytes], ids: np.ndarray, begins: list[int], ends: list[int]) -> None:
        data, width = ids.tobytes(), ids.itemsize
        self.known.update((w, data[x * width : y * width]) for w, x, y in zip(words, begins, ends, strict=True))

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text as bytes; a null text has none."""
        if len(self.known) > KEPT_WORDS or self.size > KEPT_BYTES:
            self.known.clear()
            self.size = 0
        get = self.known.get
        out, missing = [], []
        for text in texts:
            if text and self.lower:
                low = text.lower()
                if not any(m in low for m in self.marks):
                    text = low
            words = text.split() if text else []
            ids = list(map(get, words))
            if None in ids:
                missing.append((ids, [(i, words[i]) for i, x in enumerate(ids) if x is None]))
            out.append(ids)
        self._learn_all({w for _, rows in missing for _, w in rows})
        for ids, rows in missing:
            for i, w in rows:
                ids[i] = self.known[w]
        return [b"".join(x) for x in out]
