"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import os
import re
import struct

import numpy as np

#: lower-case letter runs whose ids are remembered
MOST_CORES = 400_000
#: words longer than this are encoded each time and not remembered
LONGEST = 64
#: a word of plain Latin letters and the punctuation after it: two tokens' worth of text, whatever the case
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*&%$#|]*)")

_LOADED: dict[str, WordEncoder] = {}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder(dict):
    """Ids (uint32, little-endian bytes) of words; computes and remembers those of unknown words, at most ``most``, and
    those of lower-case letter runs, at most ``most_cores``, which many words share and which take longer to compute.

    For tokenizers that lower-case, drop white space and never join across it, nor across a change from letters to
    punctuation: then the ids of a text are those of its words, one after another. Words that are not plain Latin
    letters with punctuation behind them go through the whole tokenizer; for plain ones its model alone is asked.
    When the memory is full it starts anew.
    """

    def __init__(self, tokenizer_json: str, most: int = 100_000, most_cores: int = MOST_CORES):
        super().__init__({"": b""})
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        self.most, self.most_cores, self.cores = most, most_cores, {}
        letters = [chr(c) for c in range(0x100) if _PLAIN.fullmatch(chr(c))]
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.as_bytes = str.maketrans({c: split(c)[0][0] for c in letters})

    def ids(self, text: str) -> np.ndarray:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u4")

    def __missing__(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word) if len(word) <= LONGEST else None
        if plain is None:
            ids = self._whole(word)
        elif plain[2]:
            ids = self._core(plain[1].lower()) + self[plain[2]]
        else:
            ids = self._core(word.lower())
        if len(word) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
                self[""] = b""
            self[word] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _core(self, letters: str) -> bytes:
        ids = self.cores.get(letters)
        if ids is None:
            if len(self.cores) >= self.most_cores:
                self.cores.clear()
            tokens = self.model.tokenize(letters.translate(self.as_bytes))
            ids = self.cores[letters] = _packed([t.id for t in tokens])
        return ids


def encoder(tokenizer_json: str, most_cores: int = MOST_CORES) -> WordEncoder:
    """One encoder per worker process and tokenizer."""
    if tokenizer_json not in _LOADED:
        _LOADED.clear()
        _LOADED[tokenizer_json] = WordEncoder(tokenizer_json)
    _LOADED[tokenizer_json].most_cores = most_cores
    return _LOADED[tokenizer_json]
