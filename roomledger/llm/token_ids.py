"""Token ids of whole texts by a public word tokenizer, with each distinct word looked up once per task.

Words are kept as Arrow strings with their ids in one flat array, so that a block's words are found in bulk and
only new ones are encoded one by one. The store is bounded: beyond ``CACHE_WORDS`` it falls back to the words of the
current block.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roomledger.llm.common import Words

CACHE_WORDS, CACHE_PARTS = 400_000, 50_000
# The word pattern of the tokenizer file, for texts of the characters in PLAIN alone, where its
# normalisation is lower-casing; any other text is given to the tokenizer whole.
LETTERS = "a-zªµºß-öø-ɏ"
DIGITS = "0-9²³¹¼-¾"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\s{DIGITS}{LETTERS}]+"
NOT_PLAIN = "[^\t\n\r\x20-\x7e¡-¬®-įı-ɏ]|<\\|"


class TokenIds:
    """Callable from an Arrow text array without nulls to the little-endian 32-bit ids of each text."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import os

        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.split = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.word, self.cache_words = re.compile(WORD), cache_words
        self.parts: dict[str, list[int]] = {}
        self.words = pa.array([], pa.string())
        self.ids, self.bounds = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _part(self, part: str) -> list[int]:
        """Ids of one part (the tokenizer's own split leaves it whole and maps its bytes)."""
        return [t.id for t in self.model.tokenize(part if part.isascii() else self.split.pre_tokenize_str(part)[0][0])]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-cased words, one after the other, and their bounds."""
        flat, size = array("I"), np.zeros(len(words) + 1, np.int64)
        for i, word in enumerate(words):
            if word.isalpha():
                flat.extend(self._part(word))
            else:
                for part in self.word.findall(word):  # signs, digits and short words recur
                    ids = self.parts.get(part)
                    if ids is None:
                        ids = self._part(part)
                        if len(self.parts) >= CACHE_PARTS:
                            self.parts = {}
                        self.parts[part] = ids
                    flat.extend(ids)
            size[i + 1] = len(flat)
        return (np.frombuffer(flat, np.uint32) if len(flat) else np.zeros(0, np.uint32)).astype("<u4"), size

    def _known(self, vocab: pa.Array) -> np.ndarray:
        """Place of each word of ``vocab`` in the store, after adding the new ones."""
        place = pc.index_in(vocab, value_set=self.words)
        new = pc.is_null(place)
        at = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = vocab.filter(new)
        if len(fresh):
            ids, bounds = self._encode(fresh.to_pylist())
            at[new.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(fresh))
            self.words = pa.concat_arrays([self.words, fresh])
            self.bounds = np.concatenate([self.bounds, bounds[1:] + self.bounds[-1]])
            self.ids = np.concatenate([self.ids, ids])
        return at

    def _shrink(self, at: np.ndarray) -> None:
        """Keeps the words at the given places alone."""
        size = np.diff(self.bounds)[at]
        ends = np.cumsum(size)
        self.ids = self.ids[np.repeat(self.bounds[at] - (ends - size), size) + np.arange(int(size.sum()))]
        self.words, self.bounds = self.words.take(pa.array(at)), np.concatenate([[0], ends])

    def __call__(self, text: pa.Array) -> list[bytes]:
        plain = pc.invert(pc.match_substring_regex(text, NOT_PLAIN))
        words = Words(pc.utf8_lower(pc.if_else(plain, text, "")))
        at = self._known(words.vocab.cast(pa.string()))
        place = at[words.codes]
        sizes = np.diff(self.bounds)[place]
        before = np.cumsum(sizes) - sizes
        flat = self.ids[np.repeat(self.bounds[:-1][place] - before, sizes) + np.arange(int(sizes.sum()))]
        ends = np.concatenate([[0], np.cumsum(sizes)])[words.starts]
        out = [flat[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
        for i in np.flatnonzero(~plain.to_numpy(zero_copy_only=False)):
            out[i] = np.array(self.tokenizer.encode(text[i].as_py(), add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.words) > self.cache_words:
            self._shrink(at)
        return out
