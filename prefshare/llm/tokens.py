"""Token ids of whole texts with a public tokenizer, inside tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from prefshare.llm.common import ragged
from prefshare.llm.words import words_of

# Words whose ids a Python worker keeps; others are encoded again when met.
KEPT_WORDS = 600_000
# Words that go to the library in one text.
JOINED = 256
# Letters of which a run is one unit of the tokenizer's own splitting.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

_ENCODERS: dict[str, "WordEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Encodes texts through their distinct words.

    The tokenizer's own splitting never joins what white space separates, nor a
    letter with a full stop or comma, and it drops the white space; so the ids
    of a text are those of its words, one after the other. Only words that the
    worker has not met yet go through the library. White space other than ASCII
    stays inside a word and is left to the library. Words are known by a 64-bit
    hash.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.known = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint16 if len(self.last) <= 1 << 16 else np.uint32)

    def _new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has."""
        plain = [bool(_LETTERS.fullmatch(w)) for w in words]
        runs = [w for w, p in zip(words, plain, strict=True) if p]
        odd = [w for w, p in zip(words, plain, strict=True) if not p]
        encode = self.tokenizer.encode_batch_fast
        joined = [" ".join(runs[i : i + JOINED]) for i in range(0, len(runs), JOINED)]
        parts = [x.ids for x in encode(joined, add_special_tokens=False)]
        ids = np.array([i for part in parts for i in part], np.int64)
        # Each run of letters ends with the one token that closes a word.
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(runs):
            raise ValueError("the tokenizer does not close each word with one token")
        alone = [x.ids for x in encode(odd, add_special_tokens=False)]
        counts = np.zeros(len(words), np.int64)
        mask = np.array(plain, bool)
        counts[mask] = np.diff(ends, prepend=0)
        counts[~mask] = [len(x) for x in alone]
        flat = np.zeros(int(counts.sum()), self.flat.dtype)
        at = np.cumsum(counts) - counts
        flat[ragged(at[mask], counts[mask])] = ids
        flat[ragged(at[~mask], counts[~mask])] = [i for x in alone for i in x]
        return flat, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the end of each text's ids in them."""
        words = words_of(texts, tails=True)
        if not len(words.starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        found, first, where = np.unique(
            words.hashes(), return_index=True, return_inverse=True
        )
        at = np.searchsorted(self.known, found)
        hit = np.zeros(len(found), bool)
        inside = at < len(self.known)
        hit[inside] = self.known[at[inside]] == found[inside]
        start, length = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        start[hit], length[hit] = self.start[at[hit]], self.length[at[hit]]
        flat = self.flat
        if not hit.all():
            new = ~hit
            more, counts = self._new([words.text(i) for i in first[new].tolist()])
            start[new] = len(flat) + np.cumsum(counts) - counts
            length[new] = counts
            flat = np.concatenate([flat, more])
            if len(self.known) + len(counts) <= KEPT_WORDS:
                known = np.concatenate([self.known, found[new]])
                order = np.argsort(known, kind="stable")
                self.known, self.flat = known[order], flat
                self.start = np.concatenate([self.start, start[new]])[order]
                self.length = np.concatenate([self.length, counts])[order]
        lengths = length[where]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[ragged(start[where], lengths)].astype(np.uint32)
        return ids, upto[words.bounds[1:]]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encoded(texts: pa.Array, path: str, end_id: int) -> Iterator[np.ndarray]:
    """The ids of each text with the end id appended."""
    ids, ends = encoder(path).encode(texts)
    start, last = 0, np.array([end_id], np.uint32)
    for end in ends.tolist():
        yield np.concatenate([ids[start:end], last])
        start = end
