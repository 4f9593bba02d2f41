"""Token ids of whole texts with a public tokenizer file, inside tasks.

The words of a text - split at ASCII white space, with a comma or full stop after an a-z letter split off - are encoded one by
one, each distinct word once per worker. That gives the ids of the whole text for tokenizers whose splitter drops white space,
never joins across it and never joins a letter with punctuation (`word_bpe_49k.json` is one: it lower-cases, too, so A-Z are
lower-cased before words are told apart, except where a text holds the marks of special tokens). New words made of letters
alone are encoded many at a time: the tokenizer's end-of-word mark tells where each ends.

The table of words is emptied when it holds WORDS entries, which changes no id.
"""

from __future__ import annotations

import os
import re

import numpy as np

WORDS = 500_000
_loaded: dict[str, Encoder] = {}
_STOP = re.compile(rb"(?<=[a-z])([.,])(?=[ \t-\r]|$)")


class Encoder:
    """ids(texts) for one tokenizer file; one per worker process."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True

    @classmethod
    def load(cls, path: str) -> Encoder:
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def learn(self, words: list[bytes]) -> None:
        """Adds the ids of words that aren't known yet."""
        texts = [w.decode() for w in words]
        plain = [x.isalpha() and x.islower() for x in texts]
        letters = [x for x, p in zip(texts, plain, strict=True) if p]
        rest = [x for x, p in zip(texts, plain, strict=True) if not p]
        for i in range(0, len(letters), 512):
            part = letters[i : i + 512]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) != len(part):
                rest += part
                continue
            raw, at = ids.tobytes(), 0
            for x, end in zip(part, (stop * 4).tolist(), strict=True):
                self.known[x.encode()] = raw[at:end]
                at = end
        for x, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.known[x.encode()] = np.array(e.ids, "<u4").tobytes()

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without special tokens added; a null is an empty text."""
        if len(self.known) > WORDS:
            self.known.clear()
        words, bounds = [], [0]
        for x in texts:
            raw = (x or "").encode()
            words += raw.split() if b"<|" in raw else _STOP.sub(rb" \1", raw.lower()).split()
            bounds.append(len(words))
        ids = list(map(self.known.get, words))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            self.learn(list({words[i] for i in missing}))
            for i in missing:
                ids[i] = self.known[words[i]]
        return [b"".join(ids[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def row_groups(texts: list[str | None], limit: int = 4 << 20):
    """Slices of about `limit` characters, so that a batch of long texts is never held twice."""
    i, size = 0, 0
    for j, x in enumerate(texts):
        size += len(x or "")
        if size >= limit:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)
