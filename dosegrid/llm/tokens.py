"""Byte-level BPE by the public vocabulary files, in Python workers.

`ids(text)` equals `tokenizers.Tokenizer.encode(text, add_special_tokens=False)`
with special strings taken as ordinary text. Texts of plain characters go through
tiktoken with the ranks of the same file, which is several times as fast; any
other text goes through `tokenizers` itself.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: The split pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose classes all pattern engines agree.
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\u00a1-\\u024f\\u2013-\\u2026]*")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such a file: printable bytes stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.size = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.n_bytes = np.zeros(self.size, np.int64)
        self.spaced = np.zeros(self.size, bool)  # ids whose first byte is a space
        for token, i in ranks.items():
            self.n_bytes[i] = len(token)
            self.spaced[i] = token[:1] == b" "
        self._fast = tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._full = Tokenizer.from_file(path)
        self._full.encode_special_tokens = True
        self._full.no_truncation()

    def ids(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text):
            return np.frombuffer(self._fast._core_bpe.encode_to_tiktoken_buffer(text, set()), np.uint32)
        return np.array(self._full.encode(text, add_special_tokens=False).ids, np.uint32)

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, each word after a space, and how many each word has. Words hold no ASCII white space, so plain ones are encoded together and parted at the spaces."""
        together = "".join([" " + w for w in words])
        if _PLAIN.fullmatch(together):
            ids = self.ids(together)
            starts = np.flatnonzero(self.spaced[ids])
            return ids, np.diff(starts, append=len(ids))
        plain = np.array([bool(_PLAIN.fullmatch(w)) for w in words])
        ids, sizes = self.word_ids([w for w, p in zip(words, plain, strict=True) if p])
        parts = iter(np.split(ids, np.cumsum(sizes)[:-1]))
        each = [next(parts) if p else self.ids(" " + w) for w, p in zip(words, plain, strict=True)]
        return np.concatenate(each), np.array([len(x) for x in each])


@lru_cache(2)
def byte_bpe(path: str) -> ByteBpe:
    """One for each worker process and file."""
    return ByteBpe(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
