"""Token ids of a byte-level BPE, as the tokenizers library gives them.

Texts of common characters go through tiktoken with the same vocabulary, which is several
times as fast and gives the same ids. Texts with other characters, where the two libraries'
patterns could differ, with the name of an added token or with very long words go through
tokenizers itself.
"""

from __future__ import annotations

import base64
import os
import re

import numpy as np

UNCOMMON = re.compile("[^\t\n\r\x20-\x7eÀ-ɏ]")
LONG_WORD = 500


class ByteTokenizer:
    def __init__(self, json_file: str, ranks_file: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_file)
        added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.size = self.whole.get_vocab_size()
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        longest = max(map(len, text.split()), default=0)
        if longest > LONG_WORD or UNCOMMON.search(text) or self.added and self.added.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=())


_TOKENIZERS: dict[tuple[str, str, str], ByteTokenizer] = {}


def tokenizer(json_file: str, ranks_file: str, pattern: str) -> ByteTokenizer:
    """One tokenizer a worker process and vocabulary."""
    key = (json_file, ranks_file, pattern)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = ByteTokenizer(*key)
    return _TOKENIZERS[key]
