"""Exact ids of a byte-level BPE tokenizer file.

The tokenizer library itself is the rule. Texts of common characters, on whose
classes all Unicode versions agree, are encoded several times faster by a
second library from the same vocabulary and the same pre-tokenizer pattern
(byte-level BPE has no other setting); all other texts, and texts that hold a
special token's string, go to the tokenizer.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The pre-tokenizer pattern of byte-level BPE; fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: ASCII, Latin, Greek and Cyrillic letters, general punctuation, kana, Han, Hangul.
COMMON = re.compile("[\t-\r\x20-\x7e\xa1-\xac\xae-ȠΆ-ΡΣ-ώЀ-ҁҌ-ӹ"
                    "‐-‧‰-⁞₠-₵、-〺ぁ-ゖァ-ヾ一-龥가-힣！-～]*")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        self.fast = None
        if (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel"
                and not before.get("add_prefix_space") and before.get("use_regex", True)):
            import tiktoken
            byte = _byte_of_char()
            ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
            self.fast = tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def raw(self, text: str) -> np.ndarray:
        """The tokenizer's own answer."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, without special tokens."""
        if self.fast is None or not COMMON.fullmatch(text) or self.special and self.special.search(text):
            return self.raw(text)
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")


_SHARED: dict[str, Encoder] = {}


def shared(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _SHARED:
        _SHARED[path] = Encoder(path)
    return _SHARED[path]
