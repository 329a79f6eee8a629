"""Token ids of whole texts, with the vocabulary files of public tokenizers."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

import numpy as np

# The split pattern of byte-level vocabularies, and the characters that stand for bytes in their files
# (printable ones for themselves, the others in order from 256 on).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
LONG_SPACE = 50_000


# What a vocabulary with word ends drops between its words, how it splits, and the end of a word.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0D\x20a-z0-9]+")
WORD_END = "</w>"
END_MARK = "\0"  # stands for a word's end; texts that hold it are encoded by ``tokenizers``


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, those of ``tokenizers`` for the given file as it is loaded.

    Strings of special tokens in a text become those tokens. Where the file is a plain byte-level BPE whose ids are in the
    order of its merges, ``tiktoken`` gives the same ids from the same vocabulary several times as fast, and is used.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ranks = byte_ranks(path)
        self.fast = None
        self.special = [token["content"] for token in _spec(path).get("added_tokens", [])]
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.fast is None:
            return [self._ids(found.ids) for found in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return [self._ids(self.fast.encode_ordinary(t)) if self._fits(t) else self.encode_whole(t) for t in texts]

    def encode_whole(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _fits(self, text: str) -> bool:
        """False for a text with a special token's string, or with white space so long that the fast encoder's pattern
        matcher runs out of stack."""
        if any(token in text for token in self.special):
            return False
        return len(text) < LONG_SPACE or not re.search(rf"\s{{{LONG_SPACE}}}", text)

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()


class WordEncoder(Encoder):
    """The same for a lower-case vocabulary whose tokens know the end of a word, and which drops white space.

    Texts are split into words here. A word with a mark after it is a string of bytes of which ``tiktoken`` merges pairs in
    the order of the file: the mark joins the last byte first, as the file has those pairs before all others.
    """

    def __init__(self, path: str):
        import regex

        super().__init__(path)
        ranks = word_ranks(path)
        self.words = regex.compile(WORD_PATTERN.replace(r"\s", r"\p{White_Space}"))
        self.fast = None
        if ranks:
            import tiktoken

            pattern = f"[^{END_MARK}]+{END_MARK}"
            self.fast = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.fast is None:
            return super().encode(texts)
        return [self._ids(self.fast.encode_ordinary(self._marked(t))) if self._fits(t) else self.encode_whole(t) for t in texts]

    def _fits(self, text: str) -> bool:
        if END_MARK in text or any(token in text for token in self.special):
            return False
        # Characters newer than this Python may be letters for one library and not for the other.
        return text.isascii() or all(unicodedata.category(c) != "Cn" for c in set(text))

    def _marked(self, text: str) -> str:
        if text.isascii():
            words = ASCII_WORDS.findall(text.lower())
        else:
            words = self.words.findall(self.tokenizer.normalizer.normalize_str(text))
        return END_MARK.join([*words, ""])


def word_ranks(path: str) -> dict[bytes, int] | None:
    """Ranks of the byte strings, marked at word ends, of a byte-level BPE file with word ends; None for any other file."""
    spec = _spec(path)
    model, split = spec["model"], json.dumps(spec.get("pre_tokenizer"))
    if model["type"] != "BPE" or model.get("end_of_word_suffix") != WORD_END or json.dumps(WORD_PATTERN) not in split:
        return None
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if any(model["vocab"].get(merge) != i for i, merge in enumerate(merges, 512)):
        return None
    special = {token["content"] for token in spec.get("added_tokens", [])}
    ranks = {}
    for token, i in model["vocab"].items():
        if token not in special:
            ended = token.endswith(WORD_END) and token != WORD_END
            body = token.removesuffix(WORD_END) if ended else token
            ranks[bytes(map(_byte_of().get, body)) + (END_MARK.encode() if ended else b"")] = i
    return ranks


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@cache
def _byte_of() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_ranks(path: str) -> dict[bytes, int] | None:
    """Ranks of the byte strings of a plain byte-level BPE file; None for any other file."""
    spec = _spec(path)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if model["type"] != "BPE" or spec.get("normalizer") or any(split.get(k) != v for k, v in plain.items()):
        return None
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if any(model["vocab"].get(merge) != i for i, merge in enumerate(merges, 256)):
        return None
    byte_of = _byte_of()
    special = {token["content"] for token in spec.get("added_tokens", [])}
    return {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Encoder(path) if word_ranks(path) is None else WordEncoder(path)
