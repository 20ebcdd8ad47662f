"""Token ids of the public BPE files, as the tokenizers library gives them, at corpus speed.

Prose repeats its words, so ids are kept per white-space chunk in a bounded table; a
chunk not seen before is merged by tiktoken with the file's own vocabulary.  Texts with
anything unusual (special tokens, control characters, scripts beyond Latin) go to the
tokenizers library as a whole.  Ids come packed as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Entries kept in each table of a worker, about 200 bytes each; of chunks of a word vocabulary more, as each text brings new ones.
KEPT, KEPT_CHUNKS = 300_000, 1_000_000
#: Characters for which all libraries agree on case, classes and normal form.
PLAIN = re.compile("[^\t-\r -~\xa0-įı-ɏ‐-‧‰-›]|<\\|")
#: The pre-tokenizer pattern of byte_bpe_50k.json.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = "\0"


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def token_bytes(token: str, suffix: str | None, end: bytes, table: dict[str, int]) -> bytes:
    last = bool(suffix) and token.endswith(suffix) and len(token) > len(suffix)
    return bytes(table[c] for c in (token[: -len(suffix)] if last else token)) + (end if last else b"")


class Encoder:
    """``encode(texts)`` gives the packed ids of each whole text, without added special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        model, table = spec["model"], byte_of_char()
        suffix = model["end_of_word_suffix"]
        merged = [model["vocab"][a + b] for a, b in model["merges"]]
        if merged != sorted(set(merged)):
            raise ValueError(f"{path}: ids don't follow the merges")
        ranks = {token_bytes(t, suffix, END.encode(), table): i for t, i in model["vocab"].items()}
        self.by_word, self.kept, self.line_id = bool(suffix), {}, ranks[b"\n"]
        if self.by_word:
            self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        pattern = f"[^{END}\n]+{END}|\n" if self.by_word else BYTE_PATTERN
        self.merge = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [PLAIN.search(t) is not None for t in texts]
        if not self.by_word:
            return [self._by_library(t) if o else self.merge(t).tobytes() for t, o in zip(texts, odd, strict=True)]
        chunks = [[] if o else t.lower().split() for t, o in zip(texts, odd, strict=True)]
        made = self._keep(set().union(*chunks))
        try:
            ids = self.kept.__getitem__
            return [self._by_library(t) if o else b"".join(map(ids, c)) for t, o, c in zip(texts, odd, chunks, strict=True)]
        finally:
            if len(self.kept) > KEPT_CHUNKS:
                for c in made:
                    del self.kept[c]

    def _by_library(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def _keep(self, chunks: set[str]) -> list[str]:
        """Put the packed ids of each chunk into ``kept`` and return the new chunks; these are merged in one go, a line each."""
        new = list(chunks.difference(self.kept))
        if new:
            got = self.merge(self.split.sub("\\g<0>" + END, "\n".join(new)) + "\n")
            ends, data = (np.flatnonzero(got == self.line_id) * 4).tolist(), got.tobytes()
            self.kept.update(zip(new, map(data.__getitem__, map(slice, [0, *(x + 4 for x in ends[:-1])], ends)), strict=True))
        return new


@cache
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
