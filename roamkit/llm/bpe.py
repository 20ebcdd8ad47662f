"""BPE by forced boundaries: certain cuts first, then each fragment on its own.

Two neighbouring symbols that stand side by side inside no vocabulary token can never end
up in one token, whatever is merged around them.  Cutting there is safe; the fragments are
merged independently (lowest rank first, as the file orders its merges) and their ids
concatenated.  Fragments are short and repeat, so their ids, and those of whole chunks
between white space, are kept in bounded tables.  Decoding joins the tokens' strings.

For files of the kind of word_bpe_49k.json: NFC, white space to one space, lower case, a
split pattern, bytes written as characters, word-end suffix, no decoder.  Where a text has
characters on which Unicode tables of different age disagree, the library's own normalizer
and pre-tokenizer say what its words are; they are cut and merged here all the same.

Defined cases: NULL text counts as empty: no ids, and the empty string decoded; special
tokens written in a text become their ids; repeated rows are returned as often as they
occur; an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roamkit.llm.shared import python_tasks
from roamkit.llm.tokens import KEPT, PLAIN, byte_of_char


class ForcedBoundaryBpe:
    def __init__(self, spec: dict):
        model = spec["model"]
        self.suffix, self.vocab = model["end_of_word_suffix"], model["vocab"]
        self.rank = {tuple(pair): k for k, pair in enumerate(model["merges"])}
        self.char_of = {b: c for c, b in byte_of_char().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in (self.vocab | self.special).items()}
        self.special_split = regex.compile("(" + "|".join(sorted(map(regex.escape, self.special), key=len, reverse=True)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.library = Tokenizer.from_str(json.dumps(spec))
        #: Symbol pairs that some token holds side by side; any other pair is a cut.
        self.joined = {pair for t in self.vocab for s in [self.symbols_of_token(t)] for pair in zip(s, s[1:])}
        self.fragments: dict[tuple[str, ...], tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[int, bytes, bytes]] = {}

    def symbols_of_token(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def merge(self, fragment: tuple[str, ...]) -> tuple[int, ...]:
        """Merge the pair of lowest rank, from the left, until none is left."""
        parts, rank = list(fragment), self.rank
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: rank.get(p, len(rank)))
            if best not in rank:
                break
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == best:
                    out.append(parts[k] + parts[k + 1])
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return tuple(self.vocab[p] for p in parts)

    def fragment_ids(self, fragment: tuple[str, ...]) -> tuple[int, ...]:
        ids = self.fragments.get(fragment)
        if ids is None:
            ids = self.merge(fragment)
            if len(self.fragments) < KEPT:
                self.fragments[fragment] = ids
        return ids

    def word_ids(self, word: str) -> list[int]:
        return self.symbol_ids([self.char_of[b] for b in word.encode()])

    def symbol_ids(self, symbols: list[str]) -> list[int]:
        """Ids of a word given as the characters that its bytes are written as."""
        symbols[-1] += self.suffix
        joined, out, begin = self.joined, [], 0
        for k in range(1, len(symbols)):
            if (symbols[k - 1], symbols[k]) not in joined:
                out += self.fragment_ids(tuple(symbols[begin:k]))
                begin = k
        return out + list(self.fragment_ids(tuple(symbols[begin:])))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        ids: list[int] = []
        for k, part in enumerate(self.special_split.split(text) if self.special_split else [text]):
            if k % 2:
                ids.append(self.special[part])
            else:
                words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                ids += chain.from_iterable(self.symbol_ids(list(word)) for word, _ in words)
        return ids

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.token[i] for i in ids)

    def written(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        """How many, the decimal ids and the decoded text."""
        return len(ids), " ".join(map(str, ids)).encode(), self.decode(ids).encode()

    def chunk(self, chunk: str) -> tuple[int, bytes, bytes]:
        got = self.chunks.get(chunk)
        if got is None:
            got = self.written(list(chain.from_iterable(map(self.word_ids, self.words.findall(chunk)))))
            if len(self.chunks) < KEPT:
                self.chunks[chunk] = got
        return got

    def round_trip(self, text: str) -> tuple[int, bytes, bytes]:
        """Number of ids, decimal ids joined by a space, decoded text."""
        if PLAIN.search(text):
            return self.written(self.encode(text))
        chunks = text.lower().split()
        if not chunks:
            return 0, b"", b""
        n, ids, decoded = zip(*map(self.chunk, chunks), strict=True)
        return sum(n), b" ".join(ids), b" ".join(decoded)


@cache
def codec(path: str) -> ForcedBoundaryBpe:
    """One per worker process and file."""
    with open(path, encoding="utf-8") as f:
        return ForcedBoundaryBpe(json.load(f))


def round_trips(docs: DataFrame, vocabulary: str, also: str = "", row=lambda n, ids, decoded: {}) -> DataFrame:
    """doc_id, n_tokens and the columns that ``row`` makes of (n, decimal ids, decoded); ``also``: their types."""
    python_tasks(docs.sparkSession)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trip = codec(vocabulary).round_trip
        for pdf in batches:
            got = [{"n_tokens": t[0]} | row(*t) for t in map(trip, pdf["text"])]
            out = pd.DataFrame(got, columns=names)
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    schema = "n_tokens long" + (f", {also}" if also else "")
    names = [x.split()[0] for x in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(work, f"doc_id long, {schema}")


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The operator's own output: ids as decimal numbers and the decoded text of each document."""
    return round_trips(docs, vocabulary, "ids string, decoded string", lambda n, ids, decoded: {"ids": ids.decode(), "decoded": decoded.decode()})


def op4(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The registered query."""
    digest = lambda x: hashlib.sha256(x).hexdigest()
    return round_trips(docs, vocabulary, "ids_sha256 string, decoded_sha256 string", lambda n, ids, decoded: {"ids_sha256": digest(ids), "decoded_sha256": digest(decoded)})
