"""Byte-pair encoding of whole texts by forced boundaries, and decoding.

A pair of adjacent bytes that occurs inside no token of the vocabulary can never be joined, so
the place between the two bytes is a certain token boundary. Where such a pair is a non-blank
character followed by a space, it is also a boundary of the word pattern whatever stands around
it: no alternative of the pattern reaches from a non-blank character into white space, only
white space is matched by looking ahead, and nothing looks back. Texts are cut at such places,
the fragments are encoded independently and their ids are concatenated.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from entityfold.llm.common import add_columns

# Fixed value: the word pattern of byte-level vocabularies that name no pattern of their own.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_PATTERN = WORD_PATTERN.replace(r"\s+(?!\S)|", "")
FRAGMENT = 4096


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes(path: str) -> dict[int, bytes]:
    """The bytes of every id, added tokens included."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    alphabet = byte_alphabet()
    out = {i: bytes(alphabet[c] for c in token) for token, i in model["model"]["vocab"].items()
           if all(c in alphabet for c in token)}
    return out | {t["id"]: t["content"].encode() for t in model["added_tokens"]}


def joined_pairs(tokens: dict[int, bytes]) -> np.ndarray:
    """A 256 x 256 table: true where two bytes stand side by side inside some token."""
    inside = np.zeros((256, 256), bool)
    for token in tokens.values():
        for a, b in zip(token, token[1:], strict=False):
            inside[a, b] = True
    return inside


def sure_ends(inside: np.ndarray) -> frozenset[str]:
    """The non-blank characters that form a forced pair with a space that follows.

    Python counts a few more characters as blank than the word pattern does; they only make
    fewer cuts.
    """
    plain = (chr(c) for c in range(33, 0x3000))
    return frozenset(c for c in plain if not c.isspace() and not inside[c.encode()[-1], 0x20])


def _ranks(path: str) -> dict[bytes, int] | None:
    """Bytes to id, if the ids are also the order of the merges and a plain byte-level model."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    odd = spec["normalizer"] or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback")
    if model.get("type") != "BPE" or not byte_level or odd:
        return None
    vocab, alphabet = model["vocab"], byte_alphabet()
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    added = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in added}
    ordered = all(a < b for a, b in zip(merged, merged[1:], strict=False))
    return ranks if ordered and len(set(merged)) + 256 == len(ranks) else None


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit), for one task.

    A fragment in which no white space follows white space matches the same words without the
    pattern's look-ahead, which costs a third of the time; it is encoded without. All other
    fragments, and those with the text of an added token, are encoded with the full pattern.
    """

    def __init__(self, path: str):
        ranks = _ranks(path)
        self.cuts = ranks is not None
        if ranks is None:  # nothing is known of where such a model may be cut
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.full = lambda text: np.array(model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            return
        sure = "".join(map(re.escape, sorted(sure_ends(joined_pairs(token_bytes(path))))))
        self.boundary = re.compile(f"(?<=[{sure}]) ")
        with open(path, encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self.runs = ("  ", "\n\n", " \n", "\n ", *added)
        self.blank = re.compile("[" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n") + "]")
        full = tiktoken.Encoding("full", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=added)
        plain = tiktoken.Encoding("plain", pat_str=PLAIN_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.full = lambda text: full.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        self.plain = lambda text: plain.encode_to_numpy(text).astype("<u4").tobytes()

    def fragments(self, text: str) -> list[str]:
        """The text, cut at the first forced boundary after every ``FRAGMENT`` characters."""
        out, start = [], 0
        while len(text) - start > FRAGMENT and (found := self.boundary.search(text, start + FRAGMENT)):
            out.append(text[start : found.start()])
            start = found.start()
        return [*out, text[start:]]

    def encode(self, text: str | None) -> bytes:
        if not self.cuts:
            return self.full(text or "")
        return b"".join(self.full(f) if self.odd(f) else self.plain(f) for f in self.fragments(text or ""))

    def odd(self, fragment: str) -> bool:
        """White space other than single spaces and line feeds, or an added token."""
        return any(run in fragment for run in self.runs) or self.blank.search(fragment) is not None


class Decoder:
    """Ids to text; bytes that are no UTF-8 become replacement characters."""

    def __init__(self, path: str):
        known = token_bytes(path)
        self.tokens = [known.get(i, b"") for i in range(max(known) + 1)]

    def decode(self, ids: bytes | None) -> str:
        get = self.tokens.__getitem__
        return b"".join(map(get, np.frombuffer(ids or b"", "<u4").tolist())).decode("utf-8", "replace")


def encode(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``ids``: the token ids of the whole text, four bytes each.

    A null text is an empty one and has no ids. Repeated rows give repeated rows. Columns that
    are not asked for are not read; a kept column must not be called ``ids``.
    """

    def make():
        encoder = Encoder(path)
        return lambda texts: [[encoder.encode(t) for t in texts]]

    return add_columns(df, keep, (text,), "ids binary", make)


def decode(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id", "ids")) -> DataFrame:
    """The columns ``keep`` and ``decoded``: the text of the ids; null ids give an empty text."""

    def make():
        decoder = Decoder(path)
        return lambda values: [[decoder.decode(v) for v in values]]

    return add_columns(df, keep, (ids,), "decoded string", make)


def round_trip(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``encode`` and ``decode`` in one pass: the columns ``keep``, ``ids`` and ``decoded``."""

    def make():
        encoder, decoder = Encoder(path), Decoder(path)

        def run(texts: list[str | None]) -> list:
            ids = [encoder.encode(t) for t in texts]
            return [ids, [decoder.decode(i) for i in ids]]

        return run

    return add_columns(df, keep, (text,), "ids binary, decoded string", make)
