"""Token ids of the public byte-level tokenizer."""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import tiktoken

END = 0  # id after each document
TOKENIZER = "byte_bpe_50k.json"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@functools.cache
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of a byte-level ``tokenizers`` file (ids in merge order)
    for tiktoken's faster encoder; ids are the same, and strings
    of special tokens give those tokens, as they do there by default."""
    import public_tokenizers

    # The visible stand-ins that byte-level vocabularies use for bytes.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    special = {t["content"]: t["id"] for t in content.get("added_tokens", ())}
    ranks = {
        bytes(byte_of[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in special
    }
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def ids_of(text: str | None, enc: tiktoken.Encoding) -> np.ndarray:
    """The ids of a text (null: none) and the end, unsigned 32-bit."""
    return np.append(enc.encode_to_numpy(text or "", allowed_special="all"), np.uint32(END))


def pieces(ids: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(piece, start, ids): pieces of ``size``, the first one shorter."""
    first = (len(ids) - 1) % size + 1
    edges = [0, *range(first, len(ids) + 1, size)]
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        yield k, a, ids[a:b]


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
