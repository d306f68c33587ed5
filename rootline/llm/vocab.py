"""Byte-level BPE vocabularies from files of public tokenizers; each Python worker loads a file once."""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import regex
import tiktoken

#: What Unicode calls white space, as the tokenizers' pattern means it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_LONG_RUN = regex.compile(rf"[{WHITE}]{{10000}}")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Bytes of each token -> its id, from a .tiktoken file or from the vocabulary of a tokenizers .json file."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        special = {x["content"] for x in data.get("added_tokens", [])}
        letters = _byte_letters()
        return {bytes(letters[c] for c in k): v for k, v in data["model"]["vocab"].items() if k not in special}
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def pieces_of(pattern: str) -> regex.Pattern:
    """The pattern that splits text, with Unicode's white space spelt out."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


def encode(text: str, path: str, pattern: str) -> list[int]:
    """The ids of a text; special tokens' strings are ordinary text."""
    enc = encoder(path, pattern)
    if _LONG_RUN.search(text) is None:
        return enc.encode_ordinary(text)
    # the library's regex overflows its stack on very long runs of white space; the split is the same piece by piece
    return [i for x in pieces_of(pattern).findall(text) for i in enc._encode_single_piece(x)]


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The token-byte table: the bytes at each id."""
    own = ranks(path)
    out = [b""] * (max(own.values(), default=-1) + 1)
    for k, v in own.items():
        out[v] = k
    return out
