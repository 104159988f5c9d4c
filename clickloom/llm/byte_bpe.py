"""Byte-level BPE from a file of the tokenizers library, with the places where sentences end.

The file's ids are in the order of its merges, so they are ranks too, and the ranks' own encoder
gives the same ids several times faster. Strings of added tokens in a text are their tokens.
"""

from __future__ import annotations

import json

import numpy as np

# The splitting pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_signs() -> list[str]:
    """The sign of each byte: printable ones of Latin-1 stand for themselves, the others follow
    from U+0100 on."""
    signs, spare = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            signs.append(chr(byte))
        else:
            signs.append(chr(spare))
            spare += 1
    return signs


class ByteBpe:
    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            written = json.load(file)
        vocabulary = written["model"]["vocab"]
        order = [vocabulary["".join(pair)] for pair in written["model"]["merges"]]
        if order != sorted(order) or written["normalizer"] is not None:
            raise ValueError(f"{path}: ids aren't in the order of the merges")
        byte_of = {sign: byte for byte, sign in enumerate(byte_signs())}
        added = {token["content"]: token["id"] for token in written["added_tokens"]}
        ranks = {
            bytes([byte_of[sign] for sign in token]): number
            for token, number in vocabulary.items()
            if token not in added
        }
        self.encoding = tiktoken.Encoding(
            "byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
        self.path = path
        self.sizes = np.zeros(max([*ranks.values(), *added.values()]) + 1, np.int64)
        for token, number in [*ranks.items(), *((k.encode(), v) for k, v in added.items())]:
            self.sizes[number] = len(token)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and how many of them each sentence's end has before it.

        A sentence ends with a full stop, exclamation or question mark before a blank or a new
        line, where a token always ends too."""
        try:
            found = self.encoding.encode(text, allowed_special="all")
        except ValueError:  # its pattern can't go back over a very long run of white space
            from tokenizers import Tokenizer

            found = Tokenizer.from_file(self.path).encode(text, add_special_tokens=False).ids
        ids = np.array(found, dtype="<u4")
        signs = np.frombuffer(text.encode(), np.uint8)
        ends = np.flatnonzero(_STOPS[signs[:-1]] & _BLANKS[signs[1:]]) + 1
        return ids, np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1


_STOPS = np.isin(np.arange(256), list(b".!?"))
_BLANKS = np.isin(np.arange(256), list(b" \n"))

_LOADED: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """One instance in each worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]
