"""BPE encoding by a trie of words: last tokens flow from each prefix to the longer ones.

A prefix of a BPE encoding is itself the encoding of the text it covers, and a row of tokens is
the encoding of its text exactly if each pair of neighbours is the encoding of the pair's text.
So the encoding of a word is known from one token for each of its prefixes, the last one: cut
that token off, and the last token of the shorter prefix follows. New words of a batch go into a
trie; a walk from the root finds the last token of each node once, however many words share it.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.byte_bpe import byte_signs
from clickloom.llm.common import map_rows, slices, text_of

# A worker remembers the encodings of so many pieces of text, and of judged pairs of tokens.
REMEMBERED = 800_000
LONGEST_REMEMBERED = 64
REMEMBERED_PAIRS = 1_000_000


class WordBpe:
    """A word-level BPE vocabulary of the tokenizers library, and its encoder by trie."""

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            written = json.load(file)
        model = written["model"]
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocabulary: dict[str, int] = model["vocab"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.texts = {number: text for text, number in self.vocabulary.items()}
        added = {token["content"]: token["id"] for token in written["added_tokens"]}
        self.texts.update({number: text for text, number in added.items()})
        self.added = added
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, added)) + ")")
        self.added_signs = tuple(sorted({content[:2] for content in added}))
        # Beginnings of tokens, true for tokens that the merges make of their own text.
        self._prefixes: dict[str, bool] = {}
        self._pairs: dict[str, bool] = {}
        self._bytes = byte_signs()
        self.pieces: dict[str, bytes] = {}
        for token in self.vocabulary:
            for size in range(1, len(self._symbols(token))):
                self._prefixes.setdefault(token[:size], False)
        self._prefixes.update({token: True for token in self.vocabulary if self._stands(token)})

    # --- merges of a short text, to judge a token or a pair of tokens -------
    def _symbols(self, text: str) -> list[str]:
        if self.suffix and text.endswith(self.suffix) and len(text) > len(self.suffix):
            inner = text[: -len(self.suffix)]
            return [*inner[:-1], inner[-1] + self.suffix]
        return [*text]

    def _merged(self, symbols: list[str]) -> list[str]:
        ranks = self.ranks
        while len(symbols) > 1:
            best, at = min(
                (ranks.get((symbols[i], symbols[i + 1]), len(ranks)), i)
                for i in range(len(symbols) - 1)
            )
            if best == len(ranks):
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _stands(self, token: str) -> bool:
        return self._merged(self._symbols(token)) == [token]

    def _fits(self, left: str, right: str) -> bool:
        if len(self._pairs) > REMEMBERED_PAIRS:
            self._pairs.clear()
        merged = self._merged([*left, *self._symbols(right)])
        known = self._pairs[left + " " + right] = merged == [left, right]
        return known

    # --- the trie ------------------------------------------------------------
    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Packed token ids of distinct words (in byte signs), from one trie for all of them.

        Inner nodes are dictionaries by sign. A word ends in a leaf under its last sign and the
        end-of-word suffix (always told apart from an inner sign by a leading blank)."""
        suffix, vocabulary = self.suffix, self.vocabulary
        trie: dict = {}
        for word in words:
            node = trie
            for sign in word[:-1]:
                below = node.get(sign)
                if below is None:
                    below = node[sign] = {}
                node = below
            node[" " + word[-1]] = word
        found: dict[str, bytes] = {}
        deepest = max(map(len, words), default=0) + 1
        # By depth along the path from the root: the last token, and the signs it covers.
        tokens, covers = [""] * deepest, [0] * deepest
        prefixes, pairs = self._prefixes, self._pairs
        # A node: what is below it, the text from the root, its depth, and the starts from which
        # its parent's text is the beginning of some token.
        stack: list = [(trie, "", 0, [])]
        while stack:
            below, text, depth, starts = stack.pop()
            ends = type(below) is str
            live = []
            if depth:
                first, last = 0, ""
                if ends:
                    text += suffix
                for start in starts:
                    token = text[start:]
                    kind = prefixes.get(token)
                    if kind is None:
                        continue
                    live.append(start)
                    if kind and not last:
                        if start == 0:
                            last = token
                        else:
                            fits = pairs.get(tokens[start] + " " + token)
                            if self._fits(tokens[start], token) if fits is None else fits:
                                first, last = start, token
                if not last:  # a sign without a token of its own; it is left out below
                    first, last = depth - 1, text[depth - 1 :]
                tokens[depth], covers[depth] = last, depth - first
            if ends:
                ids, at = [], depth
                while at:
                    number = vocabulary.get(tokens[at])
                    if number is not None:
                        ids.append(number)
                    at -= covers[at]
                ids.reverse()
                found[below] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                live.append(depth)
                depth += 1
                for sign, child in below.items():
                    stack.append((child, text + sign[-1], depth, live))
        return found

    # --- texts ---------------------------------------------------------------
    def _split(self, piece: str) -> list[str]:
        """Words of a piece without added tokens, in byte signs."""
        if _PLAIN.fullmatch(piece):
            words = _PLAIN_WORDS.findall(piece.lower())
            signs = self._bytes
            return [
                word if word.isascii() else "".join([signs[b] for b in word.encode()])
                for word in words
            ]
        normal = self.normalizer.normalize_str(piece)
        return [word for word, _ in self.splitter.pre_tokenize_str(normal)]

    def _parts(self, piece: str) -> list[str | int]:
        if any(sign in piece for sign in self.added_signs):
            parts: list[str | int] = []
            for text in self.added_pattern.split(piece):
                parts += [self.added[text]] if text in self.added else self._split(text)
            return parts
        return self._split(piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [_SPACE.split(text) for text in texts]
        known = self.pieces
        fresh = set().union(*split).difference(known)
        parts = {piece: self._parts(piece) for piece in fresh}
        words = {word for some in parts.values() for word in some if type(word) is str}
        # A plain word may be known as a piece of its own.
        ids = {word: known[word] for word in words if word in known and word.isascii()}
        ids.update(self.encode_words([*words.difference(ids)]))
        found = {
            piece: b"".join(
                [ids[part] if type(part) is str else struct.pack("<I", part) for part in some]
            )
            for piece, some in parts.items()
        }
        if len(known) < REMEMBERED:
            known.update(
                (piece, packed)
                for piece, packed in found.items()
                if len(piece) <= LONGEST_REMEMBERED
            )
        encoded = []
        for pieces in split:
            try:
                encoded.append(b"".join([known[piece] for piece in pieces]))
            except KeyError:
                encoded.append(
                    b"".join([found[p] if p in found else known[p] for p in pieces])
                )
        return encoded

    def decode(self, packed: bytes) -> str:
        """The tokens' texts with a space between, as the library does without a decoder."""
        texts = self.texts
        return " ".join([texts[number] for number in np.frombuffer(packed, "<u4").tolist()])


# White space that both the library and Python see as such, and that no word holds.
_SPACE = re.compile("[ \t\n\r]+")
# Pieces whose words need no Unicode tables: printable ASCII and the letters of Latin-1.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
_PLAIN_WORDS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+"
)


_LOADED: dict[str, WordBpe] = {}


def vocabulary(path: str) -> WordBpe:
    """One instance in each worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_and_decode(
    frame: DataFrame, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Key, ``ids`` (binary: little-endian unsigned 32-bit integers) and ``decoded`` (their text).

    One row per row, in no shuffle. A null text counts as empty and gives no ids and an empty
    decoded text; null or repeated keys are kept as they are; other columns are ignored. The
    vocabulary file must be at ``path`` on each executor.
    """
    columns = frame.select(F.col(key), text_of(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in slices(batches, 1):
            packed = bpe.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(packed, pa.binary()),
                    pa.array([bpe.decode(ids) for ids in packed], pa.string()),
                ],
                names=[key, "ids", "decoded"],
            )

    kind = columns.schema[0].dataType.simpleString()
    return map_rows(columns, f"`{key}` {kind}, ids binary, decoded string", work)
