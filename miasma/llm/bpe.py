"""Byte-level BPE: encoding and decoding by a trie of distinct words.

Text is cut into words by the tokenizer's own rule. The distinct new words of a batch, sorted, form a
byte trie whose states are passed on depth first. The state at a node is the last token of the encoding of the bytes from
the root to it. For a BPE vocabulary that token is unique: it is the one token that
ends there, whose predecessor (the last token where it starts) would stand beside it unmerged. So a
node's state follows from its ancestors' alone, words with a common prefix share the work for it,
and a word's encoding is read back from its last node. No merge list is run over words.

Whether two tokens may stand side by side is found by undoing their merges, latest first, and
looking for an earlier merge across the border; the answer is kept per pair.

Every task works on its own rows: no shuffle, bounded memory (words known and batch size are
limits on memory, not on what is encoded), and a lost task is simply run again. The tokenizer's
file is read on the driver and broadcast; it has a fixed size.

Defined cases: null and empty texts encode to no ids and decode to an empty text; a special token's
text is its one id wherever it stands, as the tokenizer's file says; a word of any length is one
path of the trie; ids that are no token are left out when decoding; bytes that are no UTF-8 decode
to the replacement character; columns named like a result are replaced, all others are kept.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from miasma.llm.common import replaced, slices, texts_of

# The word rule of byte-level BPE, as the format defines it.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_KNOWN_WORDS = 150_000
MAX_PAIRS = 500_000
BATCH_BYTES = 4 << 20  # of texts; their words take many times as much
_END = 256  # a trie key that is no byte


def byte_alphabet() -> dict[str, int]:
    """Character by which the file format spells each byte: itself if printable, else moved up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, how each was merged, and a trie of their reversed bytes."""

    def __init__(self, file: str):
        spec = json.loads(file)
        spelt = byte_alphabet()
        self.bytes = {i: bytes(spelt[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = spec["model"]["vocab"]
        # Rank of the merge that makes a token; single bytes come before all merges.
        self.rank = {i: -1 for i, b in self.bytes.items() if len(b) == 1}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made, pair = ids[left + right], (ids[left], ids[right])
            self.merged[pair] = rank
            self.rank.setdefault(made, rank)
            self.parts.setdefault(made, pair)
        self.beside = Beside(self)
        self.ending: dict = {}
        # Shorter tokens first: a token belongs in the trie if BPE makes it from its own bytes.
        for i in sorted(self.rank, key=lambda i: self.rank[i]):
            if i not in self.parts or self._reached(i):
                node = self.ending
                for b in reversed(self.bytes[i]):
                    node = node.setdefault(b, {})
                node[_END] = i
        self.special_rule = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.text = self.bytes | {i: s.encode() for s, i in self.special.items()}
        self.spelt = {i: str(i) for i in self.text}

    def _reached(self, token: int) -> bool:
        """The token's last merge is the one BPE makes: no earlier merge reaches over its border."""
        left, right = self.parts[token]
        return self._unmerged(left, right, self.rank[token])

    def _unmerged(self, left: int, right: int, limit: float) -> bool:
        """No merge across the border between two tokens comes before ``limit`` or the merges
        that made what is left of them on either side."""
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < limit:
                return False
            a, b = self.rank[left], self.rank[right]
            if a < 0 and b < 0:
                return True
            # The later merge is undone; of two equal ones the right one, as BPE merges from the
            # left. A pair across the border would have come in time if its rank is below that
            # of the undone merge, or equal to it when it lies to its left.
            if a > b:
                limit, left = a, self.parts[left][1]
            else:
                limit, right = b + 0.5, self.parts[right][0]


class Beside(dict):
    """Whether BPE leaves two tokens side by side, by ``left << 32 | right``; kept once found."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, pair: int) -> bool:
        if len(self) > MAX_PAIRS:
            self.clear()
        found = self[pair] = self.vocabulary._unmerged(pair >> 32, pair & 0xFFFFFFFF, float("inf"))
        return found


class Trie:
    """Byte trie of the words of a batch, walked depth first.

    In sorted order a word's path is that of the word before it down to the prefix both share, so
    the walk needs the states of one path only: it is cut back to the shared prefix and grown by the
    rest of the word. Each shared prefix is worked out once.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def encode(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each distinct word with its ids, in byte order."""
        token, size, before = [-1], [0], b""  # by depth: the last token there, and its length
        grow = self._grow
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del token[shared + 1:], size[shared + 1:]
            grow(word, token, size)
            before, ids, at = word, [], len(word)
            while at:
                ids.append(token[at])
                at -= size[at]
            yield word, ids[::-1]

    def _grow(self, word: bytes, token: list[int], size: list[int]) -> None:
        """States of the path from its end down to the whole word. Of the tokens that end at a node,
        found by walking backwards, it is the one that BPE leaves beside the last token of what comes
        before it."""
        ending, beside = self.vocabulary.ending, self.vocabulary.beside
        for end in range(len(token), len(word) + 1):
            inner, start = ending, end
            while start and (inner := inner.get(word[start - 1])) is not None:
                start -= 1
                found = inner.get(_END)
                if found is not None and (not start or beside[token[start] << 32 | found]):
                    token.append(found)
                    size.append(end - start)
                    break
            else:
                raise ValueError("the vocabulary does not cover a byte")


class Encoder:
    """Encodes batches of texts; words once encoded are remembered up to a limit."""

    def __init__(self, file: str):
        self.vocabulary = Vocabulary(file)
        self.rule = regex.compile(WORD_RULE)
        self.known: dict[str, tuple[int, str, bytes, bytes]] = {}
        self.trie = Trie(self.vocabulary)

    def cut(self, text: str) -> list[str]:
        """Words and special tokens in order."""
        special = self.vocabulary.special_rule
        at, words = 0, []
        for m in special.finditer(text):
            words += self.rule.findall(text[at:m.start()])
            words.append(m[0])
            at = m.end()
        return words + self.rule.findall(text[at:] if at else text)

    def learn(self, words: set[str]) -> None:
        """Encode words not known yet: number of ids, their spelling, the bytes they decode to, and
        the ids as 32-bit numbers."""
        special, text, spelt, known = self.vocabulary.special, self.vocabulary.text, self.vocabulary.spelt, self.known
        new = words.difference(known)
        whole = new.intersection(special)

        def keep(word: str, ids: list[int]) -> None:
            known[word] = (len(ids), ",".join([spelt[i] for i in ids]), b"".join([text[i] for i in ids]),
                           array("i", ids).tobytes())

        for w in whole:
            keep(w, [special[w]])
        for w, ids in self.trie.encode(map(str.encode, new - whole)):
            keep(w.decode(), ids)

    def batch(self, texts: list[str]) -> Iterator[list[tuple[int, str, bytes, bytes]]]:
        """The known entries of each text's words."""
        cut = [self.cut(t) for t in texts]
        words = set().union(*cut) if cut else set()
        if len(self.known) > MAX_KNOWN_WORDS:  # those at hand stay
            self.known = {w: self.known[w] for w in words if w in self.known}
        self.learn(words)
        for words in cut:
            yield [self.known[w] for w in words]


OUTPUTS = {"n_tokens": (T.LongType(), pa.int64()), "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
           "ids_sha256": (T.StringType(), pa.string()), "decoded_sha256": (T.StringType(), pa.string())}


def _output(name: str, rows: list[list[tuple[int, str, bytes, bytes]]]) -> pa.Array:
    """One result column of a batch, out of the entries of each text's words."""
    if name == "n_tokens":
        found = [sum([e[0] for e in entries]) for entries in rows]
    elif name == "ids":
        packed = [b"".join([e[3] for e in entries]) for entries in rows]
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
    elif name == "ids_sha256":
        found = [hashlib.sha256(",".join([e[1] for e in entries]).encode()).hexdigest() for entries in rows]
    else:
        found = [hashlib.sha256(b"".join([e[2] for e in entries]).decode("utf-8", "replace").encode()).hexdigest()
                 for entries in rows]
    return pa.array(found, OUTPUTS[name][1])


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", outputs=("n_tokens", "ids"),
           batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """All rows and columns, with the ``OUTPUTS`` asked for: the number of ids, the ids, the
    SHA-256 of the ids joined by commas, the SHA-256 of the text they decode to.

    ``tokenizer`` is the path of a tokenizer file on the driver. Words are encoded together for
    ``batch_bytes`` of texts; less takes less memory and more time.
    """
    file = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    names = list(outputs)
    schema = T.StructType([f for f in docs.schema.fields if f.name.lower() not in names]
                          + [T.StructField(n, OUTPUTS[n][0]) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(file.value)
        for batch in slices(batches, text_col, batch_bytes):
            texts = [t.decode("utf-8", "replace") for t in texts_of(batch.column(text_col))]
            rows = list(encoder.batch(texts))
            yield replaced(batch, names, [_output(n, rows) for n in names])

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """All rows and columns, with ``decoded``: the text of the ids, null ids as an empty text."""
    file = rows.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    schema = T.StructType([f for f in rows.schema.fields if f.name.lower() != "decoded"]
                          + [T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = Vocabulary(file.value).text
        for batch in batches:
            out = [b"".join(text.get(i, b"") for i in ids or []).decode("utf-8", "replace")
                   for ids in batch.column(ids_col).to_pylist()]
            yield replaced(batch, ["decoded"], [pa.array(out, pa.string())])

    return rows.mapInArrow(run, schema)
