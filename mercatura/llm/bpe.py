"""Byte-level BPE, encoding and decoding, with shared prefixes encoded once.

The state of a prefix is the last token of its encoding. It is the one token that ends the
prefix and that merging would leave apart from the last token of what stands before it, so
a state follows from the states of shorter prefixes. Distinct words of a batch form a trie:
in sorted order, its nodes come depth first, and the states on the path of common
characters are those of the word before. A word's tokens are read off its path backwards.

Texts are split into words by the vocabulary's own pattern; special tokens found in a text
stand for themselves. The vocabulary file's path is a parameter: the driver reads it and a
broadcast of its bounded size (about 1.4 MB) carries it to the executors.

Defined results: a null text is empty and has no tokens. Any text, of any length, is
encoded whole; the words kept between batches are bounded in number and length. Ids outside the
vocabulary are an error. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mercatura.llm.common import free_name, small_batches

# How byte-level vocabularies split a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

KEPT_WORDS = 200_000
"""Encodings a worker keeps between batches."""
KEPT_BYTES = 64
"""Longest word whose encoding is kept."""
KEPT_PAIRS = 200_000
"""Answers about neighbouring tokens that a worker keeps."""


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, content: bytes) -> None:
        file = json.loads(content)
        alphabet = byte_alphabet()
        model = file["model"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        in_bytes = {
            token: bytes(alphabet[c] for c in token)
            for token in model["vocab"]
            if token not in self.special
        }
        self.token_bytes = {model["vocab"][t]: b for t, b in in_bytes.items()}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        ids = {b: model["vocab"][t] for t, b in in_bytes.items()}
        self.rank: dict[int, int] = {i: -1 for i in ids.values()}
        self.split: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = (ids[in_bytes[left]], ids[in_bytes[right]])
            merged = ids[in_bytes[left] + in_bytes[right]]
            self.merges[pair] = rank
            self.rank[merged], self.split[merged] = rank, pair
        self.known: dict[int, bool] = {}
        # A token that merging never arrives at cannot end a prefix.
        reached = {i for i in ids.values() if i not in self.split}
        for token in sorted(self.split, key=self.rank.__getitem__):
            left, right = self.split[token]
            if left in reached and right in reached and self._apart(left, right, self.rank[token]):
                reached.add(token)
        self.ids = {b: i for b, i in ids.items() if i in reached}
        self.starts = {b[:n] for b in self.ids for n in range(len(b) + 1)}
        self.state_of: dict[bytes, int] = {}
        self.state_text: list[bytes] = []
        self.ends: list[list[tuple[int, int]]] = []
        self.moves: dict[int, int] = {}
        self._state(b"")
        marks = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.words = regex.compile(WORDS)

    def _apart(self, left: int, right: int, limit: int) -> bool:
        """Whether merges of a rank below ``limit`` leave two neighbouring tokens apart.

        The two are taken back in the reverse order of their making; at each step, the
        pieces that then faced each other must not have had an earlier merge.
        """
        merges, rank, split = self.merges, self.rank, self.split
        while True:
            if merges.get((left, right), limit) < limit:
                return False
            if rank[left] > rank[right]:
                limit = rank[left]
                left = split[left][1]
            elif rank[right] >= 0:
                limit = rank[right] + 1
                right = split[right][0]
            else:
                return True

    def apart(self, left: int, right: int) -> bool:
        """Whether merging leaves two neighbouring tokens apart; answers are kept."""
        if len(self.known) > KEPT_PAIRS:
            self.known.clear()
        answer = self.known[left << 32 | right] = self._apart(left, right, 1 << 60)
        return answer

    def _state(self, text: bytes) -> int:
        """The number of the longest suffix of ``text`` that starts some token."""
        while text not in self.starts:
            text = text[1:]
        number = self.state_of.get(text)
        if number is None:
            number = self.state_of[text] = len(self.state_text)
            self.state_text.append(text)
            ends = (text[at:] for at in range(len(text)))
            self.ends.append([(self.ids[e], len(e)) for e in ends if e in self.ids])
        return number

    def encode_words(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, array]]:
        """(word, token ids) of distinct words, in the depth-first order of their trie.

        Next to its last token, a prefix has the state of an automaton over the tokens,
        which lists the tokens that end the prefix, longest first.
        """
        moves, known, ends = self.moves, self.known, self.ends
        # Of each prefix of the word, the empty one first: state, last token, its length.
        states, last, lengths = [0], [0], [0]
        before = b""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :], last[shared + 1 :], lengths[shared + 1 :]
            state = states[-1]
            for at in range(shared, len(word)):
                move = state << 8 | word[at]
                state = moves.get(move)
                if state is None:
                    text = self.state_text[move >> 8] + word[at : at + 1]
                    state = moves[move] = self._state(text)
                for token, length in ends[state]:
                    if length > at:
                        break
                    left = last[at - length + 1]
                    fits = known.get(left << 32 | token)
                    if fits or fits is None and self.apart(left, token):
                        break
                states.append(state)
                last.append(token)
                lengths.append(length)
            tokens = array("I")
            at = len(word)
            while at:
                tokens.append(last[at])
                at -= lengths[at]
            tokens.reverse()
            yield word, tokens
            before = word

    def decode(self, tokens: Iterable[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, tokens)).decode("utf-8", "replace")


class Encoder:
    """Encodes batches of texts; keeps encodings of short words between them."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.kept: dict[str, bytes] = {}

    def _parts(self, text: str) -> list[list[str] | str]:
        """Words of each stretch, and the special tokens between the stretches."""
        vocabulary = self.vocabulary
        if vocabulary.specials is None or not any(s in text for s in vocabulary.special):
            return [vocabulary.words.findall(text)]
        pieces = vocabulary.specials.split(text)
        return [p if i % 2 else vocabulary.words.findall(p) for i, p in enumerate(pieces)]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        vocabulary = self.vocabulary
        split = [self._parts(text) for text in texts]
        words = {w for parts in split for p in parts if isinstance(p, list) for w in p}
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        packed = {w: self.kept[w] for w in words if w in self.kept}
        new = {w.encode(): w for w in words if w not in packed}
        for word, tokens in vocabulary.encode_words(new):
            packed[new[word]] = tokens.tobytes()
            if len(word) <= KEPT_BYTES:
                self.kept[new[word]] = packed[new[word]]
        for parts in split:
            yield b"".join(
                b"".join(map(packed.__getitem__, p))
                if isinstance(p, list)
                else array("I", [vocabulary.special[p]]).tobytes()
                for p in parts
            )


@lru_cache(maxsize=2)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def runs_of(texts: list[str | None], chars: int = 4_000_000) -> Iterator[list[str]]:
    """Runs of texts of about ``chars`` characters, so that the words of a run fit in memory."""
    run, size = [], 0
    for text in texts:
        run.append(text or "")
        size += len(run[-1])
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def _file(df: DataFrame, path: str | None) -> Broadcast[bytes]:
    small_batches(df.sparkSession)
    with open(path or vocabulary_path(), "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` and a last column ``ids`` (renamed if taken): the token ids of ``text``."""
    content = _file(docs, path)
    position, name = docs.columns.index(text), free_name(docs, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(content.value))
        for batch in batches:
            done = 0
            for texts in runs_of(batch.column(position).to_pylist()):
                packed = list(encoder.encode(texts))
                ends = accumulate((len(p) // 4 for p in packed), initial=0)
                values = b"".join(packed)
                ids = pa.Array.from_buffers(
                    pa.int32(), len(values) // 4, [None, pa.py_buffer(values)]
                )
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
                rows = batch.slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], [*batch.schema.names, name])

    return docs.mapInArrow(run, _with(docs.schema, name, T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """``encoded`` and a last column ``decoded`` (renamed if taken): the text of ``ids``.

    Null ids give a null text.
    """
    content = _file(encoded, path)
    position, name = encoded.columns.index(ids), free_name(encoded, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(content.value)
        for batch in batches:
            texts = [
                None if row is None else vocabulary.decode(row)
                for row in batch.column(position).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name]
            )

    return encoded.mapInArrow(run, _with(encoded.schema, name, T.StringType()))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, and the SHA-256 of its ids and of their decoding.

    Both directions run where the text is, so neither ids nor decoded texts are moved.
    """
    content = _file(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(content.value)
        encoder = Encoder(vocabulary)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for texts in runs_of(batch.column(1).to_pylist()):
                for packed in encoder.encode(texts):
                    counts.append(len(packed) // 4)
                    of_ids.append(hashlib.sha256(packed).hexdigest())
                    text = vocabulary.decode(memoryview(packed).cast("I"))
                    of_text.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
