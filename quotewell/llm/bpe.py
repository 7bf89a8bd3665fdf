"""BPE encoding and decoding by a depth-first walk over the trie of distinct words."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.llm.common import packed, read, small_batches, unpacked

# Fixed value: how the vocabulary cuts a text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_FAR = re.compile("[\U00010000-\U0010ffff]")
_FINDALL_CHARS = 1 << 20  # longer texts are cut into words a part at a time
_PART_WORDS = 1 << 17
_KEEP_WORDS = 1 << 19  # words, and steps, remembered per worker; then it starts anew
_KEEP_CHARS = 64  # longer words are encoded again each time


def _near_words() -> re.Pattern[str]:
    """WORDS for texts without characters beyond 16 bits, in Python's faster re: the classes are the characters that WORDS takes for them."""
    signs = "".join(map(chr, [*range(0xD800), *range(0xE000, 1 << 16)]))
    ranges = lambda kind: "".join(f"\\u{ord(m[0][0]):04x}-\\u{ord(m[0][-1]):04x}" for m in regex.finditer(kind, signs))
    letters, numbers, spaces = ranges(r"\p{L}+"), ranges(r"\p{N}+"), ranges(r"\s+")
    return re.compile(f" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


NEAR_WORDS = _near_words()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodings of words, each prefix that words share computed once.

    The encoding of a word is fixed by the last token of every prefix: the last
    token of a prefix is the one vocabulary entry at its end that may follow
    the last token of what comes before it. Sorted words are the trie in
    depth-first order, so the last tokens of the prefix a word shares with the
    one before it are still at hand, and only the rest of the word is new.

    The entries at the end of a prefix follow from its place: the longest end of
    it with which an entry starts. A step from place to place by one byte is
    found once and remembered, with those entries, the longest first.
    """

    def __init__(self, path: str, data: bytes | None = None):
        spec = json.loads(Path(path).read_bytes() if data is None else data)
        signs, model = _byte_signs(), spec["model"]
        as_bytes = lambda token: bytes(signs[c] for c in token)
        self.ids = {as_bytes(token): i for token, i in model["vocab"].items() if all(c in signs for c in token)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content in self.special:
            self.ids.pop(content.encode(), None)
        self.raw = {i: token for token, i in self.ids.items()} | {i: c.encode() for c, i in self.special.items()}
        self.split_special = regex.compile("(" + "|".join(regex.escape(c) for c in self.special) + ")") if self.special else None
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = self.ids[as_bytes(left)], self.ids[as_bytes(right)]
            self.merge_rank[a, b] = rank
            self.parts.setdefault(self.ids[as_bytes(left + right)], (a, b, rank))
        self.after: dict[int, dict[int, int]] = {}  # by left token: the ranks of its merges
        for (x, y), rank in self.merge_rank.items():
            self.after.setdefault(x, {})[y] = rank
        self.names = list({b""} | {token[:n] for token in self.ids for n in range(1, len(token) + 1)})
        self.places = {name: i for i, name in enumerate(self.names)}
        self.steps: dict[int, tuple[int, tuple[tuple[int, int], ...]]] = {}
        self.follows: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        # The ids of a word as the bytes of 32-bit integers; special tokens stand for themselves.
        self.special_words = {i: array("i", [i]).tobytes() for i in self.special.values()}
        self.known: dict[str | int, bytes] = dict(self.special_words)

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge (0 first, 1 last) while `token` is built, each with the rank of the merge that ends it."""
        out = self.spines.get((token, side))
        if out is None:
            out, at = [(token, float("inf"))], token
            while at in self.parts:
                rank = self.parts[at][2]
                at = self.parts[at][side]
                out.append((at, rank))
            self.spines[token, side] = out
        return out

    def may_follow(self, a: int, b: int) -> bool:
        """Whether a b stay two tokens: no merge across their border comes before the ones inside them, the left first at equal rank."""
        out = self.follows.get((a, b))
        if out is None:
            right = self._spine(b, 0)
            out = not any(
                (m := ranks.get(y)) is not None and m < x_ends and m <= y_ends
                for x, x_ends in self._spine(a, 1) if (ranks := self.after.get(x)) for y, y_ends in right
            )
            if len(self.follows) > 4 * _KEEP_WORDS:
                self.follows.clear()
            self.follows[a, b] = out
        return out

    def _step(self, key: int) -> tuple[int, tuple[tuple[int, int], ...]]:
        """From place key >> 8 by byte key & 255: the next place, and length and id of each entry that ends there."""
        seen = self.names[key >> 8] + bytes([key & 255])
        while seen not in self.places:
            seen = seen[1:]
        ends = (seen[i:] for i in range(len(seen)))
        out = self.places[seen], tuple((len(end), self.ids[end]) for end in ends if end in self.ids)
        if len(self.steps) > _KEEP_WORDS:
            self.steps.clear()
        self.steps[key] = out
        return out

    def _walk(self, words: Iterable[bytes]) -> Iterator[bytes]:
        """The encodings of sorted words, as the bytes of 32-bit integers."""
        step_of, new_step, known, ask = self.steps.get, self._step, self.follows.get, self.may_follow
        last: list[int] = [-1]  # by prefix length: its last token
        size: list[int] = [0]  # that token's length
        places: list[int] = [self.places[b""]]  # and the prefix's place
        before = b""
        for word in words:
            end = 0
            for x, y in zip(before, word):  # noqa: B905
                if x != y:
                    break
                end += 1
            del last[end + 1 :], size[end + 1 :], places[end + 1 :]
            place = places[end]
            for byte in word[end:]:
                end += 1
                key = place << 8 | byte
                place, choices = step_of(key) or new_step(key)
                for n, token in choices:
                    if n == end:
                        break
                    pair = (last[end - n], token)
                    if (good := known(pair)) is None:
                        good = ask(*pair)
                    if good:
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                last.append(token)
                size.append(n)
                places.append(place)
            out = []
            while end:
                out.append(last[end])
                end -= size[end]
            before = word
            out.reverse()
            yield array("i", out).tobytes()

    def learn(self, words: set[str | int]) -> list[str]:
        """Puts the encodings of all these words into the table; gives back the long ones, which are not to stay there."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > _KEEP_WORDS:
            self.known = dict(self.special_words)
            new = words.difference(self.known)
        order = sorted(new)
        self.known.update(zip(order, self._walk(w.encode() for w in order), strict=True))
        return [w for w in order if len(w) > _KEEP_CHARS]

    def words(self, text: str, special: bool = True) -> Iterator[list[str | int]]:
        """The words of a text in lists of bounded length; ids of special tokens stand as ints if `special`."""
        for piece in self.split_special.split(text) if special and self.split_special else [text]:
            if special and piece in self.special:
                yield [self.special[piece]]
                continue
            pattern = NEAR_WORDS if piece.isascii() or not _FAR.search(piece) else WORDS
            if len(piece) <= _FINDALL_CHARS:
                yield pattern.findall(piece)
            else:
                found = pattern.finditer(piece)
                while part := [m.group() for m in islice(found, _PART_WORDS)]:
                    yield part

    def encode(self, texts: list[str | None], special: bool = True) -> list[np.ndarray]:
        """Token ids of each text; a null text has none."""
        cut = [list(self.words(t or "", special)) for t in texts]
        long = self.learn(set(chain.from_iterable(chain.from_iterable(cut))))
        found = [np.frombuffer(b"".join(map(self.known.__getitem__, chain.from_iterable(parts))), np.int32) for parts in cut]
        for word in long:
            del self.known[word]
        return found

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


class Vocabulary:
    """A vocabulary file that only the driver has to reach: its bytes go to the executors."""

    def __init__(self, spark: SparkSession, path: str):
        content = Path(path).read_bytes()
        self.name, self.data = hashlib.sha256(content).hexdigest(), spark.sparkContext.broadcast(content)

    def encoder(self) -> Encoder:
        """One per worker process and vocabulary, kept from task to task."""
        return _encoder(self.name, self.data)


def _encoder(name: str, data: Broadcast) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder("", data.value)
    return _ENCODERS[name]


def bpe(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """Encodes every whole text and decodes the ids again.

    Returns doc (the whole row), token_ids array<int>, decoded string. Equal to
    the tokenizers library on the same vocabulary file: strings of special
    tokens in a text become those tokens. A null or empty text has no ids and
    decodes to an empty string; rows that repeat give equal results.

    Each worker gathers the distinct words of a batch of rows and walks their
    trie; encodings are remembered up to a fixed number of words, so memory does
    not grow with the table. There is no shuffle.
    """
    vocabulary = Vocabulary(docs.sparkSession, path or default_tokenizer())
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary.encoder()
        for batch in batches:
            ids = own.encode(batch.column("doc").field(text).to_pylist())
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            values = np.concatenate([*ids, np.empty(0, np.int32)])
            decoded = [own.decode(x.tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())), pa.array(decoded, pa.string())],
                names=["doc", "token_ids", "decoded"],
            )

    rows = docs.select(packed(docs))
    schema = T.StructType([*rows.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, schema)


def bpe_stage(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of docs with n_tokens, token_ids and round_trip (whether decoding gave the text back)."""
    rows = bpe(docs, path)
    own = unpacked(rows, docs).columns
    added = {"n_tokens": F.size("token_ids").cast("long"), "token_ids": F.col("token_ids"), "round_trip": F.col("decoded") == F.coalesce(F.col("doc.text"), F.lit(""))}
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in own if c not in added], *[c.alias(n) for n, c in added.items()])


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("doc.doc_id").alias("doc_id"),
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
