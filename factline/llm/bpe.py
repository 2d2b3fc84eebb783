"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece there is exactly one token that can end its encoding. An
automaton over the vocabulary lists the tokens that end at a place, longest first; the one
that fits is the one that is compatible with the last token of the prefix before it. Two
tokens are compatible if encoding their joined bytes gives the two again, which the spines of
their merge trees tell without running any merges. Back-pointers then give the ids.

Defined cases: null texts count as empty and have no ids; a special token's string in a text
becomes that token; pieces of any length are handled (long ones are not remembered). Rows are
independent, so repeated rows and ties give repeated results.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factline.llm.arrow import blocks
from factline.llm.names import quoted, set_aside, unused, without

# Fixed value: how byte-level tokenizers cut a text into pieces.
PIECES = r" ?\p{L}+|'(?:s|t|re|ve|m|ll|d)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces and pairs remembered by a worker, and the longest remembered piece.
REMEMBERED, LONGEST = 250_000, 48
_NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Encodes and decodes texts with the vocabulary and merges of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        of = {name: bytes(letters[c] for c in name) for name in vocabulary}
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.tokens = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for name, number in vocabulary.items():
            self.tokens[number] = of[name]
        for name, number in self.special.items():
            self.tokens[number] = name.encode()

        self.ranks: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}  # left, right and rank of the merge that makes a token
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (vocabulary[left], vocabulary[right]), vocabulary[left + right]
            self.ranks.setdefault(pair, rank)
            parts.setdefault(made, (*pair, rank))
        self._right = self._spines(parts, 1)
        self._left = self._spines(parts, 0)
        self._fits: dict[tuple[int, int], bool] = {}

        self._ends = ahocorasick.Automaton()
        for number in vocabulary.values():
            self._ends.add_word(self.tokens[number].decode("latin-1"), (number, len(self.tokens[number])))
        self._ends.make_automaton()
        self._pieces = regex.compile(PIECES).findall
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._known = _Known(self._of_piece)

    def _spines(self, parts: dict, side: int) -> list[list[tuple[int, int]]]:
        """Down one edge of each token's merge tree: the tokens, and the rank at which each is merged away."""
        spines = [[(number, _NEVER)] for number in range(len(self.tokens))]
        for spine in spines:
            while spine[-1][0] in parts:
                made = parts[spine[-1][0]]
                spine.append((made[side], made[2]))
        return spines

    def fits(self, left: int, right: int) -> bool:
        """Whether two neighbours stay apart: no merge across their border comes before those that build them."""
        known = self._fits.get((left, right))
        if known is None:
            known, ranks = True, self.ranks
            for a, a_gone in self._right[left]:
                for b, b_gone in self._left[right]:
                    rank = ranks.get((a, b))
                    if rank is not None and rank < a_gone and rank <= b_gone:
                        known = False
                        break
                if not known:
                    break
            if len(self._fits) >= 2 * REMEMBERED:
                self._fits.clear()
            self._fits[left, right] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of a piece: the last token of every prefix, followed back from the end."""
        n = len(piece)
        last: list[int | None] = [None] * n
        fits, known, tokens = self.fits, self._fits, self.tokens
        for end, (token, size) in self._ends.iter(piece.decode("latin-1")):
            if last[end] is None:
                if end >= size:
                    before = last[end - size]
                    if before is None:
                        continue
                    fit = known.get((before, token))
                    if fit is False or fit is None and not fits(before, token):
                        continue
                last[end] = token
        ids, at = [], n - 1
        while at >= 0:
            ids.append(last[at])
            at -= len(tokens[last[at]])
        ids.reverse()
        return ids

    def _of_piece(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece.encode()), "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        known = self._known
        found = []
        for i, part in enumerate(self._cut.split(text) if self._cut else [text]):
            if i % 2:
                found.append(self.special[part].to_bytes(4, "little"))
            else:
                found.extend(map(known.__getitem__, self._pieces(part)))
        return np.frombuffer(b"".join(found), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


class _Known(dict):
    """Little-endian ids by string; long strings are made anew each time."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self._make = make

    def __missing__(self, key: str) -> bytes:
        ids = self._make(key)
        if len(key) <= LONGEST and len(self) < REMEMBERED:  # the frequent ones come early
            self[key] = ids
        return ids


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each worker process and file."""
    return Codec(path)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each whole text as an array<int>; the file must be at that place on every node."""
    whole, columns = set_aside(without(docs, [ids]), text)
    others, raw = whole.columns, unused([*whole.columns, ids], "raw")
    source = whole.withColumn(raw, F.coalesce(quoted(text), F.lit("")))
    schema = T.StructType([*whole.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for block in blocks(batches, raw):
            found = [own.encode(x) for x in block.column(raw).to_pylist()]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            values = pa.array(np.concatenate(found).astype(np.int32), pa.int32())
            yield pa.record_batch([*map(block.column, others), pa.ListArray.from_arrays(pa.array(ends), values)], [*others, ids])

    return source.mapInArrow(run, schema).select(*columns, quoted(ids))


def _arrays(block: pa.RecordBatch, ids: str) -> Iterator[np.ndarray]:
    lists = block.column(ids)
    ends, values = np.asarray(lists.offsets), np.asarray(lists.values).astype("<u4")
    return (values[ends[i]:ends[i + 1]] for i in range(block.num_rows))


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of each array of ids."""
    whole, columns = set_aside(without(encoded, [text]), ids)
    others = whole.columns
    schema = T.StructType([*whole.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                block = batch.slice(start, 256)
                yield pa.record_batch([*map(block.column, others), pa.array([own.decode(x) for x in _arrays(block, ids)], pa.string())], [*others, text])

    return whole.mapInArrow(run, schema).select(*columns, quoted(text))


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode and decode each whole text in one pass: doc_id, n_tokens, and hashes of the ids
    (unsigned 32-bit, little-endian) and of the decoded text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for block in blocks(batches, "text"):
            counts, hashes, decoded = [], [], []
            for text in block.column("text").to_pylist():
                ids = own.encode(text)
                counts.append(len(ids))
                hashes.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.record_batch([block.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()),
                                   pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
