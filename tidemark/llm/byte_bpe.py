"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file lists the vocabulary as bytes with their ranks (= ids). Here it becomes a model of
the library: bytes are written as the letters that byte-level vocabularies use for them, and
each token's merge is the pair that its own bytes come down to under the lower ranks. Texts are
split by the file's pattern, each match is encoded by itself, and equal chunks (white space and
the run after it, cut once more where Latin letters end before another ASCII character; no match
of the pattern crosses such an edge) are encoded once per task.

Offsets come from the bytes of the ids: a token stands from the character that holds its first
byte to that of its last, so tokens that split a character share it. Decoding reverses the byte
table; a character split over tokens is whole again in the joined bytes, and comes with the
token that completes it where texts are wanted token by token."""

from __future__ import annotations

import base64
import codecs
import functools
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import blocks
from tidemark.llm.wordcache import ChunkCache

#: Characters with the Unicode property White_Space (fixed values).
BLANKS = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

#: Latin letters: all of these are letters whatever the version of Unicode.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"


def byte_letters() -> dict[int, str]:
    """Each byte as the letter that byte-level vocabularies write it with: printable ones as
    they stand, the others by turns from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The last pair that makes ``token`` when only lower ranks merge, lowest and leftmost
    first; None if it does not come down to two parts."""
    own, parts = ranks[token], [token[i: i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1], own)) < own]
        if not found:
            return None
        i = min(found)[1]
        parts[i: i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class ByteBPE:
    """Ids of whole texts, and texts of ids, by a rank file and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers
        self.letters = letters = byte_letters()
        write = lambda raw: "".join(letters[b] for b in raw)
        pairs = ((t, merge_of(t, ranks)) for t in sorted(ranks, key=ranks.__getitem__) if len(t) > 1)
        merges = [(write(p[0]), write(p[1])) for _, p in pairs if p]
        # ignore_merges: a match that is a token itself is that token, whatever its merges
        self.tokenizer = Tokenizer(models.BPE(vocab={write(t): i for t, i in ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for t, i in ranks.items():
            self.bytes[i] = t
        self.lengths = np.array([len(t) for t in self.bytes], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.split = re.compile(f"[{BLANKS}]*+(?:[{LETTERS}]++(?=[!-@\\[-`{{-~])|[^{BLANKS}]++|)").findall
        self.match = re.compile(f" ?[{LETTERS}]+").fullmatch if self.tokenizer.pre_tokenizer.pre_tokenize_str(" \xe9A") == [(
            "".join(letters[b] for b in " \xe9A".encode()), (0, 3))] else (lambda c: None)
        self.cache = ChunkCache(self._chunks, 300_000)

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}, pattern)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks: a chunk that is one match goes to the model as its letters, the
        others through the whole chain, one after another (a task has one core)."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        one = [self.match(c) is not None for c in chunks]
        chain = iter(self.tokenizer.encode_batch_fast([c for c, o in zip(chunks, one) if not o], add_special_tokens=False))
        merge = self.tokenizer.model.tokenize
        ids = ([t.id for t in merge(c.encode().decode("latin-1").translate(self.letters))] if o else next(chain).ids for c, o in zip(chunks, one))
        return [struct.pack(f"<{len(x)}I", *x) for x in ids]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return self.cache.all([self.split(t) for t in texts])

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first character, character after the last) of each token of ``text``."""
        ends = np.cumsum(self.lengths[ids])
        lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        seen = np.cumsum(lead)
        return seen[ends - self.lengths[ids]] - 1, seen[ends - 1]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, looked up some ten thousand at a time."""
        if len(ids) and int(ids.max()) >= len(self.bytes):
            raise ValueError("an id outside the vocabulary")
        out = []
        for at in range(0, len(ids), 1 << 16):
            part = ids[at: at + (1 << 16)].astype(np.int64)
            n = self.lengths[part]
            end = np.cumsum(n)
            place = np.arange(int(end[-1]))
            place += np.repeat(self.starts[part] - (end - n), n)
            out.append(self.flat[place].tobytes())
        return b"".join(out)

    def texts(self, ids: np.ndarray) -> list[str]:
        """The characters that each token completes; bytes that are no UTF-8 become U+FFFD, an
        unfinished last character is told with the last token."""
        more, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        for n, i in enumerate(ids.tolist(), 1):
            out.append(more.decode(self.bytes[i], final=n == len(ids)))
        return out


@functools.lru_cache(2)
def codec(path: str, pattern: str) -> ByteBPE:
    return ByteBPE.load(path, pattern)


def _inside(df: DataFrame, new: list[str]) -> tuple[DataFrame, list[str], list[T.StructField]]:
    """``df`` without the columns ``new``, under plain names; its names and fields."""
    names = [c for c in df.columns if c not in new]
    fields = [T.StructField(f"__in{i}", df.schema[c].dataType) for i, c in enumerate(names)]
    return df.select(*[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(names)]), names, fields


def _named(out: DataFrame, names: list[str], new: list[str]) -> DataFrame:
    return out.select(*[F.col(f"__in{i}").alias(c) for i, c in enumerate(names)], *[F.col(f"__new{i}").alias(c) for i, c in enumerate(new)])


def _arrays(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat).cast(kind))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", packed: bool = False,
           offsets: bool = False, decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col``: the ids of the whole text (array<int>; ``packed``: binary,
    little-endian unsigned 32-bit integers). ``offsets`` adds the arrays ``starts`` and ``ends``,
    the characters of each token, ``decoded_col`` the bytes that the ids decode to, in the same
    pass (as :func:`decode` would).

    Null and empty texts have no ids. Each row is encoded by itself: repeated rows agree, an
    empty table gives none, and texts of any length are encoded whole. Existing columns of the
    new names are replaced, all others pass through."""
    new = [ids_col] + (["starts", "ends"] if offsets else []) + ([decoded_col] if decoded_col else [])
    if text_col in new:
        raise ValueError("the text column cannot be replaced")
    d, names, fields = _inside(docs, new)
    at = names.index(text_col)

    def run(batches):
        c = codec(path, pattern)
        for b in blocks(batches, f"__in{at}"):
            texts = [t or "" for t in b.column(at).to_pylist()]
            raw = c.encode(texts)
            ids = [np.frombuffer(x, "<u4") for x in raw]
            columns = [pa.array(raw, pa.binary()) if packed else _arrays(ids, pa.int32())]
            if offsets:
                spans = [c.offsets(t, x) for t, x in zip(texts, ids)]
                columns += [_arrays([s[k] for s in spans], pa.int32()) for k in (0, 1)]
            if decoded_col:
                columns.append(pa.array([c.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], [*b.schema.names, *[f"__new{i}" for i in range(len(new))]])

    kinds = [T.BinaryType() if packed else T.ArrayType(T.IntegerType()), *[T.ArrayType(T.IntegerType())] * (2 * offsets),
             *[T.BinaryType()] * bool(decoded_col)]
    schema = T.StructType(fields + [T.StructField(f"__new{i}", k) for i, k in enumerate(kinds)])
    return _named(d.mapInArrow(run, schema), names, new)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded", texts: bool = False,
           rows: int = 256) -> DataFrame:
    """``df`` with ``out_col``: the bytes that the ids (array or packed) stand for; ``texts``
    gives instead the text of each token (array<string>, see :meth:`ByteBPE.texts`).

    Null and empty ids give empty bytes or no texts. An id outside the vocabulary fails."""
    if ids_col == out_col:
        raise ValueError("the id column cannot be replaced")
    d, names, fields = _inside(df, [out_col])
    at = names.index(ids_col)
    packed = isinstance(fields[at].dataType, T.BinaryType)
    read = (lambda x: np.frombuffer(x or b"", "<u4")) if packed else (lambda x: np.array(x or [], np.int64))

    def run(batches):
        c = codec(path, pattern)
        give, kind = (c.texts, pa.list_(pa.string())) if texts else (c.decode, pa.binary())
        for whole in batches:
            for b in (whole.slice(i, rows) for i in range(0, whole.num_rows, rows)):
                new = pa.array([give(read(x)) for x in b.column(at).to_pylist()], kind)
                yield pa.RecordBatch.from_arrays([*b.columns, new], [*b.schema.names, "__new0"])

    kind = T.ArrayType(T.StringType()) if texts else T.BinaryType()
    return _named(d.mapInArrow(run, T.StructType(fields + [T.StructField("__new0", kind)])), names, [out_col])
