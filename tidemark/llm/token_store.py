"""Token ids in binary shards with a minimal perfect hash index for constant-time keyed access.

Folder layout (any shared file system Arrow can write):

  ids-00007.bin     raw little-endian ids of one shard, documents one after another
  index-00007.npz   per shard: bit levels of the minimal perfect hash of its keys, and by its
                    slots a stored fingerprint, the key's first document and how many there
                    are; plus the start of every document in the payload
  manifest/         Parquet, one row per shard: key range, documents, ids

Shards are ranges of the key in ascending order (nulls first). A reader picks the shard by
key range, the slot by the hash, checks the fingerprint and reads the ids at the stored
offset. A shard is written under a temporary name and moved into place, so a repeated task
leaves one whole file."""

from __future__ import annotations

import functools
import io
import math
import re
import struct
import unicodedata
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import byte_letters
from tidemark.llm.common import blocks, mix
from tidemark.llm.wordcache import ChunkCache

END = 2
_U = np.uint64


# ---- encoding ------------------------------------------------------------------------------

class WordTokenizer:
    """Ids of whole texts by a tokenizers file that lower-cases, drops white space and splits
    into letters, single digits, other signs and a few endings. Texts in Latin letters are
    split here and each distinct piece goes through the library's model once; all others go through its whole chain, each
    distinct chunk between blanks once. Both give the library's ids; where a trial shows that
    they do not (another kind of file), every text takes the whole chain."""

    #: Blanks, printable ASCII and Latin letters: composed as they stand, lower-cased one by one.
    LATIN = r"[\t\n\x0b\x0c\r\x20-\x7e\xa0-\u024f]*"
    TRIES = ("Word", "don't Don'T", "a1b22,c", "(x) we'll...", "ABC!! $%&", "it's_ \n\t été Ärger \xa0 x² ªº ß", "Straße İstanbul ǅ ŉ", "a\xadb «c»")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.latin = re.compile(self.LATIN).fullmatch
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # the small forms of some letters of the range lie beyond it
        own = [c for c in map(chr, range(0x250)) if self.latin(c)]
        known = sorted({x for c in own for x in c + c.lower()})
        letters, digits = ("".join(c for c in known if unicodedata.category(c)[0] == kind) for kind in "LN")
        self.split = re.compile(f"[{letters}]+|[{digits}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{letters}{digits}]+").findall
        self.letters = byte_letters()
        self.pieces = ChunkCache(self._pieces, 400_000)
        self.chunks = ChunkCache(self._chunks, 100_000)
        # every character of the range, alone, inside a word, beside a digit and doubled
        tries = [*self.TRIES, *(f"{c} a{c}b 1{c}2 {c}{c}" for c in own)]
        self.plain = self._whole(tries) == self.pieces.all([self.split(t.lower()) for t in tries])

    def _ids(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.dtype.itemsize == 2 else 'I'}", *ids)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        as_letters = (p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in pieces)
        return [self._ids([t.id for t in self.model.tokenize(p)]) for p in as_letters]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        return [self._ids(e.ids) for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        lists = []
        for t in texts:
            for blank in "\n\t\r\x0b\x0c":
                if blank in t:
                    t = t.replace(blank, " ")
            lists.append(t.split(" "))
        return self.chunks.all(lists)

    def encode(self, texts: list[str]) -> list[bytes]:
        short = [self.plain and "<|" not in t and self.latin(t) is not None for t in texts]
        by_piece = iter(self.pieces.all([self.split(t.lower()) for t, s in zip(texts, short) if s]))
        whole = iter(self._whole([t for t, s in zip(texts, short) if not s]))
        return [next(by_piece if s else whole) for s in short]


@functools.lru_cache(2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


# ---- minimal perfect hash ------------------------------------------------------------------

class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: level by level, keys alone in their cell
    set its bit, the others go on to the next level; a key's slot is the rank of its bit."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(ones)])

    @staticmethod
    def _cell(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ mix(np.array([level + 1], _U) * _U(0x9E3779B97F4A7C15))) % _U(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, spread: float = 1.5) -> PerfectHash:
        sizes, bits, left, level = [], [], keys.astype(_U), 0
        while len(left):
            size = -(-max(64, int(len(left) * spread)) // 64) * 64
            cell = cls._cell(left, level, size)
            alone = np.bincount(cell, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left, level = left[~alone[cell]], level + 1
            if level > 200:
                raise ValueError("keys are not distinct")
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), np.packbits(flat, bitorder="little").view(_U))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level knows it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = self.starts[level] + self._cell(keys[left], level, size)
            word, bit = at >> 6, (at & 63).astype(_U)
            hit = (self.words[word] >> bit) & _U(1) == 1
            below = self.words[word[hit]] & ((_U(1) << bit[hit]) - _U(1))
            out[left[hit]] = self.ranks[word[hit]] + np.bitwise_count(below)
            left = left[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ _U(0x7FB5D329728EA185)) >> _U(32)).astype(np.uint32)


def build_index(keys: list[int | None], lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Index arrays of a shard whose documents have ``keys`` in order (equal ones adjacent)."""
    nulls = sum(k is None for k in keys)
    k = np.array(keys[nulls:], np.int64).view(_U)
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(new)
    own = k[first]
    h = PerfectHash.build(own)
    slot = h.slots(own)
    out = {"sizes": h.sizes, "words": h.words, "nulls": np.array([nulls]), "starts": np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)}
    for name, values in (("print", fingerprints(own)), ("first", nulls + first), ("copies", np.diff(np.append(first, len(k))))):
        out[name] = np.empty(len(own), values.dtype)
        out[name][slot] = values
    return out


class Shard:
    """A shard's index, opened for lookups."""

    def __init__(self, arrays):
        self.arrays = {k: arrays[k] for k in arrays}
        self.hash = PerfectHash(self.arrays["sizes"], self.arrays["words"])

    def find(self, keys: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, number of documents) of each key; 0 documents for unknown keys."""
        a = self.arrays
        k = np.where(null, 0, keys).astype(np.int64).view(_U)
        slot = self.hash.slots(k)
        good = slot >= 0
        good[good] = a["print"][slot[good]] == fingerprints(k[good])
        good &= ~null
        first, copies = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
        first[good], copies[good] = a["first"][slot[good]], a["copies"][slot[good]]
        copies[null] = a["nulls"][0]
        return first, copies


# ---- files ---------------------------------------------------------------------------------

def open_fs(folder: str):
    fs, path = pafs.FileSystem.from_uri(folder)
    return fs, path.rstrip("/")


def _put(fs, path: str, data) -> None:
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temporary) as f:
        f.write(data)
    fs.move(temporary, path)


def _write(folder: str, tokenizer_path: str, end_id: int):
    def run(batches):
        t = tokenizer(tokenizer_path)
        end = np.array([end_id], t.dtype).tobytes()
        fs, path = open_fs(folder)
        shard, keys, lengths = TaskContext.get().partitionId(), [], []
        name, temporary = f"{path}/ids-{shard:05d}.bin", f"{path}/ids-{shard:05d}.bin.{uuid.uuid4().hex}.tmp"
        payload = None
        for b in blocks(batches, "__t"):
            if payload is None:
                payload = fs.open_output_stream(temporary)
            ids = t.encode([x or "" for x in b.column("__t").to_pylist()])
            payload.write(b"".join(x + end for x in ids))
            keys += b.column("__id").to_pylist()
            lengths += [len(x) // t.dtype.itemsize + 1 for x in ids]
        if payload is None:
            return
        payload.close()
        fs.move(temporary, name)
        index = io.BytesIO()
        np.savez(index, dtype=np.array(t.dtype.str), **build_index(keys, np.array(lengths, np.int64)))
        _put(fs, f"{path}/index-{shard:05d}.npz", index.getvalue())
        known = [k for k in keys if k is not None]
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "first_key": pa.array([known[0] if known else None], pa.int64()),
            "last_key": pa.array([known[-1] if known else None], pa.int64()), "n_docs": pa.array([len(keys)], pa.int64()),
            "n_ids": pa.array([sum(lengths)], pa.int64())})
    return run


def write(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = END, docs_per_shard: int = 8192) -> None:
    """Encode every text, append ``end_id``, and write shards in ascending order of the id.

    Null and empty texts are one end id; null ids come first; equal ids stay together in one
    shard, ordered by text; texts are encoded whole. An empty table writes an empty manifest.
    Other columns are ignored. ``docs_per_shard`` sets the shard size, nothing else."""
    d = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__t"))
    n = max(1, math.ceil(docs.count() / docs_per_shard))
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)
    d = d.repartitionByRange(n, F.col("__id").asc_nulls_first()).sortWithinPartitions(F.col("__id").asc_nulls_first(), "__t")
    manifest = d.mapInArrow(_write(folder, tokenizer_path, end_id), "shard int, first_key long, last_key long, n_docs long, n_ids long")
    manifest.write.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str, keys: DataFrame, key_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per row of ``keys`` that the store knows: the key, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers) and,
    if asked, the ids. Equal keys take the key's documents in turn; keys beyond the stored ones
    are absent. The manifest is collected: one small row per shard of thousands of documents."""
    shards = spark.read.parquet(f"{folder}/manifest").orderBy("shard").collect()
    schema = "__id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    k = keys.select(F.col(key_col).cast("long").alias("__id"))
    if not shards:
        return spark.createDataFrame([], schema).withColumnRenamed("__id", key_col)
    numbers = [s["shard"] for s in shards]
    base = dict(zip(numbers, np.concatenate([[0], np.cumsum([s["n_ids"] for s in shards])]).tolist()))
    last = np.array([-(1 << 63) if s["last_key"] is None else s["last_key"] for s in shards], np.int64)

    def place(batches):
        for b in batches:
            ids = b.column(0)
            known = ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(last, known), len(numbers) - 1)
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.array(numbers, np.int32)[at])], ["__id", "shard"])

    def look(fs, path, shard, batch_ids, served):
        found = served.get("shard")
        if found != shard:
            with fs.open_input_file(f"{path}/index-{shard:05d}.npz") as f:
                arrays = np.load(io.BytesIO(f.read()))
                served.update(shard=shard, index=Shard(arrays), dtype=np.dtype(str(arrays["dtype"])), turn={})
            served["payload"] = fs.open_input_file(f"{path}/ids-{shard:05d}.bin")
        index, starts, size = served["index"], served["index"].arrays["starts"], served["dtype"].itemsize
        null = np.array([x is None for x in batch_ids])
        key = np.array([x or 0 for x in batch_ids], np.int64)
        first, copies = index.find(key, null)
        # equal keys are adjacent: the j-th of them is the key's j-th document
        same = np.zeros(len(key), bool)
        same[1:] = (key[1:] == key[:-1]) & (null[1:] == null[:-1])
        run = np.arange(len(key)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
        if len(key) and served["turn"] and served["turn"]["key"] == batch_ids[0]:
            head = np.cumsum(~same) == 1
            run[head] += served["turn"]["next"]
        if len(key):
            served["turn"] = {"key": batch_ids[-1], "next": int(run[-1]) + 1}
        good = run < copies
        doc = (first + run)[good]
        a, z = starts[doc], starts[doc + 1]
        rows = []
        at = 0
        while at < len(doc):  # neighbouring documents are read together, a few MB at a time
            to = at + 1
            while to < len(doc) and a[to] == z[to - 1] and (z[to] - a[at]) * size < 1 << 22:
                to += 1
            raw = np.frombuffer(served["payload"].read_at(int(z[to - 1] - a[at]) * size, int(a[at]) * size), served["dtype"])
            wide = raw.astype("<u4")
            view, low = memoryview(wide).cast("B"), a[at]
            for x, y in zip((a[at:to] - low).tolist(), (z[at:to] - low).tolist()):
                rows.append((zlib.crc32(view[4 * x: 4 * y]), wide[x:y].astype(np.int64) if with_ids else None))
            at = to
        out = [pa.array([x for x, g in zip(batch_ids, good) if g], pa.int64()), pa.array(a + base[shard]), pa.array(z - a),
               pa.array([r[0] for r in rows], pa.int64())]
        names = ["__id", "start", "n_tokens", "ids_crc32"]
        if with_ids:
            out.append(pa.array([r[1] for r in rows], pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(out, names)

    def serve(batches):
        fs, path = open_fs(folder)
        served = {}
        for b in batches:
            shard = b.column(1).to_numpy(zero_copy_only=False)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                for at in range(s, e, 2048):
                    yield look(fs, path, int(shard[at]), b.column(0).slice(at, min(2048, e - at)).to_pylist(), served)

    placed = k.mapInArrow(place, "__id long, shard int").repartition(len(numbers), "shard").sortWithinPartitions("shard", F.col("__id").asc_nulls_first())
    return placed.mapInArrow(serve, schema).withColumnRenamed("__id", key_col)
