"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Pieces and their log scores come from a public model file. Blanks become the marker U+2581
(one more stands before the text), a character no piece covers costs the lowest score less
10 and is written as its UTF-8 bytes. The best segmentation maximises the sum of the scores;
of equal ones the longest last piece counts. No piece holds a marker after another character
or a line feed, so texts are cut there and each distinct chunk is solved once per task."""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import FINE_BLOCK, blocks, frugal
from tidemark.llm.wordcache import ChunkCache

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Solved chunks a worker remembers (some 300 bytes each).
CACHED = 50_000


class DoubleArray:
    """Trie over byte strings: the child of state s by byte c is base[s] + c, if check there is s."""

    def __init__(self, keys: list[bytes]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        size = 1 << 12
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = np.zeros(size, bool)
        used[0], check[0] = True, -2
        todo, low = [(0, 0, len(order), 0)], 1
        # depth first; a node takes the first free place that holds all its children
        while todo:
            state, a, z, depth = todo.pop()
            if a < z and len(keys[order[a]]) == depth:
                value[state] = order[a]
                a += 1
            if a == z:
                continue
            edges, at = [], a
            while at < z:
                c, first = keys[order[at]][depth], at
                while at < z and keys[order[at]][depth] == c:
                    at += 1
                edges.append((c, first, at))
            codes = np.array([c for c, _, _ in edges])
            b, at, span = -1, low, 512
            while b < 0:               # first free place where all codes fit, some candidates at a time
                while at + span + 512 >= size:
                    base, value = (np.concatenate([x, np.full(size, f, np.int32)]) for x, f in ((base, 0), (value, -1)))
                    check, used = np.concatenate([check, np.full(size, -1, np.int32)]), np.concatenate([used, np.zeros(size, bool)])
                    size *= 2
                first = at + np.flatnonzero(~used[at: at + span]) - codes[0]
                first = first[first > 0]
                fits = first[~used[first[:, None] + codes].any(1)] if len(first) else first
                if len(fits):
                    b = int(fits[0])
                elif len(first) * 20 < span:
                    low = at + span    # nearly full: later nodes start behind it
                at, span = at + span, min(span * 2, 1 << 14)
            base[state] = b
            used[b + codes] = True
            check[b + codes] = state
            todo += [(b + c, first, last, depth + 1) for c, first, last in edges]
        self.base, self.check, self.value = base, check, value


class Unigram:
    """A vocabulary of (piece, score) with its special ids; encode and decode."""

    def __init__(self, pieces: list[str], scores: list[float], normal: list[bool], byte_ids: list[int], unknown: int = 0):
        self.ids = np.array([i for i, n in enumerate(normal) if n], np.int32)
        self.trie = DoubleArray([pieces[i].encode() for i in self.ids])
        self.scores = np.array([scores[i] for i in self.ids], float)
        self.unknown_score = float(self.scores.min()) - UNKNOWN_PENALTY if len(self.ids) else -UNKNOWN_PENALTY
        self.byte_ids, self.unknown = byte_ids, unknown
        self.longest = max((len(pieces[i].encode()) for i in self.ids), default=0)
        self.cuts = not any("\n" in pieces[i] or MARK in pieces[i].lstrip(MARK) for i in self.ids)
        self.text = [p.replace(MARK, " ").encode() if n else b"" for p, n in zip(pieces, normal)]
        for value, i in enumerate(byte_ids):
            self.text[i] = bytes([value])
        self.cache = ChunkCache(self._solve, CACHED)

    @classmethod
    def load(cls, path: str) -> Unigram:
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(m.get_piece_size())
        normal = [not (m.is_unknown(i) or m.is_control(i) or m.is_byte(i) or m.is_unused(i)) for i in n]
        byte_ids = [m.piece_to_id(f"<0x{v:02X}>") for v in range(256)] if any(m.is_byte(i) for i in n) else []
        return cls([m.id_to_piece(i) for i in n], [m.get_score(i) for i in n], normal, byte_ids, m.unk_id())

    # ---- best segmentation -------------------------------------------------------------

    def _one(self, raw: bytes) -> list[int]:
        """One chunk of any length, position by position."""
        base, check, value, scores = self._lists()
        n = len(raw)
        best, start, piece = [-float("inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for s in range(n):
            if raw[s] & 0xC0 == 0x80:
                continue
            width = 1 + (raw[s] >= 0xC0) + (raw[s] >= 0xE0) + (raw[s] >= 0xF0)
            state, here, single = 0, best[s], False
            for e in range(s, min(n, s + self.longest)):
                to = base[state] + raw[e]
                if to >= len(check) or check[to] != state:
                    break
                state = to
                if value[state] >= 0:
                    single |= e + 1 - s == width
                    got = here + scores[value[state]]
                    if got > best[e + 1]:
                        best[e + 1], start[e + 1], piece[e + 1] = got, s, value[state]
            if not single and here + self.unknown_score > best[s + width]:
                best[s + width], start[s + width], piece[s + width] = here + self.unknown_score, s, -1
        out, at = [], n
        while at > 0:
            s = start[at]
            out.append(self._spell(raw[s:at]) if piece[at] < 0 else [int(self.ids[piece[at]])])
            at = s
        return [i for part in reversed(out) for i in part]

    def _lists(self):
        if not hasattr(self, "_as_lists"):
            self._as_lists = (self.trie.base.tolist(), self.trie.check.tolist(), self.trie.value.tolist(), self.scores.tolist())
        return self._as_lists

    def _spell(self, raw: bytes) -> list[int]:
        return [self.byte_ids[c] for c in raw] if self.byte_ids else [self.unknown]

    def _many(self, raws: list[bytes]) -> list[bytes]:
        """Chunks of like length at once: one step moves all of them."""
        n, length = len(raws), np.array([len(r) for r in raws])
        width = int(length.max())
        text = np.zeros((n, width), np.uint8)
        text[np.arange(width) < length[:, None]] = np.frombuffer(b"".join(raws), np.uint8)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        start, piece = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for s in range(width):
            rows = np.flatnonzero((s < length) & ((text[:, s] & 0xC0) != 0x80))
            if not len(rows):
                continue
            lead = text[rows, s]
            step = 1 + (lead >= 0xC0).astype(int) + (lead >= 0xE0) + (lead >= 0xF0)
            single = np.zeros(n, bool)
            live, state, here = rows, np.zeros(len(rows), np.int32), best[rows, s]
            size = step
            for e in range(s, min(width, s + self.longest)):
                to = base[state] + text[live, e]
                ok = (e < length[live]) & (check[np.minimum(to, len(check) - 1)] == state) & (to < len(check))
                live, state, here, size = live[ok], to[ok], here[ok], size[ok]
                if not len(live):
                    break
                v = value[state]
                end = v >= 0
                r, got = live[end], here[end] + self.scores[v[end]]
                single[r[size[end] == e + 1 - s]] = True
                better = got > best[r, e + 1]
                r = r[better]
                best[r, e + 1], start[r, e + 1], piece[r, e + 1] = got[better], s, v[end][better]
            bare = ~single[rows]
            r, to = rows[bare], s + step[bare]
            got = best[r, s] + self.unknown_score
            better = got > best[r, to]
            r, to = r[better], to[better]
            best[r, to], start[r, to], piece[r, to] = got[better], s, -1
        # back from the ends, all chunks a step at a time: (chunk, place from its end, id) of every
        # piece, sorted once into reading order
        at, live, back = length.copy(), np.flatnonzero(length > 0), 0
        rows, places, found = [], [], []
        while len(live):
            e = at[live]
            s, p = start[live, e], piece[live, e]
            known = p >= 0
            rows.append(live[known])
            places.append(np.full(int(known.sum()), back, np.int64))
            found.append(self.ids[p[known]])
            back += 1
            if not known.all():
                for i, a, z in zip(live[~known].tolist(), s[~known].tolist(), e[~known].tolist()):
                    spelt = self._spell(raws[i][a:z])
                    rows.append(np.full(len(spelt), i))
                    places.append(back + np.arange(len(spelt))[::-1])
                    found.append(np.array(spelt, np.int32))
                back += 4 * max(1, len(self.byte_ids) > 0)
            at[live] = s
            live = live[s > 0]
        if not rows:
            return [b""] * n
        row, place = np.concatenate(rows), np.concatenate(places)
        order = np.lexsort((-place, row))
        flat = np.concatenate(found)[order].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(row, minlength=n))).tolist()
        return [flat[a:z] for a, z in zip([0, *ends[:-1]], ends)]

    def _solve(self, chunks: list[str], together: int = 4096, short: int = 48) -> list[bytes]:
        raw = [c.replace(" ", MARK).encode("utf-8", "replace") for c in chunks]
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        out: list[bytes] = [b""] * len(raw)
        for at in range(0, len(order), together):
            part = order[at: at + together]
            many = [i for i in part if 0 < len(raw[i]) <= short]
            for i, ids in zip(many, self._many([raw[i] for i in many]) if many else []):
                out[i] = ids
            for i in part:
                if len(raw[i]) > short:
                    out[i] = np.array(self._one(raw[i]), "<i4").tobytes()
        return out

    # ---- texts -------------------------------------------------------------------------

    _CHUNK = re.compile(r"(?: +|\n)[^ \n]*")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; an empty text has none."""
        chunks = []
        for t in texts:
            t = t.replace(MARK, " ")
            chunks.append([] if not t else self._CHUNK.findall(" " + t) if self.cuts else [" " + t])
        return self.cache.all(chunks)

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the marker before it."""
        raw = b"".join(map(self.text.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@functools.lru_cache(2)
def model(path: str) -> Unigram:
    return Unigram.load(path)


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col`` (array<int>): the pieces of the whole text, null text as empty;
    with ``decoded_col`` also the text that the ids decode to, in the same pass (as
    :func:`decode` would give it).

    Every row is encoded by itself, so repeated rows agree and an empty table gives none; an
    existing column of that name is replaced. U+2581 in a text counts as a blank."""
    names = [c for c in docs.columns if c not in (ids_col, decoded_col)]
    d = docs.select(*[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(names)])
    at = names.index(text_col)

    @frugal
    def run(batches):
        m = model(model_path)
        for b in blocks(batches, f"__in{at}", FINE_BLOCK):
            got = m.encode([t or "" for t in b.column(at).to_pylist()])
            ends = np.cumsum([0] + [len(x) // 4 for x in got]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(got), "<i4")))
            new = [ids]
            if decoded_col:
                new.append(pa.array([m.decode(np.frombuffer(x, "<i4").tolist()) for x in got], pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, "__new", "__text"][: b.num_columns + len(new)])

    schema = ", ".join(f"__in{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    out = d.mapInArrow(run, f"{schema}, __new array<int>" + (", __text string" if decoded_col else ""))
    more = [F.col("__text").alias(decoded_col)] if decoded_col else []
    return out.select(*[F.col(f"__in{i}").alias(c) for i, c in enumerate(names)], F.col("__new").alias(ids_col), *more)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text of the ids (null ids: empty). The blank that encoding
    puts before a text is dropped; bytes that are no UTF-8 become U+FFFD."""
    names = [c for c in df.columns if c != text_col]
    d = df.select(*[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(names)])
    at = names.index(ids_col)

    def run(batches, rows: int = 256):
        m = model(model_path)
        for whole in batches:
            for b in (whole.slice(i, rows) for i in range(0, whole.num_rows, rows)):
                text = pa.array([m.decode(x or []) for x in b.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns, text], [*b.schema.names, "__new"])

    schema = ", ".join(f"__in{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    out = d.mapInArrow(run, f"{schema}, __new string")
    return out.select(*[F.col(f"__in{i}").alias(c) for i, c in enumerate(names)], F.col("__new").alias(text_col))
