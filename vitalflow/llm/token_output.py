"""Token-ID output: blocks of ids coded by a static range asymmetric numeral system (rANS).

One frequency table, counted over all documents, is shared by every block and written beside them. A
block holds consecutive documents and is coded on its own by ``LANES`` interleaved coders, so blocks
decode in parallel and in any order. A block's bytes:

    magic "VRB1", ids, lanes, words (uint32 each), final state of every lane (uint64: the decoder's
    checkpoint to start from), place of the word pointer at every ``EVERY``-th step and the states
    there (checkpoints: decoding can start at any of them), crc32 of the ids, code words (uint32).

The checkpoints part a block into segments that are decoded side by side; each must end in the state and
at the word that the next one begins with.

The files: ``blocks`` (rows of blocks next to their documents' ids and lengths, written in ascending
doc_id order: range-partitioned, sorted, each with the number of ids before it in its range) and
``frequencies`` (a row for each id of the vocabulary that occurs). Nothing else is needed to read them.

Defined cases: a null text counts as empty and yields the end id alone; null doc_ids come first;
rows that share a doc_id are separate documents, ordered by a hash of the text; a damaged block
raises ValueError; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import pick, small_batches, staged
from .hashing import KEPT, released, sliced

END_ID = 2
LANES = 1024
EVERY = 32                   # steps between checkpoints
BLOCK_IDS = 1 << 19          # a block is closed after so many ids: 16 segments
LOWEST = np.uint64(1 << 31)
MAGIC = b"VRB1"
# letters that stay single letters when lower-cased and normalised
LOWER = frozenset(map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
STOPS = bytes(b for b in range(33, 127) if not chr(b).isalnum())   # ASCII punctuation


# --- tokens ------------------------------------------------------------------------

class Words(dict):
    """Bytes of the ids (uint32) of each word as written between white space, filled on demand.

    The tokenizer parts a text at white space first, so a text's ids are its words' ids in order. A
    word of lower-case Latin letters, with or without ASCII punctuation after it, is one piece (and one
    more for the punctuation): its ids come straight from the tokenizer's model, or from the same
    word without punctuation if that is remembered. All else goes through the whole tokenizer. The strings of special tokens are taken out first, in the case they
    are written in, as the tokenizer does; a word that becomes one only in lower case is plain text.
    """

    MOST = 1 << 20           # words remembered, some 170 MB; beyond it the memory starts anew

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.between = Tokenizer.from_file(path)  # for what stands between special tokens
        self.between.encode_special_tokens = True
        self.model = self.between.model
        self.special = {t.content.encode(): array("I", [i]).tobytes()
                        for i, t in self.between.get_added_tokens_decoder().items() if t.special}
        longest = sorted(self.special, key=len, reverse=True)
        self.parts = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")")
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        other = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(other)}
        self.stops: dict[bytes, bytes] = {}       # ids of runs of punctuation

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(STOPS)
        piece = self._piece(stem)
        if piece is None:
            out = self._whole(word)
        else:
            out = self.get(stem) or array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
            if len(stem) < len(word):
                out += self._stops(word[len(stem):])
        if len(self) >= self.MOST:
            self.clear()
        self[word] = out
        return out

    def _whole(self, word: bytes) -> bytes:
        return array("I", self.between.encode(word.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids).tobytes()

    def _stops(self, run: bytes) -> bytes:
        if run not in self.stops:
            if len(self.stops) > 1000:
                self.stops.clear()
            self.stops[run] = self._whole(run)
        return self.stops[run]

    def _piece(self, stem: bytes) -> str | None:
        """The model's spelling of a word that is one piece: letters a-z or of Latin-1, lower-cased; else None."""
        if stem.isalpha() and stem.islower():
            return stem.decode()
        if not stem or stem.isascii():
            return None
        text = stem.decode("utf-8", "surrogatepass").lower()
        return "".join(map(self.letters.__getitem__, text.encode())) if LOWER.issuperset(text) else None

    def ids(self, text: str | bytes | None) -> bytes:
        raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
        if not any(s in raw for s in self.special):
            return self._between(raw)
        return b"".join(self.special[p] if i % 2 else self._between(p) for i, p in enumerate(self.parts.split(raw)))

    def _between(self, raw: bytes) -> bytes:
        # bytes.lower() and split() touch ASCII only, as the tokenizer does and more
        return b"".join(map(self.__getitem__, raw.lower().split()))


_WORDS: dict[str, Words] = {}
KEPT["words"] = _WORDS.clear


def words(path: str) -> Words:
    """One per worker and tokenizer file, kept between tasks."""
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


# --- rANS --------------------------------------------------------------------------

class Frequencies:
    """Counts scaled to 2**bits, at least 1 for each id that occurs."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, counts = np.asarray(ids)[order].astype(np.uint32), np.asarray(counts)[order].astype(float)
        self.bits = max(16, int(len(self.ids)).bit_length() + 2)
        total = 1 << self.bits
        f = np.maximum(1, np.floor(counts / max(1.0, counts.sum()) * total)).astype(np.int64)
        while len(f) and (gap := total - int(f.sum())):  # the largest ones take up what rounding leaves
            top = np.argsort(-f, kind="stable")[: max(1, min(len(f), abs(gap)))]
            top = top[f[top] > 1] if gap < 0 else top
            f[top] += np.sign(gap)
        self.f = f.astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(f)[:-1]]).astype(np.uint64) if len(f) else np.zeros(0, np.uint64)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For coding: place of an id; for decoding: place of a slot."""
        place = np.zeros(int(self.ids.max()) + 1 if len(self.ids) else 0, np.uint32)
        place[self.ids] = np.arange(len(self.ids))
        return place, np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.f.astype(np.int64)), self.ids


def encode(ids: np.ndarray, freq: Frequencies, place: np.ndarray, lanes: int = LANES, every: int = EVERY) -> bytes:
    """One block. Id i belongs to lane i % lanes; coders run backwards, so that decoding runs forwards."""
    n = len(ids)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    grid = np.zeros(steps * lanes, np.uint32)
    grid[:n] = place[ids]
    grid = grid.reshape(steps, lanes)
    f, first = freq.f[grid], freq.first[grid]
    full = np.uint64(63 - freq.bits)
    state = np.full(lanes, LOWEST)
    out, written, marks = [], 0, []
    for s in range(steps - 1, -1, -1):
        m = lanes if (s + 1) * lanes <= n else n - s * lanes
        x, fs = state[:m], f[s, :m]
        spill = x >= (fs << full)
        words_ = x[spill].astype(np.uint32)
        out.append(words_)
        written += len(words_)
        x = np.where(spill, x >> np.uint64(32), x)
        q = x // fs
        state[:m] = (q << np.uint64(freq.bits)) + (x - q * fs) + first[s, :m]
        if s % every == 0 and s:
            marks.append((s, written, state.copy()))
    marks = [(s, written - w, x) for s, w, x in reversed(marks)]
    code = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    head = MAGIC + struct.pack("<4I", n, lanes, len(code), len(marks)) + state.astype("<u8").tobytes()
    head += b"".join(struct.pack("<2I", s, w) + x.astype("<u8").tobytes() for s, w, x in marks)
    return head + struct.pack("<I", zlib.crc32(ids.astype("<u4").tobytes())) + code.astype("<u4").tobytes()


def _parts(block: bytes):
    """ids, lanes, marks as (step, word pointer, states) with the start and the end, crc, code words."""
    if len(block) < 20 or block[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n, lanes, n_code, n_marks = struct.unpack_from("<4I", block, 4)
    at, size = 20 + 8 * lanes, 8 + 8 * lanes
    if len(block) != at + n_marks * size + 4 + 4 * n_code:
        raise ValueError("a block of token ids is cut short")
    marks = [(0, 0, np.frombuffer(block, "<u8", lanes, 20))]
    for i in range(n_marks):
        marks.append((*struct.unpack_from("<2I", block, at + i * size), np.frombuffer(block, "<u8", lanes, at + i * size + 8)))
    steps = -(-n // lanes) if lanes else 0
    marks.append((steps, n_code, np.full(lanes, LOWEST)))   # where every coder began
    at += n_marks * size
    return n, lanes, marks, struct.unpack_from("<I", block, at)[0], np.frombuffer(block, "<u4", n_code, at + 4).astype(np.uint64)


def _segments(n: int, lanes: int, marks: list, code: np.ndarray, freq: Frequencies, slots: np.ndarray) -> np.ndarray:
    """Places of the ids between the first and the last of ``marks``: equally long segments, decoded side by side.

    Only the last step of a block may have fewer ids than lanes, so it is in a segment of its own.
    """
    bits, mask = np.uint64(freq.bits), np.uint64((1 << freq.bits) - 1)
    low, steps = marks[0][0], marks[1][0] - marks[0][0]
    state = np.stack([m[2] for m in marks[:-1]])
    pos = np.array([m[1] for m in marks[:-1]], np.int64)
    stop = np.array([m[1] for m in marks[1:]], np.int64)
    got = np.zeros((len(state), steps, lanes), np.uint32)
    for s in range(steps):
        width = min(lanes, n - (low + s) * lanes) if len(state) == 1 else lanes
        x = state[:, :width]
        slot = x & mask
        p = slots.take(slot.view(np.int64))
        got[:, s, :width] = p
        x = freq.f.take(p) * (x >> bits)
        x += slot
        x -= freq.first.take(p)
        need = x < LOWEST
        count = need.sum(1)
        if (pos + count > stop).any():
            raise ValueError("a block of token ids is damaged")
        at = (pos[:, None] + np.cumsum(need, axis=1) - 1)[need]
        x[need] = (x[need] << np.uint64(32)) | code[at]
        pos += count
        state[:, :width] = x
    if (pos != stop).any() or any((state[i] != marks[i + 1][2]).any() for i in range(len(state))):
        raise ValueError("a block of token ids is damaged")
    return got.reshape(-1)


def decode(block: bytes, freq: Frequencies, slots: np.ndarray, from_mark: int = 0) -> np.ndarray:
    """The ids of a block; from its ``from_mark``-th checkpoint on, if given (then without the checksum)."""
    n, lanes, marks, crc, code = _parts(block)
    first = marks[from_mark][0]
    # the last segment may be shorter and may end in an incomplete step
    parts = [_segments(n, lanes, marks[from_mark:-1], code, freq, slots)] if len(marks) - from_mark > 2 else []
    parts.append(_segments(n, lanes, marks[-2:], code, freq, slots))
    ids = freq.ids[np.concatenate(parts)[: n - first * lanes]]
    if not from_mark and zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("a block of token ids is damaged")
    return ids


# --- Spark jobs --------------------------------------------------------------------

CHUNK = "range int, at bigint, docs binary, lengths binary, ids binary, id int, n bigint"
BLOCK_FORMAT = "range int, at bigint, docs binary, lengths binary, block binary"


def _tokenize(path: str, end_id: int):
    """Sorted documents to chunks: ids of consecutive documents, and at the end counts of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, part = words(path), TaskContext.get().partitionId()
        schema = pa.schema([("range", pa.int32()), ("at", pa.int64()), ("docs", pa.binary()), ("lengths", pa.binary()),
                            ("ids", pa.binary()), ("id", pa.int32()), ("n", pa.int64())])
        end, counts, at = np.array([end_id], "<u4").tobytes(), np.zeros(0, np.int64), 0
        docs, lengths, parts, size = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            nonlocal counts, at, docs, lengths, parts, size
            ids = np.frombuffer(b"".join(parts), "<u4")
            seen = np.bincount(ids)
            if len(seen) > len(counts):
                seen[: len(counts)] += counts
                counts = seen
            else:
                counts[: len(seen)] += seen
            small = ids.astype("<u2") if ids.max() < 1 << 16 else ids
            row = [[part], [at], [_pack_docs(docs)], [np.array(lengths, "<i8").tobytes()],
                   [struct.pack("<I", small.dtype.itemsize) + small.tobytes()], [None], [None]]
            at += len(ids)
            docs, lengths, parts, size = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in (part for whole in batches for part in sliced(whole)):
            # as bytes: neither the texts nor their words become Python strings
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                got = own.ids(text) + end
                docs.append(doc)
                lengths.append(len(got) // 4)
                parts.append(got)
                size += len(got) // 4
                if size >= BLOCK_IDS:
                    yield chunk()
        if docs:
            yield chunk()
        used = np.flatnonzero(counts)
        if len(used):
            none = [None] * len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(used), pa.int32()), pa.array(none, pa.int64()), *[pa.array(none, pa.binary())] * 3,
                 pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], schema=schema)

    return released(run, "words")


def _pack_docs(docs: list) -> bytes:
    """Ids of documents as int64, and a byte for each that is null."""
    known = np.array([0 if d is None else d for d in docs], "<i8")
    return known.tobytes() + np.array([d is None for d in docs], np.uint8).tobytes()


def _unpack_docs(raw: bytes) -> list:
    n = len(raw) // 9
    return [None if gone else int(d) for d, gone in zip(np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n))]


def write_blocks(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text") -> str:
    """Writes the files (see above) and returns their folder, by default one in the shared checkpoint folder."""
    spark = docs.sparkSession
    small_batches(spark)
    path = path or scratch_path(spark, f"llm-token-files-{uuid.uuid4().hex}")
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("h", F.xxhash64("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows that share a doc_id, or have none, are dealt by their texts
    dealt = rows.repartitionByRange(ranges, "doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")
    chunks = staged(dealt.mapInArrow(_tokenize(tokenizer, end_id), CHUNK), "token-chunks")
    counted = chunks.where("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("n"))
    counted.coalesce(1).write.parquet(f"{path}/frequencies")
    freq = read_frequencies(spark, path)
    shared = spark.sparkContext.broadcast(freq)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        place, _, _ = own.tables()
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column("ids")[i].as_buffer()
                width = struct.unpack_from("<I", raw)[0]
                ids = np.frombuffer(raw, f"<u{width}", offset=4).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, 1) for c in ("range", "at", "docs", "lengths")]
                    + [pa.array([encode(ids, own, place)], pa.binary())], ["range", "at", "docs", "lengths", "block"])

    part = chunks.where("id IS NULL").select("range", "at", "docs", "lengths", "ids")
    part.mapInArrow(released(code), BLOCK_FORMAT).write.parquet(f"{path}/blocks")
    return path


def read_frequencies(spark: SparkSession, path: str) -> Frequencies:
    """The shared table: one row for each id of the vocabulary that occurs."""
    counted = spark.read.schema("id int, n bigint").parquet(f"{path}/frequencies").toArrow()
    return Frequencies(counted["id"].to_numpy(), counted["n"].to_numpy())


def read_blocks(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (uint32, little-endian) from the files alone.

    Without ``with_ids`` all ids are decoded and summed up, but not handed from Python to Spark.
    """
    small_batches(spark)
    freq = read_frequencies(spark, path)
    blocks = spark.read.schema(BLOCK_FORMAT).parquet(f"{path}/blocks")
    # the ids before each range: one row per range, bounded by the partition count
    ends = (blocks.select("range", "at", "lengths").mapInArrow(_ends, "range int, n bigint")
            .groupBy("range").agg(F.max("n").alias("n")).collect())
    before, at = {}, 0
    for r in sorted(ends, key=lambda r: r["range"]):
        before[r["range"]] = at
        at += r["n"]
    shared = spark.sparkContext.broadcast((freq, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, starts = shared.value
        _, slots, _ = own.tables()
        for batch in batches:
            for r in batch.to_pylist():
                ids = memoryview(decode(r["block"], own, slots).astype("<u4", copy=False)).cast("B")
                lengths = np.frombuffer(r["lengths"], "<i8")
                ends = np.cumsum(lengths)
                parts = [ids[4 * (e - n):4 * e] for n, e in zip(lengths.tolist(), ends.tolist())]
                columns = [pa.array(_unpack_docs(r["docs"]), pa.int64()), pa.array(starts[r["range"]] + r["at"] + ends - lengths, pa.int64()),
                           pa.array(lengths, pa.int64()), pa.array(list(map(zlib.crc32, parts)), pa.int64())]
                if with_ids:
                    columns.append(pa.array(list(map(bytes, parts)), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ["doc_id bigint", "start bigint", "n_tokens bigint", "ids_crc32 bigint"] + ["ids binary"] * with_ids
    names = [k.split(" ")[0] for k in kinds]
    return blocks.mapInArrow(released(run), ", ".join(kinds))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [r["at"] + int(np.frombuffer(r["lengths"], "<i8").sum()) for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("range"), pa.array(n, pa.int64())], ["range", "n"])


def query(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return read_blocks(docs.sparkSession, write_blocks(docs, tokenizer), with_ids=False)
