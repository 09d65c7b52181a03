"""Token sequences in training order: a keyed permutation gives every sequence its slot in files of fixed stride."""

from __future__ import annotations

import base64
import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import modest_batches, stored, text_buffers
from vecframe.llm.shingles import mix, span_hashes
from vecframe.session import shared_dir

SEQUENCE = 256
SHARD_SEQUENCES = 65_536
KEY = 20_240_601
ROUNDS = 6
#: Texts whose token lengths are kept together, and the bits of a hash that the table of tokens leaves out.
PIECE_ROWS = 256
FIRST_BITS = np.uint64(42)
#: Splits a text before the merges; the pattern that belongs to the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Permutation:
    """A keyed permutation of 0 to n - 1: a Feistel network on the next even number of bits, walked until below n."""

    def __init__(self, n: int, key: int, rounds: int = ROUNDS):
        self.n, self.half = n, np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        self.keys = np.random.default_rng(key).integers(0, 2**63, rounds, dtype=np.uint64)

    def _through(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in keys:
            if back:
                left, right = right ^ (mix(left + k) & self.mask), left
            else:
                left, right = right, left ^ (mix(right + k) & self.mask)
        return left << self.half | right

    def _walk(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        x = self._through(np.asarray(x).astype(np.uint64), keys, back)
        while len(out := np.flatnonzero(x >= np.uint64(self.n))):
            x[out] = self._through(x[out], keys, back)
        return x.astype(np.int64)

    def slots(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self.keys, False)

    def index(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self.keys[::-1], True)


#: Where no two white space characters meet, this part of the pattern matches what the last part would; without it splitting is much faster.
LOOK_AHEAD = r"\s+(?!\S)|"
MEETING_SPACES = re.compile(r"\s\s")


@functools.lru_cache(maxsize=4)
def encoder(vocabulary: bytes, pattern: str = PATTERN):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write_shards(docs: DataFrame, vocabulary: str, *, folder: str | None = None, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, shard_sequences: int = SHARD_SEQUENCES, order_key: int = KEY) -> DataFrame:
    """Write all documents as token sequences in shuffled order; one row per sequence.

    Rows are (key, chunk, slot, shard, place, n_tokens, checksum). A document's tokens, closed by one
    end mark, are cut into chunks of ``sequence``; the last is filled with end marks. Sequences are numbered
    through the table's partitions, and a keyed permutation of these numbers gives the slots 0 to n - 1. Slot s is at
    place s mod ``shard_sequences`` of file s // ``shard_sequences``, so any stretch of the training order is one
    seek (see ``read_sequences``). ``checksum`` is the crc32 of the whole sequence as stored. ``manifest.json`` is written last.

    ``vocabulary`` is a rank file of a byte-level BPE tokenizer with at most 65,535 ids; the first free
    id is the end mark. Ids are stored as little-endian 16-bit numbers.

    Null and empty texts are one sequence of end marks with one token. Rows with equal keys are documents of their own. Null
    keys stay null. An empty table gives no rows and no files but the manifest. Other columns are not read.

    ``docs`` is read twice: once to tokenise it and count sequences, for the permutation needs their number, and once
    to write. So it should be a stored table; a partition that changes in between fails the job. Only counts per partition reach the driver. What the first reading
    leaves for the second, in the shared folder, are the lengths of the tokens, a file per partition, a fifth of the size of the ids: with them the ids are looked up.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    folder = folder or shared_dir(spark, "token-shards")
    with open(vocabulary, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())
    end = max(int(line.split()[1]) for line in ranks.value.splitlines() if line.strip()) + 1
    if end > 0xFFFF:
        raise ValueError("ids do not fit 16 bits")
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    aside = shared_dir(spark, "token-lengths")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, total, widths = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, vocabulary_of(ranks.value).widths
        system, inner = _file_system(aside)
        system.create_dir(inner, recursive=True)
        with system.open_output_stream(f"{inner}/.{part}-{attempt}") as file, pa.CompressedOutputStream(file, "zstd") as out:
            for batch in batches:
                for at in range(0, batch.num_rows, PIECE_ROWS):
                    ids = [np.array(_tokens(t, ranks.value), np.int64) for t in batch.column("text").slice(at, PIECE_ROWS).to_pylist()]
                    counts = np.array([len(i) for i in ids], "<u4")
                    out.write(np.array([len(ids)], "<u4").tobytes() + counts.tobytes())
                    out.write(widths[np.concatenate(ids)].tobytes())
                    total += int((counts // sequence + 1).sum())
        system.move(f"{inner}/.{part}-{attempt}", f"{inner}/{part}")
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([total], pa.int64())], names=["part", "sequences"])

    counts = {r.part: r.sequences for r in rows.mapInArrow(lengths, "part long, sequences long").collect()}
    offsets, total = {}, 0
    for part in sorted(counts):
        offsets[part], total = total, total + counts[part]
    order = Permutation(total, order_key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, known, source = TaskContext.get().partitionId(), 0, vocabulary_of(ranks.value), None
        for batch in batches:
            if source is None:
                system, inner = _file_system(aside)
                source = KeptLengths(pa.CompressedInputStream(system.open_input_stream(f"{inner}/{part}"), "zstd"))
            for at in range(0, batch.num_rows, PIECE_ROWS):
                piece = batch.slice(at, PIECE_ROWS)
                kept, widths = source.take(piece.num_rows)
                ids = known.ids(*text_buffers(piece.column("text")), kept, widths)
                tokens = [np.append(t, np.uint16(end)) for t in np.split(ids, np.cumsum(kept)[:-1])]
                chunks = np.array([(len(t) - 1) // sequence + 1 for t in tokens])
                chunk = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                sizes = np.minimum(np.repeat([len(t) for t in tokens], chunks) - chunk * sequence, sequence)
                body = [t[c * sequence : (c + 1) * sequence].tobytes() for t, n in zip(tokens, chunks, strict=True) for c in range(n)]
                slots = order.slots(offsets.get(part, 0) + done + np.arange(len(chunk)))
                done += len(chunk)
                id_ = piece.column("id").take(pa.array(np.repeat(np.arange(len(tokens)), chunks)))
                yield pa.RecordBatch.from_arrays([id_, pa.array(chunk), pa.array(slots), pa.array(slots // shard_sequences), pa.array(sizes), pa.array(body, pa.binary())], names=["id", "chunk", "slot", "shard", "n_tokens", "body"])
        if done != counts.get(part, 0):
            raise ValueError(f"partition {part} had {counts.get(part, 0)} sequences and now has {done}: the table must not change while it is read twice")

    id_type = dict(rows.dtypes)["id"]
    sequences = rows.mapInArrow(cut, f"id {id_type}, chunk long, slot long, shard long, n_tokens long, body binary")
    shards = -(-total // shard_sequences)
    placed = sequences.repartitionById(max(1, shards), F.col("shard").cast("int")).sortWithinPartitions("slot")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = _file_system(folder)
        system.create_dir(inner, recursive=True)
        attempt, at, out = TaskContext.get().taskAttemptId(), None, None
        for batch in batches:
            for shard in np.unique(batch.column("shard").to_numpy()):
                own = batch.filter(pa.array(batch.column("shard").to_numpy() == shard))
                if shard != at:
                    _finish(system, inner, at, attempt, out)
                    at, out = shard, system.open_output_stream(f"{inner}/.{shard:06d}-{attempt}")
                whole = [_filled(b, end, sequence) for b in own.column("body").to_pylist()]
                out.write(b"".join(whole))
                checks = pa.array([zlib.crc32(w) for w in whole], pa.int64())
                place = pa.array(own.column("slot").to_numpy() % shard_sequences)
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in ("id", "chunk", "slot", "shard")), place, own.column("n_tokens"), checks], names=["id", "chunk", "slot", "shard", "place", "n_tokens", "checksum"])
        _finish(system, inner, at, attempt, out)

    index = stored(placed.mapInArrow(save, f"id {id_type}, chunk long, slot long, shard long, place long, n_tokens long, checksum long"), "token-index")
    system, inner = _file_system(folder)
    system.create_dir(inner, recursive=True)
    with system.open_output_stream(f"{inner}/manifest.json") as out:
        out.write(json.dumps({"sequences": total, "sequence": sequence, "shard_sequences": shard_sequences, "end": end, "key": order_key, "dtype": "<u2"}).encode())
    return index.withColumnRenamed("id", key)


class Vocabulary:
    """The tokens of a rank file: their lengths in bytes, and their ids by a hash of their bytes."""

    def __init__(self, ranks: bytes):
        pairs = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, ranks.splitlines()) if a)
        self.widths = np.zeros(pairs[-1][0] + 1, np.uint8)
        if max(len(t) for _, t in pairs) > 255:
            raise ValueError("a token of more than 255 bytes")
        numbers = np.array([n for n, _ in pairs])
        self.widths[numbers] = [len(t) for _, t in pairs]
        ends = np.cumsum([len(t) for _, t in pairs])
        hashes = span_hashes(np.frombuffer(b"".join(t for _, t in pairs), np.uint8), ends - self.widths[numbers], ends)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], numbers[order].astype(np.uint16)
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two tokens have one hash")
        # Most tokens are found by the first bits of their hash; where two share these, by search.
        first = self.hashes >> FIRST_BITS
        self.table = np.full(1 << (64 - int(FIRST_BITS)), -1, np.int32)
        self.table[first.astype(np.int64)] = self.numbers
        self.table[first[1:][first[1:] == first[:-1]].astype(np.int64)] = -1

    def ids(self, data: np.ndarray, bounds: np.ndarray, counts: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """Ids of texts one after the other (bytes and bounds), from the number of tokens of each and the length of each token."""
        ends = np.cumsum(widths, dtype=np.int64)
        if len(counts) != len(bounds) - 1 or not np.array_equal(np.append(0, ends)[np.cumsum(counts)], bounds[1:]):
            raise ValueError("the texts are not those that were tokenised: the table must not change while it is read twice")
        hashes = span_hashes(data, ends - widths, ends)
        found = self.table[(hashes >> FIRST_BITS).astype(np.int64)]
        rare = np.flatnonzero(found < 0)
        if len(rare):
            at = np.minimum(np.searchsorted(self.hashes, hashes[rare]), len(self.hashes) - 1)
            if (self.hashes[at] != hashes[rare]).any():
                raise ValueError("the texts are not those that were tokenised: the table must not change while it is read twice")
            found[rare] = self.numbers[at]
        return found.astype("<u2")


class KeptLengths:
    """Reads what the first reading left: blocks of a number of texts, their numbers of tokens, and the tokens' lengths."""

    def __init__(self, source):
        self.source, self.counts, self.widths = source, np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def take(self, texts: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.counts) < texts and (head := self.source.read(4)):
            counts = np.frombuffer(self.source.read(4 * int(np.frombuffer(head, "<u4")[0])), "<u4").astype(np.int64)
            self.counts = np.concatenate([self.counts, counts])
            self.widths = np.concatenate([self.widths, np.frombuffer(self.source.read(int(counts.sum())), np.uint8)])
        counts, self.counts = self.counts[:texts], self.counts[texts:]
        n = int(counts.sum())
        widths, self.widths = self.widths[:n], self.widths[n:]
        return counts, widths


@functools.lru_cache(maxsize=4)
def vocabulary_of(ranks: bytes) -> Vocabulary:
    return Vocabulary(ranks)


def _tokens(text: str, vocabulary: bytes) -> list[int]:
    pattern = PATTERN if MEETING_SPACES.search(text) else PATTERN.replace(LOOK_AHEAD, "")
    return encoder(vocabulary, pattern).encode_ordinary(text)


def _filled(body: bytes, end: int, sequence: int) -> bytes:
    return body + np.full(sequence - len(body) // 2, end, "<u2").tobytes()


def _finish(system, inner: str, shard, attempt: int, out) -> None:
    """Close a shard and give it its name; a task that runs again puts the same file in its place."""
    if out is not None:
        out.close()
        system.move(f"{inner}/.{shard:06d}-{attempt}", f"{inner}/{shard:06d}.bin")


def _file_system(folder: str):
    return fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


def read_sequences(folder: str, start: int, count: int) -> np.ndarray:
    """Sequences ``start`` to ``start + count - 1`` of the training order, by one seek per file; fewer at the end."""
    system, inner = _file_system(folder)
    with system.open_input_stream(f"{inner}/manifest.json") as file:
        about = json.loads(file.read())
    stride, out = about["sequence"] * 2, []
    end = min(start + count, about["sequences"])
    while start < end:
        shard, place = divmod(start, about["shard_sequences"])
        take = min(end - start, about["shard_sequences"] - place)
        with system.open_input_file(f"{inner}/{shard:06d}.bin") as file:
            file.seek(place * stride)
            out.append(np.frombuffer(file.read(take * stride), about["dtype"]).reshape(take, -1))
        start += take
    return np.concatenate(out) if out else np.zeros((0, about["sequence"]), about["dtype"])
