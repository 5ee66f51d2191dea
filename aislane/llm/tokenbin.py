"""Token ids in binary files of patched frame-of-reference blocks.

A shard holds the ids of documents in ascending id order, cut into blocks of ``BLOCK`` ids whatever document they
belong to. Each block stores its minimum, and of every id the difference to it, packed at the width that
``PERCENTILE`` of the differences fit in; the few larger ones keep their low bits there and have position and high bits in
the block's exception list. A footer indexes where blocks start and which ids each document has, so a
reader fetches single documents by a few blocks. All numbers are little-endian.

    shard  := "PFR1" block* footer footer_length:u64 "PFR1"
    block  := minimum:u32 width:u8 exceptions:u16 count:u16 packed[ceil(count*width/8)]
              position:u16[exceptions] high:u32[exceptions]
    footer := n_blocks:u64 n_docs:u64 n_ids:u64 block_start:u64[n_blocks] doc_end:u64[n_docs]
              has_id:u8[n_docs] doc_id:i64[n_docs]

Tasks write shards under names of their own and return what they wrote; only the shards in that list
(``manifest``) count, so a repeated or lost task leaves a file that nobody reads. Files go to the shared folder through
Arrow's file systems, which take the same addresses as Spark's for local, HDFS and object stores.

Defined results: a null text is empty and has the end id alone. Null ids come first. Rows that repeat an id stand in the order of
their texts. An empty table has a manifest without shards.
"""

from __future__ import annotations

import string
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislane.llm.common import gathered, staged, worker_store
from aislane.session import scratch_path

MAGIC = b"PFR1"
BLOCK = 4096
PERCENTILE = 0.95
END_ID = 1
_HEAD = "<IBHH"
_FOOT = "<QQQ"

MANIFEST = "shard string, first_id long, n_docs long, n_ids long, n_bytes long, part int"


def encode_block(ids: np.ndarray) -> bytes:
    """One block of at most 65,535 ids."""
    least = int(ids.min())
    rest = (ids - np.uint32(least)).astype(np.uint32)
    wide = np.sort(rest)[max(0, int(np.ceil(PERCENTILE * len(rest))) - 1)]
    width = int(wide).bit_length()
    if width:
        bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        packed = np.packbits(np.ascontiguousarray(bits).reshape(-1), bitorder="little").tobytes()
    else:
        packed = b""
    high = (rest.astype(np.uint64) >> np.uint64(width)).astype("<u4")
    at = np.flatnonzero(high)
    return b"".join(
        (struct.pack(_HEAD, least, width, len(at), len(ids)), packed, at.astype("<u2").tobytes(), high[at].tobytes())
    )


def decode_block(data: bytes) -> np.ndarray:
    least, width, exceptions, count = struct.unpack_from(_HEAD, data)
    at, size = struct.calcsize(_HEAD), -(-count * width // 8)
    rest = np.zeros(count, dtype=np.uint64)
    if width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count * width, bitorder="little")
        full = np.zeros((count, 32), dtype=np.uint8)
        full[:, :width] = bits.reshape(count, width)
        rest = np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(-1).astype(np.uint64)
    at += size
    places = np.frombuffer(data, "<u2", exceptions, at)
    high = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    rest[places] |= high.astype(np.uint64) << np.uint64(width)
    return (rest + np.uint64(least)).astype("<u4")


class ShardWriter:
    """Takes documents in order, keeps one block in memory."""

    def __init__(self, stream):
        self.stream, self.at, self.starts = stream, 0, []
        self.pending, self.waiting = [], 0
        self.ends, self.doc_ids, self.n_ids = [], [], 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.add_many([doc_id], ids, np.array([len(ids)]))

    def add_many(self, doc_ids: list[int | None], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Documents whose ids follow each other, ``sizes`` of them each."""
        self.pending.append(ids)
        self.waiting += len(ids)
        self.ends += (self.n_ids + np.cumsum(sizes)).tolist()
        self.n_ids += len(ids)
        self.doc_ids += doc_ids
        if self.waiting >= 16 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) - len(ids) % BLOCK
        for begin in range(0, whole, BLOCK):
            self.starts.append(self.at)
            self._put(encode_block(ids[begin : min(begin + BLOCK, whole)]))
        self.pending, self.waiting = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        footer = b"".join(
            (
                struct.pack(_FOOT, len(self.starts), len(self.ends), self.n_ids),
                np.array(self.starts, "<u8").tobytes(),
                np.array(self.ends, "<u8").tobytes(),
                np.array([i is not None for i in self.doc_ids], "u1").tobytes(),
                np.array([i or 0 for i in self.doc_ids], "<i8").tobytes(),
            )
        )
        self._put(footer + struct.pack("<Q", len(footer)) + MAGIC)


class ShardReader:
    """Random access by block: only the footer and the blocks asked for are read."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - 12)
        tail = file.read(12)
        if tail[8:] != MAGIC:
            raise ValueError("not a whole shard")
        (length,) = struct.unpack("<Q", tail[:8])
        file.seek(size - 12 - length)
        footer = file.read(length)
        blocks, docs, self.n_ids = struct.unpack_from(_FOOT, footer)
        at = struct.calcsize(_FOOT)
        self.starts = np.append(np.frombuffer(footer, "<u8", blocks, at), size - 12 - length).astype(np.int64)
        self.ends = np.frombuffer(footer, "<u8", docs, at + 8 * blocks).astype(np.int64)
        has_id = np.frombuffer(footer, "u1", docs, at + 8 * (blocks + docs))
        ids = np.frombuffer(footer, "<i8", docs, at + 8 * blocks + 9 * docs)
        self.doc_ids = [int(i) if h else None for i, h in zip(ids, has_id, strict=True)]

    def block(self, k: int) -> np.ndarray:
        self.file.seek(int(self.starts[k]))
        return decode_block(self.file.read(int(self.starts[k + 1] - self.starts[k])))

    def document(self, k: int) -> np.ndarray:
        """The ids of the shard's k-th document."""
        begin, end = (int(self.ends[k - 1]) if k else 0), int(self.ends[k])
        if begin == end:
            return np.zeros(0, "<u4")
        first = begin // BLOCK
        ids = np.concatenate([self.block(b) for b in range(first, (end - 1) // BLOCK + 1)])
        return ids[begin - first * BLOCK : end - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Every document as (id, its first id's place in the shard, ids), blocks read once and in order."""
        have, base, k = np.zeros(0, "<u4"), 0, 0
        begin = 0
        for doc_id, end in zip(self.doc_ids, self.ends.tolist(), strict=True):
            parts, held = [have[begin - base :]], base + len(have)
            while held < end:
                parts.append(self.block(k))
                held += len(parts[-1])
                k += 1
            if len(parts) > 1 or begin - base > 16 * BLOCK:
                have, base = np.concatenate(parts), begin
            yield doc_id, begin, have[begin - base : end - base]
            begin = end


def _open(address: str):
    """Arrow's file system and path of a Spark address."""
    if "://" not in address and not address.startswith("file:"):
        return pafs.LocalFileSystem(), address
    if address.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(address)


class WordEncoder:
    """Encodes by a lower-casing tokenizer that drops white space, never joins what stands on two sides of it, and ends words in a mark.

    Each distinct run between white space goes to the library once per worker, of which about ``MOST_RUNS`` (and ``MOST_BYTES``) are remembered,
    those used last; they and their ids are Arrow columns, and documents are put together from them. Runs of letters are sent many at a time and
    taken apart at the ends of words; if their number disagrees, and for all other runs, each is encoded on its own. An ASCII run differs
    from its lower-case form in nothing, and so do ``LETTERS``; small ASCII letters pass everything before the model unchanged. ``MARKS``
    behind ``LETTERS`` are a word of their own, so both are remembered apart.
    """

    MOST_RUNS = 600_000
    MOST_BYTES = 64 << 20
    TOGETHER = 1000
    END_OF_WORD = "</w>"
    # ASCII's punctuation without the apostrophe, which begins words like 's.
    MARKS = string.punctuation.replace("'", "")
    # Letters to every version of Unicode, which meet no combining mark among themselves and stay one letter in lower case.
    LETTERS = "".join(c for c in map(chr, range(0x180)) if c.isalpha() and c != "\u0130")

    def __init__(self, path: str):
        import os

        # One thread per task, as Spark plans it; read when the library first encodes.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(self.END_OF_WORD)]] = True
        # What is remembered, its ids as bytes, and the call that used it last.
        self.known, self.known_ids = pa.array([""], pa.string()), pa.array([b""], pa.large_binary())
        self.used, self.calls = np.zeros(1, np.int64), 0

    def _alone(self, runs: list[str]) -> pa.Array:
        found = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
        return pa.array([np.array(e.ids, "<u4").tobytes() for e in found], pa.large_binary())

    def _together(self, runs: list[str]) -> pa.Array:
        data = " ".join(runs)
        library = self.plain if data.isascii() else self.tokenizer
        (encoded,) = library.encode_batch_fast([data], add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4")
        bounds = np.flatnonzero(self.ends[ids]) + 1
        if len(bounds) != len(runs):
            return self._alone(runs)
        at = 4 * np.append(0, bounds).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(runs), [None, pa.py_buffer(at), pa.py_buffer(ids)])

    def _learn(self, runs: list[str]) -> None:
        small, letters, others = [], [], []
        for run in runs:
            (others if not run.isalpha() else small if run.isascii() else letters).append(run)
        words, ids = [self.known], [self.known_ids]
        for batch, encode in ((small, self._together), (letters, self._together), (others, self._alone)):
            for begin in range(0, len(batch), self.TOGETHER):
                part = batch[begin : begin + self.TOGETHER]
                words.append(pa.array(part, pa.string()))
                ids.append(encode(part))
        self.known, self.known_ids = pa.concat_arrays(words), pa.concat_arrays(ids)
        self.used = np.append(self.used, np.full(len(runs), self.calls))

    def _forget(self) -> None:
        """Keep half of what may be remembered: what was used last, of one call the small ones first."""
        size = pc.add(pc.binary_length(self.known), pc.binary_length(self.known_ids)).to_numpy()
        kept = np.lexsort((size, -self.used))[: self.MOST_RUNS // 2]
        kept = kept[np.cumsum(size[kept]) <= self.MOST_BYTES // 2]
        self.known, self.known_ids, self.used = self.known.take(kept), self.known_ids.take(kept), self.used[kept]

    def _look_up(self, runs: pa.Array) -> pa.Array:
        """The ids of different runs, as bytes; new ones go to the library together."""
        self.calls += 1
        if len(self.known) > self.MOST_RUNS or self.known.nbytes + self.known_ids.nbytes > self.MOST_BYTES:
            self._forget()
        places = pc.index_in(runs, value_set=self.known)
        if places.null_count:
            had, new = len(self.known), runs.filter(places.is_null())
            self._learn(new.to_pylist())
            found = pc.add(pc.index_in(new, value_set=self.known.slice(had)), pa.scalar(had, pa.int32()))
            places = pc.replace_with_mask(places, places.is_null(), found)
        self.used[places.to_numpy()] = self.calls
        return self.known_ids.take(places)

    def _ids_of(self, runs: pa.Array) -> pa.Array:
        """The ids of different runs as they stand in texts, as bytes."""
        marks, letters = pc.utf8_ltrim(runs, self.LETTERS), pc.ascii_rtrim(runs, self.MARKS)
        is_word = pc.and_(pc.equal(pc.ascii_ltrim(marks, self.MARKS), ""), pc.not_equal(letters, ""))
        others = pc.if_else(pc.string_is_ascii(runs), pc.ascii_lower(runs), runs)
        parts = pc.if_else(is_word, pc.utf8_lower(letters), others), pc.if_else(is_word, marks, "")
        coded = pa.concat_arrays(parts).dictionary_encode()
        ids = self._look_up(coded.dictionary)
        front, back = ids.take(coded.indices[: len(runs)]), ids.take(coded.indices[len(runs) :])
        return pc.binary_join_element_wise(front, back, pa.scalar(b"", pa.large_binary()))

    def encode_texts(self, texts: pa.Array, end: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end``, and how many each text has; new runs go to the library together."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        found = pc.ascii_split_whitespace(texts)
        coded = found.flatten().dictionary_encode()
        held = pa.concat_arrays([self._ids_of(coded.dictionary), pa.array([np.array(end, "<u4").tobytes()], pa.large_binary())])
        # Runs and ends in their order, then their ids.
        last = np.cumsum(found.value_lengths().to_numpy().astype(np.int64) + 1) - 1
        codes = np.full(last[-1] + 1, len(held) - 1, np.int32)
        is_run = np.ones(len(codes), bool)
        is_run[last] = False
        codes[is_run] = coded.indices.to_numpy()
        _, at, data = held.take(pa.array(codes)).buffers()
        until = np.frombuffer(at, np.int64, len(codes) + 1)[last + 1] // 4
        return np.frombuffer(data or b"", "<u4", until[-1]), np.diff(until, prepend=0)

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, sizes = self.encode_texts(pa.array(texts, pa.string()), [])
        return np.split(ids, np.cumsum(sizes)[:-1]) if texts else []

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]


def write_shards(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    partitions: int | None = None,
) -> DataFrame:
    """Encode every text, end each with ``end_id``, write shards in ascending id order; returns the manifest.

    Ranges are cut by id and, so that a repeated id can't fill one shard, by a hash of the text.
    """
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    keys = ["doc_id", F.xxhash64("text")]
    ranged = narrow.repartitionByRange(partitions, *keys) if partitions else narrow.repartitionByRange(*keys)
    in_order = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, shard, first, part = None, f"{uuid.uuid4().hex}.pfr", None, 0
        store = worker_store()
        encoder = store[tokenizer_path] = store.get(tokenizer_path) or WordEncoder(tokenizer_path)
        files, path = _open(f"{folder}/{shard}")
        for some in gathered(batches, 1):
            if out is None:
                files.create_dir(path.rpartition("/")[0], recursive=True)
                stream = files.open_output_stream(path)
                out, first = ShardWriter(stream), some.column(0)[0].as_py()
                part = _partition()
            out.add_many(some.column(0).to_pylist(), *encoder.encode_texts(some.column(1), [end_id]))
        if out is not None:
            out.close()
            stream.close()
            row = {"shard": [shard], "first_id": [first], "n_docs": [len(out.ends)], "n_ids": [out.n_ids],
                   "n_bytes": [out.at], "part": [part]}
            kind = pa.schema([("shard", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()),
                              ("n_ids", pa.int64()), ("n_bytes", pa.int64()), ("part", pa.int32())])
            yield pa.RecordBatch.from_pydict(row, schema=kind)

    return staged(in_order.mapInArrow(write, MANIFEST), "manifest")


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the manifest's shards, read from the files.

    ``doc_id, start`` (ids of all documents before it), ``n_tokens, ids_crc32``. One manifest row is a shard,
    so the running sum runs over few rows; a task reads a shard block by block.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("part", "shard", "n_ids").withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                files, path = _open(f"{folder}/{shard}")
                with files.open_input_file(path) as file:
                    yield from _read_rows(ShardReader(file), start)

    count = manifest.count()
    spread = placed.select("shard", "start").repartition(max(1, count), "shard")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read_rows(reader: ShardReader, start: int, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    columns: tuple[list, ...] = ([], [], [], [])

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
        )
        for c in columns:
            c.clear()
        return made

    for doc_id, begin, ids in reader.documents():
        for column, value in zip(
            columns, (doc_id, start + begin, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True
        ):
            column.append(value)
        if len(columns[0]) >= rows:
            yield batch()
    if columns[0]:
        yield batch()


def shard_folder(spark) -> str:
    return scratch_path(spark, "shards")
