"""Token-id output: ids of documents in files of Simple-8b words, written and read as a Spark data source.

A data set is a folder of files and an index. A file holds blocks, each the
words and the escapes of up to ``BLOCK_IDS`` ids of documents that follow each
other; its footer has the place and the sizes of every block, so that a reader
goes straight to the blocks that hold the ids asked for, and the documents' ids
and lengths, coded in the same way. The index names the files of the tasks that
were committed, in order; files of lost or repeated attempts are in no index
and are never read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from yardstar.llm import simple8b
from yardstar.llm.text import SPACE, buffer, slices, span_hash, spans

MAGIC = b"S8BTOK01"
INDEX = "_index.json"
BLOCK_IDS = 1 << 16
FILE_BYTES = 64 << 20  # a new file begins behind a document once its words take more
READ_BYTES = 4 << 20  # ids of a batch of documents given to Spark
SCHEMA = "doc_id long, ids binary"


# -- one file ----------------------------------------------------------------


class Block(NamedTuple):
    at: int
    n_ids: int
    n_words: int
    n_escapes: int


def _coded(values: np.ndarray) -> bytes:
    """Numbers as their count, the numbers of words and escapes, and these."""
    coded, escapes = simple8b.encode(values)
    head = np.array([len(values), len(coded), len(escapes)], "<u8")
    return head.tobytes() + coded.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()


def _decoded(data: bytes, at: int) -> tuple[np.ndarray, int]:
    n, n_words, n_escapes = np.frombuffer(data, "<u8", 3, at).tolist()
    coded = np.frombuffer(data, "<u8", n_words, at + 24)
    escapes = np.frombuffer(data, "<u8", n_escapes, at + 24 + 8 * n_words)
    return simple8b.decode(coded, escapes, n), at + 24 + 8 * (n_words + n_escapes)


class FileWriter:
    """Documents in ascending order of id, NULLs first, appended to one file."""

    def __init__(self, stream):
        self.stream = stream
        self.stream.write(MAGIC)
        self.at = len(MAGIC)
        self.blocks: list[Block] = []
        self.pending: list[np.ndarray] = []
        self.n_pending = 0
        self.doc_ids: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.n_null = 0
        self.n_docs = 0
        self.n_ids = 0

    def append(self, doc_ids: np.ndarray, n_null: int, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents of the given lengths, the first ``n_null`` of them without an id."""
        self.n_null += n_null
        self.doc_ids.append(doc_ids)
        self.lengths.append(lengths)
        self.n_docs += len(lengths)
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.n_pending += len(ids)
        if self.n_pending >= BLOCK_IDS:
            whole = np.concatenate(self.pending)
            full = len(whole) // BLOCK_IDS * BLOCK_IDS
            for begin in range(0, full, BLOCK_IDS):
                self._block(whole[begin : begin + BLOCK_IDS])
            self.pending, self.n_pending = [whole[full:]], len(whole) - full

    def _block(self, ids: np.ndarray) -> None:
        coded, escapes = simple8b.encode(ids)
        self.blocks.append(Block(self.at, len(ids), len(coded), len(escapes)))
        self.stream.write(coded.astype("<u8").tobytes() + escapes.astype("<u8").tobytes())
        self.at += 8 * (len(coded) + len(escapes))

    def close(self) -> None:
        if self.n_pending:
            self._block(np.concatenate(self.pending))
        doc_ids = np.concatenate([np.zeros(0, np.int64), *self.doc_ids])
        first = int(doc_ids[0]) if len(doc_ids) else 0
        # Differences of ascending longs are never negative, but may need all 64 bits.
        steps = np.diff(doc_ids.astype(np.int64).view(np.uint64), prepend=np.uint64(first & (2**64 - 1)))
        lengths = np.concatenate([np.zeros(0, np.int64), *self.lengths])
        footer = np.array([first, self.n_null, len(self.blocks)], "<i8").tobytes()
        footer += np.array(self.blocks, "<i8").reshape(-1, 4).tobytes()
        footer += _coded(steps) + _coded(lengths.astype(np.uint64))
        self.stream.write(footer + np.array([self.at], "<i8").tobytes() + MAGIC)
        self.stream.close()


class FileReader:
    """Footer of one file, and the ids of any stretch of it."""

    def __init__(self, stream):
        self.stream = stream
        end = stream.size()
        tail = stream.read_at(16, end - 16)
        if tail[8:] != MAGIC or stream.read_at(8, 0) != MAGIC:
            raise ValueError("not a file of Simple-8b token ids, or cut short")
        at = int(np.frombuffer(tail, "<i8", 1)[0])
        footer = stream.read_at(end - 16 - at, at)
        first, self.n_null, n_blocks = np.frombuffer(footer, "<i8", 3).tolist()
        table = np.frombuffer(footer, "<i8", 4 * n_blocks, 24).reshape(-1, 4)
        self.blocks = [Block(*row) for row in table.tolist()]
        steps, after = _decoded(footer, 24 + 32 * n_blocks)
        lengths, _ = _decoded(footer, after)
        self.doc_ids = (np.cumsum(steps, dtype=np.uint64) + np.uint64(first & (2**64 - 1))).view(np.int64)
        self.lengths = lengths.astype(np.int64)
        self.block_ends = np.cumsum(table[:, 1])

    def block(self, i: int) -> np.ndarray:
        b = self.blocks[i]
        data = self.stream.read_at(8 * (b.n_words + b.n_escapes), b.at)
        return simple8b.decode(np.frombuffer(data, "<u8", b.n_words), np.frombuffer(data, "<u8", offset=8 * b.n_words), b.n_ids)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks that hold them."""
        if end <= start:
            return np.zeros(0, np.uint64)
        first = int(np.searchsorted(self.block_ends, start, "right"))
        last = int(np.searchsorted(self.block_ends, end - 1, "right"))
        skipped = int(self.block_ends[first - 1]) if first else 0
        return np.concatenate([self.block(i) for i in range(first, last + 1)])[start - skipped : end - skipped]


# -- the data source ---------------------------------------------------------


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


@dataclass
class Written(WriterCommitMessage):
    part: int
    files: list[dict]


class Simple8bWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _open(self.path)
        fs.create_dir(root)
        part = TaskContext.get().partitionId()
        files: list[dict] = []
        out: FileWriter | None = None

        def done() -> None:
            out.close()
            files[-1] |= {"docs": out.n_docs, "ids": out.n_ids, "bytes": out.at}

        for batch in iterator:
            data, offsets = _bytes(batch.column("ids"))
            for at, end in _runs(offsets):
                if out is None:
                    name = f"part-{part:06d}-{len(files):04d}-{uuid.uuid4().hex}.s8b"
                    files.append({"name": name})
                    out = FileWriter(fs.open_output_stream(f"{root}/{name}", compression=None))
                doc_ids = batch.column("doc_id").slice(at, end - at)
                ids = np.frombuffer(data[offsets[at] : offsets[end]].tobytes(), "<u4")
                out.append(
                    doc_ids.drop_null().to_numpy(), doc_ids.null_count, np.diff(offsets[at : end + 1]) // 4, ids.astype(np.uint64)
                )
                if out.at > FILE_BYTES:
                    done()
                    out = None
        if out is not None:
            done()
        return Written(part, files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        fs.create_dir(root)
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.part) for f in m.files]
        start = 0
        for f in files:
            f["start"] = start
            start += f["ids"]
        new = f"{root}/{INDEX}.{uuid.uuid4().hex}"
        with fs.open_output_stream(new, compression=None) as out:
            out.write(json.dumps({"ids": start, "files": files}).encode())
        fs.move(new, f"{root}/{INDEX}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        for f in (f for m in messages if m for f in m.files):
            fs.delete_file(f"{root}/{f['name']}")


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows of a binary column without NULLs, and the offsets of each."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    cut = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8), cut


def _runs(offsets: np.ndarray, most: int = READ_BYTES) -> Iterator[tuple[int, int]]:
    """Rows cut into runs of about ``most`` bytes, one row at least."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end
        at = end


@dataclass
class FilePartition(InputPartition):
    name: str
    start: int


def read_index(path: str) -> dict:
    fs, root = _open(path)
    with fs.open_input_stream(f"{root}/{INDEX}", compression=None) as stream:
        return json.loads(stream.read())


class Simple8bReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[FilePartition]:
        files = read_index(self.path)["files"]
        return [FilePartition(f["name"], f["start"]) for f in files] or [FilePartition("", 0)]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, root = _open(self.path)
        with fs.open_input_file(f"{root}/{partition.name}") as stream:
            file = FileReader(stream)
            ends = np.concatenate([[0], np.cumsum(file.lengths)])
            known = np.arange(len(file.lengths)) >= file.n_null
            doc_ids = np.zeros(len(file.lengths), np.int64)
            doc_ids[known] = file.doc_ids
            for at, end in _runs(4 * ends):
                ids = file.ids(int(ends[at]), int(ends[end])).astype("<u4")
                cuts = 4 * (ends[at : end + 1] - ends[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids[at:end], mask=~known[at:end]),
                        pa.array(partition.start + ends[at:end]),
                        pa.array(file.lengths[at:end]),
                        pa.Array.from_buffers(
                            pa.binary(), end - at, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(ids.tobytes())]
                        ),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )


class Simple8bSource(DataSource):
    """``format("simple8b")``: documents and their ids, as little-endian unsigned 32-bit numbers in ``ids``.

    Writing takes ``(doc_id long, ids binary)``, already in the order wanted
    over the partitions and inside them, with mode ``append`` into a folder that
    has no data set yet. Reading gives ``(doc_id, start, n_tokens, ids)``,
    ``start`` being the ids of all documents before.
    """

    @classmethod
    def name(cls) -> str:
        return "simple8b"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def writer(self, schema, overwrite: bool) -> Simple8bWriter:
        path = self.options["path"]
        fs, root = _open(path)
        if overwrite or fs.get_file_info(f"{root}/{INDEX}").type != pafs.FileType.NotFound:
            raise ValueError(f"{path} already holds a data set, or is to be overwritten: name a new folder")
        return Simple8bWriter(path)

    def reader(self, schema) -> Simple8bReader:
        return Simple8bReader(self.options["path"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document of a data set, a task for each file."""
    spark.dataSource.register(Simple8bSource)
    return spark.read.format("simple8b").load(path)


def read_ids(path: str, start: int, length: int) -> np.ndarray:
    """Ids ``start`` to ``start + length`` of a data set, decoding only the blocks that hold them."""
    fs, root = _open(path)
    parts = [np.zeros(0, np.uint64)]
    for f in read_index(path)["files"]:
        low, high = max(start, f["start"]), min(start + length, f["start"] + f["ids"])
        if low < high:
            with fs.open_input_file(f"{root}/{f['name']}") as stream:
                parts.append(FileReader(stream).ids(low - f["start"], high - f["start"]))
    return np.concatenate(parts).astype(np.uint32)


# -- ids of words --------------------------------------------------------------


class WordEncoder:
    """Ids of whole batches of texts with a tokenizer that never joins over white space.

    Its pre-tokenizer takes runs of letters, single digits and runs of other
    signs, and drops white space; so texts are cut at ASCII white space, and
    between ASCII letters or digits and ASCII signs other than an apostrophe.
    As most of these stretches repeat, only distinct ones are encoded, and kept
    by the worker until ``most_kept`` are known. ASCII letters and digits alone
    are looked up in lower case, as the tokenizer reads them. The literal text
    of an added token is one stretch. With another tokenizer texts are encoded
    whole.
    """

    # The rules of the tokenizer for which the cuts above hold.
    NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

    def __init__(self, path: str, most_kept: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        added = self.tokenizer.get_added_tokens_decoder().values()
        split = ((rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.by_word = (
            (rules["normalizer"] or {}).get("normalizers") == self.NORMALIZER
            and split.get("pattern") == {"Regex": self.SPLIT}
            and not any(t.lstrip or t.rstrip or t.single_word or t.normalized or re.search(r"\s", t.content) for t in added)
        )
        self.literal = re.compile(b"|".join(sorted((re.escape(t.content.encode()) for t in added), key=len, reverse=True)) or b"$^")
        self.most_kept = most_kept
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.many = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def stretches(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(start, end, text, key)`` of the stretches, in order."""
        found_text, found_start, found_end = spans(data, offsets)
        letter = np.zeros(256, bool)
        letter[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
        sign = np.zeros(256, bool)
        sign[0x21:0x7F] = True
        sign[0x27] = False
        sign &= ~letter
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (letter[data[:-1]] & sign[data[1:]]) | (sign[data[:-1]] & letter[data[1:]])
        border = np.unique(offsets)
        cut[border] = False
        raw, at = data.tobytes(), 0
        while match := self.literal.search(raw, at):
            next_text = int(border[np.searchsorted(border, match.start(), "right")])
            if match.end() > next_text:
                at = next_text
                continue
            cut[match.start() + 1 : match.end()] = False
            cut[[match.start(), match.end()]] = True
            at = match.end()
        # Cuts at white space and at the borders of words add nothing: words begin and end there.
        cut[:-1] &= ~SPACE[data]
        begins = np.zeros(len(data), bool)
        begins[found_start] = True
        cut[:-1] |= begins
        start = np.flatnonzero(cut[:-1])
        of = np.cumsum(begins[start]) - 1
        end = np.minimum(np.append(start[1:], len(data)), found_end[of])
        low = data.copy()
        plain = np.zeros(len(data) + 1, np.int64)
        np.cumsum(letter[data], out=plain[1:])
        upper = (data >= 0x41) & (data <= 0x5A)
        all_letters = plain[end] - plain[start] == end - start
        inside = np.bincount(start[all_letters], minlength=len(data) + 1) - np.bincount(end[all_letters], minlength=len(data) + 1)
        low[upper & (np.cumsum(inside)[:-1] > 0)] |= 0x20
        return start, end, found_text[of], span_hash(low, start, end)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the offset of each text in it."""
        data, offsets = buffer(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if not self.by_word:
            got = self.tokenizer.encode_batch_fast(texts.fill_null("").to_pylist(), add_special_tokens=False)
            each = [np.array(e.ids, np.uint32) for e in got]
            return np.concatenate(each), np.concatenate([[0], np.cumsum([len(e) for e in each])])
        start, end, text, key = self.stretches(data, offsets)
        keys, first, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) > self.most_kept:
            self.clear()
        place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[place] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            raw = data.tobytes()
            spans = zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)
            self._keep(keys[new], self._learn([raw[a:b] for a, b in spans]))
            place = np.searchsorted(self.keys, keys)
        at, many = self.at[place][which], self.many[place][which]
        total = np.concatenate([[0], np.cumsum(many)])
        ids = self.store[np.repeat(at - total[:-1], many) + np.arange(total[-1])]
        return ids, total[np.searchsorted(text, np.arange(len(offsets)))]

    def _learn(self, found: list[bytes]) -> list[list[int]]:
        """Ids of each stretch. One of ASCII letters alone is a single piece that the merges take as it stands."""
        merges = self.tokenizer.model
        ids = [[t.id for t in merges.tokenize(x.lower().decode())] if x.isalpha() else None for x in found]
        others = [i for i, x in enumerate(ids) if x is None]
        got = self.tokenizer.encode_batch_fast([found[i].decode() for i in others], add_special_tokens=False)
        for i, e in zip(others, got, strict=True):
            ids[i] = e.ids
        return ids

    def _keep(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        many = np.array([len(i) for i in ids])
        flat = np.array([i for its in ids for i in its], np.uint32)
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(many) - many
        self.used += len(flat)
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.at, self.many = np.concatenate([self.at, at])[order], np.concatenate([self.many, many])[order]


_encoders: dict[str, WordEncoder] = {}


def _encoder_of(path: str) -> WordEncoder:
    """The encoder of this Python worker: tasks that follow each other share what it knows."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on each core
        _encoders.clear()
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# -- documents -----------------------------------------------------------------


def write(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode whole texts and write them to the folder ``path`` in ascending order of id.

    A document is the ids of its text as the tokenizer gives them, without the
    tokens it would put around it, and ``end_id``. NULL and empty texts are
    ``end_id`` alone. NULL ids come first; rows that share an id are documents
    of their own, in the order of a hash of their texts. Other columns aren't written, an
    empty table is a data set without documents.

    Rows are dealt into ranges of id and of a hash of the text, so that rows
    that share an id, NULL included, spread over ranges next to each other;
    inside a range Spark sorts and each task streams its documents through the
    encoder into its files. Only names and totals of files reach the driver.
    """
    docs.sparkSession.dataSource.register(Simple8bSource)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text").asc()]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder_of(tokenizer_path)
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                ids, at = encoder.encode(some.column("text"))
                n = len(at) - 1
                whole = np.full(len(ids) + n, end_id, "<u4")
                whole[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(at))] = ids
                cuts = (4 * (at + np.arange(n + 1))).astype(np.int32)
                coded = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(cuts), pa.py_buffer(whole.tobytes())])
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), coded], ["doc_id", "ids"])

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, F.asc_nulls_first("text"))
    ranged.mapInArrow(encode, SCHEMA).write.format("simple8b").mode("append").save(path)
