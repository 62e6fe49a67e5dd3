"""Operator 13: token ids in Arrow stream files of equal-length sequences.

Documents are put into ascending order of id by one range shuffle of their
texts.  Each partition encodes its documents in order and streams the ids to
one *sequence file* in a shared folder:

- the file is an Arrow IPC stream: a schema message, then record batches of
  ``BATCH_ROWS`` sequences, each a row of three fixed-size lists of
  ``SEQ_LENGTH`` values: ``ids`` (the narrowest unsigned type that holds the
  vocabulary), ``mask`` (false: padding) and ``ends`` (true: last id of a
  document);
- all batches but the last hold the same number of bytes, so sequence i lies
  at a computed place; ``SequenceFile`` maps the file and returns views of
  it, without copying and without reading what lies before;
- a second stream file lists the documents that the first holds: ``doc_id``,
  ``start`` (ids before it in this file) and ``n_tokens``.  A document is
  never cut between files; only a file's last sequence is padded.

A task writes under a name of its own and renames at the end; a task that
runs again writes the same bytes.  Memory is bounded by one batch of
sequences and one document.  The *manifest* (one row per file) gives the
order of the files and the ids that lie before each.

Encoding: the tokenizer's rules never join characters across blanks, so a
text is cut at blanks and each distinct run is encoded by the library once
while it stays in a bounded cache (see ``Encoder``).  ``encode_whole`` is the
plain form that the tests compare with.

Defined results: NULL and empty texts hold the end id alone; NULL ids come
first; rows that share an id follow each other in the order of a hash of
their texts, equal rows in any order (they can't be told apart); texts of any
length are encoded whole; an empty table gives no file and no row; further
columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import string
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import staged
from starloom.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SEQ_LENGTH = 2048
BATCH_ROWS = 64
#: Runs between blanks and parts of them that a worker remembers, and the longest that it does.
CACHE_RUNS = 100_000
CACHE_PARTS = 800_000
CACHE_CHARS = 48

MANIFEST = "part int, sequences string, documents string, n_docs long, n_tokens long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def encode_whole(path: str, text: str | None) -> list[int]:
    """Ids of one text, encoded in one call, without the end id."""
    return _tokenizer(path).encode(text or "", add_special_tokens=False).ids


#: ASCII signs; after a letter or digit they begin a piece of their own.
_SIGNS = string.punctuation
#: Small Latin letters that no normalisation changes.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"


class Encoder(dict):
    """Texts to ids by way of remembered runs (the dict's own entries) and
    parts of them.

    The tokenizer treats the runs between blanks one by one, and begins a new
    piece at an ASCII sign that follows a letter or digit.  So a run that
    isn't remembered is cut before the signs at its end, and each part is
    encoded by the library: a part of plain letters by its model alone, which
    is what normaliser and splitter leave to do, any other by the whole of it.
    """

    _PLAIN = re.compile(f"[{_LETTERS}]+")

    def __init__(self, path: str, code: str):
        super().__init__()
        self.tokenizer, self.code = _tokenizer(path), code
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the model's own letters for the bytes of those beyond ASCII
        from tokenizers.pre_tokenizers import ByteLevel
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelt = {ord(c): spell(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if self._PLAIN.fullmatch(c)}

    def _encode(self, part: str) -> bytes:
        if part.isascii() and part.isalpha() and len(part) <= CACHE_CHARS:
            return array(self.code, [t.id for t in self.model.tokenize(part.lower())]).tobytes()
        if len(part) <= CACHE_CHARS and self._PLAIN.fullmatch(part):
            return array(self.code, [t.id for t in self.model.tokenize(part.translate(self.spelt))]).tobytes()
        return array(self.code, self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        ids = self._encode(part)
        if len(part) <= CACHE_CHARS:
            self.parts[part] = ids
        return ids

    def __missing__(self, run: str) -> bytes:
        known = self.parts.get
        core = run.rstrip(_SIGNS)
        # U+0130 becomes a letter and a mark, and marks join what follows
        if core == run or not core[-1:].isalnum() or core[-1] == "\u0130" or any(s in run for s in self.special):
            ids = known(run) or self._part(run)
        else:
            tail = run[len(core):]
            ids = (known(core) or self._part(core)) + (known(tail) or self._part(tail))
        if len(run) <= CACHE_CHARS:
            self[run] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        """The ids as bytes of the array type ``code``."""
        if len(self) > CACHE_RUNS:
            self.clear()
        if len(self.parts) > CACHE_PARTS:
            self.parts.clear()
        runs = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, runs))


@lru_cache(maxsize=2)
def _encoder(path: str, code: str) -> Encoder:
    """One for each Python worker, whatever the number of its tasks."""
    return Encoder(path, code)


# -- files -------------------------------------------------------------------

def _place(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    if re.match(r"file:/|/", folder):
        return pa.fs.LocalFileSystem(), "/" + re.sub(r"^file:", "", folder).lstrip("/")
    return pa.fs.FileSystem.from_uri(folder)


def sequence_schema(length: int, dtype) -> pa.Schema:
    def fixed(kind):
        return pa.list_(pa.field("item", kind, nullable=False), length)
    return pa.schema([pa.field("ids", fixed(pa.from_numpy_dtype(dtype)), nullable=False),
                      pa.field("mask", fixed(pa.bool_()), nullable=False),
                      pa.field("ends", fixed(pa.bool_()), nullable=False)])


DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Writer:
    """The two files of one partition."""

    def __init__(self, folder: str, part: int, length: int, batch_rows: int, dtype):
        self.fs, root = _place(folder)
        self.fs.create_dir(root, recursive=True)
        self.names = [f"{root}/{kind}-{part:06d}.arrows" for kind in ("sequences", "documents")]
        self.own = [f"{n}.{uuid.uuid4().hex}.tmp" for n in self.names]
        self.schema, self.length, self.size = sequence_schema(length, dtype), length, length * batch_rows
        self.sinks = [self.fs.open_output_stream(n) for n in self.own]
        self.streams = [pa.ipc.new_stream(s, x) for s, x in zip(self.sinks, (self.schema, DOCUMENTS), strict=True)]
        self.ids, self.ends, self.fill = np.zeros(self.size, dtype), np.zeros(self.size, bool), 0
        self.docs: list[tuple] = []
        self.n_docs = self.n_tokens = 0

    def add(self, doc_id: int | None, encoded: bytes) -> None:
        """One document; ``encoded`` is without the end id."""
        ids = np.frombuffer(encoded, self.ids.dtype)
        n = len(ids) + 1
        self.docs.append((doc_id, self.n_tokens, n))
        self.n_docs, self.n_tokens = self.n_docs + 1, self.n_tokens + n
        done = 0
        while done < len(ids):
            k = min(len(ids) - done, self.size - self.fill)
            self.ids[self.fill:self.fill + k] = ids[done:done + k]
            self.fill, done = self.fill + k, done + k
            if self.fill == self.size:
                self._flush()
        self.ids[self.fill], self.ends[self.fill] = END_ID, True
        self.fill += 1
        if self.fill == self.size:
            self._flush()
        if len(self.docs) >= 10_000:
            self._list()

    def _list(self) -> None:
        if self.docs:
            columns = [pa.array(c, pa.int64()) for c in zip(*self.docs, strict=True)]
            self.streams[1].write_batch(pa.record_batch(columns, schema=DOCUMENTS))
            self.docs = []

    def _flush(self) -> None:
        rows = -(-self.fill // self.length)
        n = rows * self.length
        values = pa.array(self.ids[:n]), pa.array(np.arange(n) < self.fill), pa.array(self.ends[:n])
        columns = [pa.FixedSizeListArray.from_arrays(v, type=f.type) for v, f in zip(values, self.schema, strict=True)]
        self.streams[0].write_batch(pa.record_batch(columns, schema=self.schema))
        self.ids[:], self.ends[:], self.fill = 0, False, 0

    def close(self) -> None:
        if self.fill:
            self._flush()
        self._list()
        for stream, sink in zip(self.streams, self.sinks, strict=True):
            stream.close()
            sink.close()
        for own, name in zip(self.own, self.names, strict=True):
            self.fs.move(own, name)


class SequenceFile:
    """Random access to one sequence file."""

    def __init__(self, path: str):
        fs, name = _place(path)
        self.file = pa.memory_map(name) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(name)
        self.schema = pa.ipc.read_schema(self.file)
        self.first = self.file.tell()
        self.length = self.schema.field("ids").type.list_size
        self.kept: tuple[int, pa.RecordBatch | None] = (-1, None)
        head = self._read(self.first)
        self.rows = head.num_rows if head else 0
        self.bytes = self.file.tell() - self.first

    def _read(self, at: int) -> pa.RecordBatch | None:
        self.file.seek(at)
        try:
            return pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)
        except EOFError:
            return None

    def _batch(self, k: int) -> pa.RecordBatch:
        if self.kept[0] != k:
            self.kept = k, self._read(self.first + k * self.bytes)
            if self.kept[1] is None:
                raise IndexError(k)
        return self.kept[1]

    def sequence(self, i: int) -> dict[str, pa.Array]:
        """Views of sequence i: ids, mask, ends."""
        batch = self._batch(i // self.rows)
        row = i % self.rows
        if row >= batch.num_rows:
            raise IndexError(i)
        return {f.name: batch.column(f.name)[row].values for f in self.schema}

    def slices(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The n ids from place ``start`` on, as views of at most one batch."""
        size = self.rows * self.length
        while n:
            batch = self._batch(start // size)
            ids = batch.column("ids").values.to_numpy()  # the whole batch: no offset
            at = start % size
            piece = ids[at:at + n]
            yield piece
            start, n = start + len(piece), n - len(piece)


# -- jobs --------------------------------------------------------------------

def write_sequences(docs: DataFrame, folder: str, tokenizer: str | None = None, *, length: int = SEQ_LENGTH,
                    batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into sequence files in ``folder``, which
    driver and executors share; returns the staged manifest."""
    path = tokenizer or tokenizer_path()
    if length % 8:
        raise ValueError("length must be a multiple of 8, so that masks begin at whole bytes")
    size = max(_tokenizer(path).get_vocab_size(), END_ID + 1)
    code = "H" if size <= 1 << 16 else "I"
    dtype = np.dtype(code)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, part = _encoder(path, code), None, TaskContext.get().partitionId()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                out = out or _Writer(folder, part, length, batch_rows, dtype)
                out.add(doc_id, encode.ids(text.as_py()))
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "sequences": out.names[0], "documents": out.names[1],
                                               "n_docs": out.n_docs, "n_tokens": out.n_tokens}],
                                             pa.schema([("part", pa.int32()), ("sequences", pa.string()), ("documents", pa.string()),
                                                        ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    # the row number splits what shares id and text; such rows are alike, so it may order them
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("h", F.xxhash64("text")).withColumn("r", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), "h", "text"]
    ordered = keyed.repartitionByRange(F.col("doc_id").asc_nulls_first(), "h", "r").sortWithinPartitions(*order)
    return staged(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before
    it), n_tokens and the CRC-32 of its ids."""
    n = max(manifest.count(), 1)
    # one row per file: a window over the manifest is bounded by the number of files
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            sequences = SequenceFile(row["sequences"])
            fs, name = _place(row["documents"])
            with fs.open_input_stream(name) as f:
                for docs in pa.ipc.open_stream(f):
                    starts, counts = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                    sums = np.empty(len(starts), np.int64)
                    for i, (at, k) in enumerate(zip(starts.tolist(), counts.tolist(), strict=True)):
                        crc = 0
                        for ids in sequences.slices(at, k):
                            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        sums[i] = crc
                    yield pa.record_batch([docs.column("doc_id"), pa.array(starts + row["before"]), pa.array(counts), pa.array(sums)],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of ``op13_token_files``, from files written for it."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_documents(write_sequences(docs, folder))
