"""Token ids in files of independent zstandard frames.

A file holds a frame for each document (its ids, little-endian, 2 or 4 bytes each), a skippable frame with the
documents' ids, and at its end a seek table: the sizes of every frame and the lower half of the XXH64 of its
content, as in the public seekable zstandard format. A reader fetches the two trailing frames, then only the frames
of the documents it wants, and checks each.
"""

from __future__ import annotations

import os
import re
import string
import struct
import sys
import uuid
import zlib
from array import array

import numpy as np
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.llm.common import arrow_step, saved, tuned, values
from chainlake.session import work_folder
from chainlake.sources.store import open_store

# Fixed values of the seekable zstandard format.
SEEK_FRAME = 0x184D2A5E
SEEK_END = 0x8F92EAB1
CHECKSUMS = 0x80
# A skippable frame of the private range: count, a mark whether the id is null, and the id of each document.
INDEX_FRAME = 0x184D2A50
END_ID = 0
LEVEL = 1
# A worker's memory of encoded pieces, and of their parts of letters, starts anew at this many; results do not depend on it. Parts are
# fewer than the pieces they make up and dearer to encode, so they are kept longer.
KNOWN_PIECES = 600_000
KNOWN_PARTS = 900_000

_DOUBLE = re.compile(r"\s\s")
_MIXED = re.compile(r" \s|\s ")


# ======== one file ========


class Writer:
    """Appends documents to a binary stream; `close` writes the index and the seek table."""

    def __init__(self, target, width: int):
        self.target, self.kind = target, {2: "<u2", 4: "<u4"}[width]
        self.ids: list[int | None] = []
        self.entries: list[bytes] = []
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.target.write(frame)
        self.ids.append(doc_id)
        self._entry(frame, ids)

    def _entry(self, frame: bytes, content: bytes) -> None:
        check = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self.entries.append(struct.pack("<III", len(frame), len(content), check))

    def close(self) -> None:
        nulls = bytes(i is None for i in self.ids)
        body = struct.pack("<BI", int(self.kind[-1]), len(self.ids)) + nulls + np.array(
            [i or 0 for i in self.ids], dtype="<i8"
        ).tobytes()
        self.target.write(struct.pack("<II", INDEX_FRAME, len(body)) + body)
        # Skippable frames count as frames without content.
        self.entries.append(struct.pack("<III", len(body) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_END)
        self.target.write(struct.pack("<II", SEEK_FRAME, len(table)) + table)


class Reader:
    """Reads an open random-access file of `Writer`. Wrong marks or checksums raise ValueError."""

    def __init__(self, source, size: int):
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        if size < 17:
            raise ValueError("not a token file: too short")
        count, flags, end = struct.unpack("<IBI", self._at(size - 9, 9))
        if end != SEEK_END or flags != CHECKSUMS:
            raise ValueError("not a token file: no seek table at its end")
        start = size - 9 - 12 * count
        mark, length = struct.unpack("<II", self._at(start - 8, 8))
        if mark != SEEK_FRAME or length != 12 * count + 9:
            raise ValueError("damaged seek table")
        self.table = np.frombuffer(self._at(start, 12 * count), dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        index = self._at(int(self.starts[-2]), int(self.table[-1, 0]))
        mark, _, width, n = struct.unpack("<IIBI", index[:13])
        if mark != INDEX_FRAME or n != count - 1:
            raise ValueError("damaged document index")
        self.width = width
        numbers = np.frombuffer(index[13 + n :], dtype="<i8").tolist()
        self.ids = [None if null else i for null, i in zip(index[13 : 13 + n], numbers)]

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def raw(self, place: int) -> bytes:
        """The ids of the document at `place`, as stored; only its frame is read."""
        packed, size, check = self.table[place].tolist()
        content = self.unpacker.decompress(self._at(int(self.starts[place]), packed), max_output_size=size or 1)
        if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
            raise ValueError(f"checksum of frame {place} does not match")
        return content

    def tokens(self, place: int) -> np.ndarray:
        return np.frombuffer(self.raw(place), dtype=f"<u{self.width}").astype("<u4")


# ======== encoding ========

# ASCII marks: after a run of letters, with the space before it, the public splitting pattern parts them from it.
_MARKS = string.punctuation


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for letters from 256 on."""
    shown = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class Pieces(dict):
    """Ids of pieces, each made at its first use."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        found = self[piece] = self.make(piece)
        return found


class Encoder:
    """Ids of texts, as bytes. Each distinct piece between single spaces is encoded once by the library.

    Tokens of a byte-level vocabulary with the public splitting pattern never cross from a character that is
    not white space into a space before another such character, nor over a single line end between two such, so the ids of
    those pieces follow each other. A piece of letters and marks goes to the library's model as these two parts, any other
    piece to its whole chain.
    Texts with other runs of white space that hold a space, or with a special token's string, go to the library whole.
    """

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind = {2: "H", 4: "I"}[self.width]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Pieces(self._piece)
        self.parts: dict[str, bytes] = {}
        chain = str(self.tokenizer.pre_tokenizer)
        self.splits = (
            self.tokenizer.normalizer is None and chain.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in chain
        )
        self.letters = _byte_letters()
        self.end = self._bytes([END_ID])

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One for each worker: it outlives the task."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array(self.kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            # Every ASCII letter and mark stands for itself, a space for its letter.
            spelt = part.replace(" ", self.letters[32]) if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            found = self.parts[part] = self._bytes([t.id for t in self.model.tokenize(spelt)])
        return found

    def _piece(self, piece: str) -> bytes:
        head = piece.rstrip(_MARKS)
        # Exactly the letters of the splitting pattern.
        if (head[1:] if head[:1] == " " else head).isalpha():
            return self._part(head) if len(head) == len(piece) else self._part(head) + self._part(piece[len(head) :])
        return self._whole(piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, the end id appended."""
        if len(self.pieces) > KNOWN_PIECES:
            self.pieces.clear()
        if len(self.parts) > KNOWN_PARTS:
            self.parts.clear()
        get, end = self.pieces.__getitem__, self.end
        split = map(self._pieces, texts)
        return [(b"".join(map(get, p)) if p is not None else self._whole(t)) + end for t, p in zip(texts, split)]

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _pieces(self, text: str) -> list[str] | None:
        if not self.splits or any(s in text for s in self.special):
            return None
        if not text:
            return []
        if "\0" in text or text[0].isspace() or text[-1].isspace():
            return None
        if _DOUBLE.search(text):
            return None if _MIXED.search(text) else text.replace(" ", "\0 ").split("\0")
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


# ======== folders of files ========


def write_tokens(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode all texts into files in ascending order of id; (shard, path, n_docs, n_tokens, before) of each.

    `before` counts the ids in the files before. Files follow ranges of ids, as many as the shuffle has
    partitions; each is written under a private name and renamed, so a task that runs again leaves the same file.
    Null texts count as empty, null ids come first, rows of one id follow each other by their texts.
    """
    spark = tuned(docs.sparkSession)
    folder = work_folder(spark, "tokens")

    def step(batches):
        encoder, shard = Encoder.of(tokenizer), TaskContext.get().partitionId()
        store, root = open_store(folder)
        store.create_dir(root)
        private, path = f"{root}/.{uuid.uuid4().hex}", f"{root}/part-{shard:07d}.tokens"
        n_docs = n_tokens = 0
        with store.open_output_stream(private) as target:
            writer = Writer(target, encoder.width)
            for batch in batches:
                encoded = encoder.encode([t or "" for t in values(batch, "text")])
                for key, ids in zip(values(batch, "id"), encoded):
                    writer.add(key, ids)
                    n_docs, n_tokens = n_docs + 1, n_tokens + len(ids) // encoder.width
            writer.close()
        if n_docs:
            store.move(private, path)
            yield {"shard": [shard], "path": [path.removeprefix(root)], "n_docs": [n_docs], "n_tokens": [n_tokens]}
        else:
            store.delete_file(private)

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    ranged = source.repartitionByRange(F.asc_nulls_first("id")).sortWithinPartitions(F.asc_nulls_first("id"), "text")
    shards = saved(arrow_step(ranged, step, "shard int, path string, n_docs long, n_tokens long"), "shards")
    # One row a file: the running total is over files, not rows.
    before = F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    return shards.select(
        "shard", F.concat(F.lit(folder), "path").alias("path"), "n_docs", "n_tokens",
        F.coalesce(before, F.lit(0).cast("long")).alias("before"),
    )


def read_tokens(shards: DataFrame, doc_ids: list[int] | None = None, with_tokens: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, tokens array]) of the documents in the files, or of those asked for only.

    ids_crc32 covers the ids as little-endian unsigned 32-bit integers. Frames of other documents are not read.
    """
    wanted = None if doc_ids is None else frozenset(doc_ids)

    def step(batches):
        for batch in batches:
            for path, before in zip(values(batch, "path"), values(batch, "before")):
                store, inner = open_store(path)
                with store.open_input_file(inner) as source:
                    reader = Reader(source, source.size())
                    sizes = (reader.table[:-1, 1] // reader.width).tolist()
                    names = ("doc_id", "start", "n_tokens", "ids_crc32", "tokens")[: 5 if with_tokens else 4]
                    out, start = {n: [] for n in names}, before
                    for place, (key, n) in enumerate(zip(reader.ids, sizes)):
                        if wanted is None or key in wanted:
                            ids = reader.tokens(place)
                            facts = (key, start, n, zlib.crc32(ids.tobytes()), ids)
                            for name, value in zip(names, facts):
                                out[name].append(value)
                        start += n
                        if len(out["doc_id"]) >= 200:
                            yield out
                            out = {n: [] for n in names}
                    yield out

    # A task for each file, however few bytes its row has.
    spread = shards.select("path", "before").repartition(max(1, shards.count()), "path")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return arrow_step(spread, step, f"{schema}, tokens array<long>" if with_tokens else schema)
