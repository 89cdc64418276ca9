"""Token ids of a corpus in Arrow files of equal-length sequences with masks, and reading them back."""

from __future__ import annotations

import json
import math
import os
import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillforge.llm.common import new_path, ship, staged
from fillforge.llm.words import binary_parts, texts_of

SEQUENCE = 1024  # ids of a sequence
BATCH = 512  # sequences of a record batch
FILE_BYTES = 64 << 20  # bytes of text that a file is meant for
MOST_PARTS = 16_384  # part files of a corpus; beyond that they grow
MEMO = 250_000  # encoded chunks that a Python worker remembers, twice

CONTROL = re.compile("[\0\1]")
#: Kinds of bytes: 1 a space or a line end, 2 other ASCII blanks and controls, 3 what may begin a blank beyond ASCII.
KIND = np.array([1 if c in b" \n" else 2 if c < 2 or c in b"\t\r\v\f\x1c\x1d\x1e\x1f" else 3 if c in b"\xc2\xe1\xe2\xe3" else 0 for c in range(256)], np.uint8)
SECOND = np.isin(np.arange(256), [0x85, 0xA0, 0x9A, 0x80, 0x81])  # bytes that may follow kind 3 in such a blank
SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum())
SIGNS_RAW = SIGNS.encode()
LATIN = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
SIMPLE = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]*)([!-/:-@\[-`{-~]*)")


def byte_chars() -> list[str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones of Latin-1 for themselves, the
    others in order from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


BYTE_CHARS = byte_chars()

_coders: dict[str, ByteCoder] = {}


def coder(path: str) -> ByteCoder:
    if path not in _coders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _coders[path] = ByteCoder(path)
    return _coders[path]


class ByteCoder:
    """A byte-level BPE file. A space that follows a non-blank and precedes one starts a new piece whatever stands
    around it, so the text from one such space to the next is a chunk that encodes the same everywhere."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.tokenize = self.tok.model.tokenize
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}  # the filling of memo before this one
        self.signs: dict[str, bytes] = {}

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def odd_chunks(self, text: str) -> list[bytes]:
        """Keys of the parts of a text that has other blanks than single spaces and line ends between words."""
        if CONTROL.search(text) or any(s in text for s in self.special):
            return [b"\1" + text.encode()]
        first, *rest = text.split(" ")
        out = [first]
        for r in rest:
            if not r or r[0].isspace():
                out[-1] += " " + r
            else:
                out.append(" " + r)
        return [b"\1" + x.encode() for x in out]

    def odd_rows(self, off: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Marks the texts that plain chunks do not fit: with other or doubled blanks, blank ends or special tokens."""
        kind = KIND[raw]
        at = [np.flatnonzero(kind == 2), np.flatnonzero((kind[:-1] == 1) & (kind[1:] == 1))]
        lead = np.flatnonzero(kind[:-1] == 3)
        at.append(lead[SECOND[raw[lead + 1]]])
        odd = np.zeros(len(off), bool)
        odd[np.searchsorted(off, np.concatenate(at), side="right") - 1] = True
        full = np.flatnonzero(np.diff(off))
        odd[full] |= (kind[off[full]] == 1) | (kind[off[full + 1] - 1] == 1)
        whole = raw.tobytes()
        for s in self.special:
            found = whole.find(s.encode())
            while found >= 0:
                odd[np.searchsorted(off, found, side="right") - 1] = True
                found = whole.find(s.encode(), found + 1)
        return odd[:-1]

    def piece(self, text: str) -> bytes:
        return self.packed([t.id for t in self.tokenize(text)])

    def simple(self, word: str, space: str) -> bytes | None:
        """The ids of Latin letters with signs after them, which are at most two pieces; None for any other word. The
        letters alone are a chunk too, so they are remembered under its key."""
        if not (m := SIMPLE.fullmatch(word)):
            return None
        letters, signs = m.groups()
        if not letters:
            return self.piece(space + signs) if space or signs else b""
        key = (b" " if space else b"") + letters.encode()
        found = self.memo.get(key)
        if found is None:
            seen = letters if letters.isascii() else "".join(map(BYTE_CHARS.__getitem__, letters.encode()))
            self.memo[key] = found = self.piece(space + seen)
        return found + self.ending(signs) if signs else found

    def ending(self, signs: str) -> bytes:
        if signs not in self.signs:
            if len(self.signs) >= MEMO // 8:
                self.signs.clear()
            self.signs[signs] = self.piece(signs)
        return self.signs[signs]

    def learn(self, missing: list[bytes]) -> None:
        """Remembers these chunks."""
        memo, old, hard, space, code, tokenize = self.memo, self.old, [], BYTE_CHARS[32], self.code, self.tokenize
        for key in missing:
            if key in old:
                memo[key] = old[key]
                continue
            lead = key[:1]
            if lead == b" ":
                letters = key[1:].rstrip(SIGNS_RAW)
                plain = letters.isalpha()  # of ASCII
                if plain or letters and LATIN.fullmatch(letters.decode()):  # the most common kind of simple(), in short
                    base = key[: len(letters) + 1]
                    found = memo.get(base) or old.get(base)
                    if found is None:
                        seen = letters.decode() if plain else "".join(map(BYTE_CHARS.__getitem__, letters))
                        memo[base] = found = array(code, [t.id for t in tokenize(space + seen)]).tobytes()
                    if len(base) < len(key):
                        found += self.ending(key[len(base) :].decode())
                    memo[key] = found
                    continue
                found = self.simple(key[1:].decode(), space)
            elif lead == b"\n":
                found = self.simple(key[1:].decode(), "")
                found = None if found is None else self.piece(BYTE_CHARS[10]) + found
            else:
                found = None if lead == b"\1" else self.simple(key.decode(), "")
            if found is None:
                hard.append((key, (key[1:] if lead == b"\1" else key).decode()))
            else:
                memo[key] = found
        for (key, _), e in zip(hard, self.tok.encode_batch_fast([t for _, t in hard], add_special_tokens=False), strict=True):
            memo[key] = self.packed(e.ids)

    def recall(self, keys: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks. What comes again within two fillings of the memory stays in it."""
        if len(self.memo) > MEMO:
            self.memo, self.old = {}, self.memo
        found = list(map(self.memo.get, keys))
        missing = [k for k, f in zip(keys, found, strict=True) if f is None]
        self.learn(missing)
        return [self.memo[k] if f is None else f for k, f in zip(keys, found, strict=True)] if missing else found

    def encode_column(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """The ids of each text and end_id, as bytes. A text is cut before each blank between its words, the cuts make one
        column whose distinct values are encoded once, and the ids are gathered by their numbers."""
        off, raw = binary_parts(texts)
        end = self.packed([end_id])
        odd = self.odd_rows(off, raw) if len(raw) else np.zeros(len(texts), bool)
        blank = KIND[raw] == 1
        for i in np.flatnonzero(odd).tolist():
            blank[off[i] : off[i + 1]] = False
        full = np.diff(off) > 0
        blank[off[:-1][full]] = True  # a text's own start cuts too
        starts = np.flatnonzero(blank)
        first = np.searchsorted(starts, off)
        cuts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int32)), pa.py_buffer(raw)])
        if odd.any():
            plain = ~np.repeat(odd, np.diff(first))
            cuts = cuts.filter(pa.array(plain))
            first = np.append(0, np.cumsum(plain))[first]
        coded = cuts.dictionary_encode()
        values = self.recall(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        at = coded.indices.to_numpy()
        ends = np.append(0, np.cumsum(sizes[at]))
        flat = np.frombuffer(b"".join(values), self.dtype)
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[at] - ends[:-1], sizes[at]) + np.arange(ends[-1])].tobytes()
        bounds = (ends[first] * self.dtype.itemsize).tolist()
        out = [ids[lo:hi] + end for lo, hi in zip(bounds, bounds[1:], strict=False)]
        for i in np.flatnonzero(odd).tolist():
            keys = self.odd_chunks(texts[i].as_py())
            found = dict(zip(d := list(dict.fromkeys(keys)), self.recall(d), strict=True))
            out[i] = b"".join(map(found.__getitem__, keys)) + end
        return out

    def encode_all(self, texts: list[str], end_id: int) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.string()), end_id)


def encode(path: str, end_id: int, bounds: list[int]):
    """(id, text) to (part, id, turn, ids as bytes). part numbers the ranges of ids between the bounds, null ids first;
    turn, a hash of the tokens, orders the rows of one id. A bound that stands several times is a hot id, whose rows are
    dealt by turn over as many parts."""
    cuts = np.array(bounds, np.int64)

    def run(batches):
        c = coder(path)
        for whole in batches:
            for batch in texts_of(whole, "text"):
                ids, coded = batch.column(0), c.encode_column(batch.column(1), end_id)
                keys = ids.fill_null(-(2**63)).to_numpy(zero_copy_only=False)
                part, ends = (np.searchsorted(cuts, keys, side=x) for x in ("left", "right"))
                turn = np.fromiter(map(xxhash.xxh3_64_intdigest, coded), np.uint64, len(coded)) >> np.uint64(32)
                part = part + (turn * np.maximum(1, ends - part).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), ids, pa.array(turn.astype(np.int64)), pa.array(coded, pa.binary())], ["part", "id", "turn", "ids"])

    return run


def schema_of(dtype: np.dtype) -> pa.Schema:
    token = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    return pa.schema([("tokens", pa.list_(token, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))])


class PartWriter:
    """Writes one part: sequences as they fill up, then the index of its documents. Both files appear at the end only,
    under their final names. A task that runs again makes the same bytes, so whole files that stand there already stay."""

    def __init__(self, fs: pafs.FileSystem, base: str, part: int, dtype: np.dtype):
        self.fs, self.dtype, self.schema = fs, dtype, schema_of(dtype)
        self.final = f"{base}/part-{part:06d}"
        self.draft = f"{self.final}-{uuid.uuid4().hex}"
        self.sink = fs.open_output_stream(self.draft + ".arrow")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.held, self.total = bytearray(), 0

    def add(self, doc: int | None, ids: bytes) -> None:
        self.ids.append(doc)
        self.sizes.append(len(ids) // self.dtype.itemsize)
        self.held += ids
        full = BATCH * SEQUENCE * self.dtype.itemsize
        while len(self.held) >= full:
            self.put(bytes(self.held[:full]))
            del self.held[:full]

    def put(self, raw: bytes) -> None:
        n = len(raw) // self.dtype.itemsize
        rows = math.ceil(n / SEQUENCE)
        tokens = np.zeros(rows * SEQUENCE, self.dtype)
        tokens[:n] = np.frombuffer(raw, self.dtype)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), SEQUENCE) for x in (tokens, np.arange(rows * SEQUENCE) < n)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.total += n

    def close(self) -> tuple[int, int]:
        if self.held:
            self.put(bytes(self.held))
        self.writer.close()
        self.sink.close()
        sizes = np.array(self.sizes, np.int64)
        index = pa.table({"doc_id": pa.array(self.ids, pa.int64()), "first": np.cumsum(sizes) - sizes, "n_tokens": sizes})
        with self.fs.open_output_stream(self.draft + ".index") as sink, pa.ipc.new_file(sink, index.schema) as w:
            w.write_table(index)
        for end in (".arrow", ".index"):
            draft, there = self.fs.get_file_info([self.draft + end, self.final + end])
            if there.type == pafs.FileType.File and there.size == draft.size:
                self.fs.delete_file(self.draft + end)
            else:
                self.fs.move(self.draft + end, self.final + end)
        return len(sizes), self.total

    def drop(self) -> None:
        """Leaves nothing of a part that could not be written to its end."""
        self.sink.close()
        for end in (".arrow", ".index"):
            if self.fs.get_file_info(self.draft + end).type == pafs.FileType.File:
                self.fs.delete_file(self.draft + end)


def write(uri: str, itemsize: int):
    """Rows (part, id, ids) sorted by part, id and turn to files under uri; one row per part: part, n_docs, n_ids."""

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(uri)
        fs.create_dir(base, recursive=True)
        dtype = np.dtype(f"<u{itemsize}")
        writer, part, out = None, None, []
        try:
            for batch in batches:
                for p, i, raw in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
                    if p != part:
                        if writer:
                            out.append((part, *writer.close()))
                        writer, part = PartWriter(fs, base, p, dtype), p
                    writer.add(i, raw)
            if writer:
                out.append((part, *writer.close()))
        except BaseException:
            if writer:
                writer.drop()
            raise
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["part", "n_docs", "n_ids"])

    return run


def opened(fs: pafs.FileSystem, path: str) -> pa.ipc.RecordBatchFileReader:
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path))


class TokenFile:
    """Random access to the sequences of one part; on a local or mounted path nothing is copied."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.reader = opened(fs, path)
        self.count = 0
        if n := self.reader.num_record_batches:
            self.count = (n - 1) * BATCH + self.reader.get_batch(n - 1).num_rows

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """The ids (a view of the file) and the mask of sequence i."""
        batch = self.reader.get_batch(i // BATCH).slice(i % BATCH, 1)
        return batch.column("tokens").flatten().to_numpy(), batch.column("mask").flatten()


def read_back(uri: str):
    """(part, start of the part) to one row per document: doc_id, start, n_tokens, ids_crc32 of its ids."""

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for part, at in zip(*[batch.column(c).to_pylist() for c in range(2)], strict=True):
                path = f"{base}/part-{part:06d}"
                data, docs = opened(fs, path + ".arrow"), opened(fs, path + ".index").read_all()
                left, crcs = iter(range(data.num_record_batches)), []
                have = np.empty(0, data.get_batch(0).column(0).type.value_type.to_pandas_dtype())
                for n in docs.column("n_tokens").to_pylist():
                    crc = 0
                    while n:
                        if not len(have):
                            now = data.get_batch(next(left))
                            have = now.column("tokens").flatten().to_numpy()[: now.column("mask").flatten().true_count]
                        crc = zlib.crc32(have[:n].astype("<u4").tobytes(), crc)
                        n, have = n - len(have[:n]), have[n:]
                    crcs.append(crc)
                start = docs.column("first").to_numpy() + at
                yield pa.RecordBatch.from_arrays([docs.column("doc_id").combine_chunks(), pa.array(start), docs.column("n_tokens").combine_chunks(), pa.array(crcs, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])

    return run


def write_token_files(docs: DataFrame, path: str, uri: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encodes each whole text with the tokenizer file at path, appends end_id and writes the ids in ascending id order.

    uri names a folder that all executors share. Part files follow one another in id order and hold the ids as
    sequences of SEQUENCE with masks (False where the last sequence of a part is filled up), and per part an index of
    its documents. Returns one row per part: part, n_docs, n_ids, start (ids of all parts before).

    Null texts count as empty and give the end id alone; very long ones are encoded whole. Null ids come first; rows
    that repeat an id follow one another in the order of a hash of their tokens. An empty table writes nothing. Other
    columns of docs are not read, so their names cannot clash.

    Parts are ranges of ids that hold about file_bytes of text each (more where there are MOST_PARTS). Their bounds are
    percentiles of the ids, weighted by bytes, so an id that holds much of the corpus bounds several parts and is dealt
    over them. One shuffle moves the encoded ids, one task per part writes. The window that adds up the starts sees one
    row per part.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sized = rows.select("id", (F.octet_length("text") + 1).cast("long").alias("size"))
    n = min(MOST_PARTS, max(1, math.ceil((sized.agg(F.sum("size")).first()[0] or 0) / file_bytes)))
    bounds: list[int] = []
    if n > 1:
        unit = max(1, file_bytes // 256)
        times = F.floor(F.col("size") / unit + F.pmod(F.xxhash64("id", "size"), F.lit(1 << 20)) / (1 << 20))
        points = sized.select(F.coalesce("id", F.lit(-(2**63))).alias("id"), times.cast("int").alias("times")).where("times > 0")
        points = points.select("id", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
        bounds = points.agg(F.percentile_approx("id", [i / n for i in range(1, n)], max(10_000, 4 * n))).first()[0] or []
    itemsize = coder(path).dtype.itemsize
    coded = rows.mapInArrow(encode(path, end_id, sorted(bounds)), "part int, id long, turn long, ids binary")
    dealt = coded.repartitionById(n, F.col("part")).sortWithinPartitions("part", F.col("id").asc_nulls_first(), "turn")
    parts = staged(dealt.select("part", "id", "ids").mapInArrow(write(uri, itemsize), "part int, n_docs long, n_ids long"), "parts")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return parts.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(parts: DataFrame, uri: str) -> DataFrame:
    """The documents of the parts that write_token_files returned, read from their files."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.select("part", "start").repartition(n, "part").mapInArrow(read_back(uri), "id long, start long, n_tokens long, ids_crc32 long")


def token_file_report(docs: DataFrame, path: str, id_col: str = "doc_id", **options) -> DataFrame:
    """Writes docs into new token files in the shared folder and returns one row per document as read from them."""
    uri = new_path(docs.sparkSession, "tokens")
    parts = write_token_files(docs, path, uri, id_col, **options)
    return read_token_files(parts, uri).withColumnRenamed("id", id_col)
