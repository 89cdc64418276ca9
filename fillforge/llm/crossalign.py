"""Alignment of two tokenizers over a corpus: each distinct text once, weighted by how often it stands there."""

from __future__ import annotations

import hashlib
import re
from array import array
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillforge.llm.common import ship, staged
from fillforge.llm.tokenfiles import BYTE_CHARS, ByteCoder
from fillforge.llm.words import texts_of

BATCH_BYTES = 4 << 20  # of text whose chunks share one table of pairs
BATCHES = 2  # such tables that a task measures
MEMO = 80_000  # aligned chunks that a Python worker remembers, twice

#: Texts that are not cut: with other blanks than spaces and line ends, or with what the second tokenizer takes for a space.
WHOLE = re.compile("[^\\S \n]|[\x1c-\x1f▁]")
DOUBLED = re.compile(r"[ \n][ \n]|\A[ \n]|[ \n]\Z")
CHUNK = re.compile(r"[ \n]+[^ \n]+(?:[ \n]+\Z)?|[ \n]+\Z")

_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


class Codes(dict):
    """Numbers keys in the order in which they are asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Aligner:
    """A byte-level BPE file and a piece model. A text with a space before it is cut where a word ends and a space or line
    end follows: no piece of either vocabulary reaches across (checked here for the second; the first one's pieces end
    there by its pattern), so chunks encode alike everywhere, and their ends are ends of both tokenizers' tokens.

    A chunk's key is the chunk without its leading space; chunks with a leading line end keep it; where that would be
    unclear (more blanks in front), the key is the chunk in a tuple.
    """

    def __init__(self, a: str, b: str):
        import sentencepiece

        self.a = ByteCoder(a)
        self.a.tok.encode_special_tokens = True
        byte_of = {c: i for i, c in enumerate(BYTE_CHARS)}
        entries = self.a.tok.get_vocab(with_added_tokens=True).items()
        self.bytes_a = {i: bytes(map(byte_of.__getitem__, t)) if all(c in byte_of for c in t) else t.encode() for t, i in entries}
        self.size_a, self.name_a = {i: len(t) for i, t in self.bytes_a.items()}, {i: str(i) for i in self.bytes_a}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = {i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)} | {-1: b""}
        self.size_b, self.name_b = {i: len(t) for i, t in self.bytes_b.items()}, {i: str(i) for i in self.bytes_b}
        self.space = self.b.piece_to_id("▁")
        ordinary = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        self.cuts = not any(re.search("[^▁]▁|.\n|\n.", p, re.DOTALL) for p in ordinary)
        self.memo: dict = {}
        self.old: dict = {}  # the filling of memo before this one

    def keys(self, text: str) -> list:
        if not self.cuts or WHOLE.search(text):
            return [(" " + text,)]
        if not DOUBLED.search(text):
            return text.replace("\n", " \n").split(" ")
        return [c[1:] if c[0] == " " and c[1:2] not in ("", " ", "\n") else c if c[0] == "\n" and c[1:2] not in ("", " ", "\n") else (c,) for c in CHUNK.findall(" " + text)]

    @staticmethod
    def chunk(key) -> str:
        return key[0] if isinstance(key, tuple) else key if key[:1] == "\n" else " " + key

    def recall(self, keys: list) -> list[tuple]:
        """The alignments of distinct keys: n_a, n_b, the groups as a string, pairs that end together (a << 32 | b), and
        whether the tokens of both hold the chunk's bytes."""
        if len(self.memo) > MEMO:
            self.memo, self.old = {}, self.memo
        found = list(map(self.memo.get, keys))
        again = {k: self.old[k] for k, f in zip(keys, found, strict=True) if f is None and k in self.old}
        self.memo |= again
        missing = [k for k, f in zip(keys, found, strict=True) if f is None and k not in again]
        chunks = list(map(self.chunk, missing))
        ids_a = self.a.recall([b"\1" + c.encode() if isinstance(k, tuple) else c.encode() for k, c in zip(missing, chunks, strict=True)])
        ids_b = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        learnt = again
        for k, c, a, b in zip(missing, chunks, ids_a, ids_b, strict=True):
            if c[0] != " ":  # the space that the model adds is not this chunk's
                b = b[1:] if b[0] == self.space else [-1]
            learnt[k] = self.aligned(c.encode(), array(self.a.code, a).tolist(), b)
            if not isinstance(k, tuple) and len(k) < 256:
                self.memo[k] = learnt[k]
        return [learnt[k] if f is None else f for k, f in zip(keys, found, strict=True)]

    def aligned(self, raw: bytes, a: list[int], b: list[int]) -> tuple:
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return 0, 0, "", (), False
        if len(a) == 1 and len(b) == 1:
            return 1, 1, f"{a[0]}|{b[0]}", (a[0] << 32 | b[0],), True
        groups, pairs, ends = [], [], {e: j for j, e in enumerate(accumulate(map(self.size_b.__getitem__, b)), 1)}
        name_a, name_b = list(map(self.name_a.__getitem__, a)), list(map(self.name_b.__getitem__, b))
        first_a = first_b = 0
        for i, end in enumerate(accumulate(map(self.size_a.__getitem__, a)), 1):
            j = ends.get(end)
            if j is not None:
                of_a = name_a[first_a] if i == first_a + 1 else ",".join(name_a[first_a:i])
                of_b = name_b[first_b] if j == first_b + 1 else ",".join(name_b[first_b:j])
                groups.append(of_a + "|" + of_b)
                pairs.append(a[i - 1] << 32 | b[j - 1])
                first_a, first_b = i, j
        return len(a), len(b), ";".join(groups), tuple(pairs), True


TEXTS = "keys array<binary>, n_a array<long>, n_b array<long>, n_groups array<long>, sha array<string>"
TALLY = "pairs array<long>, weights array<long>, chunk_ends array<int>, chunk_pairs array<int>, text_ends array<int>, text_chunks array<int>, text_times array<int>"
ALIGNED = f"b long, {TEXTS}, {TALLY}"
SCHEMA = pa.schema([("b", pa.int64()), *[(c, pa.list_({"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}[t[6:-1]])) for c, t in (x.split() for x in f"{TEXTS}, {TALLY}".split(", "))]])


def align(a: str, b: str):
    """(text, times) of distinct texts to one row per BATCH_BYTES of text: what is known of each text, and which pairs end
    together in it. Chunks are numbered within the row; a chunk names its pairs, a text its distinct chunks and how often
    each stands in it. weights counts the pairs of all texts, each as often as it stands in the corpus."""

    def one(c: Aligner, texts: list[str], times: np.ndarray, no: int) -> pa.RecordBatch:
        codes = Codes()
        number = codes.__getitem__
        coded = [np.fromiter(map(number, k), np.int64, len(k)) for k in map(c.keys, texts)]
        chunks = c.recall(list(codes))
        n_a, n_b, n_groups = (np.array([x[0] for x in chunks]), np.array([x[1] for x in chunks]), np.array([len(x[3]) for x in chunks]))
        good = np.array([x[4] for x in chunks])
        strings = [x[2] for x in chunks]
        sizes = np.array([len(x) for x in coded])
        flat = np.concatenate(coded)
        first = np.cumsum(sizes) - sizes
        fine = np.logical_and.reduceat(good[flat], first)
        total = lambda x: np.where(fine, np.add.reduceat(x[flat], first), 0)
        sha = [hashlib.sha256(";".join(map(strings.__getitem__, k.tolist())).encode()).hexdigest() if f else "" for k, f in zip(coded, fine, strict=True)]
        owner = np.repeat(np.arange(len(texts)), sizes)
        used, often = np.unique((owner * len(chunks) + flat)[fine[owner]], return_counts=True)
        text_of, chunk_of = np.divmod(used, len(chunks))
        chunk_weight = np.zeros(len(chunks), np.int64)
        np.add.at(chunk_weight, chunk_of, often * times[text_of])
        pairs, at = np.unique(np.fromiter(chain.from_iterable(x[3] for x in chunks), np.int64, int(n_groups.sum())), return_inverse=True)
        weights = np.zeros(len(pairs), np.int64)
        np.add.at(weights, at, np.repeat(chunk_weight, n_groups))
        ends = np.searchsorted(text_of, np.arange(len(texts)), side="right")
        row = [no, [hashlib.sha256(t.encode()).digest() for t in texts], total(n_a), total(n_b), total(n_groups), sha, pairs, weights, np.cumsum(n_groups), at, ends, chunk_of, often]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, SCHEMA, strict=True)], schema=SCHEMA)

    def run(batches):
        c, no = aligner(a, b), TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in texts_of(whole, "text", BATCH_BYTES):
                yield one(c, batch.column(0).to_pylist(), batch.column(1).to_numpy(), no)
                no += 1

    return run


MEASURES = "key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def measure(batches):
    """Rows of align() with the corpus-wide counts of their pairs (found: pair, count, best) to one row per text."""
    for batch in batches:
        for i in range(batch.num_rows):
            get = lambda c: batch.column(c).slice(i, 1).flatten()  # noqa: B023, E731
            number = lambda c: get(c).to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
            found, pairs = get("found"), number("pairs")
            order = np.argsort(found.field("pair").to_numpy())
            counts, top = found.field("count").to_numpy()[order], found.field("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
            if len(counts) != len(pairs):
                raise ValueError("a pair has no count")
            ends, of = number("chunk_ends"), number("chunk_pairs")

            def sums(x, of, ends):
                run = np.append(0, np.cumsum(x[of]))
                return run[ends] - run[np.append(0, ends[:-1])]

            chunks, often, text_ends = number("text_chunks"), number("text_times"), number("text_ends")
            per_text = [sums(sums(x, of, ends)[chunks] * often, np.arange(len(chunks)), text_ends) for x in (top, counts)]
            own = [get(c) for c in ("keys", "n_a", "n_b", "n_groups")]
            yield pa.RecordBatch.from_arrays([*own, own[3], *map(pa.array, per_text), get("sha")], [c.split()[0] for c in MEASURES.split(", ")])


def cross_alignment(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Aligns the tokens of each whole text under two tokenizers by their byte offsets: space + text under the byte-level
    BPE file a, text under the piece model b (which adds the space).

    Returns (documents, pairs). documents has one row per row of docs: the id column, n_a, n_b (tokens), n_groups (the
    least stretches that both cut out), n_links (occurrence pairs that end together, one per group, as no token is
    empty), n_best (links whose count is the highest of their b id), count_sum (of the links' counts) and groups_sha256
    of "a1,a2|b1;..." ; pairs has a, b, count (links of that pair of ids in the corpus) and best.

    Texts that are null or empty, or whose tokens of either kind don't add up to the bytes of space + text, have no tokens:
    zeros and ''. Strings of special tokens are plain text. Rows that repeat an id or a text each count and are each
    returned. Very long texts are taken whole. An empty table gives an empty result. Other columns of docs are not read,
    so their names cannot clash.

    1. Texts are grouped by their full value, which counts copies before the shuffle; each distinct one is encoded and
    aligned once, in batches that are written with their own tables of pairs.
    2. The tables' counts are added up over the corpus; each batch gets the counts of its own pairs back by a join.
    3. Measures go back to the documents by a 256-bit hash of the text.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.nullif(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    distinct = rows.where("text is not null").groupBy("text").agg(F.count("*").alias("times"))
    batches = staged(distinct.mapInArrow(align(a, b), ALIGNED), "aligned")
    each = batches.select("b", F.explode(F.arrays_zip("pairs", "weights")).alias("x")).select("b", F.col("x.pairs").alias("pair"), F.col("x.weights").alias("weight"))
    counts = staged(each.groupBy("pair").agg(F.sum("weight").alias("count")), "pair-counts")
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = counts.groupBy(second.alias("second")).agg(F.max("count").alias("highest"))
    judged = counts.join(highest, second == F.col("second")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    judged = staged(judged, "pairs")
    parts = max(spark.sparkContext.defaultParallelism, -(-batches.count() // BATCHES))
    asked = each.select("b", "pair").join(judged, "pair").select("b", F.struct("pair", "count", "best").alias("x"))
    answers = asked.repartition(parts, "b").groupBy("b").agg(F.collect_list("x").alias("found"))
    measured = batches.repartition(parts, "b").join(answers, "b", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<pair:bigint,count:bigint,best:boolean>>")))
    measured = measured.mapInArrow(measure, MEASURES)
    keyed = rows.select("id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
    out = keyed.join(measured, "key", "left")
    long = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    documents = out.select(F.col("id").alias(id_col), *long, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return documents, judged.select(F.shiftright("pair", 32).alias("a"), second.alias("b"), "count", "best")
