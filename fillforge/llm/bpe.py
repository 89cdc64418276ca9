"""BPE encoding and decoding of whole texts, with tree concatenation for long unsplit ones."""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillforge.llm.common import ship
from fillforge.llm.tokenfiles import BYTE_CHARS, SIMPLE

#: A piece without a cut inside is encoded by halves from this many characters on.
LEAF = 4096
#: A text of more characters is dealt out as several rows.
LONG = 1 << 20
#: Encoded chunks that a Python worker remembers.
MEMO = 150_000

_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _coders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _coders[path] = Coder(path)
    return _coders[path]


class Coder:
    """A tokenizer file whose BPE marks word ends and drops white space, so that white space cuts a text safely."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.inner = BPE(vocab=model["vocab"], merges=pairs)
        self.strings = {i: s for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.memo: dict[str, tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex", "")
        #: Runs of letters and runs of signs are pieces of their own, in lower case: Latin words need no normalising.
        self.plain = "Lowercase" in kinds and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in split

    def chunks(self, text: str) -> list[str]:
        """Parts that encode independently. \\x1c-\\x1f are blanks to Python but symbols to the tokenizer."""
        return [text] if re.search("[\x1c-\x1f]", text) else text.split()

    def learn(self, chunks: set[str]) -> None:
        missing = chunks - self.memo.keys()
        if len(self.memo) + len(missing) > MEMO:
            self.memo = {c: self.memo[c] for c in chunks if c in self.memo}  # what is common stays
        new = [c for c in missing if len(c) <= LEAF and not (self.plain and self.learn_word(c))]
        for c, e in zip(new, self.tok.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.memo[c] = tuple(e.ids)

    def learn_word(self, chunk: str) -> bool:
        """Remembers Latin letters with signs after them, which are at most two pieces; False for any other chunk."""
        if not (m := SIMPLE.fullmatch(chunk)):
            return False
        ids: tuple[int, ...] = ()
        for piece in m.groups():
            if piece:
                low = piece.lower()
                if low not in self.words:
                    if len(self.words) >= MEMO:
                        self.words.clear()
                    seen = low if low.isascii() else "".join(map(BYTE_CHARS.__getitem__, low.encode()))
                    self.words[low] = tuple(t.id for t in self.tok.model.tokenize(seen))
                ids += self.words[low]
        self.memo[chunk] = ids
        return True

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        split = [self.chunks(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        out = []
        for cs in split:
            try:
                out.append(list(chain.from_iterable(map(self.memo.__getitem__, cs))))
            except KeyError:  # a chunk too long to be remembered
                out.append(list(chain.from_iterable(self.memo[c] if c in self.memo else self.long_chunk(c) for c in cs)))
        return out

    def pieces(self, chunk: str) -> list[tuple[str, int | None]]:
        """What the model sees of a chunk: pieces as (string, None), special tokens as (string, id)."""
        out: list[tuple[str, int | None]] = []
        for part in self.at_special.split(chunk):
            if part in self.special:
                out.append((part, self.special[part]))
            elif part:
                out += [(p, None) for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(part))]
        return out

    def long_chunk(self, chunk: str) -> list[int]:
        out: list[int] = []
        for piece, known in self.pieces(chunk):
            if known is not None:
                out.append(known)
            else:
                leaves = [piece[i : i + LEAF] for i in range(0, len(piece), LEAF)]
                out += self.tree([self.leaf(s, s_no == len(leaves) - 1) for s_no, s in enumerate(leaves)], True)
        return out

    def leaf(self, text: str, ends: bool) -> list[int]:
        """The ids of a stretch of a piece; only the stretch that ends the piece gets the word-end mark."""
        return [t.id for t in (self.tok.model if ends else self.inner).tokenize(text)]

    def tree(self, leaves: list[list[int]], ends: bool) -> list[int]:
        if len(leaves) == 1:
            return leaves[0]
        half = len(leaves) // 2
        return self.joined(self.tree(leaves[:half], False), self.tree(leaves[half:], ends), ends)

    def joined(self, left: list[int], right: list[int], ends: bool) -> list[int]:
        """The encoding of the concatenation. A window around the join is encoded anew and doubled until its outer
        tokens are those that stand there already: then each adjacent pair of the result is the encoding of its own
        text, and a sequence with that property is the one that the merges give."""
        k = 2
        while True:
            a, b = left[-k:], right[:k]
            whole_left, whole_right = k >= len(left), k >= len(right)
            text = "".join(self.strings[i] for i in a + b)
            closed = ends and whole_right
            if closed and self.suffix:
                text = text.removesuffix(self.suffix)
            mid = self.leaf(text, closed)
            if (whole_left or mid[0] == a[0]) and (whole_right or mid[-1] == b[-1]) and (len(mid) > 1 or whole_left and whole_right):
                return left[: -k if not whole_left else 0] + mid + right[k:]
            k *= 2


def result(coder: Coder, batches: list[list[int]], digest: bool) -> list[pa.Array]:
    counts = pa.array([len(x) for x in batches], pa.int64())
    if not digest:
        return [counts, pa.array(batches, pa.list_(pa.int32()))]
    texts = coder.tok.decode_batch(batches, skip_special_tokens=False)
    ids = [hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for x in batches]
    return [counts, pa.array(ids), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])]


def columns(digest: bool) -> tuple[str, list[str]]:
    return ("id long, n_tokens long, ids_sha256 string, decoded_sha256 string", ["id", "n_tokens", "ids_sha256", "decoded_sha256"]) if digest else ("id long, n_tokens long, ids array<int>", ["id", "n_tokens", "ids"])


def encode_short(path: str, digest: bool):
    def run(batches):
        c = coder(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo in range(0, len(texts), 512):
                yield pa.RecordBatch.from_arrays([ids.slice(lo, 512), *result(c, c.encode_all(texts[lo : lo + 512]), digest)], columns(digest)[1])

    return run


DEALT = "id long, k string, no int, piece int, ends boolean, text string"


def deal(path: str):
    """Long texts to rows: runs of whole chunks, and the leaves of each piece that has no cut inside (piece >= 0)."""

    def rows(c: Coder, text: str):
        run: list[str] = []
        size = piece = 0
        for chunk in c.chunks(text):
            if len(chunk) > LEAF:
                if run:
                    yield -1, True, " ".join(run)
                run, size = [], 0
                for string, known in c.pieces(chunk):
                    if known is not None:
                        yield -1, True, string
                        continue
                    leaves = [string[i : i + LEAF] for i in range(0, len(string), LEAF)]
                    for no, leaf in enumerate(leaves):
                        yield piece, no == len(leaves) - 1, leaf
                    piece += 1
            else:
                run.append(chunk)
                size += len(chunk)
                if size > LONG // 8:
                    yield -1, True, " ".join(run)
                    run, size = [], 0
        if run:
            yield -1, True, " ".join(run)

    def go(batches):
        c = coder(path)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key, out = hashlib.md5(text.encode()).hexdigest(), list(rows(c, text))
                for lo in range(0, len(out), 1024):
                    part = out[lo : lo + 1024]
                    yield pa.RecordBatch.from_pydict({"id": pa.array([i] * len(part), pa.int64()), "k": [key] * len(part), "no": pa.array(range(lo, lo + len(part)), pa.int32()), "piece": pa.array([p for p, _, _ in part], pa.int32()), "ends": [e for _, e, _ in part], "text": [t for _, _, t in part]})

    return go


def encode_rows(path: str):
    def run(batches):
        c = coder(path)
        for batch in batches:
            d = batch.to_pydict()
            plain = iter(c.encode_all([t for t, p in zip(d["text"], d["piece"], strict=True) if p < 0]))
            ids = [next(plain) if p < 0 else c.leaf(t, e) for t, p, e in zip(d["text"], d["piece"], d["ends"], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(x) for x in ("id", "k", "no", "piece")], pa.array(ids, pa.list_(pa.int32()))], ["id", "k", "no", "piece", "ids"])

    return run


def combine(path: str, digest: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """One text, maybe in several equal rows: each of its parts then comes as often."""
        c, times = coder(path), int((rows["no"] == 0).sum())
        rows = rows.drop_duplicates("no").sort_values("no")
        ids: list[int] = []
        for _, part in rows.groupby(((rows["piece"] < 0) | (rows["piece"] != rows["piece"].shift())).cumsum(), sort=True):
            ids += c.tree([list(map(int, x)) for x in part["ids"]], True)
        values = [x.to_pylist()[0] for x in result(c, [ids], digest)]
        return pd.DataFrame([[rows["id"].iloc[0], *values]] * times, columns=columns(digest)[1])

    return run


def bpe(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Encodes each whole text as the tokenizers library does with the file at path, without special tokens added.

    Returns one row per row of docs: the id column and n_tokens, then ids, or with digest=True ids_sha256 (of the
    decimal ids joined by one space) and decoded_sha256 (of the text that the library decodes from the ids). Null texts
    count as empty and have no tokens. Rows that repeat an id are encoded each; an empty table gives an empty result.
    Other columns of docs are not read, so their names cannot clash.

    Texts up to LONG characters are encoded where they lie. Longer ones are dealt out: white space cuts them into rows,
    and a piece without any cut is dealt as leaves, encoded in parallel and concatenated in a tree of joins.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema, names = columns(digest)
    short = texts.where(F.length("text") <= LONG).mapInArrow(encode_short(path, digest), schema)
    rows = texts.where(F.length("text") > LONG).mapInArrow(deal(path), DEALT)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded = rows.repartition(parts, "id", "k", "no").mapInArrow(encode_rows(path), "id long, k string, no int, piece int, ids array<int>")
    long = coded.groupBy("id", "k").applyInPandas(combine(path, digest), schema)
    return short.unionByName(long).select(F.col("id").alias(id_col), *names[1:])
