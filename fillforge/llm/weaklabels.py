"""Quality classifier: overlapping heuristic labellers, their accuracies by EM, and a hashed linear scorer."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillforge.llm.common import ship, staged
from fillforge.llm.minhash import mixed

SAMPLE = 6000  # documents at most that the scorer is fitted on, by the order of a hash of their ids and words
BITS = 13
BINS = 1 << BITS  # of the hashed features
BLOCK = 500  # words within which v_distinct counts
MEMO = 300_000  # words that a Python worker remembers
GOOD, BAD, ABSTAIN = 2, 1, 0

#: Frequent function words of the languages that the labeller of running prose knows.
FUNCTION_WORDS = frozenset(b"the of and to in is that for with was on as it by der die das und in zu den mit von ist nicht auf la le les de et des que en du une el los las y un por con para".split())

SHAPES = bytes(c if c >= 0x80 else 0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A else 0x30 if 0x30 <= c <= 0x39 else c for c in range(256))
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FLAGS = ("odd_end", "run", "bare", "known", "stop")
HASH = 2 * BITS + len(FLAGS)  # bits below a word's hash


class Words(dict):
    """What the labellers and the scorer use of a word, as one number: the bins of the lowered word and of its shape,
    FLAGS (ends in a sign that prose does not end words in; holds a run of one sign; has no letters, digits or characters
    beyond ASCII; is a function word; ends in a sign that prose does end words in), and a hash of the lowered word."""

    def __missing__(self, word: bytes) -> int:
        low = word.lower()
        form = b"#" + re.sub(rb"(.)\1+", rb"\1", word.translate(SHAPES))
        h = xxhash.xxh3_64_intdigest(low)
        flags = (word[-1] in b"#*$%&|!?<>~^=+_", re.search(rb"([!-/:-@\[-`{-~])\1", word) is not None, not word.translate(None, SIGNS), low in FUNCTION_WORDS, word[-1] in b".,;:")
        out = h % BINS | xxhash.xxh3_64_intdigest(form) % BINS << BITS | h >> HASH << HASH
        for i, yes in enumerate(flags):
            out |= yes << 2 * BITS + i
        if len(self) >= MEMO:
            self.clear()
        self[word] = out
        return out


known_words = Words()


class Look:
    """What the labellers and the scorer see of a text."""

    def __init__(self, raw: bytes | None):
        self.raw = raw or b""
        words = self.raw.split()
        self.n = len(words)
        self.chars = sum(map(len, words))
        self.words = np.fromiter(map(known_words.__getitem__, words), np.uint64, self.n)
        self.hashes = self.words >> np.uint64(HASH)
        self.lines = [x for x in self.raw.split(b"\n") if x.strip()]

    def flagged(self, name: str) -> float:
        """The share of words with this flag."""
        return share(int((self.words >> np.uint64(2 * BITS + FLAGS.index(name)) & np.uint64(1)).sum()), self.n)

    @property
    def bins(self) -> np.ndarray:
        """Per word its bin, and the bin of its shape in the bits above."""
        return (self.words & np.uint64(BINS * BINS - 1)).astype(np.uint32)


def share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def bad_from(x: float, limit: float) -> int:
    return BAD if x >= limit else ABSTAIN


def distinct(x: np.ndarray) -> int:
    x = np.sort(x)
    return int((x[1:] != x[:-1]).sum()) + 1 if len(x) else 0


def v_empty(t: Look) -> int:
    return BAD if t.n < 3 else ABSTAIN


def v_symbols(t: Look) -> int:
    return bad_from(share(len(t.raw) - len(t.raw.translate(None, b"#*$%&|<>{}[]~^")), t.n), 0.15)


def v_shouting(t: Look) -> int:
    letters = len(t.raw) - len(t.raw.translate(None, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return bad_from(share(len(t.raw) - len(t.raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")), letters), 0.4)


def v_odd_ends(t: Look) -> int:
    """Words that end in punctuation other than prose has at its ends."""
    return bad_from(t.flagged("odd_end"), 0.12)


def v_runs(t: Look) -> int:
    """Words with runs of one sign, as in !! or ***."""
    return bad_from(t.flagged("run"), 0.12)


def v_bare_signs(t: Look) -> int:
    return bad_from(t.flagged("bare"), 0.12)


def v_distinct(t: Look) -> int:
    """Words that stand already in the same BLOCK of words; counting by blocks treats short and long texts alike."""
    if t.n < 20:
        return ABSTAIN
    found = distinct(t.hashes << np.uint64(HASH) ^ np.arange(t.n, dtype=np.uint64) // np.uint64(BLOCK))
    return bad_from(1 - share(found, t.n), 0.75)


def v_windows(t: Look) -> int:
    """Windows of three words that stand elsewhere in the text too."""
    if t.n < 3:
        return ABSTAIN
    h = t.hashes * np.uint64(0x9E3779B97F4A7C15)
    return bad_from(1 - share(distinct(h[:-2] + mixed(h[1:-1] + mixed(h[2:]))), t.n - 2), 0.3)


def v_echo(t: Look) -> int:
    """Words that repeat the one before, or lines that repeat an earlier one."""
    lines = 1 - share(len(set(t.lines)), len(t.lines)) if len(t.lines) > 2 else 0.0
    return bad_from(max(lines, share(int((t.hashes[1:] == t.hashes[:-1]).sum()), t.n)), 0.3)


def v_word_length(t: Look) -> int:
    mean = share(t.chars, t.n)
    return GOOD if 3 <= mean <= 9 else BAD if mean < 2 or mean > 14 else ABSTAIN


def v_prose(t: Look) -> int:
    known = t.flagged("known")
    return GOOD if known >= 0.08 else BAD if known < 0.01 and t.n >= 50 else ABSTAIN


def v_sentences(t: Look) -> int:
    """Prose ends its sentences."""
    return GOOD if t.flagged("stop") >= 0.04 else ABSTAIN


LABELLERS = (v_empty, v_symbols, v_shouting, v_odd_ends, v_runs, v_bare_signs, v_distinct, v_windows, v_echo, v_word_length, v_prose, v_sentences)


def pattern(t: Look) -> int:
    """The labellers' votes as one number to base 3."""
    out = 0
    for f in LABELLERS:
        out = out * 3 + f(t)
    return out


def votes_of(patterns: np.ndarray) -> np.ndarray:
    k = len(LABELLERS)
    return np.stack([patterns // 3 ** (k - 1 - j) % 3 for j in range(k)], axis=1)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good quality per vote pattern, and each labeller's chances of its three votes in either class.

    The chances to vote good, bad or not at all (accuracies) are estimated per class with the classes' shares, in turn
    with the posteriors. As a labeller knows one kind of bad text and is silent on the rest, the start takes any vote
    for bad as a sign of it, the more so the more there are; that also tells the classes apart. One pseudo-count per
    vote smooths.
    """
    votes, n = votes_of(patterns), counts.astype(float)
    hot = np.eye(3)[votes]
    post = np.array([0.95, 0.2, 0.02])[np.minimum((votes == BAD).sum(1), 2)]
    chance = np.zeros((2, len(LABELLERS), 3))
    for _ in range(rounds):
        logit = np.zeros(len(n))
        for cls, w in ((0, post * n), (1, (1 - post) * n)):
            counted = np.einsum("p,pjv->jv", w, hot) + 1
            chance[cls] = counted / counted.sum(1, keepdims=True)
            logit += (1 - 2 * cls) * (np.einsum("pjv,jv->p", hot, np.log(chance[cls])) + np.log(w.sum() + 1))
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        done = np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
    return post, chance


def looked_at(batches):
    """(id, text as bytes) to (id, pattern, bins): the one pass over the texts."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            seen = [Look(raw.as_py()) for raw in batch.column(1).slice(lo, 512)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 512), pa.array([pattern(t) for t in seen], pa.int32()), pa.array([t.bins.tobytes() for t in seen], pa.binary())], ["id", "pattern", "bins"])


def counted_bins(bins: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the words' and the shapes' bins of some texts: keys (text, then 0 for words and 1 for shapes, then the
    bin, as one number) in order, and how often each comes."""
    sizes = np.array([len(x) // 4 for x in bins], np.int64)
    flat = np.frombuffer(b"".join(bins), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(bins)), sizes)
    return np.unique(np.concatenate([(2 * row) << BITS | flat & BINS - 1, (2 * row + 1) << BITS | flat >> BITS]), return_counts=True)


def unit_values(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hashed bin and value of the features of counted texts: logarithms of the counts of words and of word shapes,
    each kind of each text to unit length."""
    kind, x = keys >> BITS, np.log1p(n)
    return kind >> 1, keys & BINS - 1, x / np.sqrt(np.bincount(kind, x * x))[kind]


def features(bins: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return unit_values(*counted_bins(bins))


def condensed(batches):
    """(pattern, key, bins) to (pattern, key, at, n): the counted bins of each text, of which there are 2 * BINS at most
    however long it is."""
    for batch in batches:
        pairs = [counted_bins([raw.as_py()]) for raw in batch.column(2)]
        more = [pa.array([k.astype(np.uint16).tobytes() for k, _ in pairs], pa.binary()), pa.array([n.astype(np.uint32).tobytes() for _, n in pairs], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *more], ["pattern", "key", "at", "n"])


def fit(rows: list, posterior: dict[int, float], epochs: int = 30, seed: int = 1) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels by averaged minibatch steps; classes weigh alike."""
    w, bias = np.zeros(BINS), 0.0
    if not rows:
        return w, bias
    y = np.array([posterior[r["pattern"]] for r in rows])
    good = min(max(y.mean(), 1e-3), 1 - 1e-3)
    weight = y / good + (1 - y) / (1 - good)
    keys = [np.frombuffer(r["at"], np.uint16).astype(np.int64) + (2 * i << BITS) for i, r in enumerate(rows)]
    row, at, x = unit_values(np.concatenate(keys), np.concatenate([np.frombuffer(r["n"], np.uint32) for r in rows]))
    off = np.searchsorted(row, np.arange(len(rows) + 1))
    rng, total, steps = np.random.default_rng(seed), np.zeros(BINS), 0
    bias_total = 0.0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), 64):
            part = order[lo : lo + 64]
            pick = np.concatenate([np.arange(off[i], off[i + 1]) for i in part])
            flat, values = at[pick], x[pick]
            owner = np.repeat(np.arange(len(part)), off[part + 1] - off[part])
            score = np.bincount(owner, w[flat] * values, len(part)) + bias
            error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y[part]) * weight[part] / len(part)
            w -= np.bincount(flat, 2.0 * error[owner] * values, BINS)
            bias -= 0.1 * error.sum()
            if epoch >= epochs // 2:
                total, bias_total, steps = total + w, bias_total + bias, steps + 1
    return total / steps, bias_total / steps


def scored(w: np.ndarray, bias: float, posterior: dict[int, float]):
    """(id, pattern, bins) to (id, posterior, score)."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                row, at, x = features(part.column(2).to_pylist())
                score = np.bincount(row, w[at] * x, part.num_rows) + bias
                post = [posterior[p] for p in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(post, pa.float64()), pa.array(1 / (1 + np.exp(-np.clip(score, -30, 30))))], ["id", "posterior", "score"])

    return run


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per row of docs: id, posterior (of good quality, from the votes), score (the linear scorer's) and kept
    (score of 0.5 or more).

    Null and empty texts have no words; they get votes and a score like any text, and so do very long ones, whose words
    are looked at whole. Rows that repeat an id are scored each; equal scores keep or go alike. On an empty table the
    result is empty. Other columns of docs are not read, so their names cannot clash.

    One pass looks at each text and writes its vote pattern and hashed words. Votes are counted per pattern, at most
    3 ** len(LABELLERS) of them, and EM runs on the counts. The scorer learns the posteriors of at most `sample`
    documents, those first by a hash of id and words (picked by a threshold for the hash first, so that no task sorts
    more than about twice as many; each comes as counts of its features, 2 * BINS at most), and scores all: its words and shapes reach further than the thresholds of the
    labellers.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    seen = staged(texts.mapInArrow(looked_at, f"id {kind}, pattern int, bins binary"), "looks")
    counted = seen.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    patterns, n = np.array([r["pattern"] for r in counted], np.int64), np.array([r["n"] for r in counted], np.int64)
    posterior = dict(zip(patterns.tolist(), expectation_maximisation(patterns, n)[0].tolist(), strict=True)) if counted else {}
    key = F.xxhash64("id", "bins")
    below = min(1.0, (1.5 * sample + 200) / max(1, int(n.sum())))
    low = seen.withColumn("key", key).where(F.pmod("key", F.lit(1 << 32)) < F.lit(int(below * (1 << 32)))).dropDuplicates(["key"])
    low = low.select("pattern", "key", "bins").mapInArrow(condensed, "pattern int, key long, at binary, n binary")
    rows = low.orderBy(F.pmod("key", F.lit(1 << 32)), "key").limit(sample).select("pattern", "at", "n").collect()
    w, bias = fit(rows, posterior)
    out = seen.mapInArrow(scored(w, bias, posterior), f"id {kind}, posterior double, score double")
    return out.select(F.col("id").alias(id_col), "posterior", "score", (F.col("score") >= 0.5).alias("kept"))
