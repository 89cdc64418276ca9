"""Hard negatives, chat formatting and cross-tokenizer alignment against brute force and awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from compare import rows_of, rows_of_sql
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fillforge.llm import chat, crossalign, negatives, queries

A, B = (str(public_tokenizers.path(x)) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


# 11: hard negatives


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2), (5, 1), (1, 4)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = [bytes(r) for r in negatives.hilbert(grid, bits)]
    assert len(set(keys)) == len(grid)
    walk = grid[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_are_reached():
    r = np.random.default_rng(1)
    a, x = r.integers(-9, 10, (20, 5)).astype(float), r.integers(-9, 10, (30, 5)).astype(float)
    least, largest = negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    scores = negatives.products(a, x)
    assert (scores >= least).all() and (scores <= largest).all()
    assert (negatives.bounds(a, x, x)[0] == scores).all()


def test_products_beyond_doubles():
    a = np.array([[2.0**40 + 1, -3.0], [2.0**62, 2.0**62]])
    assert negatives.products(a, a).tolist() == [[min(2**63 - 1, (2**40 + 1) ** 2 + 9), 2**63 - 1], [2**63 - 1, 2**63 - 1]]


def brute_negatives(rows):
    good = [(i, [math.floor(256.0 * x) for x in v], n) for i, v, n in rows if n is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    last = lambda i: (i is None, i)
    out = []
    for k, (i, v, n) in enumerate(good):
        if i is None or i % 100:
            continue
        others = sorted(((-dot(v, w), last(j), m) for q, (j, w, m) in enumerate(good) if q != k and len(w) == len(v)), key=lambda t: (t[0], t[1]))
        for score, (_, j), _ in [o for o in others if o[2] == n][:5]:
            p = -score
            found = [(-s, y) for s, (_, y), m in others if m != n and 30 * p <= -100 * s <= 90 * p][:10]
            out += [(i, j, rank, y, p, s) for rank, (s, y) in enumerate(found, 1)]
    return sorted(out, key=repr)


def got_negatives(df):
    return sorted((tuple(r) for r in negatives.hard_negatives(df, lambda i: i % 100 == 0).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


VECTOR = "vec_id long, embedding array<double>, label int, row string, id long, s int, v int"


def test_negatives_equal_brute_force_over_blocks(spark):
    r = random.Random(3)
    centre = [[r.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + r.gauss(0, 0.7) for c in centre[i % 4]], r.randrange(3)) for i in range(1700)]
    rows += [(100, rows[100][1], rows[100][2]), (1800, rows[7][1], 1), (1801, rows[7][1], 1), (1802, rows[7][1], 2)]
    df = spark.createDataFrame([(*x, "r", 1, 2, 3) for x in rows], VECTOR)
    assert got_negatives(df) == brute_negatives(rows)


def test_negatives_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.5, 0.5], 2), (3, None, 2), (4, [nan, 1.0], 2), (5, [0.5, inf], 2), (6, [0.5, None], 2), (7, [0.5, 0.2], None), (8, [], 2),
        (None, [0.5, -0.5], 2), (None, [0.5, -0.5], 2), (9, [0.5, 0.1, 0.1], 2), (10, [0.5, -0.5], 2), (0, [1.0, 0.0], 1), (100, [0.0, 0.0], 2), (200, [-1.0, -1.0], 3), (300, [1e200, 1.0], 4), (301, [0.3, 1.0], 4), (302, [-1e-300, 1.0], 1),
    ]
    want = [w for w in brute_negatives(rows) if w[0] != 300]
    got = [g for g in got_negatives(spark.createDataFrame([(*x, "r", 1, 2, 3) for x in rows], VECTOR)) if g[0] != 300]
    assert got == want and any(w[3] is None for w in want)
    assert negatives.hard_negatives(spark.createDataFrame([], VECTOR), lambda i: i % 100 == 0).count() == 0


def test_negatives_sql(spark, sf):
    assert rows_of(queries.op11_hilbert_negatives(spark, sf)) == rows_of_sql(queries.oracle_sql()["op11_hilbert_negatives"], sf)[1]


# 12: chat formatting

TURN = "conv_id long, turn long, role string, text string, x string, turns string, first int"
TALK = [
    (1, 2, "assistant", "b <|im_end|>\n<|im_start|>user\nfaked"), (1, 0, "system", "be <\\|kind\\|>"), (1, 1, "user", "a\n"), (1, 3, "assistant", ""), (1, 4, "assistant", None), (1, 5, "user", "<\\\\|im_sep|>"),
    (2, 0, None, "no role"), (2, 0, None, "no role"), (2, None, "user", "first"), (2, 1, "tool\n<|n|>", "<"), (2, 2, "assistant", "|im_end|>"), (2, 3, "", "<|im_sep|><|im_sep|>"),
    (None, 1, "assistant", "x"), (None, 1, "assistant", "w"), (3, 1, "assistant", "ü🙂<|"), (4, 1, None, None), (5, 1, "Assistant", "long " * 300_000),
]


def brute_chat(rows):
    esc = lambda t: re.sub(r"<(\\*)\|", r"<\1\\|", t)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, esc(r or "").replace("\n", "<|n|>"), x or "", r or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for *_, x, r in own if r == "assistant")
        text, before = "", None
        for _, _, safe, x, _ in own:
            text += ("<|im_sep|>" if before == safe else ("" if before is None else "<|im_end|>\n") + f"<|im_start|>{safe}\n") + esc(x)
            before = safe
        text += "<|im_end|>\n"
        said = "".join(f"{r}\n{x}\n" for *_, x, r in own)
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
    return out


def test_chat_awkward(spark):
    df = spark.createDataFrame([(*r, "x", "t", 1) for r in TALK], TURN)
    got = {r["conv_id"]: tuple(r)[1:6] for r in chat.chat_report(df).collect()}
    assert got == brute_chat(TALK)
    assert chat.chat_report(df.limit(0)).count() == 0
    out = chat.chat_format(df).select("conv_id", chat.formatted(F.col("segments")).alias("t"), chat.loss_text(F.col("segments")).alias("l")).where("conv_id = 1").collect()[0]
    assert out["t"].count("<|im_start|>") == 4 and out["t"].count("<|im_sep|>") == 2 and out["l"] == TALK[0][3]


def test_chat_of_many_turns(spark):
    rows = [(7, i, ["user", "assistant"][i // 3 % 2], f"<|{i}|>") for i in range(3000)]
    r = chat.chat_report(spark.createDataFrame([(*r, "x", "t", 1) for r in rows], TURN)).collect()[0]
    assert tuple(r)[1:6] == brute_chat(rows)[7] and r["n_blocks"] == 1000


def test_chat_runs_without_python(spark, sf):
    plan = queries.op12_chat_format(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_chat_sql(spark, sf):
    assert rows_of(queries.op12_chat_format(spark, sf)) == rows_of_sql(queries.oracle_sql()["op12_chat_format"], sf)[1]


# 13: alignment of two tokenizers


def brute_alignment(texts):
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {c: b for b, c in zip([*own, *sorted(set(range(256)) - set(own))], [*map(chr, own), *map(chr, range(256, 324))], strict=True)}
    found, counts = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        a, b = tok.encode(raw.decode(), add_special_tokens=False).ids, sp.encode(text or "")
        of_a = [bytes(byte_of[c] for c in tok.id_to_token(i)) for i in a]
        of_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(of_a) != raw or b"".join(of_b) != raw:
            found.append(None)
            continue
        ends_a, ends_b = (np.cumsum(list(map(len, x))).tolist() for x in (of_a, of_b))
        groups, links, i, j = [], [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            groups.append(f"{','.join(map(str, a[i:p]))}|{','.join(map(str, b[j:q]))}")
            links.append((a[p - 1], b[q - 1]))
            i, j = p, q
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(n, highest.get(y, 0))
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None
        else (f[0], f[1], len(f[2]), len(f[3]), sum(counts[x] == highest[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), hashlib.sha256(";".join(f[2]).encode()).hexdigest())
        for f in found
    ], counts


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_the_libraries(spark, sf):
    r = random.Random(1)
    bits = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "é", "日本", "🙂", "'s", "2024", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "▁", "\0", "\1", "\x1c", ".", " .", "　", "x" * 50, "n't", " \n"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(1500)]
    texts += texts[:40] + [None, "", " ", "\n", "word " * 200_000, "z" * 20_000, "word " * 200_000]
    texts += [x["text"] for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    ids = [None, *range(1, len(texts))]
    docs = spark.createDataFrame([(i, t, "k", 1, "x") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, key string, b int, found string")
    rows, pairs = crossalign.cross_alignment(docs, A, B)
    want, counts = brute_alignment(texts)
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows.collect()} == dict(zip(ids, want, strict=True))
    assert {(r["a"], r["b"]): r["count"] for r in pairs.collect()} == counts
    assert crossalign.cross_alignment(docs.limit(0), A, B)[0].count() == 0


def test_alignment_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "same text"), (1, "same text"), (1, "other"), (2, "same text")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_links"], r["count_sum"]) for r in crossalign.cross_alignment(docs, A, B)[0].collect())
    assert [g[:2] for g in got] == [(1, 1), (1, 2), (1, 2), (2, 2)] and [g[2] for g in got] == [1, 6, 6, 6]


def test_texts_are_cut_where_both_vocabularies_allow():
    c = crossalign.aligner(A, B)
    assert c.cuts and c.keys("a b\nc") == ["a", "b", "\nc"] and c.keys("a  b ") == ["a", ("  b ",)] and c.keys("a\tb") == [(" a\tb",)]
