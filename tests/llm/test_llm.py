"""The corpus operators against brute force, the libraries themselves, and awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from compare import rows_of, rows_of_sql
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fillforge.llm import bpe, embeddings, language, licenses, minhash, mixing, passages, quality, queries, tokenfiles, weaklabels
from fillforge.llm.common import components, release, staged, unstage

WORD_BPE, BYTE_BPE = (str(public_tokenizers.path(x)) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
DOC = "doc_id long, text string, lang string, source string, n_chars long, k int, target string, _row string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(["the", "of", "and", "to"]) if i % 4 == 0 else "".join(r.choice("abcdeghilnorstu") for _ in range(r.randint(3, 8))) for i in range(n))


LONG = prose(1, 400)
NEAR = LONG.split()
NEAR[50], NEAR[200] = "changed", "words"
PASSAGE = prose(7, 70)
AWKWARD = [
    (1, LONG, "en", "a"), (2, LONG, "en", "a"), (2, LONG, "en", "a"), (3, " ".join(NEAR), "en", None), (4, "", "en", "b"), (5, None, None, "b"), (None, LONG, "en", None),
    (6, " \n\t ", "de", "c"), (7, "one", "de", "c"), (8, "ONE", "de", "c"), (9, "x" * 30_000, "fr", "d"), (10, prose(2, 30) + " " + PASSAGE + " " + prose(3, 30), "en", "a"),
    (11, prose(4, 60) + "\n" + PASSAGE.upper() + ". " + prose(5, 20), "en", "a"), (12, "### $$$ " * 60, "en", "a"), (13, "a b " * 100, "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), 0, "t", "r") for r in AWKWARD], DOC)


@pytest.fixture(scope="module")
def real(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def top(links, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = top(edges, {n for e in edges for n in e})
    assert got == {n: want[n] for a, b in edges if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_staged_tables_can_be_released(spark):
    tables = [staged(spark.range(3), "some") for _ in range(2)]
    unstage(tables[0])
    assert tables[1].count() == 3 and release(spark) >= 2 and release(spark) == 0
    where = spark._jvm.org.apache.hadoop.fs.Path(tables[1].staged_path)
    assert not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


# 10: near duplicates


def shingle_set(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def test_near_duplicates(real):
    got = by_id(minhash.near_duplicates(real, width=2))
    sets = {r["doc_id"]: shingle_set(r["text"], 2) for r in real.collect()}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = top(links, ids)
    assert links and {d: (r["component_id"], r["n_shingles"], r["kept"]) for d, r in got.items()} == {d: (want[d], len(sets[d]), want[d] == d) for d in ids}


def test_near_duplicates_awkward(docs):
    rows = minhash.near_duplicates(docs).collect()
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in rows}
    assert len(rows) == len(AWKWARD)
    assert (got[2], got[3], got[None], got[4], got[5], got[8], got[9]) == ((1, False), (1, False), (1, False), (4, True), (5, True), (7, False), (9, True))
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13]


def test_members_far_from_the_leader_are_linked(spark):
    base = [f"w{i}" for i in range(400)]
    chain = [(i, " ".join([f"n{j}" for j in range(30 * i)] + base[30 * i :])) for i in range(12)]
    got = by_id(minhash.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string"), width=2))
    assert {r["component_id"] for r in got.values()} == {0}


# 9, 8: rules and mixing


def test_quality_sql(spark, sf):
    assert rows_of(queries.op9_host_quality(spark, sf)) == rows_of_sql(queries.oracle_sql()["op9_host_quality"], sf)[1]


def test_quality_awkward(docs):
    got = by_id(quality.quality_report(docs))
    assert (got[4]["n_words"], got[5]["base_failed"], got[13]["n_repeat_words"], got[1]["kept"], got[12]["kept"]) == (0, True, 200, True, False)
    left = quality.quality_filter(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 2, 2, 3, 10, 11]
    assert quality.quality_report(docs.limit(0)).count() == 0


def test_bad_host_takes_doubtful_documents_only(spark):
    rows = [(i, "#### " * 3 * (i % 20 > 0) + prose(i, 90), "bad") for i in range(100)] + [(i, prose(i, 90), f"h{i % 9}") for i in range(100, 200)]
    got = by_id(quality.quality_report(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert {i for i, r in got.items() if not r["kept"]} == {i for i in range(100) if i % 20}


def test_mix(spark, sf, docs):
    assert rows_of(queries.op8_mix_sources(spark, sf)) == rows_of_sql(queries.oracle_sql()["op8_mix_sources"], sf)[1]
    got = mixing.mix_report(docs).collect()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got) and sorted(map(str, got)) == sorted(map(str, mixing.mix_report(docs).collect()))
    want = Counter({i: 0 for i, *_ in AWKWARD})
    for r in got:
        want[r["doc_id"]] += r["taken"] // r["size"] if r["size"] else 0
    out = mixing.mix(docs)
    assert out.columns == docs.columns and Counter(r["doc_id"] for r in out.collect()) == +want
    assert mixing.mix_report(docs.limit(0)).count() == 0


def test_taken_words_come_near_the_targets(real):
    """Within four standard deviations of the draws, source by source."""
    by = {}
    for r, d in zip(mixing.mix_report(real).orderBy("doc_id").collect(), real.orderBy("doc_id").collect(), strict=True):
        by.setdefault(d["source"], []).append(r)
    for rows in by.values():
        target, size = rows[0]["target"], sum(r["size"] for r in rows)
        f = target / size % 1
        assert size == rows[0]["source_size"] and abs(sum(r["taken"] for r in rows) - target) <= 4 * (f * (1 - f) * sum(r["size"] ** 2 for r in rows)) ** 0.5 + 1e-6


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 1000}, {"a": 1}, {"a": 5, "b": 0}, {"b": 7, None: 7, "a": 900}, {c: 3**i for i, c in enumerate("abcdefg")}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "_source string, source_size long")
    got = {r["_source"]: r["target"] for r in mixing.source_targets(df, (5, 2, 1), 1.5, 2.0).collect()}
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, free, want = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        w = sum(weight[n] for n in free)
        over = [n for n in free if left * weight[n] / w > 2 * sizes[n]]
        if not over:
            want |= {n: left * weight[n] / w for n in free}
            break
        for n in over:
            want[n] = 2 * sizes[n]
            left -= want[n]
            free.discard(n)
    assert got == pytest.approx(want)


# 2, 7: tokens


def whole(path):
    return Tokenizer.from_file(path)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("abtheing .,!?'\n\t\x1c é1ßİ中") , max_size=60))
def test_encoders_on_any_text(text):
    assert bpe.coder(WORD_BPE).encode_all([text])[0] == whole_word.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokenfiles.coder(BYTE_BPE).encode_all([text], 2)[0], "<u2").tolist() == whole_byte.encode(text, add_special_tokens=False).ids + [2]


whole_word, whole_byte = whole(WORD_BPE), whole(BYTE_BPE)


@pytest.mark.parametrize("leaf", [5, 64, 4096])
def test_joins_are_exact(monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF", leaf)
    c = bpe.Coder(WORD_BPE)
    r = random.Random(9)
    texts = ["".join(r.choice(["tion", "the", "ing", "er", "a", "s"]) for _ in range(3000)), "a" * 9001, "!?" * 5000, "é" * 3000 + "x<|endoftext|>" + "ab" * 4000, "日本語" * 2000]
    assert c.encode_all(texts) == [e.ids for e in whole_word.encode_batch(texts, add_special_tokens=False)]


def test_bpe(docs, monkeypatch):
    for limit in (bpe.LONG, 50):
        monkeypatch.setattr(bpe, "LONG", limit)
        got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.bpe(docs, WORD_BPE, digest=True).collect())
        want = Counter()
        for i, text, *_ in AWKWARD:
            ids = whole_word.encode(text or "", add_special_tokens=False).ids
            want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(whole_word.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
        assert got == want
    assert bpe.bpe(docs.limit(0), WORD_BPE).count() == 0


def test_token_files(spark, docs, real, tmp_path):
    uri = f"file://{tmp_path}/t"
    parts = tokenfiles.write_token_files(real, BYTE_BPE, uri, file_bytes=60_000)
    assert parts.count() > 3
    got, at = by_id(tokenfiles.read_token_files(parts, uri), "id"), 0
    texts = {r["doc_id"]: r["text"] for r in real.collect()}
    stream = []
    for i in sorted(texts):
        ids = whole_byte.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        assert tuple(got[i])[1:] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
        stream += ids
    f = tokenfiles.TokenFile(f"{uri}/part-000000.arrow")
    tokens, mask = f[0]
    assert len(f) > 1 and tokens.tolist() == stream[: tokenfiles.SEQUENCE] and mask.true_count == tokenfiles.SEQUENCE and not tokens.flags.owndata
    rows = tokenfiles.token_file_report(docs, BYTE_BPE).orderBy("start").collect()
    assert [r["doc_id"] for r in rows][0] is None and len(rows) == len(AWKWARD) and rows[-1]["start"] + rows[-1]["n_tokens"] == sum(r["n_tokens"] for r in rows)
    assert tokenfiles.token_file_report(docs.limit(0), BYTE_BPE).count() == 0


# 5: passages


def test_passages(docs):
    pairs = {(r["doc_id"], r["other_doc_id"]): r for r in passages.passage_report(docs).collect()}
    assert set(pairs) == {(2, 1), (3, 1), (3, 2), (11, 10)} - ({(3, 2)} - set(pairs))
    r = pairs[11, 10]
    assert abs(r["start_word"] - 60) <= 1 and abs(r["end_word"] - 130) <= 1 and r["n_match"] >= 69
    left = passages.drop_repeats(docs)
    got = {r["doc_id"]: r for r in left.collect()}
    assert left.columns == docs.columns and got[10]["text"] == dict((i, t) for i, t, *_ in AWKWARD)[10]
    assert got[11]["n_chars"] == len(got[11]["text"]) and 70 <= len(got[11]["text"].split()) <= 82 and {2, 3}.isdisjoint(got) and {4, 5, 6, None} <= set(got)
    assert passages.passage_report(docs.limit(0)).count() == 0


def test_chains_allow_edits(spark):
    words = prose(11, 120).split()
    fuzzy = [w if i % 17 else "edited" for i, w in enumerate(words)]
    rows = [(1, prose(12, 80) + " " + " ".join(words)), (2, " ".join(fuzzy[:60] + ["extra"] + fuzzy[60:]) + " " + prose(13, 50)), (3, prose(14, 300))]
    got = passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(x["doc_id"], x["other_doc_id"]) for x in got] == [(2, 1)] and got[0]["end_word"] - got[0]["start_word"] >= 100


@pytest.mark.parametrize("apart", [10, 60, 120, 300])
def test_passages_of_one_chain_are_split(spark, apart):
    one, two = prose(31, 60), prose(32, 60)
    rows = [(i, " ".join([prose(40 + i, 30), one, prose(50 + i, apart), two, prose(60 + i, 30)])) for i in (1, 2)]
    got = [(x["start_word"], x["end_word"]) for x in passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = {*range(30, 90), *range(90 + apart, 150 + apart)}
    found = {w for lo, hi in got for w in range(lo, hi)}
    assert len(got) == (1 if apart < 30 else 2) and want <= found and (apart < 30 or len(found - want) <= 8)


@pytest.mark.parametrize("times", [(1, 2), (2, 1), (1, 4)])
def test_passages_repeat_within_a_document(spark, times):
    copies = lambda i, n: " ".join(prose(100 * i + j, 80) + " " + prose(33, 60) for j in range(n))
    docs = spark.createDataFrame([(i + 1, copies(i + 1, n)) for i, n in enumerate(times)], "doc_id long, text string")
    got = passages.passage_report(docs).collect()
    found = {w for x in got for w in range(x["start_word"], x["end_word"])}
    assert {w for n in range(times[1]) for w in range(140 * n + 80, 140 * n + 140)} <= found
    assert {w for n in range(times[0]) for w in range(140 * n + 80, 140 * n + 140)} <= {w for x in got for w in range(x["other_start"], x["other_end"])}
    assert prose(33, 60) not in by_id(passages.drop_repeats(docs))[2]["text"]


def test_earlier_phrases_do_not_shift_the_match(spark):
    words = prose(34, 60).split()
    phrases = " ".join(" ".join(words[i : i + 12]) + " " + prose(400 + i, 40) for i in range(0, 60, 6))
    rows = [(1, prose(35, 40) + " " + " ".join(words)), (2, phrases + " " + " ".join(words) + " " + prose(36, 40))]
    for docs in (rows, [(3 - i, x) for i, x in rows]):
        got = passages.passage_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
        assert any(x["n_match"] >= 60 for x in got)


def test_exact_runs_meet_whatever_holds_their_parts(spark):
    words, own = prose(37, 60).split(), (prose(500 + i, 30) for i in range(99))
    parts = {1: words[:30], 2: words[30:], 10: words, 20: words, 30: words[:30], 40: words[30:]}
    got = passages.passage_report(spark.createDataFrame([(i, " ".join([next(own), *w, next(own)])) for i, w in parts.items()], "doc_id long, text string")).collect()
    assert [(x["doc_id"], x["other_doc_id"], x["start_word"], x["end_word"]) for x in got] == [(20, 10, 30, 90)]


def test_repeated_runs_equal_brute_force(spark):
    r = random.Random(3)
    blocks = [prose(600 + i, r.choice([8, 25, 40, 55])) for i in range(8)]
    rows = [(i, " ".join(prose(700 + 20 * i + j, r.randint(1, 30)) if r.random() < 0.3 else r.choice(blocks) for j in range(8))) for i in range(1, 80)]
    first, want = {}, set()
    for i, text in rows:
        w = text.split()
        for p in range(len(w) - 49):
            if first.setdefault(tuple(w[p : p + 50]), i) < i:
                want |= {(i, x) for x in range(p, p + 50)}
    got = passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert want and want <= {(x["doc_id"], w) for x in got for w in range(x["start_word"], x["end_word"])}


def test_one_word_over_and_over(spark):
    rows = [(1, prose(41, 30) + " word" * 900), (2, " word" * 700 + " " + prose(42, 30)), (3, prose(43, 99))]
    got = passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x["doc_id"], x["other_doc_id"]) for x in got} == {(2, 1)} and len(got) < 60
    assert set(range(700)) <= {w for x in got for w in range(x["start_word"], x["end_word"])}


def test_fuzzy_passages_are_found(spark):
    """Passages of 100 words with every 20th changed, left out or doubled in turn, which is a similarity of 5-word shingles
    of about 0.6: nine of ten are found."""
    rows, want = [], {}
    for i in range(0, 200, 2):
        words = prose(1000 + i, 100).split()
        copy = [x for j, w in enumerate(words) for x in ([w] if j % 20 != i % 20 else (["new"], [], [w, w])[j // 20 % 3])]
        rows += [(i, " ".join([prose(2000 + i, 50), *words, prose(3000 + i, 50)])), (i + 1, " ".join([prose(4000 + i, 50), *copy, prose(5000 + i, 50)]))]
        want[i + 1] = set(range(50, 50 + len(copy)))
    found = {}
    for x in passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert x["other_doc_id"] == x["doc_id"] - 1
        found.setdefault(x["doc_id"], set()).update(range(x["start_word"], x["end_word"]))
    assert sum(len(w & found.get(i, set())) >= 0.8 * len(w) for i, w in want.items()) >= 90


def edited(words, rate, r):
    out = []
    for w in words:
        out += r.choice(([prose(r.randrange(10**6), 1)], [], [w, w])) if r.random() < rate else [w]
    return out


def test_fuzzy_passages_of_all_sizes(spark):
    """Random edits: of passages of 60, 100 and 200 words with 5, 10 and 15 % of the words changed, left out or doubled,
    nine of ten are found."""
    r, rows, want = random.Random(11), [], {}
    cases = [(size, rate) for size in (60, 100, 200) for rate in (5, 10, 15)]
    for n, (size, rate) in enumerate(c for c in cases for _ in range(40)):
        words = prose(10_000 + n, size).split()
        copy = edited(words, rate / 100, r)
        rows += [(2 * n, " ".join([prose(20_000 + n, 50), *words, prose(30_000 + n, 50)])), (2 * n + 1, " ".join([prose(40_000 + n, 50), *copy, prose(50_000 + n, 50)]))]
        want[2 * n + 1] = size, rate, set(range(50, 50 + len(copy)))
    found = {}
    for x in passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if x["other_doc_id"] == x["doc_id"] - 1:
            found.setdefault(x["doc_id"], set()).update(range(x["start_word"], x["end_word"]))
    hits = Counter((size, rate) for i, (size, rate, w) in want.items() if len(w & found.get(i, set())) >= 0.8 * len(w))
    assert all(hits[c] >= 34 for c in cases) and sum(hits.values()) >= 0.93 * len(want), hits


def test_fuzzy_halves_with_other_holders(spark):
    """As test_two_halves_with_other_holders, with 5 % of the words edited in every copy: nine of ten are found."""
    r, rows = random.Random(5), []
    for c in range(60):
        one, two = prose(6000 + c, 44).split(), prose(7000 + c, 44).split()
        held = {11: one, 30: one, 10: two, 31: two, 21: one + two}
        rows.append((100 * c + 20, " ".join([prose(8000 + c, 30), *one, *two, prose(9000 + c, 30)])))
        rows += [(100 * c + i, " ".join([prose(10_000 + 100 * c + i, 30), *edited(x, 0.05, r), prose(20_000 + 100 * c + i, 30)])) for i, x in held.items()]
    got = Counter()
    for x in passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if x["doc_id"] % 100 == 21 and x["other_doc_id"] == x["doc_id"] - 1:
            got[x["doc_id"]] += x["n_match"]
    assert sum(n >= 70 for n in got.values()) >= 51


def test_two_halves_with_other_holders(spark):
    """Documents 20 and 21 share 88 words; others of smaller and larger ids hold either half alone."""
    rows = []
    for c in range(60):
        one, two = prose(6000 + c, 44), prose(7000 + c, 44)
        held = {11: one, 30: one, 10: two, 31: two, 20: f"{one} {two}", 21: f"{one} {two}"}
        rows += [(100 * c + i, " ".join([prose(8000 + 100 * c + i, 30), x, prose(20000 + 100 * c + i, 30)])) for i, x in held.items()]
    got = {(x["doc_id"], x["other_doc_id"]) for x in passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect() if x["n_match"] >= 88}
    assert {(100 * c + 21, 100 * c + 20) for c in range(60)} <= got


def test_fenwick_chain_equals_quadratic():
    r = np.random.default_rng(2)
    for _ in range(30):
        n = int(r.integers(2, 40))
        x, y = r.integers(0, 200, n), r.integers(0, 200, n)
        best = np.ones(n)
        for i in np.lexsort((-y, x)):
            for j in range(n):
                if x[j] < x[i] and y[j] < y[i]:
                    best[i] = max(best[i], best[j] + 1 - passages.GAP * (x[i] - x[j] + y[i] - y[j]))
        found = passages.chains(x, y)
        score = lambda c: len(c) - passages.GAP * sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(c, c[1:], strict=False))
        if best.max() > 1:
            assert score(found[0]) == pytest.approx(best.max())
        for c in found:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:], strict=False))


# 3: vectors


def vector_links(rows):
    """Links by brute force: (number of links, smallest reachable id) by id. Odd vectors are zero here."""
    x = np.array([v for _, v in rows], float)
    x /= np.maximum(np.abs(x).max(axis=1), 1e-320)[:, None]
    x /= np.maximum(np.linalg.norm(x, axis=1), 1e-9)[:, None]
    hit = x @ x.T >= 0.9
    np.fill_diagonal(hit, False)
    ids = [i for i, _ in rows]
    groups = top([(ids[a], ids[b]) for a, b in np.argwhere(hit).tolist()], ids)
    return {i: (int(n), groups[i]) for i, n in zip(ids, hit.sum(axis=1), strict=True)}


def test_vectors(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(300, 16))
    near = base[:60] + r.normal(size=(60, 16)) * 0.12
    tight = base[100] + r.normal(size=(150, 16)) * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, near, tight, np.tile(base[7], (40, 1)), 3.0 * base[20:25]]))]
    small = [(2000 + i, v.tolist()) for i, v in enumerate(r.normal(size=(6, 3)))] + [(2010, [1.0, 0.0, 0.0]), (2011, [2.0, 0.0, 0.0])]
    line = [(2100, [1.0]), (2101, [2.0]), (2102, [-3.0]), (2103, [-1e-300]), (2104, [7.0])]
    big = [(2200, [1e200, 0.0]), (2201, [2e200, 0.0]), (2202, [1e-300, 1e-302]), (2203, [0.0, 5.0]), (2204, [-0.0, 5.0])]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, []), (904, [float("inf")] * 2), (905, [None] + [1.0] * 15), (None, base[7].tolist())]
    df = spark.createDataFrame(rows + small + line + big + odd, "vec_id long, embedding array<double>").withColumn("k", F.lit(1)).withColumn("v", F.lit(2))
    all_rows = embeddings.embedding_duplicates(df).collect()
    got = {x["vec_id"]: x for x in all_rows}
    want = vector_links(rows) | vector_links(small) | vector_links(line) | vector_links(big)
    twins = {i for i, v in rows if vector_links([(0, v), (1, base[7].tolist())])[0][0]}
    for i, (n, group) in want.items():
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (n + (i in twins), group, group == i), i
    assert len(all_rows) == len(rows + small + line + big + odd) and got[None]["component_id"] == 7 and not got[None]["kept"]
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i, _ in odd[:-1])
    assert embeddings.embedding_duplicates(df.limit(0)).count() == 0 and embeddings.embedding_duplicates(df.where("vec_id = 7")).count() == 1


def test_vectors_recall(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    noisy = df.select((F.col("vec_id") + 10_000).alias("vec_id"), F.transform("embedding", lambda v, i: v + 0.02 * F.sin(i * 7.0)).alias("embedding"), "label")
    both = df.union(noisy)
    got = by_id(embeddings.embedding_duplicates(both), "vec_id")
    rows = both.collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * (int((x @ x.T >= 0.9).sum()) - len(rows)) > 0


def test_ranks_equal_counting():
    r = np.random.default_rng(3)
    x = embeddings.unit(r.normal(size=(300, 8)))
    index = embeddings.MultiIndex(x, 8)
    which, cells = r.integers(0, 300, 50), r.integers(0, 64, 50)
    a, b = index.distances(x)
    for w, c, got in zip(which, cells, index.ranks(x, which, cells), strict=True):
        i, j = divmod(int(c), 8)
        assert got == (a[w][:, None] + b[w][None] < a[w, i] + b[w, j]).sum()


def test_rare_pairs_are_found(spark):
    """Twenty pairs at the least cosine among four thousand vectors: too few for a sample to meet, so that the length of
    the traversal comes from made-up neighbours."""
    r = np.random.default_rng(8)
    x = embeddings.unit(r.normal(size=(4000, 32)))
    for i in range(20):
        away = r.normal(size=32)
        away -= away @ x[i] * x[i]
        x[2000 + i] = 0.905 * x[i] + np.sqrt(1 - 0.905**2) * away / np.linalg.norm(away)
    got = by_id(embeddings.embedding_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")), "vec_id")
    assert sum(got[2000 + i]["component_id"] == i for i in range(20)) >= 18


# 4: licences


def test_license_places_equal_brute_force(docs, real):
    for df in (docs, real):
        got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in licenses.license_scan(df).collect())
        want = Counter()
        for r in df.select("doc_id", "text").collect():
            text = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
            at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
            want[r["doc_id"], len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))] += 1
        assert got == want


def test_licenses(docs, spark):
    texts = ["Licensed under CC BY-NC 4.0.", "All rights reserved. all RIGHTS reserved", "cc by cc by", "Foo. Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "general public", None, "mit license"]
    got = by_id(licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [got[i]["labels"] for i in range(8)] == ["cc-by,cc-by-nc-4.0", "reserved", "cc-by", "mit", "gpl,gpl-3.0", "", "", ""]
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[2]["n_base"], got[6]["n_words"], got[6]["first_word"]) == (2, 0, 3, 2, 0, None)
    assert licenses.license_scan(docs).count() == len(AWKWARD) and licenses.license_scan(docs.limit(0)).count() == 0


def test_every_template_in_a_long_text(spark):
    r = random.Random(4)
    index = licenses.Index()
    every = " . ".join(t[1] for t in licenses.TEMPLATES)
    bag = sorted(w.decode() for w in index.vocabulary)
    damaged = [" ".join(w if r.random() > 0.1 else "x" for w in t[1].split()) for t in licenses.TEMPLATES for _ in range(4)]
    texts = [every, " ".join(bag) + " " + every, "licensed under cc by 4 0 " + licenses.TEMPLATES[0][1], " ".join(bag) + " released under the mit license " + " ".join(bag)]
    texts += damaged + [" ".join(r.choices(bag, k=300) + r.choice(damaged).split() + r.choices(bag, k=300)) for _ in range(40)]

    def brute(text):
        words, out = licenses.words_of(text.encode()), {}
        for label, ws, keys in zip(index.labels, index.words, index.keys, strict=True):
            for start in range(len(words) - len(ws) + len(ws) // 4 + 1):
                share = sum(x == y for x, y in zip(ws, words[start : start + len(ws)], strict=False)) / len(ws)
                if share >= licenses.SHARE and all(words[start + p : start + p + len(k)] == k for p, k in keys):
                    out[label] = max(share, out.get(label, 0.0))
        return out

    got = by_id(licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, text in enumerate(texts):
        want = brute(text)
        base = {x for p, x in licenses.PHRASES.items() if f" {p} " in " " + b" ".join(licenses.words_of(text.encode())).decode() + " "}
        assert got[i]["labels"] == ",".join(sorted({*want, *base})) and got[i]["score"] == max(want.values(), default=float(bool(base)))
    assert {t[0] for t in licenses.TEMPLATES} <= set(got[0]["labels"].split(","))


def test_starts_are_intersected_without_loss():
    """Templates with one, many and no key phrases, among texts made of their words: every start with the share and the
    key phrases is among those that the index names, and starts that only one word speaks for are not."""
    r = random.Random(9)
    templates = (("a", "x y x y x", ("x y",)), ("b", "p q r s t u v w", ()), ("c", "solo", ("solo",)), ("d", "one two three four", ("two", "four")), ("e", "n m", ()))
    index = licenses.Index(templates, {w: r.random() for w in (b"x", b"y", b"p", b"q", b"u", b"two", b"four")})
    for _ in range(400):
        words = [w.encode() for w in r.choices("x y p q r s t u v w solo one two three four n m z".split(), k=r.randint(1, 40))]
        if r.random() < 0.7:
            words += [w if r.random() > 0.15 else b"z" for w in r.choice(index.words)]
        starts = index.starts(words)
        for t, (ws, keys) in enumerate(zip(index.words, index.keys, strict=True)):
            for s in range(len(words)):
                share = sum(x == y for x, y in zip(ws, words[s : s + len(ws)], strict=False)) / len(ws)
                if share >= licenses.SHARE and all(words[s + p : s + p + len(k)] == k for p, k in keys):
                    assert s in starts[t]
    assert index.starts([b"p", b"z", b"z", b"q"]) == {} and index.starts(b"two z z four".split()) == {}


# 1, 6: classifier, languages


def others(words, low, raw, share, odd):
    """The labellers of symbols, capitals, bare signs, echoes, word lengths and sentence ends, counted with plain loops."""
    bad, good = weaklabels.BAD, weaklabels.GOOD
    letters = [c for c in raw if c.isascii() and c.isalpha()]
    lines = [x for x in raw.encode().split(b"\n") if x.strip()]
    again = share(len(lines) - len(set(lines)), len(lines)) if len(lines) > 2 else 0.0
    twice = share(sum(a == b for a, b in zip(low, low[1:], strict=False)), len(words))
    mean = share(sum(map(len, words)), len(words))
    return {
        "v_symbols": bad * (share(sum(c in "#*$%&|<>{}[]~^" for c in raw), len(words)) >= 0.15), "v_shouting": bad * (share(sum(c.isupper() for c in letters), len(letters)) >= 0.4),
        "v_bare_signs": bad * (odd(lambda w: all(not chr(c).isalnum() and 0x20 < c < 0x7F for c in w)) >= 0.12), "v_echo": bad * (max(again, twice) >= 0.3),
        "v_word_length": good if 3 <= mean <= 9 else bad * (mean < 2 or mean > 14), "v_sentences": good * (odd(lambda w: w[-1:] in (b".", b",", b";", b":")) >= 0.04),
    }


def test_scorer_equals_the_definition(docs):
    """Scores by hand from the fitted weights: logarithms of counts of words and of shapes, each kind to unit length."""
    r = np.random.default_rng(2)
    w, bias = r.normal(size=weaklabels.BINS), 0.3
    for raw in [x["text"] for x in docs.select("text").collect()]:
        t = weaklabels.Look(raw.encode() if raw is not None else None)
        want = bias
        for bins in ((t.bins & (weaklabels.BINS - 1)).tolist(), (t.bins >> weaklabels.BITS).tolist()):
            counts = Counter(bins)
            length = math.sqrt(sum(math.log1p(n) ** 2 for n in counts.values()))
            want += sum(w[b] * math.log1p(n) / length for b, n in counts.items())
        row, at, x = weaklabels.features([t.bins.tobytes()])
        assert float(np.bincount(row, w[at] * x, 1)[0]) + bias == pytest.approx(want)


def test_votes_and_scores_equal_the_definitions(docs, real):
    """Vote patterns, posteriors and scores row by row: words, windows and blocks counted with plain sets."""
    def plain(raw):
        words = (raw or "").encode().split()
        low = [w.lower() for w in words]
        blocks = sum(len(set(low[i : i + weaklabels.BLOCK])) for i in range(0, len(low), weaklabels.BLOCK))
        grams = list(zip(low, low[1:], low[2:], strict=False))
        share = lambda a, b: a / b if b else 0.0
        odd = lambda f: share(sum(bool(f(w)) for w in words), len(words))
        known = odd(lambda w: w.lower() in weaklabels.FUNCTION_WORDS)
        bad = weaklabels.BAD
        return {
            "v_odd_ends": bad * (odd(lambda w: w[-1:] in [bytes([c]) for c in b"#*$%&|!?<>~^=+_"]) >= 0.12), "v_runs": bad * (odd(lambda w: re.search(rb"([!-/:-@\[-`{-~])\1", w)) >= 0.12),
            "v_distinct": bad * (len(low) >= 20 and 1 - blocks / len(low) >= 0.75), "v_windows": bad * (bool(grams) and 1 - len(set(grams)) / max(1, len(grams)) >= 0.3),
            **others(words, low, raw or "", share, odd), "v_prose": weaklabels.GOOD if known >= 0.08 else bad * (known < 0.01 and len(words) >= 50), "v_empty": bad * (len(words) < 3),
        }

    for df in (docs, real):
        rows = df.select("text").collect()
        for r in rows:
            t = weaklabels.Look(r["text"].encode() if r["text"] is not None else None)
            for name, vote in plain(r["text"]).items():
                assert getattr(weaklabels, name)(t) == vote, (name, r["text"])
    got = weaklabels.quality_scores(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in AWKWARD) and all(0 <= r["score"] <= 1 and r["kept"] == (r["score"] >= 0.5) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["posterior"], r["score"]))
    assert len(by[2]) == 1 and by[1] == by[2] == by[None] and by[4] == by[5] == by[6]


def test_classifier(spark, sf, docs, real):
    got = by_id(weaklabels.quality_scores(real))
    truth = by_id(spark.read.parquet(f"{sf}/labels.parquet"))
    right = sum((r["quality"] == 1) == got[i]["kept"] for i, r in truth.items())
    assert right >= 0.95 * len(truth)
    assert weaklabels.quality_scores(docs).count() == len(AWKWARD) and weaklabels.quality_scores(docs.limit(0)).count() == 0


def test_em_finds_accurate_labellers():
    r = np.random.default_rng(1)
    good, n = r.random(4000) < 0.8, len(weaklabels.LABELLERS)
    votes = np.where(good[:, None], np.where(r.random((4000, n)) < 0.03, 1, 0), np.where(r.random((4000, n)) < 0.5, 1, 0))
    p, counts = np.unique(votes @ 3 ** np.arange(n)[::-1], return_counts=True)
    post = dict(zip(p.tolist(), weaklabels.expectation_maximisation(p, counts)[0].tolist(), strict=True))
    assert np.mean((np.array([post[x] for x in (votes @ 3 ** np.arange(n)[::-1]).tolist()]) > 0.5) == good) > 0.97


def test_languages(spark, sf, real):
    langs, table = language.fit_text(real, "doc_id", "text", "lang")
    held = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet").where("doc_id >= 300")
    got, truth = by_id(language.document_languages(held, langs, table)), by_id(held)
    assert len(got) == len(truth) > 500  # rows that the likelihoods were not fitted on; their lang column is no evidence
    assert np.mean([got[i]["text_lang"] == r["lang"] for i, r in truth.items()]) > 0.9
    assert np.mean([got[i]["lang"] == r["lang"] for i, r in truth.items()]) > 0.95
    pages = spark.createDataFrame([(1, "http://a.example.de/x", "<html lang=de><body>" + "und der die nicht " * 9), (2, "http://a.example.de/y", None), (3, None, ""), (3, None, ""), (4, "http://b.org/", "<html lang='fr'><script>the of</script></html>")], "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in language.page_languages(pages, langs, table).collect()}
    assert (rows[1]["lang"], rows[2]["lang"], rows[4]["declared"], rows[4]["text_lang"], rows[3]["host"]) == ("de", "de", "fr", None, None)
    assert language.page_languages(pages.limit(0), langs, table).count() == 0
    none = language.fit_text(real.limit(0), "doc_id", "text", "lang")
    assert language.page_languages(pages, *none).where("lang is null").count() == 5


def test_languages_awkward(docs, real):
    langs, table = language.fit_text(real, "doc_id", "text", "lang")
    extra = docs.withColumns({x: F.lit("z") for x in ("ll", "host", "declared", "_hint", "first", "suffix", "n_grams")})
    rows = language.document_languages(extra, langs, table).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, *_ in AWKWARD) and {r["lang"] for r in rows} <= set(langs)
    got = {r["doc_id"]: r for r in rows}
    assert (got[4]["text_lang"], got[5]["n_grams"], got[9]["n_grams"], got[None]["host"]) == (None, 0, 30_000, None)
    assert all(0 < r["confidence"] <= 1 for r in rows) and language.document_languages(docs.limit(0), langs, table).count() == 0


def test_fused_language_equals_the_product_of_its_evidence(spark):
    """Posterior by hand: text likelihood, markup, suffix and a prior smoothed from all pages to suffix, domain, host."""
    langs = ["de", "en", "fr"]
    table = np.full((language.BINS, 3), -9.0)
    urls = ["http://a.x.de/1"] * 3 + ["http://b.x.de/", "http://c.y.fr/", "http://c.y.fr/2", "http://z/"]
    marks = ["de", "de", "en", "fr", "fr", None, "en"]
    pages = spark.createDataFrame([(i, u, f"<html lang={m}>" if m else "<p>") for i, (u, m) in enumerate(zip(urls, marks, strict=True))], "page_id long, url string, html string")
    said = lambda lang, x, right: 0.0 if x is None else np.log(right if x == lang else (1 - right) / 2)
    hosts = [u.split("/")[2] for u in urls]
    hints = [language.SUFFIX_LANGUAGE.get(h.split(".")[-1]) if "." in h else None for h in hosts]
    first = np.array([[said(x, m, language.MARKUP_RIGHT) + said(x, h, language.SUFFIX_RIGHT) for x in langs] for m, h in zip(marks, hints, strict=True)])
    counts = np.eye(3)[first.argmax(axis=1)]
    levels = ([h.split(".")[-1] for h in hosts], [".".join(h.split(".")[-2:]) for h in hosts], hosts)
    got = {r["page_id"]: r for r in language.page_languages(pages, langs, table).collect()}
    for i in range(len(urls)):
        prior = (counts.sum(axis=0) + 1) / (len(urls) + 3)
        for level in levels:
            of = counts[[x == level[i] for x in level]]
            prior = (of.sum(axis=0) + language.SMOOTHING * prior) / (len(of) + language.SMOOTHING)
        odds = np.exp(first[i]) * prior
        assert got[i]["lang"] == langs[int(odds.argmax())] and got[i]["confidence"] == pytest.approx(odds.max() / odds.sum())


def test_rare_languages_are_known(spark):
    rows = [(i, prose(i, 20), "en", "a") for i in range(200)] + [(900, "talo ja yksi kaksi kolme " * 6, "FI", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    pages = spark.createDataFrame([(1, "http://a.org/", "<html lang=hu><p>" + "egy kettő három négy öt " * 6), (2, "http://x.jp/", None)], "page_id long, url string, html string")
    langs, table = language.fit_text(docs, "doc_id", "text", "lang", sample=5, pages=pages)
    assert {"en", "fi", "hu", "ja"} <= set(langs)
    got = by_id(language.document_languages(docs, langs, table))
    assert (got[900]["lang"], got[900]["text_lang"], got[3]["lang"]) == ("fi", "fi", "en")
    found = by_id(language.page_languages(pages, langs, table), "page_id")
    assert (found[1]["lang"], found[1]["text_lang"], found[2]["lang"]) == ("hu", "hu", "ja")


def test_a_thousand_declared_codes(spark):
    """Junk codes are classes like any other; the plan does not grow with them."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    codes = [a + b + c for a in letters for b in letters for c in letters][::17][:1000]
    rows = [(i, f"http://h{i % 300}.x{i % 50}.{['com', 'de', 'org'][i % 3]}/", f"<html lang={codes[i % 1000]}><p>{prose(i, 3)}") for i in range(10_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    docs = spark.createDataFrame([(1, prose(1, 20), "en", "a")], "doc_id long, text string, lang string, source string")
    langs, table = language.fit_text(docs, "doc_id", "text", "lang", pages=pages)
    assert len(langs) > 1000
    got = language.page_languages(pages, langs, table).collect()
    assert len(got) == 10_000 and np.mean([r["lang"] == r["declared"] for r in got]) > 0.5 and all(0 < r["confidence"] <= 1 for r in got)


# The pipeline


def test_pipeline(spark, sf, docs):
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, sf)
        assert rows.columns == docs.columns
    out = corpus_pipeline.STAGES[-1][1](spark, rows, sf)
    assert out.count() == rows.count() > 0 and corpus_pipeline.run(spark, sf).count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_pipeline_stages_equal_brute_force(spark, sf):
    """Each stage's rows against a plain version over what the stage before kept."""
    now = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in quality.quality_report(now).where("kept").collect()}
    after = corpus_pipeline.quality_rules(spark, now, sf)
    assert Counter(map(tuple, after.collect())) == Counter(tuple(r) for r in now.collect() if r["doc_id"] in kept)

    now = spark.createDataFrame(after.collect(), after.schema)
    texts = {r["doc_id"]: r["text"] for r in now.collect()}
    sets, ids = {i: shingle_set(t, 5) for i, t in texts.items()}, sorted(texts)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    groups = top(links, ids)
    after = corpus_pipeline.near_dedup(spark, now, sf)
    assert links and sorted(r["doc_id"] for r in after.collect()) == [i for i in ids if groups[i] == i]

    now = spark.createDataFrame(after.collect(), after.schema)
    before = {r["doc_id"]: r["text"].split() for r in now.collect()}
    after = corpus_pipeline.substring_dedup(spark, now, sf)
    left = {r["doc_id"]: r["text"].split() for r in after.collect()}
    spans = {}
    for r in passages.passage_report(now).collect():
        spans.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    assert left == {i: rest for i, w in before.items() if (rest := [x for k, x in enumerate(w) if k not in spans.get(i, ())])}
    runs, seen = lambda w: {tuple(x.lower() for x in w[k : k + 50]) for k in range(len(w) - 49)}, {}
    for i in sorted(before):  # each run of 50 words that an earlier document holds lies in a reported passage
        for k in range(len(before[i]) - 49):
            run = tuple(x.lower() for x in before[i][k : k + 50])
            assert seen.setdefault(run, i) == i or set(range(k, k + 50)) <= spans[i]
    assert spans and runs(left[min(left)]) == runs(before[min(before)])

    now = spark.createDataFrame(after.collect(), after.schema)
    after = corpus_pipeline.mix_sources(spark, now, sf)
    times = Counter(map(tuple, after.collect()))
    want = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else 0 for r in mixing.mix_report(now).collect()}
    assert times == Counter({tuple(r): want[r["doc_id"]] for r in now.collect() if want[r["doc_id"]]})

    now = spark.createDataFrame(after.collect(), after.schema)
    tok = Tokenizer.from_file(WORD_BPE)
    ids_of = {r["doc_id"]: tok.encode(r["text"], add_special_tokens=False).ids for r in now.collect()}
    for r in corpus_pipeline.encode(spark, now, sf).collect():
        ids = ids_of[r["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
