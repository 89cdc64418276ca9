"""Passages that repeat across documents, found by chaining shared k-mer seeds and aligning the chains."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillforge.llm.common import ship, staged, unstage, wrapped
from fillforge.llm.minhash import mixed
from fillforge.llm.words import GOLD, binary_parts, texts_of, word_hashes

K = 4  # words of a seed
WINDOW = 14  # the least seed of each run of so many is kept: equal runs of K + WINDOW - 1 words share one
GAP = 0.01  # cost of a word of distance between chained seeds, each of which scores 1
MARGIN = 64  # words that are aligned beyond a chain's ends
NEAR = 12  # of so many words after a mismatch half must come again nearby on the other side, or alignment ends there
ROW = 1 << 32  # positions of the rows of one id lie so far apart


def lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 (one more than rows) and the values of a list column without nulls."""
    off = column.offsets.to_numpy().astype(np.int64)
    return off - off[0], column.flatten()


def list_array(off: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values))


def shingle_hashes(h: np.ndarray) -> np.ndarray:
    s = np.full(len(h) - K + 1, K, np.uint64)
    for j in range(K):
        s = mixed(s * GOLD + h[j : j + len(s)])
    return s


def seed_marks(s: np.ndarray, doc: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks the shingles that are least, the first of equals, in some window of WINDOW that lies within one text (in
    the whole text, if that is shorter). doc numbers the texts, at and ends are places within them and their sizes."""
    low = np.uint64((1 << 20) - 1)
    key = s >> np.uint64(20) << np.uint64(20) | at.astype(np.uint64) & low
    key = np.where(at < ends, key, ~np.uint64(0))
    least, width = np.concatenate([key, np.full(WINDOW, ~np.uint64(0))]), 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        least[:-step] = np.minimum(least[:-step], least[step:])
        width += step
    inside = np.flatnonzero(at + WINDOW <= ends)
    found = inside + (((least[inside] & low) - (at[inside].astype(np.uint64) & low)) & low).astype(np.int64)
    marks = np.zeros(len(s), bool)
    marks[found] = True
    for i in np.flatnonzero((at == 0) & (ends > 0) & (ends < WINDOW)).tolist():
        marks[i + int(key[i : i + ends[i]].argmin())] = True
    return marks


def seeds(least: int):
    """(id, row, text as bytes) to (h, id, pos, turn, last): keys and word positions of the seeds, the number of the same
    seeds before each in the text, and whether it is the last of them. Texts under `least` words have none."""

    def run(batches):
        for whole in batches:
            for batch in texts_of(whole, "text"):
                h, off = word_hashes(batch.column(2))
                if len(h) < K:
                    continue
                n = np.diff(off)
                doc = np.repeat(np.arange(len(n)), n)[: len(h) - K + 1]
                s, at = shingle_hashes(h), np.arange(len(h) - K + 1) - off[doc]
                ends = np.where(n >= max(least, K), n - K + 1, 0)[doc]
                found = np.flatnonzero(seed_marks(s, doc, at, ends))
                s, doc, at = s[found], doc[found], at[found]
                order = np.lexsort((s, doc))
                new = np.append(True, (s[order][1:] != s[order][:-1]) | (doc[order][1:] != doc[order][:-1]))[: len(s)]
                turn, last = np.empty(len(s), np.int32), np.empty(len(s), bool)
                turn[order] = np.arange(len(s)) - np.flatnonzero(new)[np.cumsum(new) - 1]
                last[order] = np.append(new[1:], True)[: len(s)]
                ids, rows = (batch.column(c).to_numpy() for c in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (s.view(np.int64), ids[doc], at + rows[doc] * ROW, turn, last)], ["h", "id", "pos", "turn", "last"])

    return run


def chains(xs: np.ndarray, ys: np.ndarray) -> list[list[int]]:
    """Collinear chains of the matches (x, y), best first; each match joins one chain.

    A chain rises strictly in x and y. It scores 1 per match less GAP per word of distance on either side. As that cost
    is a sum over both sides, the best match to follow is a prefix maximum over y of score + GAP * (x + y), which a
    Fenwick tree keeps while x grows.
    """
    order = np.lexsort((-ys, xs))
    rank = np.unique(ys, return_inverse=True)[1] + 1
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (int(rank.max()) + 1)
    score, back = np.zeros(len(xs)), np.full(len(xs), -1)
    for i in order.tolist():
        best, r = (-1e18, -1), int(rank[i]) - 1
        while r > 0:
            best = max(best, tree[r])
            r -= r & -r
        here = GAP * float(xs[i] + ys[i])
        gain = best[0] - here
        score[i] = 1.0
        if gain > 0:
            score[i], back[i] = 1.0 + gain, best[1]
        entry, r = (score[i] + here, i), int(rank[i])
        while r < len(tree):
            tree[r] = max(tree[r], entry)
            r += r & -r
    out, used = [], set()
    for i in np.argsort(-score, kind="stable").tolist():
        chain: list[int] = []
        while i >= 0 and i not in used:
            used.add(i)
            chain.append(i)
            i = int(back[i])
        if len(chain) > 1:
            out.append(chain[::-1])
    return out


CHAIN = ["b", "a", "lo_b", "hi_b", "lo_a", "hi_a", "at_b", "at_a"]


def chain_pairs():
    """(b, a, matches) to the chains of two seeds or more, as spans with their matches. Edits may leave no more of a
    passage than two seeds side by side, so short chains stay; alignment judges them."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            off, m = lists(batch.column(2))
            pair = np.repeat(np.arange(batch.num_rows), np.diff(off))
            x, y = (m.field(c).to_numpy() for c in range(2))
            order = np.lexsort((y, x, pair))
            x, y, pair = x[order], y[order], pair[order]
            new = np.append(True, (pair[1:] != pair[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
            x, y, pair = x[new], y[new], pair[new]
            first = np.searchsorted(pair, np.arange(batch.num_rows + 1))
            dx, dy, same = np.diff(x), np.diff(y), pair[1:] == pair[:-1]
            # where both sides rise by steps that cost less than a match scores, the one chain is all there is
            odd = np.unique(pair[1:][same & ((dx <= 0) | (dy <= 0) | (GAP * (dx + dy) >= 1))])
            found = [np.arange(lo, hi) for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)) if hi - lo > 1] if not len(odd) else []
            if len(odd):
                knotty = set(odd.tolist())
                for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                    if i in knotty:  # small numbers keep the costs exact
                        found += [lo + np.array(c) for c in chains(x[lo:hi] - x[lo:hi].min(), y[lo:hi] - y[lo:hi].min())]
                    elif hi - lo > 1:
                        found.append(np.arange(lo, hi))
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            ends = np.cumsum([0, *map(len, found)])
            head, tail = flat[ends[:-1]], flat[ends[1:] - 1]
            b, a = (batch.column(c).to_numpy()[pair[head]] for c in range(2))
            sides = [pa.array(v) for v in (b, a, x[head], x[tail] + K, y[head], y[tail] + K)]
            yield pa.RecordBatch.from_arrays([*sides, list_array(ends, x[flat]), list_array(ends, y[flat])], CHAIN)

    return run


def strobes(batches):
    """(id, row, shared seeds) to pairs of seeds one apart: (h, id, pos, ahead, lo, lo2) with the key of the pair, how
    far ahead the second one stands and the smallest ids that hold either. A pair tells more of its place than a seed."""
    for batch in batches:
        if not batch.num_rows:
            continue
        off, m = lists(batch.column(2))
        doc = np.repeat(np.arange(batch.num_rows), np.diff(off))
        pos, h, lo = (m.field(c).to_numpy() for c in range(3))
        order = np.lexsort((pos, doc))
        pos, h, lo, doc = pos[order], h[order].view(np.uint64), lo[order], doc[order]
        i = np.flatnonzero((doc[2:] == doc[:-2]) & (pos[2:] - pos[:-2] <= 3 * WINDOW))
        key = mixed(h[i] * GOLD + mixed(h[i + 2]))
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (key.view(np.int64), batch.column(0).to_numpy()[doc[i]], pos[i], pos[i + 2] - pos[i], lo[i], lo[i + 2])], ["h", "id", "pos", "ahead", "lo", "lo2"])


def shared_stretches(least: int):
    """(id, row, shared seeds) to (id, row, from, to): where runs of `least` words may repeat exactly. In such a run all
    seeds are shared, follow each other within WINDOW words and leave less than that at either end."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            off, m = lists(batch.column(2))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(off))
            ids, rows = (batch.column(c).to_numpy() for c in range(2))
            pos = m.field(0).to_numpy() - rows[doc] * ROW
            order = np.lexsort((pos, doc))
            pos, doc = pos[order], doc[order]
            cut = np.append(True, (doc[1:] != doc[:-1]) | (np.diff(pos) > WINDOW))
            lo, hi = pos[cut], pos[np.append(cut[1:], True)] + K
            lo, hi, doc = np.maximum(lo - (WINDOW - 1), 0), hi + (WINDOW - 1), doc[cut]
            wide = hi - lo >= least
            lo, hi, doc = lo[wide], hi[wide], doc[wide]
            some, n = np.unique(doc, return_counts=True)
            ends = np.append(0, np.cumsum(n))
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(rows[some]), list_array(ends, lo), list_array(ends, hi)], ["id", "row", "lo", "hi"])

    return run


def run_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words, put together from runs whose sizes are powers of two."""
    n = len(h) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out, done, part, width = np.full(n, size, np.uint64), 0, mixed(h), 1
    while done < size:
        if size & width:
            out = mixed(out * GOLD + part[done : done + n])
            done += width
        part = mixed(part[:-width] * GOLD + part[width:])
        width *= 2
    return out


def covering(key: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Marks places (sorted) so that, of those of one key, the stretches of `size` words from the marked ones cover as
    much as all do. Only a text that repeats itself, like one word over and over, has places to spare."""
    keep = np.ones(len(at), bool)
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    for lo, hi in zip(first[n > 2].tolist(), (first + n)[n > 2].tolist(), strict=True):
        where = order[lo:hi]
        pos, last = at[where], 0
        keep[where[1:]] = False
        while last < len(pos) - 1:
            last = max(int(np.searchsorted(pos, pos[last] + size, side="right")) - 1, last + 1)
            keep[where[last]] = True
    return keep


def runs(least: int):
    """(id, row, text as bytes, from, to) to (h, id, pos) of the runs of `least` words in the stretches; of equal runs of
    one text, those that cover as much as all do."""

    def run(batches):
        for whole in batches:
            for batch in texts_of(whole, "text"):
                h, off = word_hashes(batch.column(2))
                ids, rows = (batch.column(c).to_numpy() for c in range(2))
                ends, lo = lists(batch.column(3))
                lo, hi = lo.to_numpy(), lists(batch.column(4))[1].to_numpy()
                doc = np.repeat(np.arange(batch.num_rows), np.diff(ends))
                lo, hi = off[doc] + lo, np.minimum(off[doc] + hi, off[doc + 1])
                inside = np.zeros(len(h) + 1, np.int64)
                fits = hi - lo >= least
                np.add.at(inside, lo[fits], 1)
                np.add.at(inside, hi[fits] - least + 1, -1)
                at = np.flatnonzero(np.cumsum(inside) > 0)
                if len(at):
                    found = run_hashes(h, least)[at]
                    doc = np.searchsorted(off, at, side="right") - 1
                    keep = covering(found + mixed(doc.astype(np.uint64)), at, least)
                    found, doc, at = found[keep].view(np.int64), doc[keep], at[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(ids[doc]), pa.array(at - off[doc] + rows[doc] * ROW)], ["h", "id", "pos"])

    return run


PASSAGE = ["b", "a", "start_b", "end_b", "start_a", "end_a", "n_match"]


def equal_stretches(least: int):
    """(b, a, ahead, positions in b) of equal runs, a's positions less by ahead, to passages."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            off, p = lists(batch.column(3))
            pair = np.repeat(np.arange(batch.num_rows), np.diff(off))
            order = np.lexsort((p.to_numpy(), pair))
            p, pair = p.to_numpy()[order], pair[order]
            cut = np.append(True, (pair[1:] != pair[:-1]) | (np.diff(p) > 1))
            lo, hi, pair = p[cut], p[np.append(cut[1:], True)] + least, pair[cut]
            b, a, ahead = (batch.column(c).to_numpy()[pair] for c in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (b, a, lo, hi, lo - ahead, hi - ahead, hi - lo)], PASSAGE)

    return run


def outermost(batches):
    """(b, a, passages) to the passages that lie in no other one of the pair on both sides."""
    for batch in batches:
        if not batch.num_rows:
            continue
        off, m = lists(batch.column(2))
        pair = np.repeat(np.arange(batch.num_rows), np.diff(off))
        v = np.stack([m.field(c).to_numpy() for c in range(5)])
        order = np.lexsort((-v[4], -v[3], v[2], -v[1], v[0], pair))
        v, pair = v[:, order], pair[order]
        keep = np.append(True, (pair[1:] != pair[:-1]) | (v[:4, 1:] != v[:4, :-1]).any(axis=0))
        v, pair = v[:, keep], pair[keep]
        stay = np.ones(len(pair), bool)
        first = np.searchsorted(pair, np.arange(batch.num_rows + 1))
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            for i in range(lo + 1, hi) if hi - lo > 1 else ():
                c = v[:, lo:hi]
                holds = (c[0] <= v[0, i]) & (v[1, i] <= c[1]) & (c[2] <= v[2, i]) & (v[3, i] <= c[3])
                stay[i] = holds.sum() == 1
            if hi - lo > 1:
                c = v[:, lo:hi]
                stay[lo] = ((c[0] <= v[0, lo]) & (v[1, lo] <= c[1]) & (c[2] <= v[2, lo]) & (v[3, lo] <= c[3])).sum() == 1
        b, a = (batch.column(c).to_numpy()[pair[stay]] for c in range(2))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (b, a, *v[:, stay])], PASSAGE)


def slices(batches):
    """(id, row, text as bytes, spans) to the word hashes of each span with its margins: (id, lo, hi, from, words)."""
    for whole in batches:
        for batch in texts_of(whole, "text"):
            h, off = word_hashes(batch.column(2))
            h = h.astype(np.uint32)
            ids, rows = (batch.column(c).to_numpy() for c in range(2))
            ends, m = lists(batch.column(3))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            lo, hi = (m.field(c).to_numpy() for c in range(2))
            base = rows[doc] * ROW
            first = np.maximum(0, lo - base - MARGIN)
            until = np.minimum(hi - base + MARGIN, np.diff(off)[doc])
            words = [h[x:y].tobytes() for x, y in zip((off[doc] + first).tolist(), (off[doc] + until).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[doc]), pa.array(lo), pa.array(hi), pa.array(first + base), pa.array(words, pa.binary())], ["id", "lo", "hi", "first", "words"])


def matched(x: np.ndarray, y: np.ndarray) -> int:
    """Words of a longest common subsequence."""
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    x, y, n = x[head:], y[head:], n - head
    differ = np.flatnonzero(x[::-1][:n] != y[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    last = np.zeros(len(y) + 1, np.int64)
    for w in x if len(y) else ():
        now = last.copy()
        now[1:] = np.maximum(last[1:], last[:-1] + (y == w))
        last = np.maximum.accumulate(now)
    return head + tail + int(last[-1])


def reach(x: np.ndarray, y: np.ndarray, costs: tuple[float, ...]) -> list[tuple[int, int, int]]:
    """How far two word runs go on alike on either side, with how many matches, for each cost: the ends with the most
    matches less the cost times the other words of the longer side. All ends come from one table of common subsequences."""
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    x, y = x[head:], y[head:]
    again = (x[:NEAR, None] == y[None, : NEAR + 4]).any(axis=1)
    if not len(again) or not len(y) or 2 * again.sum() < len(again):
        return [(head, head, head)] * len(costs)
    common = np.zeros((len(x) + 1, len(y) + 1), np.int32)
    for i, same in enumerate(x[:, None] == y[None]):
        common[i + 1, 1:] = np.maximum(common[i, 1:], common[i, :-1] + same)
        np.maximum.accumulate(common[i + 1], out=common[i + 1])
    longer = np.maximum(np.arange(len(x) + 1)[:, None], np.arange(len(y) + 1))
    out = []
    for cost in costs:
        i, j = divmod(int(((1 + cost) * common - cost * longer).argmax()), len(y) + 1)
        out.append((head + i, head + j, head + int(common[i, j])))
    return out


def stretches(starts: np.ndarray, ends: np.ndarray, hits: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """The longest runs (first, last) of a chain's seeds with percent of their words matched; each seed is in one or more.

    starts and ends (2 sides x seeds) are the seeds' words, hits the words matched up to the end of each. A run passes
    where the balance 100 * hits - percent * words of either side is not negative. A chain is cut first, to keep runs
    short, where the best balances up to a gap and from it on do not pay for the gap.
    """
    n = len(hits)
    if not n:
        return []
    close = 100 * hits - percent * ends  # balance up to a seed's end
    open_ = 100 * (hits - K) - percent * starts  # and up to its start
    if (close[:, -1] >= open_[:, 0]).all():
        return [(0, n - 1)]
    left = np.minimum.accumulate(open_, axis=1)[:, :-1]
    right = np.maximum.accumulate(close[:, ::-1], axis=1)[:, ::-1][:, 1:]
    cuts = np.flatnonzero((right < left).any(axis=0)) + 1
    if len(cuts):
        edges = [0, *cuts.tolist(), n]
        parts = zip(edges, edges[1:], strict=False)
        return [(lo + i, lo + j) for lo, hi in parts for i, j in stretches(starts[:, lo:hi], ends[:, lo:hi], hits[lo:hi], percent)]
    far = [i + int(np.flatnonzero((close[:, i:] >= open_[:, i : i + 1]).all(axis=0))[-1]) for i in range(n)]
    covered, out = np.zeros(n, bool), []
    for i in sorted(range(n), key=lambda i: starts[0, i] - ends[0, far[i]]):
        if not covered[i : far[i] + 1].all():
            covered[i : far[i] + 1] = True
            out.append((i, far[i]))
    return sorted(out)


def spans_that_match(px: np.ndarray, py: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> list[tuple[int, int, int, int, int]]:
    """The stretches of a chain of seeds at px and py of the words x and y with percent of their words matched: where
    they start and end on both sides, and the matches."""
    ex, ey = int(px[-1]) + K, int(py[-1]) + K
    if ex - px[0] == ey - py[0] and (x[px[0] : ex] == y[py[0] : ey]).all():
        return [(int(px[0]), ex, int(py[0]), ey, ex - int(px[0]))]
    hits, ex, ey, ends = 0, int(px[0]), int(py[0]), []
    for i, j in zip(px.tolist(), py.tolist(), strict=True):
        if i >= ex and j >= ey:
            hits += matched(x[ex:i], y[ey:j]) + K
        else:  # it overlaps the one before: what lies beyond that on both sides is new
            hits += max(0, min(i + K - ex, j + K - ey))
        ex, ey = max(ex, i + K), max(ey, j + K)
        ends.append((ex, ey, hits))
    e = np.array(ends).T
    return [(int(px[i]), int(e[0, j]), int(py[i]), int(e[1, j]), int(e[2, j] - e[2, i]) + K) for i, j in stretches(np.stack([px, py]), e[:2], e[2], percent)]


def align(least: int, percent: int):
    """Chains with the word hashes around them to passages of at least `least` words with percent of them matched. A
    chain that falls short as a whole gives the passages among its stretches."""
    strict = percent / (100 - percent) if percent < 100 else 1e9

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {c: batch.column(c).to_numpy() for c in ("b", "a", "first_b", "first_a")}
            off, at_b = lists(batch.column("at_b"))
            at_b, at_a = at_b.to_numpy(), lists(batch.column("at_a"))[1].to_numpy()
            words = {c: binary_parts(batch.column(f"words_{c}")) for c in "ba"}
            words = {c: (o // 4, raw.view(np.uint32)) for c, (o, raw) in words.items()}
            out: list[tuple] = []
            for r, (lo, hi) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
                x, y = (flat[o[r] : o[r + 1]] for o, flat in (words["b"], words["a"]))
                fb, fa = int(col["first_b"][r]), int(col["first_a"][r])
                for sx0, ex0, sy0, ey0, n0 in spans_that_match(at_b[lo:hi] - fb, at_a[lo:hi] - fa, x, y, percent):
                    # a far reach may cost the share that a short one keeps
                    after = reach(x[ex0 : ex0 + MARGIN], y[ey0 : ey0 + MARGIN], (1, strict))
                    before = reach(x[max(0, sx0 - MARGIN) : sx0][::-1], y[max(0, sy0 - MARGIN) : sy0][::-1], (1, strict))
                    for (after_b, after_a, more), (before_b, before_a, most) in zip(after, before, strict=True):
                        sx, sy, ex, ey, n = sx0 - before_b, sy0 - before_a, ex0 + after_b, ey0 + after_a, n0 + more + most
                        if min(ex - sx, ey - sy) >= least and 100 * n >= percent * max(ex - sx, ey - sy):
                            out.append((int(col["b"][r]), int(col["a"][r]), sx + fb, ex + fb, sy + fa, ey + fa, n))
                            break
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(7)], PASSAGE)

    return run


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row (tells the texts of one id apart), text as bytes; rows without id or text take no part."""
    text = F.col(text_col).cast("string")
    row = F.pmod(F.hash(text).cast("long"), F.lit(2**31))
    return docs.select(F.col(id_col).cast("long").alias("id"), row.alias("row"), text.cast("binary").alias("text")).where("id is not null and text is not null")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50, percent: int = 80) -> DataFrame:
    """Passages of `least` words or more that a document shares with one of a smaller id, small edits allowed.

    Returns rows b, a (ids, a < b), start_b, end_b, start_a, end_a (words from 0, ends exclusive, plus ROW times a
    number of the row where an id has several), n_match (words matched in order). Words are runs of non-blank characters, A-Z count as a-z. A
    document whose passages all are its own, a null, empty or short text, or one without id has no row. Rows of one id
    are one document. Other columns of docs are not read.

    Texts of any length are looked at whole; an empty table gives an empty result. Matches of two documents are gathered
    in one row, which is bounded by the seeds of a text.

    Seeds are K-word shingles, thinned to the least one of each window. Matches are stars, never all pairs, so a passage
    that many documents share costs as much as it is long:
    1. each occurrence of a shared seed meets the smallest id that holds it: the n-th one in a text the other text's
       n-th or, past the end, its last, and the last one all that the other text has beyond it;
    2. each two seeds one apart (a strobe) meet the smallest id that holds them so, since the smallest id of a common
       seed may hold nothing else of the passage;
    3. each run of `least` words that repeats exactly meets its first place in the smallest id that holds it, so no
       exact passage is lost, whatever holds its parts.
    The matches of 1 and 2 between two documents are chained, and a chain's words with a margin are aligned.
    """
    ship(docs.sparkSession)
    rows = numbered(docs, id_col, text_col)
    all_seeds = staged(rows.mapInArrow(seeds(least), "h long, id long, pos long, turn int, last boolean"), "seeds")
    ends = all_seeds.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h", "lo")
    shared = staged(all_seeds.join(ends, "h"), "shared_seeds")
    unstage(all_seeds)
    places = shared.where("id = lo").groupBy("h").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    both = shared.where("id <> lo").join(places, "h")
    same = F.explode(F.slice("at", F.least(F.col("turn") + 1, F.size("at")), F.when(F.col("last"), F.size("at")).otherwise(1)))
    single = both.select(F.col("id").alias("b"), F.col("lo").alias("a"), F.col("pos").alias("pb"), same.alias("pa"))

    seeded = shared.groupBy("id", F.floor(F.col("pos") / ROW).alias("row")).agg(F.collect_list(F.struct("pos", "h", "lo")).alias("s")).where("size(s) > 1")
    seeded = staged(seeded, "seeds_by_text")
    pairs = seeded.mapInArrow(strobes, "h long, id long, pos long, ahead long, lo long, lo2 long")
    origin = lambda rows, *more: rows.groupBy("h").agg(F.min(F.struct("id", "pos", *more)).alias("first"), F.max("id").alias("hi")).where("first.id < hi").select("h", F.col("first.id").alias("a"), F.col("first.pos").alias("pa"), *[F.col(f"first.{x}").alias(f"{x}_a") for x in more])
    paired = pairs.join(origin(pairs, "ahead"), "h").where("id <> a and (a <> lo or a <> lo2)")
    two = F.array(F.struct(F.col("pos").alias("pb"), "pa"), F.struct((F.col("pos") + F.col("ahead")).alias("pb"), (F.col("pa") + F.col("ahead_a")).alias("pa")))
    paired = paired.select(F.col("id").alias("b"), "a", F.inline(two))

    met = single.union(paired).groupBy("b", "a").agg(F.collect_list(F.struct("pb", "pa")).alias("m")).where("size(m) > 1")
    chained = met.mapInArrow(chain_pairs(), "b long, a long, lo_b long, hi_b long, lo_a long, hi_a long, at_b array<long>, at_a array<long>")
    found = staged(chained, "chains")
    unstage(shared)

    side = lambda s: found.select(F.col(s).alias("id"), F.col(f"lo_{s}").alias("lo"), F.col(f"hi_{s}").alias("hi"))
    spans = side("b").union(side("a")).distinct().withColumn("row", F.floor(F.col("lo") / ROW))
    spans = spans.groupBy("id", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    alike = seeded.mapInArrow(shared_stretches(least), "id long, row long, lo array<long>, hi array<long>")
    needed = spans.join(alike, ["id", "row"], "full")
    texts = staged(rows.join(needed, ["id", "row"]).select("id", "row", "text", "spans", "lo", "hi"), "texts")
    unstage(seeded)
    whole = texts.where("spans is not null").select("id", "row", "text", "spans")
    cut = staged(whole.mapInArrow(slices, "id long, lo long, hi long, first long, words binary").dropDuplicates(["id", "lo", "hi"]), "slices")
    all_runs = staged(texts.where("lo is not null").select("id", "row", "text", "lo", "hi").mapInArrow(runs(least), "h long, id long, pos long"), "runs")
    unstage(texts)

    passage = "b long, a long, start_b long, end_b long, start_a long, end_a long, n_match long"
    equal = all_runs.join(origin(all_runs), "h").where("id <> a").groupBy(F.col("id").alias("b"), "a", (F.col("pos") - F.col("pa")).alias("ahead")).agg(F.collect_list("pos").alias("at"))
    exact = staged(equal.mapInArrow(equal_stretches(least), passage), "exact")
    unstage(all_runs)
    both = found
    for s in "ba":
        part = cut.select(F.col("id").alias(s), F.col("lo").alias(f"lo_{s}"), F.col("hi").alias(f"hi_{s}"), F.col("first").alias(f"first_{s}"), F.col("words").alias(f"words_{s}"))
        both = both.join(part, [s, f"lo_{s}", f"hi_{s}"])
    aligned = staged(both.mapInArrow(align(least, percent), passage), "aligned")
    unstage(found)
    unstage(cut)
    pairs = aligned.union(exact).groupBy("b", "a").agg(F.collect_list(F.struct(*PASSAGE[2:])).alias("p"))
    return pairs.mapInArrow(outermost, passage)


def without(batches):
    """(text, spans) to the text less the words of the spans and the blanks after them."""
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if spans:
                marks = [m.span() for m in re.finditer("[^\x20\x09-\x0d]+", text)]
                gone = np.zeros(len(marks) + 1, bool)
                for s in spans:
                    gone[s["lo"] : s["hi"]] = True
                gone[-1] = False
                edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0))
                keep, at = [], 0
                for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    keep.append(text[at : marks[i][0]])
                    at = marks[j][0] if j < len(marks) else len(text)
                text = "".join(keep) + text[at:]
            out.append(text)
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in range(2, batch.num_columns)], pa.array(out, pa.string())], [*batch.schema.names[2:], "_text"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50, percent: int = 80) -> DataFrame:
    """docs with each repeated passage cut from every document but the one of the smallest id; columns as before.

    A column n_chars, if there is one, follows the text. A document left without words goes; one that had none (null,
    empty or blank text) stays, and so does one without id. Rows of one id are one document: of its repeated rows none
    cuts another. Texts of any length are cut; an empty table stays empty; other columns stay whatever their names are.
    """
    passages = staged(repeated_passages(docs, id_col, text_col, least, percent).select("b", "start_b", "end_b"), "passages")
    row = F.floor(F.col("start_b") / ROW)
    spans = passages.select(F.col("b").alias("_b"), row.alias("_row_no"), F.struct((F.col("start_b") - row * ROW).alias("lo"), (F.col("end_b") - row * ROW).alias("hi")).alias("s"))
    spans = staged(spans.groupBy("_b", "_row_no").agg(F.collect_set("s").alias("_spans")), "spans")
    text = F.col("_t").cast("string")
    keyed = wrapped(docs, _id=id_col, _t=text_col).select("_row", F.col("_id").cast("long").alias("_id"), text.alias("_t"), F.pmod(F.hash(text).cast("long"), F.lit(2**31)).alias("_r"))
    both = keyed.join(spans, (keyed["_id"] == spans["_b"]) & (keyed["_r"] == spans["_row_no"]), "left")
    inner = both.select("_t", "_spans", "_row", F.col("_spans").isNotNull().alias("_cut"))
    out = inner.mapInArrow(without, f"_row {docs_struct(docs)}, _cut boolean, _text string")
    out = out.where(~F.col("_cut") | F.col("_text").rlike("[^\\x20\\x09-\\x0D]"))
    new = {text_col: F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    pick = lambda c: F.when(F.col("_cut"), new[c]).otherwise(F.col(f"_row.`{c}`")).alias(c) if c in new else F.col(f"_row.`{c}`")
    return out.select(*[pick(c) for c in docs.columns])


def docs_struct(docs: DataFrame) -> str:
    return "struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in docs.schema.fields) + ">"


def passage_report(docs: DataFrame, **options) -> DataFrame:
    """One row per repeated passage: doc_id (the later document), other_doc_id, words from and to in both, n_match."""
    p = repeated_passages(docs, **options)
    place = lambda c: (F.col(c) - F.floor(F.col(c) / ROW) * ROW).alias
    return p.select(F.col("b").alias("doc_id"), F.col("a").alias("other_doc_id"), place("start_b")("start_word"), place("end_b")("end_word"), place("start_a")("other_start"), place("end_a")("other_end"), "n_match")
