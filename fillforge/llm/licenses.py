"""Licence scans by a positional index of rare licence words."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillforge.llm.common import ship

#: The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, words of the notice, key phrases that must stand at their place in it.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted", "without restriction")),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "2 0")),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license", "in compliance with the license")),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license", "free software foundation")),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc", "4 0")),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa", "4 0")),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use", "following conditions")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license", "2 0")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
)
SHARE = 0.75  # of a template's words that must stand at their relative positions

#: Bytes that are no part of a word once A-Z are lowered become blanks.
BLANKED = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").lower().translate(BLANKED).split()


class Index:
    """Postings of the templates' words, and the templates' key phrases by position.

    A text is looked up by its own licence words: `asked` holds the places of a template that a match cannot do without,
    its key phrases or, without any, so many of its rarest words that two of them stand in place in every match.
    """

    def __init__(self, templates=TEMPLATES, idf: dict[bytes, float] | None = None):
        self.labels = [t[0] for t in templates]
        self.words = [t[1].encode().split() for t in templates]
        self.idf = idf or {}
        self.vocabulary = frozenset(w for ws in self.words for w in ws)
        self.keys = []
        for (_, _, keys), ws in zip(templates, self.words, strict=True):
            phrases = [k.encode().split() for k in keys]
            self.keys.append([(p, k) for k in phrases for p in range(len(ws)) if ws[p : p + len(k)] == k])
        self.asked: list[list[int]] = []
        self.needs: list[frozenset[bytes]] = []  # words without which a text holds no match
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, ws in enumerate(self.words):
            keyed = sorted({p + j for p, k in self.keys[t] for j in range(len(k))})
            rare = sorted(range(len(ws)), key=lambda p, ws=ws: (*self.rarity(ws[p]), p))
            self.asked.append(keyed or rare[: len(ws) - math.ceil(SHARE * len(ws)) + 2])
            self.needs.append(frozenset(ws[p] for p in keyed))
            for p in self.asked[t]:
                self.postings[ws[p]].append((t, p))

    def rarity(self, word: bytes) -> tuple[float, bytes]:
        return -self.idf.get(word, 0.0), word

    def starts(self, words: list[bytes]) -> dict[int, list[int]]:
        """Where templates may begin in a text. Its licence words are taken by falling IDF until each template that it can
        hold has two places among them (all that it has, where a template asks for fewer, or has no key phrase), and the
        words' places, each less its place in the template, are intersected."""
        present = self.vocabulary.intersection(words)
        able = {t: [] for t, need in enumerate(self.needs) if need <= present}
        if not able:
            return {}
        want = {t: min(2, len(self.asked[t])) if self.needs[t] else len(self.asked[t]) for t in able}
        still = set(able)
        for w in sorted(present & self.postings.keys(), key=self.rarity):
            for t, p in self.postings[w]:
                if t in still:
                    able[t].append((w, p))
                    if len(able[t]) == want[t]:
                        still.remove(t)
            if not still:
                break
        taken = {w for hits in able.values() for w, _ in hits}
        where: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            if w in taken:
                where[w].append(i)
        out = {}
        for t, hits in able.items():
            least = min(2, len(self.asked[t]))  # keyed templates: all of the places taken; others: two of them
            agree = Counter(i - p for w, p in hits for i in where[w])
            found = sorted(s for s, n in agree.items() if n >= least)
            if found:
                out[t] = found
        return out


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Starts, as word numbers, of a phrase in words joined by single blanks with one before and after."""
    out, at, seen, word = [], joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", seen, at)
        seen = at
        out.append(word)
        at = joined.find(phrase, at + 1)
    return out


def document_words(batches):
    """Texts to the number of documents, per batch, that hold each licence word; the empty word counts all documents."""
    vocabulary = Index().vocabulary
    for batch in batches:
        counts: dict[bytes, int] = defaultdict(int)
        for raw in batch.column(0):
            counts[b""] += 1
            for w in vocabulary.intersection(words_of(raw.as_py())):
                counts[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts]), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def scan(idf: dict[bytes, float], templates):
    index = Index(templates, idf)
    phrases = [(b" " + p.encode() + b" ", label) for p, label in PHRASES.items()]

    def found(words: list[bytes]) -> dict[str, float]:
        """Labels of the templates that stand in the words, with the share of their words in place."""
        out: dict[str, float] = {}
        for t, starts in index.starts(words).items():
            ws = index.words[t]
            for start in starts:
                if start < 0 or start + len(ws) > len(words) + len(ws) // 4:
                    continue
                if all(words[start + p : start + p + len(k)] == k for p, k in index.keys[t]):
                    share = sum(x == y for x, y in zip(ws, words[start : start + len(ws)], strict=False)) / len(ws)
                    if share >= SHARE:
                        out[index.labels[t]] = max(share, out.get(index.labels[t], 0.0))
        return out

    def run(batches):
        for batch in batches:
            rows = []
            for raw in batch.column(1):
                words = words_of(raw.as_py())
                joined = b" " + b" ".join(words) + b" "
                base = [(i, len(p.split()), label) for p, label in phrases for i in places(joined, p)]
                own = sorted({label for _, _, label in base})
                more = found(words) if len(words) > 1 else {}
                score = max(more.values(), default=1.0 if base else 0.0)
                starts = [i for i, _, _ in base]
                rows.append((len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(own), ",".join(sorted({*own, *more})), score))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]], ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of digits, letters a-z (A-Z lowered) and characters beyond ASCII. n_base counts all places where the
    words of a phrase of PHRASES stand consecutively, overlaps included; first_word and last_word are their smallest and
    largest start, null without any. labels adds those of the templates found. score is the largest share of a found
    template's words that stand in place, else 1 with and 0 without a base place. Null and empty texts have no words;
    very long ones are scanned whole. Rows that repeat an id are scanned each; an empty table gives an empty result.
    Other columns of docs are not read, so their names cannot clash.

    Document frequencies of the licence words are summed over the whole corpus; only the words of the templates, a few
    hundred, reach the driver. Then each text is scanned where it lies: its own licence words of the highest IDF are looked
    up, the places that they name are intersected by relative position, and where they agree on a start the template's key
    phrases and words are verified. No match is lost by that (see Index.starts).
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    counted = texts.select("text").mapInArrow(document_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = {r["word"].encode(): r["n"] for r in counted.collect()}
    idf = {w: math.log((1 + n.get(b"", 0)) / (1 + x)) for w, x in n.items() if w}
    kind = docs.schema[id_col].dataType.simpleString()
    out = texts.mapInArrow(scan(idf, templates), f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
    return out.withColumnRenamed("id", id_col)
