"""Language identification by fusing text likelihoods with markup, address and host evidence."""

from __future__ import annotations

import html
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fillforge.llm.common import ship, staged

SAMPLE = 4000  # labelled texts of each language at most that its likelihoods are fitted on, by the order of a hash of id and text
BINS = 1 << 14  # of hashed byte trigrams
WEIGHT = 100.0  # trigrams that a text's evidence counts for at most: they are far from independent
MARKUP_RIGHT, SUFFIX_RIGHT = 0.85, 0.7  # chances that a declared language, a country's suffix tell the truth
CHUNK = 1 << 20  # chances that a task holds at a time
SMOOTHING = 10.0  # documents that each level of the host hierarchy lends to the one below

#: Languages of country suffixes.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "se": "sv", "jp": "ja", "ru": "ru", "cn": "zh"}

UNSEEN = re.compile(r"(?is)<(script|style|nav|footer|header|aside|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<div\s+class=.?ad\b.*?</div>|<[^>]*>")


def visible(markup: str) -> str:
    return html.unescape(UNSEEN.sub(" ", markup))


def bins(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lowered text; each run of characters other than letters is one blank."""
    raw = (" " + re.sub(r"[\W\d_]+", " ", text.lower()) + " ").encode()
    x = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(x) < 4:
        return np.empty(0, np.int64)
    code = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def trigram_counts(batches):
    """(number of the language, text, markup) to counts per language and bin."""
    for batch in batches:
        total: dict[int, np.ndarray] = {}
        for no, text, markup in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
            total.setdefault(no, np.zeros(BINS, np.int64))
            np.add.at(total[no], bins(visible(text) if markup else text), 1)
        for no, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([no] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], ["no", "bin", "n"])


def markup_language() -> Column:
    return F.nullif(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1), F.lit(""))


def fit_text(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE, pages: DataFrame | None = None) -> tuple[list[str], np.ndarray]:
    """Languages and log likelihoods (bin, language), counted by grouped sums.

    The languages are all that a row of labelled or of pages (page_id, html) declares and, if there is any, those of
    SUFFIX_LANGUAGE. Each is fitted on at most `sample` of its texts, those with the least hashes of id and text; rows that
    repeat both count once. Pages lend theirs to languages that no row of labelled declares. A language without any text
    has NaN. What reaches the driver is a number per language and bin: 0.13 MB a language.
    """
    shape = lambda df, lang, text, key, markup: df.select(F.lower(lang).alias("lang"), F.col(text).cast("string").alias("text"), F.xxhash64(key, text).alias("key"), F.lit(markup).alias("markup")).where("lang is not null")
    count = lambda df: {r["lang"]: r["n"] for r in df.groupBy("lang").agg(F.count("text").alias("n")).collect()}
    spark = labelled.sparkSession
    rows = shape(labelled, F.col(lang_col), text_col, id_col, False)
    sizes = count(rows)
    if pages is not None:
        more = shape(pages, markup_language(), "html", "page_id", True).where(~F.col("lang").isin(list(sizes)))
        rows, sizes = rows.union(more), sizes | count(more)
    langs = sorted({*sizes, *(SUFFIX_LANGUAGE.values() if sizes else ())})
    table = np.full((BINS, len(langs)), np.nan)
    if not langs:
        return langs, table
    place = F.pmod("key", F.lit(1 << 32))
    shares = [(lang, langs.index(lang), min(1.0, (2 * sample + 100) / max(1, n))) for lang, n in sizes.items()]  # about twice the sample
    known = F.broadcast(spark.createDataFrame(shares, "lang string, no int, share double"))  # a row per language
    low = rows.where("text is not null").withColumn("place", place).join(known, "lang").where(F.col("place") / (1 << 32) < F.col("share"))
    order = Window.partitionBy("no").orderBy("place", "key")
    ranked = low.select("no", "place", "key").distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample)
    last = F.broadcast(ranked.groupBy("no").agg(F.max(F.struct("place", "key")).alias("last")))
    picked = low.join(last, "no").where(F.struct("place", "key") <= F.col("last")).dropDuplicates(["no", "key"])
    counted = picked.select("no", "text", "markup").mapInArrow(trigram_counts, "no int, bin int, n long").groupBy("no", "bin").agg(F.sum("n").alias("n")).toArrow()
    no, at, n = (counted.column(c).to_numpy() for c in ("no", "bin", "n"))
    table[:, np.unique(no)] = 0.5
    table[at, no] += n
    return langs, np.log(table / table.sum(axis=0))


def evidence(langs: list[str], table: np.ndarray, markup: bool):
    """(rest..., text) to (rest..., n_grams, said, first, e): the log chances (e) of each language by the text, the declared
    language and the suffix's, which of them is the largest by all (first) and by the text alone (said, null where it says
    nothing). A text counts for at most WEIGHT trigrams. Languages without a fit get the mean of the others. A declared
    language that is none of langs says nothing."""
    fitted = ~np.isnan(table).any(axis=0)
    known = np.where(fitted, table, 0.0)
    number = {x: i for i, x in enumerate(langs)}
    others = max(1, len(langs) - 1)

    def named(e: np.ndarray, lang: str | None, right: float) -> np.ndarray:
        i = number.get(lang)
        if i is None:
            return e
        e = e + math.log((1 - right) / others)
        e[i] += math.log(right) - math.log((1 - right) / others)
        return e

    def run(batches):
        step = max(1, CHUNK // len(langs))
        for batch in (b.slice(lo, step) for b in batches for lo in range(0, b.num_rows, step)):
            grams, said, first, out = [], [], [], []
            for text, declared, hint in zip(*[batch.column(c).to_pylist() for c in ("text", "declared", "hint")], strict=True):
                at, times = np.unique(bins(visible(text) if markup and text else text or ""), return_counts=True)
                n = int(times.sum())
                e = times @ known[at] * min(1.0, WEIGHT / max(1, n))
                e[~fitted] = e[fitted].mean() if fitted.any() else 0.0
                grams.append(n)
                said.append(int(e.argmax()) if n and fitted.any() else None)
                e = named(named(e, declared, MARKUP_RIGHT), hint, SUFFIX_RIGHT)
                first.append(int(e.argmax()))
                out.append(e)
            rest = [c for c in batch.schema.names if c not in ("text", "hint")]
            more = [pa.array(grams, pa.int64()), pa.array(said, pa.int32()), pa.array(first, pa.int32()), pa.array(out, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], *more], [*rest, "n_grams", "said", "first", "e"])

    return run


def host_counts(first: DataFrame) -> DataFrame:
    """Per host: how many texts name which language (first), of the host, its domain and its suffix, as arrays of (first,
    n): rows for what occurs, none for what does not."""
    sums = lambda df, by: df.groupBy(by, "first").agg(F.sum("n").alias("n")).groupBy(by).agg(F.collect_list(F.struct("first", "n")).alias(f"of_{by}")).withColumnRenamed(by, f"_{by}")
    labels = F.split("host", r"\.")
    counts = first.groupBy("host", "first").agg(F.count("*").alias("n"))
    counts = staged(counts.withColumns({"domain": F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), "."), "suffix": F.element_at(labels, -1)}), "hosts")
    out = counts.select("host", "domain", "suffix").distinct()
    for by in ("suffix", "domain", "host"):
        found = sums(counts, by)
        out = out.join(found, out[by].eqNullSafe(found[f"_{by}"]), "left")
    return out.select(F.col("host").alias("_host"), "of_suffix", "of_domain", "of_host")


def fuse(whole: np.ndarray):
    """(rest..., e, of_suffix, of_domain, of_host) to (rest..., best, confidence). The prior of a host is the share of the
    languages of its texts, smoothed by its domain's, that by its suffix's and that by all texts' (whole: their counts)."""
    start = (whole + 1.0) / (whole.sum() + len(whole))
    levels = ("of_suffix", "of_domain", "of_host")
    step = max(1, CHUNK // len(whole))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                yield fused(batch.slice(lo, step))

    def fused(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = batch.column("e").flatten().to_numpy().reshape(batch.num_rows, -1)
        prior = np.tile(start, (batch.num_rows, 1))
        for level in levels:
            column = batch.column(level)
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(column).to_numpy())
            first, n = (column.flatten().field(c).to_numpy() for c in ("first", "n"))
            prior *= SMOOTHING
            np.add.at(prior, (row, first), n)
            prior /= np.bincount(row, n, minlength=batch.num_rows)[:, None] + SMOOTHING
        p = e + np.log(prior)
        top = p.argmax(axis=1)
        sure = 1 / np.exp(p - p.max(axis=1, keepdims=True)).sum(axis=1)
        rest = [c for c in batch.schema.names if c not in ("e", *levels)]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(top, pa.int32()), pa.array(sure)], [*rest, "best", "confidence"])

    return run


def identify(rows: DataFrame, langs: list[str], table: np.ndarray, key: list[str], text_col: str, declared: Column, host: Column, markup: bool) -> DataFrame:
    """One row per row of rows: the key columns, lang, confidence, text_lang, declared, host, n_grams.

    lang is the language of the largest posterior among langs: text likelihood times the chances of the declared
    language and of the address suffix times the host's prior; text_lang is that of the text alone, null without
    trigrams. Null or empty texts are judged by the rest. Null hosts share one prior. Ties go to the language that comes
    first by name. Repeated rows are judged each; without any language (nothing to fit on) lang is null; an empty table
    gives an empty result. Columns that are not named are not read, so their names cannot clash. Texts are read whole,
    however long; as neighbouring trigrams depend on each other, the mean log likelihood of a text's trigrams counts
    WEIGHT times at most, else a few hundred words would drown any other evidence.

    Plans do not grow with the languages: their chances are arrays, made and added up in whole batches, and hosts count
    only those that their texts name. The table of likelihoods goes to the tasks, 0.13 MB a language.
    """
    ship(rows.sparkSession)
    suffix = F.lower(F.element_at(F.split(host, r"\."), -1))
    named = F.create_map(*[F.lit(x) for kv in SUFFIX_LANGUAGE.items() for x in kv])
    hint = F.when(F.lower(host).contains("."), F.try_element_at(named, suffix))
    thin = rows.select(*key, F.lower(declared).alias("declared"), F.lower(host).alias("host"), hint.alias("hint"), F.col(text_col).cast("string").alias("text"))
    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in thin.schema.fields[:-2])
    if not langs:
        none = F.lit(None).cast("string")
        return thin.select(*key, none.alias("lang"), F.lit(0.0).alias("confidence"), none.alias("text_lang"), "declared", "host", F.lit(0).cast("long").alias("n_grams"))
    scored = staged(thin.mapInArrow(evidence(langs, table, markup), f"{rest}, n_grams long, said int, first int, e array<double>"), "evidence")
    whole = np.zeros(len(langs))
    for r in scored.groupBy("first").agg(F.count("*").alias("n")).collect():  # a row per language at most
        whole[r["first"]] = r["n"]
    priors = staged(host_counts(scored), "host_counts")
    both = scored.join(priors, scored["host"].eqNullSafe(priors["_host"])).drop("_host", "first")
    out = both.mapInArrow(fuse(whole), f"{rest}, n_grams long, said int, best int, confidence double")
    name = lambda c: F.get(F.array(*map(F.lit, langs)), F.col(c))
    return out.select(*key, name("best").alias("lang"), "confidence", name("said").alias("text_lang"), "declared", "host", "n_grams")


def page_languages(pages: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """identify() for raw pages (page_id, url, html): the markup's lang attribute, the address's host and suffix."""
    host = F.nullif(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))
    return identify(pages, langs, table, ["page_id"], "html", markup_language(), host, True)


def document_languages(docs: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """identify() for documents (doc_id, text, source): source stands for the host, and nothing is declared. The column
    lang trains the likelihoods, so it is no evidence of its own here."""
    return identify(docs, langs, table, ["doc_id"], "text", F.lit(None).cast("string"), F.col("source"), False)
