"""Quality rules with host-level verdicts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillforge.llm.common import staged, unwrapped, wrapped

BLANKS = "[\\x20\\x09-\\x0D]+"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: A host is bad from this shrunken share of failing documents on.
BAD_HOST = 0.6


def let(value: Column, body) -> Column:
    """body(value) with value computed once, whatever the optimizer does with the projection around it."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words that stand in a 3-word window which the array holds twice or more, the first one included."""

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def marked(h: Column) -> Column:
        return let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), twins)

    def twins(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        found = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return let(F.array_sort(F.transform(found, lambda x: x["i"])), covered)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def checked(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(marked(h))

    return let(words, lambda w: F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(let(windows(w), checked)))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the struct column _m of MEASURES and n_lines. A null text counts as an empty one."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def of(t: Column) -> Column:
        words = F.filter(F.split(t, BLANKS), lambda x: x != "")
        lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
        both = F.struct(words.alias("w"), lines.alias("l"))
        return let(
            both,
            lambda b: F.struct(
                F.size(b["w"]).cast("long").alias("n_words"),
                F.length(F.array_join(b["w"], "")).cast("long").alias("word_chars"),
                F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                F.size(b["l"]).cast("long").alias("n_lines"),
                (F.size(b["l"]) - F.size(F.array_distinct(b["l"]))).cast("long").alias("n_dup_lines"),
                repeat_words(b["w"]).alias("n_repeat_words"),
            ),
        )

    return docs.withColumn("_m", let(text, of))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def soft_failures(m: Column) -> Column:
    """How many of the softer rules a document breaks: symbols per word, mean word length, repeated lines."""
    broken = (
        10 * m["n_symbols"] > m["n_words"],
        (m["word_chars"] < 3 * m["n_words"]) | (m["word_chars"] > 10 * m["n_words"]),
        100 * m["n_dup_lines"] > 30 * m["n_lines"],
    )
    return sum((b.cast("int") for b in broken[1:]), broken[0].cast("int"))


def with_flags(rows: DataFrame, *columns) -> DataFrame:
    """The columns, with _base (fails a hard rule) and _soft (softer rules broken) of the measures _m."""
    return rows.select(*columns, base_failed(F.col("_m")).alias("_base"), soft_failures(F.col("_m")).alias("_soft"))


def bad_hosts(rows: DataFrame) -> DataFrame:
    """Hosts (column _host) of rows (_h, _base, _soft) whose share of failing documents, shrunken by an empirical beta
    prior, reaches BAD_HOST.

    The prior's mean and strength come from the moments of the hosts' shares, so a host with few documents stays near
    the corpus while a large one speaks for itself. Only two sums over hosts reach the driver.
    """
    failed = (F.col("_base") | (F.col("_soft") > 0)).cast("long")
    hosts = staged(rows.groupBy(F.col("_h").alias("_host")).agg(F.count("*").alias("n"), F.sum(failed).alias("f")), "hosts")
    stat = hosts.agg(F.avg(F.col("f") / F.col("n")).alias("m"), F.var_pop(F.col("f") / F.col("n")).alias("v")).first()
    m, v = stat["m"] or 0.0, stat["v"] or 0.0
    strength = min(max(m * (1 - m) / v - 1, 1.0), 1e4) if v > 0 else 1e4
    shrunk = (F.col("f") + m * strength) / (F.col("n") + strength)
    return staged(hosts.where(shrunk >= BAD_HOST).select("_host", F.lit(True).alias("_bad")), "bad_hosts")


def judged(rows: DataFrame) -> DataFrame:
    """Staged rows with _kept. The bad hosts are joined by their own size: Spark broadcasts them only below its threshold."""
    bad = bad_hosts(rows.select("_h", "_base", "_soft"))
    broken = (F.col("_soft") >= 2) | ((F.col("_soft") >= 1) & F.coalesce(F.col("_bad"), F.lit(False)))
    return rows.join(bad, rows["_h"].eqNullSafe(bad["_host"]), "left").withColumn("_kept", ~F.col("_base") & ~broken)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per row of docs: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines.

    Words are runs of non-blank characters; null and empty texts have none and fail. base_failed: under 50 words, or
    over half the words stand in a 3-word window that repeats. Else a document goes if it breaks two soft rules, or one
    and its host is bad; a clean document of a bad host stays. Null hosts form one host. Repeated rows are judged
    each, very long texts whole; an empty table gives an empty result. Columns of docs that are not named are not read.
    """
    thin = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_h"), F.col(text_col).alias("_t"))
    out = judged(staged(with_flags(measured(thin, "_t"), "_id", "_h", "_m"), "measures"))
    return out.select(F.col("_id").alias(id_col), *[f"_m.{x}" for x in MEASURES], F.col("_base").alias("base_failed"), F.col("_kept").alias("kept"), "_m.n_lines")


def quality_filter(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of docs that quality_report keeps, with the columns of docs.

    Each text is measured once: the rows are written with their flags (those that no host's verdict can save without
    their columns), and the verdicts of the hosts then filter what was written. Nulls, empty and very long texts,
    repeated rows and empty tables go as in quality_report.
    """
    rows = with_flags(measured(wrapped(docs, _h=host_col, _t=text_col), "_t"), "_row", "_h")
    rows = rows.select("_h", "_base", "_soft", F.when(~F.col("_base") & (F.col("_soft") < 2), F.col("_row")).alias("_row"))
    return unwrapped(judged(staged(rows, "flagged")).where("_kept"))
