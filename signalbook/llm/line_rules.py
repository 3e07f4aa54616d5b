"""Rules on words and lines: measures of one text, and lines that a host
repeats over many documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalbook.llm.store import with_value, words_of

WINDOW = 5
#: A line is boilerplate of its host in more than ``MIN_DOCS`` distinct texts,
#: however large the host.
MIN_DOCS = 20
#: A document is depleted if its boilerplate lines hold more than this share of its words.
MOST_REMOVED = 0.7
_HAS_WORD = r"[^\x20\x09-\x0D]"


def base_measures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``text_hash`` and the measures of every text.

    A word counts as repeated if a window of five words around it occurs
    elsewhere in the text.  The windows are hashed; only a text with equal
    hashes pays for sorting them.  No text means no words and zeros.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("text_hash"),
        words_of(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(_HAS_WORD))).alias("lines"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
    )
    hashed = split.select(
        "doc_id",
        "source",
        "text_hash",
        "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        with_value(F.col("words"), _window_hashes).alias("windows"),
    )
    return hashed.select(
        "doc_id",
        "source",
        "text_hash",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(with_value(F.col("windows"), _words_in_repeats), F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def _window_hashes(words: Column) -> Column:
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    return F.when(F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window))


def _words_in_repeats(windows: Column) -> Column:
    """Words covered by windows whose hash recurs; null if none does."""

    def covered(pairs: Column) -> Column:
        twice = F.filter(
            pairs, lambda p, k: (F.get(pairs, k - 1)["h"] == p["h"]) | (F.get(pairs, k + 1)["h"] == p["h"])
        )
        return F.aggregate(
            F.array_sort(F.transform(twice, lambda p: p["i"])),
            F.struct(F.lit(-WINDOW).alias("last"), F.expr("0L").alias("n")),
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), with_value(pairs, covered))


def _normal_lines(text: Column) -> Column:
    """Lower-cased lines, every number as 0, every run of blanks as one."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(t, "[0-9]+", "0")
    t = F.regexp_replace(t, r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(t, "\n"), lambda line: F.trim(line))


def line_frequency(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines of every distinct text of a host (``host``, ``text_hash``,
    ``at``, ``line_hash``, ``n_words``), and the lines above the limit
    (``host``, ``line_hash``, ``n_docs``).

    Exact copies of a text count as one document, so copies alone make no line
    common.  Null hosts are one host.
    """
    lines = docs.select(
        F.coalesce("source", F.lit("\x00")).alias("host"),
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(_normal_lines(F.col("text"))).alias("at", "line"),
    ).filter(F.col("line") != "")
    blanks = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit("")))
    lines = lines.select(
        "host", "text_hash", "at", F.xxhash64("line").alias("line_hash"), (blanks + 1).cast("bigint").alias("n_words")
    ).distinct()
    common = (
        lines.select("host", "line_hash", "text_hash")
        .distinct()
        .groupBy("host", "line_hash")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") > MIN_DOCS)
    )
    return lines, common


def removed_lines(docs: DataFrame) -> DataFrame:
    """Per host and distinct text with boilerplate: the words in it
    (``removed_words``) and its line numbers from 0 (``removed_at``)."""
    lines, common = line_frequency(docs)
    return (
        lines.join(common, ["host", "line_hash"])
        .groupBy("host", "text_hash")
        .agg(F.sum("n_words").alias("removed_words"), F.collect_list("at").alias("removed_at"))
    )


def verdicts(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: the measures, ``removed_words``, ``base_failed``
    and ``kept``.

    ``base_failed``: fewer than 10 words, or over a fifth of them repeated.
    A text that passes is rejected if over ``MOST_REMOVED`` of its words are in
    its host's boilerplate lines, or fewer than 10 words are left.  A null text
    has no words and fails; a null source is a host of its own; a null or
    repeated id is a row like others.  Equal texts of a host count as one
    document, so copies alone make no line common, and get the same verdict.
    An empty table gives an empty one.
    """
    base = base_measures(docs).withColumn("host", F.coalesce("source", F.lit("\x00")))
    removed = removed_lines(docs).select("host", "text_hash", "removed_words")
    words, cut = F.col("n_words"), F.coalesce("removed_words", F.lit(0))
    failed = (words < 10) | (100 * F.col("n_repeat_words") > 20 * words)
    return (
        base.join(removed, ["host", "text_hash"], "left")
        .withColumn("removed_words", cut)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (cut <= MOST_REMOVED * words) & (words - cut >= 10))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "removed_words", "base_failed", "kept",
        )
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """The kept documents, without their host's boilerplate lines; other
    columns as they were, ``n_chars`` counted anew where present.  Nulls,
    repeated rows and the empty table are as in :func:`verdicts`."""
    columns = docs.columns
    host = F.coalesce("source", F.lit("\x00")).alias("__rule_host")
    # Aggregated before the filter, which else would move into the measures.
    passed = (
        base_measures(docs)
        .groupBy(F.coalesce("source", F.lit("\x00")).alias("__rule_host"), F.col("text_hash").alias("__rule_hash"))
        .agg(F.max("n_words").alias("__rule_words"), F.max("n_repeat_words").alias("__rule_repeats"))
        .filter((F.col("__rule_words") >= 10) & (100 * F.col("__rule_repeats") <= 20 * F.col("__rule_words")))
    )
    removed = removed_lines(docs).select(
        F.col("host").alias("__rule_host"), F.col("text_hash").alias("__rule_hash"), "removed_words", "removed_at"
    )
    verdict = passed.join(removed, ["__rule_host", "__rule_hash"], "left")
    cut = F.coalesce("removed_words", F.lit(0))
    verdict = verdict.filter((cut <= MOST_REMOVED * F.col("__rule_words")) & (F.col("__rule_words") - cut >= 10))
    verdict = verdict.select("__rule_host", "__rule_hash", F.col("removed_at").alias("__rule_at"))
    rows = docs.select("*", host, F.xxhash64("text").alias("__rule_hash"))
    rows = rows.join(verdict, ["__rule_host", "__rule_hash"])
    at = F.col("__rule_at")

    def left(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), at)
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    kept_text = with_value(F.split("text", "\n"), left)
    rows = rows.withColumn("text", F.when(at.isNull(), F.col("text")).otherwise(kept_text))
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    return rows.select(*columns)
