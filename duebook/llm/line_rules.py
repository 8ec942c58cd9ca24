"""Quality rules over lines: text statistics, and lines that too many documents of a host share.

All of it is DataFrame expressions.  Per document the statistics come from its own array of
words; across documents only hashes of lines travel, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, WORD, numbered, staged, words

WINDOW = 5
MAX_DOCUMENTS = 25        # documents of one host that may share a line
MAX_REMOVED = 0.6         # share of a document's words that removed lines may take
MIN_WORDS = 10
MAX_REPEATED = 20         # percent of words in repeated windows
SYMBOLS = "[#*$%&|<>]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(ws: Column) -> Column:
    """Words covered by windows of five that occur twice or more in the text.

    Windows are compared by 64-bit hash within one text.  Texts without a repeated window,
    nearly all, are told by a set of the hashes; the others are sorted once.
    """
    count = F.size(ws) - (WINDOW - 1)
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
                         lambda i: F.xxhash64(*[F.get(ws, i + n) for n in range(WINDOW)]))

    def repeats(found: Column) -> Column:
        def twin(x: Column, n: Column) -> Column:
            def same(other):
                return F.coalesce(F.get(found, other)["h"] == x["h"], F.lit(False))
            return same(n - 1) | same(n + 1)
        return F.array_sort(F.transform(F.filter(found, twin), lambda x: x["i"]))

    def covered(hs: Column) -> Column:
        found = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # a window adds the words that the one before it has not covered yet
        return F.aggregate(
            _let(found, repeats), F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"])

    some = _let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), 0)
                .otherwise(covered(hs)))
    return F.when(count <= 1, 0).otherwise(some).cast("long")


def line_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.  Null counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    ws = F.col("__words")
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD))
    return (docs.withColumn("__words", words(whole))
            .withColumns({
                "n_words": F.size(ws).cast("long"),
                "word_chars": F.length(F.array_join(ws, "")).cast("long"),
                "n_symbols": F.length(F.regexp_replace(whole, f"(?s){SYMBOLS.replace('[', '[^')}+",
                                                       "")).cast("long"),
                "__lines": lines,
                "n_repeat_words": repeated_words(ws)})
            .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines")))
                        .cast("long"))
            .drop("__words", "__lines"))


def normalised(line: Column) -> Column:
    """Lower case, white space as one space, digits as 0."""
    plain = F.regexp_replace(F.lower(line), f"[{SPACES}]+", " ")
    return F.regexp_replace(F.trim(plain), "[0-9]+", "0")


def line_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
               max_documents: int = MAX_DOCUMENTS, max_removed: float = MAX_REMOVED,
               copies_count_once: bool = False) -> DataFrame:
    """Statistics, base verdict, the text without shared lines, its lost words, and the verdict.

    A normalised line that more than ``max_documents`` different documents of one host hold is
    removed from all documents of that host.  A document is rejected (``kept`` false) if it
    fails the base rules or if removed lines held more than ``max_removed`` of its words or
    left fewer than ten.  With ``copies_count_once`` equal texts count as one document, so that
    copies do not condemn each other.  ``clean_text`` stands in place of ``text``, whatever the
    verdict: the other lines as they are and in their order.

    Null and empty texts have no words and fail; a null host is a host of its own.  The key
    must be unique (rows of a repeated key are one document and share their removed words); rows
    with a null key are documents of their text, kept as rows, and lose no lines.  Columns of
    ``docs`` go through, whatever their names, unless an added one has their name.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "removed_words", "kept", "clean_text"]
    rows, names = numbered(docs)
    ident, body, place = F.col(names[key]), F.col(names[text]), F.col(names[host])
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD))
    hashed = rows.where(body.isNotNull()).select(
        ident.alias("key"), place.alias("host"), F.xxhash64(body).alias("same"),
        F.explode(F.transform(lines, lambda x: F.struct(
            F.xxhash64(normalised(x)).alias("h"),
            F.regexp_count(x, F.lit(WORD)).alias("n")))).alias("l"))
    document = F.col("same") if copies_count_once else F.when(
        F.col("key").isNull(), F.xxhash64(F.lit("text"), "same")).otherwise(F.xxhash64("key"))
    # the lines of all texts as numbers, computed once for the counts and for the removal
    hashed = staged(hashed.select("key", document.alias("document"),
                                  F.xxhash64("host", F.col("l.h")).alias("line"), F.col("l.n").alias("n")))
    # (line, document) pairs are made unique before they are counted: a hot line is then one
    # partial count per task
    shared = (hashed.select("line", "document").distinct().groupBy("line").count()
              .where(F.col("count") > max_documents).select(F.col("line").alias("shared")))
    shared = staged(shared)
    removed = (hashed.where("key is not null")
               .groupBy("key", "line").agg(F.sum("n").alias("n"))
               .join(shared, F.col("line") == F.col("shared"))
               .groupBy("key").agg(F.sum("n").alias("removed_words"),
                                   F.collect_list("line").alias("gone")))
    rows = line_statistics(rows, names[text]).join(removed, ident == F.col("key"), "left").drop("key")
    lost = F.coalesce(F.col("removed_words"), F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    depleted = (lost > F.col("n_words") * F.lit(max_removed)) | (F.col("n_words") - lost < MIN_WORDS)
    # the lines of a text are told by their hashes, so no text leaves its row
    left = F.filter(F.split(body, "\n", -1), lambda x: ~x.rlike(WORD) | ~F.array_contains(
        F.col("gone"), F.xxhash64(place, F.xxhash64(normalised(x)))))
    cleaned = F.when(F.col("gone").isNull(), body).otherwise(F.array_join(left, "\n"))
    rows = rows.withColumns({"removed_words": lost.cast("long"), "base_failed": failed,
                             "clean_text": cleaned, "kept": ~failed & ~depleted})
    through = [F.col(n).alias(c) for c, n in names.items() if c not in added and (c != text or c == key)]
    return rows.select(*through, *added)
