"""Language identification by fusing evidence in Bayes' rule.

posterior(l) ~ P(text | l) * P(declared | l) * P(address suffix | l) * P(l | host)

* Text: hashed byte n-grams, fitted to a bounded sample of texts with a declared language.
* Declared language and address suffix: rates counted over all rows against the language
  their text is most like.
* Host: counts of that language per host, smoothed by those of its domain (last two labels),
  these by those of the whole table; a row's own count is taken out.

Counts are grouped aggregations over all rows; a table of hosts or domains is joined like
any other, never broadcast by hint.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import by_batch, list_array, lower_ascii, numbered, splitmix, staged, texts_of

LANGUAGES = ("de", "en", "es", "fr")
SAMPLE = 4_000           # texts with a declared language that the text model is fitted to
DIMENSIONS = 8_192       # hashed n-grams
SIZE = 3                 # bytes of an n-gram
EVIDENCE = 40.0          # n-grams' worth of evidence a text can give at most; they overlap
STRENGTH = 20.0          # rows that the parent of a host or domain counts for
UNSEEN = 0.25            # what an n-gram that was not seen in a language counts for
OTHER = 0.05             # prior of a text in none of the languages
THRESHOLD = 0.5          # posterior from which on a language is taken as found

_FLOATS = T.ArrayType(T.DoubleType())


def _grams(text: bytes) -> np.ndarray:
    """Bucket of each n-gram of letters; bytes of other signs are spaces, runs of them one."""
    data = np.frombuffer(text.lower(), np.uint8)
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    data = np.where(letter, data, 32).astype(np.uint64)
    if len(data):
        again = np.zeros(len(data), bool)
        again[1:] = (data[1:] == 32) & (data[:-1] == 32)
        data = data[~again]
    if not letter.any() or len(data) < SIZE:
        return np.empty(0, np.int64)
    code = np.zeros(len(data) - SIZE + 1, np.uint64)
    for n in range(SIZE):
        code = code * np.uint64(256) + data[n:len(code) + n]
    return (splitmix(code) % np.uint64(DIMENSIONS)).astype(np.int64)


def text_model(docs: DataFrame, text: str, declared: str, languages: tuple[str, ...],
               sample: int) -> np.ndarray | None:
    """Log rate of each n-gram bucket by language; None where no row declares one of them.

    Fitted to ``sample`` different texts, of each language the like number with the smallest hashes.
    """
    rows = (docs.where(F.col(declared).isin(*languages) & F.col(text).isNotNull())
            .select(F.col(declared).alias("l"), F.col(text).alias("text"))
            .withColumn("mark", F.xxhash64("l", "text")))
    picked = [rows.where(F.col("l") == l).select("mark").distinct().orderBy("mark")
              .limit(-(-sample // len(languages))) for l in languages]
    chosen = staged(reduce(DataFrame.unionByName, picked), 1)
    # about ``sample`` marks; of copies any one, as they are equal
    some = rows.join(F.broadcast(chosen), "mark").groupBy("mark").agg(
        F.min("l").alias("l"), F.min("text").alias("text"))

    def count(column: pa.Array) -> list[pa.Array]:
        return [list_array([np.unique(_grams(t)) for t in texts_of(column)], pa.int32())]
    grams = by_batch(some, ["text"], [T.StructField("grams", T.ArrayType(T.IntegerType()))], count, ["l"])
    table = (grams.select("l", F.explode("grams").alias("g"))
             .groupBy("l", "g").count().toArrow())     # languages x DIMENSIONS rows at most
    if not table.num_rows:
        return None
    counts = np.full((DIMENSIONS, len(languages)), UNSEEN)
    at = [languages.index(x) for x in table["l"].to_pylist()]
    np.add.at(counts, (np.asarray(table["g"]), at), np.asarray(table["count"]))
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", declared: str = "lang",
             host: str | None = "source", suffix: str | None = None,
             languages: tuple[str, ...] = LANGUAGES, keep: list[str] | None = None,
             sample: int = SAMPLE) -> DataFrame:
    """``key`` (or ``keep``), __lang, __posterior, __text_lang and __kept, a row per row.

    ``declared``, ``host`` and ``suffix`` are columns; None leaves that evidence out, a null
    or unknown value gives none for its row.  ``__kept`` needs letters in the text and a
    posterior of at least one half.  Null, empty and letterless texts get the language that
    the other evidence favours, and are not kept.  So do texts of another language and noise:
    the background, in which all n-grams are equally likely, is a class of its own, and where it
    is likelier than every language the text has none.  Where no row declares a known language
    nothing is learned and no text has one.  Ties take the language first in ``languages``.
    Repeated rows count each; an empty table gives no rows.  Other columns are not read.
    """
    names = [f"p{n}" for n in range(len(languages))]
    model = text_model(docs, text, declared, languages, sample)

    def score(column: pa.Array) -> list[pa.Array]:
        rows, best = [], []
        for t in texts_of(column):
            grams = _grams(t or b"")
            total, known = np.zeros(len(languages) + 1), False       # the background last
            if len(grams) and model is not None:
                counts = np.bincount(grams, minlength=DIMENSIONS)
                total[:-1] = counts @ model / len(grams)
                total[-1] = -np.log(DIMENSIONS)
                known = total[:-1].max() >= total[-1]
                total = (total - total.max()) * min(len(grams), EVIDENCE)
            rows.append(total)
            best.append(int(total[:-1].argmax()) if known else None)
        return [list_array(rows, pa.float64()), pa.array(best, pa.int32())]

    out = keep if keep is not None else [key]
    # no column that is not read can clash with those added here
    docs = docs.select(*dict.fromkeys([*out, text, declared, *[c for c in (host, suffix) if c]]))
    place = lower_ascii(F.col(host)) if host else F.lit(None).cast("string")
    labels = docs.withColumns({
        "__declared": F.when(F.lower(declared).isin(*languages), F.lower(declared)),
        "__host": place,
        "__domain": F.when(place.isNotNull(), F.substring_index(place, ".", -2)),
        "__suffix": F.lower(F.col(suffix)) if suffix else F.lit(None).cast("string")})
    evidence = ["__declared", "__host", "__domain", "__suffix"]
    scored = by_batch(labels, [text], [T.StructField("__like", _FLOATS),
                                       T.StructField("__best", T.IntegerType())],
                      score, [*out, *evidence])
    narrow = staged(by_batch(labels, [text], [T.StructField("__like", _FLOATS),
                                              T.StructField("__best", T.IntegerType())],
                             score, evidence)) if keep is not None else None
    if narrow is None:
        scored = narrow = staged(scored)

    def counted(by: str, within: DataFrame) -> DataFrame:
        return within.where(f"{by} is not null and __best is not null").groupBy(by).agg(
            F.array(*[F.count_if(F.col("__best") == n).cast("double")
                      for n in range(len(languages))]).alias(f"{by}_n"))

    row = narrow.agg(*[F.count_if(F.col("__best") == n).alias(p) for n, p in enumerate(names)]).first()
    whole = np.array([row[p] for p in names], float) + 1
    whole /= whole.sum()
    agree = np.ones((len(languages), len(languages)))
    for r in counted("__declared", narrow).collect():        # a row per language at most
        agree[languages.index(r[0])] += r[1]
    agree /= agree.sum(axis=0)

    def own(n: int) -> Column:
        return F.coalesce((F.col("__best") == n).cast("double"), F.lit(0.0))

    total = [F.col("__like")[n] for n in range(len(languages))]
    for n, l in enumerate(languages):
        chance = F.lit(0.0)
        for d, other in enumerate(languages):
            chance = F.when(F.col("__declared") == other, float(np.log(agree[d, n]))).otherwise(chance)
        total[n] = total[n] + chance
    prior = [F.lit(float(x)) for x in whole]
    for by in ("__domain", "__host") if host else ():
        table = staged(counted(by, narrow)).withColumnRenamed(by, f"{by}_key")
        scored = scored.join(table, F.col(by) == F.col(f"{by}_key"), "left")
        number = [F.greatest(F.lit(0.0), F.coalesce(F.col(f"{by}_n")[n], F.lit(0.0)) - own(n))
                  for n in range(len(languages))]
        size = number[0]
        for x in number[1:]:
            size = size + x
        # columns of their own, so that each level is computed once
        level = [f"{by}_p{n}" for n in range(len(languages))]
        scored = scored.withColumn("__size", size).withColumns({
            c: (x + STRENGTH * p) / (F.col("__size") + STRENGTH)
            for c, x, p in zip(level, number, prior)}).drop(f"{by}_n", f"{by}_key")
        prior = [F.col(c) for c in level]
    total = [t + F.log(p) for t, p in zip(total, prior)]
    if suffix:
        table = staged(counted("__suffix", narrow)).withColumnRenamed("__suffix", "__suffix_key")
        scored = scored.join(table, F.col("__suffix") == F.col("__suffix_key"), "left")
        for n, share in enumerate(whole):
            # P(suffix | l) up to a factor that is the same for all languages
            here = F.greatest(F.lit(0.0), F.coalesce(F.col("__suffix_n")[n], F.lit(0.0)) - own(n))
            every = F.aggregate(F.coalesce("__suffix_n", F.array(F.lit(0.0))), F.lit(0.0),
                                lambda a, x: a + x)
            rate = (here + STRENGTH * float(share)) / (every + STRENGTH) / float(share)
            total[n] = total[n] + F.least(F.lit(2.0), F.greatest(F.lit(-2.0), F.log(rate)))
    scored = scored.withColumns(dict(zip(names, [t.alias(p) for t, p in zip(total, names)])))
    top = F.greatest(*names)
    mass = F.exp(F.col("__like")[len(languages)] + float(np.log(OTHER)) - top)
    for p in names:
        mass = mass + F.exp(F.col(p) - top)
    found = F.coalesce(*[F.when(F.col(p) == top, l) for p, l in zip(names, languages)])
    text_lang = F.coalesce(*[F.when(F.col("__best") == n, l) for n, l in enumerate(languages)])
    posterior = F.lit(1.0) / mass
    return scored.select(
        *[F.col(f"`{c}`") for c in out], found.alias("__lang"), posterior.alias("__posterior"),
        text_lang.alias("__text_lang"), F.col("__declared"),
        (F.col("__best").isNotNull() & (posterior >= THRESHOLD)).alias("__kept"))


def language_scores(docs: DataFrame, **options) -> DataFrame:
    """``identify`` with columns lang_found, posterior, text_lang, declared and kept."""
    return identify(docs, **options).withColumnsRenamed({
        "__lang": "lang_found", "__posterior": "posterior", "__text_lang": "text_lang",
        "__declared": "declared", "__kept": "kept"})


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    declared: str = "lang", host: str = "source") -> DataFrame:
    """The rows whose language is found; the found language replaces the declared one."""
    plain, names = numbered(docs)
    found = identify(plain, names[key], names[text], names[declared], names[host],
                     keep=plain.columns).where("__kept")
    return found.select(*[F.col("__lang" if c == declared else names[c]).alias(c)
                          for c in docs.columns])
