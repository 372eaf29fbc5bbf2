"""Quality rules in DataFrame functions only: base counts and distribution divergence.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text. Beside the base rules, each document's histogram of
character classes and of common words is compared with its language's reference by Jensen-Shannon
distance (base 2). The reference of a language is the sum of the histograms of all its documents
that pass the base rules and have at least ``MIN_WORDS`` words; documents below that length, or
whose language has no reference, are not judged by divergence.

The words are compared among the common ones only: the many others would hold any distance down.
A document with few common words strays from the reference by chance alone, so the greatest
distance falls with the square root of their number. Documents with far fewer common words than
the reference's share of their length are rejected for that.

A null text has no words; a null language is a language of its own; repeated rows are judged (and
counted in the reference) each; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm.common import load, materialize

WINDOW = 8
MIN_WORDS = 50
MAX_CHAR_DISTANCE = 0.3
#: Greatest word distance: a fixed part, and a part over the root of the number of common words.
MAX_WORD_DISTANCE, WORD_NOISE = 0.45, 1.0
#: Documents with fewer common words are not judged by their distance.
MIN_COMMON = 5
#: Least part of the expected common words, and how many more may be missing by chance.
LEAST_COMMON, SPARE_COMMON = 0.25, 2
#: Languages up to which the references are broadcast.
BROADCAST_LANGUAGES = 1000
WHITE = r"[\x20\x09-\x0D]"
# Frequent words of English, German, French and Spanish.
COMMON = (
    "the", "of", "and", "to", "in", "that", "is", "with",
    "der", "die", "und", "das", "den", "ein", "ist", "zu",
    "de", "la", "le", "les", "et", "des", "en", "un",
    "que", "el", "y", "los", "se", "por", "con", "para",
)
#: Character classes by pattern; the rest (small letters, white space) is a class of its own.
CHAR_CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "mark": "[.,;:!?'\"()-]", "symbol": r"[#*$%&|<>]", "wide": r"[^\x00-\x7F]"}
CHARS = [*CHAR_CLASSES, "other"]


def statistics(docs: DataFrame) -> DataFrame:
    """Base counts and histograms, one row per document, in one pass over the texts."""
    kept = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang") if "lang" in docs.columns else F.lit("").alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    a = kept.select(
        "doc_id", "lang", F.length("text").alias("n_text"),
        *[F.regexp_count("text", F.lit(p)).cast("long").alias(f"c_{k}") for k, p in CHAR_CLASSES.items()],
        F.array_remove(F.split("text", f"{WHITE}+"), "").alias("words"),
        F.filter(F.split("text", "\n"), has_word).alias("lines"),
    )
    n = F.size("words")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    b = a.select(
        "doc_id", "lang", n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("c_symbol").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        *[F.col(f"c_{k}") for k in CHAR_CLASSES], F.col("n_text").cast("long").alias("n_text"),
        windows.alias("windows"), F.filter("words", lambda w: w.isin(*COMMON)).alias("hits"),
    )
    c = b.withColumn("pairs", F.when(F.size("windows") > F.size(F.array_distinct("windows")), F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    same = lambda e, j: F.coalesce(F.get("pairs", j)["x"] == e["x"], F.lit(False))
    found = F.array_sort(F.transform(F.filter("pairs", lambda e, j: same(e, j - 1) | same(e, j + 1)), lambda e: e["i"]))
    start = F.struct(F.lit(0).alias("covered"), F.lit(-WINDOW).alias("last"))
    step = lambda s, i: F.struct((s["covered"] + F.least(F.lit(WINDOW), i - s["last"])).alias("covered"), i.alias("last"))
    repeat = F.when(F.col("pairs").isNull(), 0).otherwise(F.aggregate(found, start, step, lambda s: s["covered"]))
    h = F.size("hits")
    return c.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeat.cast("long").alias("n_repeat_words"),
        *[F.col(f"c_{k}") for k in CHAR_CLASSES], (F.col("n_text") - sum((F.col(f"c_{k}") for k in CHAR_CLASSES), F.lit(0))).alias("c_other"),
        *[(h - F.size(F.array_remove("hits", w))).cast("long").alias(f"w_{w}") for w in COMMON], (F.col("n_words") - h).alias("w_other"),
    )


def _shares(columns: list[str]) -> Column:
    total = sum((F.col(c) for c in columns), F.lit(0)).cast("double")
    return F.array(*[F.when(total > 0, F.col(c) / total).otherwise(F.lit(0.0)) for c in columns])


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) / 2 + part(y, (x + y) / 2) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, both distances, and the verdicts."""
    chars, words = [f"c_{k}" for k in CHARS], [f"w_{w}" for w in COMMON]
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    stats = materialize(statistics(docs).withColumn("base_failed", base_failed), "rules")
    good = stats.where(~F.col("base_failed") & (F.col("n_words") >= MIN_WORDS))
    hits = F.col("n_words") - F.col("w_other")
    refs = materialize(good.groupBy("lang").agg(*[F.sum(c).alias(c) for c in chars + words], (F.sum(hits) / F.sum("n_words")).alias("ref_common"))
                       .select("lang", "ref_common", _shares(chars).alias("ref_chars"), _shares(words).alias("ref_words")), "rules-ref")
    if refs.count() <= BROADCAST_LANGUAGES:
        refs = F.broadcast(refs)
    joined = stats.join(refs, "lang", "left").withColumns({
        "char_distance": js_distance(_shares(chars), F.col("ref_chars")), "word_distance": js_distance(_shares(words), F.col("ref_words")),
    })
    long_enough = (F.col("n_words") >= MIN_WORDS) & F.col("char_distance").isNotNull()
    few = hits + SPARE_COMMON < LEAST_COMMON * F.col("ref_common") * F.col("n_words")
    # A reference without common words says nothing of them.
    other = (hits >= MIN_COMMON) & (F.col("ref_common") > 0) & (F.col("word_distance") > MAX_WORD_DISTANCE + WORD_NOISE / F.sqrt(hits))
    diverges = long_enough & ((F.col("char_distance") > MAX_CHAR_DISTANCE) | few | other)
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~diverges).alias("kept"), "char_distance", "word_distance")


def rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(load(spark, sf_dir, "documents"))
