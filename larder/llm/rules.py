"""Quality rules: counts on whole texts, and divergence from what is usual in a language.

Each text gives two histograms: shares of character classes, and of each common word among its common words.
A language's reference is the mean histogram of its documents that are long enough. A document is rejected
if the Jensen-Shannon distance (square root of the divergence in bits, 0 to 1) from its language's reference
is above a bound, and only if the text is long enough for its histogram to mean something. A text without
common words is at distance 1 from a language that has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.stages import stored

# Frequent words of the languages expected; any other text has its words in the last share.
COMMON_WORDS = (
    "the of and to in that is was for it with as on be at by this are or from an not he have "
    "der die und das von den zu mit sich des auf ist im dem nicht ein eine "
    "le la les de et un une du que qui dans est pour par sur pas "
    "el los las del en y por con para se su al una"
).split()
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
LEAST_WORDS, LEAST_DOCS = 50, 20
# A language with a smaller share of common words, in the mean, is not one of those listed.
LEAST_COMMON = 0.1
MOST_CHARACTERS, MOST_WORDS = 0.33, 0.68
CLASSES = ("lower", "upper", "digit", "blank", "symbol", "other_ascii", "beyond_ascii")


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _repeat_words(words: str, windows: str) -> Column:
    """Words inside windows that occur twice or more; ``windows`` are (hash, place) in order."""
    sorted_windows = F.col(windows)
    repeated = F.filter(
        sorted_windows,
        lambda w, j: (F.get(sorted_windows, j - 1)["k"] == w["k"]) | (F.get(sorted_windows, j + 1)["k"] == w["k"]),
    )
    covered = F.flatten(F.transform(repeated, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2)))
    return F.size(F.array_distinct(covered))


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(id, lang, counts, character shares, word shares) of every row; null texts count as empty."""
    df = docs.select(
        F.col(id_column).alias("id"), F.col(lang_column).alias("lang"), F.coalesce(F.col(text_column), F.lit("")).alias("t")
    )
    df = df.withColumn("w", F.array_remove(F.split("t", BLANK), ""))
    df = df.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""))
    df = df.withColumn("rest", F.regexp_replace("t", "[a-z]+", ""))
    df = df.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    df = df.select(
        "id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _length_without(F.col("rest"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length("t").alias("n"),
        (F.length("t") - F.length("rest")).alias("lower"),
        _length_without(F.col("rest"), "[^A-Z]+").alias("upper"),
        _length_without(F.col("rest"), "[^0-9]+").alias("digit"),
        _length_without(F.col("rest"), r"[\x00-\x7F]+").alias("beyond_ascii"),
        F.filter("w", lambda x: F.lower(x).isin(COMMON_WORDS)).alias("common"),
        F.when(
            F.size("h") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("h") - 3),
                lambda i: F.xxhash64(F.get("h", i), F.get("h", i + 1), F.get("h", i + 2)),
            ),
        ).alias("keys"),
    )
    # Places are needed only where some window repeats.
    repeats = F.size(F.array_distinct("keys")) < F.size("keys")
    df = df.withColumn(
        "windows", F.when(repeats, F.array_sort(F.transform("keys", lambda k, i: F.struct(k.alias("k"), i.alias("i")))))
    )
    df = df.withColumn("common", F.transform("common", lambda x: F.lower(x)))
    blank = F.col("n") - F.col("word_chars")
    other = F.col("n") - F.col("lower") - F.col("upper") - F.col("digit") - blank - F.col("n_symbols") - F.col("beyond_ascii")
    classes = F.array("lower", "upper", "digit", blank, "n_symbols", other, "beyond_ascii")
    found = F.transform(
        F.array(*[F.lit(w) for w in COMMON_WORDS]), lambda c: F.size("common") - F.size(F.array_remove("common", c))
    )
    share = lambda counts, total: F.transform(counts, lambda x: x / F.greatest(total, F.lit(1)))
    return df.select(
        "id",
        "lang",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(F.col("windows").isNull(), 0).otherwise(_repeat_words("w", "windows")).cast("long").alias("n_repeat_words"),
        F.size("common").alias("n_common"),
        share(classes, F.col("n")).alias("characters"),
        share(F.concat(found, F.array(F.col("n_words").cast("int") - F.size("common"))), F.col("n_words")).alias("words"),
    )


def references(rows: DataFrame) -> DataFrame:
    """(lang, characters, words): mean shares of a language's texts of ``LEAST_WORDS`` and more, if enough of them."""
    long = rows.filter(F.col("n_words") >= LEAST_WORDS)
    mean = lambda name, n: F.array(*[F.avg(F.col(name)[i]) for i in range(n)]).alias(f"usual_{name}")
    usual = long.groupBy(F.col("lang").alias("_lang")).agg(
        F.count("*").alias("_docs"), mean("characters", len(CLASSES)), mean("words", len(COMMON_WORDS) + 1)
    )
    return usual.filter(F.col("_docs") >= LEAST_DOCS).drop("_docs")


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def _among_common(words: str, common: Column) -> Column:
    """Shares among common words, of which ``common`` is the sum."""
    return F.transform(F.slice(words, 1, len(COMMON_WORDS)), lambda x: x / common)


def quality_rules(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Counts, distances and verdict of every row.

    ``base_failed``: under 50 words, or more than half of the words in repeated three-word windows.
    ``kept``: not ``base_failed``, and no distance above its bound. Distances need 50 words; a language with
    under 20 such texts has no reference, one with under a tenth of common words none for them, and the
    distances are null then. A null language is a language of its own. Null and empty texts have no words
    and fail. Repeated rows and ids are judged each; other columns are not looked at; an empty table
    gives an empty one.
    """
    rows = stored(measured(docs, id_column, text_column, lang_column))
    usual = stored(references(rows))
    joined = rows.join(usual, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    joined = joined.withColumn("usual_common", 1 - F.col("usual_words")[len(COMMON_WORDS)])
    long = F.col("n_words") >= LEAST_WORDS
    joined = joined.withColumns(
        {
            "character_distance": F.when(long, distance(F.col("characters"), F.col("usual_characters"))),
            "word_distance": F.when(
                long & (F.col("usual_common") >= LEAST_COMMON),
                F.when(F.col("n_common") == 0, 1.0).otherwise(
                    distance(_among_common("words", F.col("n_common") / F.col("n_words")), _among_common("usual_words", F.col("usual_common")))
                ),
            ),
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )
    near = (F.coalesce("character_distance", F.lit(0.0)) <= MOST_CHARACTERS) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MOST_WORDS
    )
    return joined.select(
        F.col("id").alias(id_column),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & near).alias("kept"),
        "character_distance",
        "word_distance",
    )
