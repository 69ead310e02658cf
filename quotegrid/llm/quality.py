"""Quality rules whose thresholds follow the corpus, native DataFrame expressions throughout.

Each document is measured once. Every measure is a whole number (per mille), which goes into a
quantile sketch per language and source: a histogram whose buckets keep the leading
``SKETCH_BITS`` bits of a value, so a quantile is off by less than 1 in 2**(SKETCH_BITS-1), the
number of buckets is bounded, and sketches of parts merge exactly by adding counts.

A group's upper fence stands ``REACH`` tail widths above its upper decile; the tail width is the
distance from median to decile, a small ``least`` of the measure at least, as deciles of
measures that are mostly zero coincide. Measures with outliers at both ends have a lower fence
likewise. The fences of a language and source are averaged with those of the language, as if
the latter had ``prior`` documents, and a language's with those of the corpus: a group counts
for the more the larger it is, and no size switches anything.

Null or empty text: no words, so ``base_failed``. Null language or source: a group of its own.
Empty tables give no rows. Ties do not matter, as fences are inclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotegrid.llm.common import BLANKS, settle, text_of, words_of

#: Fixed by the contract of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SKETCH_BITS = 7
REACH = 5
PRIOR = 20
#: name -> (per mille expression, least tail width, whether low values are outliers too)
MEASURES = {
    "word_length": ("1000 * word_chars div greatest(n_words, 1)", 100, True),
    "symbols": ("1000 * n_symbols div greatest(n_words, 1)", 40, False),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", 48, False),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", 40, False),
}


def _repeat_words(numbered: Column) -> Column:
    """How many words lie in a window of three words that occurs at least twice.

    ``numbered`` holds window hashes with their positions, sorted, or nothing where no hash
    repeats.
    """

    def repeated(x: Column, i: Column) -> Column:
        before = F.get(numbered, i - 1)["g"] == x["g"]
        after = F.get(numbered, i + 1)["g"] == x["g"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    starts = F.transform(F.filter(numbered, repeated), lambda x: x["i"])
    covered = F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))
    return F.size(F.array_distinct(covered)).cast("bigint")


def measure(docs: DataFrame) -> DataFrame:
    """Base counts of each document, in one narrow pass over the texts."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS + " ", "") != "")
    word_hashes = F.transform(F.col("words"), lambda w: F.xxhash64(w))
    gram = lambda i: F.xxhash64(
        *(F.get(F.col("word_hashes"), i + k) for k in range(3))
    )
    grams = F.when(
        F.col("n") >= 3, F.transform(F.sequence(F.lit(0), F.col("n") - 3), gram)
    ).otherwise(F.array().cast("array<bigint>"))
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    numbered = F.when(
        repeats,
        F.sort_array(F.transform(F.col("grams"), lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<g:bigint,i:int>>"))
    return (
        docs.select("doc_id", "lang", "source", text_of().alias("text"))
        .select(
            "doc_id",
            "lang",
            "source",
            words_of(text).alias("words"),
            lines.alias("lines"),
            F.length(F.translate(text, BLANKS + " ", "")).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias(
                "n_symbols"
            ),
        )
        .withColumns({"n": F.size("words"), "word_hashes": word_hashes})
        .withColumn("grams", grams)
        .withColumn("numbered", numbered)
        .select(
            "doc_id",
            "lang",
            "source",
            F.col("n").cast("bigint").alias("n_words"),
            "word_chars",
            "n_symbols",
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias(
                "n_dup_lines"
            ),
            F.size("lines").cast("bigint").alias("n_lines"),
            _repeat_words(F.col("numbered")).alias("n_repeat_words"),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
    )


def bucket(value: Column) -> Column:
    """The sketch bucket of a whole number: its leading bits, the rest zero."""
    size = F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0)))
    return value - value % size.cast("bigint")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, value, n): the sketch of every group, of passing documents."""
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("measure"), F.expr(text).cast("bigint").alias("value"))
            for name, (text, _, _) in MEASURES.items()
        )
    )
    return (
        measured.filter(~F.col("base_failed"))
        .select("lang", "source", F.explode(entries).alias("e"))
        .groupBy("lang", "source", F.col("e.measure"), bucket(F.col("e.value")).alias("value"))
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, *group: str) -> DataFrame:
    """Sketches of coarser groups: counts of equal buckets add up."""
    return sketch.groupBy(*group, "measure", "value").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *group: str) -> DataFrame:
    """Per group: documents seen, lower and upper fence of every measure."""
    per = Window.partitionBy(*group, "measure")
    ranked = sketch.select(
        *group,
        "measure",
        "value",
        F.sum("n").over(per.orderBy("value")).alias("upto"),
        F.sum("n").over(per).alias("total"),
    )
    decile = lambda k: F.min(F.when(10 * F.col("upto") >= k * F.col("total"), F.col("value")))
    deciles = ranked.groupBy(*group, "measure").agg(
        F.max("total").alias("total"),
        *[decile(k).alias(name) for name, k in (("low", 1), ("middle", 5), ("high", 9))],
    )
    columns = [F.max("total").alias("group_size")]
    for name, (_, least, both) in MEASURES.items():
        here, spread = F.col("measure") == name, F.lit(least)
        above = F.greatest(F.col("high") - F.col("middle"), spread)
        columns.append(F.max(F.when(here, F.col("high") + REACH * above)).alias(f"{name}_max"))
        if both:
            below = F.greatest(F.col("middle") - F.col("low"), spread)
            columns.append(F.max(F.when(here, F.col("low") - REACH * below)).alias(f"{name}_min"))
    if group:
        return deciles.groupBy(*group).agg(*columns)
    return deciles.agg(*columns)


def _limits() -> list[str]:
    return [
        f"{name}_{end}"
        for name, (_, _, both) in MEASURES.items()
        for end in (("max", "min") if both else ("max",))
    ]


def _averaged(own: str, parent: str, prior: int) -> Column:
    """A group's fences, averaged with those of the group above it."""
    n = F.col(f"{own}.group_size")
    return F.struct(
        *(
            F.floor((n * F.col(f"{own}.{x}") + prior * F.col(f"{parent}.{x}")) / (n + prior)).alias(x)
            for x in _limits()
        )
    )


def thresholds(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per language and source with the limits that hold there, and how far its own
    documents set them, per mille."""
    limits = _limits()
    own = fences(sketch, "lang", "source").select(
        "lang", "source", F.struct("group_size", *limits).alias("own")
    )
    language = fences(merged(sketch, "lang"), "lang").select(
        F.col("lang").alias("lang_key"), F.struct("group_size", *limits).alias("language")
    )
    whole = fences(merged(sketch)).select("group_size", *limits).first()  # one row, always
    corpus = F.struct(*(F.lit(v).cast("bigint").alias(k) for k, v in whole.asDict().items()))
    joined = (
        own.join(language, F.col("lang").eqNullSafe(F.col("lang_key")))
        .withColumn("corpus", corpus)
        .withColumn("above", _averaged("language", "corpus", prior))
    )
    size = F.col("own.group_size")
    return joined.select(
        "lang",
        "source",
        _averaged("own", "above", prior).alias("limit"),
        F.floor(1000 * size / (size + prior)).alias("own_share"),
    )


def within(limit: str = "limit") -> Column:
    """Whether a measured document lies inside the fences."""
    verdict = F.lit(True)
    for name, (text, _, both) in MEASURES.items():
        value = F.expr(text)
        verdict = verdict & (value <= F.col(f"{limit}.{name}_max"))
        if both:
            verdict = verdict & (value >= F.col(f"{limit}.{name}_min"))
    return verdict


def adaptive_filter(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """Every document with its counts, its group's share in the fences and the verdict ``kept``."""
    measured = settle(measure(docs), "quality")
    limits = thresholds(sketches(measured), prior).select(
        F.col("lang").alias("lang_key"), F.col("source").alias("source_key"), "limit", "own_share"
    )
    same = F.col("lang").eqNullSafe(F.col("lang_key")) & F.col("source").eqNullSafe(
        F.col("source_key")
    )
    inside = F.coalesce(within(), F.lit(False))
    return measured.join(limits, same, "left").select(
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "own_share",
        (~F.col("base_failed") & inside).alias("kept"),
    )
