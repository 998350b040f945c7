"""Quality rules: base counts and divergence from language references, in DataFrame functions only.

A document passes unless

* it has fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT_PCT`` per
  cent of its words stand in five-word windows that the text repeats; or
* the Jensen-Shannon divergence (base 2) of its character classes from its
  language's reference is above ``MAX_CLASS_DIVERGENCE``; or
* that of its common-word histogram is above ``MAX_WORD_DIVERGENCE``.

Divergence falls with the length of a text even where nothing is wrong, as
chance evens out, so both limits have a part that shrinks as 1 / words.

References are learned from the prose of the corpus, that is from all documents
with at most ``MAX_REFERENCE_SYMBOL_PCT`` symbols in 100 characters: by language,
the sums of the character classes, and the ``COMMON_WORDS`` most frequent words of at most
``SHORT`` letters (articles, prepositions and pronouns in most languages) with
a bin for all other words. A document whose language is null or has fewer than
``MIN_REFERENCE_WORDS`` words has no reference to diverge from: only the base
counts judge it.
Texts of fewer than ``MIN_DIVERGENCE_WORDS`` words are not compared at all.

The references are a table of one row a language, however many there are, of
6 + ``COMMON_WORDS`` + 1 numbers each, joined to the documents by language. It
is small enough to be broadcast, so scoring is one pass without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epistar.llm.common import table
from epistar.session import cut_lineage

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5
COMMON_WORDS = 12
SHORT = 4
MIN_REFERENCE_WORDS = 1000
MAX_REFERENCE_SYMBOL_PCT = 1
MIN_DIVERGENCE_WORDS = 30
MAX_CLASS_DIVERGENCE = (0.025, 1.0)  # limit, and what is added by 1 / words
MAX_WORD_DIVERGENCE = (0.04, 3.5)

GAP = r"[\x20\x09-\x0D]+"
# Punctuation that prose uses, and the characters counted as symbols.
SENTENCE_MARKS = r"""[.,;:!?'"()\-]"""
SYMBOLS = "[#*$%&|<>]"
CLASSES = ("upper", "plain", "blank", "mark", "symbol", "other")


def _only(text: Column, keep: str) -> Column:
    """Number of characters left when all but ``keep`` (a negated class) goes."""
    return F.char_length(F.regexp_replace(text, keep, "")).cast("long")


def _prose_words(text: Column) -> Column:
    """Words in lower case without sentence marks."""
    return F.array_remove(F.split(F.lower(F.regexp_replace(text, SENTENCE_MARKS, "")), GAP), "")


def base_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_m`` of the base counts and columns ``_c_*``, ``_chars`` of the character classes."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    step = _with_classes(docs.withColumn("_t", text), F.col("_t"))
    step = step.withColumn("_w", F.array_remove(F.split("_t", GAP), ""))
    n = F.size("_w")
    # shifted copies side by side make the windows; one function a window hashes them
    shifted = F.arrays_zip(*[F.slice("_w", k + 1, n - (WINDOW - 1)) for k in range(WINDOW)])
    windows = F.transform(shifted, lambda words: F.xxhash64(words))
    step = step.withColumn("_win", F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    # positions of windows that occur twice or more; only texts with such windows are sorted
    step = step.withColumn(
        "_s",
        F.when(
            F.size(F.array_distinct("_win")) < F.size("_win"),
            F.sort_array(F.transform("_win", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda x, i: F.coalesce(F.get("_s", i)["h"] == x["h"], F.lit(False))
    twin = F.filter("_s", lambda x, i: same(x, i - 1) | same(x, i + 1))
    step = step.withColumn("_p", F.sort_array(F.transform(twin, lambda x: x["i"])))
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = step.withColumn("_lines", lines)
    measures = F.struct(
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.col("_c_symbol").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )
    return step.withColumn("_m", measures).drop("_w", "_win", "_s", "_p", "_lines", "_t")


def _with_classes(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the characters by class (``_c_*``) and in all (``_chars``).

    Small letters and digits are ``plain``, what is in no class is ``other``. One pass over the text takes the plain
    characters out; the other classes are counted in what it leaves, a quarter of a usual text, and then in what is
    left of that without the blanks.
    """
    size = lambda c: F.char_length(c).cast("long")
    step = docs.withColumns({"_chars": size(text), "_rest": F.regexp_replace(text, r"[\p{Ll}0-9]+", "")})
    step = step.withColumn("_solid", F.regexp_replace("_rest", GAP, ""))
    step = step.withColumns({
        "_c_upper": _only(F.col("_solid"), r"\P{Lu}+"), "_c_plain": F.col("_chars") - size("_rest"), "_c_blank": size("_rest") - size("_solid"),
        "_c_mark": _only(F.col("_solid"), r"""[^.,;:!?'"()\-]+"""), "_c_symbol": _only(F.col("_solid"), "[^#*$%&|<>]+"),
    })
    other = F.col("_chars") - reduce(lambda a, b: a + b, [F.col(f"_c_{c}") for c in CLASSES[:-1]])
    return step.withColumn("_c_other", other).drop("_rest", "_solid")


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Reference histograms (_lang, _qc: shares of the classes, _qw: shares of the common words), a row for each language."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = _with_classes(docs.select(F.col(f"`{lang_col}`").cast("string").alias("_lang"), text.alias("_t")), F.col("_t"))
    base = base.where((100 * F.col("_c_symbol") <= MAX_REFERENCE_SYMBOL_PCT * F.col("_chars")) & F.col("_lang").isNotNull())
    base = base.withColumn("_w", _prose_words(F.col("_t"))).withColumn("_c_n", F.size("_w").cast("long"))
    # one pass counts both: short words, and the classes with a first entry that no word can equal
    sums = ["_c_n", *[f"_c_{c}" for c in CLASSES]]
    rows = base.select("_lang", *sums, F.posexplode(F.concat(F.array(F.lit(" ")), "_w")).alias("pos", "word"))
    rows = rows.where(F.char_length("word") <= SHORT)
    counted = rows.groupBy("_lang", "word").agg(F.count(F.lit(1)).alias("k"), *[F.sum(F.when(F.col("pos") == 0, F.col(c))).alias(c) for c in sums])
    counted = cut_lineage(counted)
    sums = counted.where("word = ' '").select("_lang", F.col("_c_n").alias("_n"), *[f"_c_{c}" for c in CLASSES])
    chars = reduce(lambda a, b: a + b, [F.col(f"_c_{c}") for c in CLASSES])
    sums = sums.where((F.col("_n") >= MIN_REFERENCE_WORDS) & (chars > 0))
    by_count = Window.partitionBy("_lang").orderBy(F.desc("k"), "word")
    common = counted.where(F.col("word").rlike(r"\p{L}")).withColumn("r", F.row_number().over(by_count)).where(F.col("r") <= COMMON_WORDS)
    common = common.groupBy("_lang").agg(F.map_from_entries(F.collect_list(F.struct("word", "k"))).alias("_top"))
    share = F.transform_values("_top", lambda w, k: k / F.col("_n"))
    return cut_lineage(
        sums.join(common, "_lang", "left").select(
            "_lang", F.array(*[F.col(f"_c_{c}") / chars for c in CLASSES]).alias("_qc"),
            F.coalesce(share, F.create_map().cast("map<string,double>")).alias("_qw"),
        )
    )


def _js(p: Column, q: Column) -> Column:
    """One bin's share of the Jensen-Shannon divergence."""
    part = lambda a, b: F.when(a > 0, 0.5 * a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    return part(p, q) + part(q, p)


def divergences(docs: DataFrame, refs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` of ``base_measures`` with ``_js_classes`` and ``_js_words`` (null without a reference or without text)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    step = docs.withColumn("_key", F.col(f"`{lang_col}`").cast("string"))
    step = step.join(refs, F.col("_key") == F.col("_lang"), "left")
    js_classes = reduce(
        lambda a, b: a + b, [_js(F.col(f"_c_{c}") / F.col("_chars"), F.get("_qc", F.lit(i))) for i, c in enumerate(CLASSES)]
    )
    step = step.withColumn("_js_classes", F.when((F.col("_chars") > 0) & F.col("_qc").isNotNull(), js_classes))
    # the histogram of the language's common words: counts by word, the rest in one bin
    step = step.withColumn("_pw", _prose_words(text)).withColumn("_np", F.size("_pw"))
    step = step.withColumn("_found", F.filter("_pw", lambda w: (F.char_length(w) <= SHORT) & F.map_contains_key("_qw", w)))
    step = step.withColumn(
        "_bins",
        F.transform(
            F.array_distinct("_found"),
            lambda w: F.struct(
                ((F.size("_found") - F.size(F.array_remove("_found", w))) / F.col("_np")).alias("p"),
                F.element_at(F.col("_qw"), w).alias("q"),
            ),
        ),
    )
    zero = F.lit(0.0)
    sums = F.aggregate(
        "_bins", F.struct(zero.alias("js"), zero.alias("p"), zero.alias("q")),
        lambda acc, b: F.struct(
            (acc["js"] + _js(b["p"], b["q"])).alias("js"), (acc["p"] + b["p"]).alias("p"), (acc["q"] + b["q"]).alias("q")
        ),
    )
    every_q = F.aggregate(F.map_values("_qw"), zero, lambda a, q: a + q)
    step = step.withColumn("_sum", sums).withColumn("_every_q", every_q)
    absent = F.greatest(zero, F.col("_every_q") - F.col("_sum")["q"])
    rest_p, rest_q = F.greatest(zero, 1 - F.col("_sum")["p"]), F.greatest(zero, 1 - F.col("_every_q"))
    js_words = F.col("_sum")["js"] + 0.5 * absent + _js(rest_p, rest_q)
    step = step.withColumn("_js_words", F.when((F.col("_np") > 0) & F.col("_qw").isNotNull(), js_words))
    return step.drop("_key", "_lang", "_qc", "_qw", "_pw", "_found", "_np", "_bins", "_sum", "_every_q", "_chars", *[f"_c_{c}" for c in CLASSES])


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with a struct ``_q``: base counts, ``base_failed`` and ``kept``.

    Null texts count as empty and fail the base rule. ``docs`` should hold no
    column with a leading underscore; ``keep_good`` packs its rows first, so
    that no name of theirs can clash.
    """
    refs = references(docs, text_col, lang_col)
    step = divergences(base_measures(docs, text_col), refs, text_col, lang_col)
    m = F.col("_m")
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PCT * m["n_words"])
    above = lambda js, limit: F.coalesce(F.col(js) > limit[0] + limit[1] / m["n_words"], F.lit(False))
    long_enough = m["n_words"] >= MIN_DIVERGENCE_WORDS
    diverges = long_enough & (above("_js_classes", MAX_CLASS_DIVERGENCE) | above("_js_words", MAX_WORD_DIVERGENCE))
    verdict = F.struct(
        *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"), (~failed & ~diverges).alias("kept"),
    )
    # a later filter would move below these projections and repeat their long expressions inside each other;
    # behind a row number, which is never negative, it stays above them
    return step.withColumn("_q", F.when(F.monotonically_increasing_id() >= 0, verdict)).drop("_m")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, base counts, ``base_failed``, ``kept``."""
    slim = docs.select(F.col(id_col), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return judged(slim).select(id_col, "_q.*")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"), F.col("lang"))
    return judged(packed).where("_q.kept").select("row.*")


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document; null texts are empty and fail, an empty table gives no rows."""
    return quality_rules(table(spark, sf_dir, "documents"))
