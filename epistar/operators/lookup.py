"""Name -> code resolution: exact (J1), fuzzy (J2, F12, O2) and the fallback
chain (J3).

Matching works the same way at every size of the lookup. The fuzzy step scores
only the *distinct* names the exact pass missed, and pairs them by exact blocking, with an
upper bound for every form of the score:

* edit and token-sort ratio: the rarest grams of two names within the edit budget, as many as the
  budget can spoil and one more, have one in common near its place;
* token set: a name that has the words of the other, up to the allowed share, has at least one of
  its rarest words that together exceed what may be missing (an inverted index of words in
  document-frequency order, searched by prefixes);
* partial: the shorter name within the edit budget of a stretch of the longer leaves one of its segments
  unedited there, wherever it lies.

So pairs meet on equi-join keys and no pair that can reach the threshold is
lost. The best candidate per name is picked by an aggregate (``max_by``), ties
going to the earliest lookup row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epistar.functions.text import (
    ALL_FORMS,
    PARTIAL_MIN_LENGTH,
    PARTIAL_WEIGHT,
    PLAIN_FORMS,
    TOKEN_SET_WEIGHT,
    TOKEN_SORT_WEIGHT,
    joined_length,
    length_window,
    normalize_name,
    prefix,
    similarity,
    token_sort,
    tokens,
)
from epistar.operators.dedupe import keep_first
from epistar.operators.projection import replace_values
from epistar.session import cut_lineage


# Fixed value: the reference threshold for accepting a fuzzy match (0-100).
FUZZY_MIN_SCORE = 75

# A name whose plain spelling always matches the wrong entry is
# matched under this working alias, then restored.
MATCH_ALIASES = {"United States Virgin Islands": "Virgin Islands US"}


def prepare_lookup(
    lookup: DataFrame,
    name_col: str = "Name",
    code_col: str = "Code",
    pos_col: str | None = None,
    materialize: bool = True,
) -> DataFrame:
    """Normalise a (name, code) lookup to ``_lk_name, _lk_code, _lk_pos``.

    Names are lower-cased; duplicate names keep their first row so a join
    can never multiply data rows. The result is written once to the shared
    checkpoint folder; whether a join broadcasts it follows from its bytes
    there, and matching works the same way at every size.
    """
    pos = F.col(pos_col) if pos_col else F.monotonically_increasing_id()
    lk = lookup.select(
        normalize_name(F.col(name_col)).alias("_lk_name"),
        F.col(code_col).alias("_lk_code"),
        pos.alias("_lk_pos"),
    ).filter(F.col("_lk_name").isNotNull())
    prepared = keep_first(lk, ["_lk_name", "_lk_code", "_lk_pos"], ["_lk_name"], ["_lk_pos"])
    if not materialize:
        return prepared
    # its file size tells the planner whether to broadcast it
    return cut_lineage(prepared)


def exact_lookup(df: DataFrame, name_col: str, lookup: DataFrame, out_col: str = "code_exact") -> DataFrame:
    """Case-insensitive left equi-lookup of ``name_col`` -> ``out_col``."""
    lk = lookup.select("_lk_name", "_lk_code")
    joined = df.join(lk, normalize_name(F.col(name_col)) == F.col("_lk_name"), "left")
    return joined.withColumnRenamed("_lk_code", out_col).drop("_lk_name")


def _max_edits(length: Column, min_ratio: int) -> Column:
    """Largest edit distance d with round(100 * (L - d) / L) >= min_ratio."""
    return F.floor(length * F.lit(201 - 2 * min_ratio) / 200).cast("int")


def _segment(m: Column, d: Column, i: Column) -> tuple[Column, Column]:
    """(start, length) of segment i when a string of length m is cut into d + 1 parts."""
    k = d + 1
    base = (m / k).cast("int")
    boundary = k - m % k
    start = i * base + F.greatest(F.lit(0), i - boundary)
    length = base + F.when(i >= boundary, 1).otherwise(0)
    return start, length


def _key(*parts: Column) -> Column:
    """A blocking key as one text: duplicates among texts are found by hashing, among structs by comparing all."""
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def _segment_keys(text: Column, ratios: tuple[int, ...], min_score: int, side: str) -> Column:
    """Exploded blocking keys ``variant|m|d|i|piece`` for one string.

    Pigeonhole: if lev(a, b) <= d, cutting b into d + 1 segments leaves one
    segment unedited, found in a at most d positions from where it starts in
    b. The lookup side ("b") emits its segments for every d its partners'
    lengths can imply; the query side ("a") emits, for every partner length m
    in its window, the substrings that could be such a segment.
    """
    keys = []
    for variant, (ratio, source) in enumerate(ratios):
        t = source(text)
        n = F.length(t)
        lo, hi = length_window(n, min_score)
        if side == "b":
            ds = F.sequence(_max_edits(n, ratio), _max_edits(F.greatest(n, hi), ratio))
            per_d = F.transform(
                ds,
                lambda d: F.transform(
                    F.sequence(F.lit(0), d),
                    lambda i: _key(F.lit(variant), n, d, i, F.substr(t, _segment(n, d, i)[0] + 1, _segment(n, d, i)[1])),
                ),
            )
        else:
            def per_m(m):
                d = _max_edits(F.greatest(n, m), ratio)

                def per_i(i):
                    start, length = _segment(m, d, i)
                    first, last = F.greatest(F.lit(0), start - d), F.least(n - length, start + d)
                    starts = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
                    return F.transform(starts, lambda st: _key(F.lit(variant), m, d, i, F.substr(t, st + 1, length)))

                return F.flatten(F.transform(F.sequence(F.lit(0), d), per_i))

            per_d = F.transform(F.sequence(F.greatest(lo, F.lit(0)), hi), per_m)
        keys.append(F.flatten(per_d))
    return F.explode(F.array_distinct(F.concat(*keys)))


def _segment_pairs(cand: DataFrame, lookup: DataFrame, min_score: int) -> DataFrame:
    """Candidate (name, lookup entry) pairs by exact segment blocking."""
    sorted_ratio = _least_ratio(min_score, TOKEN_SORT_WEIGHT)
    ratios = ((min_score, lambda c: c), (sorted_ratio, token_sort))
    q = cand.select("_match_name", "_norm", _segment_keys(F.col("_norm"), ratios, min_score, "a").alias("_k"))
    b = lookup.select("_lk_name", "_lk_code", "_lk_pos", _segment_keys(F.col("_lk_name"), ratios, min_score, "b").alias("_k"))
    return q.join(b, "_k", "inner").select("_match_name", "_norm", "_lk_name", "_lk_code", "_lk_pos").distinct()


def _gram_size(min_score: int) -> int:
    """Two characters where d edits of names of length m always leave a gram: m - 1 - 2 d >= 1; else one."""
    return 2 if min_score >= 75 else 1


def _gram_rows(df: DataFrame, c: str, ratios, size: int) -> DataFrame:
    """(c, _v, _n, _gram, _at, _take) of every variant's grams; a gram's repeats are told apart by number.

    ``_take``: how many of the rarest grams must be looked at for the largest number of edits that a partner allows.
    """
    frames = []
    for variant, (ratio, source) in enumerate(ratios):
        t = source(F.col(c))
        n = F.length(t)
        # at the lowest ratio the partner is n * 100 / ratio long; one more absorbs rounding
        widest = F.floor(n * 100 / (ratio - 0.5)).cast("int") + 1
        starts = F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1)))
        grams = F.transform(starts, lambda i: F.struct(F.substr(t, i, F.lit(size)).alias("g"), i.alias("i")))  # noqa: B023
        row = df.select(c, F.lit(variant).alias("_v"), n.alias("_n"), (size * _max_edits(widest, ratio) + 1).alias("_take"), F.explode(grams).alias("_g"))
        frames.append(row)
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    nth = F.row_number().over(Window.partitionBy(c, "_v", "_g.g").orderBy("_g.i"))
    return rows.select(c, "_v", "_n", "_take", F.col("_g.i").alias("_at"), F.concat("_g.g", F.lit("#"), nth.cast("string")).alias("_gram"))


def _gram_pairs(cand: DataFrame, lookup: DataFrame, min_score: int) -> DataFrame:
    """Candidate pairs (_norm, _lk_name) whose edit or token-sort ratio can reach ``min_score``.

    d edits change at most d times as many grams of a name as a gram has characters. So if both names' grams are put in
    one order, rarest first, that many of each and one more have one in common, at most d places apart.
    """
    size = _gram_size(min_score)
    ratios = ((min_score, lambda c: c), (_least_ratio(min_score, TOKEN_SORT_WEIGHT), token_sort))
    of_names, of_lookup = _gram_rows(cand.select("_norm").distinct(), "_norm", ratios, size), _gram_rows(lookup.select("_lk_name"), "_lk_name", ratios, size)
    frequency = of_lookup.groupBy("_v", "_gram").agg(F.count(F.lit(1)).alias("_df"))

    def rarest(rows: DataFrame, c: str, tag: str) -> DataFrame:
        placed = rows.join(frequency, ["_v", "_gram"], "left").fillna(0, ["_df"])
        nth = F.row_number().over(Window.partitionBy(c, "_v").orderBy("_df", "_gram"))
        kept = placed.withColumn("_nth", nth).where((F.col("_nth") <= F.col("_take")) & (F.col("_df") > 0))
        return kept.select(c, "_v", "_gram", F.col("_n").alias(f"_n{tag}"), F.col("_at").alias(f"_at{tag}"))

    met = rarest(of_names, "_norm", "a").join(rarest(of_lookup, "_lk_name", "b"), ["_v", "_gram"])
    longest = F.greatest("_na", "_nb")
    edits = F.lit(None).cast("int")
    for variant, (ratio, _) in enumerate(ratios):
        edits = F.when(F.col("_v") == variant, _max_edits(longest, ratio)).otherwise(edits)
    near = (F.abs(F.col("_na") - F.col("_nb")) <= edits) & (F.abs(F.col("_ata") - F.col("_atb")) <= edits)
    return met.where(near).select("_norm", "_lk_name").distinct()


def _least_ratio(min_score: int, weight: int) -> int:
    """Smallest plain ratio whose weighted form still rounds to ``min_score``."""
    return -(-(100 * min_score - 50) // weight)


def _prefixes(words: DataFrame, key: str, missing_share: float) -> DataFrame:
    """The rarest words of each name (rows ``key``, ``_len``, ``_word``, ``_df``) that outweigh the share that may be missing."""
    before = Window.partitionBy(key).orderBy("_df", "_word").rowsBetween(Window.unboundedPreceding, -1)
    weighed = words.withColumn("_before", F.coalesce(F.sum(F.length("_word")).over(before), F.lit(0)))
    return weighed.where((F.col("_before") <= missing_share * F.col("_len")) & (F.col("_df") > 0))


def _token_pairs(cand: DataFrame, lookup: DataFrame, min_score: int) -> DataFrame:
    """Candidate pairs (_norm, _lk_name) whose token-set form can reach ``min_score``."""
    # rounding adds at most half a point to the share
    missing = 1 - (_least_ratio(min_score, TOKEN_SET_WEIGHT) - 0.5) / 100 + 1e-9
    listed = lambda df, c: df.select(c, joined_length(tokens(F.col(c))).alias("_len"), F.explode(tokens(F.col(c))).alias("_word"))
    of_names, of_lookup = listed(cand.select("_norm").distinct(), "_norm"), listed(lookup.select("_lk_name"), "_lk_name")
    frequency = of_lookup.groupBy("_word").agg(F.count(F.lit(1)).alias("_df"))
    of_names = of_names.join(frequency, "_word", "left").fillna(0, ["_df"])
    of_lookup = of_lookup.join(frequency, "_word")
    covered_name = _prefixes(of_names, "_norm", missing).select("_norm", "_word").join(of_lookup.select("_lk_name", "_word"), "_word")
    covered_entry = _prefixes(of_lookup, "_lk_name", missing).select("_lk_name", "_word").join(of_names.select("_norm", "_word"), "_word")
    return covered_name.select("_norm", "_lk_name").unionByName(covered_entry.select("_norm", "_lk_name")).distinct()


def _partial_pairs(cand: DataFrame, lookup: DataFrame, min_score: int) -> DataFrame:
    """Candidate pairs (_norm, _lk_name) whose partial form can reach ``min_score``."""
    ratio = _least_ratio(min_score, PARTIAL_WEIGHT)

    def segments(c: Column) -> Column:
        """Keys of a name as the shorter one."""
        m = F.length(c)
        d = _max_edits(m, ratio)
        cut = lambda i: _key(m, i, F.substr(c, _segment(m, d, i)[0] + 1, _segment(m, d, i)[1]))
        return F.when(m >= PARTIAL_MIN_LENGTH, F.transform(F.sequence(F.lit(0), d), cut)).otherwise(F.array().cast("array<string>"))

    def stretches(c: Column) -> Column:
        """Keys of a name as the longer one: for every length and segment of the shorter, its own stretches of that size."""
        n = F.length(c)
        longest = F.floor(n * 2 / 3).cast("int")

        def of_length(m: Column) -> Column:
            d = _max_edits(m, ratio)

            def of_segment(i: Column) -> Column:
                size = _segment(m, d, i)[1]
                return F.transform(F.sequence(F.lit(1), n - size + 1), lambda at: _key(m, i, F.substr(c, at, size)))

            return F.flatten(F.transform(F.sequence(F.lit(0), d), of_segment))

        lengths = F.sequence(F.lit(PARTIAL_MIN_LENGTH), longest)
        none = F.array().cast("array<string>")
        return F.when(longest >= PARTIAL_MIN_LENGTH, F.array_distinct(F.flatten(F.transform(lengths, of_length)))).otherwise(none)

    names, entries = cand.select("_norm").distinct(), lookup.select("_lk_name")
    explode = lambda df, c, keys: df.select(c, F.explode(keys(F.col(c))).alias("_k"))
    short_names = explode(names, "_norm", segments).join(explode(entries, "_lk_name", stretches), "_k")
    short_entries = explode(entries, "_lk_name", segments).join(explode(names, "_norm", stretches), "_k")
    return short_names.select("_norm", "_lk_name").unionByName(short_entries.select("_norm", "_lk_name")).distinct()


def candidate_pairs(cand: DataFrame, lookup: DataFrame, min_score: int, forms: tuple[str, ...]) -> DataFrame:
    """All (name, lookup entry) pairs that can reach ``min_score`` in one of ``forms``, each once."""
    steps = [_gram_pairs]
    steps += [f for form, f in (("set", _token_pairs), ("partial", _partial_pairs)) if form in forms]
    found = steps[0](cand, lookup, min_score)
    for step in steps[1:]:
        found = found.unionByName(step(cand, lookup, min_score))
    full = found.distinct().join(cand.select("_match_name", "_norm"), "_norm")
    return full.join(lookup.select("_lk_name", "_lk_code", "_lk_pos"), "_lk_name")


def best_fuzzy_matches(
    names: DataFrame,
    lookup: DataFrame,
    min_score: int = FUZZY_MIN_SCORE,
    blocking: str = "index",
    forms: tuple[str, ...] = ALL_FORMS,
) -> DataFrame:
    """J2 core: for each distinct ``_match_name``, the best lookup entry scoring >= min_score.

    Pairs meet on exact keys (see ``candidate_pairs``), so only names that share a piece or a
    rare word are scored and no shuffle partition holds all names of
    one length. ``blocking="segments"`` meets pairs on unedited segments and ``"window"`` pairs all names whose lengths
    fit; they are there to check against (plain forms only), as all find every
    pair that can score ``min_score`` or more.
    Returns ``_match_name, match_name, match_score, code_fuzzy``.
    """
    if blocking != "index":
        forms = tuple(f for f in forms if f in PLAIN_FORMS)
    cand = names.select("_match_name").distinct().withColumn("_norm", normalize_name(F.col("_match_name")))
    if blocking == "index":
        # the names are read once for all indexes
        pairs = candidate_pairs(cut_lineage(cand), lookup, min_score, forms)
    elif blocking == "segments":
        pairs = _segment_pairs(cand, lookup, min_score)
    else:
        lo, hi = length_window(F.length("_norm"), min_score)
        cand = cand.withColumn("_cand_len", F.explode(F.sequence(lo, hi)))
        lk = lookup.withColumn("_lk_len", F.length("_lk_name"))
        pairs = cand.join(lk, F.col("_cand_len") == F.col("_lk_len"), "inner")
    pairs = pairs.withColumn("_score", similarity(F.col("_norm"), F.col("_lk_name"), forms))
    best = pairs.groupBy("_match_name").agg(
        F.max_by(
            F.struct(F.col("_lk_name").alias("match_name"), F.col("_score").alias("match_score"), F.col("_lk_code").alias("code_fuzzy")),
            F.struct(F.col("_score"), -F.col("_lk_pos")),
        ).alias("_best")
    )
    return best.select("_match_name", "_best.*").filter(F.col("match_score") >= min_score)


def fuzzy_lookup(
    df: DataFrame,
    name_col: str,
    lookup: DataFrame,
    code_col: str = "code_exact",
    out_col: str = "code_fuzzy",
    min_score: int = FUZZY_MIN_SCORE,
    aliases: Mapping[str, str] = MATCH_ALIASES,
) -> DataFrame:
    """Fill ``out_col`` for rows whose ``code_col`` is null, by best fuzzy match.

    Only distinct unmatched names are scored; the result (one row per
    distinct name) is joined back on the name. AQE picks broadcast or
    shuffle for that join from its measured size.
    """
    keyed = df.withColumn("_match_name", replace_values(F.col(name_col), aliases))
    unmatched = keyed.filter(F.col(code_col).isNull() & F.col("_match_name").isNotNull())
    best = best_fuzzy_matches(unmatched, lookup, min_score).select(
        "_match_name", F.col("code_fuzzy").alias(out_col), "match_name", "match_score"
    )
    out = keyed.join(best, "_match_name", "left")
    # only rows that needed a fuzzy match take its code
    out = out.withColumn(out_col, F.when(F.col(code_col).isNull(), F.col(out_col)))
    return out.drop("_match_name")


def name_codes(
    names: DataFrame,
    lookup: DataFrame,
    min_score: int = FUZZY_MIN_SCORE,
    aliases: Mapping[str, str] = MATCH_ALIASES,
    blocking: str = "index",
    forms: tuple[str, ...] = ALL_FORMS,
) -> DataFrame:
    """J1+J2 over distinct names: ``_name, _code_exact, _code_fuzzy, match_name, match_score``.

    The exact pass and the fuzzy pass both run on the distinct names only, so
    a name repeated on millions of rows is resolved once.
    """
    distinct = names.filter(F.col("_name").isNotNull()).distinct()
    exact = exact_lookup(distinct, "_name", lookup, "_code_exact")
    keyed = exact.withColumn("_match_name", replace_values(F.col("_name"), aliases))
    best = best_fuzzy_matches(keyed.filter(F.col("_code_exact").isNull()), lookup, min_score, blocking=blocking, forms=forms)
    joined = keyed.join(best, "_match_name", "left")
    return joined.select(
        "_name",
        "_code_exact",
        F.when(F.col("_code_exact").isNull(), F.col("code_fuzzy")).alias("_code_fuzzy"),
        "match_name",
        "match_score",
    )


def resolve_codes(
    df: DataFrame,
    lookup: DataFrame,
    name_col: str = "country_name",
    territory_col: str = "territory_code",
    code_col: str = "country_code",
    min_score: int = FUZZY_MIN_SCORE,
    keep_match_details: bool = False,
    blocking: str = "index",
    forms: tuple[str, ...] = ALL_FORMS,
) -> DataFrame:
    """``code = exact ?? fuzzy ?? first two chars of territory ?? original code``.

    Names are resolved once per distinct name (``name_codes``, a pass that
    reads only the name column) and joined back in one join; AQE picks a
    broadcast or a shuffle for it from the measured number of names. Columns
    that do not exist are left out of the chain. The result replaces (or
    creates) ``code_col``.
    """
    names = set(df.columns)
    if name_col not in names:
        return df
    codes = name_codes(df.select(F.col(name_col).alias("_name")), lookup, min_score, blocking=blocking, forms=forms)
    # null names never resolve, so a plain equality join is exact
    out = df.join(codes, df[name_col] == codes["_name"], "left").drop("_name")
    chain = [F.col("_code_exact"), F.col("_code_fuzzy")]
    if territory_col in names:
        chain.append(prefix(F.col(territory_col), 2))
    if code_col in names:
        chain.append(F.col(code_col))
    out = out.withColumn(code_col, F.coalesce(*chain))
    drop = ["_code_exact", "_code_fuzzy"]
    if not keep_match_details:
        drop += ["match_name", "match_score"]
    return out.drop(*drop)
