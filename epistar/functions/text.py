"""String expressions: row hash (F6/F7), age bands (F8), prefixes (F9),
similarity scores (F12) and dataset slugs (S12).

All are native Column expressions; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from epistar.operators.columns import col_of


def composite_key(*cols, sep: str = "|") -> Column:
    """``a|b|c`` text key (nulls are skipped, as ``concat_ws`` does)."""
    return F.concat_ws(sep, *[col_of(c).cast("string") for c in cols])


# Fixed value: stands for a null in a hashed key.
NULL_MARK = "\0"


def row_hash(*cols, sep: str = "|") -> Column:
    """SHA-256 hex digest of the ``|``-joined key columns.

    A null keeps its place. A separator, backslash or null mark inside a part gets a backslash before it, so
    different rows never join to one text; ordinary parts hash as they stand.
    """
    if len(sep) != 1 or sep in ("\\", NULL_MARK):
        raise ValueError("sep must be one character, no backslash and not the null mark")
    special = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in ("\\", NULL_MARK, sep)) + "]"
    part = lambda c: F.regexp_replace(col_of(c).cast("string"), special, r"\\$0")
    return F.sha2(F.concat_ws(sep, *[F.coalesce(part(c), F.lit(NULL_MARK)) for c in cols]), 256)


def prefix(c, n: int = 2) -> Column:
    """first ``n`` characters."""
    return F.substring(col_of(c), 1, n)


# The open age band runs to 200 and an unbanded group spans 0..200.
AGE_OPEN_UPPER = 200
AGE_ALL_LOWER = 0
AGE_PATTERN = "^(?:1_)?Age(.*)$"


def age_band(group) -> tuple[Column, Column]:
    """F8: (lower, upper) age limits of a target-group label.

    ``AgeA_B`` -> (A, B); ``Age<N`` -> (0, N); ``AgeN+`` -> (N, 200); the
    same after a ``1_`` prefix; anything else (``ALL``, ``AgeUNK``, ``HCW``)
    -> (0, 200). Numbers that do not parse become null.
    """
    # a band is what follows "Age": two limits around "_", an upper one after "<", or a lower one before "+"
    found = F.regexp_extract(col_of(group), AGE_PATTERN, 1)
    limits = F.split(found, "_")
    open_below, open_above, pair = found.contains("<"), found.contains("+"), found.contains("_")
    number = lambda text: F.trim(text).try_cast("int")
    of_pair = lambda k: F.when(F.size(limits) == 2, number(F.get(limits, F.lit(k))))
    alone = F.regexp_replace(found, "[<+]", "")
    lower = F.when(pair, of_pair(0)).when(open_above & ~open_below, number(alone)).otherwise(F.lit(AGE_ALL_LOWER))
    upper = F.when(pair, of_pair(1)).when(open_below, number(alone)).otherwise(F.lit(AGE_OPEN_UPPER))
    return lower, upper


def _int_ratio(distance: Column, length: Column) -> Column:
    """round(100 * (L - d) / L) in exact integer arithmetic (half rounds up)."""
    return F.when(length == 0, F.lit(100)).otherwise(
        ((F.lit(200) * (length - distance) + length) / (F.lit(2) * length)).cast("int")
    )


def edit_ratio(a, b) -> Column:
    """Levenshtein similarity 0-100: ``round(100 * (1 - lev(a, b) / max_len))``."""
    x, y = col_of(a), col_of(b)
    length = F.greatest(F.length(x), F.length(y))
    return _int_ratio(F.levenshtein(x, y), length)


def normalize_name(c) -> Column:
    """Lower-case, trim and collapse runs of white space to one space."""
    return F.lower(F.trim(F.regexp_replace(col_of(c), r"\s+", " ")))


def token_sort(c) -> Column:
    """Words of a normalised name sorted and re-joined by one space.

    On a normalised name this keeps the length unchanged.
    """
    return F.array_join(F.array_sort(F.split(col_of(c), " ")), " ")


# Fixed value: token-sort similarity is weighted 95/100 against the plain ratio.
TOKEN_SORT_WEIGHT = 95


# The other forms of the score, and their weights in 100.
TOKEN_SET_WEIGHT = 95
PARTIAL_WEIGHT = 90
PARTIAL_FAR_WEIGHT = 60
# A partial match needs lengths 3:2 apart or more (beyond 8:1 it weighs less) and this many characters.
PARTIAL_MIN_LENGTH = 4
PLAIN_FORMS = ("plain", "sort")
ALL_FORMS = ("plain", "sort", "set", "partial")


def _weighted(score: Column, weight: int) -> Column:
    return ((score * weight + 50) / 100).cast("int")


def tokens(c) -> Column:
    """Distinct words of a normalised name."""
    return F.array_distinct(F.filter(F.split(col_of(c), " "), lambda t: t != ""))


def joined_length(words: Column) -> Column:
    """Characters of words joined by one space."""
    return F.length(F.array_join(words, " "))


def token_set_ratio(a, b) -> Column:
    """Share (0-100, by characters) of the shorter name's words that the other name has too.

    100 where one name holds all words of the other ("Republic of Moldova" and "Moldova").
    """
    x, y = tokens(a), tokens(b)
    shorter = F.least(joined_length(x), joined_length(y))
    common = joined_length(F.array_intersect(x, y))
    return F.when(shorter == 0, F.lit(0)).otherwise(((F.lit(200) * common + shorter) / (F.lit(2) * shorter)).cast("int"))


def partial_ratio(a, b) -> Column:
    """Best edit ratio of the shorter name with a stretch of the longer of the same length."""
    x, y = col_of(a), col_of(b)
    short, long_ = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
    m = F.length(short)
    starts = F.sequence(F.lit(1), F.length(long_) - m + 1)
    return _int_ratio(F.array_min(F.transform(starts, lambda i: F.levenshtein(short, F.substr(long_, i, m)))), m)


def partial_applies(a, b) -> Column:
    """Whether the lengths of two names are far enough apart for the partial form."""
    m, n = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return (m >= PARTIAL_MIN_LENGTH) & (2 * n >= 3 * m)


def similarity(a, b, forms: tuple[str, ...] = PLAIN_FORMS) -> Column:
    """0-100 similarity of two normalised names (see ``normalize_name``), the largest of ``forms``.

    ``plain``: edit ratio. ``sort``: that of the token-sorted names, weighted 0.95, so word order
    counts for little. ``set``: words in common, weighted 0.95, so added words count for little.
    ``partial``: the best stretch of the longer name, weighted 0.9 (0.6 if it is over 8 times as long).
    """
    x, y = col_of(a), col_of(b)
    scores = [edit_ratio(x, y), _weighted(edit_ratio(token_sort(x), token_sort(y)), TOKEN_SORT_WEIGHT)]
    if "set" in forms:
        scores.append(_weighted(token_set_ratio(x, y), TOKEN_SET_WEIGHT))
    if "partial" in forms:
        far = F.greatest(F.length(x), F.length(y)) > 8 * F.least(F.length(x), F.length(y))
        part = partial_ratio(x, y)
        part = F.when(far, _weighted(part, PARTIAL_FAR_WEIGHT)).otherwise(_weighted(part, PARTIAL_WEIGHT))
        scores.append(F.when(partial_applies(x, y), part).otherwise(F.lit(0)))
    return F.greatest(*scores)


def length_window(length, min_score: int) -> tuple[Column, Column]:
    """Lengths a partner must have to possibly reach ``min_score``.

    Levenshtein distance is at least the length difference, so a pair of
    lengths (m, n) with m <= n can reach a ratio of at most 100 * m / n.
    Token sorting keeps the length of a normalised name, so the bound holds
    for ``similarity`` on normalised names.
    The window is exact: no pair outside it can score ``min_score`` or more.
    """
    n = col_of(length)
    # plain ratio >= s  needs  100*m/n >= s - 0.5 (rounding) ; the weighted
    # form is never larger than the plain bound, so the plain bound is the window.
    # One extra on each side absorbs floating-point error at the edges.
    lo = F.ceil(n * F.lit(max(min_score, 1) - 0.5) / 100).cast("int") - 1
    hi = F.floor(n * 100 / F.lit(max(min_score, 1) - 0.5)).cast("int") + 1
    return F.greatest(lo, F.lit(0)), hi


# The one endpoint whose landed name is not derived from its path.
SLUG_OVERRIDES = {"json/data.json": "colour-key.json"}


def dataset_slug(endpoint) -> Column:
    """Landed file name of an endpoint path.

    First path segment with surrounding slashes removed, ``_`` -> ``-``,
    lower-cased, ``.json`` appended when it has no extension.
    """
    e = col_of(endpoint)
    segment = F.split(F.regexp_replace(e, "^/+|/+$", ""), "/").getItem(0)
    base = F.lower(F.translate(segment, "_", "-"))
    named = F.when(base.contains("."), base).otherwise(F.concat(base, F.lit(".json")))
    out = named
    for path, name in SLUG_OVERRIDES.items():
        out = F.when(e == path, F.lit(name)).otherwise(out)
    return out
