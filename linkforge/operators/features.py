"""Pair features: each is a Column of two array columns, 0.0 where a side is missing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkforge.functions.dates import similarity
from linkforge.functions.text import BAND_WORDS, literals, no_value
from linkforge.functions.urls import URL_STOP_WORDS

MISSING = 0.0


def _score(value: Column, *sides: Column, threshold: float | None = None) -> Column:
    some = ~no_value(sides[0])
    for s in sides[1:]:
        some = some & ~no_value(s)
    out = F.coalesce(F.when(some, value), F.lit(MISSING)).cast("double")
    return out if threshold is None else (out >= threshold).cast("double")


def _present(values: Column) -> Column:
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull()))


def exact_match(a: Column, b: Column, match: float = 1.0, non_match: float = 0.0) -> Column:
    return _score(F.when(F.arrays_overlap(_present(a), _present(b)), match).otherwise(non_match), a, b)


def levenshtein(a: Column, b: Column, threshold: float | None = None) -> Column:
    """The best similarity of any two elements: 1 - distance / length of the longer."""

    def one(x: Column, y: Column) -> Column:
        n = F.greatest(F.length(x), F.length(y))
        return F.when(n == 0, F.lit(0.0)).otherwise(1 - F.levenshtein(x, y) / n)

    best = F.array_max(F.flatten(F.transform(_present(a), lambda x: F.transform(_present(b), lambda y: one(x, y)))))
    return _score(best, a, b, threshold=threshold)


def token_cosine(a: Column, b: Column, threshold: float | None = None) -> Column:
    """Cosine of two token sets."""
    a, b = _present(a), _present(b)
    return _score(F.try_divide(F.size(F.array_intersect(a, b)), F.sqrt(F.size(a) * F.size(b))), a, b, threshold=threshold)


def word_grams(values: Column, n: int = 2, pad: bool = True) -> Column:
    """Character n-grams within words; with pad, of words with a space on both sides."""
    words = F.filter(F.split(F.concat_ws(" ", values), " "), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" "))) if pad else words
    return F.flatten(F.transform(padded, lambda w: F.when(F.length(w) >= n, F.transform(F.sequence(F.lit(1), F.length(w) - (n - 1)), lambda i: F.substring(w, i, F.lit(n)))).otherwise(F.array(w))))


def count_cosine(a: Column, b: Column) -> Column:
    """Cosine of the counts of two lists' elements."""
    count = lambda g, k: F.size(F.filter(g, lambda y: y == k))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda t, x: t + x)
    dot = total(F.transform(F.array_intersect(a, b), lambda k: (count(a, k) * count(b, k)).cast("double")))
    norm = lambda g: F.sqrt(total(F.transform(F.array_distinct(g), lambda k: F.pow(count(g, k), 2))))
    return F.try_divide(dot, norm(a) * norm(b))


def string_kernel(a: Column, b: Column, n: int = 2, threshold: float | None = None) -> Column:
    return _score(count_cosine(word_grams(_present(a), n), word_grams(_present(b), n)), a, b, threshold=threshold)


def similar_strings(a: Column, b: Column, algorithm: str = "levenshtein", analyzer: str | None = None, n: int = 2, threshold: float | None = None) -> Column:
    """analyzer of the cosine: 'tokens' (sets as they are), 'char_wb' (grams in padded words), 'char' (grams over all), 'word'."""
    if algorithm == "levenshtein":
        return levenshtein(a, b, threshold)
    if algorithm != "cosine":
        raise ValueError(f"no such algorithm: {algorithm}")
    if analyzer in (None, "tokens"):
        return token_cosine(a, b, threshold)
    if analyzer == "char_wb":
        return string_kernel(a, b, n, threshold)
    if analyzer == "word":
        words = lambda v: F.filter(F.split(F.lower(F.concat_ws(" ", _present(v))), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) > 1)
        return _score(count_cosine(words(a), words(b)), a, b, threshold=threshold)
    if analyzer == "char":
        grams = lambda v: word_grams(F.array(F.translate(F.concat_ws(" ", _present(v)), " ", "\u0001")), n, pad=False)
        return _score(count_cosine(grams(a), grams(b)), a, b, threshold=threshold)
    raise ValueError(f"no such analyzer: {analyzer}")


def similar_dates(a: Column, b: Column) -> Column:
    """a, b: arrays of parsed dates (see functions.dates). The best share of leading parts that agree."""
    best = F.array_max(F.flatten(F.transform(_present(a), lambda x: F.transform(_present(b), lambda y: similarity(x, y)))))
    return _score(best, a, b)


def _split(values: Column) -> Column:
    return F.array_distinct(F.filter(F.flatten(F.transform(_present(values), lambda x: F.split(x, " "))), lambda w: w != ""))


def shared_tokens(a: Column, b: Column, low_words: Sequence[str] = BAND_WORDS) -> Column:
    """Shared over all tokens, those of low_words counting a tenth; the target's elements are split at spaces."""
    a, t = _present(a), _split(b)
    both = F.array_intersect(a, t)
    low = F.size(F.array_intersect(both, literals(low_words)))
    return _score(F.try_divide(F.size(both) - 0.9 * low, F.size(F.array_union(a, t))), a, b)


def shared_tokens_plus(a: Column, b: Column, stop_words: Sequence[str] = ()) -> Column:
    """Shared over the smaller side's tokens; both sides lower-cased, split and without stop words."""
    words = lambda v: F.array_except(_split(F.transform(_present(v), F.lower)), literals(stop_words))
    x, y = words(a), words(b)
    return _score(F.try_divide(F.size(F.array_intersect(x, y)), F.least(F.size(x), F.size(y))), a, b)


def shared_occupations(a: Column, b_expanded: Column) -> Column:
    """b_expanded: the target's occupations with their sub- and superclasses (expand_occupations)."""
    x, y = _present(a), _present(b_expanded)
    return _score(F.try_divide(F.size(F.array_intersect(x, y)), F.least(F.size(x), F.size(y))), a, b_expanded)


def expand_occupations(rows: DataFrame, expansion: DataFrame, key: str, column: str = "occupations", out: str = "occupations_expanded") -> DataFrame:
    """rows with each occupation replaced by all classes related to it (closure.expansion: node, related)."""
    long = rows.select(key, F.explode(column).alias("node")).distinct().join(expansion, "node", "left")
    wide = long.select(key, F.explode(F.coalesce("related", F.array("node"))).alias("q")).groupBy(key).agg(F.array_sort(F.collect_set("q")).alias(out))
    return rows.join(wide, key, "left")


#: name -> (function, source column, target column). Own features are added here or passed to vectors().
FEATURES: dict[str, tuple[Callable[[Column, Column], Column], str, str]] = {
    "name_exact": (exact_match, "name", "name"),
    "url_exact": (exact_match, "url", "url"),
    "url_tokens_shared": (shared_tokens, "url_tokens", "url_tokens"),
    "url_tokens_shared_plus": (lambda a, b: shared_tokens_plus(a, b, URL_STOP_WORDS), "url_tokens", "url_tokens"),
    "born_similar": (similar_dates, "born", "born"),
    "died_similar": (similar_dates, "died", "died"),
    "name_levenshtein": (levenshtein, "name", "name"),
    "name_string_kernel_cosine": (string_kernel, "name_tokens", "name_tokens"),
    "name_tokens_shared": (shared_tokens, "name_tokens", "name_tokens"),
    "description_cosine": (token_cosine, "description_tokens", "description_tokens"),
    "occupations_shared": (shared_occupations, "occupations", "occupations_expanded"),
    "genres_tokens_shared": (shared_tokens_plus, "genres", "genres"),
}
#: The reference form of the name's edit distance: one source token against the target's joined tokens.
TOKEN_LEVENSHTEIN = {"name_tokens_levenshtein": (lambda a, b: levenshtein(a, F.array(F.concat_ws(" ", b))), "name_tokens", "name_tokens")}


def vectors(pairs: DataFrame, source: DataFrame, target: DataFrame, features: dict | None = None, source_key: str = "qid", target_key: str = "tid") -> DataFrame:
    """pairs with one DOUBLE column per feature; a feature whose columns a side lacks is 0.0, so the width is the same everywhere.

    Only the columns in use are joined; pairs are made distinct first, so that arrays travel once per pair."""
    features = FEATURES if features is None else features
    s_cols = sorted({s for _, s, _ in features.values() if s in source.columns})
    t_cols = sorted({t for _, _, t in features.values() if t in target.columns})
    s = source.select(source_key, *[F.col(c).alias(f"s_{c}") for c in s_cols])
    t = target.select(target_key, *[F.col(c).alias(f"t_{c}") for c in t_cols])
    rows = pairs.select(source_key, target_key).distinct().join(s, source_key).join(t, target_key)
    made = [f(F.col(f"s_{a}"), F.col(f"t_{b}")).alias(n) if a in s_cols and b in t_cols else F.lit(MISSING).alias(n) for n, (f, a, b) in features.items()]
    return rows.select(source_key, target_key, *made)
