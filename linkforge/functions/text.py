"""Normalised text and tokens, as Column expressions that stay in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# English stop words (a public-domain list for English stemming, apostrophes cut).
STOP_WORDS = tuple(
    "a about above after again against all am an and any are aren as at be because been before being below between both but by "
    "cannot could couldn did didn do does doesn doing down during each few for from further had hadn has hasn have haven having he "
    "her here hers herself him himself his how i if in into is isn it its itself ll me more most mustn my myself no nor not of off on "
    "once only or other ought our ours ourselves out over own re same shan she should shouldn so some such than that the their theirs "
    "them themselves then there these they this those through to too under until up ve very was wasn we were weren what when where "
    "which while who whom why with won would wouldn you your yours yourself yourselves".split()
)
# Words that count little in names of bands.
BAND_WORDS = tuple(
    "band big blues boys brothers chamber choir chorus club del der die duo ensemble five four group jazz les los music orchester "
    "orchestra orchestre quartet quintet radio singers string studio symphony trio van".split()
)
# Letters that aren't a base letter with a mark, or have two letters in ASCII.
DIGRAPHS = {"ä": "ae", "æ": "ae", "ö": "oe", "ø": "oe", "ü": "ue", "ß": "ss", "ð": "dh", "þ": "th", "đ": "d", "ħ": "h", "ł": "l", "ŧ": "t", "ƒ": "f", "µ": "u"}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "j", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o",
    "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "c", "ч": "ch", "ш": "sh", "щ": "sch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "ju", "я": "ja",
}
#: Latin letters of these blocks lose their marks: Latin-1, Extended-A and -B, Extended Additional.
BLOCKS = ((0xC0, 0x24F), (0x1E00, 0x1EFF))


def _marked() -> dict[str, str]:
    out = {}
    for first, last in BLOCKS:
        for c in map(chr, range(first, last + 1)):
            base, *marks = unicodedata.normalize("NFD", c)
            if c.islower() and c not in DIGRAPHS and marks and base.isascii() and all(map(unicodedata.combining, marks)):
                out[c] = base
    return out


TABLE = {**_marked(), **DIGRAPHS, **CYRILLIC}
SINGLE = {k: v for k, v in TABLE.items() if len(v) <= 1}
SEVERAL = {k: v for k, v in TABLE.items() if len(v) > 1}
#: translate() drops what has no counterpart, so letters for nothing come last
SINGLE_FROM = "".join(sorted(SINGLE, key=lambda k: (SINGLE[k] == "", k)))
SINGLE_TO = "".join(SINGLE[k] for k in SINGLE_FROM)
SPLIT = r"[^\p{L}\p{N}_]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it many times: inside body it's a bound variable, which Catalyst can't inline."""
    return F.element_at(F.transform(F.array(value), body), 1)


# White space that a text is stripped of.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def normalize(text: Column) -> Column:
    """Stripped, lower-cased and in ASCII as far as Latin and Cyrillic letters go; other scripts stay."""

    def ascii_(plain: Column) -> Column:
        out = F.translate(plain, SINGLE_FROM, SINGLE_TO)
        for k, v in SEVERAL.items():
            out = F.replace(out, F.lit(k), F.lit(v))
        return F.when(F.octet_length(plain) > F.char_length(plain), out).otherwise(plain)

    return let(F.lower(strip(text)), ascii_)


def literals(words: Sequence[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def tokenize(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """The sorted distinct tokens of the normalised text, two characters or longer and no stop words; null for null."""
    parts = F.filter(F.split(normalize(text), SPLIT), lambda t: F.length(t) > 1)
    return F.sort_array(F.array_except(parts, literals(stop_words)))


def normalize_values(values: Column) -> Column:
    """Distinct normalised values, sorted; null if none is left."""
    out = F.sort_array(F.array_distinct(F.filter(F.transform(values, normalize), lambda x: F.coalesce(x, F.lit("")) != "")))
    return F.when(F.size(out) > 0, out)


def tokenize_values(values: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """All values' tokens, distinct and sorted; null if there are none."""
    out = F.sort_array(F.array_distinct(F.flatten(F.transform(F.filter(values, lambda x: x.isNotNull()), lambda x: tokenize(x, stop_words)))))
    return F.when(F.size(out) > 0, out)


def split_single(values: Column) -> Column:
    """Occupations: a list of one value is a text with spaces between values. Distinct and sorted, empty for null."""
    one = F.filter(F.split(F.get(values, F.lit(0)), " "), lambda x: x != "")
    out = F.when(F.size(values) == 1, one).otherwise(values)
    return F.coalesce(F.sort_array(F.array_distinct(F.filter(out, lambda x: x.isNotNull() & (x != "")))), F.array().cast("array<string>"))


def no_value(values: Column) -> Column:
    """True where a list is null, empty or holds nothing but nulls."""
    return F.coalesce(F.size(F.filter(values, lambda x: x.isNotNull())), F.lit(0)) <= 0


def json_line(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def soundex(text: Column) -> Column:
    """The phonetic code of a normalised name."""
    return F.soundex(normalize(text))
