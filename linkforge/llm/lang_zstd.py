"""Operator 4: language identification by compression.

For each language a raw-content zstandard dictionary is made of a bounded sample of its training rows; a text is
compressed with every dictionary, and the language whose result is smallest wins. Results within 3 bytes of the smallest
are compressed at further levels too, and the sums decide. `rejected` marks narrow margins; the contract wants a
learned language even then.

Training rows: lang and text not null and crc32(doc_id as text) mod 5 not 0. Of each language up to `per_lang` rows are
drawn by a hash of id and text, a piece from anywhere in each, and `dict_bytes` bytes of these used: both bounds are
parameters, and these pieces are all that reaches the driver. Every language of the training rows is learned. Text that
is null or has no letter (Unicode categories L): `und`, score 0. Ties: the first language by name. Texts of any length
are compressed whole. Rows with a null doc_id are not held out and not learned from. Repeated rows give repeated
results and are drawn once. Empty tables learn nothing and give empty ones; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEVELS = (6, 1, 3, 9, 12)
CLOSE = 3


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, per_lang: int = 200, dict_bytes: int = 64_000) -> dict[str, bytes]:
    """Language -> dictionary content, of pieces from anywhere in the sampled texts. Sampled and cut by hashes of id and
    text, so it's the same whatever the partitions."""
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**40)).alias("draw")
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("lang", "text", draw)
    counts = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # pieces of twice the length that would fill the dictionary, as characters may be fewer than bytes or texts shorter
    rows = train.join(F.broadcast(counts), "lang").where(F.col("draw") / F.lit(float(2**40)) < 1.5 * per_lang / F.col("n"))  # a row per language
    n = F.greatest(F.lit(256), F.floor(2.0 * dict_bytes / F.least(F.col("n"), F.lit(per_lang)))).cast("int")
    start = F.pmod(F.xxhash64("draw"), F.greatest(F.length("text") - n, F.lit(0)) + 1).cast("int")
    pieces = rows.select("lang", "draw", F.substring("text", start + 1, n).alias("piece")).groupBy("lang", "draw").agg(F.min("piece").alias("piece"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))  # about 1.5 times per_lang rows of each
    got: dict[str, list[str]] = {}
    for r in pieces.withColumn("place", place).where(F.col("place") <= per_lang).orderBy("lang", "place").collect():
        got.setdefault(r["lang"], []).append(r["piece"])
    out = {}
    for lang, texts in got.items():
        parts = [t.lower().encode(errors="replace") for t in texts]
        each = dict_bytes // len(parts)
        # an equal part of each last, as what is nearest costs least; what else they hold before it
        content = b"\n".join([*(p[each:] for p in parts), *(p[:each] for p in parts)])
        out[lang] = content[-dict_bytes:].decode(errors="ignore").encode()
    return out


class Classifier:
    def __init__(self, content: dict[str, bytes]):
        import zstandard

        self.coders = {}
        for lang in sorted(content):
            for level in LEVELS:
                d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=level)
                self.coders.setdefault(lang, []).append(zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is the margin to the second, as a share of its size."""
        if not isinstance(text, str) or not self.coders or not any(map(str.isalpha, text)):
            return "und", 0.0
        data = text.lower().encode(errors="replace")
        size = sorted((len(c[0].compress(data)), lang) for lang, c in self.coders.items())
        if len(size) == 1:
            return size[0][1], 1.0
        if size[1][0] - size[0][0] <= CLOSE:  # whole bytes are coarse for short texts: other searches for matches add to them
            near = [(n + sum(len(c.compress(data)) for c in self.coders[lang][1:]), n, lang) for n, lang in size if n - size[0][0] <= CLOSE]
            best, other = sorted(near)[:2]
            return best[2], min(1.0, (best[0] != other[0]) * max(0, other[1] - best[1]) / max(1, other[1]))
        return size[0][1], min(1.0, (size[1][0] - size[0][0]) / size[1][0])


def identify(docs: DataFrame, content: dict[str, bytes], narrow: float = 0.01) -> DataFrame:
    """narrow: margins below it are rejected."""
    made: list[Classifier] = []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not made:
            made.append(Classifier(content))
        for b in batches:
            got = [made[0].predict(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "lang_pred": [x for x, _ in got], "score": [float(s) for _, s in got], "rejected": [s < narrow for _, s in got]})

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op4_lang_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, fit(docs))


QUERIES = {"op4_lang_zstd": op4_lang_zstd}
SQL: dict[str, str] = {}
