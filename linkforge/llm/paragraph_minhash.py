"""Operator 10: substring deduplication by MinHash banding of paragraphs.

A paragraph is a line of `least` words or more. Each has the set of its 5-word shingles, `bands` tables of `rows`
minhashes (a pair at a similarity of 0.8 shares no table with a chance of 0.2 %); colliding paragraphs are verified by
exact Jaccard on their sets and joined into components (see linking). The first place of each component stays, the
other paragraphs go.

Passages are often pasted into running text, so lines are no reliable unit for them. Beside its lines a text is
therefore cut into small pieces at content-defined places: a cut stands between two words whose joint hash is the
smallest within `reach` places on both sides, at both ends of a stretch of one word, and `longest` words after the last
cut at the latest (in such a stretch `least` words, so of one word fewer than that may stay). Cuts depend only on the words around them, so a passage is cut alike wherever it stands: of 51
words, 99.9 % hold a whole piece in any surroundings, of 40 words 99 %. A piece that stands earlier is held against its
first place; pieces that follow each other there as here are one run, which is extended word by word on both sides
over up to `longest` words, as whole pieces beyond that have matched themselves. Runs that only `gap` words or fewer
part, here and there, are one where 4/5 of its words agree. Runs of `least` words or more go, shorter ones stay: they
are too common to be copies, and line deduplication is for those.

Earlier: in a text with a smaller doc_id, or the same one and a smaller hash. What a text repeats of itself stays, as
that is no copy between documents (quality rules see to it); with within=True it goes but for its first place. Of equal texts under several doc_ids the first alone is
searched; the others go as a whole. Words are compared with A-Z in lower case; deleted runs leave the white space
before them. Null and empty texts, texts under `least` words and rows with a null doc_id stay as they are. Texts of any
length are searched whole; a very long one is one row of work. Repeated rows (same doc_id and text) are one document
and stay alike; rows that share only a doc_id are told apart by their texts. Empty tables give empty ones. Extra
columns stay; a column n_removed is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from linkforge.llm.common import _MEMO, M1, M2, Scratch, bitmap, keep, maybe_in, mix, pick, shingle_hashes, small, word_hashes
from linkforge.llm.linking import batches, verified_components
from linkforge.llm.near_minhash import group_minhashes

REACH, LONGEST, BANDS, ROWS, LEAST, GAP, K = 5, 48, 6, 2, 30, 4, 5
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def piece_starts(h: np.ndarray, doc: np.ndarray, reach: int = REACH, longest: int = LONGEST) -> np.ndarray:
    """Starts of pieces in the words of many documents; doc: the number of each word's document, ascending."""
    n = len(h)
    if not n:
        return np.empty(0, dtype=np.int64)
    joint = mix(h[:-1] * M1 + h[1:] * M2)
    together = doc[:-1] == doc[1:]
    ok = together.copy()
    for s in range(1, reach + 1):  # the leftmost of equals; places in other documents don't count
        same = doc[s:-1] == doc[: -s - 1]
        ok[s:] &= ~same | (joint[s:] < joint[:-s])
        same = doc[:-1][:-s] == doc[s + 1 :]
        ok[:-s] &= ~same | (joint[:-s] <= joint[s:])
    again = np.concatenate([[False], together & (h[:-1] == h[1:]), [False]]).astype(np.int8)
    a, b = np.flatnonzero(np.diff(again) == 1), np.flatnonzero(np.diff(again) == -1) + 1
    a, b = a[b - a > reach], b[b - a > reach]  # stretches of one word
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, a, 1)
    np.add.at(edge, b, -1)
    inside = np.cumsum(edge)[:n] > 0
    firsts = np.flatnonzero(np.diff(doc, prepend=-1))
    cuts = np.flatnonzero(ok) + 1
    starts = np.unique(np.concatenate([firsts, cuts[~(inside[cuts] & inside[cuts - 1])], a, b]))
    starts = starts[starts < n]
    most = np.where(inside[starts], LEAST, longest)
    more = (np.diff(starts, append=n) - 1) // most
    step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    return np.union1d(starts, np.repeat(starts, more) + step * np.repeat(most, more))


def parsed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of many texts, each word's text, and the first words and numbers of words of all lines."""
    hashes, counts, lens = [], [], []
    for t in texts:
        lines = [x.split() for x in t.encode(errors="replace").lower().split(b"\n")]
        own = list(map(len, lines))
        counts += own
        hashes.append(_MEMO.of(list(chain.from_iterable(lines))))
        lens.append(len(hashes[-1]))
    n = np.array(counts, dtype=np.int64)
    return np.concatenate([*hashes, np.empty(0, dtype=np.uint64)]), np.repeat(np.arange(len(texts)), lens), np.cumsum(n) - n, n


def units(known: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, th (the text's hash), a (first word), n (words), f (hash of the words) of all pieces, and of paragraphs
    (g: their bands, k: number of their shingles; null for pieces)."""

    def hashed(h: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
        at = np.repeat(starts, n) + (within := np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        return mix(np.add.reduceat(mix(h[at] + within.astype(np.uint64) * M1), np.cumsum(n) - n) + n.astype(np.uint64)).view(np.int64)

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches(pdfs, 256):
            h, doc, lines, n = parsed(part["text"].tolist())
            if not len(h):
                continue
            ids, ths, begin = part["doc_id"].to_numpy(), part["th"].to_numpy(), np.searchsorted(doc, np.arange(len(part)))
            starts = piece_starts(h, doc)
            sizes = np.diff(starts, append=len(h))
            whole = sizes > REACH
            starts, sizes = starts[whole], sizes[whole]
            if len(starts):
                d = doc[starts]
                yield pd.DataFrame({"doc_id": ids[d], "th": ths[d], "a": (starts - begin[d]).astype("int32"), "n": sizes.astype("int32"), "f": hashed(h, starts, sizes), "k": pd.array([None] * len(d), dtype="Int32"), "g": None})
            long = n >= least
            lines, n = lines[long], n[long]
            if len(lines):
                d, m = doc[lines], n - K + 1
                at = np.repeat(lines, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                flat, first = shingle_hashes(h, K)[at], np.cumsum(m) - m
                g = group_minhashes(flat, first, BANDS, ROWS, 21).view(np.int64)
                k = [len(np.unique(flat[x : x + y])) for x, y in zip(first.tolist(), m.tolist(), strict=True)]
                yield pd.DataFrame({"doc_id": ids[d], "th": ths[d], "a": (lines - begin[d]).astype("int32"), "n": n.astype("int32"), "f": hashed(h, lines, n), "k": pd.array(k, dtype="Int32"), "g": list(g)})

    return known.mapInPandas(run, "doc_id long, th long, a int, n int, f long, k int, g array<long>")


def _known(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def _texts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """found (doc_id, th and more; stored) with the texts; repeated rows come more than once."""
    ids = found.select("doc_id").distinct()
    return _known(pick(docs, ids)).join(found, ["doc_id", "th"])


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, th of texts that stand under a smaller doc_id too, and the smallest one, d0."""
    ids = _known(docs).select("doc_id", "th").distinct()
    first = ids.groupBy("th").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("x")).where("d0 <> x").select("th", "d0")
    return ids.join(first, "th").where("doc_id > d0")


PLACE = ["doc_id", "th", "a"]


def near_paragraphs(docs: DataFrame, paragraphs: DataFrame, within: bool = False) -> DataFrame:
    """doc_id, th, a, n of paragraphs equal or similar to an earlier one, and the document d0 of the component's first."""

    def sets(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches(pdfs, 256):
            out = []
            for text, want in zip(part["text"], part["want"], strict=True):
                h = word_hashes(text)
                out += [(w["id"], np.unique(shingle_hashes(h[w["a"] : w["a"] + w["n"]], K)).view(np.int64)) for w in want]
            yield pd.DataFrame(out, columns=["id", "s"])

    with Scratch(docs.sparkSession) as t:
        place = F.struct(*PLACE)
        keys = paragraphs.select(F.posexplode("g").alias("i", "x"), F.col("f").alias("id")).select(F.xxhash64("i", "x").alias("key"), "id")
        first = paragraphs.groupBy(F.col("f").alias("id")).agg(F.min(F.struct(*PLACE, "n")).alias("p"), F.max("k").cast("long").alias("n"))
        first = t.store(first)

        def sets_of(ids: DataFrame) -> DataFrame:
            wanted = first.join(ids, "id", "left_semi").groupBy("p.doc_id", "p.th").agg(F.collect_list(F.struct(F.col("p.a").alias("a"), F.col("p.n").alias("n"), "id")).alias("want"))  # a document's at most
            return _texts(docs, t.store(wanted)).select("text", "want").mapInPandas(sets, "id long, s array<long>")

        comps = verified_components(keys, first.select("id", "n"), sets_of).withColumnRenamed("id", "f")
        found = t.store(paragraphs.select(*PLACE, "n", "f").join(comps, "f", "left").select(*PLACE, "n", F.coalesce("comp", "f").alias("comp")).distinct())
        kept = found.groupBy("comp").agg(F.min(place).alias("p"), F.max(place).alias("x")).where("p <> x").select("comp", "p")
        later = place > F.col("p") if within else ~((F.col("doc_id") == F.col("p.doc_id")) & (F.col("th") == F.col("p.th")))
        return t.keep(found.join(kept, "comp").where(later).select(*PLACE, "n", F.col("p.doc_id").alias("d0")))


def chains(pieces: list) -> list[tuple[int, int, int, int, int, int]]:
    """Pieces (a, n, d0, t0, a0) of a text -> (a, b, d0, t0, a0, b0): those that follow each other here and there are one."""
    out: list[list[int]] = []
    for p in sorted(pieces, key=lambda p: p["a"]):
        a, n, d0, t0, a0 = (int(p[x]) for x in ("a", "n", "d0", "t0", "a0"))
        if out and out[-1][1] == a and out[-1][2] == d0 and out[-1][3] == t0 and out[-1][5] == a0:
            out[-1][1], out[-1][5] = a + n, a0 + n
        else:
            out.append([a, a + n, d0, t0, a0, a0 + n])
    return [tuple(x) for x in out]


def repeated_runs(docs: DataFrame, pieces: DataFrame, within: bool = False) -> DataFrame:
    """doc_id, th, runs: chains of pieces that stand earlier, with the words around their first place (pre: nearest first)."""

    def chained(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in pdfs:
            out = [(d, th, *c) for d, th, p in zip(x["doc_id"].tolist(), x["th"].tolist(), x["pieces"], strict=True) for c in chains(p)]
            yield pd.DataFrame(out, columns=["doc_id", "th", "a", "b", "d0", "t0", "a0", "b0"])

    def around(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches(pdfs, 256):
            out = []
            for d, th, text, want in zip(part["doc_id"].tolist(), part["th"].tolist(), part["text"], part["want"], strict=True):
                h = word_hashes(text).view(np.int64)
                out += [(d, th, w["a0"], w["b0"], h[max(0, w["a0"] - LONGEST) : w["a0"]][::-1], h[w["b0"] : w["b0"] + LONGEST]) for w in want]
            yield pd.DataFrame(out, columns=["d0", "t0", "a0", "b0", "pre", "post"])

    with Scratch(docs.sparkSession) as t:
        place = F.struct(*PLACE)
        first = t.store(pieces.groupBy("f").agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("c")).where("c > 1").select("f", F.col("p.doc_id").alias("d0"), F.col("p.th").alias("t0"), F.col("p.a").alias("a0")))
        often = maybe_in(pieces.select(*PLACE, "n", "f"), "f", bitmap(first, "f"))
        later = often.join(first, "f").where(place > F.struct("d0", "t0", "a0") if within else (F.col("doc_id") != F.col("d0")) | (F.col("th") != F.col("t0")))
        per = later.groupBy("doc_id", "th").agg(F.collect_set(F.struct("a", "n", "d0", "t0", "a0")).alias("pieces"))  # a document's at most
        runs = t.store(per.mapInPandas(chained, "doc_id long, th long, a int, b int, d0 long, t0 long, a0 int, b0 int"))
        t.drop(first)
        wanted = t.store(runs.groupBy(F.col("d0").alias("doc_id"), F.col("t0").alias("th")).agg(F.collect_set(F.struct("a0", "b0")).alias("want")))
        beside = t.store(_texts(docs, wanted).mapInPandas(around, "d0 long, t0 long, a0 int, b0 int, pre array<long>, post array<long>"))
        at = ["d0", "t0", "a0", "b0"]
        joined = runs.join(beside, at).select("doc_id", "th", F.struct("a", "b", F.col("d0").alias("of"), F.col("t0").alias("of_th"), "a0", "b0", "pre", "post").alias("r"))
        return t.keep(joined.groupBy("doc_id", "th").agg(F.collect_list("r").alias("runs")))


def removable(docs: DataFrame, least: int = LEAST, within: bool = False) -> DataFrame:
    """doc_id, th and what to delete: whole (its words stand in this document), runs (see repeated_runs) and near
    paragraphs."""
    with Scratch(docs.sparkSession) as t:
        again = t.store(copies(docs))
        known = _known(docs).join(small(again).select("doc_id", "th"), ["doc_id", "th"], "left_anti")
        found = t.store(units(known, least))
        runs = repeated_runs(docs, found.where("k is null"), within)
        near = near_paragraphs(docs, found.where("k is not null"), within)
        t.drop(found)
        per = near.groupBy("doc_id", "th").agg(F.collect_set(F.struct("a", (F.col("a") + F.col("n")).alias("b"), F.col("d0").alias("of"))).alias("near"))
        both = runs.join(per, ["doc_id", "th"], "full").withColumn("whole", F.lit(None).cast("long"))
        return t.keep(both.unionByName(again.select("doc_id", "th", F.col("d0").alias("whole")), allowMissingColumns=True))


def extended(h: np.ndarray, own: tuple[int, int], runs: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(first word, word after the last, document that keeps it) of the runs of least words or more, after extension
    over words that agree and over short gaps. own: doc_id and text hash of this text."""
    h, found = h.view(np.int64), []
    for r in runs:
        a, b, a0, b0 = (int(r[x]) for x in ("a", "b", "a0", "b0"))
        # in the same text a run doesn't reach its own kept place
        most = a - b0 if own == (int(r["of"]), int(r["of_th"])) else len(h)
        left = min(len(r["pre"]), a, max(0, most))
        same = h[a - left : a][::-1] == r["pre"][:left]
        left = left if same.all() else int(same.argmin())
        right = min(len(r["post"]), len(h) - b)
        same = h[b : b + right] == r["post"][:right]
        right = right if same.all() else int(same.argmin())
        found.append(((int(r["of"]), int(r["of_th"])), a - left, b + right, a0 - left, b0 + right))
    out: list[list] = []
    for key, a, b, a0, b0 in sorted(found):
        if out and (c := out[-1])[0] == key and a <= c[2] + GAP and -GAP <= (a0 - a) - (c[4] - c[2]) <= GAP and a0 <= c[4] + GAP:
            agree = c[5] + max(0, b - max(a, c[2]))
            if 5 * agree >= 4 * (max(b, c[2]) - c[1]):
                if b > c[2]:
                    c[2], c[4] = b, b0
                c[5] = agree
                continue
        out.append([key, a, b, a0, b0, b - a])
    return [(a, b, key[0]) for key, a, b, _, _, _ in out if b - a >= least]


def spans(text: str, own: tuple[int, int], whole, runs, near, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(first word, word after the last, document that keeps its first words) of the deleted runs, apart and in order."""
    h = word_hashes(text)
    if whole is not None and whole == whole:
        return [(0, len(h), int(whole))] if len(h) >= least else []
    found = extended(h, own, runs, least) if runs is not None else []
    found += [(int(r["a"]), int(r["b"]), int(r["of"])) for r in near] if near is not None else []
    out: list[tuple[int, int, int]] = []
    for a, b, of in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2])
        else:
            out.append((a, b, of))
    return out


def without(text: str, gone: list[tuple[int, int, int]]) -> str:
    """text without these runs of words and the white space behind each."""
    data = text.encode(errors="replace")
    at = [m.span() for m in WORD.finditer(data)]
    parts, end = [], 0
    for a, b, _ in gone:
        parts.append(data[end : at[a][0]])
        end = at[b][0] if b < len(at) else len(data)
    parts.append(data[end:])
    return b"".join(parts).decode()


def removals(docs: DataFrame, within: bool = False) -> DataFrame:
    """A row per deleted run: doc_id, first_word, n_words, kept_doc_id (the document where its first words stay), md5 of its words."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches(pdfs, 256):
            out = []
            for d, th, text, whole, runs, near in zip(part["doc_id"].tolist(), part["th"].tolist(), part["text"], part["whole"], part["runs"], part["near"], strict=True):
                if got := spans(text, (d, th), whole, runs, near):
                    w = text.encode(errors="replace").lower().split()
                    out += [(d, th, a, b - a, of, hashlib.md5(b" ".join(w[a:b])).hexdigest()) for a, b, of in got]
            yield pd.DataFrame(out, columns=["doc_id", "th", "first_word", "n_words", "kept_doc_id", "words_md5"])

    found = _texts(docs, removable(docs, within=within)).select("doc_id", "th", "text", "whole", "runs", "near")
    return keep(found.mapInPandas(run, "doc_id long, th long, first_word long, n_words long, kept_doc_id long, words_md5 string").distinct().drop("th"))


def dedup(docs: DataFrame, within: bool = False) -> DataFrame:
    """docs with repeated passages taken out of text, and n_removed (words)."""
    docs = docs.drop("n_removed")
    columns = docs.columns
    mine = [f"linkforge {x}" for x in ("id", "th", "whole", "runs", "near")]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in found:
            for i in range(0, whole_batch.num_rows, 256):
                b = whole_batch.slice(i, 256)
                ids, ths, whole, runs, near = (b.column(x).to_pylist() for x in mine)
                texts, n = b.column("text").to_pylist(), []
                for j, text in enumerate(texts):
                    got = spans(text, (ids[j], ths[j]), whole[j], [r | {x: np.array(r[x], dtype=np.int64) for x in ("pre", "post")} for r in runs[j]] if runs[j] is not None else None, near[j]) if ids[j] is not None else []
                    if got:
                        texts[j] = without(text, got)
                    n.append(sum(y - x for x, y, _ in got))
                yield pa.RecordBatch.from_arrays([pa.array(texts, b.schema.field("text").type) if c == "text" else b.column(c) for c in columns] + [pa.array(n, pa.int64())], names=[*columns, "n_removed"])

    found = removable(docs, within=within)
    ids = found.select("doc_id")
    rest = pick(docs, ids, "left_anti").withColumn("n_removed", F.lit(0).cast("long"))
    found = found.select(F.col("doc_id").alias(mine[0]), F.col("th").alias(mine[1]), *[F.col(x.split()[1]).alias(x) for x in mine[2:]])
    hit = pick(docs, ids)
    hit = hit.join(found, (F.col("doc_id").cast("long") == F.col(f"`{mine[0]}`")) & (F.xxhash64("text") == F.col(f"`{mine[1]}`")), "left")
    return rest.unionByName(hit.mapInArrow(run, StructType([*docs.schema.fields, StructField("n_removed", LongType())])))


def op10_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; a document of which nothing is left goes. n_chars, if there, follows the text."""
    out = dedup(docs)
    out = out.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns) if "n_removed" not in docs.columns else out


QUERIES = {"op10_paragraph_minhash": op10_paragraph_minhash}
SQL: dict[str, str] = {}
