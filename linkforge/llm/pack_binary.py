"""Operator 7: packing by power-of-two decomposition.

Each document (its ids, then id `eos`) is cut into pieces whose lengths are powers of two: as many of `longest` as
fit, then the binary digits of the rest from the largest. A piece is a sequence by itself, so no sequence crosses
documents and, its length being a power of two, none is padded; sequences of one length form a bucket, named by the
power of two (`bucket`); write_buckets() gives a folder for each.

Ids are those of the tokenizer's encode(): the content of an added token within a text is that token's id. Null text
counts as empty: one piece with `eos` alone. Texts of any length are cut alike, as one row of work. Repeated rows are
packed each for itself. Null doc_ids are kept. A sequence_id is unique in its table, no more. Empty tables give empty
ones; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: str.split() takes these four for white space, the tokenizer doesn't.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
BREAKS = re.compile(r"[ \t\n\r]+")
#: ASCII and composed Latin letters: in normal form already, and lower-cased one by one (but for the dotted I).
PLAIN = re.compile(r"[!-~\u00c0-\u012f\u0131-\u017e]*")
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u017e0-9]+")

#: The tokenizer's own settings that the three patterns above rely on.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def chunks_of(text: str) -> list[str]:
    return BREAKS.split(text) if any(c in text for c in SEPARATORS) else text.split()


def _visible() -> dict[int, int]:
    """Bytes that a byte-level vocabulary writes as other characters."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in shown)}


class Pieces(dict):
    """Match of the tokenizer's pattern, in its byte characters -> ids as little-endian 32-bit bytes."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, piece: str) -> bytes:
        out = self[piece] = array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
        return out


class Chunks(dict):
    """Text without white space -> its ids; bounded. No match of the tokenizer's pattern and no normalisation spans
    white space, so a text's ids are those of its chunks in turn."""

    def __init__(self, path: str, most: int = 250_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.pieces, self.visible = Pieces(self.tokenizer.model), _visible()
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        #: Added tokens that no chunk shows: across white space, or sought in normalised text.
        self.whole = any(t.normalized or len(chunks_of(f"|{t.content}|")) > 1 for t in added)
        made = json.loads(self.tokenizer.to_str())
        #: Chunks and PIECES stand for this normaliser, this pattern and a plain model; with any other each text is encoded whole.
        self.whole |= made["normalizer"] != NORMALIZER or made["pre_tokenizer"] != PRE_TOKENIZER or made["model"].get("dropout") is not None
        self.marks = re.compile("|".join(re.escape(t.content) for t in added) or "(?!)")

    def encoded(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if self.marks.search(chunk):
            out = self[chunk] = self.encoded(chunk)
            return out
        if PLAIN.fullmatch(chunk):
            found = PIECES.findall(chunk.lower())
            if not chunk.isascii():
                found = [p.encode().decode("latin-1").translate(self.visible) for p in found]
        else:
            t = self.tokenizer
            found = [p for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(chunk))]
        out = self[chunk] = b"".join(map(self.pieces.__getitem__, found))
        return out

    def shrink(self, most: int | None = None) -> None:
        for memo in (self, self.pieces):
            if len(memo) > (self.most if most is None else most):
                memo.clear()

    def ids(self, text: str) -> bytes:
        return self.encoded(text) if self.whole else b"".join(map(self.__getitem__, chunks_of(text)))


_CHUNKS: dict[str, Chunks] = {}


def binary_cuts(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    out = [(i * longest, longest) for i in range(n // longest)]
    at = n - n % longest
    for bit in range(longest.bit_length() - 2, -1, -1):
        if n % longest >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def pack(docs: DataFrame, path: str, longest: int = 2048, eos: int = 1, ids: bool = False) -> DataFrame:
    """Pieces of docs (doc_id, text). longest: a power of two. ids=True: with the ids of each piece."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = np.array([eos], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _CHUNKS:
            _CHUNKS[path] = Chunks(path)
        memo = _CHUNKS[path]
        for b in batches:
            rows, texts = [], [t if isinstance(t, str) else "" for t in b["text"]]
            ended = 0
            for i in range(0, len(texts), 256):
                memo.shrink()
                for t in texts[i : i + 256]:
                    got = memo.ids(t) + end
                    n = len(got) // 4
                    for start, length in binary_cuts(n, longest):
                        x = got[4 * start : 4 * (start + length)]
                        rows.append((ended, start, length, zlib.crc32(x), n, *([np.frombuffer(x, "<u4").astype("int64")] if ids else [])))
                    ended += 1
            out = pd.DataFrame(rows, columns=["i", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * ids])
            out.insert(0, "doc_id", b["doc_id"].to_numpy()[out.pop("i").to_numpy(dtype="int64")])
            yield out
        memo.shrink(0)  # the worker lives on for other steps

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * ids
    return (
        docs.select("doc_id", "text").mapInPandas(run, schema)
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
        .withColumn("bucket", F.round(F.log2("length")).cast("int"))
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """A folder for each length, for training with batches of one length."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)


def op7_pack_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("word_bpe_49k.json"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return pack(docs, P.path("word_bpe_49k.json"))


QUERIES = {"op7_pack_binary": op7_pack_binary}
SQL: dict[str, str] = {}
