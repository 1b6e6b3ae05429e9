"""Operator 6: byte-level BPE by dynamic programming over byte prefixes.

For every prefix of a piece of text the encoding has exactly one valid last token: a token t ending there such
that t may follow the last token of the prefix before it. Storing that one token per prefix gives the encoding of
every prefix, so bytes can be appended exactly, and after an edit only the prefixes from the edit until the table
repeats itself are computed anew.

Nulls are encoded as the empty text (no ids). Invalid or unknown input can't occur: all 256 bytes are tokens.
Repeated rows give repeated results; other columns are ignored by `encode` and left out of its result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


class Vocabulary:
    """Ranks of a byte-level BPE. pair_ok(s, t): whether the encoding of both tokens' bytes is just these two."""

    def __init__(self, path: str, most: int = 300_000):
        self.rank: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                a, b = line.split()
                self.rank[base64.b64decode(a)] = int(b)
        self.bytes = [b""] * (max(self.rank.values()) + 1)
        for k, v in self.rank.items():
            self.bytes[v] = k
        self.text = [str(i) for i in range(len(self.bytes))]
        self.size = list(map(len, self.bytes))
        self.longest = max(self.size)
        self.most, self.pairs = most, {}
        # the reachable tokens, and the two parts that each was merged from last (itself twice for a byte)
        self.own, self.parts, self.joins = {}, [(0, 0)] * len(self.bytes), {}
        for k, v in self.rank.items():
            two = self.merge(k, 2)
            if len(two) <= 2:
                self.own[k] = v
                self.parts[v] = (two[0], two[-1])
                if len(two) == 2:
                    self.joins[two[0], two[1]] = v

    def merge(self, piece: bytes, until: int = 1) -> list[int]:
        """The defining procedure: merge the lowest-ranked neighbours, leftmost first, until none can be merged."""
        rank, parts = self.rank, [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > until:
            low, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (low is None or r < low):
                    low, at = r, i
            if low is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [rank[p] for p in parts]

    def pair_ok(self, s: int, t: int) -> bool:
        ok = self.pairs.get((s, t))
        if ok is None:
            if len(self.pairs) > self.most:
                self.pairs.clear()
            ok = self.pairs[s, t] = self._stays(s, t)
        return ok

    def _stays(self, s: int, t: int) -> bool:
        """Undo the merges beside the border, the latest first; a join across the border that ranks below the merge
        just undone would have come before it, and the two tokens would never have formed."""
        joins, parts, limit = self.joins, self.parts, len(self.bytes)
        left_open, right_open = True, True
        while True:
            over = joins.get((s, t))
            if over is not None and over < limit:
                return False
            left_open, right_open = left_open and parts[s][1] != s, right_open and parts[t][0] != t
            if left_open and (s > t or not right_open):
                limit, s = s, parts[s][1]
            elif right_open:
                limit, t = t + 1, parts[t][0]
            else:
                return True


    def ask(self, data: bytes, end: int, last: list[int]) -> int:
        """last[end] of a prefix table that is filled only where it is asked for; 0 < end, -1: not yet known."""
        own, pairs = self.own, self.pairs
        for start in range(end - self.longest if end > self.longest else 0, end):
            t = own.get(data[start:end])
            if t is not None:
                if start:
                    s = last[start]
                    if s < 0:
                        s = self.ask(data, start, last)
                    ok = pairs.get((s, t))
                    if not (self.pair_ok(s, t) if ok is None else ok):
                        continue
                last[end] = t
                return t
        raise ValueError("no valid last token")

    def encode(self, data: bytes) -> list[int]:
        if len(data) > 256:  # beyond this, without recursion
            return PrefixTable(self, data).tokens()
        last, out, end = [-1] * (len(data) + 1), [], len(data)
        while end:
            t = last[end]
            if t < 0:
                t = self.ask(data, end, last)
            out.append(t)
            end -= self.size[t]
        return out[::-1]


class PrefixTable:
    """last[i]: the last token of the encoding of the first i + 1 bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _at(self, end: int) -> int:
        v, last, data = self.v, self.last, self.data
        own, pairs = v.own, v.pairs
        for start in range(max(0, end - v.longest), end):
            t = own.get(data[start:end])
            if t is None:
                continue
            if not start:
                return t
            s = last[start - 1]
            ok = pairs.get((s, t))
            if ok or ok is None and v.pair_ok(s, t):
                return t
        raise ValueError("no valid last token")

    def append(self, more: bytes) -> None:
        self.data += more
        for end in range(len(self.last) + 1, len(self.data) + 1):
            self.last.append(self._at(end))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put new for the bytes from start to end; the prefixes computed anew are counted."""
        old, tail = self.last, self.data[end:]
        self.data, self.last = self.data[:start] + new + tail, old[:start]
        same = done = 0
        for e in range(start + 1, len(self.data) + 1):
            self.last.append(self._at(e))
            done += 1
            k = e - len(self.data) + len(old) - 1  # the same byte's place before
            # a prefix's token depends on no more than the `longest` entries before it
            same = same + 1 if e > start + len(new) and self.last[-1] == old[k] and self._inside(e, start + len(new)) else 0
            if same >= self.v.longest:
                self.last += old[k + 1 :]
                break
        return done

    def _inside(self, e: int, border: int) -> bool:
        """Whether the last token lies wholly behind the edit."""
        return e - len(self.v.bytes[self.last[e - 1]]) >= border

    def tokens(self, end: int | None = None) -> list[int]:
        out, i = [], len(self.data) if end is None else end
        while i > 0:
            out.append(t := self.last[i - 1])
            i -= len(self.v.bytes[t])
        return out[::-1]


class PieceMemo(dict):
    """Piece of text -> its ids; bounded."""

    def __init__(self, vocabulary: Vocabulary, most: int = 500_000):
        super().__init__()
        self.v, self.most = vocabulary, most

    def __missing__(self, piece: str) -> list[int]:
        b = piece.encode()
        r = self.v.rank.get(b)  # a piece that is a token is that token, as in the library
        out = self[piece] = [r] if r is not None else self.v.encode(b)
        return out


class Encoder:
    def __init__(self, path: str, pattern: str):
        import regex

        self.v = Vocabulary(path)
        self.find = regex.compile(pattern).findall
        self.memo = PieceMemo(self.v)

    def encode(self, text: str | None) -> list[int]:
        if len(self.memo) > self.memo.most:
            self.memo.clear()
        return list(chain.from_iterable(map(self.memo.__getitem__, self.find(text or ""))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.bytes.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, ids: bool = False) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_tokens, digests of the ids and of the decoded bytes, and with ids=True the ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path, pattern)
        for b in batches:
            out = []
            for text in b["text"]:
                got = e.encode(text if isinstance(text, str) else "")
                sha = hashlib.sha256(",".join(map(e.v.text.__getitem__, got)).encode()).hexdigest()
                out.append((len(got), sha, hashlib.sha256(e.decode(got)).hexdigest(), *([got] if ids else [])))
            done = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids])
            done.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield done

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def op6_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of operator 6 SQL can say: decoding gives each text back, byte for byte."""
    return op6_bpe_prefix(spark, sf_dir).select("doc_id", "decoded_sha256")


QUERIES = {"op6_bpe_prefix": op6_bpe_prefix, "bpe_round_trip": bpe_round_trip}
SQL = {"bpe_round_trip": "SELECT doc_id, sha256(coalesce(text, '')) AS decoded_sha256 FROM documents"}
