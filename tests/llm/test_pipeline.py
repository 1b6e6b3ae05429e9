"""The pipeline against a plain version of its five stages, and on dirty rows."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest
from test_near import brute
from test_texts import near_lines, plain_distances, repeated_windows, winnowed

from linkforge.llm import pack_binary, quality_mcd

P = pytest.importorskip("public_tokenizers")


def corpus():
    """Documents of a few lines in two languages and sources, with every kind of copy, and junk."""
    r = random.Random(11)
    vocabulary = {k: [f"{k}{''.join(r.choice('abcdefghijklmnop') for _ in range(r.randrange(1, 8)))}" for _ in range(900)] for k in ("a", "b")}
    line = lambda k, n: " ".join(r.choice(vocabulary[k]) + ("." if r.random() < 0.1 else "") for _ in range(n))
    short = lambda k: line(k, r.randrange(3, 9))
    passages = {k: [line(k, n) for n in (55, 70, 120)] for k in vocabulary}
    blocks = {k: [short(k) for _ in range(4)] for k in vocabulary}
    docs = []
    for i in range(120):
        k = "ab"[i % 2]
        lines = [short(k) for _ in range(r.randrange(9, 16))]
        if i % 7 == 1:
            lines.insert(3, f"{line(k, 5)} {passages[k][i % 3]} {line(k, 6)}")
        if i % 9 == 2:
            lines[2:2] = blocks[k]
        docs.append("\n".join(lines))
    for i in (5, 8, 20):
        docs.append(docs[i])
    for i in (30, 31, 33):
        docs.append(" ".join(w if j % 40 else "edited" for j, w in enumerate(docs[i].split(), 1)))
    docs += [" ".join(f"{w}###$$$" for w in docs[40].split()), "too few words", "again and again " * 30, ""]
    return [(i, t, "ab"[i % 2], f"s{i // 2 % 2}", len(t)) for i, t in enumerate(docs)]


def plain(spark, rows):
    """doc_id -> text that is packed."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stats = quality_mcd.statistics(df).toPandas()
    good = stats[~stats["base_failed"]]
    kept = set()
    for _, own in good.groupby(["lang", "source"]):
        assert len(own) >= 15
        d = plain_distances(own[list(quality_mcd.X)].to_numpy())
        kept |= set(own["doc_id"][d <= quality_mcd.CHI2_TAIL])
    docs = [(d, t) for d, t, *_ in rows if d in kept]
    docs = [(d, t) for d, t in winnowed(docs).items() if t.strip() or t == dict(docs)[d]]
    component = brute(docs, 5)
    docs = [(d, t) for d, t in docs if component[d] == d]
    gone = repeated_windows(docs, 30)
    for d, own in gone.items():  # up to four words between repeated ones go with them
        for a, b in itertools.pairwise(sorted({*own})):
            own |= set(range(a, b)) if b - a <= 5 else set()
    for d, a, n, _ in near_lines(docs):
        gone[d] |= set(range(a, a + n))
    left = {}
    for d, t in docs:
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        keep = "".join(t[a : words[i + 1][0] if i + 1 < len(words) else len(t)] for i, (a, _) in enumerate(words) if i not in gone[d])
        left[d] = keep if gone[d] else t
    return {d: t for d, t in left.items() if t.strip() or not gone[d]}


def test_pipeline_equals_a_plain_one(spark, tmp_path):
    import corpus_pipeline as c
    from tokenizers import Tokenizer

    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    want = plain(spark, rows)
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    pieces = set()
    for d, t in want.items():
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 1]
        pieces |= {(d, a, n, zlib.crc32(np.array(ids[a : a + n], dtype="<u4").tobytes()), len(ids)) for a, n in pack_binary.binary_cuts(len(ids), 2048)}
    got = {(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in c.run(spark, str(tmp_path)).collect()}
    assert got == pieces
    assert 90 < len(want) < len(rows) and not {126, 127, 128, 129} & {*want}


def test_dirty_rows_pass_all_stages(spark, tmp_path):
    import corpus_pipeline as c

    long = " ".join(f"word{i % 7919}x{i % 13}" for i in range(30_000))
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", None, "x", 1) for i, t in enumerate([None, "", " ", "\n\n", "one", long, "the same text of ten words and more, as it must\nbe"] * 2)]
    rows += [rows[6], (None, "no id but a text of ten words and more as it must be", "en", "s", 1, "x", 1), (6, "another text under an id that is there already, of ten words", "de", "s", 1, "x", 1)]
    for n, part in (("some", rows), ("none", rows[:0])):
        spark.createDataFrame(part, "doc_id long, text string, lang string, source string, n_chars long, spans string, n_deleted int").repartition(3).write.parquet(str(tmp_path / n / "documents.parquet"))
    got = c.run(spark, str(tmp_path / "some")).select("doc_id").distinct().collect()
    assert {r["doc_id"] for r in got} == {5, 6, None}
    assert c.run(spark, str(tmp_path / "none")).count() == 0
    assert len(c.STAGES) == 5
