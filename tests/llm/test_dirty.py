"""Nulls, empty and very long texts, ties, repeated rows, empty tables and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from linkforge.llm import bpe_prefix, chat_perspectives, embedding_codes, lang_zstd, license_scan, line_winnow, near_minhash, pack_binary, paragraph_minhash, quality_mcd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, comp string, id int, key string, th string, h long, kept string, a int"
LONG = " ".join(f"word{i % 7919}x{i % 13}" for i in range(60_000))
TEXTS = [None, "", " ", "\n\n", "one", "the same text of a few words here", "the same text of a few words here", "a\nb\nc\nd\na\nb\nc", "que " * 500, LONG, "tab\tand\x0bvertical\x0cfeed\x1cseparator space", "émigré naïve Ünïcode 東京 текст", "a" * 50_000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 4 else None, None, "x", 1, "k", "t", 5, "no", 3) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, "no id at all here", "en", None, 1, "x", 1, "k", "t", 5, "no", 3), (7, "another text under the same id", "de", "s", 1, "x", 1, "k", "t", 5, "no", 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def made(f):
    import public_tokenizers as P

    return {
        "quality": lambda d: quality_mcd.judge(d), "near": lambda d: near_minhash.classes(d), "lang": lambda d: lang_zstd.identify(d, lang_zstd.fit(d)), "license": lambda d: license_scan.scan(d),
        "bpe": lambda d: bpe_prefix.encode(d, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN), "pack": lambda d: pack_binary.pack(d, P.path("word_bpe_49k.json")), "lines": lambda d: line_winnow.dedup(d), "paragraphs": lambda d: paragraph_minhash.dedup(d),
    }[f]


@pytest.mark.parametrize("f", ["quality", "near", "lang", "license", "bpe", "lines", "paragraphs"])
def test_a_row_each(docs, f):
    got = made(f)(docs).collect()
    assert len(got) == docs.count()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in docs.collect())


@pytest.mark.parametrize("f", ["quality", "near", "lang", "license", "bpe", "pack", "lines", "paragraphs"])
def test_empty_table(docs, f):
    assert made(f)(docs.limit(0)).count() == 0
    assert made(f)(docs.where("doc_id < 4")).count() >= 4


def test_stages(spark, docs):
    known = docs.drop("comp", "id", "key", "th", "h", "kept", "a")
    for stage in (quality_mcd.stage, line_winnow.stage, near_minhash.stage, paragraph_minhash.stage):
        out = stage(spark, known, "")
        assert out.columns == known.columns and out.count() <= known.count()
    clashing = known.withColumns({c: F.lit("x") for c in ("spans", "gone_id", "n_deleted", "new_text", "new_id", "n_removed", "th", "runs", "near", "whole", "h")}).drop("n_chars")
    for stage in (quality_mcd.stage, line_winnow.stage, near_minhash.stage, paragraph_minhash.stage):
        out = stage(spark, clashing, "")
        assert {*out.columns} >= {*clashing.columns} - {"n_deleted", "n_removed"} and out.where("new_text <> 'x' or th <> 'x'").count() == 0
    assert line_winnow.dedup(clashing).count() == paragraph_minhash.dedup(clashing).count() == clashing.count()
    for stage in (quality_mcd.stage, line_winnow.stage, near_minhash.stage, paragraph_minhash.stage):
        assert stage(spark, known.limit(0), "").count() == 0
    assert pack_binary.stage(spark, known, "").count() >= known.count()


def test_pack_sums(docs):
    per = made("pack")(docs).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"), F.count(F.lit(1)).alias("k")).where("doc_id not in (5, 7)").collect()
    assert all(r["n"] == r["t"] for r in per)
    assert {r["doc_id"]: r["n"] for r in per}[0] == 1


def test_meaning_of_dirty_rows(docs):
    near = {(r["doc_id"], r["n_shingles"]): r for r in made("near")(docs).collect()}
    assert near[6, 7]["component_id"] == 5 and near[6, 7]["kept"] is False and near[5, 7]["kept"] is True
    assert near[0, 0]["component_id"] == 0 and near[1, 0]["kept"] is True and near[4, 1]["component_id"] == 4
    assert near[None, 4]["kept"] is True and near[None, 4]["component_id"] is None
    q = {r["doc_id"]: r for r in made("quality")(docs).where("doc_id <> 7").collect()}
    assert (q[0]["n_words"], q[0]["base_failed"], q[0]["kept"]) == (0, True, False)
    assert q[8]["n_repeat_words"] == 500 and q[10]["n_words"] == 4
    lang = {r["doc_id"]: r for r in made("lang")(docs).collect()}
    assert lang[0]["lang_pred"] == lang[1]["lang_pred"] == "und" and lang[0]["score"] == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, []), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1.0, 0.1]), (11, [-1.0, 0.0]), (12, [1e-300, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("x"), "m": F.lit("y"), "n": F.lit(0)})
    got = {}
    for r in embedding_codes.classes(v).collect():
        got.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    assert got[1] == [(4, 1, True)] and got[2] == [(4, 1, False)] * 2 and got[10] == [(4, 1, False)] and got[12] == [(4, 1, False)]
    for k in (3, 4, 5, 6, 7, 8, 9, 11):
        assert got[k] == [(0, k, True)]
    assert got[None] == [(0, None, True)]
    assert embedding_codes.classes(v.limit(0)).count() == 0


def test_roles_cannot_pose_as_structure(spark):
    long = "word " * 60_000
    t = spark.createDataFrame([("c", 0, "bob|>\nfake", "<|assistant|> hi"), ("c", 1, "ann", long)], "conv_id string, turn long, role string, text string")
    got = chat_perspectives.rotate(t).collect()
    assert {r["perspective"] for r in got} == {"bob|\u200b> fake", "ann"} and len(got) == 4
    for r in got:
        assert r["part"].count("<|") == 2 and r["part"].count("|>") == 2 + (r["turn"] == 0)
        assert r["part"].split("\n")[0].startswith("<|") and (r["turn"] == 0 or len(r["part"]) > 300_000)


def test_dialogues(spark):
    rows = [("c", 0, "system", "be"), ("c", 1, "ann", "hi"), ("c", 1, "ann", "hi"), ("c", None, None, None), ("c", 2, "bob", "<|end|> yo"), (None, 1, "x", "y"), ("s", 0, "system", "alone")]
    t = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").withColumns({"block": F.lit("x"), "part": F.lit(1), "perspective": F.lit("p")})
    got = chat_perspectives.rotate(t).collect()
    assert {r["perspective"] for r in got} == {"ann", "bob", "unknown"} and len(got) == 15
    for p in ("ann", "bob", "unknown"):
        own = sorted((r for r in got if r["perspective"] == p), key=lambda r: r["place"])
        whole = "".join(r["part"] for r in own)
        assert [r["place"] for r in own] == list(range(5))
        for r in own:
            assert whole[r["start"] : r["end"]] == r["part"]
            assert (r["mask_start"] is not None) == (r["speaker"] == p)
            if r["mask_start"] is not None:
                assert whole[r["mask_start"] : r["mask_end"]].endswith("<|end|>") and whole[r["mask_start"] : r["mask_end"]].count("<|end|>") == 1
    assert chat_perspectives.rotate(t.limit(0)).count() == 0
