import base64
import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkforge.llm import bpe_prefix, lang_zstd, license_scan, line_winnow, pack_binary, paragraph_minhash, quality_mcd

P = pytest.importorskip("public_tokenizers")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
SPACE = r"[\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


# ------------------------------------------------------------------ operator 6
@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe_prefix.encoder(RANKS, P.PATTERN)


def test_ids_equal_the_library(texts, library, encoder):
    for t in texts.values():
        ids = encoder.encode(t)
        assert ids == library.encode_ordinary(t) and encoder.decode(ids).decode() == t


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(library, encoder, t):
    t = t.encode("utf-8", "replace").decode()
    assert encoder.encode(t) == library.encode_ordinary(t)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=80), st.binary(max_size=20), st.integers(0, 80), st.integers(0, 30))
def test_prefix_table_appends_and_edits(encoder, data, new, start, n):
    table = bpe_prefix.PrefixTable(encoder.v, data)
    table.append(new)
    assert table.tokens() == bpe_prefix.PrefixTable(encoder.v, data + new).tokens() == encoder.v.merge(data + new)
    start = min(start, len(data))
    end = min(len(data), start + n)
    table = bpe_prefix.PrefixTable(encoder.v, data)
    table.replace(start, end, new)
    assert table.last == bpe_prefix.PrefixTable(encoder.v, data[:start] + new + data[end:]).last


def test_edit_recomputes_little(encoder):
    data = ("the quick brown fox jumps over it " * 300).encode()
    table = bpe_prefix.PrefixTable(encoder.v, data)
    assert table.replace(500, 503, b"xyz") < 2000 and table.tokens() == bpe_prefix.PrefixTable(encoder.v, table.data).tokens()


def test_encode_query(docs, texts, library):
    import hashlib

    for r in bpe_prefix.encode(docs, RANKS, P.PATTERN, ids=True).limit(50).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# ------------------------------------------------------------------ operator 7
def test_packing(docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    per = collections.defaultdict(list)
    rows = pack_binary.pack(docs, P.path("word_bpe_49k.json"), ids=True).collect()
    for r in rows:
        per[r["doc_id"]].append(r)
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for d, text in texts.items():
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        pieces = sorted(per[d], key=lambda r: r["start"])
        assert [i for r in pieces for i in r["ids"]] == ids and {r["doc_tokens"] for r in pieces} == {len(ids)}
        for r in pieces:
            n = r["length"]
            assert n <= 2048 and n & (n - 1) == 0 and r["offset"] == 0
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'stremvdl09éßİΣ\x1c\x0b")), max_size=40))
def test_chunked_ids_equal_whole(t):
    from tokenizers import Tokenizer

    if "c" not in _MEMO:
        _MEMO.update(c=pack_binary.Chunks(P.path("word_bpe_49k.json")), t=Tokenizer.from_file(P.path("word_bpe_49k.json")))
    assert np.frombuffer(_MEMO["c"].ids(t), "<u4").tolist() == _MEMO["t"].encode(t, add_special_tokens=False).ids


_MEMO: dict = {}


def test_added_tokens_equal_the_library(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    path = P.path("word_bpe_49k.json")
    whole, made = Tokenizer.from_file(path), pack_binary.Chunks(path)
    for t in ["abc <|endoftext|> def", "abc<|endoftext|>def", "<|startoftext|>É's <|ENDOFTEXT|>\n<|endoftext|><|endoftext|>x", "é<|endoftext|>\u0301a\x1c<|startoftext|>", "<| endoftext |>"]:
        assert np.frombuffer(made.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids
    assert np.frombuffer(made.ids("abc <|endoftext|> def"), "<u4").tolist() == [5334, 49407, 11649]
    for n, token in enumerate([AddedToken("two words", normalized=False), AddedToken("<mark>", normalized=True), AddedToken("<one>", single_word=True, normalized=False)]):
        other = Tokenizer.from_file(path)
        other.add_tokens([token])
        other.save(str(tmp_path / f"{n}.json"))
        made = pack_binary.Chunks(str(tmp_path / f"{n}.json"))
        for t in ["a two words b", "a <MARK> b<mark>c", "a<one>b <one> c"]:
            assert np.frombuffer(made.ids(t), "<u4").tolist() == other.encode(t, add_special_tokens=False).ids


def test_other_tokenizers_are_encoded_whole(tmp_path):
    from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

    other = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    other.normalizer = normalizers.NFC()
    other.save(str(tmp_path / "cased.json"))
    other = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    other.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(r"\s+"), "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    other.save(str(tmp_path / "split.json"))
    for name in ("cased", "split"):
        made, whole = pack_binary.Chunks(str(tmp_path / f"{name}.json")), Tokenizer.from_file(str(tmp_path / f"{name}.json"))
        for t in ("Hello it's 42 Words, they're ABC", "é x--y 's"):
            assert np.frombuffer(made.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids
    assert not pack_binary.Chunks(P.path("word_bpe_49k.json")).whole


def test_buckets_hold_one_length(spark, docs, tmp_path):
    pack_binary.write_buckets(pack_binary.pack(docs.limit(60), P.path("word_bpe_49k.json")), str(tmp_path / "b"))
    got = spark.read.parquet(str(tmp_path / "b"))
    assert got.where("length <> shiftleft(1, bucket)").count() == 0 and got.select("bucket").distinct().count() == got.select("length").distinct().count() > 5


def test_binary_cuts():
    assert pack_binary.binary_cuts(2 * 2048 + 5, 2048) == [(0, 2048), (2048, 2048), (4096, 4), (4100, 1)]
    with pytest.raises(ValueError):
        pack_binary.pack(None, "", longest=1000)


# ------------------------------------------------------------------ operator 1
def statistics(text):
    w = [x for x in re.split(SPACE, text or "") if x]
    windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_base_statistics(docs, texts):
    for r in quality_mcd.judge(docs).collect():
        n, chars, symbols, dup, rep = want = statistics(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (n < 10 or 100 * rep > 20 * n) and (r["kept"] is False or not r["base_failed"])


def test_outliers_are_rejected_per_group(spark):
    r = random.Random(2)
    words = ["plain", "words", "of", "every", "day", "and", "night"]
    rows = [(i, " ".join(r.choice(words) + str(r.randrange(50)) for _ in range(120)), "en" if i % 2 else "de", "s") for i in range(400)]
    rows += [(1000 + i, " ".join("###$$$" if j % 2 else r.choice(words).upper() + str(j) for j in range(120)), "en", "s") for i in range(8)]
    got = {x["doc_id"]: x["kept"] for x in quality_mcd.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)).collect()}
    assert not any(got[1000 + i] for i in range(8)) and sum(got[i] for i in range(400)) >= 396


def plain_distances(x, share=0.75):
    """The estimate in plain numpy: squared distances of whole vectors, as multiples of what the median makes consistent."""
    n, d = x.shape
    v = x / quality_mcd.UNIT

    def params(rows):
        return rows.mean(0), np.cov(rows.T, bias=True) + quality_mcd.ROUNDING * np.eye(d)

    def distances(p):
        return np.einsum("ij,jk,ik->i", v - p[0], np.linalg.inv(p[1]), v - p[0])

    def steps(p):
        return np.floor(np.log1p(distances(p)) * quality_mcd.STEPS)

    def upto(q, part):  # rows of the steps up to where this part of them is reached
        return q <= np.sort(q)[int(np.ceil(part * n)) - 1]

    a, b, c = (np.sort(x, 0)[int(np.ceil(part * n)) - 1] / quality_mcd.UNIT for part in (0.25, 0.5, 0.75))
    s = (c - a) / 1.349
    box = (np.abs(v - b) <= 1.5 * s + 1 / quality_mcd.UNIT).all(1)
    def better(start):
        return params(v[upto(steps(start), share)])

    def det(p):
        return np.linalg.slogdet(p[1])[1]

    starts = [(b, np.diag(s**2) + quality_mcd.ROUNDING * np.eye(d)), params(v), params(v[box])]
    raw = min((better(better(p)) for p in starts), key=det)
    for _ in range(50):
        last, raw = raw, better(raw)
        if abs(det(raw) - det(last)) <= 1e-9:
            break
    scale = lambda p: np.expm1((np.sort(steps(p))[int(np.ceil(n / 2)) - 1] + 0.5) / quality_mcd.STEPS) / quality_mcd.CHI2_MEDIAN
    final = params(v[distances(raw) <= quality_mcd.CHI2_975 * scale(raw)])
    return distances(final) / scale(final)


def test_tables_by_group_are_short_files(spark):
    """Estimates of a few groups are one file, however many shuffle partitions there are, and the same in more tasks."""
    r = np.random.default_rng(5)
    rows = spark.createDataFrame([(f"g{g}", *map(int, r.normal(100 * g, 20, 3))) for g in range(9) for _ in range(60)], "g string, x0 long, x1 long, x2 long")
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = quality_mcd.estimate(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got.inputFiles()) == 1
    assert got.orderBy("g").collect() == quality_mcd.estimate(rows).orderBy("g").collect()


def test_estimate_equals_a_plain_one(spark):
    r = np.random.default_rng(0)
    groups = {}
    for g, far in (("a", 0), ("b", 60), ("c", 140)):
        x = np.rint(r.standard_normal((600, 3)) @ np.array([[200, 90, 0], [0, 120, -40], [0, 0, 60]]) + [100, 200, -300]).astype(int)
        x[:far] += [900, -700, 300]
        groups[g] = x
    groups["d"] = np.rint(r.standard_normal((40, 3)) * [100, 0, 50]).astype(int)  # a constant part
    df = spark.createDataFrame([(g, *map(int, v)) for g, x in groups.items() for v in x], "g string, x0 long, x1 long, x2 long").repartition(5)
    params = quality_mcd.estimate(df)
    got = df.join(params, "g").withColumn("d", quality_mcd._distance(F.col("p")) / F.col("scale")).toPandas()
    for g, x in groups.items():
        own = got[got["g"] == g]
        mine = dict(zip(map(tuple, own[["x0", "x1", "x2"]].to_numpy().tolist()), own["d"], strict=True))
        assert np.allclose([mine[tuple(v)] for v in x.tolist()], plain_distances(x), rtol=1e-6)
    c = got[got["g"] == "c"]
    assert ((c["d"] > quality_mcd.CHI2_TAIL) == (c["x0"] > 600)).mean() > 0.99  # 23 % far rows don't draw it away


def test_verdicts_equal_plain_ones(spark, docs):
    stats = quality_mcd.statistics(docs).toPandas()
    kept = {r["doc_id"]: r["kept"] for r in quality_mcd.judge(docs).collect()}
    good = stats[~stats["base_failed"]]
    pool = good.groupby(["lang", "source"])["doc_id"].transform("size") >= 15
    small = good[~pool].groupby("lang")["doc_id"].transform("size") >= 15
    g = [f"{a}|{b}" if p else a if small.get(i, False) else "*" for i, a, b, p in zip(good.index, good["lang"], good["source"], pool, strict=True)]
    want = {}
    for _, own in good.groupby(g):
        far = plain_distances(own[list(quality_mcd.X)].to_numpy()) > quality_mcd.CHI2_TAIL if len(own) >= 15 else [False] * len(own)
        want.update(zip(own["doc_id"], far, strict=True))
    assert {d: not want.get(d, True) for d in kept} == kept


# ------------------------------------------------------------------ operator 4
def test_language_accuracy(docs):
    got = lang_zstd.identify(docs, lang_zstd.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'")
    n, right = got.count(), got.where("lang = lang_pred").count()
    assert n > 20 and right / n > 0.9
    assert got.where("score < 0 or score > 1").count() == 0


def test_letters_decide_on_und(spark):
    c = lang_zstd.Classifier({"en": b"an example of the language that follows", "fr": b"un exemple du langage employe ensuite"})
    assert [c.predict(t)[0] for t in (None, "", "12 34", "½ ² Ⅷ", "_ - _")] == ["und"] * 5
    assert c.predict("the language that follows an example")[0] == "en" and c.predict("exemple du langage employe")[0] == "fr"


def test_sample_is_bounded_and_the_same(spark):
    rows = [(1, "the same words here again", "en")] * 500 + [(i, f"other words {i} of this language", "en") for i in range(2, 400)] + [(i, "mots de cette langue", f"l{i}") for i in range(400, 460)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lang_zstd.fit(df.repartition(7), per_lang=20, dict_bytes=300)
    assert got == lang_zstd.fit(df.repartition(2), per_lang=20, dict_bytes=300)
    assert len(got["en"]) <= 300 and got["en"].count(b"the same words") <= 2 and sum(k.startswith("l") for k in got) >= 40


# ------------------------------------------------------------------ operator 5
def phrases(text):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if x]
    out = []
    for p, label in license_scan.PHRASES:
        q = p.split()
        out += [(i, label) for i in range(len(w) - len(q) + 1) if w[i : i + len(q)] == q]
    return len(w), out


def test_phrases_equal_brute_force(spark, docs, texts):
    more = {-1: "Under the MIT License. cc-by-nc CC BY NC under the mit  license", -2: None, -3: "Apache License, Version 2.0", -4: "", -5: "é under the mit licenseé"}
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(more.items()), "doc_id long, text string"))
    for r in license_scan.scan(df).collect():
        n, base = phrases({**texts, **more}[r["doc_id"]])
        pos = [i for i, _ in base]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (n, len(base), min(pos, default=None), max(pos, default=None))
        assert r["base_labels"] == ",".join(sorted({k for _, k in base})) and {*r["base_labels"].split(",")} - {""} <= {*r["labels"].split(",")}
        assert 0 <= r["score"] <= 1


def test_matching_statistics_equal_brute_force():
    r = random.Random(5)
    seqs = [[r.randrange(4) for _ in range(30)] for _ in range(4)]
    text = [r.randrange(5) for _ in range(200)]
    a = license_scan.SuffixAutomaton(seqs)
    inside = {tuple(s[i:j]) for s in seqs for i in range(30) for j in range(i + 1, 31)}
    for i, (n, state) in enumerate(a.statistics(text)):
        want = max((k for k in range(31) if k <= i + 1 and (k == 0 or tuple(text[i + 1 - k : i + 1]) in inside)), default=0)
        assert n == want
        if n:
            t, end = a.place[state]
            assert seqs[t][end - n : end] == text[i + 1 - n : i + 1]


def test_long_matches_count_for_every_template():
    shared = " ".join(f"word{i}" for i in range(20))
    got = license_scan.Scanner((), (("one", shared), ("two", f"before {shared}"), ("three", " ".join(shared.split()[:12])))).scan([shared, " ".join(shared.split()[:12])])
    assert [r[5] for r in got] == ["one", "three"] and {x[0] for x in license_scan.Scanner((), (("one", shared), ("two", shared))).scan([shared])[0][7]} == {"one", "two"}
    a = license_scan.SuffixAutomaton([[1, 2, 3, 4, 5, 6], [9, 2, 3, 4, 5, 6], [2, 3, 4, 5, 7]], least=3)
    *_, (n, state) = a.statistics([2, 3, 4, 5])
    assert n == 4 and a.places[state] == {(0, 5), (1, 5), (2, 4)}
    *_, (n, state) = a.statistics([1, 2, 3, 4, 5])
    assert a.standing(n, state) == {(0, 5): 5, (1, 5): 4, (2, 4): 4}


def test_notices_are_told_apart(tmp_path):
    notice = {k: t for k, t in license_scan.TEMPLATES if k.startswith(("gpl", "lgpl", "agpl", "cc-")) and len(t) > 80 or k.startswith("cc-")}
    got = license_scan.Scanner().scan([f"x y {t} z" for t in notice.values()])
    assert [r[5] for r in got] == list(notice)
    (tmp_path / "own.2.txt").write_text("terms of a licence of our own making")
    assert license_scan.read_templates(str(tmp_path)) == (("own", "terms of a licence of our own making"),)


def test_template_spans(spark):
    label, template = next(x for x in license_scan.TEMPLATES if x[0] == "bsd")
    w = template.split()
    text = "before it " + " ".join(w[:20] + ["changed"] + w[21:]) + " and after"
    r = license_scan.scan(spark.createDataFrame([(1, text), (2, "no licence at all")], "doc_id long, text string"), spans=True).orderBy("doc_id").collect()
    assert r[0]["labels"] == label and r[0]["spans"][0]["first"] == 2 and r[0]["score"] > 0.9 and r[1]["labels"] == ""


# ------------------------------------------------------------------ operator 9
def winnowed(docs, run=3, chars=100, reach=4):
    """By brute force: selected pairs and long lines, each against its first place, extended line by line."""
    import hashlib

    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    lines, prints = {}, []
    for d, t in sorted(docs):
        own = lines[d] = [(i, x) for i, x in enumerate(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)]
        m = [md5(x) for _, x in own]
        o = [md5(a + b) for a, b in itertools.pairwise(m)]
        chosen = {max(w, key=lambda j: (-int(o[j], 16), j)) for w in ([list(range(s, s + 2)) for s in range(len(o) - 1)] or [[0]] * len(o))}
        prints += [(("pair", m[j], m[j + 1]), d, j, 2) for j in chosen] + [(("line", m[j]), d, j, 1) for j, (_, x) in enumerate(own) if len(x) >= chars]
    first, gone = {}, collections.defaultdict(set)
    for f, d, j, k in sorted(prints, key=lambda x: x[1:]):
        d0, j0 = first.setdefault(f, (d, j))
        if d == d0 and j < j0 + k:
            continue
        h, h0 = [x for _, x in lines[d]], [x for _, x in lines[d0]]
        a, b, most = j, j + k - 1, min(reach, j - j0 - k) if d == d0 else reach
        while j - a < most and a > 0 and j0 - (j - a) > 0 and h[a - 1] == h0[j0 - (j - a) - 1]:
            a -= 1
        while b - (j + k - 1) < reach and b + 1 < len(h) and j0 + b + 1 - j < len(h0) and h[b + 1] == h0[j0 + b + 1 - j]:
            b += 1
        if b - a + 1 >= run or sum(map(len, h[a : b + 1])) >= chars:
            gone[d] |= set(range(lines[d][a][0], lines[d][b][0] + 1))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in docs}


def test_line_runs_equal_brute_force(spark):
    r = random.Random(3)
    pool = [f"line {i}" for i in range(12)] + ["", " "] + ["long " * 19 + f"line {i}" for i in range(3)]
    docs = [(i, "\n".join(r.choice(pool) if r.random() < 0.7 else f"own {i} {j}" for j in range(r.randrange(1, 25)))) for i in range(80)] + [(90, "a b\n" * 9), (91, pool[-1]), (92, "x\n" + pool[-1]), (93, "x")]
    got = {x["doc_id"]: x["text"] for x in line_winnow.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)).collect()}
    assert got == winnowed(docs)
    assert got[92] == "x" and got[93] == "x"


def test_fewer_fingerprints_than_windows(spark):
    """Whole runs are found although only two pairs of lines in three are shuffled."""
    r = random.Random(6)
    own = lambda n: [f"line {r.random()}" for _ in range(n)]
    shared = [own(n) for n in (3, 4, 5, 9, 30)]
    docs = [(i, "\n".join([*own(r.randrange(5, 40)), *shared[i % 5], *own(r.randrange(5, 40))])) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    pairs = sum(len(t.split("\n")) - 1 for _, t in docs)
    chosen = line_winnow.marks(df).select(F.explode("marks")).count()
    assert 0.5 * pairs < chosen < 0.75 * pairs
    got = {x["doc_id"]: x["n_deleted"] for x in line_winnow.dedup(df).collect()}
    assert got == {i: len(shared[i % 5]) if i >= 5 else 0 for i in range(40)}


def repeated_runs(docs, run=3, chars=100):
    """By brute force: the numbers of the lines in runs that stand earlier, wherever that is."""
    lines = {d: [(i, x) for i, x in enumerate(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)] for d, t in docs}
    first, gone = {}, collections.defaultdict(set)
    for d, own in sorted(lines.items()):
        for j, k in itertools.product(range(len(own)), range(1, run + 1)):
            w = tuple(x for _, x in own[j : j + k])
            if len(w) == k and (k == run or sum(map(len, w)) >= chars):
                d0, j0 = first.setdefault(w, (d, j))
                if d != d0 or j >= j0 + k:
                    gone[d] |= set(range(own[j][0], own[j + k - 1][0] + 1))
    return gone


def test_whole_runs_whose_fingerprints_stand_elsewhere(spark, tmp_path):
    """Each pair of a run of three stands in an earlier document by itself; the run goes from its second place on."""
    r = random.Random(3)
    docs = [(1, "a\nb\nx"), (2, "y\nb\nc"), (3, "a\nb\nc"), (4, "z\na\nb\nc\nw")]
    long, short = "long " * 30, "short"
    docs += [(5, long), (6, f"{long}\n{short}"), (7, f"u\n{long}\n{short}\nv")]
    pool = [f"line {i}" for i in range(12)] + ["", " "] + ["long " * 19 + f"line {i}" for i in range(3)]
    docs += [(i, "\n".join(r.choice(pool) if r.random() < 0.7 else f"own {i} {j}" for j in range(r.randrange(1, 25)))) for i in range(10, 90)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = {x["doc_id"]: x["text"] for x in line_winnow.dedup(df, whole=True).collect()}
    gone, before = repeated_runs(docs), winnowed(docs)
    assert got[4] == "z\nw" and got[7] == "u\nv"
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert {x["doc_id"]: x["n_deleted"] for x in line_winnow.op9_line_winnow(spark, str(tmp_path)).where("doc_id < 8").collect()} == {1: 0, 2: 0, 3: 0, 4: 3, 5: 0, 6: 1, 7: 2}
    for d, t in docs:
        rest = [x for i, x in enumerate(t.split("\n")) if i not in gone[d]]
        # whatever goes without whole=True goes with it
        assert len(got[d]) <= min(len(before[d]), len("\n".join(rest)))
    plain = [(d, t) for d, t in docs if all(t.split("\n").count(x) == 1 for x in t.split("\n"))]  # no run of its own
    got = {x["doc_id"]: x["text"] for x in line_winnow.dedup(spark.createDataFrame(plain, "doc_id long, text string"), whole=True).collect()}
    gone = repeated_runs(plain)
    assert got == {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in plain}


# ------------------------------------------------------------------ operator 10
def test_repeated_passages_go_but_the_first(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(r.randrange(1, 4))) + str(r.randrange(30))
    clean = [" ".join(word() for _ in range(r.randrange(20, 300))) for _ in range(60)]
    passages = [" ".join(word() for _ in range(n)) for n in (52, 60, 80, 200)]
    docs = []
    for i in range(60):
        w = clean[i].split()
        at = r.randrange(len(w))
        docs.append((i, " ".join([*w[:at], passages[i % 4], *w[at:]]) if i % 3 else clean[i]))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    got = {x["doc_id"]: (x["text"], x["n_removed"]) for x in paragraph_minhash.dedup(df).collect()}
    first = {}
    for i, t in docs:
        if i % 3 == 0:
            assert got[i] == (t, 0)
        elif i % 4 not in first:
            first[i % 4] = i
            assert got[i] == (t, 0)
        else:
            n = len(passages[i % 4].split())
            assert n <= got[i][1] <= n + 2 and got[i][0].split() != t.split()
            assert abs(len(got[i][0].split()) - len(clean[i].split())) <= 2
    spans = paragraph_minhash.removals(df).collect()
    assert {x["doc_id"] for x in spans} == {i for i, _ in docs if i % 3 and i not in first.values()}
    assert all(first[x["doc_id"] % 4] <= x["kept_doc_id"] < x["doc_id"] and (x["doc_id"] - x["kept_doc_id"]) % 4 == 0 for x in spans)


def paragraphs(docs):
    """Lines of 30 words or more: (doc_id, first word, shingles), by document and place."""
    for d, t in sorted(docs):
        at = 0
        for line in t.lower().split("\n"):
            w = line.split()
            if len(w) >= 30:
                yield d, at, {tuple(w[i : i + 5]) for i in range(len(w) - 4)}, len(w)
            at += len(w)


def near_lines(docs):
    """(doc_id, first word, words, first document of the component) of paragraphs linked with one of an earlier document."""
    found = list(paragraphs(docs))
    up = list(range(len(found)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in itertools.combinations(range(len(found)), 2):
        a, b = found[x][2], found[y][2]
        if 5 * len(a & b) >= 4 * len(a | b):
            x, y = sorted((root(x), root(y)))
            up[y] = x
    return {(found[x][0], found[x][1], found[x][3], found[root(x)][0]) for x in range(len(found)) if found[root(x)][0] != found[x][0]}


def test_near_paragraphs_equal_brute_force(spark):
    """All pairs of paragraphs, linked by Jaccard of 0.8 or more; each but the first of a component goes."""
    r = random.Random(9)
    own = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    bases = [own(n) for n in (30, 45, 60, 120, 300)]
    edited = lambda w, share: [x if r.random() > share else f"e{r.randrange(10**9)}" for x in w]
    docs = [(i, "\n".join(" ".join(x) for x in [own(r.randrange(3, 60)), edited(bases[i % 5], r.choice([0.005, 0.01, 0.02, 0.04, 0.1])), own(r.randrange(1, 40)), own(35)])) for i in range(120)]
    want = near_lines(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    known = paragraph_minhash._known(df)
    got = {(x["doc_id"], x["a"], x["n"], x["d0"]) for x in paragraph_minhash.near_paragraphs(df, paragraph_minhash.units(known).where("k is not null")).collect()}
    assert got == want and len(want) > 40
    # bands find what pieces of equal words alone don't
    left = {x["doc_id"]: x["text"].lower().split() for x in paragraph_minhash.dedup(df).collect()}
    for d, a, n, _ in want:
        words = dict(docs)[d].split()
        assert not {*words[a : a + n]} & {*left[d]} - {*bases[d % 5]}


def repeated_windows(docs, least):
    """Words in windows of `least` words that stand in an earlier document, by brute force."""
    first, out = {}, {}
    for d, t in sorted(docs):
        w, gone = t.lower().split(), set()
        for a in range(len(w) - least + 1):
            if first.setdefault(tuple(w[a : a + least]), d) != d:
                gone |= set(range(a, a + least))
        out[d] = gone
    return out


def test_passages_in_running_text_go(spark):
    r = random.Random(5)
    own = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    docs, shared = [], {}
    for i, n in enumerate([51, 55, 60, 80, 120, 400, 20, 12] * 6):
        passage = shared.setdefault(n, own(n))
        docs.append((i, " ".join([*own(r.randrange(3, 60)), *passage, *own(r.randrange(3, 60))])))
    docs += [(50, docs[3][1]), (51, "few words here"), (52, "few words here"), (53, " ".join([*own(9), *(x if i % 40 else "edited" for i, x in enumerate(shared[400], 1)), *own(9)]))]
    got = {x["doc_id"]: x["text"].split() for x in paragraph_minhash.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)).collect()}
    want = repeated_windows(docs, 30)
    for d, t in docs:
        if d != 53:
            assert got[d] == [x for i, x in enumerate(t.split()) if i not in want[d] or d in (51, 52)]
    assert len(got[53]) == 19  # single edited words go with the run around them, but for the last one


def test_stretches_of_one_word_go(spark):
    docs = [(i, " ".join([*(f"a{i}x{j}" for j in range(20)), *["and"] * n, *(f"b{i}x{j}" for j in range(20))])) for i, n in enumerate([296, 50, 948, 11])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = [x["text"].split().count("and") for x in paragraph_minhash.dedup(df).orderBy("doc_id").collect()]
    assert left[0] == 296 and left[1] == 0 and left[2] < 30 and left[3] == 11
    alone = [x["text"].split().count("and") for x in paragraph_minhash.dedup(df, within=True).orderBy("doc_id").collect()]
    assert 30 <= alone[0] <= 60 and alone[2] < 30


def test_within_one_text(spark):
    r = random.Random(2)
    passage, rest = [f"p{i}" for i in range(60)], [f"r{r.randrange(10**9)}" for _ in range(90)]
    df = spark.createDataFrame([(1, " ".join([*rest[:30], *passage, *rest[30:60], *passage, *rest[60:]]))], "doc_id long, text string")
    assert paragraph_minhash.dedup(df).first()["n_removed"] == 0
    assert paragraph_minhash.dedup(df, within=True).first()["text"].split() == [*rest[:30], *passage, *rest[30:60], *rest[60:]]


def test_pieces_are_bounded_and_alike_everywhere():
    r = np.random.default_rng(1)
    h = r.integers(0, 2**63, 4000, dtype=np.uint64)
    h[1000:1400] = 7
    starts = paragraph_minhash.piece_starts(h, np.zeros(len(h), dtype=np.int64))
    assert starts[0] == 0 and np.diff(starts, append=len(h)).max() <= paragraph_minhash.LONGEST and {1000, 1030, 1400} <= {*starts.tolist()}
    two = paragraph_minhash.piece_starts(np.concatenate([h[:500], h[200:900]]), np.repeat([0, 1], [500, 700]))
    inside = lambda x, a, b: {v for v in x.tolist() if a <= v < b}
    assert inside(two[two < 500], 206, 494) == inside(starts, 206, 494) == {v + 200 - 500 for v in two[two >= 500].tolist() if 506 <= v < 794}
    assert paragraph_minhash.piece_starts(h[:0], np.empty(0, dtype=np.int64)).tolist() == []


def test_a_run_does_not_reach_its_own_kept_place():
    h = np.array([7] * 90, dtype=np.uint64)
    r = {"a": 44, "b": 50, "of": 1, "of_th": 2, "a0": 0, "b0": 14, "pre": np.array([], dtype=np.int64), "post": np.array([7] * 40)}
    far = r | {"a0": 20, "b0": 34, "pre": np.array([7] * 20)}
    assert paragraph_minhash.extended(h, (1, 2), [r]) == [(44, 90, 1)]
    assert paragraph_minhash.extended(h, (1, 2), [far]) == [(34, 90, 1)] and paragraph_minhash.extended(h, (5, 5), [far]) == [(24, 90, 1)]


def test_white_space_and_bytes_stay():
    t = "Éa  b\n\nc d\te f"
    assert paragraph_minhash.without(t, [(1, 3, 0)]) == "Éa  d\te f"
    assert paragraph_minhash.without(t, [(4, 6, 0)]) == "Éa  b\n\nc d\t"
