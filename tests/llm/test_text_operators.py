"""Operators 3, 4, 5, 7, 8 and the pipeline against brute force and held-out rows."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sitegauge.llm import decontam, jaccard, langid, quality, sentencepiece
from sitegauge.llm.components import connected_components
from sitegauge.llm.tables import read
from sitegauge.llm.textvec import shingle_sets

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and den * len(x & y) >= num * len(x | y):
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    low = {}
    for i, (name, _) in enumerate(sets):
        r = find(i)
        low[r] = min(x for x in (low.get(r), name) if x is not None) if (low.get(r) is not None or name is not None) else None
    return [(name, len(s), low[find(i)]) for i, (name, s) in enumerate(sets)]


@pytest.fixture(scope="module")
def hard_rows():
    base = [f"w{i}" for i in range(120)]
    rows = [(1, " ".join(base)), (2, " ".join(base).upper()), (3, " ".join(base[:-2])), (4, " ".join(base[20:]))]
    for i in range(40):  # near copies of one text, each changed elsewhere
        words = list(base)
        words[(i * 3) % 120] = f"x{i}"
        rows.append((100 + i, " ".join(words)))
    rows += [(5, None), (6, ""), (7, " \t\n"), (8, "two words"), (9, "Two  words\n"), (10, "z" * 5000 + " a b c d"),
             (11, "z" * 5000 + " a b c d"), (None, " ".join(base)), (12, "é É " * 30), (12, "é É " * 30)]
    return rows


def test_jaccard_against_brute_force(spark, hard_rows):
    docs = spark.createDataFrame(hard_rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("sig", F.lit(1))
    for k, num, den in ((4, 85, 100), (5, 80, 100)):
        got = jaccard.jaccard_join(docs, k=k, limit=jaccard.Threshold(num, den)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute_components(hard_rows, k, num, den), key=str)
    assert jaccard.jaccard_join(docs.limit(0)).count() == 0
    kept = jaccard.one_per_group(docs).collect()
    assert kept[0].asDict().keys() == docs.first().asDict().keys()
    comps = {n: c for n, _, c in brute_components(hard_rows, 5, 80, 100) if n is not None}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({i for i, c in comps.items() if i == c})


def test_one_per_group_with_repeated_and_null_ids(spark):
    """No text is lost and no copy stays, whatever the ids say."""
    texts = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"}
    near = texts["a"].replace("a59", "x")
    rows = [(1, texts["a"]), (None, texts["a"]), (None, near), (None, texts["a"]),        # linked: 1 stays
            (7, texts["b"]), (7, texts["c"]), (7, texts["c"]),                            # one id, two texts: both stay
            (None, texts["d"]), (None, texts["d"]), (None, texts["e"]),                   # no ids: one of each
            (7, near), (9, texts["f"]), (9, texts["f"]),
            (5, None), (5, None), (None, ""), (6, "")]                                    # no words: all stay
    docs = spark.createDataFrame([(i, t, n, "x") for n, (i, t) in enumerate(rows)], "doc_id long, text string, _row int, _near_0 string")
    kept = jaccard.one_per_group(docs.repartition(3))
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = [(1, texts["a"]), (7, texts["b"]), (7, texts["c"]), (None, texts["d"]), (None, texts["e"]), (9, texts["f"]),
            (5, None), (5, None), (None, ""), (6, "")]
    assert got == sorted(want, key=str)
    comps = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_join(docs).collect()}
    assert {(7, 56, 7), (7, 56, 1), (None, 56, 1), (None, 56, None), (9, 56, 9)} <= comps
    assert jaccard.one_per_group(docs.limit(0)).count() == 0


def test_jaccard_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    got = jaccard.op4_ngram_jaccard(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, 4, 85, 100))


def test_shingle_hashes_follow_words():
    import pyarrow as pa
    texts = ["a b  c d e", "A B c\td\ne", "a b c d", "é" * 700, "é" * 699 + "e", None, "q" * 9 + " r"]
    got = dict(shingle_sets(pa.array(texts), 4))
    assert list(got[0]) == list(got[1]) and len(got[0]) == 2 and len(got[2]) == 1 and got[2][0] in got[0]
    assert len(got[5]) == 0 and list(got[3]) != list(got[4])


def test_components_on_a_long_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (201, 200), (200, 201), (None, 3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 200: 200, 201: 200}


def brute_leaks(docs, items, k=decontam.K):
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for name, text in docs:
        w = cut(text)
        have = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
        for item, t in items:
            v = cut(t)
            want = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)}
            if want and len(want & have) >= 0.9 * len(want):
                out.add((name, item))
    return out


def test_decontamination_finds_copies(spark):
    docs, items = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontam.op3_decontamination(spark, SF).collect()}
    want = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want
    left = decontam.drop_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - len({d for d, _ in want})


def test_decontamination_slots(spark):
    item = "then Alice has 5 apples and 7 pears, and gives 5 of them and 3 kg of plums to the boy over there in the garden"
    items = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "tiny item")], "item_id long, text string").withColumn("h", F.lit(1))
    texts = [(1, "zz " + item + " yes"), (2, item.replace("5", "9").replace("Alice", "Clara")),
             (3, "so it is: then Alice has 5 apples and the cat sat on a mat far from the old mill"), (4, None), (5, ""), (6, "tiny, ITEM!"),
             (None, item), (2, item.replace("5", "9").replace("Alice", "Clara"))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("form", F.lit("x"))
    got = {(r.doc_id, r.item_id): r.kind for r in decontam.template_matches(docs, items).collect()}
    assert got == {(1, 1): "exact", (1, 2): "exact", (2, 1): "reworded", (2, 2): "reworded", (6, 5): "exact",
                   (None, 1): "exact", (None, 2): "exact"}
    assert decontam.template_matches(docs.limit(0), items).count() == 0
    assert decontam.template_matches(docs, items.limit(0)).count() == 0
    assert decontam.drop_contaminated(docs, items).where("doc_id in (3, 4, 5)").count() == 3


def test_decontamination_occurrences(spark):
    """True copies behind a variant, equal numbers re-parameterised apart, decimals for whole numbers."""
    item = "Ann buys 3 boxes of pears and 3 boxes of plums, then she pays 20 dollars and walks 4 miles to the old mill"
    variant = "then she pays 90 dollars and walks 8 miles to the old mill"
    split = item.replace("then she pays", "then, as always, she gladly pays")
    texts = [(1, variant + " . " + "so it goes on and on here " * 20 + item), (2, item.replace("3 boxes of pears", "6 boxes of pears").replace("3 boxes of plums", "8 boxes of plums")),
             (3, item.replace("3", "2.5")), (4, item.replace("20", "1,300")), (5, variant + " . " + item + " . " + variant),
             (6, "we say that " + variant + " . " + "so it goes on and on here " * 20 + split), (7, "so it goes on and on here " * 20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.kind for r in decontam.template_matches(docs, items).collect()}
    assert got == {1: "exact", 2: "reworded", 3: "reworded", 4: "reworded", 5: "exact", 6: "exact"}
    assert {r.doc_id for r in decontam.drop_contaminated(docs, items).collect()} == {7}


def test_decontamination_short_items(spark):
    """Items of 2 to 8 tokens are found at every position of longer texts."""
    tokens = "what river flows through the old town centre".split()
    items = spark.createDataFrame([(n, " ".join(tokens[:n])) for n in range(2, 9)] + [(0, None)], "item_id long, text string")
    texts = [(i, "well " * i + " ".join(tokens) + " he asked them") for i in range(6)]
    texts += [(10, "what river flows over the hill"), (11, "the old town centre"), (12, None), (13, "what"),
              (14, "no other river flows through the old town, she says")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.template_matches(docs, items).collect()}
    # 14 shares 'river flows through the old [town]': 1 of 2, 2 of 3 and 2 of 4 windows
    want = {(i, n) for i in range(6) for n in range(2, 9)} | {(10, 2), (10, 3), (14, 6), (14, 7), (14, 8)}
    assert got == want


def test_langid_held_out(spark):
    got = langid.op5_langid_centroids(spark, "/root/testdata/sf0.01")
    truth = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out").toPandas()
    assert (held.lang == held.lang_pred).mean() > 0.97 and got.count() == truth.count()
    assert held.score.between(0, 1).all()


def test_langid_learns_alike_with_many_languages(spark, monkeypatch):
    docs = read(spark, SF, "documents")
    want = langid.train_langid(docs)
    monkeypatch.setattr(langid, "MOST_LANGS", 1)
    got = langid.train_langid(docs)
    assert got.langs == want.langs and np.array_equal(got.centroids, want.centroids) and np.array_equal(got.least, want.least)
    plan = []
    assert langid.train_langid(docs.limit(0)).langs == plan


def test_langid_edges(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(None, None, "en"), (1, "", None), (2, "123 --- !!", "en"), (3, "the of and", None), (3, "Ж" * 400, "en")],
                                "doc_id long, text string, lang string").withColumn("letters", F.lit(0))
    model = langid.train_langid(docs)
    rows = [(r.lang_pred, r.rejected) for r in langid.predict_langid(odd, model).collect()]
    assert rows[:3] == [("und", True)] * 3 and rows[3] == ("en", False)
    kept = langid.keep_known(odd, model)
    assert kept.columns == odd.columns and kept.where("text = 'the of and'").count() == 1 and kept.where("text is null").count() == 0
    empty = langid.train_langid(docs.limit(0))
    assert {r.lang_pred for r in langid.predict_langid(odd, empty).collect()} == {"und"}


def test_quality_held_out(spark):
    got = quality.op7_quality_ftrl(spark, "/root/testdata/sf0.1")
    marks = read(spark, "/root/testdata/sf0.1", "labels").select("doc_id", "quality")
    held = got.join(marks, "doc_id").where("held_out").toPandas()
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.predicted == 1).mean() > 0.99 and (bad.predicted == 0).mean() > 0.9
    assert got.count() == read(spark, "/root/testdata/sf0.1", "documents").count()


def test_quality_edges(spark):
    docs = read(spark, SF, "documents")
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (2, 1), (None, 1), (4, 7)], "doc_id long, quality int").withColumn("text", F.lit("t"))
    model = quality.train_quality(docs, labels)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "x " * 30000)], "doc_id long, text string").withColumn("score", F.lit(2))
    scores = [r.score for r in quality.score_quality(odd, model).collect()]
    assert len(scores) == 4 and scores[0] == scores[1] and all(0 <= s <= 1 for s in scores)
    assert quality.keep_good(odd, model).columns == odd.columns
    blank = quality.train_quality(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(odd, blank).collect()} == {0.5}


def test_sentencepiece_parity_and_round_trip(spark):
    import sentencepiece as own
    sp = own.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    docs = read(spark, SF, "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "  a  b▁c <s> \u0000\n"), (9003, "x" * 30000), (None, "ok")], docs.schema)
    every = docs.unionByName(odd).withColumn("ids", F.lit(1))
    encoded = sentencepiece.encode(every)
    texts = {(r.doc_id, r.text) for r in every.collect()}
    rows = encoded.collect()
    assert len(rows) == every.count()
    assert {(r.doc_id, None if r.ids is None else tuple(r.ids), r.n_tokens) for r in rows} == \
        {(i, None if t is None else tuple(sp.encode(t)), None if t is None else len(sp.encode(t))) for i, t in texts}
    assert {r.round_trip for r in rows if r.ids is not None} == {True}
    back = {(r.doc_id, r.text) for r in sentencepiece.decode(encoded).collect()}
    assert back == {(i, None if t is None else t.replace("▁", " ")) for i, t in texts}


def test_sentencepiece_unigram_model(tmp_path):
    """A unigram model written by hand: the rebuilt tokenizer agrees with the library."""
    import struct

    import sentencepiece as own

    def field(number, wire, value):
        key = bytes([number << 3 | wire]) if number < 16 else bytes([(number << 3 | wire) & 0x7F | 0x80, number >> 4])
        return key + (bytes([len(value)]) if wire == 2 else b"") + value

    def piece(text, score, kind):
        return field(1, 2, field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))

    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)]
    pieces += [(f"<0x{b:02X}>", 0, 6) for b in range(256)]
    pieces += [(t, s, 1) for t, s in (("▁", -2), ("a", -3), ("b", -3.5), ("ab", -3.2), ("▁ab", -4), ("ba", -4.1), ("▁a", -4.5))]
    data = b"".join(piece(*p) for p in pieces)
    data += field(2, 2, field(3, 0, b"\x01") + field(35, 0, b"\x01"))
    data += field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00"))
    sp = own.SentencePieceProcessor(model_proto=data)
    model = sentencepiece.parse_model(data)
    assert model.kind == sentencepiece.UNIGRAM and model.byte_fallback
    tok = sentencepiece.build(model)
    sentencepiece.check_parity(tok, data, ["ab", "ab ba", "abab aab", "bca é", "", " a"])
    assert tok.decode(sp.encode("ab é"), skip_special_tokens=False) == "ab é"
    with pytest.raises(ValueError):
        sentencepiece.parse_model(field(2, 2, field(3, 0, b"\x04")))


def test_pipeline_stages(spark):
    docs = read(spark, SF, "documents")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF)
        assert out.columns == docs.columns, name
        ids, before = ({r.doc_id for r in x.select("doc_id").collect()} for x in (out, seen))
        assert ids <= before and len(ids) >= 0.6 * len(before), name
        seen = out
    want = {r.doc_id for r in seen.select("doc_id").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want) and all(r.round_trip for r in got)
    marks = {r.doc_id: r.quality for r in read(spark, SF, "labels").collect()}
    assert np.mean([marks[i] for i in want if i in marks]) > np.mean(list(marks.values())) + 0.05
