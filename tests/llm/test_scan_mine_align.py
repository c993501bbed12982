"""Operators 11, 12 and 13 against brute force; every query with SQL against it."""

import hashlib
import os
import random
import re
import sys
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from oracle_check import compare, duck  # noqa: E402
from sitegauge.llm import hardneg, secretscan, tokalign  # noqa: E402
from sitegauge.llm.automaton import Rule, compile_rules  # noqa: E402
from sitegauge.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], SQL[name], SF)


def test_secret_query_on_planted_texts(spark, scratch):
    """The query itself against its SQL, on texts full of secrets."""
    rows = [(i, t) for i, t in enumerate(secret_texts()[:300] + secret_texts()[-12:])] + [(None, "token=abcdefgh"), (3, "AKIA" * 5)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{scratch}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{scratch}/documents.parquet/*.parquet')")
    assert compare(spark, con, "op11", QUERIES["op11_secret_scan"], SQL["op11_secret_scan"], scratch)


# ---- 11: secret scans

SEARCH = {r.kind: (re.compile(re.sub(r"\(\?i:(.*?\?key)\)", r"(?ai:\1)", r.pattern), re.A), r) for r in secretscan.BASE + secretscan.MORE}


def brute_spans(text):
    found = []
    for k, (pattern, rule) in enumerate(SEARCH.values()):
        for m in pattern.finditer(text or ""):
            last = len(re.search(r"[A-Za-z0-9+/_.=-]*\Z", re.sub(r"^(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", "", m[0]))[0]) \
                if rule.kind == "assign" else len(m[0]) - (4 if rule.kind == "access" else 0)
            if last >= rule.least and len(m[0]) >= rule.shortest:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def secret_texts():
    rnd = random.Random(5)
    bits = ["token", "secret", "password", "passwd", "api_key", "APIKEY", "ToKeN", " ", "  ", ":", "=", "'", '"', "abcdefgh",
            "deadbeef" * 4, "0123456789abcdef" * 2, "AKIA", "AKIAABCDEFGHIJKL", "é", "東京", "🙂", "x", "\n", "-", "/", "eyJabc", "eyJ",
            ".", " gh", "ghp_", "Z" * 36, "xoxb-", "1234", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "abc", "ſecret", "toKen"]
    made = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    return made + ["token=" + "a" * 5000, "f" * 100_000, None, "", "token: secret: abcdefghij", "token=mysecret: password=abcdefgh",
                   "x" * 3000 + "token: " + " " * 5000 + "abcdefgh", "AKIA" * 900, "é" * 2000 + "f" * 32, "f" * 31, "token=1234567"]


@pytest.mark.parametrize("lane", [7, 1 << 10])
def test_automaton_finds_what_single_searches_find(monkeypatch, lane):
    monkeypatch.setattr(secretscan, "LANE", lane)
    auto = compile_rules(secretscan.BASE + secretscan.MORE)
    texts = secret_texts()
    found = secretscan.spans_of(pa.array(texts), auto)
    for i, text in enumerate(texts):
        assert [tuple(x) for x in found.get(i, [])] == brute_spans(text), text
    # a slice of a batch, and small buffers
    monkeypatch.setattr(secretscan, "BUFFER", 300)
    again = secretscan.spans_of(pa.array(texts).slice(100, 400), auto)
    assert again == {i - 100: x for i, x in found.items() if 100 <= i < 500}


def test_rules_that_one_pass_cannot_end_are_refused():
    for pattern in ("a(b*c)?", "(ab)+", "x*"):
        with pytest.raises(ValueError):
            compile_rules((Rule("k", pattern),))
    assert compile_rules((Rule("k", r"[^a-c]{2}\.\d{1,3}z"),)).moves.shape[0] < 12


def test_minimised_states_are_distinct():
    auto = compile_rules(secretscan.BASE)
    assert len(auto.moves) < 1000 and auto.moves.max() < len(auto.moves)
    sign = {(tuple(s), tuple(m)) for s, m in zip(auto.says.tolist(), auto.moves.tolist())}
    assert len(sign) == len(auto.moves)


def test_secret_scan_table(spark):
    rows = [(i, t, "extra") for i, t in enumerate(secret_texts()[-40:])] + [(None, "token=abcdefgh", None), (3, "token=abcdefgh", "spans")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = secretscan.scan(docs).collect()
    assert len(got) == len(rows)
    kinds = list(SEARCH)
    want = Counter((i, tuple((kinds[k], a, b) for a, k, b in brute_spans(t))) for i, t, _ in rows)
    assert Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in got) == want
    assert secretscan.scan(docs.limit(0)).count() == 0


# ---- 12: hard negatives

def brute_negatives(rows, positives=5, negatives=5):
    """rows: (id, label, numbers or None)."""
    last = lambda i: (i is None, i or 0)
    ok = [(n, i, lab, [int(np.floor(256 * float(x))) for x in v]) for n, (i, lab, v) in enumerate(rows)
          if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for n, i, lab, v in ok:
        if i is None or i % 10:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), m, j, other) for m, j, other, w in ok if m != n and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], last(s[2]), s[1]))
        for p in [s for s in scored if s[3] == lab][:positives]:
            fits = [s for s in scored if s[3] != lab and 80 * p[0] <= 100 * s[0] <= 100 * p[0]][:negatives]
            for rank, s in enumerate(fits, 1):
                out[i, p[2], rank, s[2], p[0], s[0]] += 1
    return out


def test_scores_are_inner_products():
    rng = np.random.default_rng(0)
    for dim, size in ((64, 300), (5, 3), (1, 1), (8, 2), (0, 1), (17, 70_000), (64, 1 << 20)):
        a, c = rng.integers(-size, size, (9, dim)), rng.integers(-size, size, (33, dim))
        places = int(max(np.abs(a).max(initial=0), np.abs(c).max(initial=0))).bit_length() + 1
        assert (hardneg.scores(hardneg.planes(c, places), hardneg.tables(a)) == c @ a.T).all()


def mining_rows():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 20))
    rows = [(i, int(i % 3), [float(np.float32(x)) for x in centres[i % 6] + 0.4 * rng.standard_normal(20)]) for i in range(300)]
    rows += [(1000 + i, 1, rows[10][2]) for i in range(40)]                    # copies: ties by id
    rows += [(30, 2, rows[31][2]), (30, 2, rows[31][2]), (None, 0, rows[5][2]), (None, 1, rows[5][2])]
    rows += [(400, None, rows[1][2]), (410, 1, None), (420, 1, []), (421, 2, []), (422, 1, []), (430, 1, [1.0, 2.0]), (431, 1, [1.0, 1.0]),
             (432, 0, [1.0, 1.5]), (440, 1, [float("nan")] * 20), (450, 1, [float("inf")] * 20), (460, 1, [None] + [0.5] * 19),
             (470, 0, [0.0] * 20), (480, 9, [-0.001] * 20)]
    return rows


def test_hard_negatives_against_brute_force(spark, monkeypatch):
    rows = mining_rows()
    vectors = spark.createDataFrame([(i, lab, v, 0) for i, lab, v in rows], "vec_id long, label int, embedding array<double>, score int")
    want = brute_negatives(rows)
    for anchors, candidates in ((8192, 65536), (7, 50)):
        monkeypatch.setattr(hardneg, "ANCHORS", anchors)
        monkeypatch.setattr(hardneg, "CANDIDATES", candidates)
        got = hardneg.mine(vectors, F.col("vec_id") % 10 == 0).collect()
        assert Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got) == want
    assert hardneg.mine(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hardneg.mine(vectors.where("vec_id = 1"), F.col("vec_id") % 10 == 0).count() == 0


def test_hard_negatives_keep_string_labels_apart(spark):
    rows = [(i, "ab"[i % 2], [1.0, float(i % 2)]) for i in range(0, 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>")
    got = hardneg.mine(vectors, F.col("vec_id") == 1, positives=1).collect()
    assert [(r.positive_id, r.negative_id) for r in got] == []      # 65536 is less than 80 % of 131072
    got = hardneg.mine(vectors, F.col("vec_id") == 1, positives=1, percent=50).collect()
    assert [(r.positive_id, r.negative_id) for r in got] == [(3, x) for x in (0, 2, 4, 6)]


# ---- 13: tokens of two tokenizers

def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokalign.VOCABULARY)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=tokalign.MODEL)
    letters = tokalign.byte_letters()

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    docs, count = [], Counter()
    for t in texts:
        groups = []
        if t:
            a = [(i, bytes(letters[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + t, add_special_tokens=False).ids]
            b = [(i, piece(i)) for i in sp.encode(t)]
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + t).encode():
                ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
                low = 0
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    groups.append(tuple([i for (i, _), e in zip(side, end) if low < e <= cut] for side, end in zip((a, b), ends)))
                    low = cut
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        count.update(links.keys())
        docs.append((groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for groups, links in docs:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, count


def alignment_texts(spark):
    rnd = random.Random(2)
    bits = ["word", "Zürich", "東京", "🙂", "👩‍👩‍👧", "  ", " ", "\n", "\t", "<|endoftext|>", "</s>", "<0x41>", "é", "é", "͸", "ﬁ", "①", "don't",
            "1234567", "\x00", "ሴ", "=" * 40, "aaaaaaaa", " ", "▁"]
    made = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40))) for _ in range(150)]
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    return made + real + ["", None, " ", "  ", " x", "x ", "\n", "🙂" * 3000, "ab" * 20_000, real[0], real[0], "▁", "a b" * 5, "b \n", "b  \n", "b \n ", "  ", "a \u3000 b", "a\u2003 b \u00a0", "\x1c x"]


def test_alignment_against_brute_force(spark, monkeypatch):
    texts = alignment_texts(spark)
    want, count = brute_alignment(texts)
    rows = [(i if i % 7 else None, t, 1, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int, n int").repartition(3)
    got, pairs = tokalign.align(docs)
    of = {t: w for t, w in zip(texts, want)}
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    expected = Counter((i, *of[t]) for i, t, _, _ in rows)
    assert Counter((r.doc_id, *(r[c] for c in names)) for r in got.collect()) == expected
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == dict(count)
    assert tokalign.align(docs.limit(0))[0].count() == 0


def test_alignment_without_word_memory_or_small_groups(spark, monkeypatch):
    texts = alignment_texts(spark)[:120] + ["ab" * 3000]
    fast = tokalign.Aligner(tokalign.VOCABULARY, tokalign.MODEL)
    slow = tokalign.Aligner(tokalign.VOCABULARY, tokalign.MODEL)
    assert fast.by_word
    slow.by_word = False
    one, other = fast.align(texts), slow.align(texts)
    for x, y in zip(one, other):
        assert list(x) == list(y)
    monkeypatch.setattr(tokalign, "EXPAND", 5)
    monkeypatch.setattr(tokalign, "WORDS", 10)
    for x, y in zip(one, fast.align(texts)):
        assert list(x) == list(y)
    assert fast.align(texts[:3])[4] == one[4][:3]


def test_new_words_are_encoded_many_at_once(spark, monkeypatch):
    """As one text, with the tokens that each word has alone, whatever stands beside it."""
    one = tokalign.Aligner(tokalign.VOCABULARY, tokalign.MODEL)
    words = list(dict.fromkeys(w for t in alignment_texts(spark) if t for w in one.cut(t)))
    raw = [w.encode() for w in words]
    for size in (1 << 14, 50, 1):
        monkeypatch.setattr(tokalign, "RUN_BYTES", size)
        for side in (one.a, one.b):
            alone, joined, texts = tokalign.Words(side), tokalign.Words(side), []
            alone.add(words, raw)
            encode = side.encode
            monkeypatch.setattr(side, "encode", lambda x, e=encode: texts.extend(x) or e(x))
            joined.add(words, raw, joined=True)
            monkeypatch.undo()
            monkeypatch.setattr(tokalign, "RUN_BYTES", size)
            for name in ("ids", "ends", "starts", "sizes", "same"):
                assert (getattr(alone, name) == getattr(joined, name)).all(), name
            assert (size > 50) <= (len(texts) < len(words) / 4)
            empty = tokalign.Words(side)
            empty.add([], [], joined=True)
            assert len(empty.sizes) == 0


def test_words_of_several_calls_stay_when_the_memory_is_full(monkeypatch):
    """Common words are encoded once, however many others come and go; a call looks each word up once."""
    monkeypatch.setattr(tokalign, "WORDS", 20)
    one, whole = (tokalign.Aligner(tokalign.VOCABULARY, tokalign.MODEL) for _ in range(2))
    whole.by_word = False
    encoded, looked, encode, number = [], [], one.b.encode, one.number
    monkeypatch.setattr(one.b, "encode", lambda x: encoded.extend(x) or encode(x))
    monkeypatch.setattr(one, "number", lambda x: looked.append(len(x)) or number(x))
    for k in range(10):
        texts = ["the river over there"] * 2 + [" ".join(f"the w{k}x{i}" for i in range(8)), "the ▁"]
        for x, y in zip(one.align(texts), whole.align(texts)):
            assert list(x) == list(y)
    assert "".join(encoded).count(" river") == 1
    assert looked == [4 + 8 + 1] * 10
    assert len(one.known) <= 20 + 13 and len(one.texts) == len(one.sizes) == len(one.known)


def test_linked_groups_of_any_size():
    rng = np.random.default_rng(1)
    sizes = [(1, 1), (2, 3), (300, 200), (1, 1), (90, 70), (2, 1)]
    a, b = ([rng.integers(0, 30, s[k]) for s in sizes] for k in (0, 1))
    group = [np.repeat(np.arange(len(sizes)), [s[k] for s in sizes]) for k in (0, 1)]
    doc_of = np.array([0, 0, 0, 2, 2, 5])
    key, times = tokalign.linked(np.concatenate(a), np.concatenate(b), *group, doc_of)
    want = Counter()
    for d, x, y in zip(doc_of.tolist(), a, b):
        for i in x.tolist():
            for j in y.tolist():
                want[d << 33 | i << 16 | j] += 1
    assert dict(zip(key.tolist(), times.tolist())) == dict(want) and (np.diff(key) > 0).all()
