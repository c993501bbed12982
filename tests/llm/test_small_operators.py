"""Operators 1, 2, 6, 9 and 10 against brute force on the smallest tables."""

import hashlib
import io
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sitegauge.llm import chat, itq, packing, urltree, warc
from sitegauge.llm.tables import read

SF = "/root/testdata/sf0.001"


def test_url_rules_and_verdicts(spark):
    got = urltree.op1_url_template_tree(spark, SF).toPandas()
    urls = read(spark, SF, "pages").toPandas()
    assert sorted(got.page_id) == sorted(urls.page_id)
    host = {}
    for r in urls.itertuples():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url or "")
        host[r.page_id] = (m[1].lower(), m[2]) if m else ("", "")
    for r in got.itertuples():
        h, p = host[r.page_id]
        assert (r.host, r.path) == (h, p)
        fits = [(len(s + x), s + x, v) for s, x, v in urltree.RULES if (h == s or h.endswith("." + s)) and p.startswith(x)]
        if fits:
            assert (r.rule, r.verdict) == max(fits)[1:]
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


def test_url_templates_merge_and_reject(spark):
    rows = [(i, f"http://h.io/a/{i}") for i in range(20)] + [(100 + i, f"http://h.io/b/{i}?q") for i in range(20)]
    rows += [(200 + i, f"http://h.io/spam/{i}") for i in range(20)] + [(300, None), (None, "no scheme"), (301, "HTTP://X.IO")]
    urls = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(100 + i, 1) for i in range(20)]
                                   + [(200 + i, 0) for i in range(20)] + [(5000, None)], "id long, label int")
    got = urltree.judge(urls, labels, rules=()).toPandas()
    assert len(got) == len(rows)
    t = {(None if pd.isna(r.page_id) else int(r.page_id)): r for r in got.itertuples()}
    assert t[3].verdict == "allow" and t[203].verdict == "block"
    assert t[203].template == "/spam/*" and t[300].host == "" and t[None].path == ""
    assert urltree.judge(urls.limit(0), None).count() == 0


@pytest.mark.parametrize("sections", [20, 64, 65, 300])
def test_url_branches_keep_their_names_on_hosts_of_any_size(spark, sections):
    """A wholly bad branch is told from its siblings, at any number of siblings and depth."""
    rows, marks = [], []
    for s in range(sections):
        name = "spam" if s == 7 else "sec" + "abcdefghij"[s % 10] + "klmnopqrst"[s // 10 % 10] + "uvwxyzabcd"[s // 100]
        for i in range(12):
            page = s * 100 + i
            rows.append((page, f"http://h.io/{name}/{i}"))
            rows.append((100_000 + page, f"http://deep.io/a/b/c/d/e/f/{name}/{i}"))
            marks += [(page, int(name != "spam")), (100_000 + page, int(name != "spam"))]
    rows.append((999_999, "http://long.io/" + "/".join(["x"] * 400)))
    urls, labels = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(marks, "id long, label int")
    got = {r.page_id: r for r in urltree.judge(urls, labels, rules=()).collect()}
    assert len(got) == len(rows)
    assert got[703].template == "/spam/*" and got[703].verdict == "block" and got[100_703].verdict == "block"
    assert got[100_703].template == "/a/b/c/d/e/f/spam/*"
    for page in (3, 100_003, 1203):
        assert got[page].verdict == "allow" and got[page].template.endswith("/*/*")
    assert got[999_999].template == "/" + "/".join(["x"] * 400)


def test_packing(spark):
    docs = read(spark, SF, "documents")
    hot = spark.range(200).select((F.col("id") + 10_000).alias("doc_id"), F.lit("same text here").alias("text"))
    odd = spark.createDataFrame([(None, None), (None, None), (5, ""), (5, "")], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(hot).unionByName(odd)
    got = packing.shard(every).toPandas()
    assert len(got) == every.count()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    sizes = got.groupby("shard")["size"].sum().reindex(range(16), fill_value=0)
    assert sizes.max() - sizes.min() <= max(got["size"].max(), 0.02 * sizes.mean())
    assert packing.shard(every.limit(0)).count() == 0
    import zlib
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got[got.doc_id.isin(list(texts))].itertuples():
        if r.doc_id != 5:
            b = (texts[r.doc_id] or "").encode()
            assert r.size == len(b) + 1 and r.text_crc32 == zlib.crc32(b)


def test_chat(spark):
    got = chat.op6_chat_template(spark, SF).toPandas().set_index("conv_id")
    turns = read(spark, SF, "conversations").toPandas()
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = pd.DataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], columns=["conv_id", "turn", "role", "text"])
    turns = pd.concat([turns, extra])
    assert set(got.index) == set(turns.conv_id)
    for conv, g in turns.sort_values("turn").groupby("conv_id"):
        want = "".join(f"{r.role}\n{r.text or ''}\n" for r in g.itertuples())
        loss = "".join(r.text or "" for r in g.itertuples() if r.role == "assistant")
        assert got.loc[conv, "n_turns"] == len(g)
        assert got.loc[conv, "turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert got.loc[conv, "loss_chars"] == len(loss)
        assert got.loc[conv, "loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_language_and_edges(spark):
    assert chat.fold(chat.parse("a{{ 'b' + 'c' }}{% if 'x' == 'x' %}d{% else %}e{% endif %}")) == [("text", "abcd")]
    for bad in ("{% for m messages %}", "{{ m.a() }}", "{{ 'a' ", "{% if 'a' %}", "{{ __import__('os') }}"):
        with pytest.raises((chat.TemplateError, KeyError)):
            out = "".join(t for t, _ in chat.compile_template(bad)([]))
            raise KeyError(out) if "{{" in out else AssertionError(bad)
    odd = [(1, 1, None, None), (1, 0, "us\ner", "a\\n<|im_end|>\n<|x"), (1, None, "assistant", "\\"), (None, 0, "assistant", "z"),
           (1, 0, "us\ner", "a\\n<|im_end|>\n<|x")]
    turns = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string").withColumn("role2", F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    want = "assistant\n\\\n" + "us\ner\na\\n<|im_end|>\n<|x\n" * 2 + "\n\n"
    assert got[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest() and got[1].loss_chars == 1
    assert got[None].n_turns == 1 and got[None].loss_chars == 1
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


def test_itq(spark):
    vecs = read(spark, SF, "embeddings")
    odd = spark.createDataFrame([(9001, None, 1), (9002, [0.0] * 64, 1), (9003, [float("nan")] + [1.0] * 63, 1),
                                 (9004, [1.0, None], 1), (9005, [1.0, 2.0], 1), (9006, [2.0, 4.0], 1), (9007, [1.0, 2.0], None),
                                 (None, [1.0, 2.0], 1), (9008, [], 2)], "vec_id long, embedding array<float>, label int")
    every = vecs.select("vec_id", "embedding", "label").unionByName(odd)
    got = {r.vec_id: r for r in itq.links(every).collect()}
    assert len(got) == every.count()
    rows = vecs.toPandas()
    x = np.array(rows.embedding.tolist(), dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & (rows.label.values[:, None] == rows.label.values[None, :])
    np.fill_diagonal(near, False)
    want = near.sum(axis=1)
    have = np.array([got[i].n_links for i in rows.vec_id])
    assert (have <= want).all() and have.sum() >= 0.9 * want.sum()
    assert got[9005].n_links == 2 and got[9006].component_id == 9005 and got[None].component_id == 9005 and not got[None].kept
    for i in (9001, 9002, 9003, 9004, 9007, 9008):
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert itq.links(every.limit(0)).count() == 0


def brute_near(rows, least=0.98):
    """id -> (n_links, component_id) of (id, vector, label) rows, and the number of pairs."""
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, label = (np.array([r[c] for r in rows]) for c in (0, 2))
    near = (x @ x.T >= least) & (label[:, None] == label[None, :])
    low = ids.copy()
    while True:
        new = np.where(near, low[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == low).all():
            break
        low = new
    return {int(i): (int(n) - 1, int(c)) for i, n, c in zip(ids, near.sum(axis=1), low)}


def test_itq_components_of_chains(spark):
    """Middle members with the largest ids, so that no end is the other's smallest neighbour."""
    rng = np.random.default_rng(5)
    rows, step = [], np.arccos(0.985)
    for group in range(60):
        u, v = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        size = 3 + group % 4
        order = sorted(range(size), key=lambda i: (i % 2, i))  # 0 2 4 1 3: odd places get the largest ids
        for i in range(size):
            at = i * step
            rows.append((1000 * group + order.index(i), (np.cos(at) * u + np.sin(at) * v).tolist(), group % 3))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in
           itq.links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    want = brute_near(rows)
    assert sum(n for n, _ in want.values()) == 2 * (len(rows) - 60)
    assert len({c for _, c in want.values()}) == 60
    whole = [i for i, (n, _) in want.items() if got[i][0] == n]
    assert len(whole) >= 0.95 * len(rows)
    # a chain whose links were all found is one component, kept once
    for group in range(60):
        chain = [i for i in want if i // 1000 == group]
        if all(got[i][0] == want[i][0] for i in chain):
            assert {got[i][1] for i in chain} == {1000 * group} and sum(got[i][2] for i in chain) == 1


def test_itq_recall_with_a_common_mean(spark):
    """Pairs planted at 0.98 to 0.99 in a hot label, about a large common mean, and in small labels."""
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)

    def planted(x):
        ways = rng.standard_normal(x.shape)
        ways = unit(ways - (ways * x).sum(axis=1, keepdims=True) * x)
        c = rng.uniform(0.9801, 0.99, len(x))[:, None]
        return c * x + np.sqrt(1 - c * c) * ways

    middle = unit(rng.standard_normal(64))
    for shift in (0.0, 2.1, 3.9):  # common part against one of length 1: means of about 0, 0.9, 0.97
        hot = unit(shift * middle + unit(rng.standard_normal((5000, 64))))
        rest = unit(shift * middle + unit(rng.standard_normal((500, 64))))
        x = np.concatenate([hot, planted(hot[:1000]), rest, planted(rest)])
        label = np.concatenate([np.full(6000, 7), np.tile(np.arange(10, 20), 100)])
        rows = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))],
                                     "vec_id long, embedding array<float>, label int")
        found, want = 0, 0
        got = {r.vec_id: r.n_links for r in itq.links(rows).collect()}
        x32 = unit(x.astype(np.float32).astype(np.float64))
        for part in (np.arange(6000), np.arange(6000, 7000)):
            near = (x32[part] @ x32[part].T >= 0.98) & (label[part][:, None] == label[part][None, :])
            n = near.sum(axis=1) - 1
            have = np.array([got[i] for i in part])
            assert (have <= n).all()
            found, want = found + have.sum(), want + n.sum()
        assert want >= 3000 and found >= 0.98 * want, (shift, found, want)


def test_itq_loses_no_link_at_any_size(spark, monkeypatch):
    """A label's links are those of brute force, whether few or many rows share it and
    whatever the plan takes a bucket to cost."""
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(rng.standard_normal((1500, 64)))
    ways = rng.standard_normal(x.shape)
    ways = unit(ways - (ways * x).sum(axis=1, keepdims=True) * x)
    c = rng.uniform(0.98001, 0.981, len(x))[:, None]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([x, c * x + np.sqrt(1 - c * c) * ways]))]
    few = [r for r in rows if r[0] % 1500 < 100]
    want = brute_near(rows)
    assert sum(n for n, _ in want.values()) >= 3000
    plans, plan = [], itq.plan
    monkeypatch.setattr(itq, "plan", lambda *args: plans.append(plan(*args)) or plans[-1])
    for cost, some in ((1000, few), (1000, rows), (3, few), (3, rows)):
        monkeypatch.setattr(itq, "TABLE_COST", cost)
        df = spark.createDataFrame(some, "vec_id long, embedding array<float>, label int")
        assert {r.vec_id: (r.n_links, r.component_id) for r in itq.links(df).collect()} == {r[0]: want[r[0]] for r in some}
    assert all(bits >= 1 for bits, *_ in plans) and len({p[:2] for p in plans}) > 1


def test_itq_block_roots():
    """Blocks of two sides, against brute force."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, copies = rng.permutation(40).astype(np.int64), np.ones(40, dtype=np.int64)
    keys = np.zeros((40, 1), dtype=np.int64)
    rows = [(int(i), v.tolist(), i < 0) for i, v in zip(ids, x)]
    n, low, low_r = itq._block_links(*[(ids, x, keys, copies)] * 2, 0, 0.9)
    want = brute_near(rows, 0.9)
    assert {int(i): (int(a), int(b)) for i, a, b in zip(ids, n, low)} == want and (low == low_r).all()
    n, low, low_r = itq._block_links(*((ids[s], x[s], keys[s], copies[s]) for s in (slice(0, 20), slice(20, 40))), 0, 0.9)
    near = x[:20] @ x[20:].T >= 0.9
    assert (n == near.sum(axis=1)).all()
    for i, j in zip(*np.nonzero(near)):
        assert low[i] == low_r[j] <= min(ids[i], ids[20 + j])


def test_warc(spark, scratch):
    body = "x" * 120
    rows = [(3, "http://a/\r\nb", body), (1, "http://a", body), (1, "http://a", body), (2, None, None), (4, "u", "tiny"), (5, "u", "tiny"),
            (None, "u", body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit(7))
    manifest = warc.write_archives(pages, scratch, shard_bytes=300, roll_bytes=150)
    got = sorted(warc.read_archives(spark, manifest, scratch).collect(), key=str)
    assert len(got) == len(rows) and manifest.count() > 2
    kinds = [(r.page_id, r.record_type, r.refers_to) for r in got]
    assert kinds.count((1, "response", None)) == 1 and kinds.count((1, "revisit", 1)) == 1
    assert (3, "revisit", 1) in kinds and (5, "response", None) in kinds and (None, "revisit", 1) in kinds
    again = warc.write_archives(pages, scratch + "/again", shard_bytes=300, roll_bytes=150)
    names = sorted(r.name for r in manifest.collect())
    assert names == sorted(r.name for r in again.collect())
    for n in names:
        assert open(f"{scratch}/{n}", "rb").read() == open(f"{scratch}/again/{n}", "rb").read()
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(open(f"{scratch}/{names[0]}", "rb").read()[:-9])))
    empty = warc.write_archives(pages.limit(0), scratch + "/empty")
    assert warc.read_archives(spark, empty, scratch + "/empty").count() == 0
