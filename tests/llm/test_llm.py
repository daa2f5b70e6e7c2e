"""Each operator against a brute-force version, on texts with nulls, blanks, copies, ties, long rows and clashing columns."""

import base64
import hashlib
import itertools
import math
import random
import time
import zlib
from collections import Counter, defaultdict, deque

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerleaf.llm import bpe, chat_tools, embedding_dedup, line_dedup, lm_scoring, minhash_dedup, packing, quality_rules, substring_dedup, warc

WORD_BPE, RANKS = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")


def made_texts():
    r = random.Random(5)
    vocabulary = ["the", "of", "and", "Straße", "été", "x", "long-word", "12", "a", "tion", "ing", "ß"]
    base = [" ".join(r.choice(vocabulary) + r.choice(["", "", ".", ","]) for _ in range(r.randrange(1, 120))) for _ in range(24)]
    near = [" ".join(w if r.random() > 0.02 else "changed" for w in t.split()) for t in base for _ in range(2)]
    lines = ["A first line.\nA second line.\nOwn line %d.\n\nA first line.\nA second line." % k for k in range(4)]
    hot = ["one hot passage that many documents share word by word until the very end of it all " + str(k) for k in range(40)]
    odd = [None, "", " \n\t ", "\x0b\x0c", "word", "a b c d e f g h i j k l m", "same " * 3000, "x y z 😀 <|endoftext|>", "\x1c\x1fq"]
    return base + near + base[:5] + lines + hot + odd


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", None if k % 7 == 0 else f"s{k % 3}", "mine") for k, t in enumerate(made_texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def groups(links, ids):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_substring_dedup(spark, docs, empty, monkeypatch):
    rows = {r.doc_id: split(r.text) for r in docs.collect()}
    first = {}
    for d in sorted(rows):
        for i in range(len(rows[d]) - 12):
            first.setdefault(tuple(rows[d][i : i + 13]), d)
    for small in (False, True):  # the second time with many buckets and frequent minimisers split
        if small:
            monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 2000)
            monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 5000)
        got = {r.doc_id: r for r in substring_dedup.substring_dedup(docs).collect()}
        assert len(got) == len(rows)
        for d, w in rows.items():
            gone = set()
            for i in range(len(w) - 12):
                if first[tuple(w[i : i + 13])] < d:
                    gone.update(range(i, i + 13))
            kept = [x for i, x in enumerate(w) if i not in gone]
            assert (got[d].n_words, got[d].n_removed) == (len(w), len(gone)), d
            assert got[d].kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()
            assert split(got[d].text) == kept
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_substring_dedup_rows_of_one_id(spark):
    text = " ".join(f"w{k}" for k in range(20))
    got = substring_dedup.substring_dedup(spark.createDataFrame([(1, text), (1, text), (None, text), (2, "a")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 0), (False, 0), (False, 0), (True, 20)]


def test_quality_rules(docs, empty):
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    for r in docs.collect():
        w, text, g = split(r.text), r.text or "", got[r.doc_id]
        win = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        often = {i + j for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if split(x)]
        assert (g.n_words, g.word_chars, g.n_repeat_words) == (len(w), sum(map(len, w)), len(often)), r.doc_id
        assert g.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert g.n_dup_lines == len(lines) - len(set(lines))
        assert g.base_failed == (len(w) < 50 or 100 * len(often) > 50 * len(w))
        assert not (g.kept and g.base_failed)
    assert quality_rules.quality_rules(empty).count() == 0


def test_quality_lines(spark):
    prose = "This is a line of plain prose, and it ends well. " * 8
    cases = {prose: True, prose + "\nAll rights reserved.": True, "A | B | C | D | " * 20: False, prose.upper(): False, "noise### more%%% and$$$ " * 30: False}
    rows = [(k, t) for k, t in enumerate(cases)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("base_failed", F.lit(False)).collect()}
    for k, (t, good) in enumerate(cases.items()):
        assert (got[k].loss <= quality_rules.MAX_LOSS) == good, t
    assert "rights" not in got[1].clean_text


def test_every_boilerplate_wording_has_a_hint(spark):
    lines = ["Please enable JavaScript.", "Alle Rechte vorbehalten.", "Zur Datenschutzerklärung, bitte.", "Impressum.", "Cookies akzeptieren.", "Bitte hier klicken.", "Mehr dazu: weiterlesen", "Jetzt: mehr erfahren", "Newsletter abonnieren.",
             "Tous droits réservés.", "Politique de confidentialité.", "Mentions légales.", "Conditions d’utilisation.", "Accepter les cookies.", "Cliquez ici.", "Voir: lire la suite", "Abonnez-vous.",
             "Todos los derechos reservados.", "Política de privacidad.", "Aviso legal.", "Condiciones de uso.", "Haga clic aquí.", "Ver: leer más", "Suscríbase."]
    rows = [(k, "Plain prose, as it is. \n" + x) for k, x in enumerate([*lines, "El aviso fue leal, no legal.", "Er klickte, und es ging weiter."])]
    got = {r.doc_id: r.n_bad_lines for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: int(k < len(lines)) for k, _ in rows}


def test_lm_scores(docs, empty):
    got = {r.doc_id: r for r in lm_scoring.lm_scores(docs, WORD_BPE).collect()}
    count, tokens = Counter(), {}
    for r in docs.collect():
        tokens[r.doc_id] = [w.decode() for w in (r.text or "").encode().lower().split()] + [None]
        if zlib.crc32(str(r.doc_id).encode()) % 10:
            count.update(tokens[r.doc_id])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(tokens)
    for d, t in tokens.items():
        g = got[d]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (zlib.crc32(str(d).encode()) % 10 == 0, len(t), sum(count[x] > 0 for x in t), n)
        assert math.isclose(g.base_score, sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t), rel_tol=1e-9)
        assert math.isfinite(g.score) and g.score < 0
    assert lm_scoring.lm_scores(empty, WORD_BPE).count() == 0


def small_tables(r, size=9, classes=6, behind=4):
    n = r.integers(0, 50, size).astype(float)
    of, back = r.integers(0, classes, size), r.integers(0, behind, size)
    of[:classes], back[:behind] = np.arange(classes), np.arange(behind)
    follow = lm_scoring.followers(r.integers(0, 9, (size, classes)).astype(float), np.full(classes, 1 / classes))
    return lm_scoring.Tables(n, of, back, r.normal(0, 1, (size, 5)).astype(np.float32), follow, r.integers(0, 3, (size, behind)).astype(np.float32))


def test_attention_is_causal_normalised_and_has_the_right_gradient():
    r = np.random.default_rng(3)
    tables, model = small_tables(r), lm_scoring.Attention(5, 4, 6)
    model.load(model.numbers() + 0.3 * r.normal(0, 1, len(model.numbers())))
    x = r.integers(0, 9, (3, lm_scoring.WINDOW))
    *_, z, total = model.forward(x, tables)
    later = x.copy()
    later[:, -1] = (later[:, -1] + 1) % 9  # the last input must not change what is said before it
    *_, z2, total2 = model.forward(later, tables)
    same = np.arange(len(z)) % lm_scoring.STEP != lm_scoring.STEP - 1
    assert np.allclose((z / total[:, None])[same], (z2 / total2[:, None])[same], atol=1e-6)
    inside = np.exp(tables.member())
    assert all(np.allclose(inside[tables.of == c].sum(axis=0), 1, atol=1e-5) for c in range(6))
    y, w = r.integers(0, 6, 3 * lm_scoring.STEP), (r.random(3 * lm_scoring.STEP) < 0.8).astype(np.float32)
    grad = model.step(x, y, w, tables)

    def loss():
        *_, z, total = model.forward(x, tables)
        return -(w * (np.log(z[np.arange(len(z)), y]) - np.log(total))).sum() / w.sum()

    for name in model.NAMES:
        a = getattr(model, name).astype(np.float64)
        setattr(model, name, a)
        for at in (0, a.size // 2, a.size - 1):
            if name == "rel" and at == a.size - 1:
                continue  # the last new position alone is so far from the first input
            keep = a.ravel()[at]
            a.ravel()[at] = keep + 1e-3
            up = loss()
            a.ravel()[at] = keep - 1e-3
            down = loss()
            a.ravel()[at] = keep
            assert abs((up - down) / 2e-3 - grad[name].ravel()[at]) < 2e-3, (name, at)


def test_scores_token_by_token():
    r = np.random.default_rng(5)
    tables, model, end = small_tables(r), lm_scoring.Attention(5, 4, 6), 8
    model.load(model.numbers() + 0.3 * r.normal(0, 1, len(model.numbers())))
    per = np.array([1, 3, 24, 25, 100, 7])
    ids = r.integers(0, 8, per.sum())
    ids[np.cumsum(per) - 1] = end
    got, at = lm_scoring.document_scores(ids, per, end, model, tables), 0
    soft = lambda v: np.exp(v - v.max()) / np.exp(v - v.max()).sum()
    for k, size in enumerate(per):
        doc, total = ids[at : at + size], 0.0
        inputs = np.append(end, doc[:-1])
        for i in range(size):
            first = i // lm_scoring.STEP * lm_scoring.STEP - (lm_scoring.WINDOW - lm_scoring.STEP)
            seen = [inputs[p] if p >= 0 else end for p in range(first, i + 1)]
            e = tables.embedding[seen].astype(np.float64)
            score = e @ model.k @ (e[-1] @ model.q) / 2 + model.rel[np.arange(len(seen))[::-1]]
            h = np.tanh(soft(score) @ (e @ model.v) + e[-1] @ model.own)
            p = soft(h @ model.out + model.bias + tables.follow[seen[-1]])[tables.of[doc[i]]]
            total += np.log10(p) + tables.member()[doc[i], tables.behind[seen[-1]]] / np.log(10)
        assert math.isclose(got[k], total, rel_tol=1e-4)
        at += size


def test_scores_beat_the_unigrams_on_held_out_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in lm_scoring.lm_scores(df, WORD_BPE).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in got)
    assert sum(r.score for r in got) / tokens > sum(r.base_score for r in got) / tokens  # log10 per token


def test_tables_count_all_training_tokens(spark):
    r, end = np.random.default_rng(1), 5000
    rows, want = [], np.zeros((end + 1, 3))
    kind = r.integers(0, 3, end + 1)
    for chunk in range(3):
        sizes, lengths = np.array([4, 0, 6]), np.ones(10, np.int64)
        flat, pieces, trains = np.arange(10, dtype=np.uint32), r.integers(0, end, 10).astype(np.uint32), np.array([True, True, chunk != 1])
        rows.append((lm_scoring._pack(np.arange(3), trains, sizes, flat, lengths, pieces),))
        for d, (a, z) in enumerate(((0, 4), (4, 4), (4, 10))):
            doc = [*pieces[a:z].tolist(), end]
            for before, after in zip([end, *doc], doc):
                want[before, kind[after]] += trains[d]
    (table,) = lm_scoring._table(spark.createDataFrame(rows, "data binary"), end, [(True, kind, 3)])
    assert np.array_equal(table, want)


def test_embedding_dedup(spark, monkeypatch):
    r = np.random.default_rng(1)
    base = r.standard_normal((60, 16))
    near = base[:20] + 0.02 * r.standard_normal((20, 16))
    hot = base[0] + 0.01 * r.standard_normal((30, 16))
    vectors = [*base, *near, *hot, *base[:6], base[7] * 3]
    rows = [(k, [float(e) for e in v], "mine") for k, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    rows += [(1000 + k, v, "mine") for k, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    pairs = [(i, j) for i, j in itertools.combinations(range(len(vectors)), 2) if unit[i] @ unit[j] >= 0.95]
    degree = Counter(x for p in pairs for x in p)
    part = groups(pairs, [x[0] for x in rows])
    for cell in (embedding_dedup.CELL, 16):  # the second time with cells split on both sides
        monkeypatch.setattr(embedding_dedup, "CELL", cell)
        got = {x.vec_id: x for x in embedding_dedup.embedding_dedup(df).collect()}
        assert {k: (g.n_links, g.component_id, g.kept) for k, g in got.items()} == {k: (degree[k], part[k], part[k] == k) for k in part}
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_long_vectors_deal_their_blocks_not_themselves(spark, monkeypatch):
    r = np.random.default_rng(3)
    base = r.standard_normal((120, 768))
    vectors = [*base, *(base[:40] + 0.1 * r.standard_normal((40, 768)))]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    dealt = []
    deal = embedding_dedup.deal
    monkeypatch.setattr(embedding_dedup, "deal", lambda *a: dealt.append(deal(*a)) or dealt[-1])
    got = {x.vec_id: (x.n_links, x.component_id) for x in embedding_dedup.embedding_dedup(df).collect()}
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    assert got == {k: (int(near[k].sum()) - 1, int(np.flatnonzero(near[k])[0])) for k in range(len(vectors))}
    rows, most, spent = dealt[0].agg(F.count(F.lit(1)), F.max(F.length("at")), F.sum(F.length("at"))).first()
    assert most == 4 * (embedding_dedup.WIDTH + embedding_dedup.BESIDE)
    assert spent < rows * 8 * 768 / 50  # whole vectors would be more than 50 times that


def test_minhash_dedup(docs, empty, monkeypatch):
    sets = {}
    for r in docs.collect():
        w = (r.text or "").encode().lower().split()
        sets[r.doc_id] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} - {()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    part = groups(links, sets)
    docs = docs.withColumns({c: F.lit(0) for c in ("component", "node", "id", "a.b")})
    for small, limit in ((minhash_dedup.SMALL, minhash_dedup.LIMIT), (2, minhash_dedup.LIMIT), (2, 8)):  # then every region is large, then over the limit too
        monkeypatch.setattr(minhash_dedup, "SMALL", small)
        monkeypatch.setattr(minhash_dedup, "LIMIT", limit)
        got = {r.doc_id: r for r in minhash_dedup.minhash_dedup(docs).collect()}
        assert {d: (g.n_shingles, g.component_id, g.kept) for d, g in got.items()} == {d: (len(s), part[d], part[d] == d) for d, s in sets.items()}
    assert minhash_dedup.minhash_dedup(empty).count() == 0


def test_minhash_of_hubs_and_documents_of_several_texts(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "TOGETHER", 3)
    monkeypatch.setattr(minhash_dedup, "SMALL", 4)
    r = random.Random(3)
    words = [f"w{r.randrange(10**6)}" for _ in range(200)]
    rows = [(k, " ".join([*words[:k], f"x{k}", *words[k + 1 :]])) for k in range(40)]
    other = " ".join(f"o{k}" for k in range(50))
    rows += [(100, other), (100, " ".join(words)), (101, other + " end"), (102, "alone in all")]
    got = {x.doc_id: x.component_id for x in minhash_dedup.minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{k: 0 for k in range(40)}, 100: 0, 101: 0, 102: 102}


def test_forest_pairs_small_regions_and_splits_large_ones():
    r = np.random.default_rng(2)
    tail = np.sort(r.integers(0, 3, (90, minhash_dedup.TAIL)).astype(np.uint8).view(f"V{minhash_dedup.TAIL}").ravel()).view(np.uint8).reshape(90, -1)
    tail[20:34] = tail[20]
    region = np.repeat([1, 2, 3], [34, 54, 2])
    node = r.permutation(90)
    common = minhash_dedup.prefixes(region, tail)
    assert [int(common[i]) for i in (0, 34, 88)] == [-1, -1, -1]
    for i in range(1, 90):
        if common[i] >= 0:
            c = int(common[i])
            assert (tail[i][:c] == tail[i - 1][:c]).all() and (c == minhash_dedup.TAIL or tail[i][c] != tail[i - 1][c])
    i, j, member, first = minhash_dedup.candidates(node, common, 8)
    pairs = set(zip(i.tolist(), j.tolist())) | set(zip(j.tolist(), i.tolist()))
    assert (88, 89) in pairs and all(region[a] == region[b] for a, b in pairs)
    assert {a for a in range(88)} <= set(member.tolist()) and all(node[b] <= node[a] for a, b in zip(member.tolist(), first.tolist()))
    up = groups([(int(node[a]), int(node[b])) for a, b in pairs], range(90))
    assert len({up[int(x)] for x in node[:34]}) == 1 and len({up[int(x)] for x in node[34:88]}) == 1
    for a in range(34, 88):  # everyone meets the neighbour of the longer common prefix
        beside = {k: common[max(a, k)] for k in (a - 1, a + 1) if 34 <= k < 88}
        assert any((a, k) in pairs for k, n in beside.items() if n == max(beside.values()))


def test_packing(docs, empty):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    for length in (4096, 64):
        by, seqs = defaultdict(list), defaultdict(list)
        for r in packing.pack(docs, WORD_BPE, 2, length).collect():
            by[r.doc_id].append(r)
            seqs[r.sequence_id].append(r)
        for d, x in ids.items():
            at = 0
            for r in sorted(by[d], key=lambda r: r.start):
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(x), zlib.crc32(np.array(x[at : at + r.length], "<u4").tobytes()))
                at += r.length
            assert at == len(x)
        sizes = []
        for s in range(len(seqs)):
            at = 0
            for r in sorted(seqs[s], key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            sizes.append(at)
        assert all(n & (n - 1) == 0 and n <= length for n in sizes)
    assert packing.pack(empty, WORD_BPE, 2).count() == 0


def test_packing_puts_sources_of_weight_nothing_last(spark):
    rows = spark.createDataFrame([(k, "a b c", f"s{k % 3}") for k in range(300)], "doc_id long, text string, source string")
    order = [r.doc_id for r in sorted(packing.pack(rows, WORD_BPE, 2, 64, {"s1": 0.0}).where("start = 0").collect(), key=lambda r: (r.sequence_id, r.offset))]
    assert len(order) == 300 and [d % 3 == 1 for d in order] == [False] * 200 + [True] * 100
    assert packing.pack(rows, WORD_BPE, 2, 64, {"s0": 0.0, "s1": 0.0, "s2": 0.0}).where("start = 0").count() == 300
    with pytest.raises(ValueError):
        packing.pack(rows, WORD_BPE, 2, 64, {"s1": -1.0})


def test_packing_serves_a_rare_source_at_once():
    queues = {"rare": deque([(0, 10)]), "all": deque((k, 1000) for k in range(1, 4000))}
    began = time.time()
    order = list(packing.serve(queues, {"rare": 0.0, "all": 0.0}, {"rare": 1e-12, "all": 1 - 1e-12}, 4096))
    assert len(order) == 4000 and order[-1] == 0 and time.time() - began < 1


def test_packing_follows_targets():
    queues = {"a": deque((k, 100) for k in range(300)), "b": deque((1000 + k, 30) for k in range(1000))}
    order = list(packing.serve({q: deque(v) for q, v in queues.items()}, {"a": 0.0, "b": 0.0}, {"a": 0.25, "b": 0.75}, 4096))
    size = {r: n for v in queues.values() for r, n in v}
    a = sum(size[r] for r in order[:800] if r < 1000)
    assert abs(a / sum(size[r] for r in order[:800]) - 0.25) < 0.05
    assert sorted(order) == sorted(size)


def test_packing_mixes_more_sources_than_a_few_hundred(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 4096)
    small = [(k, "a b c", f"s{k // 4}") for k in range(1600)]  # 400 sources, the rows of each together
    large = [(2000 + k, "a b c", "large") for k in range(1600)]
    once = [(4000 + k, "a b c", f"once{k}") for k in range(400)]
    rows = spark.createDataFrame(small + large + once, "doc_id long, text string, source string").coalesce(2)
    n = len(small) + len(large) + len(once)
    for targets in (None, {"s399": 0.5}):
        order = [r.doc_id for r in sorted(packing.pack(rows, WORD_BPE, 2, 64, targets).where("start = 0").collect(), key=lambda r: (r.sequence_id, r.offset))]
        assert len(order) == n
        places = defaultdict(list)
        for at, d in enumerate(order):
            places["small" if d < 2000 else "large" if d < 4000 else "once"].append(at / n)
            if d < 1600:
                places[d // 4].append(at / n)
        for kind in ("small", "large", "once"):  # each kind is spread evenly
            assert max(abs(x - (k + 0.5) / len(places[kind])) for k, x in enumerate(places[kind])) < 0.1, kind
        for k in range(400 if targets is None else 399):  # a document of a source in each quarter of the windows
            assert all(abs(x - (j + 0.5) / 4) < 0.2 for j, x in enumerate(places[k])), k
        if targets:  # weight 0.5 beside 1: a third of the tokens until its four documents are gone
            assert places[399][-1] < 0.02


def test_warc(spark, monkeypatch):
    long = "<p>" + "x y z " * 60000
    rows = [(1, "http://a/b\r\nc", "<html>é</html>"), (2, None, "same"), (3, "u", "same"), (4, "u", None), (5, "u", ""), (6, "u", long), (7, "u", "a\r\n\r\nb\r\n"), (8, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    monkeypatch.setattr(warc, "STEP", 1000)
    for least in (0, 10):
        first = {}
        got = {r.page_id: r for r in warc.warc_round_trip(pages, least).collect()}
        assert len(got) == len(rows)
        for k, _, html in rows:
            raw = (html or "").encode()
            f = first.setdefault(raw, k) if len(raw) >= least else k
            assert (got[k].payload_bytes, got[k].payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
            assert (got[k].record_type, got[k].refers_to) == (("response", None) if f == k else ("revisit", f))
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_bpe(docs, empty):
    coding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = {r.doc_id: r for r in bpe.bpe_round_trip(docs, RANKS, P.PATTERN).collect()}
    for r in docs.collect():
        assert got[r.doc_id].ids == coding.encode_ordinary(r.text or "")
        assert bytes(got[r.doc_id].decoded) == (r.text or "").encode() and got[r.doc_id].text == (r.text or "")
    again = {r.doc_id: r.text for r in bpe.bpe_decode(bpe.bpe_encode(docs, RANKS, P.PATTERN), RANKS).collect()}
    assert again == {d: g.text for d, g in got.items()}
    assert bpe.bpe_round_trip(empty, RANKS, P.PATTERN).count() == 0


def test_transducer_on_any_bytes():
    ranks = bpe.read_ranks(RANKS)
    coding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    transducer, decoder, r = bpe.Transducer(ranks), bpe.Decoder(ranks), random.Random(2)
    for k in range(1500):
        raw = bytes(r.randrange(256) if k % 2 else r.choice(b"theing aore-") for _ in range(r.randrange(1, 40)))
        ids = transducer.encode(raw)
        assert ids == coding._encode_single_piece(raw)
        assert decoder.decode(np.array(ids, np.int32)) == (raw, raw.decode("utf-8", "replace"))


def test_units_are_cut_between_matches():
    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choice("ab é  \n\t\x85 1².,'s_́") for _ in range(r.randrange(1, 20)))
        assert [p for u in bpe.UNIT.findall(text) for p in regex.findall(P.PATTERN, u)] == regex.findall(P.PATTERN, text)


def test_other_patterns_are_matched_on_whole_texts():
    ranks, crossing = bpe.read_ranks(RANKS), r"\S+ \S+|\s+|\S+"
    texts = ["one two three", "a  b c. d!", "", "été, Straße. don't it's x"]
    for pattern in (crossing, P.PATTERN):
        coding, encoder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), bpe.Encoder(ranks, pattern)
        assert encoder.in_units == (pattern == P.PATTERN)
        assert [np.frombuffer(encoder.encode(t), np.int32).tolist() for t in texts] == [coding.encode_ordinary(t) for t in texts]


def test_chat_tools(spark):
    schemas = {"find": {"q": ("string", True), "n": ("integer", False)}}
    calls = [
        (1, "a", None, 0, "find", '{"q": "x", "n": 2}'), (1, "b", "a", 1, "find", '{"n": 1.5}'), (1, "c", "b", 2, "other", "{}"), (1, "d", "gone", 3, "find", "no json"),
        (1, "e", "f", 4, "find", None), (1, "f", "e", 5, "find", '{"q": 1, "z": 0}'), (1, "a", None, 9, "find", '{"q": "again"}'), (2, None, None, 0, "find", '{"q": "x"}'),
    ]
    results = [(1, "a", 7, "late"), (1, "a", 1, "früh"), (1, "zz", 1, "lost"), (1, None, 1, "none")]
    got = chat_tools.link_tool_calls(
        spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string, turn long, name string, arguments string"),
        spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string"), schemas,
    ).collect()
    by = {(r.call_id, r.turn): r for r in got}
    assert len(got) == len(calls) + 3
    assert [by["a", 7].status, by["zz", 1].status, by[None, 1].status] == ["further_result", "orphan_result", "orphan_result"]
    assert [r.call_id for r in sorted(got, key=lambda r: (r.conv_id, r.position))][:4] == ["a", "d", "a", "b"]
    assert by["a", 0].json == '{"arguments":{"n":2,"q":"x"},"call_id":"a","conv_id":1,"depth":0,"name":"find","result":"früh","status":"linked","turn":0}'
    assert (by["a", 0].n_results, by["a", 0].valid, by["a", 9].status) == (2, True, "repeated")
    assert (by["b", 1].depth, by["c", 2].depth, by["e", 4].depth, by["e", 4].status) == (1, 2, None, "cycle")
    assert (by["d", 3].parent_missing, by["d", 3].depth, by["d", 3].errors) == (True, 0, ["arguments: not an object"])
    assert by["b", 1].errors == ["q: missing", "n: not integer"] and by["c", 2].errors == ["unknown tool other"] and by["f", 5].errors == ["q: not string", "z: unknown"]


def test_numbers_of_arguments_are_exact_or_an_error(spark):
    numbers = {
        "1.0": ("1", True), "1.10": ("1.1", False), "12345678901234567890": ("12345678901234567890", True), "9" * 38: ("9" * 38, True), "-2": ("-2", True), "1e2": ("100.0", False), "0e-999": ("0.0", False),
        "9" * 39: None, "0." + "0" * 40 + "1": None, "1e400": None, "-1E400": None, "1e-400": None, "1e-310": None, "1.2345678901234567e5": None,
    }
    texts = [f'{{"n":{x},"q":"1e999\\\\\\"{"9" * 50}"}}' for x in numbers] + ['{"n":1,"n":2}', '{"n":1,"q":"' + "x" * 200_000 + '"}']
    calls = spark.createDataFrame([(1, f"{k:02}", None, k, "t", x) for k, x in enumerate(texts)], "conv_id long, call_id string, parent_id string, turn long, name string, arguments string")
    got = chat_tools.link_tool_calls(calls, calls.select("conv_id", "call_id", "turn", F.lit("").alias("content")).limit(0), {"t": {"n": ("integer", True), "q": ("string", False)}}).orderBy("turn").collect()
    for r, (x, out) in zip(got, numbers.items()):
        if out is None:
            assert r.errors == ["arguments: number not exact"] and r.json.startswith('{"arguments":null,')
        else:
            assert r.errors == ([] if out[1] else ["n: not integer"]) and r.json.startswith(f'{{"arguments":{{"n":{out[0]},"q"'), x
    assert got[-2].errors == ["arguments: not an object"] and got[-1].valid


def brute_lines(rows, least):
    lines = {d: [x for x in (t or "").split("\n") if split(x)] for d, t in rows}
    seen, gone = set(), defaultdict(set)
    for d in sorted(lines):
        for i in range(len(lines[d]) - least + 1):
            run = tuple(lines[d][i : i + least])
            if run in seen:
                gone[d].update(range(i, i + least))
            seen.add(run)
    return lines, gone


@pytest.mark.parametrize("least", [1, 2, 3])
def test_line_dedup(spark, docs, empty, least):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000, "p\nq\nr\ns\nt"), (1001, "z\np\nq\nr\ns\nt"), (1002, "q\n \nr\ns\ny"), (1003, "p\nq\np\nq\np\nq")]
    got = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), least).collect()}
    lines, gone = brute_lines(rows, least)
    for d, t in rows:
        assert (got[d].n_lines, got[d].n_removed_lines) == (len(lines[d]), len(gone[d])), d
        assert [x for x in (got[d].clean_text or "").split("\n") if split(x)] == [x for i, x in enumerate(lines[d]) if i not in gone[d]]
        assert (got[d].clean_text is None) == (t is None)
    assert line_dedup.line_dedup(empty, least).count() == 0


def test_line_dedup_deletes_wide_single_lines(spark, docs, empty):
    import corpus_pipeline

    wide = " ".join(f"w{k}" for k in range(13))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000, f"p\n{wide}\nq"), (1001, f"r\n{wide}\ns"), (1002, wide), (1003, f"t\n {wide[3:]}\nu"), (1004, f"v\n {wide[3:]}\nw\np\nx"), (1005, f"{wide}\n{wide}")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    lines, gone = brute_lines(rows, 2)
    lines, single = brute_lines(rows, 1)
    want = {d: gone[d] | {i for i in single[d] if len(split(lines[d][i])) >= 13} for d in lines}
    assert (want[1001], want[1002], want[1003], want[1004], want[1005]) == ({1}, {0}, set(), set(), {0, 1})
    left = {d: [x for i, x in enumerate(lines[d]) if i not in want[d]] for d in lines}
    got = {r.doc_id: r for r in line_dedup.line_dedup(given, min_words=13).collect()}
    assert {d: g.n_removed_lines for d, g in got.items()} == {d: len(x) for d, x in want.items()}
    assert {d: [x for x in (g.clean_text or "").split("\n") if split(x)] for d, g in got.items()} == left
    stage = {r.doc_id: [x for x in (r.text or "").split("\n") if split(x)] for r in corpus_pipeline.lines(spark, given, "").collect()}
    assert stage == {d: x for d, x in left.items() if x or not lines[d]}  # a copy of one line is gone as a whole
    assert line_dedup.line_dedup(empty, min_words=13).count() == 0


def test_line_dedup_of_long_copies(spark):
    lines = "\n".join(f"line {k}" for k in range(3000))
    gone = line_dedup.repeated_lines(spark.createDataFrame([(1, lines), (2, "own\n" + lines)], "doc_id long, text string"))
    assert gone.count() == 3000
    assert [r.n_removed_lines for r in line_dedup.line_dedup(spark.createDataFrame([(1, lines), (2, lines)], "doc_id long, text string")).orderBy("doc_id").collect()] == [0, 3000]


def near_groups(rows, width):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
    return groups([(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])], sets)


def test_pipeline_near_copies_share_five_words(spark, docs):
    import corpus_pipeline

    words = [f"w{k}" for k in range(40)]  # one word changed: similarity 33/41 in shingles of four words, 31/41 in those of five
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(1000, " ".join(words)), (1001, " ".join([*words[:20], "changed", *words[21:]]))]
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.near(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect() if r.text is not None)
    part = near_groups(rows, 5)
    assert near_groups(rows, 4)[1001] == 1000
    assert got == sorted((d, t) for d, t in rows if part[d] == d and t is not None)


def test_names_never_clash(docs):
    names = ["_keys", "_words", "_lines", "_low", "component", "node", "chunk", "d", "h", "n", "id", "a.b", "row", "found"]
    small = docs.limit(12).select("doc_id", "text", "source")
    given = small.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    runs = {
        "substring": substring_dedup.substring_dedup, "quality": quality_rules.quality_rules, "near": minhash_dedup.minhash_dedup, "line": line_dedup.line_dedup,
        "bpe": lambda df: bpe.bpe_encode(df, RANKS, P.PATTERN),
    }
    for name, run in runs.items():
        rows = run(given).collect()
        assert len(rows) == 12, name
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names), name
    assert {r.doc_id for r in packing.pack(given, WORD_BPE, 2).collect()} == set(range(12)) and lm_scoring.lm_scores(given, WORD_BPE).count() == 12
    vectors = small.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0), F.col("doc_id").cast("double")).alias("embedding")).withColumns({c: F.concat(F.lit(c), F.col("vec_id")) for c in [*names, "at", "links", "part", "digest", "size"]})
    assert all(r[c] == f"{c}{r.vec_id}" for r in embedding_dedup.embedding_dedup(vectors).collect() for c in names)


def test_very_large_and_small_vectors_link(spark):
    rows = [(k, [x] * 16) for k, x in enumerate((1e200, 1.5e200, 1e-200, 3e-200, -1e200))]
    got = {r.vec_id: r.component_id for r in embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4}


def test_scratch_goes(spark, docs):
    from ledgerleaf.llm.common import save, scratch

    with scratch(spark):
        kept = save(docs, "x")
        folder = kept.inputFiles()[0].rpartition("/")[0]
        assert spark.read.parquet(folder).count() == kept.count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder).count()


def brute_rules(rows):
    """What the quality stage keeps: the same rules, line by line in plain Python."""
    out = []
    for d, text in rows:
        w, lines = split(text), (text or "").split("\n")
        win = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        often = {i + j for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for j in range(3)}

        def ok(x):
            n = x.count(" ") + 1
            shout = not regex.search(r"\p{Ll}", x) and len(regex.findall(r"\p{Lu}", x)) >= 8
            return not split(x) or bool(regex.search(quality_rules.SENTENCE.replace("\\z", "\\Z"), x)) and x.count("|") * 5 <= n and sum(x.count(c) for c in quality_rules.SYMBOLS) * 10 <= n and not shout and not regex.search(quality_rules.BOILERPLATE.replace("\\z", "\\Z"), x)

        good = [x for x in lines if ok(x)]
        size = lambda t: sum(len(x) for x in split(t))
        if len(w) >= 50 and 100 * len(often) <= 50 * len(w) and 1 - size("\n".join(good)) / max(1, size(text)) <= quality_rules.MAX_LOSS:
            out.append((d, "\n".join(good)))
    return out


def test_pipeline_against_plain_versions_of_its_stages(spark):
    import corpus_pipeline

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = lambda rows: sorted((d, split(t)) for d, t in rows)
    now, rows = df, [(r.doc_id, r.text) for r in df.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "quality rules":
            want = brute_rules(rows)
        elif name == "line dedup":
            (lines, gone), (_, single) = brute_lines(rows, 2), brute_lines(rows, 1)
            left = {d: [x for i, x in enumerate(lines[d]) if i not in gone[d] and not (i in single[d] and len(split(x)) >= 13)] for d in lines}
            want = [(d, "\n".join(x)) for d, x in left.items() if x or not lines[d]]
        elif name == "minhash near-dedup":
            part = near_groups(rows, 5)
            want = [(d, t) for d, t in rows if part[d] == d]
        else:
            first, given, want = {}, {d: split(t) for d, t in rows}, []
            for d in sorted(given):
                for i in range(len(given[d]) - 12):
                    first.setdefault(tuple(given[d][i : i + 13]), d)
            for d, w in given.items():
                gone_ = {i + j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < d for j in range(13)}
                if len(gone_) < len(w) or not w:
                    want.append((d, " ".join(x for i, x in enumerate(w) if i not in gone_)))
        now = spark.createDataFrame((out := stage(spark, now, "")).collect(), out.schema)
        rows = [(r.doc_id, r.text) for r in now.collect()]
        assert words(rows) == words(want), name
        assert len(rows) > 50 and out.columns == df.columns
    tokenizer = Tokenizer.from_file(WORD_BPE)
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows}
    got = defaultdict(list)
    for r in corpus_pipeline.STAGES[-1][1](spark, now, "").collect():
        got[r.doc_id].append((r.start, r.length, r.ids_crc32))
    assert got.keys() == ids.keys()
    for d, x in ids.items():
        assert sum(n for _, n, _ in got[d]) == len(x)
        assert all(crc == zlib.crc32(np.array(x[a : a + n], "<u4").tobytes()) for a, n, crc in got[d])


def test_pipeline_of_odd_and_empty_tables(spark, docs, empty):
    import corpus_pipeline

    for given in (docs.drop("kept"), empty):
        now = given
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, "")
            if name != "packing":
                assert out.columns == given.columns
                now = spark.createDataFrame(out.collect(), out.schema)
        left = {r.doc_id for r in now.collect()}
        assert {r.doc_id for r in out.collect()} == left and bool(left) == (given is not empty)
