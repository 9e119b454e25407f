"""Source divergence, fill-in-middle and language-model scoring against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import divergence, infill, maxent
from sluice.llm.common import table
from tests.llm.conftest import edge_rows

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# ---------------------------------------------------------------- divergence

def brute_divergence(rows, min_docs, top):
    """rows: (lang, source, text) -> the audit's rows, dense and in whole numbers."""
    rows = [tuple(v or "" for v in r) for r in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = TERM.findall(fold(text))
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    kept = {lang: [t for t, n in c.items() if n >= min_docs] for lang, c in docs.items()}
    share = lambda n, total, v: 1 + 10**9 * (n + 5) // (total + 5 * v)
    p, out = {}, []
    groups = {(r[0], r[1]) for r in rows}
    for lang, source in groups:
        total = sum(counts[lang, source][t] for t in kept[lang])
        p[lang, source] = {t: share(counts[lang, source][t], total, len(kept[lang])) for t in kept[lang]}
    for lang, source in groups:
        whole = sum((c for (la, _), c in counts.items() if la == lang), Counter())
        total = sum(whole[t] for t in kept[lang])
        q = {t: share(whole[t], total, len(kept[lang])) for t in kept[lang]}
        own = p[lang, source]
        pairs = [(sum(abs(own[t] - p[lang, other][t]) for t in kept[lang]), other) for la, other in groups if la == lang and other != source]
        more = [(own[t] - q[t], t) for t in kept[lang] if counts[lang, source][t] and own[t] > q[t]]
        for part, found, limit in (("pair", pairs, None), ("term", more, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(found[:limit], 1)]
    return sorted(out)


def audit(df, **kw):
    return sorted(tuple(r) for r in divergence.divergence_audit(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("min_docs", [1, 3])
def test_divergence_matches_brute_force(spark, min_docs):
    rnd = random.Random(min_docs)
    words = ["The", "of", "river", "É", "été", "x2y", "a-b", "stone", "LIGHT", "walks"]
    rows = [(rnd.choice(["en", "fr", None]), rnd.choice(["s1", "s2", "s3", "S", None]),
             " ".join(rnd.choice(words[:rnd.randint(1, 10)]) for _ in range(rnd.randint(0, 12)))) for _ in range(80)]
    rows += [("en", "s1", "the copy of a text")] * 7 + [("en", "s2", "the copy of a text")] * 4 + [("en", "s4", "copy")]
    rows += [("zz", "only", "one source"), ("yy", "a", ""), ("yy", "b", None)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    assert audit(df, min_docs=min_docs, top=5) == brute_divergence(rows, min_docs, 5)


def test_divergence_on_edges(edge_docs, no_docs):
    rows = [(r[2], r[3], r[1]) for r in edge_rows()]
    assert audit(edge_docs, min_docs=2) == brute_divergence(rows, 2, 50)
    # no kept terms: the pairs stay, at distance 0, ordered by item
    none = audit(edge_docs, min_docs=99)
    assert none == brute_divergence(rows, 99, 50) and none and all(r[4] == 0 for r in none)
    assert audit(no_docs) == []


def test_divergence_flushes_and_slices(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [("en", f"s{rnd.randint(0, 6)}", " ".join(rnd.choice("abcdefghij") * rnd.randint(1, 3) for _ in range(20))) for _ in range(300)]
    batch = pa.RecordBatch.from_pylist([{"lang": "en", "text": r[2].encode(), "copies": [{"source": r[1], "n": 1}]} for r in rows])
    whole = list(divergence._count_terms(iter([batch])))
    monkeypatch.setattr(divergence, "HELD", 5)
    parts = list(divergence._count_terms(iter([batch])))

    def added(batches):
        out = Counter()
        for b in batches:
            for r in b.to_pylist():
                out[r["source"], r["term"], "n"] += r["n"]
                out[r["source"], r["term"], "docs"] += r["docs"]
        return out

    assert len(parts) > len(whole) and added(parts) == added(whole)
    used = pa.RecordBatch.from_pylist([{"lang": "en", "used": [{"source": f"s{k}", "p": 10 * k + j, "p0": k + 1} for k in range(j % 7 + 1)]}
                                       for j in range(40)])
    once = sorted(map(str, pa.Table.from_batches(divergence._common(iter([used]))).to_pylist()))
    monkeypatch.setattr(divergence, "PAIRS", 3)
    assert once == sorted(map(str, pa.Table.from_batches(divergence._common(iter([used]))).to_pylist()))


# ---------------------------------------------------------------- fill-in-middle

def brute_infill(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("step", [1, 7, infill.STEP])
def test_infill_moves_and_restores(step, monkeypatch):
    monkeypatch.setattr(infill, "STEP", step)
    rnd = random.Random(step)
    texts = ["".join(rnd.choice("aé😀<PSM>\n") for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    want = [brute_infill(i, t) for i, t in enumerate(texts)]
    n = np.array([w[0] for w in want])
    low = np.array([w[2] or 0 for w in want])
    high = low + np.array([w[3] or 0 for w in want])
    form = infill._codes(pa.array([w[1] for w in want]))
    assert {"plain", "psm", "spm"} == {w[1] for w in want}
    out = infill.transform_batch(pa.array(texts), n, low, high, form)
    assert out.to_pylist() == [w[4] for w in want]
    assert infill.restore_batch(out, form).to_pylist() == texts
    at = out.slice(5, 40)  # an array that starts inside its buffers
    assert infill.restore_batch(at, form[5:45]).to_pylist() == texts[5:45]


def test_infill_on_edges(edge_docs, no_docs, monkeypatch):
    rows = infill.restore(infill.fill_in_middle(edge_docs)).collect()
    got = sorted((str(r["doc_id"]), r["n"], r["form"], str(r["prefix_chars"]), str(r["middle_chars"]), r["output"]) for r in rows)
    want = sorted((str(r[0]), *(str(v) if k in (2, 3) else v for k, v in enumerate(brute_infill(r[0], r[1])))) for r in edge_rows())
    assert got == want
    assert sorted(r["restored"] for r in rows) == sorted(r[1] or "" for r in edge_rows())
    assert infill.restore(infill.fill_in_middle(no_docs)).collect() == []


def test_infill_rejects_a_broken_output():
    with pytest.raises(ValueError):
        infill.restore_batch(pa.array(["<P>a<S>b"]), np.array([infill._PSM]))


def test_infill_row_groups():
    bounds = np.array([0, 3, 3, 10, 11, 12, 40])
    assert list(infill._row_groups(bounds, 5)) == [(0, 2), (2, 3), (3, 5), (5, 6)]
    assert list(infill._row_groups(np.zeros(1, np.int64), 5)) == []


def test_infill_on_the_given_table(spark):
    docs = table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in infill.restore(infill.fill_in_middle(docs)).collect():
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute_infill(r["doc_id"], texts[r["doc_id"]])
        assert r["restored"] == texts[r["doc_id"]]


# ---------------------------------------------------------------- language model

WORD = re.compile(b"[^\x20\x09-\x0d]+")
LM_SCHEMA = "doc_id long, text string"


def tokens_of(text):
    return WORD.findall(fold(text or "").encode()) + [None]  # None: the end


def is_held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def brute_base(rows):
    """(doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score"""
    count = Counter(t for i, text in rows if not is_held_out(i) for t in tokens_of(text))
    total, distinct = sum(count.values()), len(count)
    for i, text in rows:
        found = tokens_of(text)
        base = sum(math.log10((count[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in found)
        yield i, is_held_out(i), len(found), sum(count[t] > 0 for t in found), total, base


def brute_score(model, count, text):
    """The model's log10 probability of a text, token by token, from its weights and counts."""
    number = {w: k for k, w in enumerate(model.words)}
    place = lambda t: number.get(t, -1) if t is not None else len(model.words) + 1
    one = two = maxent.EDGE
    out = 0.0
    for t in tokens_of(text):
        k = place(t)
        rows = maxent.feature_rows(np.array([two * maxent.CONTEXTS + one]))[0]
        logits = model.weights[rows].sum(0)
        p_class = math.exp(logits[model.classes[k]]) / np.exp(logits).sum()
        if k == -1:
            left = count[t] - model.discount if count[t] else model.discount * model.distinct
            p_token = left / model.out_mass
        else:
            own = model.ends if t is None else model.counts[k]
            p_token = (own - model.discount) / model.mass[model.classes[k]]
        out += math.log10(p_class * p_token)
        two, one = one, model.symbols[k]
    return out


def lm_rows(seed, n=120):
    rnd = random.Random(seed)
    words = ["The", "of", "river", "é", "stone.", "LIGHT", "walks", "a", "b", "c"] + [f"w{k}x" for k in range(40)]
    weight = [1 / (k + 1) for k in range(len(words))]
    texts = [" ".join(rnd.choices(words, weight, k=rnd.randint(0, 25))) for _ in range(n)]
    return list(enumerate(texts)) + [(None, "the river"), (7, "the river"), (7, None), (-5, " \t\n "), (901, "new " * 30), (902, "z" * 100)]


def close(a, b):
    return abs(a - b) <= 1e-9 * max(1, abs(a), abs(b))


@pytest.mark.parametrize("listed", [0, 5, 12, maxent.LISTED])
def test_lm_matches_brute_force(spark, listed):
    """Whatever the number of listed words: the rest of the words goes through the join."""
    rows = lm_rows(3)
    docs = spark.createDataFrame(rows, LM_SCHEMA).repartition(3)
    trained = maxent.train(docs, listed=listed, rounds=2)
    count = Counter(t for i, text in rows if not is_held_out(i) for t in tokens_of(text))
    assert len(trained.model.words) <= listed
    got = sorted(maxent.score(docs, trained).collect(), key=repr)
    want = sorted(((*b, brute_score(trained.model, count, text)) for b, (_, text) in zip(brute_base(rows), rows)),
                  key=lambda x: repr(x[:2]))
    key = lambda r: (str(r[0]), *r[1:5], round(r[5], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert tuple(g)[:5] == w[:5] and close(g["base_score"], w[5]) and close(g["score"], w[6])


def test_lm_probabilities_sum_to_one(spark):
    rows = lm_rows(4)
    trained = maxent.train(spark.createDataFrame(rows, LM_SCHEMA), listed=12, rounds=3)
    model = trained.model
    count = Counter(t for i, text in rows if not is_held_out(i) for t in tokens_of(text))
    classes = np.exp(maxent.log_softmax(model.weights, np.array([0, 5 * maxent.CONTEXTS + 3, 700])))
    shares = np.zeros(maxent.CLASSES)
    for k in range(len(model.words)):
        shares[model.classes[k]] += 10 ** model.shares[k]
    shares[maxent.END_CLASS] += 10 ** model.shares[-2]
    outside = [t for t in count if t is not None and t not in model.words]
    shares[maxent.OUT_CLASS] = sum((count[t] - model.discount) / model.out_mass for t in outside) + model.discount * model.distinct / model.out_mass
    assert model.distinct == len(count) and np.allclose(shares[model.mass > 0], 1)
    assert np.allclose((classes * shares).sum(1), 1) and np.allclose(classes.sum(1), 1)


def test_lm_gradient_climbs_and_matches_a_dense_one(spark, monkeypatch):
    rows = lm_rows(5, 60)
    docs = spark.createDataFrame(rows, LM_SCHEMA)
    model = maxent.train(docs, rounds=3).model
    # the same updates over the training tokens one by one, without hashing into tasks
    observed, seen = np.zeros((2, maxent.ROWS + 1, maxent.CLASSES))
    positions = []
    number = {w: k for k, w in enumerate(model.words)}
    for i, text in rows:
        if is_held_out(i):
            continue
        one = two = maxent.EDGE
        for t in tokens_of(text):
            k = number.get(t, -1) if t is not None else len(model.words) + 1  # a very long word is not listed
            n = model.ends if t is None else model.counts[k]
            own = 0 if k == -1 else round(maxent.UNIT * (1 - model.discount / n)) / maxent.UNIT
            target = np.zeros(maxent.CLASSES)
            target[model.classes[k]] += own
            target[maxent.OUT_CLASS] += 1 - own
            positions.append((two * maxent.CONTEXTS + one, target))
            two, one = one, model.symbols[k]
    histories = np.array([h for h, _ in positions])
    targets = np.stack([t for _, t in positions])
    features = maxent.feature_rows(histories)
    for f in range(maxent.FEATURES):
        np.add.at(observed, features[:, f], targets)
    weights, present = np.zeros_like(observed), model.mass > 0
    weights[0] = np.log((observed[0] + 0.5) / (observed[0].sum() + 0.5 * maxent.CLASSES))
    weights[0, ~present] = -1e4
    likelihood = []
    for _ in range(3):
        logs = maxent.log_softmax(weights, histories)
        likelihood.append((targets * logs).sum())
        seen[:] = 0
        for f in range(maxent.FEATURES):
            np.add.at(seen, features[:, f], np.exp(logs))
        pull = maxent.PRIOR * weights
        pull[0] = 0
        step = maxent.RATE * (observed - seen - pull) / (maxent.FEATURES * (observed + seen) / 2 + maxent.PRIOR)
        weights += np.where(present, step, 0)
    likelihood.append((targets * maxent.log_softmax(weights, histories)).sum())
    assert likelihood == sorted(likelihood)
    assert np.allclose(weights, model.weights)


def test_lm_pieces_do_not_change_scores(spark, monkeypatch):
    rows = lm_rows(6, 40) + [(77, "the river of light " * 300), (78, "y" * 500 + " the " + "q" * 40)]
    docs = spark.createDataFrame(rows, LM_SCHEMA)
    trained = maxent.train(docs, listed=8, rounds=1)
    texts = pa.array([(t or "").encode() for _, t in rows])

    def scores():
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array([i for i, _ in rows]), pa.array([False] * len(rows)), texts],
                                           ["row_id", "doc_id", "held_out", "text"])
        shared = type("Shared", (), {"value": trained.model})
        return [b.to_pylist() for b in maxent._score(shared)(iter([batch]))][0]

    whole = scores()
    monkeypatch.setattr(maxent, "PIECE", 11)
    monkeypatch.setattr(maxent, "BATCH", 5)
    for a, b in zip(whole, scores(), strict=True):
        assert a["n_tokens"] == b["n_tokens"] and a["outside"] == b["outside"] and close(a["score_sum"], b["score_sum"])
    for text in (b"", b" a  b ", b"abcdefghijklmnop", b"ab cdefghijklmnopq rs"):
        assert [w for p in maxent.pieces(text, 4) for w in p] == text.split()


def test_lm_on_edges(spark, edge_docs, no_docs):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = maxent.score_documents(edge_docs, rounds=1).collect()
    want = sorted(brute_base(rows), key=lambda r: (str(r[0]), *r[1:]))
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), *r[1:6])), want, strict=True):
        assert tuple(g)[:5] == w[:5] and close(g["base_score"], w[5]) and g["score"] <= 0
    assert maxent.score_documents(no_docs).collect() == []
    unlearnt = [i for i in range(99) if is_held_out(i)][:2]
    alone = maxent.score_documents(spark.createDataFrame([(unlearnt[0], "a b"), (unlearnt[1], None)], LM_SCHEMA)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in alone) == [(1, 0, 0, 0, 0), (3, 0, 0, 0, 0)]


def test_lm_predicts_held_out_text(spark):
    scored = maxent.score_documents(table(spark, "/root/testdata/sf0.01", "documents")).where("held_out").collect()
    assert len(scored) > 150
    assert sum(r["score"] for r in scored) > 0.85 * sum(r["base_score"] for r in scored)  # logarithms: nearer to zero is better
    assert sum(r["score"] > r["base_score"] for r in scored) > 0.9 * len(scored)


def test_lm_threshold_is_bounded(spark):
    words = spark.createDataFrame([(f"{k}".encode(), k) for k in range(1, 3000)], "word binary, n long")
    for listed in (0, 1, 1900, 2990, 10_000):
        least = maxent._threshold(words, listed)
        reach = sum(k >= least for k in range(1, 3000))
        assert reach <= listed and (reach >= 0.85 * min(listed, 2999) or listed <= 1)
