"""Quality rules, language identification and personal data against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import langid, pii, repetition
from sluice.llm.common import table
from tests.llm.conftest import edge_rows

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_measures(text):
    text = text or ""
    words, out = WORD.findall(text), {}
    lines, seen = text.split("\n"), set()
    dup = [line for i, line in enumerate(lines) if WORD.search(line) and line in lines[:i]]
    for n in (5, 6, 7, 8, 9, 10):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        count, seen = Counter(grams), set()
        later, any_copy = set(), set()
        for i, g in enumerate(grams):
            if g in seen:
                later.update(range(i, i + n))
            if count[g] > 1:
                any_copy.update(range(i, i + n))
            seen.add(g)
        out[f"dup_chars_{n}"] = sum(len(words[i]) for i in later)
        if n == 5:
            out["n_repeat_words"] = len(any_copy)
    return out | {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
                  "n_dup_lines": len(dup), "dup_line_chars": sum(len(w) for d in dup for w in WORD.findall(d))}


def test_repetition_measures_match_brute_force():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("ab cd # é".split()) for _ in range(rnd.randint(0, 80))) for _ in range(150)]
    texts += ["\n".join(rnd.choice(["x y z", "", " ", "one two three four five six"]) for _ in range(12)) for _ in range(60)]
    for text in [*texts, None, "", "one"]:
        assert dict(zip(repetition.MEASURES, repetition.measure(text))) == brute_measures(text)


def test_repetition_verifies_hash_matches(monkeypatch):
    monkeypatch.setattr(repetition, "_BASE", repetition.np.uint64(0))  # every window hashes alike
    text = "a b c d e f a b c d e g h i j k l m n o p"
    assert dict(zip(repetition.MEASURES, repetition.measure(text))) == brute_measures(text)


def test_quality_rules_on_edges(edge_docs, no_docs):
    rows = repetition.quality_rules(edge_docs).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        if r["n_words"] < 10:
            assert r["base_failed"] and not r["kept"]
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[9]["n_repeat_words"] == 30_000 and not by_id[9]["kept"]
    assert by_id[11]["n_dup_lines"] == 4 and by_id[6]["kept"] == (not by_id[6]["base_failed"])
    assert repetition.quality_rules(no_docs).count() == 0


def naive_bits(samples, text, order):
    """PPM code length of a text: counts from samples, escape method C, no exclusion."""
    count = defaultdict(Counter)
    for s in samples:
        padded = b"\0" * order + s
        for i in range(order, len(padded)):
            for k in range(order + 1):
                count[padded[i - k:i]][padded[i]] += 1
    # contexts of different lengths are different contexts
    total, padded = 0.0, b"\0" * order + text
    for i in range(order, len(padded)):
        bits, k = 0.0, order
        while True:
            seen = count.get(padded[i - k:i]) if k >= 0 else None
            if k < 0:
                bits += 8
                break
            if seen:
                n, q = sum(seen.values()), len(seen)
                if padded[i] in seen:
                    bits += math.log2((n + q) / seen[padded[i]])
                    break
                bits += math.log2((n + q) / q)
            k -= 1
        total += bits
    return total


def fitted(batch):
    import pandas as pd

    counts = pd.concat(b.to_pandas() for b in langid._count_contexts(iter([batch])))
    counts = counts.groupby(["lang", "pair"], as_index=False)["n"].sum()
    langs = sorted(counts["lang"].unique())
    return langid.Model(langs, counts["lang"].map(langs.index).to_numpy(), counts["pair"].to_numpy(), counts["n"].to_numpy())


def test_code_lengths_match_a_naive_model():
    import pyarrow as pa

    samples = {"aa": ["abracadabra", "banana"], "bb": ["zebra zoo", "lazy dog é"]}
    batch = pa.RecordBatch.from_pydict({"lang": [k for k, v in samples.items() for _ in v], "text": [t for v in samples.values() for t in v]})
    model = fitted(batch)
    texts = ["abra zoo", "lazybanana", "é", "qqq", "a" * 50]
    got = model.code_lengths([t.encode() for t in texts]) / langid.POINT
    for i, t in enumerate(texts):
        for k, lang in enumerate(model.langs):
            assert got[i, k] == pytest.approx(naive_bits([s.encode() for s in samples[lang]], t.encode(), langid.ORDER), abs=0.05)


def test_long_texts_are_scored_whole(monkeypatch):
    import pyarrow as pa

    model = fitted(pa.RecordBatch.from_pydict({"lang": ["x", "y"], "text": ["hello world", "guten tag"]}))
    texts = [b"", b"hello" * 40, b"tag " * 30, b""]
    whole = model.code_lengths(texts)
    monkeypatch.setattr(langid, "SLICE", 7)
    assert (model.code_lengths(texts) == whole).all()


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where("held_out AND n_chars > 100").collect()
    assert len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(edge_docs, no_docs):
    rows = langid.identify(edge_docs).collect()
    assert len(rows) == len(edge_rows())
    for r, text in ((r, t) for r in rows for i, t, *_ in edge_rows() if i == r["doc_id"] and i in (1, 2, 3, 5)):
        assert (r["lang_pred"], r["score"]) == ("und", 0.0), text
    assert {r["lang_pred"] for r in langid.identify(edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(no_docs).count() == 0
    kept = langid.known_language(edge_docs)
    assert kept.columns == edge_docs.columns and kept.where("text IS NULL").count() == 0


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def brute_spans(text):
    shapes = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
              "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for order, (kind, shape) in enumerate(shapes.items()):
        for m in re.finditer(shape, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), order, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


def test_personal_data_matches_plain_expressions(spark):
    rnd = random.Random(5)
    bits = ["a@b.co", "@", ".", "_", " ", "-", "+1", "(974) ", "555", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "256.", "é",
            "😀", "x", "\n", "0", "9", "1-2 3", "token = ", "deadbeef00deadbeef00deadbeef00deadbeef00"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))) for i in range(500)] + [(500, None), (501, ""), (None, "a@b.co"), (None, "a@b.co")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((str(i), hashlib.sha256(",".join(brute_spans(t)).encode()).hexdigest()) for i, t in rows)
    got = pii.find_personal_data(docs).collect()
    assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in got) == want
    texts = dict(rows)
    for r in got:
        if r["doc_id"] is not None:
            base, spans = brute_spans(texts[r["doc_id"]]), r["spans"].split(",") if r["spans"] else []
            assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0]), int(s.split(":")[2])))
            assert r["n_email"] == sum(s.startswith("email") for s in base) and r["n_card"] == sum(s.startswith("card") for s in base)


def test_personal_data_edges(spark, edge_docs, no_docs):
    assert pii.find_personal_data(edge_docs).count() == len(edge_rows())
    assert pii.find_personal_data(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "a@b.co " * 5000 + "1" * 30_000 + "@" * 1000)], "doc_id long, text string")
    assert pii.find_personal_data(docs).first()["n_email"] == 5000


def test_announced_numbers_are_added_and_plain_ones_stay(spark):
    """Recall of the added spans on planted texts, and precision beside numbers of other kinds."""
    planted, texts = Counter(), []
    for i in range(400):
        numbers = [f"(555) {100 + i % 900}-4{i:03d}", f"555 {200 + i % 700} {4000 + i}", f"{100 + i % 800}-{10 + i % 90}-6{i:03d}"]
        lead = ("call ", "my phone ", "SSN: ")
        text = "Please " + ", ".join(w + n for w, n in zip(lead, numbers)) + " or +1 555 010 %04d today" % i
        for n in numbers:
            planted[len(texts), text.index(n), text.index(n) + len(n)] += 1
        texts.append(text)
    clean = [f"Item {i}: built 19{10 + i % 80}-0{1 + i % 9}-1{i % 10}, sizes 12.5 {i % 90 + 10}.75, pages 100-1{i:02d}" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts + clean)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs).collect()}
    added = {(d, *map(int, s.split(":")[1:])) for d, spans in found.items() for s in spans.split(",") if s.startswith("digits:")}
    assert len(added & set(planted)) >= 0.9 * len(planted)
    assert not [a for a in added if a[0] >= len(texts)]
    assert all("phone:" in found[d] for d in range(len(texts)))


def test_boosting_separates_and_calibrates():
    per_kind = pii.CODES // pii.FEATURES["kind"]
    good, bad = per_kind + 4 * 500, per_kind + 4 * 10
    rows = [(good, held, 100, 99) for held in (True, False)] + [(bad, held, 100, 2) for held in (True, False)]
    assert pii.select_codes(rows) == [good]
    assert pii.select_codes([(good, False, 10, 0), (good, True, 10, 0)]) == []
    assert pii.select_codes([]) == []


def test_redact(spark):
    row = spark.createDataFrame([("call +1 234 5 now, or é a@b.c", "phone:5:13,digits:8:13,email:24:29", "")], "t string, s string, none string")
    assert row.select(pii.redact(F.col("t"), F.col("s"))).first()[0] == "call [REDACTED] now, or é [REDACTED]"
    assert row.select(pii.redact(F.col("t"), F.col("none"))).first()[0] == "call +1 234 5 now, or é a@b.c"
