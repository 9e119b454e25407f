"""Sharding, mixing, token roll-ups and the pipeline."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import decontaminate, hilbert, langid, mixing, rollup, simhash
from sluice.llm.common import materialize, running_totals, table
from sluice.session import shared_dir
from tests.llm.conftest import edge_rows

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def test_running_totals(spark):
    df = spark.range(1000).select((F.col("id") % 97).alias("k"), "id", F.col("id").alias("v"))
    rows = running_totals(df, ["k", "id"], {"before": "v"}, "t").orderBy("k", "id").collect()
    total = 0
    for r in rows:
        assert r["before"] == total
        total += r["v"]


@pytest.mark.parametrize(("dims", "bits"), [(3, 3), (2, 4)])
def test_curve_is_a_hilbert_curve(spark, dims, bits):
    n = 1 << dims * bits
    cells = spark.range(n).select(*[F.shiftright("id", bits * i).bitwiseAND((1 << bits) - 1).cast("int").alias(f"c{i}") for i in range(dims)])
    rows = sorted(cells.select("*", hilbert.curve_index([F.col(f"c{i}") for i in range(dims)], bits).alias("h")).collect(), key=lambda r: r["h"])
    assert [r["h"] for r in rows] == list(range(n))
    assert all(sum(abs(a[i] - b[i]) for i in range(dims)) == 1 for a, b in zip(rows, rows[1:]))


def test_depth_bounds_keep_order(spark):
    docs = spark.createDataFrame([(f"s{i % 50:02d}",) for i in range(5000)] + [(None,)], "source string")
    bounds = hilbert.depth_bounds(docs, "source", 3)
    codes = {r[0]: r[1] for r in docs.select("source", hilbert.depth_code(F.col("source"), bounds)).distinct().collect()}
    assert codes[None] == 0 and len(bounds) <= 8
    named = [codes[k] for k in sorted(k for k in codes if k)]
    assert named == sorted(named) and max(Counter(named).values()) <= 9


def check_shards(rows, texts, shards=hilbert.SHARDS):
    per = Counter(r["shard"] for r in rows)
    sizes = [per.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(set)
    for r in rows:
        slots[r["shard"]].add(r["slot"])
    assert all(slots[s] == set(range(n)) for s, n in per.items())
    order = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert want == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)


def test_shards(spark, edge_docs, no_docs):
    docs = table(spark, SF, "documents")
    check_shards(hilbert.hilbert_shards(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])
    check_shards(hilbert.hilbert_shards(edge_docs).collect(), [(r[0], r[1]) for r in edge_rows()])
    check_shards(hilbert.hilbert_shards(edge_docs, 3).collect(), [(r[0], r[1]) for r in edge_rows()], 3)
    assert hilbert.hilbert_shards(no_docs).count() == 0


def test_written_shards_hold_all_columns(spark, edge_docs):
    path = shared_dir(spark, "test") + "/shards"
    hilbert.write_shards(edge_docs, path, 4)
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.select(*edge_docs.columns).collect())) == Counter(map(tuple, edge_docs.collect()))
    assert {r[0] for r in back.select("_shard").distinct().collect()} == {0, 1, 2, 3}


def brute_targets(sizes):
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, open_, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if unit * weights[s] > 2 * sizes[s]}
        if not over:
            return target | {s: unit * weights[s] for s in open_}
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def check_mix(rows, sources, block=mixing.BLOCK):
    sizes = Counter()
    for (i, t, s) in sources:
        sizes[s] += len(WORD.findall(t or ""))
    target = brute_targets({s: sizes[s] for _, _, s in sources})
    assert len(rows) == len(sources)
    by_text = defaultdict(list)
    for i, t, s in sources:
        by_text[i, len(WORD.findall(t or "")), sizes[s]].append(s)
    taken = Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        source = by_text[r["doc_id"], r["size"], r["source_size"]].pop()
        assert r["target"] == pytest.approx(target[source])
        taken[source] += r["taken"]
    for s, t in target.items():
        assert taken[s] == pytest.approx(t, abs=1.5)


def test_mix_meets_targets(spark, edge_docs, no_docs):
    docs = table(spark, SF, "documents")
    rows = mixing.mix(docs).collect()
    check_mix(rows, [tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(7)).collect())
    check_mix(mixing.mix(edge_docs.where("doc_id IS NOT NULL")).collect(), [(r[0], r[1], r[3]) for r in edge_rows() if r[0] is not None])
    assert mixing.mix(edge_docs).count() == len(edge_rows()) and mixing.mix(no_docs).count() == 0
    assert {r["taken"] for r in mixing.mix(edge_docs.where("text IS NULL")).collect()} == {0}


def test_schedule_is_low_discrepancy(spark):
    needs = spark.createDataFrame([("sa", 500), ("sb", 200), ("sc", 1)], "skey string, need long")
    slots = Counter(r["skey"] for r in mixing.schedule(needs, 64).collect())
    ranks = sorted(r["rank"] for r in mixing.schedule(needs, 64).where("skey = 'sa'").collect())
    assert ranks == list(range(slots["sa"])) and slots["sa"] >= 500 and slots["sb"] >= 200 and slots["sc"] >= 1
    assert abs(slots["sa"] / slots["sb"] - 2.5) < 0.05


def test_small_sources_get_every_slot_beside_large_ones(spark):
    small = {f"s{i:02d}b": 1 + i % 5 for i in range(20)}
    rows = [*small.items(), *((f"s{i:02d}a", 100_000 + 7_919 * i) for i in range(20))]
    needs = dict(rows)
    slots = mixing.schedule(spark.createDataFrame(rows, "skey string, need long"), 64)
    got = {r["skey"]: r for r in slots.groupBy("skey").agg(
        F.count("*").alias("n"), F.count_distinct("rank").alias("ranks"), F.max("rank").alias("last")).collect()}
    for s, need in needs.items():
        assert got[s]["n"] == got[s]["ranks"] == got[s]["last"] + 1 >= need


def test_mixed_documents_take_effect(spark, edge_docs):
    taken = {}
    for r in mixing.mix(edge_docs).collect():
        taken[r["doc_id"], r["size"]] = taken.get((r["doc_id"], r["size"]), 0) + r["taken"]
    out = mixing.mixed_documents(edge_docs)
    assert out.columns == edge_docs.columns
    words = Counter()
    for r in out.collect():
        assert r["n_chars"] == len(r["text"])
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    want = Counter()
    for (i, _), n in taken.items():
        want[i] += n
    assert +words == +want


def test_every_prefix_of_the_mix_holds_each_share(spark):
    docs = table(spark, SF, "documents")
    target = {r["source"]: r["target"] for r in docs.join(mixing.mix(docs).drop("source"), "doc_id")
              .groupBy("source").agg(F.max("target").alias("target")).collect()}
    pieces = sorted(mixing.mixed_pieces(docs).collect(), key=lambda r: (r["slot"], r["place"]))
    words, at = Counter(), {}
    share = {s: t / sum(target.values()) for s, t in target.items()}
    for r in pieces:
        assert at.setdefault(r["slot"], r["source"]) == r["source"]  # a slot holds one source
        words[r["source"]] += r["n_words"]
        total = sum(words.values())
        for s in share:
            assert abs(words[s] - share[s] * total) <= 6 * mixing.BLOCK
    in_slot = Counter()
    for r in pieces:
        in_slot[r["slot"]] += r["n_words"]
    assert max(in_slot.values()) == mixing.BLOCK
    # A plain order, one source after the other, is far from that.
    plain = Counter()
    for r in sorted(pieces, key=lambda r: (str(r["source"]), r["slot"]))[:len(pieces) // 2]:
        plain[r["source"]] += r["n_words"]
    assert max(abs(plain[s] - share[s] * sum(plain.values())) for s in share) > 60 * mixing.BLOCK


def test_pieces_add_up_to_the_mix(spark, edge_docs):
    texts = {(r[0], r["h"]): WORD.findall(r["text"] or "") for r in edge_docs.withColumn("h", F.xxhash64("text")).select("doc_id", "text", "h").collect()}
    got, first, last, begins = Counter(), {}, {}, defaultdict(dict)
    for r in mixing.mixed_pieces(edge_docs).collect():
        key = r["doc_id"], r["text_hash"]
        assert 1 <= r["first_word"] and r["first_word"] + r["n_words"] - 1 <= len(texts[key])
        got[key] += r["n_words"]
        first[key], last[key] = min(first.get(key, r["slot"]), r["slot"]), max(last.get(key, r["slot"]), r["slot"])
        begins[key][r["copy"]] = min(begins[key].get(r["copy"], r["slot"]), r["slot"])
    rows = mixing.mix(edge_docs).collect()
    many = Counter((r["doc_id"], r["text_hash"]) for r in rows)
    for r in rows:
        key = r["doc_id"], r["text_hash"]
        if many[key] == 1:  # repeated rows share their key
            assert (r["taken"], r["first_slot"], r["last_slot"]) == (got[key], first.get(key), last.get(key))
            assert r["copy_slots"] == [begins[key][c] for c in sorted(begins[key])]
    assert sum(got.values()) == sum(r["taken"] for r in rows)


def test_mixed_documents_follow_the_schedule(spark):
    docs = table(spark, SF, "documents")
    out = mixing.mixed_documents(docs, slot="mix_slot")
    assert out.columns == [*docs.columns, "mix_slot"]
    rows = out.withColumn("part", F.spark_partition_id()).collect()
    slots = [r["mix_slot"] for r in sorted(rows, key=lambda r: r["part"])]  # as read, partition after partition
    assert slots == sorted(slots) and len(slots) == mixing.mixed_documents(docs).count()
    begins = {r["doc_id"]: r["copy_slots"] for r in mixing.mix(docs).collect()}
    placed = defaultdict(list)
    for r in rows:
        placed[r["doc_id"]].append(r["mix_slot"])
    assert {i: sorted(s) for i, s in placed.items()} == {i: sorted(s) for i, s in begins.items() if s}
    with pytest.raises(ValueError, match="MIX_SLOT"):
        mixing.mixed_documents(out, slot="MIX_SLOT")


def test_rollup_commits_once(spark):
    docs = spark.createDataFrame([("a", "en", "one two"), ("a", "en", None), (None, None, ""), ("b", "de", "x")], "source string, lang string, text string")
    count = lambda d: rollup.counted(d, F.size(F.split(F.coalesce("text", F.lit("")), " ")), "v1")
    store = rollup.Rollup(spark, shared_dir(spark, "test") + "/rollup")
    read = lambda: sorted(map(tuple, store.totals().collect()), key=repr)
    assert read() == []
    assert store.commit("one", rollup.signed(inserted=count(docs)))
    first = read()
    assert first == [("a", "en", "v1", 2, 3), ("b", "de", "v1", 1, 1), (None, None, "v1", 1, 1)]
    assert not store.commit("one", rollup.signed(inserted=count(docs)))
    assert read() == first
    with pytest.raises(ValueError, match="other contents"):
        store.commit("one", rollup.signed(inserted=count(docs.limit(1))))
    assert read() == first
    revised = docs.where("source = 'a' AND text IS NOT NULL").withColumn("text", F.lit("one two three"))
    store.commit("two", rollup.signed(inserted=count(revised), deleted=count(docs.where("text = 'one two'"))))
    store.commit("three", rollup.signed(deleted=count(docs.where("source = 'b'"))))
    assert read() == [("a", "en", "v1", 2, 4), (None, None, "v1", 1, 1)]
    with pytest.raises(ValueError, match="letters"):
        store.commit("../x", rollup.signed(inserted=count(docs)))


def test_uncommitted_attempts_are_not_read(spark):
    store = rollup.Rollup(spark, shared_dir(spark, "test") + "/rollup")
    delta = spark.createDataFrame([("a", "en", "v", 1, 5)], "source string, lang string, tokenizer string, docs long, tokens long")
    delta.write.parquet(f"{store.path}/deltas/one/lost-attempt")
    store.commit("one", delta)
    assert [tuple(r) for r in store.totals().collect()] == [("a", "en", "v", 1, 5)]


def test_token_totals(spark, edge_docs, no_docs):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rollup.VOCABULARY, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=rollup.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = edge_docs.where("doc_id <> 10 OR doc_id IS NULL")
    want = defaultdict(lambda: [0, 0])
    for r in docs.collect():
        group = want[r["source"], r["lang"], "byte_bpe_50k.tiktoken"]
        group[0] += 1
        group[1] += len(encoding.encode_ordinary(r["text"] or ""))
    got = rollup.maintained_totals(docs, shared_dir(spark, "test") + "/totals").collect()
    assert {tuple(r[:3]): list(r[3:]) for r in got} == dict(want)
    assert rollup.maintained_totals(no_docs, shared_dir(spark, "test") + "/totals").count() == 0


def test_pipeline_stages_match_brute_force(spark, edge_docs):
    docs = table(spark, SF, "documents").unionByName(
        edge_docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 10_000))
    given = docs
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination",
                                                          "mixing sources to target weights", "sharding"]
    steps = dict(corpus_pipeline.STAGES)
    key = lambda rows: Counter((r["doc_id"], r["text"]) for r in rows)

    known = materialize(steps["language ID"](spark, given, SF), "t")
    verdict = Counter((r["doc_id"], r["lang_pred"] != langid.UNKNOWN and r["score"] >= langid.MIN_SCORE and r["bits"] <= langid.MAX_BITS)
                      for r in langid.identify(given).collect())
    assert Counter(r["doc_id"] for r in known.collect()) == Counter(
        i for (i, ok), n in verdict.items() if ok for _ in range(n))

    single = materialize(steps["SimHash near-dedup"](spark, known, SF), "t")
    rows = known.collect()
    prints = [simhash.fingerprint(r["text"]) & (1 << 64) - 1 for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r["doc_id"])
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    assert Counter(r["doc_id"] for r in single.collect()) == Counter(least(g) for g in groups.values())

    clean = materialize(steps["benchmark decontamination"](spark, single, SF), "t")
    items = [decontaminate.tokens(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    windows = {tuple(w[i:i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}
    hit = lambda w: any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))
    assert key(clean.collect()) == key(r for r in single.collect() if not hit(decontaminate.tokens(r["text"])))

    mixed = materialize(steps["mixing sources to target weights"](spark, clean, SF), "t")
    assert mixed.columns == docs.columns
    sizes, got = Counter(), Counter()
    for r in clean.collect():
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    for r in mixed.collect():
        got[r["source"]] += len(WORD.findall(r["text"]))
    for s, t in brute_targets(sizes).items():
        assert got[s] == pytest.approx(t, abs=1.5)

    placed = steps["sharding"](spark, mixed, SF).collect()
    check_shards(placed, [(r["doc_id"], r["text"]) for r in mixed.collect()])


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 100 and {r["law"] for r in rows} == {"rows"}
