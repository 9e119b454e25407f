"""Decontamination, page text, substrings and SimHash against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import decontaminate, pagetext, simhash, substrings
from sluice.llm.queries import QUERIES
from tests.llm.conftest import edge_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_matches_oracle(spark, name):
    fn, sql = QUERIES[name]
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = fn(spark, SF)
    columns = sorted(df.columns)
    result = con.execute(sql)
    at = [d[0] for d in result.description]
    assert sorted(at) == columns
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    want = sorted(repr([norm(r[at.index(c)]) for c in columns]) for r in result.fetchall())
    assert sorted(repr([norm(r[c]) for c in columns]) for r in df.collect()) == want


def brute_hits(text, items):
    words = decontaminate.tokens(text)
    hit, found = set(), set()
    for item_id, item in items:
        w = decontaminate.tokens(item)
        for i in range(max(1, len(w) - 9) if w else 0):
            window = w[i:i + 10]
            for p in range(len(words) - len(window) + 1):
                if words[p:p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    found.add(str(item_id))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("limit", [decontaminate.TERMS_LIMIT, 0])
def test_decontamination(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "TERMS_LIMIT", limit)
    rnd = random.Random(2)
    vocab = ["The", "of", "Ärger", "x1", "blue", "sky", "sky"]
    say = lambda n: rnd.choice([" ", "-", "\n", "  "]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, say(rnd.choice([0, 1, 3, 9, 10, 11, 14]))) for i in range(12)] + [(3, say(12)), (90, None), (91, "?!"), (None, say(12))]
    docs = [(i, say(rnd.randint(0, 30))) for i in range(40)]
    docs += [(100 + i, say(5) + " " + (t or "") + " " + say(4)) for i, t in items if i is not None and i < 90]
    docs += [(None, None), (200, ""), *docs[45:48]]
    frame = lambda rows, c: spark.createDataFrame(rows, f"{c} long, text string")
    items = [(i, t) for i, t in items if i is not None]  # an item without an id cannot be named
    got = decontaminate.decontaminate(frame(docs, "doc_id").withColumn("pos", F.lit("clash")), frame(items, "item_id")).collect()
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(((str(r["doc_id"]), *(r[n] for n in names)) for r in got)) == sorted((str(i), *brute_hits(t, items)) for i, t in docs)


def test_proximity_matches(spark):
    words = "one two three four five six seven eight nine ten".split()
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:4], "x", *words[5:]])), (3, " ".join(words[:6]))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in decontaminate.decontaminate(docs, items).collect()}
    assert got[1] == (10, 0) and got[2] == (0, 1) and got[3] == (0, 0)


def test_proximity_matches_wherever_words_change(spark):
    words = "one two three four five six seven eight nine ten".split()
    changes = [c for n in (1, 2, 3) for c in itertools.combinations(range(10), n)]
    docs = [(i, "lead " + " ".join("x" if p in c else w for p, w in enumerate(words))) for i, c in enumerate(changes)]
    frame = lambda rows, c: spark.createDataFrame(rows, f"{c} long, text string")
    found = decontaminate.decontaminate(frame(docs, "doc_id"), frame([(7, " ".join(words))], "item_id"))
    assert {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in found.collect()} == {i: (0, int(len(c) < 3)) for i, c in enumerate(changes)}


def brute_near(text, windows):
    words = decontaminate.tokens(text)
    same = lambda w, p: sum(a == b for a, b in zip(w, words[p:p + len(w)]))
    near = lambda w, n: n < len(w) and n * 10 >= len(w) * decontaminate.NEAR
    return sum(any(near(w, same(w, p)) for p in range(len(words))) for _, w in windows)


@pytest.mark.parametrize("limit", [decontaminate.TERMS_LIMIT, 0])
def test_proximity_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "TERMS_LIMIT", limit)
    monkeypatch.setattr(decontaminate, "PROBES_LIMIT", limit)
    rnd = random.Random(6)
    say = lambda n: [rnd.choice("abcd") for _ in range(n)]
    items = [(i, " ".join(say(n))) for i, n in enumerate([1, 2, 4, 5, 7, 9, 10, 10, 13])]
    docs = [(i, " ".join(say(rnd.randint(0, 40)))) for i in range(60)]
    docs += [(100 + i, t + " " + " ".join(say(3))) for i, t in items] + [(200, None)]
    cut = {(i, tuple(w[k:k + 10])) for i, t in items for w in [decontaminate.tokens(t)] for k in range(max(1, len(w) - 9))}
    frame = lambda rows, c: spark.createDataFrame(rows, f"{c} long, text string")
    got = {r["doc_id"]: r["n_near"] for r in decontaminate.decontaminate(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    assert got == {i: brute_near(t, cut) for i, t in docs}


def test_decontamination_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "the the"), (2, "word word word word word word word word word word word")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.decontaminate(edge_docs, items).collect()}
    assert got[9]["n_hit"] == 30_000 and got[1]["n_words"] == 0
    assert decontaminate.decontaminate(no_docs, items).count() == 0
    assert decontaminate.decontaminate(edge_docs, items.where("false")).where("contaminated").count() == 0
    clean = decontaminate.clean_documents(edge_docs, items)
    assert clean.columns == edge_docs.columns and clean.where("doc_id = 9").count() == 0
    assert clean.where("text IS NULL").count() == sum(r[1] is None for r in edge_rows())


def brute_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s:s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def repeated_texts():
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 90))) for _ in range(60)]
    piece = lambda: (rnd.choice(base)[rnd.randint(0, 20):] if rnd.random() < .6
                     else "".join(rnd.choice("xyz ") for _ in range(rnd.randint(0, 40))))
    rows = [(i if rnd.random() < .95 else None, "".join(piece() for _ in range(rnd.randint(0, 5))) if rnd.random() < .95 else None) for i in range(200)]
    return rows + rows[:6] + [(1000, "ab" * 300), (1001, "a" * 500), (1002, "a" * 41), (1003, "abc" * 100 + "q"), (3, "another")]


@pytest.mark.parametrize("hot", [substrings.HOT, 2])
def test_repeated_substrings(spark, hot):
    rows = repeated_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lo", F.lit("clash"))
    assert sorted(map(tuple, substrings.remove_repeats(docs, 40, 16, hot).collect()), key=repr) == brute_repeats(rows, 40)


def test_substring_edges(edge_docs, no_docs):
    got = sorted(map(tuple, substrings.remove_repeats(edge_docs).collect()), key=repr)
    assert got == brute_repeats([(r[0], r[1]) for r in edge_rows()], substrings.LENGTH)
    assert substrings.remove_repeats(no_docs).count() == 0


def test_documents_without_an_id_keep_their_own_spans(spark):
    """Two texts without an id whose 32-bit hashes are equal: only one of them is repeated."""
    text = F.concat(*[F.sha2(F.concat("id", F.lit(k)), 256) for k in "ab"])
    pair = (spark.range(300_000).select(F.col("id").cast("string").alias("id")).select(text.alias("text"))
            .groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).where("size(t) > 1").first()["t"][:2])
    rows = [(None, pair[0]), (None, pair[1]), (5, pair[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substrings.remove_repeats(docs, 40, 16).collect()), key=repr) == brute_repeats(rows, 40)


@pytest.mark.parametrize("windows", [1, 60])
def test_open_runs_are_compared_some_at_a_time(spark, windows, monkeypatch):
    monkeypatch.setattr(substrings, "WINDOWS", windows)
    rows = repeated_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert sorted(map(tuple, substrings.remove_repeats(docs, 40, 16).collect()), key=repr) == brute_repeats(rows, 40)


def test_runs_cover_every_window_once_in_any_slices(monkeypatch):
    texts = [(t or "").encode() for _, t in repeated_texts()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
    for size in (1 << 20, 64, 7):
        monkeypatch.setattr(substrings, "SLICE", size)
        covered = Counter()
        for doc, *_, lo, windows, times in substrings.runs(data, bounds, 40, 16):
            for d, a, n in zip(doc.tolist(), lo.tolist(), (windows * times).tolist()):
                covered.update((d, s) for s in range(a, a + n))
        assert covered == Counter((d, s) for d, t in enumerate(texts) for s in range(len(t) - 39))


def test_prefix_hashes_agree_with_equality():
    data = np.frombuffer(b"abcabcabdabcab", np.uint8)
    for which in (0, 1):
        h = substrings.Prefixes(data, which).windows(3)
        for i in range(len(h)):
            for j in range(len(h)):
                assert (h[i] == h[j]) == (data[i:i + 3].tobytes() == data[j:j + 3].tobytes())


def brute_fingerprint(text, shingle=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance):
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((str(i), f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, group)), key=repr)


@pytest.mark.parametrize(("distance", "hot"), [(4, simhash.HOT), (4, 2), (3, 2), (0, simhash.HOT)])
def test_simhash_components(spark, distance, hot):
    rnd = random.Random(4)
    base = [" ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 40)) for _ in range(rnd.randint(0, 120))) for _ in range(12)]
    rows = [(r[0], r[1]) for r in edge_rows()]
    for i in range(150):
        words = rnd.choice(base).split()
        if words:
            words[rnd.randrange(len(words))] = rnd.choice("ABC")
        rows.append((200 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = simhash.near_duplicates(docs, distance=distance, hot=hot).collect()
    assert sorted(((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got), key=repr) == brute_components(rows, distance)


def test_simhash_edges(edge_docs, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    one = simhash.one_of_each(edge_docs)
    assert one.columns == edge_docs.columns
    ids = Counter(r["doc_id"] for r in one.collect())
    assert ids[12] == 1 and ids[1] == 1 and ids[2] == 0 and ids[6] == 1 and ids[7] == 0


@pytest.mark.parametrize("n", [10, 10_000, 10**7, 10**10])
def test_blocks_share_a_key_up_to_the_distance(n):
    blocks = simhash.choose_blocks(n, 4)
    masks = simhash.block_masks(blocks, 4)
    rnd = random.Random(n)
    for _ in range(300):
        flips = sum(1 << b for b in rnd.sample(range(64), 4))
        assert any(flips & m & (1 << 64) - 1 == 0 for m in masks)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(200, 100)], "a long, b long")
    got = dict(map(tuple, simhash.components(edges).collect()))
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100}


@pytest.mark.parametrize(("html", "want"), [
    (None, []), ("", []), ("plain &amp; simple", [(0, "plain & simple")]),
    ("<nav>menu<p>in</nav>out<script>'</p>'</script>", [(0, "out")]),
    ("<article><h1>T</h1><p>a<b>b</b>\n c<br>d<p>e</article>after", [(2, "T"), (2, "ab c d"), (2, "e"), (0, "after")]),
    ("<main><div class='comments'><p>x</p></div><p>y &#233; &am</main>", [(1, "y é &am")]),
    ("<div role=main>m</div><div class=ad>buy</div><form>f</form><!-- no --><p hidden>h</p>z", [(2, "m"), (0, "z")]),
    ("<body class=has-sidebar><p>kept", [(0, "kept")]), ("a < b > c", [(0, "a < b > c")]), ("<p>open <a href='x", [(0, "open <a href='x")]),
    ("<article>a<style>p{}</style><table><tr><td>1<td>2<tr><td>3</table></article>", [(2, "a"), (2, "1 2"), (2, "3")]),
])
def test_blocks(html, want):
    assert pagetext.blocks(html) == want


@pytest.mark.parametrize(("html", "want"), [
    ('<div class="layout has-sidebar"><article>a b</article></div>', "a b"),
    ('<div id="page" class="with-menu"><article>a b</article></div>', "a b"),
    ('<article class="post comments-open category-social">a b</article>', "a b"),
    ('<article class="comments">a b</article>', "a b"),
    ('<div class="menu">x<article>a b<p class="cookie-notice">c</p></article></div>', "a b"),
    ('<form id=f><main><p>a b</p></main></form>', "a b"),
    ('<aside><article>card</article></aside><article>a b</article>', "a b"),
    ('<p>an unmarked page</p><aside><article>card</article></aside>', "an unmarked page"),
    ('x<span class="ad">y</span>z<article>a <b class="share">s</b>b</article>', "a\nb"),
    ('<main><p>the main text of the page</p><article>card</article></main>', "the main text of the page"),
    ('<main><h1>T</h1><article>the main text of the page</article></main>', "the main text of the page"),
])
def test_articles_are_never_hidden(html, want):
    found = pagetext.blocks(html)
    assert "\n".join(t for level, t in found if level == pagetext.text_level(found)) == want


@pytest.mark.parametrize(("html", "want"), [
    ('<article>a b c<ol class="comment-list"><li>first!</li></ol></article>', "a b c"),
    ('<article>a b c<div id="comments-area">me too</div><div class="ad-slot top">buy</div></article>', "a b c"),
    ('<main><div class="sidebar-left">x</div><p>a b c</p><div class="cookie-bar">y</div></main>', "a b c"),
    ('<article><p>a b c</p><p class="related-work">the related work</p></article>', "a b c\nthe related work"),
    ('<article class="post"><div class="content-sidebar-wrap"><p>' + "a " * 50 + '</p></div><h1>t</h1></article>', ("a " * 50).strip() + "\nt"),
    ('<div class="comments-area"><article>a b</article></div>', "a b"),
    ('<article><p>short</p><div class="comment-list">' + "long talk " * 9 + '</div></article>', "short"),
])
def test_layout_names_hide_what_is_beside_the_text(html, want):
    found = pagetext.blocks(html)
    assert "\n".join(t for level, t in found if level == pagetext.text_level(found)) == want


def test_a_very_long_page():
    html = "<nav>menu</nav><article>" + "<p>word &amp; word</p><div class='ad-slot'>buy</div>" * 40_000 + "</article>" + "<div>" * 30_000
    found = pagetext.blocks(html)
    assert found == [(2, "word & word")] * 40_000


def brute_host_text(pages, run):
    """Unmarked pages as lists of blocks per (host, page): what is kept, by definition."""
    streams = {(h, tuple(" ".join(b).split())) for h, b in pages}
    out = []
    for h, blocks in pages:
        words = " ".join(blocks).split()
        holders = lambda gram: sum(any(s[i:i + run] == gram for i in range(len(s))) for host, s in streams if host == h)
        held = [0] * len(words)
        for i in range(len(words) - run + 1):
            n = holders(tuple(words[i:i + run]))
            if n > 1:
                held[i:i + run] = [max(x, n) for x in held[i:i + run]]
        kept, at, gone = [], 0, 0
        for b in blocks:
            n = len(b.split())
            least, at = min(held[at:at + n]), at + n
            if least >= pagetext.MANY or (least > 1 and n <= pagetext.SHORT):
                gone += n
            else:
                kept.append(b)
        out.append("\n".join(kept if gone <= pagetext.NEARLY_ALL * len(words) else blocks))
    return out


def test_unmarked_pages_match_brute_force(spark):
    rnd = random.Random(12)
    say = lambda n: " ".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    shared = [say(n) for n in (2, 7, 12, 40, 50)]
    pages = [(rnd.choice("xy"), [rnd.choice([say(rnd.randint(1, 45)), rnd.choice(shared), "p " + shared[1] + " q"]) for _ in range(rnd.randint(1, 7))])
             for _ in range(40)]
    pages += [pages[0], pages[1], ("z", [shared[3]]), ("z", [shared[3], "own words"])]
    rows = [(k, f"http://{h}/{k}", "".join(f"<p>{b}</p>" for b in blocks)) for k, (h, blocks) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pagetext.extract_pages(df).collect()}
    assert [got[k] for k in range(len(pages))] == brute_host_text(pages, pagetext.RUN)


def test_mirrored_pages_and_shared_phrases_stay(spark):
    story = "once upon a time there was a river that ran through the old town and nobody knew where it came from"
    pages = [(1, "http://h/1", f"<p>{story}</p><p>a second paragraph</p>"), (2, "http://h/2", f"<p>{story}</p><p>a second paragraph</p>"),
             (3, "http://h/3", "<div>the keeper said that once upon a time there was a river, and that was all</div>")]
    got = {r["page_id"]: r["text"] for r in pagetext.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: story + "\na second paragraph", 2: story + "\na second paragraph",
                   3: "the keeper said that once upon a time there was a river, and that was all"}


def test_pages_lose_what_the_host_repeats(spark):
    bar = "all rights reserved by the site owner"
    pages = [(1, "https://a.com/1", f"<div>{bar}</div><div>first story about rivers</div>"), (2, "http://u@A.com:80/2", f"<div>second story</div><div>{bar}</div>"),
             (3, "https://b.com/1", f"<div>{bar}</div>"), (4, "https://a.com/3", "<article>a marked article with many words in it</article>"),
             (5, "https://a.com/4", "<article>a marked article with many words in it</article><p>x"), (6, None, None), (None, None, "<p>t"), (None, None, "<p>t")]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("page", F.lit(1))
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in pagetext.extract_pages(docs).collect()), key=repr)
    article = "a marked article with many words in it"
    want = [(1, "first story about rivers"), (2, "second story"), (3, bar), (4, article), (5, article), (6, ""), (None, "t"), (None, "t")]
    assert got == sorted(((i, t, len(t)) for i, t in want), key=repr)
    assert pagetext.extract_pages(docs.where("false")).count() == 0


def test_repeated_suffixes_match_brute_force(spark):
    rnd = random.Random(9)
    streams = [(h, p, [rnd.choice("abc") for _ in range(rnd.randint(0, 25))]) for h in "xy" for p in range(20)]
    scanned = spark.createDataFrame([(f"http://{h}/", hash((h, p)), [" ".join(t)]) for h, p, t in streams], "url string, stream long, rest array<string>")
    found = pagetext.suffixes(scanned)
    got = {(r["stream"], r["at"]) for r in found.join(pagetext.repeated_suffixes(found), ["host", "prefix"], "left_semi").collect()}
    holders = {}
    for h, p, t in streams:
        for i in range(len(t) - pagetext.RUN + 1):
            holders.setdefault((h, tuple(t[i:i + pagetext.RUN])), set()).add(p)
    assert got == {(hash((h, p)), i) for h, p, t in streams for i in range(len(t) - pagetext.RUN + 1)
                   if len(holders[h, tuple(t[i:i + pagetext.RUN])]) > 1}


def test_suffix_array_is_sorted_and_holds_common_prefixes(spark):
    rnd = random.Random(21)
    run, depth = 3, 7
    streams = {(h, p): [rnd.choice("ab") for _ in range(rnd.randint(0, 16))] for h in "xy" for p in range(8)}
    scanned = spark.createDataFrame([(f"http://{h}/", p, [" ".join(t)]) for (h, p), t in streams.items()], "url string, stream long, rest array<string>")
    array = pagetext.suffix_array(scanned, run, depth)
    rows = sorted(array.collect(), key=lambda r: (r["host"], r["prefix"], r["interval"], r["tail"], r["stream"], r["at"]))
    for (_, _), group in itertools.groupby(rows, key=lambda r: (r["host"], r["prefix"])):
        group = list(group)
        assert [r["tail"] for r in group] == sorted(streams[r["host"], r["stream"]][r["at"]:r["at"] + depth] for r in group)
        same = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert [r["common"] for r in group] == [0] + [same(a["tail"], b["tail"]) for a, b in zip(group, group[1:])]
    holders = {}
    for (h, p), t in streams.items():
        for i in range(len(t) - run + 1):
            holders.setdefault((h, tuple(t[i:i + run])), set()).add(p)
    want = set()
    for (h, p), t in streams.items():
        n = [len(holders[h, tuple(t[i:i + run])]) for i in range(len(t) - run + 1)]
        for i, k in enumerate(n):
            if k > 1 and (i == 0 or n[i - 1] != k):
                end = next((j for j in range(i, len(n)) if n[j] != k), len(n))
                want.add((h, p, i, end - 1 - i + run, k))
    assert {tuple(r) for r in pagetext.maximal_repeats(array, run=run).collect()} == want


def test_repeats_decide_inside_marked_articles(spark):
    rnd = random.Random(5)
    say = lambda n: " ".join("".join(rnd.choice("aeioklmnrst") for _ in range(6)) for _ in range(n))
    bar, line = "get our letter every morning in your box", "a line that some of the articles have"
    page = lambda parts: "<article>" + "".join(f"<div>{p}</div>" for p in parts) + "</article>"
    own = [say(60) for _ in range(10)]
    parts = {k: [own[k], *([bar] if k < 7 else []), *([line] if k < 4 else [])] for k in range(10)}
    rows = [(k, f"http://h/{k}", page(p)) for k, p in parts.items()]
    copy = say(60)  # nearly equal articles: their short blocks are text
    copies = {20 + k: [copy, bar, f"number {k}"] for k in range(12)}
    rows += [(k, f"http://mirror/{k}", page(p)) for k, p in copies.items()]
    short = {40 + k: [say(10), bar] for k in range(6)}  # too large a part of the article
    rows += [(k, f"http://brief/{k}", page(p)) for k, p in short.items()]
    got = {r["page_id"]: r["text"] for r in pagetext.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {k: "\n".join(b for b in p if b != bar) for k, p in parts.items()} | {k: "\n".join(p) for k, p in (copies | short).items()}
    assert got == want


def test_postings_carry_their_words_and_counts_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "COUNTED", 2)
    texts = ["Größe 東京 b c 東京", "", None, "b b x", "é 東京"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    terms = spark.createDataFrame([("東京",), ("b",), ("none",)], "term string")
    assert {r["term"]: r["n"] for r in decontaminate.term_counts(docs, terms).collect()} == {"東京": 3, "b": 3}
    found = decontaminate.build_index(docs, terms, 2).where("term IS NOT NULL").collect()
    want = []
    for i, text in enumerate(texts):
        padded = ["", "", *(t.decode() for t in decontaminate.tokens(text)), "", ""]
        want += [(padded[p], i, p - 2, " ".join(padded[p - 2:p + 3])) for p in range(2, len(padded) - 2) if padded[p] in ("東京", "b")]
    assert sorted((r["term"], r["doc_id"], r["pos"], r["around"]) for r in found) == sorted(want)
