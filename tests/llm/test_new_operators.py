"""Main text, periodic runs and the Merkle manifest: brute force on small
inputs, the oracles' queries, and the defined results."""

import hashlib
import random
import re
import zlib
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from dq_mart.llm import layouts, maintext, manifest, runs
from dq_mart.llm.queries import QUERIES

from conftest import SF_SMALL
from test_operators import EDGE, LONG, docs_of


# --- main text --------------------------------------------------------------------

@pytest.fixture(scope="module")
def field(spark):
    return maintext.fit(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))


def test_main_text_of_the_pages(spark):
    got = {r.page_id: r for r in QUERIES["op11_main_text"](spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(pages) > 0
    for p in pages:
        inside = p.html[p.html.index("<article>") + 9:p.html.index("</article>")]
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inside)]
        want = "\n".join(x for x in parts if x)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want) and got[p.page_id].url == p.url


def test_blocks_of_unseen_templates(field):
    wrong = n = 0
    for html in layouts.training_pages(150, seed=901):
        _, want = maintext.labelled(html)
        got = field.labels(maintext.Reader(field.weights).blocks(html))
        wrong += sum(bool(a) != bool(b) for a, b in zip(want, got))
        n += len(want)
    assert n > 2000 and wrong < 0.01 * n


T = "On the old road the thing was seen again. It went, they say, north."
PAGES = {
    f"<body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{T}</p><p>Be.</p>"
    f"</article><section class=comments><h2>Comments</h2><p>{T}</p></section><footer>&copy; x</footer>":
        f"Title\n{T}\nBe.",
    f"<article><h1>Title</h1><div class=ad>{T}</div><p>{T}</p><aside><p>{T}</p></aside><form><label>Mail</label>"
    f"<button>Go</button></form><p>The.</p><div class='comments'><p>{T}</p></div></article>": f"Title\n{T}\nThe.",
    f"<div id=cookie-banner>{T}</div><div id=content><h1>Title</h1><p>{T}</p><ul><li>One<li>Two</ul></div>"
    f"<div class=sidebar><h3>Related</h3><p>{T}</p></div><div id=footer>{T}</div>": f"Title\n{T}\nOne\nTwo",
    "<article><p>a<b>b</b>c &lt;x&gt;&#233;&nbsp;\n y<br>z &am &copy</p><script>var p='<p>no</p>'</script>"
    "<!-- <p>no</p> --><style>p{}</style><p>x < y & z": "abc <x>é y z &am ©\nx < y & z",
}


@pytest.mark.parametrize("html", PAGES)
def test_handmade_pages(field, html):
    assert field.text(html) == PAGES[html]


def test_viterbi_is_the_best_labelling(field):
    for html in layouts.training_pages(40, seed=55):
        blocks = maintext.Reader(field.weights).blocks(html)[:9]
        e = [field.bias + b[3].score + sum(field.weights.get(f, 0.0) for f in maintext._text_features(*b[:3]))
             for b in blocks]
        def total(y):
            return sum(e[i] * y[i] + (field.move[y[i - 1], y[i]] if i else 0) for i in range(len(y)))
        best = max(total([k >> i & 1 for i in range(len(e))]) for k in range(2 ** len(e)))
        assert total([int(y) for y in field.labels(blocks)]) == pytest.approx(best)
    assert field.labels([]) == []


def test_main_text_edges(spark, field):
    rows = [(1, None), (None, f"<article><p>{T}</p></article>"), (2, ""), (3, " \n "), (4, "<" * 3000),
            (5, "<article><p>" + LONG), (5, "<article><p>" + LONG), (6, "<article>" + "<div>" * 20000 + "x"),
            (7, "<a href=\"" * 5000), (8, "<article><p>" + "<b>x" * 20000), (9, "<!--" * 5000)]
    df = spark.createDataFrame(rows, "page_id bigint, html string").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("id", "text", "names", "labels", "h", "page", "hide")})
    got = [(r.page_id, r.text) for r in maintext.extract(df, field).collect()]
    texts = dict(got)
    assert len(got) == len(rows) and texts[1] == texts[2] == texts[3] == texts[9] == texts[7] == ""
    assert texts[None] == T and [i for i, _ in got].count(5) == 2 and texts[5] == LONG.strip()
    empty = df.where("page_id < -1")
    assert maintext.extract(empty, maintext.fit(empty, templates=60)).collect() == []


# --- periodic runs ------------------------------------------------------------------

def brute_runs(w, least=12):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in out.items())


def test_runs_by_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        texts = []
        for _ in range(rng.randint(1, 5)):
            n, k = rng.choice([0, 1, 5, 12, 20, 40, 90]), rng.choice([1, 2, 3, 5])
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = rng.randint(1, n - a)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        least = rng.choice([12, 12, 7, 4, 2])
        got = runs.find_runs(np.array([x for w in texts for x in w], np.int64),
                             np.array([len(w) for w in texts]), least)
        for i, w in enumerate(texts):
            assert got.get(i, []) == brute_runs(w, least), (w, least)


def test_long_periodic_texts():
    for w, want in (([0] * 60_000, [(0, 60_000, 1)]), ([0, 1, 2] * 20_000, [(0, 60_000, 3)])):
        assert runs.find_runs(np.array(w), np.array([len(w)])) == {0: want}


def test_collapsed_words():
    words = b"x a b a b a b a b a b a b a b y".split()
    assert runs.collapsed(words, brute_runs(words)) == b"x a b y"
    assert runs.collapsed(words, []) == b" ".join(words)


def test_runs_edges(spark):
    rows = EDGE + [(7, "A a " * 10), (8, "one\x0btwo\x1cthree four five")]
    got = {}
    for r in runs.periodic_runs(docs_of(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[4]) == 2 and len(got[None]) == 2
    assert [tuple(x) for x in got[4][0].runs] == [(0, 40_000, 2)] and got[4][0].collapsed == "lorem ipsum"
    assert got[1][0].n_words == got[2][0].n_words == got[3][0].n_words == 0 and got[1][0].collapsed == ""
    assert [tuple(x) for x in got[7][0].runs] == [(0, 20, 2)]          # case matters
    assert got[8][0].n_words == 2 and got[6][0].collapsed == "a b"
    assert runs.periodic_runs(docs_of(spark, rows).where("false")).collect() == []


def test_planted_runs_of_the_query(spark, tmp_path):
    """Rewritten words, the query's columns and digests by brute force."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefghij") * rng.randint(1, 2) for _ in range(rng.choice([0, 1, 30, 80]))))
            for i in range(120)] + [(500, None), (None, "a b c")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, text in rows:
        w = (text or "").split()
        n, h = len(w), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        found, r = brute_runs(w), got[i]
        gone = {j for s, size, q in found for j in range(s + q, s + size)}
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == sha("".join(f"{s},{size},{q}\n" for s, size, q in found))
        assert r.collapsed_sha256 == sha(" ".join(x for j, x in enumerate(w) if j not in gone))


# --- Merkle manifest ------------------------------------------------------------------

def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_leaf(row, low=False):
    text = row["text"]
    if low and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(nodes):
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        groups = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for k in range(len(paths)):
            up, digit = divmod(place[k], 16)
            paths[k].append((digit, groups[up][:digit] + groups[up][digit + 1:]))
            place[k] = up
        nodes = [H("".join(g)) for g in groups]
    return nodes[0], paths


def brute_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    sub, paths = {}, {}
    for s in names:
        by[s].sort(key=lambda x: x[:3])
        sub[s], paths[s] = brute_tree([x[2] for x in by[s]])
    root, above = brute_tree([sub[s] for s in names])
    out = []
    for k, s in enumerate(names):
        for (_, _, leaf, r), path in zip(by[s], paths[s]):
            whole = path + above[k]
            i = r["doc_id"]
            altered = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
            at = brute_leaf(r, True) if altered else leaf
            for digit, others in whole:
                at = H("".join(others[:digit] + [at] + others[digit:]))
            out.append((i, leaf, sub[s], root, H("".join("".join(o) for _, o in whole)), at, at == root))
    return out


def proofs(df):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return manifest.verify(df, "source", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"],
                           {"text": lower}, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


def as_sorted(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 1], [300, 1, 16, 257], [2] * 40, [33] + [1] * 18])
def test_manifest_by_brute_force(spark, sizes):
    rows = [(100 * s + i, f"Text {i} of {s}", f"src{s}") for s, n in enumerate(sizes) for i in range(n)]
    random.Random(2).shuffle(rows)
    df = docs_of(spark, rows)
    want = brute_manifest([r.asDict() for r in df.collect()])
    assert as_sorted(proofs(df).collect()) == as_sorted(want)
    assert any(not w[-1] for w in want) or len(want) < 3


def test_manifest_edges(spark):
    rows = [(i, t, s) for i, t in EDGE for s in (None, "", "Å", "z")] + [(9, "Same Text", None)] * 40
    df = docs_of(spark, rows)
    df = df.withColumn("lang", F.when(F.col("doc_id") == 2, None).otherwise(F.col("lang")))
    want = brute_manifest([r.asDict() for r in df.collect()])
    got = proofs(df).collect()
    # rows that are alike share a leaf; each has a place and a proof of its own
    assert as_sorted(got) == as_sorted(want)
    assert proofs(df.where("false")).collect() == []


def test_manifest_store_is_content_addressed(spark):
    df = docs_of(spark, [(i, f"T{i}", f"s{i % 3}") for i in range(400)])
    rows = df.select(F.col("source").alias("grp"), F.col("doc_id").alias("id"),
                     manifest.digest_of([F.col("doc_id"), F.col("text")]).alias("digest"))
    m = manifest.Manifest(rows, ["id", "digest"])
    store = {r.digest: r.children for r in m.store().collect()}
    assert all(H("".join(c)) == d and 1 <= len(c) <= 16 for d, c in store.items())
    seen, todo = [], [m.root().first().digest]
    while todo:                          # every leaf is reached from the root
        d = todo.pop()
        if d in store:
            todo += store[d]
        else:
            seen.append(d)
    assert sorted(seen) == sorted(r.digest for r in rows.collect())


def test_fold_and_digests_differ(spark):
    one = spark.createDataFrame([(None, ""), ("-", "a"), ("", None), ("2:ab", "x")], "a string, b string")
    leaves = [r[0] for r in one.select(manifest.digest_of([F.col("a"), F.col("b")])).collect()]
    assert leaves[0] == H("-0:") and leaves[2] == H("0:-") and len(set(leaves)) == 4
