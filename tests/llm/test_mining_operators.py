"""Spelling variants, phrases and main texts against brute-force versions on small tables with odd rows."""

import os
import re
import time
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from test_text_operators import BASE, SCHEMA

from tierline.llm import collocations, html_text, licenses, near_dedup, spelling, token_files

public_tokenizers = pytest.importorskip("public_tokenizers")

HOT = "kolossal " * 400
TEXTS = [None, "", " \n\t", "Straße strasse STRASSE über Ober", "a" * 3000, BASE * 3, BASE * 3, BASE.replace("quick", "quikc"), HOT, HOT.replace("o", "a", 40),
         "colour color colours colour color color colon colon colon", "color " * 9 + "colour " * 4 + "colours " * 3, "×÷×÷× x×÷y×÷z " * 4, "漢字 🙂 Ünï çødé " * 5]


def documents(spark, texts, langs=("en", "de", None)):
    rows = [(None if i == 3 else i, t, langs[i % len(langs)], "s", None, "x", 1, 2, "w", 3, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_variants(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around = {w: sorted((v for v in words if near(w, v)), key=lambda v: (-words[v], v)) for w in words}
    form = {w: v[0] if v and words[v[0]] >= 2 * words[w] else None for w, v in around.items()}
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(around[w]), words[form[w]] if form[w] else None))
    return out


CHAIN = [w for i, w in enumerate(["abcdefgh", "abcdefg", "abcdef", "bbcdef", "bccdef", "bccdeff"]) for _ in range(3 * 2**i)]


@pytest.mark.parametrize("round_bytes", [spelling.ROUND_BYTES, 128])
def test_spelling_variants(spark, round_bytes):
    texts = [*TEXTS, " ".join(CHAIN), *(" ".join(f"common{'xyz'[i % 3]}{chr(97 + i * k % 26)}" for k in range(60)) for i in range(30))]
    docs = documents(spark, texts)
    docs = docs.union(docs.filter("doc_id = 10"))
    want = brute_variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = spelling.variants(docs, round_bytes=round_bytes)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert any(r[1] and r[1] != r[2] for r in want)
    if round_bytes == 128:
        sizes = {r.n: r.c for r in got.selectExpr("length(word) AS n").groupBy("n").agg({"*": "count"}).withColumnRenamed("count(1)", "c").collect()}
        assert len(spelling.Plan(sizes, round_bytes).rounds) > 3
    assert spelling.variants(docs.limit(0)).count() == 0


def brute_collocations(rows, least, share, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p for p, a in counts.items() if a >= least and len(p) > 1}
        dropped = set()
        for q in cand:
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    if 100 * counts[q] >= share * counts[q[i : i + k]]:
                        dropped.add(q[i : i + k])
        ranked = []
        for p in cand - dropped:
            score, _, left, right = min((2000000 * counts[p] // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -counts[p], " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("bits,top", [(64, 2000), (3, 7)])
def test_collocations(spark, bits, top):
    texts = [*TEXTS, "New York,new  york\tnew york new\nyork. of of of of of " * 8, "x" * 70000 + " y " + "x" * 70000, "Aé" * 20 + " b. " + "aé" * 20 + " b " + "aé" * 20 + " c "]
    texts += [" ".join(f"w{i * k % 7}" for k in range(90)) for i in range(9)]
    docs = documents(spark, texts)
    docs = docs.union(docs)
    want = brute_collocations([tuple(r) for r in docs.select("lang", "text").collect()], 4, 80, top)
    found = collocations.collocations(docs, least=4, top=top, bits=bits)
    got = sorted((r["lang"], r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())
    assert got == want and len(want) > 20
    assert collocations.collocations(docs.limit(0)).count() == 0
    if bits == 64:
        texts_by_id = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
        for r in found.filter("doc_id is not null").collect():
            words = re.findall("[^ \t.,;:!?\n-\r]+", lower(texts_by_id[r.doc_id]))
            assert " ".join(words[r["word"] : r["word"] + len(r.phrase.split(" "))]) == r.phrase


def test_score_is_exact_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("10000000000000000L AS a", "10000000000000001L AS l", "10000000000000000L AS r")
    got = row.selectExpr(
        f"(cast({collocations.SCALE} as decimal(8,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) AS s"
    ).first()
    assert got.s == 2000000 * 10**16 // (2 * 10**16 + 1)


def test_phrases_with_one_fingerprint_are_told_apart():
    part = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["A b. a c a b", "a  b"], "lang": ["en", "de"]})
    found = collocations.Phrases(part)
    first = found.starts(2)
    assert found.text(first, 2).to_pylist() == ["a b", "a c", "c a", "a b", "a b"]
    assert found.same(first, first[[0] * 5], 2).tolist() == [True, False, False, True, False]


def prose(n, word="word"):
    return " ".join(f"{word}{i}," if i % 7 == 0 else f"{word}{i}" for i in range(n)) + "."


ARTICLE = [prose(40), prose(30), "Short.", prose(60)]
BODY = "".join(f"<p>{x}</p>" for x in ARTICLE)
MAIN = "\n\n".join(ARTICLE)
SEVERAL = f"<section><p>{ARTICLE[0]}<p>{ARTICLE[1]}</section><section><p>{ARTICLE[2]}<p>{ARTICLE[3]}</section>"
PAGES = [
    (None, ""), ("", ""), (" \n", ""), ("plain text &amp; more", "plain text & more"), ("<html><body><nav>x</nav></body></html>", ""),
    (f'<div id="header"><h1>Site</h1><p>{prose(20)}</p></div><ul class=menu><li><a href=x>a</a></ul><div class="wrap"><div class="post-content">{BODY}</div>'
     f'<div id="sidebar"><p>{prose(90)}</p></div></div><div id="comments"><div class=comment><p>{prose(200)}</p></div></div>', MAIN),
    (f'<body class="sidebar-right">{BODY}<div><a href=a>{prose(5)}</a></div></body>', MAIN),
    (f'<body><div class="c">{SEVERAL}</div><footer><p>{prose(90)}</footer>', MAIN),
    (f"<div id=outer><div class=part><p>{ARTICLE[0]}<p>{ARTICLE[1]}<p>{ARTICLE[2]}</div><div class=part><p>{ARTICLE[3]}</div></div>", MAIN),
    (f"<form id=f><div class=x>{BODY}</div><input value=a><div class=cookie-notice><p>We use, cookies, a, lot.</p></div></form>", MAIN),
    (f"<table><tr><td><a href=1>menu</a><td>{BODY}</td></tr></table>", MAIN),
    (f'<div class="has-sidebar sidebar"><main>{BODY}</main></div>', MAIN),
    (f'<header><p>{prose(70)}</p></header><main><h1>T &amp; X</h1><article>{BODY}<aside>{prose(80)}</aside></article>'
     f'<section class="related-posts"><p>{prose(80)}</section></main>', "T & X\n\n" + MAIN),
    (f'<article><h1>T</h1><p>{ARTICLE[0]}</p><div class="ad">buy, buy</div><p>{ARTICLE[1]}</p><!-- <p>no</p> --><div class="socialShare">share</div>'
     f'<p>{ARTICLE[2]}</p><script>if(a<b){{"</p>"}}</script><style>x</style><form><p>sub</p></form><div hidden>no</div><p>{ARTICLE[3]}</p></article>'
     f'<div class="comments-area"><p>{prose(300)}</p></div>', "T\n\n" + MAIN),
    (f'<div class="article">{BODY}</div><section class="user-comments"><article id=c1><p>{prose(300)}</article></section>', MAIN),
    ("<body><nav><a href=x>Home</a></nav><article><p>Hi.</p></article><footer>c</footer>", "Hi."),
    ("<article><p><b>One.<br><p>Two&nbsp;&#8212; &lt;b&gt; &am</b> x &amp y</p><p>cut off<a hre", "One.\n\nTwo — <b> &am x & y\n\ncut off"),
    (f"<div id=content><h2>H</h2>{BODY}<ul><li>one<li>two</ul><pre>x  y\n z</pre><blockquote>q</blockquote></div>", f"H\n\n{MAIN}\n\none\n\ntwo\n\nx y z\n\nq"),
    ("<p>" + "<div>" * 3000 + "deep", "deep"), ("<article><p>" + '<a "' * 3000 + "</p>", ""), ("<article><p>" + "long word " * 90000, ("long word " * 90000).strip()),
]


def test_main_text(spark):
    for page, want in PAGES:
        assert html_text.main_text(page)[0] == want
    rows = [(i % 4, None if i == 2 else "u", page, 1, "t") for i, (page, _) in enumerate(PAGES)] * 2
    table = spark.createDataFrame(rows, "page_id long, url string, html string, score int, text string").repartition(3)
    found = html_text.extract(table)
    assert sorted((r.page_id, r.url or "", r.text) for r in found.collect()) == sorted((i % 4, "" if i == 2 else "u", w) for i, (_, w) in enumerate(PAGES * 2) for i in [i % len(PAGES)])
    assert found.columns == ["page_id", "url", "text", "container", "score"]
    assert html_text.extract(table.limit(0)).count() == 0


COMMON = "/usr/share/common-licenses"
WHOLE_TEXTS = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}


@pytest.mark.skipif(not os.path.isdir(COMMON), reason="no licence texts on this machine")
def test_whole_licence_texts(spark):
    files = [(f"{name}/LICENSE", open(f"{COMMON}/{name}", encoding="utf-8").read()) for name in WHOLE_TEXTS]
    files += [(f"{name}/src/a.py", "code") for name in WHOLE_TEXTS]
    found = licenses.license_scan(spark.createDataFrame(files, "path string, text string")).collect()
    assert {(r.path.split("/")[0], r.license, r.origin) for r in found} == {(n, w, o) for n, w in WHOLE_TEXTS.items() for o in ("own", "inherited")}


def test_reused_and_missing_ids_lose_no_link(spark):
    words = lambda k, n=60: " ".join(f"{k}{i}" for i in range(n))
    rows = [(1, words("a")), (1, words("b")), (2, words("a") + " x"), (3, words("b") + " x"), (4, words("c")), (None, words("c")), (5, None), (5, "")]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.component_id) for r in found.collect()) == [(0, 4), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (5, 5)]


def test_many_empty_texts_are_written_in_seconds(spark, tmp_path):
    empty = spark.range(40000).selectExpr("id AS doc_id", "cast(null AS string) AS text").coalesce(1)
    began = time.time()
    token_files.write_token_file(empty, f"file:{tmp_path}/t", public_tokenizers.path("word_bpe_49k.json"))
    assert token_files.read_token_file(spark, f"file:{tmp_path}/t").count() == 40000 and time.time() - began < 60
