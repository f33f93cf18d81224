"""Every operator against a plain version of itself, and on rows that are null, empty, very long, repeated or oddly named."""

import base64
import hashlib
import html
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

pytest.importorskip("pairloom.llm")
from pairloom.llm import bpe, decontaminate, html_text, licenses, line_dedup, lm, ngram_join, pii, quality, queries  # noqa: E402
from pairloom.llm.components import components  # noqa: E402
from pairloom.llm.exact_dedup import exact_duplicates  # noqa: E402
from pairloom.llm.shared import TEXTS, add_rows, membership, parts_of, texts_of, with_membership, without  # noqa: E402
from pairloom.llm.words import hashes_of, steps, words_of  # noqa: E402

BLANK = re.compile(rb"[\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
ODD_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _hit boolean, score double, license string, n_tokens string"


def words(text):
    return [w for w in BLANK.split((text or "").encode().translate(LOWER)) if w]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, clashing names, keys beyond 2 ** 53."""
    long = " ".join(f"word{i % 977} Ünï{i}" for i in range(30_000))
    run = "the quick brown fox jumps over the lazy dog again and again until evening comes\n"
    texts = [None, "", "  \n\t", long, long, run * 3, run * 3 + "end", run * 3, "One.", "one.", "a b c d e", "A b c d e", "a b c d", "!!", "Released under the MIT License."]
    rows = [(i if i != 9 else 2**60 + 1, t, None, None, None, None, None, None, None) for i, t in enumerate(texts)]
    rows += [(None, "One.", "en", "s", 4, True, 1.0, "x", "y"), (4, long, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, ODD_COLUMNS)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf_dir, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None


# 1 HTML


def test_pages(spark, sf_dir):
    """The article of the given pages is the text between its tags, block by block."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.QUERIES["op1_html_text"](spark, sf_dir).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>?", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_page_parts():
    text = "One sentence, with a comma, and <b>bold</b>&nbsp;words &amp; more of them to score well. " * 3
    page = (
        "<body><header>Top</header><ul class=menu><li><a href=/>Home</a></ul><div id='content'><h2>Title</h2><p>" + text + "<p>Short."
        "<div class='share-buttons'><a>Tweet</a></div><script>if (a < b) '</p>'</script><form><input>Name</form></div>"
        "<div id=comments><p>" + text + "</div><aside>Side</aside><footer>End</footer>"
    )
    plain = " ".join(html.unescape(re.sub("<[^>]*>", "", text)).split())
    assert html_text.main_text(page) == f"Title\n\n{plain}\n\nShort."
    assert html_text.main_text("") == html_text.main_text("<p></p>") == html_text.main_text("<script>x") == ""
    assert html_text.main_text("<article><p>cut &eacute;&#233; off<p>in a ta") == "cut éé off\n\nin a ta"
    assert html_text.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_html_odd(odd, empty):
    rows = html_text.extract(odd.withColumnRenamed("text", "html"), text="main").collect()
    assert len(rows) == 18 and sum(r.main == "" for r in rows) == 4
    assert html_text.extract(empty.withColumnRenamed("text", "html")).count() == 0


# 2 BPE


@pytest.fixture(scope="module")
def encoding():
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_texts(encoding):
    path, known = encoding
    vocabulary = bpe.Vocabulary(open(path, "rb").read())
    random = np.random.default_rng(3)
    pool = list("aZé 's'tre'll've'd'm'''  \n\t\r\x1c 　\xa0١12½#!$.-_中文字😀ǅᲉ")
    texts = ["".join(random.choice(pool, random.integers(0, 70))) for _ in range(3000)] + ["", "\n", "x" * 5000, "ab " * 3000, "!" * 999]
    texts += ["".join(map(chr, random.integers(1, 0xD7FF, 40))) for _ in range(1000)]
    for text, ids in zip(texts, vocabulary.encode(texts), strict=True):
        assert ids.tolist() == known.encode_ordinary(text), repr(text)
        assert vocabulary.decode(ids, vocabulary.offsets(ids)) == text.encode()


def test_bpe_table(spark, sf_dir, odd, empty, documents, encoding):
    path, known = encoding
    got = {r.doc_id: r for r in queries.QUERIES["op2_byte_bpe"](spark, sf_dir).collect()}
    for i, text in documents:
        ids = np.array(known.encode_ordinary(text or ""), "<u4")
        want = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want
    back = bpe.decode(bpe.encode(odd.select("doc_id", "text", "lang"), path), path)
    whole = [(r.doc_id, r.text or "", r.lang) for r in odd.collect()]
    assert Counter((r.doc_id, r.text, r.lang) for r in back.collect()) == Counter(whole)
    assert bpe.encode(empty.drop("n_tokens"), path).count() == 0
    assert bpe.encode(odd.select("doc_id", "text"), path, offsets=False).columns == ["doc_id", "n_tokens", "ids"]
    with pytest.raises(ValueError, match="n_tokens"):
        bpe.encode(odd, path)


# 3 private data


def test_surrogates(spark, odd, empty):
    text = (
        "Mr. John Smith and Mrs Jane DOE, again Mr John Smith; Dr Иван Петров. +1 (212) 555-1234 or +12125551234, 10.0.0.1, card 4111-1111-1111-1111 and "
        "4111111111111111, bob@x.org BOB@X.ORG, token = \"0123456789abcdef0123456789abcdef01234567\" v1.2.3.4.5"
    )
    rows = pii.replace_private_data(spark.createDataFrame([(1, text), (2, text), (3, "nothing here, 12 3"), (4, None)], "doc_id int, text string"), "k").collect()
    by = {r.doc_id: r for r in rows}
    out = by[1].text
    assert out == by[2].text and by[3].text == "nothing here, 12 3" and by[4].text == "" and by[3]._entities == []
    for piece in ("Smith", "Jane", "Петров", "555-1234", "10.0.0.1", "4111", "bob@", "BOB@", "0123456789abcdef"):
        assert piece not in out
    men = re.findall(r"Mr\.? (\w+ \w+)", out)
    assert men[0] == men[1] and men[0].split()[0] in pii.GIVEN["m"]["latin"] and men[0].split()[1] in pii.FAMILY["latin"]
    woman = re.search(r"Mrs (\w+) (\w+)", out)
    assert woman[1] in pii.GIVEN["f"]["latin"] and re.search(r"Dr [А-Яа-я]+ [А-Яа-я]+", out)
    phone, plain = re.search(r"\+\d \(\d{3}\) \d{3}-\d{4}", out)[0], re.search(r"\+\d{11}", out)[0]
    assert re.sub(r"\D", "", phone) == re.sub(r"\D", "", plain)
    card = re.search(r"\d{4}-\d{4}-\d{4}-\d{4}", out)[0]
    assert card.replace("-", "") in out
    mails = re.findall(r"\S+@\S+?(?=[ ,])", out)
    assert mails[0].upper() == mails[1] and mails[0].endswith("@x.org") and out.endswith("v1.2.3.4.5")
    assert {e.kind: e["count"] for e in by[1]._entities} == {"email": 2, "secret": 1, "ip": 1, "phone": 2, "card": 2, "name": 4}
    assert pii.replace_private_data(odd, "k").count() == 18 and pii.replace_private_data(empty, "k").count() == 0


def test_surrogates_stay_apart(spark):
    """Many entities of a small space: all surrogates differ from each other and from every entity."""
    forms = spark.range(300).select(F.lit("ip").alias("_kind"), F.concat(F.lit("10.0."), (F.col("id") / 200).cast("int"), F.lit("."), F.col("id") % 200).alias("_form"), F.lit(None).cast("string").alias("_gender"))
    names = spark.range(60).select(F.lit("name").alias("_kind"), F.concat(F.lit("n"), F.col("id")).alias("_form"), F.lit("m").alias("_gender"))
    rows = pii.surrogates(forms.unionByName(names), "k").collect()
    assert len(rows) == 360 and len({(r._kind, r._surrogate) for r in rows}) == 360
    assert not {(r._kind, r._surrogate) for r in rows} & {(r._kind, r._form) for r in rows}


def test_long_runs_do_not_overflow(spark):
    """Every pattern on texts that repeat what it repeats, 100 kB each but for a host of 300 labels."""
    texts = [f"x@{'ab.' * 300}com", "a." * 50_000 + "@b.com", "x@" + "a-" * 50_000, "1.2.3." * 17_000, "+49 12 " * 14_000, "1234-" * 20_000, "Dr Ab " * 17_000,
             "Dr " + "A'" * 50_000, "sk-" + "a" * 100_000, "0" * 100_000, "(12) 345 " * 11_000, "ab1" * 33_000]
    rows = pii.replace_private_data(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), "k").collect()
    assert len(rows) == len(texts) and all(r.text for r in rows)
    assert "ab.ab.com" in next(r.text for r in rows if r.doc_id == 0) and next(r.text for r in rows if r.doc_id == 0) != texts[0]


def test_surrogates_where_all_short_ones_are_taken(spark):
    """All one-letter addresses of a host, and all numbers of a short form, still get surrogates that no one else has."""
    mails = [(f"{c}@x.org",) for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = pii.replace_private_data(spark.createDataFrame([(i, f"write to {m}") for i, (m,) in enumerate(mails)], "doc_id int, text string"), "k").collect()
    new = {r.text.removeprefix("write to ") for r in rows}
    assert len(new) == 26 and not new & {m for (m,) in mails} and all(re.fullmatch(r"[a-z]+@x\.org", m) for m in new)
    forms = spark.createDataFrame([("phone", f"1{i}", None) for i in range(10)], "_kind string, _form string, _gender string")
    got = pii.surrogates(forms, "k").collect()
    assert len({r._surrogate for r in got}) == 10 and not {r._surrogate for r in got} & {r._form for r in got}
    shown = spark.createDataFrame([("phone", "(12) 3", "1945678")], "k string, found string, new string")
    assert shown.select(pii.formatted(F.col("k"), F.col("found"), F.col("new"))).first()[0] == "(19) 45678"


def test_no_private_data_left(spark, sf_dir, documents):
    found = re.compile(r"[\w.]+@mail\S*\.com|\+1 \(\d{3}\) 555-\d{4}|(?<![\w.])\d{16}(?!\w)|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])|(?<=\")[0-9a-fA-F]{40}(?=\")")
    got = {r.doc_id: r for r in queries.QUERIES["op3_private_data"](spark, sf_dir).collect()}
    for i, text in documents:
        assert got[i].changed == bool(found.search(text)) or got[i].changed
        assert not set(found.findall(text)) & set(found.findall(got[i].text))
        if not got[i].changed:
            assert got[i].text == text


# 4 licences


def test_patience():
    a, b = "x a b c q d e".split(), "a b c d z e".split()
    pairs = licenses.patience_align(a, b)
    assert [a[i] for i, _ in pairs] == ["a", "b", "c", "d", "e"] and all(a[i] == b[j] for i, j in pairs)
    random = np.random.default_rng(5)
    for _ in range(200):
        a, b = (random.integers(0, 12, random.integers(0, 30)).astype(str).tolist() for _ in range(2))
        pairs = licenses.patience_align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(set(pairs))
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def test_licenses(spark, sf_dir, odd, empty, documents):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    got = Counter((r.doc_id, r.license) for r in queries.QUERIES["op4_license_scan"](spark, sf_dir).collect())
    assert got == Counter((i, n) for i, t in documents for line, n in lines.items() for _ in range(t.count(line)))
    scanner = licenses.Scanner(licenses.TEMPLATES)
    changed = licenses._MIT.replace("free of charge", "gratis").replace("publish, ", "")
    (row,) = scanner.find("intro words\n" + changed + "\nend", 0.8)
    assert row[0] == "MIT" and 0.8 < row[1] < 1
    assert not scanner.find("we work under pressure, by a version of the license", 0.8)
    for line in ("Licensed under the BSD License.", "Released under the ISC License.", "licensed under the Mozilla Public License.", "Licensed under the Apache License, Version 1.1.",
                 "This work is licensed under the GNU Lesser General Public License, version 3.", "This work is licensed under the GNU General Public License, version 2.",
                 "Licensed under CC BY-ND 4.0.", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY 3.0.", "This work is licensed under a Creative Commons Attribution 3.0 International License.",
                 licenses._GPL.replace("version 3", "version 2"), licenses._GPL.replace("GNU", "GNU Lesser"), licenses._APACHE.replace("2.0", "1.1")):
        assert scanner.find(line, 0.8) == [], line
    rows = licenses.find_licenses(odd.drop("license")).collect()
    assert [(r.doc_id, r.license) for r in rows] == [(14, "MIT")] and licenses.find_licenses(empty).count() == 0


# 5 lines


def test_perfect_hash():
    random = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 4000):
        h1, h2 = np.unique(random.integers(-(2**63), 2**63 - 1, 2 * n))[:n], random.integers(-(2**63), 2**63 - 1, n)
        seeds, prints, counts = line_dedup.build_shard(h1, h2, np.arange(n))
        row = {"shard": 0, "lines": n, "seeds": seeds.tobytes(), "prints": prints.tobytes(), "counts": counts.tobytes()}
        arrays = line_dedup.Arrays(1, [row])
        assert arrays.count(h1, h2).tolist() == list(range(n)) and sorted(counts) == list(range(n))
        assert not arrays.count(h1, h2 + 1).any()


@pytest.mark.parametrize("how", [{}, {"pass_bytes": 40, "shard_lines": 2}])
def test_lines(odd, empty, how):
    """In one pass and in several."""
    rows = [r for r in odd.collect()]
    keys = [[k.strip(" \t\n\v\f\r").encode().translate(LOWER) for k in (r.text or "").split("\n")] for r in rows]
    found = Counter(k for ks in keys for k in set(ks))
    want = []
    for r, ks in zip(rows, keys):
        kept = [x for x, k in zip((r.text or "").split("\n"), ks) if not (k and found[k] >= 2)]
        want.append((r.doc_id, "\n".join(kept), len(ks), len(ks) - len(kept), r.n_tokens))
    got = line_dedup.drop_frequent_lines(odd, min_docs=2, **how).collect()
    assert Counter((r.doc_id, r.text, r._n_lines, r._n_dropped, r.n_tokens) for r in got) == Counter(want)
    assert line_dedup.drop_frequent_lines(empty, min_docs=2, **how).count() == 0


# 6 exact duplicates


@pytest.mark.parametrize("prefix", [1, 64])
def test_exact(odd, empty, prefix):
    groups = defaultdict(list)
    for r in odd.collect():
        form = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        groups[form].append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0, r.doc_id))
    rows = exact_duplicates(odd, prefix=prefix, digest_all=True).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.text_sha256].append(r)
    assert len(rows) == 18 and len(by) == len(groups)
    for form, members in groups.items():
        got = by[hashlib.sha256(form.encode()).hexdigest()]
        assert [r.group_size for r in got] == [len(members)] * len(members) and {r.keep_id for r in got} == {min(members)[3]}
        assert sum(r.kept for r in got) == 1 and next(r.doc_id for r in got if r.kept) == min(members)[3]
    assert exact_duplicates(empty).count() == 0
    assert {r.text_sha256 is None for r in exact_duplicates(odd).where("group_size > 1").collect()} == {False}


# 7 language model


def test_scores(spark, sf_dir, odd, empty, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op7_context_mixing"](spark, sf_dir).collect()}
    own = {i: words(t) for i, t in documents}
    train = [i for i in own if zlib.crc32(str(i).encode()) % 10]
    count = Counter(w for i in train for w in own[i])
    tokens, distinct = sum(count.values()) + len(train), len(count) + 1
    log = lambda c: math.log10((c + 0.1) / (tokens + 0.1 * (distinct + 1)))
    for i, ws in own.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws) + 1, sum(count[w] > 0 for w in ws) + 1, tokens)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(sum(log(count[w]) for w in ws) + log(len(train)), rel=1e-9)
        assert r.score < 0 and 0 < r.bits_per_byte < 20
    held = [r for r in got.values() if r.held_out]
    # Far better than the bytes' own entropy, which is over four bits.
    assert -sum(r.score for r in held) / math.log10(2) < 3.3 * sum(len(b" ".join(own[r.doc_id])) + 1 for r in held)
    rows = lm.score_texts(odd).collect()
    assert len(rows) == 18 and {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert len({(r.base_score, r.score) for r in rows if r.doc_id == 4}) == 1
    assert lm.score_texts(empty).count() == 0


def test_code_and_model():
    """The code's ways are a full binary tree, and the probabilities of all continuations sum to one bit by bit."""
    lengths, _, _ = lm.huffman(np.arange(256))
    assert sum(2.0**-n for n in lengths) == pytest.approx(1)
    tables = np.zeros((len(lm.ORDERS), lm.SLOTS), np.float16)
    code = lm.huffman(np.zeros(256))
    ((bits, size, n),) = lm._score(["ab c"], tables, code)
    assert (size, n) == (5, 2) and bits == pytest.approx(sum(code[0][x] for x in b"ab c\n"))


# 8 leaks


def test_subsequence():
    random = np.random.default_rng(2)
    for _ in range(50):
        a, b = (random.integers(0, 6, random.integers(1, 25)).astype(np.uint64) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_subsequence(a, b) == table[-1, -1]


def test_leaks(spark, sf_dir, odd, empty):
    """Planted copies, copies with every eighth word changed, and paraphrases with words left out are found; others are not."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: r.text.split() for r in benchmark.collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    whole = {r.doc_id: " ".join((r.text or "").split()) for r in docs.collect()}
    clean = [t.split() for t in whole.values() if not any(" ".join(x[:8]) in t for x in items.values())]
    planted, want = [], set()
    for n, (i, ws) in enumerate(sorted(items.items())):
        filler = clean[n % len(clean)]
        changed = [w if k % 8 else f"new{k}" for k, w in enumerate(ws)]
        shorter = [w for k, w in enumerate(ws) if k % 7]
        for k, body in enumerate((ws, changed, shorter)):
            at = 10**6 + 10 * n + k
            planted.append((at, " ".join(filler[:90] + body + filler[90:200])))
            want.add((at, i))
        planted.append((10**6 + 10 * n + 9, " ".join(filler)))
    every = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(every, benchmark).collect()}
    exact = {(d, i) for d, t in whole.items() for i, ws in items.items() if " ".join(ws) in t}
    assert len(want & got) >= 0.95 * len(want) and exact <= got
    assert len(got - want - exact) <= 0.02 * len(got)
    one = spark.createDataFrame([(1, "the lazy dog again and again until evening comes the quick brown fox"), (2, None), (3, "")], "item_id int, text string")
    assert {r.doc_id for r in decontaminate.find_leaks(odd, one).collect()} <= {5, 6, 7}
    assert decontaminate.find_leaks(empty, one).count() == 0 and decontaminate.find_leaks(odd, one.where("false")).count() == 0


def test_leaks_in_blocks(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one, several = (decontaminate.find_leaks(docs, benchmark, items=n).select("doc_id", "item_id").collect() for n in (4000, 9))
    assert Counter(one) == Counter(several)


def test_texts_go_to_tasks_once(spark, sf_dir):
    """Leaks and shingle sets send a text to Python once, not beside itself; batches are worked on in parts."""
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id long, text string")
    for made in (decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), ngram_join.shingle_classes(docs, "doc_id", "text", 5)):
        assert "_source#" not in made._jdf.queryExecution().optimizedPlan().toString()
    batch = pa.RecordBatch.from_pydict({"k": list(range(2 * TEXTS + 1)), "t": [str(i) if i % 3 else None for i in range(2 * TEXTS + 1)]})
    parts = list(texts_of([batch, batch.slice(0, 0)]))
    assert [len(p) for p in parts] == [TEXTS, TEXTS, 1] and sum(parts, []) == batch.column(1).to_pylist()
    many = spark.range(0, 2500, 1, 1).select("id", F.lit("x").alias("other"), F.col("id").cast("string").alias("t"))
    odd_ones = lambda ts: ([i for i, t in enumerate(ts) if int(t) % 2], [[t for t in ts if int(t) % 2], [len(ts)] * sum(int(t) % 2 for t in ts)])
    got = add_rows(many, F.col("t"), odd_ones, "same string, n int", keep=["id"], rows=TEXTS)
    assert got.columns == ["id", "same", "n"]
    assert {(r.id, r.same) for r in got.collect()} == {(i, str(i)) for i in range(1, 2500, 2)} and got.agg(F.max("n")).first()[0] <= TEXTS


def test_leaks_hash_words_in_short_steps():
    """The search holds what lies beside the hashes for a short step only, and batches are cut where its steps end."""
    texts = [" ".join(f"word{i}x{k}" for k in range(100)) for i in range(900)]
    place = np.full(decontaminate.FEATURES, -1, np.int64)
    list(decontaminate._search(texts, {}, np.ones(len(place), np.float32), place, np.zeros((0, 1)), 0.3))  # powers are kept
    tracemalloc.start()
    assert not list(decontaminate._search(texts, {}, np.ones(len(place), np.float32), place, np.zeros((0, 1)), 0.3))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * 10**6  # all at once, it took 20.5 MB
    odd = ["", " ", "é ü", "x" * 300_000 + " y", "", *texts, "A b\tC"]
    for some in (odd, [], [""]):
        assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(hashes_of(some), words_of(some)))
    batch = pa.RecordBatch.from_pydict({"k": list(range(len(odd) + 1)), "t": odd + [None]})
    parts = list(parts_of([batch, batch.slice(0, 0)], chars=5000))
    assert [p.num_rows for p in parts] == [b - a for a, b in steps(odd + [""], 5000)] and pa.Table.from_batches(parts).column(1).to_pylist() == odd + [None]


def test_workers_keep_no_vocabulary(spark):
    """After a task the vocabulary and the cached merges are gone from Spark's Python workers, which live on for other stages."""
    rows = spark.range(0, 64, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), "id").alias("text"))
    assert bpe.encode(rows, queries.bpe_ranks()).agg(F.sum("n_tokens")).first()[0] > 64

    def held(batches):
        import gc

        list(batches)
        yield pa.RecordBatch.from_pydict({"n": [sum(type(x).__name__ == "Vocabulary" for x in gc.get_objects())]})

    assert [r.n for r in spark.range(0, 64, 1, 4).mapInArrow(held, "n long").collect()] == [0] * 4


# 9 quality


def test_quality(spark, sf_dir, odd, empty):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    rows = queries.QUERIES["op9_quality_nbsvm"](spark, sf).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(label[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in label]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(y == p for y, p, _ in held) / len(held) > 0.93 and all(p for y, p, _ in held if y)
    labels = spark.createDataFrame([(i, i % 2) for i in range(14)] + [(None, 1), (3, None), (5, 7)], "doc_id long, quality int")
    scored = quality.with_quality(odd, quality.fit(odd, labels)).collect()
    assert len(scored) == 18 and len({r._score for r in scored if not r.text}) == 1
    for none in (labels.where("false"), labels.where("quality = 1")):
        assert {round(r._score, 6) for r in quality.with_quality(odd, quality.fit(odd, none)).collect()} <= {0.5, 1.0}
    assert quality.with_quality(empty, quality.fit(empty, labels)).count() == 0


def test_descent_holds_no_scaled_rows():
    rows = [np.arange(i, i + 2000, dtype=np.int32) for i in range(500)]
    signs = np.where(np.arange(500) % 2, 1.0, -1.0)
    tracemalloc.start()
    quality.dual_coordinate_descent(rows, signs, np.linspace(-1, 1, 2500), np.full(500, 0.02), epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * 10**6  # all rows scaled would take 16 bytes for each of a million features


def test_dual_coordinate_descent():
    """On a separable set every row ends on its side, at a distance."""
    rows = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])]
    signs = np.array([1.0, 1.0, -1.0, -1.0])
    w = quality.dual_coordinate_descent(rows, signs, np.array([1.0, -1.0, 0.1, 0.1]), np.full(4, 10.0), epochs=50)
    margins = [float((w[:-1] * np.array([1.0, -1.0, 0.1, 0.1]))[r].sum() + w[-1]) for r in rows]
    assert all(s * m > 0.9 for s, m in zip(signs, margins))


# 10 similarity join


def brute_components(rows, size=5):
    sets, parent, at = [], {}, defaultdict(list)
    for _, text in rows:
        ws = words(text)
        sets.append({tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)} or ({tuple(ws)} if ws else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in at[g])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
        for g in s:
            at[g].append(i)
    least = defaultdict(list)
    for i in range(len(rows)):
        if rows[i][0] is not None:
            least[find(i)].append(rows[i][0])
    return Counter((rows[i][0], len(sets[i]), min(least[find(i)], default=None) if sets[i] else rows[i][0]) for i in range(len(rows)))


def test_join_documents(spark, sf_dir, documents):
    got = queries.QUERIES["op10_ngram_join"](spark, sf_dir).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(documents)


def test_join_near_copies(spark):
    """A large group of near copies, chains of copies and short texts around the threshold."""
    random = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = random.choice(vocabulary, 160).tolist()
    rows = []
    for _ in range(150):
        t = list(base)
        for k in random.integers(0, 160, random.integers(0, 4)):
            t[k] = str(random.integers(10**6))
        rows.append(" ".join(t))
    chain = random.choice(vocabulary, 90).tolist()
    for _ in range(40):
        chain = chain[2:] + random.choice(vocabulary, 2).tolist()
        rows.append(" ".join(chain))
    for n in range(1, 30):
        t = random.choice(vocabulary, n).tolist()
        rows += [" ".join(t), " ".join(t + ["x"]), " ".join(["y", *t]), " ".join(t).upper()]
    shared = random.choice(vocabulary, 60).tolist()
    rows += [" ".join(random.choice(vocabulary, 80).tolist() + shared) for _ in range(60)]
    table = list(enumerate(rows))
    got = ngram_join.similarity_components(spark.createDataFrame(table, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(table)


def test_join_odd(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = ngram_join.similarity_components(odd).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)
    assert ngram_join.similarity_components(empty).count() == 0


def test_signatures():
    """Sets at the threshold always share a signature."""
    random = np.random.default_rng(4)
    for _ in range(300):
        n = int(random.integers(4, 400))
        a = random.integers(0, 2**63, n).astype(np.uint64)
        k = int(random.integers(0, n // 9 + 1))
        b = np.concatenate((a[: n - k], random.integers(0, 2**63, k).astype(np.uint64)))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (2 * n - common) and common < n:
            x, y = (np.concatenate(ngram_join.signatures(np.unique(s), 80, 100)) for s in (a, b))
            assert len(np.intersect1d(x, y)) >= (2 if n >= 64 else 1)


def test_signatures_are_few_and_rare(spark):
    """A fifth of a set's shingles and two more, those first that few texts have."""
    random = np.random.default_rng(6)
    held = np.unique(random.integers(0, 2**63, 400).astype(np.uint64))
    assert sum(len(x) for x in ngram_join.signatures(held, 80, 100)) == len(held) // 5 + 2
    passage = " ".join(f"p{i}" for i in range(100))
    rows = [(i, passage + " " + " ".join(f"w{i}x{k}" for k in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    levels = ngram_join.shingle_levels(docs, "text", 5, 40 * 156)
    packed = ngram_join.packed_signatures(docs, "text", 5, 80, 100, 8, levels)
    assert ngram_join.sharing_classes(packed).count() == 0


def test_join_compares_few_of_a_family(spark, monkeypatch):
    """Of copies that are too different to link, few pairs are compared, and what links is found."""
    random = np.random.default_rng(12)
    base, rows, pairs = [f"b{i}" for i in range(150)], [], []
    for i in range(300):
        t = list(base)
        for k in random.choice(150, 1 + i % 9, replace=False):
            t[k] = f"e{i}x{k}"
        rows.append((i, " ".join(t)))
    likely = ngram_join._likely

    def counted(candidates, *more):
        pairs.append(candidates.count())
        return likely(candidates, *more)

    monkeypatch.setattr(ngram_join, "_likely", counted)
    got = ngram_join.similarity_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)
    assert len(pairs) == 2 and sum(pairs) < 6000


# What they share


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7), (6, 5), *((100 + i, 101 + i) for i in range(30))]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {2: 1, 3: 1, 9: 1, 6: 5} | {101 + i: 100 for i in range(30)}


def test_membership_and_without(spark):
    ids = spark.range(0, 3000, 3).select(F.xxhash64("id").alias("h"))
    marked = with_membership(spark.range(3000).withColumn("h", F.xxhash64("id")), "h", membership(ids, "h"), "there")
    assert marked.where("id % 3 = 0 and not there").count() == 0 and marked.where("id % 3 > 0 and there").count() < 10
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, t string")
    kept = without(rows, spark.createDataFrame([(2,), (None,), (5,)], "k long"), "k")
    assert sorted(r.t for r in kept.collect()) == ["a", "d"]
