"""Periodic runs, token counts and token alignment against plain versions and the tokenizer libraries."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("pairloom.llm")
from pairloom.llm import alignment, queries, token_counts  # noqa: E402
from pairloom.llm.periodic import find_runs, periodic_runs  # noqa: E402
from pairloom.llm.words import words_of  # noqa: E402

ONE, OTHER = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
ATOMS = ["the", "running", " ", "  ", "\n", "\n\n", "\t", "'", "'re", "'ll", "''s", "ing", "1234", "!...", "é", "日本", "<|endoftext|>", "<|endof", "🙂",
         "\xa0", "　", "\r\n", "Zürich", "ʼ", "'r", "   "]
COLUMNS = "doc_id long, text string, lang string, score double, tokens long, _hit boolean"


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, texts without blanks, texts that a tokenizer does not give back."""
    rng = random.Random(7)
    texts = [None, "", " \n\t", "One.", "One.", "x" * 150_000, "日本語" * 30_000, "a" + " " * 30_000 + "b", "hello world, " * 12_000, "hello world, " * 12_000 + "▁", "a\x00b"]
    texts += ["".join(rng.choice(ATOMS) for _ in range(rng.randrange(14))) for _ in range(60)] + ["".join(rng.choice(ATOMS) for _ in range(40_000))]
    rows = [(i, t, None, None, None, None) for i, t in enumerate(texts)] + [(7, texts[7], "en", 1.0, 2, True), (None, "One.", None, None, None, None), (None,) * 6]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


# 11 periodic runs


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
            i += i > start and i + q < len(words) and words[i] != words[i + q]
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_repetitive_texts():
    rng = random.Random(5)

    def made():
        alphabet = rng.choice(["ab", "abc", [f"w{i}" for i in range(rng.choice([5, 20, 200]))]])
        out, size = [], rng.choice([0, 1, 11, 12, 40, 200, 300])
        while len(out) < size:
            block = [rng.choice(alphabet) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 13, 16, 17, 31, 32, 33, 64]))]
            out += block * rng.choice([1, 2, 2, 3, 5]) + block[: rng.randrange(len(block) + 1)]
        return out

    for _ in range(60):
        texts = [made() for _ in range(rng.choice([1, 3, 10]))]
        hashes, offsets, *_ = words_of([" ".join(t) for t in texts], lower=False)
        assert find_runs(hashes, offsets) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("words, runs", [(["a"] * 11, 0), (["a"] * 12, 1), (["a", "b"] * 200_000, 1), (["a"] * 3000 + ["b"] + ["a"] * 3000, 2)])
def test_long_runs(words, runs):
    hashes, offsets, *_ = words_of([" ".join(words)], lower=False)
    assert len(find_runs(hashes, offsets)[0]) == runs


def test_run_query(spark, sf_dir, documents):
    word, rows = re.compile(r"[^\x20\x09-\x0D]+"), {}
    for key, text in documents:
        words = word.findall(text or "")
        h, n = zlib.crc32(str(key).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))]
        rows[key] = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digests)
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(documents) and any(r[0] for r in rows.values())
    assert {k: got[k] for k in rows} == rows


def test_runs_of_odd_rows(odd):
    made = periodic_runs(odd.withColumn("runs_", F.lit(1)))
    assert made.columns == [*odd.columns, "runs_", "runs", "collapsed"]
    rows = made.collect()
    assert len(rows) == odd.count()
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        if len(words) < 3000:
            assert [tuple(x) for x in r.runs] == plain_runs(words) and r.collapsed == collapsed(words, plain_runs(words))
        elif len(set(words)) == 2:
            assert [tuple(x) for x in r.runs] == [(0, 24_000, 2)] and r.collapsed == "hello world,"
    assert periodic_runs(odd.where("false")).collect() == []
    with pytest.raises(ValueError, match="runs"):
        periodic_runs(odd.withColumn("runs", F.lit(1)))


# 12 token counts


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(ONE)


def n_tokens(tokenizer, texts):
    return [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_every_prefix(tokenizer):
    rng = random.Random(1)
    with open(ONE, "rb") as f:
        counter = token_counts.PrefixCounter(f.read())
    texts = ["".join(rng.choice(ATOMS) for _ in range(rng.randrange(14))) for _ in range(150)]
    for (_, parts), text in zip(counter.of_texts(texts), texts):
        assert np.concatenate(parts).tolist() == n_tokens(tokenizer, [text[:k] for k in range(1, len(text) + 1)])


def test_every_character(tokenizer):
    with open(ONE, "rb") as f:
        counter = token_counts.PrefixCounter(f.read())
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}{chr(c)}c." for c in range(0, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    assert [int(parts[-1][-1]) for _, parts in counter.of_texts(texts)] == n_tokens(tokenizer, texts)


def test_count_query(spark, sf_dir, documents, tokenizer):
    texts = [t or "" for _, t in documents]
    want = {k: (len(t.encode()), n, n > 1024) for (k, _), t, n in zip(documents, texts, n_tokens(tokenizer, texts))}
    assert {r[0]: tuple(r)[1:] for r in queries.QUERIES["op12_token_counts"](spark, sf_dir).collect()} == want


def test_counts_of_odd_rows(spark, odd, tokenizer):
    made = token_counts.prefix_counts(odd, ONE, chunk=1000)
    got = Counter((r.doc_id, r.lang, r.n_bytes, r.n_tokens) for r in token_counts.totals(made).collect())
    rows = odd.collect()
    counts = n_tokens(tokenizer, [r.text or "" for r in rows])
    assert got == Counter((r.doc_id, r.lang, len((r.text or "").encode()), n) for r, n in zip(rows, counts))
    assert made.agg(F.max(F.size("counts"))).first()[0] == 1000
    assert token_counts.prefix_counts(odd.where("false"), ONE).collect() == []
    with pytest.raises(ValueError, match="counts"):
        token_counts.prefix_counts(odd.withColumn("counts", F.lit(1)), ONE)


def test_budgets_without_encoding_again(spark, tokenizer):
    texts = {1: "Hello wonderful   world 'really well", 2: "", 3: None, 4: "word and <|endoftext|> more " * 300}
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    made = token_counts.prefix_counts(docs, ONE, chunk=100)
    for budget in (0, 1, 4, 50):
        got = {r.id: r.text for r in token_counts.truncated(docs, made, budget, "id").collect()}
        for key, text in texts.items():
            if text is not None:
                fits = [n <= budget for n in n_tokens(tokenizer, [text[:k] for k in range(len(text) + 1)])]
                assert got[key] == text[: max(k for k, x in enumerate(fits) if x)]
    for length in (0, 1, 17, 250):
        got = {r.id: r.n for r in made.select("id", token_counts.tokens_of_prefix(F.lit(length)).alias("n")).where("n is not null").collect()}
        assert got == {k: n_tokens(tokenizer, [t[:length]])[0] for k, t in ((k, t or "") for k, t in texts.items()) if len(t) >= length}


# 13 alignment


def plain_alignment(docs):
    """Per row (key, text) the contract's values, by walking through both libraries' tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    one, other = Tokenizer.from_file(ONE), sentencepiece.SentencePieceProcessor(model_file=OTHER)
    one.encode_special_tokens = True
    symbols = token_counts.byte_symbols()
    pieces = lambda i: bytes([int(other.id_to_piece(i)[3:5], 16)]) if other.is_byte(i) else other.id_to_piece(i).replace("▁", " ").encode()
    made, texts = [], Counter()
    for key, text in docs:
        source = (" " + (text or "")).encode()
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids
        b = other.encode(text or "")
        of_a, of_b = [bytes(symbols[c] for c in one.id_to_token(i)) for i in a], [pieces(i) for i in b]
        if not text or b"".join(of_a) != source or b"".join(of_b) != source:
            made.append((key, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in of_a]).tolist(), np.cumsum([len(x) for x in of_b]).tolist()
        links, groups, i, j, first_a, first_b = [], [], 0, 0, 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            x, y = ends_a[i], ends_b[j]
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append(",".join(map(str, a[first_a:i])) + "|" + ",".join(map(str, b[first_b:j])))
                first_a, first_b = i, j
        made.append((key, len(a), len(b), len(groups), links, ";".join(groups)))
        texts.update(set(links))
    highest = defaultdict(int)
    for (x, _), n in texts.items():
        highest[x] = max(highest[x], n)
    return Counter(
        (key, n_a, n_b, n, len(links), sum(texts[p] == highest[p[0]] for p in links), sum(texts[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for key, n_a, n_b, n, links, g in made
    )


def test_alignment_query(spark, sf_dir, documents):
    got = Counter(map(tuple, queries.QUERIES["op13_token_alignment"](spark, sf_dir).collect()))
    assert got == plain_alignment(documents)


def test_alignment_of_odd_rows(odd):
    made = alignment.with_pair_counts(alignment.aligned_tokens(odd, ONE, OTHER))
    assert made.columns == ["doc_id", "lang", "score", "tokens", "_hit", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    got = made.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest).collect()
    assert Counter(map(tuple, got)) == plain_alignment([(r.doc_id, r.text) for r in odd.collect()])
    assert alignment.with_pair_counts(alignment.aligned_tokens(odd.where("false"), ONE, OTHER)).collect() == []
    with pytest.raises(ValueError, match="groups"):
        alignment.aligned_tokens(odd.withColumn("groups", F.lit(1)), ONE, OTHER)


def test_fragments_compose_in_any_order(documents):
    with open(ONE, "rb") as f, open(OTHER, "rb") as g:
        aligner = alignment.Aligner(f.read(), g.read())
    text = "\n".join(t for _, t in documents[:30] if t and "▁" not in t)
    _, sources, (a, a_ends, b, b_ends), _, _ = aligner.tokens([text])
    rng = random.Random(2)

    def made():
        borders = sorted({0, len(sources[0]), *(rng.randrange(len(sources[0])) for _ in range(300))})
        for low, high in zip(borders, borders[1:]):
            i, j = np.searchsorted(a_ends, [low, high], "right")
            k, n = np.searchsorted(b_ends, [low, high], "right")
            yield aligner.described(low, (a[i:j], a_ends[i:j], b[k:n], b_ends[k:n]))

    def in_any_order(held):
        while len(held) > 1:
            i = rng.randrange(len(held) - 1)
            held[i : i + 2] = [aligner.composed(held[i], held[i + 1])]
        return held[0]

    *want, codes = next(aligner.whole_texts([text]))
    for x in (reduce(aligner.composed, made()), in_any_order(list(made())), in_any_order(list(made()))):
        *got, held = aligner.finished(x)
        assert got == want and sorted(held) == sorted(codes)
