"""Byte pair encoding, collocations and ranked search against the tokenizer library, brute force and SQL."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lotmill.llm import byte_pairs, collocations, queries, ranked_search
from tests.compare import differences, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    return byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def unpacked(ids):
    return np.frombuffer(ids, "<u4").tolist()


ALPHABET = "abé ñ  \n\t'ls12.!ß日本🙂tre ve"


def some_text(rnd, most):
    return "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, most)))


def test_encoding_equals_the_library(spark, ranks, library):
    rnd = random.Random(5)
    texts = [None, "", " ", "<|endoftext|> plain", "it's we'll", "   \r\n", "x" * 40_000, "ab" * 9_000 + " end", "ñandú 日本語 🙂🙂"]
    texts += [some_text(rnd, 120) for _ in range(300)]
    texts += texts[:3]
    rows = [(i % 290, t, "ids", 1, "decoded") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int, decoded string")
    found = byte_pairs.decode(byte_pairs.encode(docs, ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN).collect()
    got = Counter((r["doc_id"], r["n_tokens"], tuple(unpacked(r["ids"])), bytes(r["decoded"])) for r in found)
    want = Counter()
    for i, text, *_ in rows:
        ids = tuple(library.encode_ordinary(text or ""))
        want[(i, len(ids), ids, (text or "").encode())] += 1
    assert got == want


def test_encoding_of_an_empty_table(spark, ranks):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert byte_pairs.encode(docs, ranks, public_tokenizers.PATTERN).collect() == []


def test_byte_pair_query_over_whole_texts(spark, library):
    found = {r["doc_id"]: r for r in queries.op11_byte_pairs(spark, SMALL).collect()}
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SMALL}/documents.parquet'").fetchall()
    assert len(found) == len(rows)
    for doc, text in rows:
        ids = library.encode_ordinary(text)
        assert found[doc]["n_tokens"] == len(ids)
        assert found[doc]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[doc]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_every_prefix_has_its_own_last_token(ranks, library):
    encoder = byte_pairs.Encoder(ranks, public_tokenizers.PATTERN)
    for word in (" internationalisation", "ñandúes", "aaaaaaaaaaaa", "日本日本"):
        data = word.encode()
        table = encoder.table(data)
        for n in range(1, len(data) + 1):
            assert encoder.read(table, data[:n]) == encoder.merged(data[:n]) or data[:n] in ranks


def test_merges_out_of_rank_order_are_merged_not_undone():
    """'abc' has a lower rank than its part 'bc', 'xyz' cannot be merged from its bytes at all."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"xyz": 258, b"aab": 259, b"ab": 260}
    encoder = byte_pairs.Encoder(ranks, r"[a-z]+| ")
    library = tiktoken.Encoding("odd", pat_str=r"[a-z]+| ", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(3)
    for _ in range(2_000):
        text = "".join(rnd.choice("aabbccxyz ") for _ in range(rnd.randint(1, 14)))
        assert unpacked(encoder.encode(text)) == library.encode_ordinary(text)


def test_edits_are_exact_and_local(spark, ranks, library):
    rnd = random.Random(11)
    rows, want = [], {}
    for i in range(120):
        text, steps = some_text(rnd, 150), []
        now = text
        for _ in range(4):
            start = rnd.randint(0, len(now))
            stop = min(len(now), start + rnd.choice([0, 0, 1, 5, 30]))
            new = some_text(rnd, 8)
            steps.append((start, stop, new))
            now = now[:start] + new + now[stop:]
        rows.append((i, text, steps))
        want[i] = library.encode_ordinary(now)
    rows += [(900, None, [(5, 2, "ab")]), (901, "abc", None), (902, "abc", [(None, None, None), None]), (903, "ab", [(-3, 99, "z")])]
    want |= {900: library.encode_ordinary("ab"), 901: library.encode_ordinary("abc"), 902: library.encode_ordinary("abc"), 903: library.encode_ordinary("z")}
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,stop:int,new:string>>")
    found = byte_pairs.encode_edits(df, ranks, public_tokenizers.PATTERN).collect()
    assert {r["doc_id"]: unpacked(r["ids"]) for r in found} == want
    word = "".join(rnd.choice("abcdefghij") for _ in range(20_000))
    state = byte_pairs.EncodedText(byte_pairs.Encoder(ranks, public_tokenizers.PATTERN), word)
    state.replace(10_000, 10_001, "zz")
    assert state.filled < 500 and state.ids() == library.encode_ordinary(word[:10_000] + "zz" + word[10_001:])
    state.append("a")
    assert state.filled == 1


# ---- collocations ---------------------------------------------------------------------------


def brute_collocations(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang or "und"][tuple(words[i:i + m])] += 1
    out = set()
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if a >= f[p[i:i + m]]:
                        inside.add(p[i:i + m])
        scored = []
        for p, a in frequent.items():
            if p not in inside:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


@pytest.mark.parametrize("counts, top", [(64, 9), (1 << 16, 500)])
def test_collocations_against_brute_force(spark, counts, top):
    """64 pair counts make nearly every pair pass the filter, 65,536 nearly none that is rare: the same phrases."""
    rnd = random.Random(2)
    words = ["new", "York", "york", "city", "of", "of", "the", "Ñu", "日本", "a'b", "x"]
    rows = []
    for i in range(400):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ";", "\x0b"]) for _ in range(rnd.randint(0, 60)))
        rows.append((text, rnd.choice(["en", "en", "fr", None])))
    rows += [(None, "en"), ("", None), ("  .,;", "fr"), ("word " * 5_000, "en")] + rows[:40]
    docs = spark.createDataFrame([(t, lang, "x", 1, "y") for t, lang in rows], "text string, lang string, words string, f int, piece string")
    found = collocations.collocations(docs, least=20, top=top, counts=counts)
    assert {tuple(r) for r in found.collect()} == brute_collocations(rows, 20, top)


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_collocation_scores_beyond_64_bits(spark):
    """1000 * a * n passes 64 bits here; the quotient is exact."""
    from pyspark.sql import functions as F

    a, n, left, right = 3 * 10**12 + 1, 9 * 10**15 + 7, 3 * 10**12 + 5, 4 * 10**12 + 3
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    wide = [f"cast({c} AS decimal(19,0))" for c in "anlr"]
    assert row.select(F.expr(f"(1000 * {wide[0]} * {wide[1]}) div ({wide[2]} * {wide[3]})")).first()[0] == 1000 * a * n // (left * right)


# ---- ranked search --------------------------------------------------------------------------


def brute_search(docs, items, top):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    counted = [(doc, Counter(cut(t))) for doc, t in docs]
    n_docs, n_terms = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(cut(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc, c in counted:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        out += [(item, rank, doc if there else None, -score) for rank, (score, there, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("width, batch_terms, top", [(1, 200_000, 5), (4, 30, 7), (1024, 200_000, 50)])
def test_search_against_brute_force(spark, width, batch_terms, top):
    rnd = random.Random(width)
    words = [f"w{i}" for i in range(60)] + ["Ñu", "日本", "X9"]
    pick = lambda: words[min(int(rnd.expovariate(0.08)), len(words) - 1)]
    docs = [(i, rnd.choice([" ", "-", "."]).join(pick() for _ in range(rnd.randint(0, 80)))) for i in range(1500)]
    docs += [(7, docs[7][1])] * 3 + [(2000 + i, "w1 w2 w50 w51") for i in range(300)] + [(None, "w50 w51"), (3000, None), (3001, ""), (3002, "w3 " * 50_000)]
    rnd.shuffle(docs)
    items = [(i, " ".join(pick() for _ in range(rnd.randint(1, 12)))) for i in range(30)] + [(3, "w50 W51 w51"), (None, "w50"), (40, None), (41, "--"), (42, "unseen")]
    left = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], "doc_id long, text string, item int, rank int, terms string").repartition(7)
    right = spark.createDataFrame([(i, t, 1, "y") for i, t in items], "item_id long, text string, doc int, place string")
    found = ranked_search.search(left, right, top=top, width=width, batch_terms=batch_terms)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_search(docs, items, top)


def test_search_scores_few_documents_exactly():
    rnd = random.Random(4)
    sizes = np.array([rnd.randint(5, 60) for _ in range(20_000)])
    rows = np.repeat(np.arange(len(sizes)), 5)
    terms = np.concatenate([np.array(rnd.sample(range(300), 5)) for _ in sizes])
    items = [np.array(rnd.sample(range(300), 8)) for _ in range(20)]
    searcher = ranked_search.Searcher(items, np.array([rnd.randint(100, 4000) for _ in range(300)]), 20_000, int(sizes.sum()), 50, 1024)
    for low in range(0, len(sizes), 1000):
        part = (rows >= low) & (rows < low + 1000)
        searcher.add(list(range(low, low + 1000)), sizes[low:low + 1000], terms[part], np.ones(part.sum(), np.int64), rows[part] - low)
    assert searcher.exact < 0.02 * len(sizes) * len(items)


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ranked_search.search(none, items).collect() == []
    assert ranked_search.search(docs, items.limit(0)).collect() == []
    assert ranked_search.search(docs.where("doc_id > 1"), items).collect() == []


def test_sizes_beyond_64_bit_products():
    found = ranked_search.impacts(np.array([5]), np.array([2]), np.array([10**9]), 10**11, 10**15)
    assert found.tolist() == [5 * (2 * 10**9 // (2000 + 20 * (50 + 50 * 10**20 // 10**15)))]


@pytest.mark.parametrize("name", ["op12_collocations", "op13_ranked_search"])
def test_queries_equal_their_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), duck(SMALL), queries.ORACLES[name]) is None
