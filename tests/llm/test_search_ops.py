"""Ranked search, spelling variants and exact duplicates against plain loops, and registered queries against their SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from comparison import compare, connect

from trackloom.llm import exact_dedup, queries, ranked_search, spelling

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, term string, n long, row long, run long, word string, item int, rank int"
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, "w", 4, 5) for i, t in rows], COLUMNS)


@pytest.fixture(scope="module")
def texts():
    """(id, text): nulls, empty and white texts, copies that white space tells apart, repeated rows, a hot text, a long one."""
    draw = random.Random(11)
    stems = ["the", "of", "Running", "runing", "walked", "wälked", "tokens", "tokenizer", "tokeniser", "ÀÉÿ", "7x", "b2b"]
    stems += ["".join(draw.choice("abcdeé") for _ in range(draw.randint(6, 10))) for _ in range(60)]
    some = [" ".join(draw.choice(stems) for _ in range(draw.randint(1, 70))) for _ in range(150)]
    out = list(enumerate(some))
    out += [(200, None), (201, ""), (202, " \t\n\x0b\x0c\r "), (203, "\u00a0"), (204, "-- __ ;"), (None, some[4]), (None, None), (None, "only")]
    out += [(300 + i, some[i].replace(" ", "  ")) for i in range(9)] + [(290 - i, some[i].replace(" ", "\n")) for i in range(5)]
    out += [(400 + i, "the hot text of tokens") for i in range(90)] + [(7, some[7]), (7, some[7]), (500, "tokens " * 30_000)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts).repartition(7)


def by_loop_exact(rows):
    groups = defaultdict(list)
    for place, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, place))
    out = []
    for normal, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        sha = hashlib.sha256(normal.encode()).hexdigest()
        out += [(None if m[1] else m[2], keep, len(members), m == best, sha) for m in members]
    return Counter(out)


@pytest.mark.parametrize("bits, run_rows", [(4, 200_000), (1, 5), (2, 17)])
def test_exact_duplicates(docs, texts, bits, run_rows):
    got = exact_dedup.exact_duplicates(docs, bits=bits, run_rows=run_rows)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == by_loop_exact(texts)
    assert exact_dedup.exact_duplicates(docs.where("doc_id = -1")).count() == 0


def test_merged_runs_verify_beyond_the_first_word():
    def entries(*rows):
        out = np.zeros(len(rows), exact_dedup.ENTRY)
        for place, (digest, length, chars, ident) in enumerate(rows):
            out[place] = (digest, length, chars, 0, ident, ident, 1)
        return exact_dedup.merge([out])

    a = entries(((1, 2, 3, 4), 9, 10, 5), ((1, 2, 3, 4), 9, 12, 8), ((1, 2, 3, 5), 9, 12, 1))
    b = entries(((1, 2, 3, 4), 8, 99, 2), ((1, 2, 3, 4), 9, 12, 7), ((2**64 - 1, 0, 0, 0), 9, 1, 3))
    got = [(r["digest"].tolist(), r["length"].item(), r["id"].item(), r["n"].item()) for r in exact_dedup.merge([a, b])]
    assert got == [([1, 2, 3, 4], 8, 2, 1), ([1, 2, 3, 4], 9, 7, 3), ([1, 2, 3, 5], 9, 1, 1), ([2**64 - 1, 0, 0, 0], 9, 3, 1)]


def by_loop_spelling(rows, least_count=2, times=10, typo=31):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % typo == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= least_count}

    def one_apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v.encode()), default=None)
        form[w] = best if best and n[best] >= times * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("times, typo", [(10, 31), (2, 3)])
def test_spelling_variants(docs, texts, times, typo):
    got = spelling.spelling_variants(docs, times=times, typo=typo)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == by_loop_spelling(texts, times=times, typo=typo)
    assert spelling.spelling_variants(docs.where("doc_id = -1")).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs, least_length=3)


def test_near_words_of_a_dense_vocabulary(spark):
    """Words over two letters have the most neighbours, repeated bigrams and ties of ranks."""
    draw = random.Random(2)
    words = {"".join(draw.choice("ab") for _ in range(draw.randint(4, 9))) for _ in range(500)} | {"aaaaaaa", "aaaaaaaa", "abababa"}
    df = spark.createDataFrame([(w, 2 + k) for k, w in enumerate(sorted(words))], "word string, n long").repartition(3)
    pairs = [(r["word"], r["near"]) for r in spelling.near_words(df).collect()]
    want = set()
    for w in words:
        edits = {w[:k] + w[k + 1 :] for k in range(len(w))} | {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in "ab"}
        edits |= {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in "ab"}
        want |= {(w, v) for v in edits & words if v != w}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_pivots_are_the_cheapest_disjoint_pair():
    draw = random.Random(6)
    for _ in range(300):
        word = "".join(draw.choice("abc") for _ in range(draw.randint(4, 12)))
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)}, key=lambda g: draw.random())
        ranks = {g: (k, draw.randint(1, 9)) for k, g in enumerate(grams)}
        prefix = spelling.prefix_of(word, ranks)
        cost = {i: ranks[word[i : i + 2]][1] for i in prefix}
        a, b = spelling.pivots_of(word, prefix, ranks)
        assert b - a >= 2 and cost[a] + cost[b] == min(cost[i] + cost[j] for i in prefix for j in prefix if j - i >= 2)


def test_roots_follow_long_chains(spark, rows_of):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)], "word string, form string")
    assert rows_of(spelling.roots(chain, 2**14, 2)) == sorted((f"w{i}", "w13") for i in range(13))


def by_loop_search(rows, items, top):
    split = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    counted = [(i, Counter(split((t or "").translate(LOWER)))) for i, t in rows]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    N, L, df = len(counted), sum(n for _, _, n in counted), Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(split((text or "").translate(LOWER))), []
        for i, c, n in counted:
            m = 75 + (25 * n * N) // L
            score = 0
            for term, times in asked.items():
                if c[term]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1000000000 * c[term]) // (1000 * c[term] + 12 * m))
            if score:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("top, shard_docs, item_bytes", [(20, 8192, 8_000_000), (3, 16, 60), (20, 64, 8_000_000)])
def test_ranked_search(spark, docs, texts, top, shard_docs, item_bytes):
    items = [(i, t) for i, t in texts if i is not None and i % 9 == 0] + [(600, "the of tokens tokens"), (601, None), (602, "none such")]
    df = table(spark, [*items, items[0]])
    got = ranked_search.ranked_search(
        docs, df, item_id_column="doc_id", top=top, shard_docs=shard_docs, item_bytes=item_bytes
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == by_loop_search(texts, items, top)


def test_ranked_search_without_rows(docs):
    none = docs.where("doc_id = -1")
    for a, b in ((none, docs.limit(3)), (docs, none)):
        assert ranked_search.ranked_search(a, b, item_id_column="doc_id").count() == 0


def test_bounds_skip_most_documents_and_hold():
    """Summaries bound every score of their blocks, and most documents of a clustered list are never scored."""
    import pyarrow as pa

    draw = random.Random(3)
    topics = [[f"t{k}w{j}" for j in range(12)] for k in range(30)]
    made = [[draw.choice(topics[k % 30]) for _ in range(20)] + ["common"] for k in range(3000)]
    items = ranked_search.Items([" ".join(topics[k][:6] + ["common"]).encode() for k in range(30)])
    rows, df = [], Counter()
    for i, words in enumerate(made):
        counted = {items.number[w.encode()]: n for w, n in Counter(words).items() if w.encode() in items.number}
        df.update(counted.keys())
        rows.append((i, len(words), list(counted), list(counted.values())))
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "n", "terms", "tfs"])
    shard = ranked_search.Shard([batch], 3000, 21 * 3000, items)
    weighted = items.weighted({t: ranked_search.weight(3000, n) for t, n in df.items()})
    scored = 0
    for terms, weights in weighted:
        best = ranked_search.Best(20, 1)
        scored += ranked_search.search_shard(shard, terms, weights, best)
        dense = np.zeros(len(shard.most), np.int64)
        dense[terms] = weights
        every = np.array([(shard.impacts[a:b] * dense[shard.terms[a:b]]).sum() for a, b in zip(shard.starts, shard.ends)])
        assert best.score.tolist() == sorted(every.tolist(), reverse=True)[:20]
        for term in terms.tolist():
            members, ends, summary = shard.blocks(term)
            bounds = summary[:, np.searchsorted(items.coordinates[term], terms)].astype(np.int64) @ weights
            assert all(every[members[a:b]].max() <= bound for a, b, bound in zip(ends, ends[1:], bounds))
    assert scored < 0.2 * 30 * 3000


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_spelling", "op13_exact_dedup", "op1_substring_dedup", "op4_suffix_dedup"])
def test_registered_queries_equal_their_sql(spark, name):
    ok, message = compare(spark, connect(SMALL), SMALL, name, queries.queries()[name], queries.oracle_sql()[name])
    assert ok, message
