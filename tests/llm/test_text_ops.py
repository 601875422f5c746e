"""Text operators against plain loops, on a small table with awkward rows."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from trackloom.llm import bpe, decision_list, mixing, near_dedup, repeats, substring_dedup, suffix_dedup, wordpiece

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, part long, hash long, text_ string"


def words(text):
    return WORDS(text or "")


@pytest.fixture(scope="module")
def texts():
    """(id, text): nulls, empty and white texts, copies, near copies, shared passages, repeats, a long text without breaks."""
    draw = random.Random(5)
    some = [" ".join(draw.choice("abcdefgh") + draw.choice("xyzé") * draw.randint(0, 2) for _ in range(draw.randint(1, 140))) for _ in range(40)]
    passage = " ".join(f"p{i}" for i in range(60))
    out = list(enumerate(some))
    out += [(100, None), (101, ""), (102, " \t\n "), (103, "one"), (104, "One"), (105, "a b c d"), (None, some[3])]
    out += [(110 + i, some[i]) for i in range(6)] + [(120, some[7] + "  tail"), (121, some[8].upper())]
    out += [(130 + i, f"{some[i]} {passage}\n{some[i + 9]}") for i in range(5)] + [(140, passage), (141, passage + " " + passage)]
    out += [(150, "ab" * 3000), (151, "x" * 2000 + " y"), (152, "line one here\n" * 40), (153, "go " * 90), (39, some[39])]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{(i or 0) % 4}" if i != 5 else None, len(t or ""), 1, 2, "z") for i, t in texts]
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


def by_id(df):
    out = defaultdict(list)
    for row in df.collect():
        out[row["doc_id"]].append(row.asDict())
    return out


def empty(docs):
    return docs.where("doc_id = -1")


def test_bpe_equals_tiktoken(docs, texts):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(bpe.encode_texts(docs, with_ids=True))
    assert sum(map(len, got.values())) == len(texts)
    for i, text in texts:
        ids = own.encode_ordinary(text or "")
        want = np.array(ids, "<u4").tobytes()
        row = got[i][0]
        assert row["n_tokens"] == len(ids) and row["ids"] == want
        assert row["ids_sha256"] == hashlib.sha256(want).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode_texts(empty(docs)).count() == 0


def test_bpe_on_odd_characters():
    import public_tokenizers
    import tiktoken

    codec = bpe.codec("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    draw = random.Random(1)
    letters = "ab'sStve \n\t\r\x0b\x1c\x1f\x85\xa0​ 　﻿12é٣.,!漢😀́"
    for _ in range(2000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 14)))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == own.encode_ordinary(text)
    for text in ("a" * 20_000, "abc" * 7000, "漢" * 3000):
        assert codec.merge(text.encode()) == own.encode_ordinary(text)


def test_substring_dedup(docs, texts):
    seen, want = {}, {}
    for i, text in sorted(((i, t) for i, t in texts if i is not None), key=lambda x: x[0]):
        w = words(text)
        cut = [False] * len(w)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if seen.setdefault(key, (i, s)) < (i, s):
                cut[s : s + 20] = [True] * 20
        kept = [x for x, c in zip(w, cut) if not c]
        want[i] = len(w), sum(cut), hashlib.sha256(" ".join(kept).encode()).hexdigest()
    got = by_id(substring_dedup.remove_repeated_spans(docs, keep=docs.columns, with_text=True))
    assert sum(map(len, got.values())) == len(texts)
    for i, text in texts:
        if i is None:
            assert got[None][0]["n_removed"] == 0
            continue
        for row in got[i]:
            assert (row["n_words"], row["n_removed"], row["kept_sha256"]) == want[i]
            assert row["text"] == text or row["n_removed"]
            assert row["hash"] == 2 and row["part"] == 1 and row["text_"] == "z"
    assert substring_dedup.remove_repeated_spans(empty(docs)).count() == 0


@pytest.mark.parametrize("crowd", [repeats.CROWD, 1])
def test_byte_dedup(docs, texts, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    first, want = {}, {}
    for i, text in sorted(((i, t) for i, t in texts if i is not None), key=lambda x: x[0]):
        data = (text or "").encode()
        cut = bytearray(len(data))
        for s in range(len(data) - 49):
            if first.setdefault(data[s : s + 50], i) < i:
                cut[s : s + 50] = b"\1" * 50
        kept = bytes(x for x, c in zip(data, cut) if not c)
        want[i] = len(data), sum(cut), len(re.findall(b"\1+", cut)), hashlib.sha256(kept).hexdigest()
    got = by_id(suffix_dedup.remove_repeated_bytes(docs))
    assert sum(map(len, got.values())) == len(texts)
    for i, row in ((i, row) for i, rows in got.items() for row in rows):
        if i is not None:
            assert (row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) == want[i]
    assert suffix_dedup.remove_repeated_bytes(empty(docs)).count() == 0


def test_pieces_of_one_anchor_that_share_40_bits_of_hash(spark):
    pairs = [
        ("dsrohuswoeivxtturfzjnfqrqaagilgovncffqvehddtjghlhh", "nkqeewbewwpuhtturfzjnfqrqaagilgovncffidxywkegdyoew"),
        ("nmjuqfumnpsoitturfzjnfqrqaagilgovncffyrnzvpabdwher", "vvfuymnwmqtostturfzjnfqrqaagilgovncffhhywcwambhwdp"),
    ]
    rows = [(i, t) for i, t in enumerate(t for pair in pairs for t in pair)]
    data = np.frombuffer("".join(t for _i, t in rows).encode(), np.uint8)
    windows = repeats.Windows(suffix_dedup._byte_units, 50, 24, within=False)
    anchor, piece, _doc, _start, n = repeats.pieces(windows, *suffix_dedup._byte_units(data, np.arange(5) * 50))
    assert len(set(anchor.tolist())) == 1 and n.tolist() == [1] * 4
    assert len({p & (1 << 40) - 1 for p in piece.tolist()}) == 2 and len(set(piece.tolist())) == 4
    docs = spark.createDataFrame(rows + [(9, rows[0][1])], "doc_id long, text string")
    got = by_id(suffix_dedup.remove_repeated_bytes(docs))
    assert [got[i][0]["n_removed"] for i in (0, 1, 2, 3, 9)] == [0, 0, 0, 0, 50]


def test_suffix_array_and_prefixes():
    draw = random.Random(3)
    for _ in range(500):
        text = [draw.randint(1, 3) for _ in range(draw.randint(0, 40))] + [0]
        array = suffix_dedup.suffix_array(text, 4)
        assert array == sorted(range(len(text)), key=lambda i: text[i:])
        shared = suffix_dedup.permuted_prefixes(text, array)
        for a, b in zip(array, array[1:]):
            n = 0
            while text[a + n] == text[b + n]:
                n += 1
            assert shared[b] == n


def test_automaton_matching():
    draw = random.Random(4)
    for _ in range(200):
        added = [[draw.randint(0, 2) for _ in range(draw.randint(0, 12))] for _ in range(4)]
        automaton = substring_dedup.SuffixAutomaton()
        for sequence in added:
            automaton.add(sequence)
        runs = {tuple(s[i:j]) for s in added for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        query = [draw.randint(0, 2) for _ in range(15)]
        want = [max([n for n in range(1, e + 2) if tuple(query[e + 1 - n : e + 1]) in runs], default=0) for e in range(15)]
        assert automaton.matching(query) == want


def _sets(texts):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = {}
    for i, text in texts:
        w = words((text or "").translate(lower))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    return out


def test_near_dedup(docs, texts):
    sets = _sets(texts)
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = by_id(near_dedup.near_duplicates(docs))
    assert sum(map(len, got.values())) == len(texts)
    for i in ids:
        for row in got[i]:
            assert (row["n_shingles"], row["component_id"], row["kept"]) == (len(sets[i]), root(i), root(i) == i)
    assert got[None][0]["component_id"] is None and got[None][0]["kept"]
    assert near_dedup.near_duplicates(empty(docs)).count() == 0


def test_sketches_never_drop_links():
    draw = random.Random(9)
    for size in (20, 300, 3000):
        base = [f"w{draw.randint(0, 10**6)}" for _ in range(size)]
        other = base[: size - size // 8]  # about 7 of 8 shingles in common
        data = (" ".join(base) + " ".join(other)).encode()
        cut = len(" ".join(base))
        hashes, firsts = near_dedup.shingle_sets(np.frombuffer(data, np.uint8), np.array([0, cut, len(data)]))
        a, b = set(hashes[: firsts[1]].tolist()), set(hashes[firsts[1] :].tolist())
        assert len(a & b) / len(a | b) >= 0.75
        odd = near_dedup.odd_sketches(near_dedup._samples(hashes, firsts[:-1]))
        assert np.bitwise_count(odd[0] ^ odd[1]).sum() <= near_dedup.most_odd_bits()
        whole = near_dedup.set_sketches(hashes, firsts)
        assert np.bitwise_count(whole[0] ^ whole[1]).sum() <= len(a ^ b)


def test_sketches_lose_fewer_links_than_bands():
    samples, bits = near_dedup.BANDS * near_dedup.ROWS, near_dedup.SKETCH_BITS
    most, odd = near_dedup.most_odd_bits(), np.arange(bits + 1)
    chance, beyond = (odd == 0).astype(float), []
    for _ in range(samples + 1):  # each differing sample flips a bit in either sketch
        beyond.append(chance[most + 1 :].sum())
        for _ in range(2):
            up, down = chance * (bits - odd) / bits, chance * odd / bits
            chance = np.append(down[1:], 0) + np.append(0, up[:-1])
    lost = sum(math.comb(samples, d) * 0.25**d * 0.75 ** (samples - d) * p for d, p in enumerate(beyond))
    assert lost <= (1 - 0.75**near_dedup.ROWS) ** near_dedup.BANDS


def test_mixing(docs, texts, spark):
    made = mixing.mix_report(docs, block_words=8, shard_slots=16)
    got = [r.asDict() for r in made.collect()]
    assert len(got) == len(texts)
    sizes = defaultdict(int)
    for i, text in texts:
        sizes[None if i == 5 else f"s{(i or 0) % 4}"] += len(words(text))
    names = sorted((s for s in sizes if s), key=str.encode) + [None]
    goal = dict(zip(names, mixing.targets([(n, sizes[n]) for n in names], 1.5, (3, 1, 2), 2.0)))
    assert sum(goal.values()) == pytest.approx(min(1.5 * sum(sizes.values()), 2 * sum(sizes.values())))
    taken, text_of = Counter(), dict(texts)
    for r in got:
        name = None if r["doc_id"] == 5 else f"s{(r['doc_id'] or 0) % 4}"
        assert r["size"] == len(words(text_of[r["doc_id"]])) and r["source_size"] == sizes[name]
        assert r["target"] == pytest.approx(goal[name]) and r["taken"] <= 2 * r["size"]
        taken[name] += r["taken"]
    assert all(abs(taken[n] - goal[n]) <= 16 for n in names)
    again = mixing.mix_report(docs.repartition(3), block_words=8, shard_slots=16).collect()
    assert sorted((r["doc_id"] or -1, r["taken"]) for r in got) == sorted((r["doc_id"] or -1, r["taken"]) for r in again)
    assert mixing.mix_report(empty(docs)).count() == 0


def test_mixed_documents(docs):
    out = mixing.mixed_documents(docs.where("doc_id != 39"), block_words=8, shard_slots=16)
    assert out.columns == docs.columns
    counts = Counter()
    for row in out.collect():
        counts[row["doc_id"]] += len(words(row["text"]))
    report = mixing.mix_report(docs.where("doc_id != 39"), block_words=8, shard_slots=16)
    sizes = {r["doc_id"]: r["size"] for r in report.collect()}
    assert all(n <= 2 * sizes[i] for i, n in counts.items())


def test_targets_stop_and_share():
    assert mixing.targets([("a", 10), ("b", 1000), (None, 10)], 1.5, (3, 1, 2), 2.0) == [20.0, pytest.approx(1490.0), 20.0]
    assert mixing.targets([], 1.5, (3, 1, 2), 2.0) == [] and mixing.targets([("a", 0)], 1.5, (3,), 2.0) == [0.0]


def _statistics(text):
    w = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    three = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {k for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines), len(lines) - len(set(lines)), len(again)


def test_text_statistics(docs, texts):
    got = by_id(decision_list.text_statistics(docs))
    for i, text in texts:
        assert tuple(got[i][0][c] for c in decision_list.STATISTICS) == _statistics(text)


def test_decision_list_learns_and_keeps(spark):
    draw = random.Random(2)
    good = [" ".join(f"w{draw.randint(0, 900)}" for _ in range(80)) for _ in range(150)]
    bad = [" ".join(f"w{draw.randint(0, 900)} ###" for _ in range(60)) for _ in range(50)]
    rows = list(enumerate(good + bad)) + [(500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 200, 2)] + [(None, 1), (3, None)], "doc_id long, quality int")
    judged = by_id(decision_list.quality_verdicts(docs, labels))
    assert all(judged[i][0]["kept"] == (i < 150) for i in range(200))
    assert not judged[500][0]["kept"] and judged[501][0]["base_failed"]
    none = by_id(decision_list.quality_verdicts(docs, labels.where("doc_id = -1")))
    assert all(none[i][0]["kept"] for i in range(200))


def test_decision_list_rules_are_precise():
    draw = random.Random(8)
    rows = [dict.fromkeys(decision_list.FEATURES, 0.0) | {"bad": draw.random() < 0.3} for _ in range(600)]
    for row in rows:
        row["symbols_per_word"] = draw.random() + row["bad"]
        row["chars_per_word"] = draw.random()
    for rule in decision_list.learn(rows):
        bad, good = decision_list._counts(rule, rows)
        assert bad >= decision_list.LEAST_COVER and bad >= 0.9 * (bad + good)


def test_word_pieces_against_longest_match():
    draw = random.Random(6)

    def greedy(pieces, word):
        word, at, n = wordpiece.MARK + word, 0, 0
        while at < len(word):
            end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
            if end is None:
                return 0
            at, n = end, n + 1
        return n

    for _ in range(200):
        pieces = {draw.choice(["", wordpiece.MARK]) + "".join(draw.choice("ab") for _ in range(draw.randint(1, 4))) for _ in range(7)}
        count = wordpiece.PieceCounter(pieces)
        for _ in range(30):
            word = "".join(draw.choice("ab") for _ in range(draw.randint(1, 10)))
            assert count(word) == greedy(pieces, word)


def test_token_counts(docs, texts):
    got = by_id(wordpiece.token_counts(docs))
    count = wordpiece.counter("piece_bpe_32k.model")
    for i, text in texts:
        each = [count._pieces(w) for w in words(text)]
        row = got[i][0]
        assert (row["n_words"], row["n_unknown"]) == (len(each), each.count(0))
        assert row["n_tokens"] == sum(each) + each.count(0)
    assert wordpiece.token_counts(empty(docs)).count() == 0


def test_token_counts_over_the_whole_vocabulary(spark):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    kinds = (model.is_control, model.is_unknown, model.is_byte)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(kind(i) for kind in kinds)}

    def greedy(word):
        word, at, n = wordpiece.MARK + word, 0, 0
        while at < len(word):
            end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
            if end is None:
                return 0
            at, n = end, n + 1
        return n

    text = "ñandú ça ßen Índice 中国人民 日本 plain ▁a ▁▁▁ a▁b \u0378x " + "国" * 300
    want = [greedy(w) for w in words(text)]
    row = wordpiece.token_counts(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert want.count(0) == 1 and min(want[:6]) > 1 and want[-1] > 300
    assert (row["n_words"], row["n_tokens"], row["n_unknown"]) == (len(want), sum(want) + 1, 1)
