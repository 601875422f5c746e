"""Vectors, pages, placement, components, and the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from trackloom.llm import components, html_extract, queries, sharding, vector_dedup


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (139, 100), (200, 300)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 300: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(3)
    base = draw.standard_normal((120, 24))
    near = [base[i] + 0.05 * draw.standard_normal(24) for i in range(20)] + [base[0] + 0.1 * draw.standard_normal(24) for _ in range(60)]
    rows = [(i, v.tolist()) for i, v in enumerate([*base, *near])]
    rows += [(300 + i, base[5].tolist()) for i in range(30)] + [(400, (3 * base[5]).tolist())]
    rows += [(500, None), (501, []), (502, [0.0] * 24), (503, [1.0, None] * 12), (504, [float("nan")] * 24), (505, [float("inf")] * 24)]
    return rows + [(506, [1.0, 2.0]), (507, [1.0, 2.0]), (None, base[5].tolist()), (508, [1e-30] + [0.0] * 23)]


@pytest.mark.parametrize("block", [8, 256])
def test_near_vectors(spark, vectors, block):
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in vectors], "vec_id long, embedding array<double>, label int, key long")
    got = {r["vec_id"]: r for r in vector_dedup.near_vectors(df.repartition(4), block=block).collect()}
    good = {i: np.array(v) for i, v in vectors if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    parent, links = {i: i for i in good}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]):
                x, y = good[a] / np.linalg.norm(good[a]), good[b] / np.linalg.norm(good[b])
                if x @ y >= 0.9:
                    links[a] += 1
                    links[b] += 1
                    p, q = sorted((root(a), root(b)))
                    parent[q] = p
    assert sum(got[i]["n_links"] for i in good) >= 0.97 * sum(links.values())
    assert all(got[i]["n_links"] <= links[i] for i in good)
    assert sum(got[i]["component_id"] == root(i) for i in good) >= 0.97 * len(good)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _ in vectors if i not in good)
    assert vector_dedup.near_vectors(df.where("vec_id = -1")).count() == 0


def test_projections_meet_as_planned():
    draw = np.random.default_rng(1)
    hashes, tables = vector_dedup.plan(10_000)
    x = vector_dedup._unit(draw.standard_normal((400, 48)))
    aside = draw.standard_normal((400, 48))
    aside = vector_dedup._unit(aside - (aside * x).sum(1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * aside
    same = vector_dedup.bucket_keys(x, hashes, tables) == vector_dedup.bucket_keys(y, hashes, tables)
    assert same.any(axis=1).mean() >= 0.93


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body class='has-sidebar'>"
    "<nav><ul><li><a href=/x>menu one</a></li></ul></nav><header><p>site head</p></header><!-- <p>gone</p> -->"
    "<div class='cookie-notice'>we use cookies</div><article><header><h1>Title &amp; more&lt;</h1></header>"
    "<p><b>First\n  line<br><p>sec<i>ond</i>&nbsp;part<div class=\"ad\">buy <p>now</div><p>third a < b"
    "<aside>side</aside><form><p>mail</p></form><section id=comments><p>reader says</p></section></article>"
    "<div class='sidebar'>links</div><footer>foot &copy;</footer></body></html>"
)


def test_pages_with_marks(spark):
    rows = [(1, "https://h.example/a", PAGE), (2, "https://h.example/a", PAGE), (3, None, None), (4, "odd", ""), (None, "https://h.example/b", "<p>only</p>")]
    rows += [(5, "https://h.example/c", PAGE[: PAGE.index("third") + 5]), (6, "https://h.example/d", "<article>" + "w " * 50_000 + "</article>")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, _k int, text string")
    got = {r["page_id"]: r for r in html_extract.extract(df).collect()}
    text = "Title & more< First line second part third a < b"
    assert got[1]["text"] == got[2]["text"] == text and got[1]["n_chars"] == len(text)
    assert got[3]["text"] == got[4]["text"] == "" and got[None]["text"] == "only"
    assert got[5]["text"] == "Title & more< First line second part third"
    assert got[6]["n_chars"] == 99_999
    assert html_extract.extract(df.where("page_id = -1")).count() == 0


def test_unmarked_pages_lose_what_their_host_repeats(spark):
    draw = random.Random(4)
    own = [" ".join(f"w{draw.randint(0, 10**6)}" for _ in range(30)) for _ in range(12)]
    rows = [(i, f"http://Host.example/{i}", f"<div>Home About Contact us today now</div><p>{t}</p><div>Top</div>") for i, t in enumerate(own)]
    rows.append((50, "http://other.example/", f"<div>Home About Contact us today now</div><p>{own[0]}</p>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert all(got[i] == t for i, t in enumerate(own))
    assert got[50] == "Home About Contact us today now " + own[0]
    again = {r["page_id"]: r["text"] for r in html_extract.extract(df, group_pages=6).collect()}
    assert again.keys() == got.keys()


def test_marks_do_not_cost_a_page_its_other_blocks(spark):
    made = [
        ("<h1 class='entry-title'>Title</h1><div>first part</div><div>second part</div>", "Title first part second part"),
        ("<div>before</div><p class='post-meta'>by me</p><div>the text</div>", "before by me the text"),
        ("<div class='content has-sidebar'><p>kept</p></div>", "kept"),
        ("<div class='post related-open'><p>kept</p></div>", "kept"),
        ("<div id='layout-with-sidebar' class='no-comments'><p>kept</p></div>", "kept"),
        ("<article><p>one</p><section class='alert alert-info'>two</section><p>three</p></article>", "one two three"),
        ("<article><p>one</p><div class='related'>gone</div></article><div class='sidebar'>gone</div><div>tail</div>", "one tail"),
    ]
    rows = [(i, f"https://h{i}.example/", f"<body>{page}</body>") for i, (page, _text) in enumerate(made)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: text for i, (_page, text) in enumerate(made)}
    # pages of one id and url keep their own blocks, and count as one page
    rows = [(1, "https://h.example/", f"<p>{'same words on each of them ' * n}own{n}</p>") for n in (1, 2, 3)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r["text"] for r in got) == sorted("same words on each of them " * n + f"own{n}" for n in (1, 2, 3))


@pytest.mark.parametrize("group_pages", [2, 7, 1000])
def test_boilerplate_is_found_over_all_pages_of_a_host(spark, group_pages):
    draw = random.Random(8)
    own = [" ".join(f"w{draw.randint(0, 10**6)}" for _ in range(20)) for _ in range(60)]
    few = {11: "<div>seen on three pages of many</div>", 31: "<div>seen on three pages of many</div>", 51: "<p>Top</p><p>seen on three pages of many</p>"}
    two = {5: "<div>but this is on two only</div>", 45: "<div>but this is on two only</div>"}
    rows = [(i, f"https://big.example/{i}", f"{few.get(i, '')}<p>{t}</p>{two.get(i, '')}") for i, t in enumerate(own)]
    want = {i: t + (" but this is on two only" if i in two else "") for i, t in enumerate(own)}
    want[51] = "Top " + own[51]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), group_pages=group_pages)
    assert {r["page_id"]: r["text"] for r in got.collect()} == want


def test_runs_against_a_loop():
    draw = random.Random(12)
    for _ in range(150):
        streams = [[[draw.choice("abc") for _ in range(draw.randint(1, 7))] for _ in range(draw.randint(0, 4))] for _ in range(6)]
        owners = [0, 1, 2, 2, 3, 4]
        pages = {}

        def windows(block):
            return [(s, tuple([*block, "|"][s : s + 5])) for s in range(len(block))]

        for owner, page in zip(owners, streams):
            for block in page:
                for _s, window in windows(block):
                    pages.setdefault(window, set()).add(owner)
        runs = html_extract.Runs(streams, owners)
        cover = runs.covered([n >= 3 for *_, n in runs.found])
        for page, found in zip(streams, cover):
            for block, inside in zip(page, found):
                cut = [False] * (len(block) + 1)
                for s, window in windows(block):
                    if len(pages[window]) >= 3 and (len(window) == 5 or s == 0):
                        cut[s : s + len(window)] = [True] * len(window)
                assert inside.tolist() == cut[:-1]


def test_lookup_table_is_even_and_steady():
    names = [f"n{i}" for i in range(20)]
    table = sharding.lookup_table(names, 2039)
    shares = Counter(table)
    assert max(shares.values()) - min(shares.values()) <= 1 and set(table) == set(range(20))
    less = sharding.lookup_table(names[:-1], 2039)
    moved = sum(a != b for a, b in zip(table, less) if a != 19)
    assert moved <= 0.15 * 2039
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 2040)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "a"], 2039)


def test_placement(spark):
    names = [f"n{i}" for i in range(5)]
    rows = [(i, "t") for i in range(50)] + [(None, "t"), (7, "u")]
    got = sharding.place(spark.createDataFrame(rows, "doc_id long, shard string"), "doc_id", names, 101).collect()
    table = sharding.lookup_table(names, 101)
    assert len(got) == len(rows)
    for row in got:
        text = "" if row["doc_id"] is None else str(row["doc_id"])
        slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 101
        assert (row["slot"], row["shard"]) == (slot, names[table[slot]])


def test_queries_are_registered():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert queries.oracle_sql().keys() <= set(names)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(7)
    own = [" ".join(f"w{draw.randint(0, 4000)}" for _ in range(draw.randint(60, 200))) for _ in range(30)]
    passage = " ".join(f"q{i}" for i in range(70))
    rows = [(i, t) for i, t in enumerate(own)] + [(100, own[0]), (101, own[1] + " end"), (102, None), (103, "short")]
    rows += [(104, own[2][:200] + " " + passage), (105, own[5][:240] + "\n" + passage), (106, "### " * 100)]
    documents = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (_name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append([r.asDict() for r in docs.collect()])
        assert k == 4 or docs.columns == columns
    ids = [{r["doc_id"] for r in rows} for rows in kept]
    assert ids[0] == set(range(30)) | {100, 101, 104, 105}
    assert ids[1] == set(range(30)) | {104, 105}
    texts = {r["doc_id"]: r["text"] for r in kept[2]}
    assert passage in texts[104] and "q30" not in texts[105] and texts[3] == own[3]
    assert all(r["n_chars"] == len(r["text"]) for r in kept[2] + kept[3])
    assert [r["doc_id"] for r in kept[4]] and all(r["n_tokens"] > 0 for r in kept[4])
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r["ids_sha256"] for r in done.collect()) == sorted(r["ids_sha256"] for r in kept[4])
