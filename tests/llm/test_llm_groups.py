import random
import time

import fixtures_llm as fx
import numpy as np
import pytest
from pyspark.sql import functions as F

from skillgrid.llm import components, hilbert, jaccard, language, toxicity, url_templates


# --- Jaccard join

def result(spark, rows, **options):
    return jaccard.near_duplicates(fx.table(spark, rows), **options).collect()


def compare(spark, rows):
    sets = {i: fx.word_grams(text) for i, text in rows}
    want = fx.components_of(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, rows)}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def edited(text, seed, n):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_components_are_those_of_all_pairs(spark):
    rows = [(i, fx.prose(i, 20 + 13 * i)) for i in range(12)]
    rows += [(100 + i, edited(fx.prose(5, 200), i, i % 6)) for i in range(40)]  # near copies around the threshold
    rows += [(200 + i, fx.prose(77, 30) + " " + fx.prose(300 + i, 60)) for i in range(15)]  # a shared passage
    rows += [(300 + i, fx.prose(6, 200)) for i in range(30)]  # copies
    chain = fx.prose(9, 120)
    for i in range(10):  # each like the one before, not like the first
        rows.append((400 + i, chain))
        chain = edited(chain, 900 + i, 1)
    compare(spark, rows)


def test_full_join_alone_and_stars_agree(spark, monkeypatch):
    rows = [(i, edited(fx.prose(5, 150), i, i % 5)) for i in range(40)]
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    compare(spark, rows)


def test_shuffle_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 1)
    compare(spark, [(i, edited(fx.prose(5, 150), i, i % 4)) for i in range(20)])


def test_texts_move_for_about_similar_sets_alone(spark, monkeypatch):
    """Texts that share most of a passage are candidates; their signatures tell them apart before texts move."""
    rows = [(i, fx.prose(i, 200)) for i in range(40)]
    rows += [(100 + i, " ".join(text.split()[:150]) + " " + fx.prose(900 + i, 50)) for i, text in rows[:30]]  # similarity 0.6
    rows += [(200 + i, edited(text, i, 2)) for i, text in rows[30:40]]
    monkeypatch.setattr(jaccard, "BUCKET_BITS", 6)  # a full sketch, as that of a large corpus: shared n-grams are no less rare
    moved, verified = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *rest: moved.append(pairs.count()) or verified(pairs, *rest))
    compare(spark, rows)
    assert 10 <= sum(moved) <= 15


def test_signatures_never_overstate_a_difference():
    rng = np.random.default_rng(3)
    for n, m, both in [(1, 1, 0), (1, 1, 1), (20, 24, 19), (31, 33, 30), (500, 520, 0), (500, 600, 450), (3000, 100, 90), (40_000, 41_000, 36_000)]:
        z = np.unique(rng.integers(0, 1 << 63, 2 * (n + m), dtype=np.uint64))
        rng.shuffle(z)
        a, b = np.sort(z[:n]), np.sort(z[n - both : n - both + m])
        apart, least = len(np.setxor1d(a, b)), jaccard.least_difference(jaccard.signature(a), jaccard.signature(b))
        assert least == jaccard.least_difference(jaccard.signature(b), jaccard.signature(a)) <= apart
        assert jaccard.least_difference(jaccard.signature(a), jaccard.signature(a)) == 0
        assert least >= min(apart, 0.3 * (n + m)) * 0.6 or n > 2 * m


def test_full_join_of_groups_that_lie_in_few_components(spark, monkeypatch):
    """Shared passages of linked and lone texts of many sizes, with stars, without and after one round."""
    shared = fx.prose(77, 60)
    rows = [(i, shared + " " + edited(fx.prose(8, 20), i, i % 3)) for i in range(25)]
    rows += [(100 + i, shared + " " + fx.prose(500 + i, 5 * i)) for i in range(12)] + [(200 + i, fx.prose(600 + i % 3, 9) + f" t{i}") for i in range(9)]
    for rounds in (0, 1, 2):
        monkeypatch.setattr(jaccard, "ROUNDS", rounds)
        compare(spark, rows)


def test_jaccard_of_hard_rows(spark):
    got = result(spark, fx.hard_texts())
    assert len(got) == len(fx.hard_texts())
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert found[1] == found[2] == found[3] == (57, 1) and found[12][1] == 1
    assert found[4] == (0, 4) and found[5] == (0, 5) and found[6] == (0, 6) and found[7] == (1, 7)
    assert found[None][1] is None and found[9] == (1, 9) and found[13] == (1, 13)
    assert result(spark, []) == []


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = fx.prose(3, 3000).encode() + b" " + b"y" * 5000 + b" end of it"
    whole = jaccard.word_hashes(text)
    monkeypatch.setattr(jaccard, "BLOCK", 1000)
    parts = jaccard.word_hashes(text)
    assert len(whole) == len(parts) == 3004 and (whole[:3000] == parts[:3000]).all() and whole[-1] == parts[-1]


def test_word_hashes_tell_words_apart():
    words = sorted({fx.prose(i, 1, 10**9) for i in range(3000)} | {f"{a}{b}" for a in "abcdefgh" for b in "abcdefgh"})
    assert len(set(jaccard.word_hashes(" ".join(words).encode()).tolist())) == len(words)
    assert (jaccard.word_hashes(b"Ab  c\x0b\xc3\x84") == jaccard.word_hashes(b"aB\tC \xc3\x84")).all()


def test_components_of_links(spark):
    links = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (4, 1), (5, 5)] + [(100, i) for i in range(101, 140)]
    frame = spark.createDataFrame(links, "x bigint, y bigint")
    got = {r.node: r.component for r in components.components(frame).collect()}
    assert got == {**{i: 1 for i in (1, 2, 3, 4)}, **{i: 7 for i in (7, 8, 9)}, **{i: 100 for i in range(100, 140)}}


# --- neighbours

def vectors(spark, rows):
    return fx.table(spark, rows, "vec_id bigint, embedding array<float>")


def test_neighbours_of_hard_vectors(spark):
    rows = [(i, [float(i % 4), 1.0]) for i in range(12)] + [(20, None), (21, [0.0, 0.0]), (22, [1.0, None]), (23, [float("nan"), 1.0]), (24, [float("inf"), 1.0]), (25, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (3, [3.0, 1.0])]
    got = hilbert.nearest(vectors(spark, rows), F.col("vec_id") % 4 == 0, k=3).collect()
    lists = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        lists.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert lists == {0: [(4, 0.0), (8, 0.0), (1, 1.0)], 4: [(0, 0.0), (8, 0.0), (1, 1.0)], 8: [(0, 0.0), (4, 0.0), (1, 1.0)]}
    assert hilbert.nearest(vectors(spark, rows[:1]), F.lit(True)).collect() == []
    assert hilbert.nearest(vectors(spark, []), F.lit(True)).collect() == []


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(1200, 16)), np.repeat(rng.normal(size=(1, 16)), 400, axis=0)]).astype(np.float32)
    got = hilbert.nearest(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]), F.col("vec_id") % 40 == 0).collect()
    lists = {}
    for r in got:
        lists.setdefault(r.query_id, {})[r.vec_id] = r.score
    found = 0
    for q in range(0, len(x), 40):
        far = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(x)), far)) if i != q][:10]
        found += len(set(order) & set(lists[q]))
        assert len(lists[q]) == 10 and all(abs(far[i] - s) < 1e-12 for i, s in lists[q].items())
        if q >= 1200:  # equal vectors: exactly the smallest ids
            assert set(order) == set(lists[q])
    assert found >= 0.9 * 10 * len(range(0, len(x), 40))


def test_hilbert_keys_walk_the_whole_square():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = hilbert.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# --- urls

def test_urls_and_rules(spark):
    rows = [
        (1, "https://A.Example.COM/en/1?x#y"), (2, "http://www.example.com/en/2"), (3, "http://b.net/es/3"), (4, "http://b.net"), (5, None),
        (6, "no scheme"), (7, "x://h?q/en/"), (8, "http://com/"), (9, "http://telecom/en/"), (10, "ftp://example.com://en/"), (1, "https://A.Example.COM/en/1?x#y"), (None, "http://ex\nample.com/en/"),
    ]
    got = url_templates.judge_urls(fx.table(spark, rows, "page_id bigint, url string")).collect()
    assert len(got) == len(rows)
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert found[1] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert found[2] == ("www.example.com", "/en/2", "www.example.com/en/", "allow")
    assert found[3] == ("b.net", "/es/3", "net/es/", "block") and found[4][:3] == ("b.net", "", None)
    assert found[5] == ("", "", None, "allow") == found[6] and found[7][:3] == ("h", "", None)
    assert found[8][2:] == ("com/", "allow") and found[9][2] is None and found[10][:2] == ("example.com:", "//en/")
    assert url_templates.judge_urls(fx.table(spark, [], "page_id bigint, url string")).count() == 0


def test_templates_of_blocked_pages_are_rejected(spark):
    rules = (("a.org", "/bad/", "block"), ("a.org", "/good/", "allow"))
    rows = [(i, f"http://a.org/bad/{i}") for i in range(60)] + [(100 + i, f"http://a.org/good/{i}.html") for i in range(60)]
    rows += [(200, "http://a.org//bad/7"), (201, "http://a.org/other/5"), (202, "http://b.org/bad/1")]
    found = {r.page_id: r for r in url_templates.judge_urls(fx.table(spark, rows, "page_id bigint, url string"), rules=rules).collect()}
    assert found[5].template == "/bad/{number}" and found[100].template == "/good/{number}.html"
    assert found[200].verdict == "block" and found[200].rule is None  # no rule fits, its template is a blocked one
    assert found[201].verdict == found[202].verdict == "allow"


def test_values_that_hardly_repeat_become_wildcards(spark):
    names = [f"{a}{b}" for a in "abcdefg" for b in "hijklmn"]
    rows = [(i, f"http://h.org/user/{n}/{i}") for i, n in enumerate(names)] + [(900, "http://h.org/about/us")]
    found = {r.page_id: r.template for r in url_templates.judge_urls(fx.table(spark, rows, "page_id bigint, url string")).collect()}
    assert found[0] == "/user/{value}/{number}" and found[900] == "/about/us"


def test_branches_part_at_any_depth(spark):
    rules = (("a.org", "/2024/05/01/x/y/spam/", "block"),)
    rows = [(i, f"http://a.org/2024/05/01/x/y/spam/{i}") for i in range(60)] + [(100 + i, f"http://a.org/2024/05/01/x/y/news/{i}") for i in range(20)]
    rows += [(200, "http://a.org//2024/05/01/x/y/spam/7"), (201, "http://a.org/2024/05"), (202, "http://a.org")]
    found = {r.page_id: r for r in url_templates.judge_urls(fx.table(spark, rows, "page_id bigint, url string"), rules=rules).collect()}
    assert len(found) == len(rows) and found[202].template == ""
    assert found[0].template == "/{number}/{number}/{number}/x/y/spam/{number}" and found[201].template == "/{number}/{number}"
    assert found[200].verdict == "block" and {found[100 + i].verdict for i in range(20)} == {"allow"}


def test_alike_branches_of_several_shapes_merge(spark):
    pages = lambda host, name, numbers, files: [f"http://{host}/{name}/{i}" for i in range(numbers)] + [f"http://{host}/{name}/{i}.html" for i in range(files)]
    urls = pages("a.org", "news", 51, 9) + pages("a.org", "blog", 40, 8) + pages("a.org", "docs", 5, 45) + pages("a.org", "faq", 4, 50) + pages("a.org", "spam", 50, 9)
    urls += pages("a.org", "one", 1, 0)
    urls += [f"http://b.org/{name}" for name in ("x.html", "y.html", "z.pdf") for _ in range(9)]
    rules = (("a.org", "/spam/", "block"),)
    got = url_templates.judge_urls(fx.table(spark, list(enumerate(urls)), "page_id bigint, url string"), rules=rules).collect()
    name = {(r.host, r.path.split("/")[1]): r.template.split("/")[1] for r in got}
    assert len(got) == len(urls)
    assert name["a.org", "news"] == name["a.org", "blog"] == "{branch:news}" and name["a.org", "docs"] == name["a.org", "faq"] == "{branch:faq}"
    assert name["a.org", "spam"] == "spam"  # shapes as news has, but blocked
    assert name["b.org", "x.html"] == name["b.org", "y.html"] == "{branch:y.html}" and name["b.org", "z.pdf"] == "z.pdf"


def test_purity_is_that_of_labelled_pages(spark):
    rules = (("a.org", "/u/bad", "block"),)
    # One template of variable names: 30 labelled pages, all blocked, and 60 that no rule decides.
    names = [f"bad{a}{b}" for a in "abcdef" for b in "ghijk"] + [f"{a}{b}{c}" for a in "mno" for b in "abcd" for c in "vwxyz"]
    urls = [f"http://a.org/u/{x}" for x in names] + ["http://a.org/about/me", "http://b.org/u/badag"]
    found = {r.path if r.host == "a.org" else r.host: r for r in url_templates.judge_urls(fx.table(spark, list(enumerate(urls)), "page_id bigint, url string"), rules=rules).collect()}
    assert found["/u/badag"].template == found["/u/mav"].template == "/u/{value}" and found["/u/mav"].purity == 1.0
    assert found["/u/mav"].rule is None and found["/u/mav"].verdict == "block"
    assert found["/about/me"].verdict == found["b.org"].verdict == "allow"


def test_long_paths_and_literal_braces(spark):
    trap = "http://a.org/" + "/".join(f"s{'x' * (i % 7)}" for i in range(2000))
    urls = [trap, trap + "/end", *[f"http://h{i % 9}.org/a/{i}.html" for i in range(1000)], "http://c.org/{number}/1", "http://c.org/2/1"]
    start = time.time()
    found = {r.page_id: r for r in url_templates.judge_urls(fx.table(spark, list(enumerate(urls)), "page_id bigint, url string"), rules=()).collect()}
    assert time.time() - start < 60 and len(found) == len(urls)
    assert found[0].template.count("/") == 2000 and found[1].template == found[0].template + "/end"
    assert found[2].template == "/a/{number}.html"
    assert found[1002].template == "/%7Bnumber%7D/{number}" and found[1003].template == "/{number}/{number}"


# --- classifiers

def sentences(words, n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(8, 40))) for _ in range(n)]


LATIN = {"aa": ["the", "and", "with", "thing", "over"], "bb": ["une", "avec", "était", "çela", "pour"]}


def test_languages_are_told_apart(spark):
    rows = [(i, t, lang) for lang, words in LATIN.items() for i, t in enumerate(sentences(words, 80, lang), 100 * (lang == "bb"))]
    rows += [(900, "12 34 !", "aa"), (901, None, "aa"), (902, "", None), (903, "сталин пошёл домой вчера вечером", None), (None, rows[0][1], None)]
    docs = fx.table(spark, rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs, allowed=F.col("doc_id") % 5 != 0)
    got = {r.doc_id: (r._lang.lang, r._lang.score, r._lang.rejected) for r in language.detect(docs, model).select("doc_id", "_lang").collect()}
    assert all(got[i][0] == lang for i, _, lang in rows[:160]) and not any(got[i][2] for i, _, _ in rows[:160])
    assert got[900] == got[901] == got[902] == ("und", 0.0, True)
    assert got[903][2] and got[903][0] in LATIN and got[None][0] == "aa"
    assert all(0 <= s <= 1 for _, s, _ in got.values())
    assert sorted(language.detect(docs, model).columns) == sorted({*docs.columns, "_lang"})


def test_every_language_is_learned_and_blocks_agree(spark, monkeypatch):
    """More labels than fit one block of centroids, more than any cap of old."""
    rng = random.Random(7)
    names = [f"l{k:03}" for k in range(510)]
    words = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(3)] for n in names}
    rows = [(k * 3 + j, " ".join(words[n] * 3), n) for k, n in enumerate(names) for j in range(2)]
    docs = fx.table(spark, rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs, centroids=1)
    assert set(model.languages) == set(names)
    sample = docs.where("doc_id % 17 = 0")
    whole = {(r.doc_id, r.lang, r._lang) for r in language.detect(sample, model).collect()}
    assert all(found.lang == lang for _, lang, found in whole)
    monkeypatch.setattr(language, "BLOCK", 200)
    assert {(r.doc_id, r.lang, r._lang) for r in language.detect(sample, model).collect()} == whole


def test_language_without_labels(spark):
    docs = fx.table(spark, [(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert language.fit(docs) is None
    assert language.detect(docs, None).first()._lang.lang == "und"


def test_toxic_texts_score_high(spark):
    clean = sentences(LATIN["aa"] + LATIN["bb"], 200, 1)
    toxic = [t + " you slimeball" for t in sentences(LATIN["aa"] + LATIN["bb"], 60, 2)]
    rows = list(enumerate(clean + toxic)) + [(900, None), (901, ""), (902, "slimeball"), (902, "slimeball")]
    labels = [(i, int(i >= 200)) for i in range(260)] + [(5, None), (None, 1), (6, 0), (6, 0)]
    docs = fx.table(spark, rows)
    frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, frame, allowed=F.col("doc_id") % 4 != 2)
    got = toxicity.score(docs, model).select("doc_id", "_toxic").collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r._toxic for r in got}
    held = [i for i in range(260) if i % 4 == 2]
    assert all((score[i] >= 0.3) == (i >= 200) for i in held) and score[902] >= 0.3
    assert score[900] == score[901] < 0.3


@pytest.mark.parametrize("labels", [[], [(0, 0)], [(0, 1), (1, 1)]])
def test_toxicity_of_one_class_or_none(spark, labels):
    docs = fx.table(spark, [(0, "a b c"), (1, None)])
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    scores = {r._toxic for r in toxicity.score(docs, model).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1
