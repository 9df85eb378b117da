import os
from pathlib import Path

import compare
import corpus_pipeline
import fixtures_llm as fx
import pytest

from skillgrid.llm import queries

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare.difference(spark, compare.connect(SF), name, queries.QUERIES[name], queries.ORACLE[name], SF) is None


@needs_data
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_has_rows(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_stages_keep_columns_of_any_name(spark, folder):
    """Columns named like the stages' own helpers."""
    path, _, _ = folder
    clash = {c: "x" for c in ("_found", "_FOUND_", "_match", "_match_more", "_lang", "_pii", "node", "t", "tree")}
    from pyspark.sql import functions as F

    plain = docs = spark.read.parquet(f"{path}/documents.parquet")
    named = docs.withColumns({c: F.lit(v) for c, v in clash.items()})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, out = stage(spark, plain, path), stage(spark, named, path)
        plain, named_out = corpus_pipeline.materialize(plain, "plain"), corpus_pipeline.materialize(out, "named")
        assert named_out.columns == named.columns, name
        assert sorted(map(tuple, named_out.select(docs.columns).collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
        assert named_out.where(" or ".join(f"`{c}` <> 'x'" for c in clash)).count() == 0
        named = named_out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents and benchmark with planted cases."""
    words = {"xx": ["the", "and", "with", "thing", "over"], "yy": ["une", "avec", "pour", "cela", "tout"]}
    import random

    def text(lang, seed, n=120):
        rng = random.Random(seed)
        return " ".join(rng.choice(words[lang]) + rng.choice("abcdefgh") for _ in range(n))

    item = fx.prose(50, 30, 10**6)
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(["xx", "yy"] * 30)]
    rows += [(100, rows[3][1], "yy"), (101, rows[3][1] + " tail", "yy"), (2, rows[2][1], "xx")]  # copies
    rows += [(102, text("xx", 500) + " " + item + " " + text("xx", 501), "xx"), (103, "the " + item, "xx")]  # benchmark
    rows += [(104, text("yy", 502) + " mail jo.doe@example.org now " + text("yy", 503), "yy")]
    rows += [(105, None, "xx"), (106, "12 !", None), (None, text("xx", 504), "xx")]
    path = str(tmp_path_factory.mktemp("corpus"))
    frame = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, item


def test_stages_decide_as_plain_versions(spark, folder):
    path, rows, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = docs.columns
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, path), "test")
        assert docs.columns == names
        kept.append({r.doc_id: r for r in docs.collect()})
    start = {i for i, _, _ in rows}
    assert set(kept[0]) == start - {105, 106}
    assert set(kept[1]) == start - {105, 106, 100, 101} and kept[1][3].text == rows[3][1]
    assert set(kept[2]) == set(kept[1]) - {103}
    assert item.split()[5] not in kept[2][102].text and kept[2][102].n_chars == len(kept[2][102].text)
    assert "jo.doe@" not in kept[3][104].text and "@example.org" in kept[3][104].text
    assert all(kept[3][i].text == t for i, t, _ in rows if i in kept[3] and i not in (102, 104, 2))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {p.doc_id for p in pieces} == set(kept[3])
    whole = corpus_pipeline.run(spark, path).collect()
    key = lambda p: (p.doc_id or -1, p.start, p.length, p.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, pieces))


def test_pipeline_of_no_documents(spark, folder, tmp_path):
    path, _, _ = folder
    spark.read.parquet(f"{path}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_are_those_of_all_pairs(spark):
    rows = [(i, fx.prose(i, 100)) for i in range(10)]
    for i in range(10):  # a passage of 10 to 28 words more, a word changed: similarities around 0.80 and 0.85
        rows += [(100 + i, rows[i][1] + " " + fx.prose(700 + i, 10 + 2 * i)), (200 + i, " ".join([*rows[i][1].split()[: 90 - i], "other", *rows[i][1].split()[91 - i :]]))]
    sets = {i: fx.word_grams(text, 5) for i, text in rows}
    alike = [len(sets[i] & sets[100 + i]) / len(sets[i] | sets[100 + i]) for i in range(10)]
    assert sum(0.80 <= s < 0.85 for s in alike) >= 2 and min(alike) < 0.80
    groups = fx.components_of(sets, 80)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()}
    assert kept == set(groups.values())


def test_no_text_is_shuffled_while_few_documents_go(spark, monkeypatch):
    """More documents stay than may be broadcast, fewer go."""
    from skillgrid.llm import jaccard

    monkeypatch.setattr(jaccard, "SMALL", 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, fx.prose(i, 40)) for i in range(20)] + [(30, fx.prose(3, 40)), (31, fx.prose(4, 40)), (6, fx.prose(6, 40)), (None, fx.prose(7, 40)), (None, None)]
        out = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert sorted((r.doc_id for r in out.collect()), key=lambda i: -1 if i is None else i) == [None, None, *range(20)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
