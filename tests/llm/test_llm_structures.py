"""Merkle manifest and SentencePiece round trip against plain versions."""

import hashlib
import random

import fixtures_llm as fx
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skillgrid.llm import merkle, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


# --- Merkle manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(row):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h(*values)


def climb(digests, arity):
    """The root, and for each start its siblings on every level as (before, after)."""
    paths, spots = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for path, spot in zip(paths, spots):
            run = digests[spot // arity * arity : spot // arity * arity + arity]
            path.append(("".join(run[: spot % arity]), "".join(run[spot % arity + 1 :])))
        digests = [h(*digests[k : k + arity]) for k in range(0, len(digests), arity)]
        spots = [s // arity for s in spots]
    return digests[0], paths


def plain_manifest(rows, arity):
    """(doc_id, leaf, subroot, root, path) of rows (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for i, text, lang, source, n in rows:
        key = b"-" if lang is None else b"=" + lang.encode()
        trees.setdefault(key, []).append((i is not None, i or 0, leaf_of((i, source, lang, n, text)), i))
    names = sorted(trees)
    grown = {k: climb([x[2] for x in sorted(trees[k], key=lambda x: x[:3])], arity) for k in names}
    root, tops = climb([grown[k][0] for k in names], arity)
    out = []
    for k, top in zip(names, tops):
        for (_, _, leaf, i), path in zip(sorted(trees[k], key=lambda x: x[:3]), grown[k][1]):
            out.append((i, leaf, grown[k][0], root, tuple(path + top)))
    return out


def manifest_rows(spark, rows, arity):
    frame = fx.table(spark, rows, SCHEMA).withColumns({"digest": F.lit("d"), "tree": F.lit("t"), "idx": F.lit(0), "level": F.lit(1), "parent": F.lit("p"), "_row": F.lit(3)})
    got = merkle.manifest(frame, arity=arity).collect()
    as_hex = lambda b: bytes(b).hex()
    return [(r.doc_id, r.leaf, r.subroot, r.root, tuple((as_hex(s.before), as_hex(s.after)) for s in r.path)) for r in got]


def hexed(paths):
    return sorted(paths, key=repr)


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_manifest_is_the_plain_trees(spark, arity):
    rng = random.Random(arity)
    rows = [(i, text, None, None, None) for i, text in fx.hard_texts() if text is None or len(text) < 1000]
    for i in range(200):
        lang = rng.choice(["en"] * 8 + ["de", "fr", "es", "", "-", "ñ", None])
        rows.append((rng.randrange(150), fx.prose(i, rng.randrange(9)), lang, rng.choice(["a", None]), rng.choice([i, None])))
    rows += [(5000 + k, "t", f"one{k}", "s", 1) for k in range(20)] + [(7, "same", "en", "s", 4)] * 3
    assert hexed(manifest_rows(spark, rows, arity)) == hexed(plain_manifest(rows, arity))


def test_paths_fold_to_the_root_and_show_tampering(spark):
    rows = [(i, f"Text {i}" if i % 4 else f"text {i}", "ab"[i % 2], "s", i) for i in range(70)]
    found = merkle.manifest(fx.table(spark, rows, SCHEMA), variants={"given": {"text": F.lower("text")}})
    got = found.select("doc_id", "root", merkle.folded(F.col("leaf"), F.col("path")).alias("own"), merkle.folded(F.col("given"), F.col("path")).alias("other")).collect()
    assert len(got) == 70 and all(r.own == r.root and (r.other == r.root) == (r.doc_id % 4 == 0) for r in got)


def test_manifest_of_one_row_and_of_none(spark):
    (got,) = manifest_rows(spark, [(1, "a", "en", None, 1)], 8)
    assert got[1] == got[2] == got[3] == leaf_of((1, None, "en", 1, "a")) and got[4] == ()
    none = merkle.manifest(fx.table(spark, [], SCHEMA))
    assert none.count() == 0 and none.columns == ["doc_id", "leaf", "subroot", "root", "path"]


def test_siblings_meet_without_a_further_exchange(spark):
    rows = [("t", k, 20, b"x") for k in range(20)]
    nodes = spark.createDataFrame(rows, "tree string, idx bigint, size bigint, digest binary")
    with merkle._layout_by_parent(spark):
        plan = merkle.linked(nodes, 8)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange hashpartitioning") <= 2
    assert spark.conf.get(merkle._LAYOUT, "true") == "true"


# --- SentencePiece

@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


def odd_texts():
    rng = random.Random(3)
    alphabet = "abcdehnrst   \n\t▁éüßñ北京한☃🙂​́<>0x41s/ İЖعت’—…"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    runs = ["".join(rng.choice(" ab") for _ in range(rng.randrange(200))) for _ in range(500)]
    return texts + runs + [" " * n for n in range(60)] + ["x" * 20_000, "<s></s><unk><0x41>", "a\x00b", "▁", "▁▁ a", "\r\n"]


def test_encoding_and_decoding_are_the_librarys(library):
    own = pieces.vocabulary(MODEL)
    for text in odd_texts():
        ids = library.encode(text)
        assert own.encode(text).tolist() == ids
        assert own.decode(ids) == library.decode(ids)


def test_decoding_of_any_ids_is_the_librarys(library):
    own, rng = pieces.vocabulary(MODEL), random.Random(4)
    for _ in range(3000):
        ids = [rng.randrange(rng.choice([5, 262, 32_000])) for _ in range(rng.randrange(10))]
        assert own.decode(ids) == library.decode(ids)


def test_every_prefix_ends_with_the_last_token_of_its_encoding():
    own = pieces.vocabulary(MODEL)
    text = "thatble▁▁ereerhainnotion"
    assert own.last_tokens(text)[1:] == [own.merged(text[:n])[-1] for n in range(1, len(text) + 1)]


def test_table_is_filled_only_where_longest_tokens_lead():
    own, rng = pieces.vocabulary(MODEL), random.Random(6)
    texts = ["".join(rng.choice(["th", "ble", "▁", "er", "tion", "xq", "aaa"]) for _ in range(rng.randrange(1, 9))) for _ in range(2000)]
    left_out = 0
    for text in texts:
        full, table = own.last_tokens(text), own.reached_tokens(text)
        assert table[-1] == full[-1] and all(token in (None, want) for token, want in zip(table, full))
        left_out += table[1:].count(None)
    assert left_out > len(texts)


def test_words_are_cut_where_no_piece_joins(library):
    own = pieces.vocabulary(MODEL)
    words = own.words("▁elle$$$▁▁ab.&&Привет12")
    assert words[:2] == ["▁elle", "$$$"] and "Привет" in words and "".join(words) == "▁elle$$$▁▁ab.&&Привет12"
    kinds = own.kinds()
    assert sum(map(len, kinds)) == len(own.known) - 1
    for piece in own.ids:
        assert sum(not kind.isdisjoint(piece.lstrip("▁")) for kind in kinds) <= 1


def test_caches_start_anew_when_full(monkeypatch, library):
    monkeypatch.setattr(pieces, "CACHE", 3)
    own = pieces.Vocabulary(MODEL)
    for text in ("one two three four five six", "seven eight one two"):
        assert own.encode(text).tolist() == library.encode(text)
        assert len(own.cache) <= 3 and len(own.cache.older) <= 3 and len(own.pairs) <= 3


def test_seams_are_those_of_plain_merging():
    own, rng = pieces.vocabulary(MODEL), random.Random(5)
    tokens = [*own.halves]
    short = [t for t in tokens if len(t) <= 3]
    for _ in range(20_000):
        x, y = rng.choice(short), rng.choice(rng.choice([short, tokens]))
        assert own.compatible(x, y) == (own.merged(x + y) == [x, y])


def test_round_trip_of_a_table(spark, library):
    rows = fx.hard_texts()
    got = pieces.decoded(pieces.encoded(fx.table(spark, rows).withColumn("ids", F.lit(1)), MODEL), MODEL).collect()
    want = [(i, library.encode(text or ""), library.decode(library.encode(text or ""))) for i, text in rows]
    assert sorted(((r.doc_id, list(r.ids), r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert pieces.encoded(fx.table(spark, []), MODEL).count() == 0
