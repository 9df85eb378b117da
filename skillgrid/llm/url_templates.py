"""URL filters: rules first, then path templates judged by labelled purity. DataFrame functions only.

1. A url's longest fitting rule decides it. The pages that rules decide are the labelled ones.
2. Paths of a host form a tree of segments. Fork by fork, down to the last segment, a segment becomes a wildcard where it looks
   variable (numbers, dates, hexadecimal names), or where its parent has many different values that
   hardly repeat. Branches of one parent are merged with a larger one if neither how their pages divide
   over the shapes below nor their blocked share differs significantly: of labelled pages if both have some, else of all.
3. A template is rejected when the blocked share of its labelled pages, smoothed towards that of all labelled
   pages, reaches a threshold. One without a blocked page is never rejected.

Segments that all paths of a template share are passed in one step (they are the common prefix of the smallest and the
largest path), so rounds follow the forks of the tree and not the length of a path. A literal brace counts as ``%7B`` or ``%7D``.

Counts are pre-aggregated by (host, path prefix), so a host with a third of all pages is counted in all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, scratch_path

REPEATS = 2.0  # pages per different value under which values of a parent are variable
VALUES = 20  # different values a parent must have for that
SIGNIFICANT = 2.58  # standard errors by which two branches' blocked shares must differ to stay apart
LEVEL = 2.326  # of the chi-square test of shapes: the same 1 %, one-sided
SMOOTHING = 10.0  # labelled pages' weight of the overall share
REJECT = 0.6
PARTS = 32  # tasks over which the paths of one host and template are spread in a join

# Fixed values: (host, path, verdict) of the registered query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, ASCII letters lower-cased, and path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, null without one; of equally long ones the first in order of text.

    Rules are configuration, tried in one expression; a rule fits its host and all its subdomains.
    """
    name = verdict = None
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        text = F.lit(rule_host + rule_path)
        name = F.when(fits, text) if name is None else name.when(fits, text)
        verdict = F.when(fits, F.lit(decision)) if verdict is None else verdict.when(fits, F.lit(decision))
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


def shape(segment: Column) -> Column:
    """A wildcard for a segment that looks variable, else the segment."""
    extension = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    wildcard = (
        F.when(stem.rlike(r"^\d{4}-\d{2}(-\d{2})?$"), F.lit("{date}"))
        .when(stem.rlike(r"^\d+$"), F.lit("{number}"))
        .when(stem.rlike(r"^(?=.*\d)[0-9a-fA-F-]{8,}$"), F.lit("{hex}"))
        .when(stem.rlike(r"^[A-Za-z]+[-_]?\d+$"), F.concat(F.regexp_extract(stem, r"^([A-Za-z]+[-_]?)", 1), F.lit("{number}")))
    )
    return F.when(wildcard.isNotNull(), F.concat(wildcard, extension)).otherwise(segment)


def alike(left: DataFrame) -> DataFrame:
    """host, template, own, leader: each branch with the one it is like, itself if with no larger one.

    ``left`` has how many pages ``c`` of a branch have a shape below, with the branch's pages ``n``, labelled pages ``l``,
    blocked pages ``b`` and shapes ``k``. In a round, branches larger than all that share a shape with them lead; each other
    one is compared with the largest it shares a shape with, if that one leads. Leaders and what is like
    them drop out, and rounds go on until no branch is left, so work is that of shapes, not of pairs.
    """
    spark, folder, turn = left.sparkSession, scratch_path(left.sparkSession, "alike"), 0
    keys = ["host", "template"]
    left = materialize(left, "left")
    while turn == 0 or left.limit(1).count():
        largest = left.groupBy(*keys, "below").agg(F.max(F.struct("n", "own")).alias("largest"))
        target = left.join(largest, [*keys, "below"]).groupBy(*keys, "own", "n", "l", "b", "k").agg(F.max("largest").getField("own").alias("leader"))
        target = materialize(target, "targets")
        leaders = target.where("own = leader").select(*keys, "leader", F.col("n").alias("m"), F.col("l").alias("ml"), F.col("b").alias("mb"), F.col("k").alias("mk"))
        pairs = target.where("own <> leader").join(leaders, [*keys, "leader"])
        theirs = left.select(*keys, F.col("own").alias("leader"), "below", F.col("c").alias("d"))
        both = pairs.join(left.select(*keys, "own", "below", "c"), [*keys, "own"]).join(theirs, [*keys, "leader", "below"])
        scale = F.sqrt(F.col("m") / F.col("n"))
        square = F.pow(scale * F.col("c") - F.col("d") / scale, F.lit(2)) / (F.col("c") + F.col("d"))
        sums = both.groupBy(*keys, "own", "leader", "n", "l", "b", "k", "m", "ml", "mb", "mk").agg(
            F.sum(square).alias("x"), F.sum("c").alias("sc"), F.sum("d").alias("sd"), F.count("*").alias("shared")
        )
        # Two-sample chi-square over all shapes of either, with Wilson and Hilferty's bound.
        x = F.col("x") + F.col("m") / F.col("n") * (F.col("n") - F.col("sc")) + F.col("n") / F.col("m") * (F.col("m") - F.col("sd"))
        free = F.col("k") + F.col("mk") - F.col("shared") - 1
        part = F.lit(2 / 9) / F.greatest(free, F.lit(1))
        shapes_agree = (free == 0) | (x <= free * F.pow(1 - part + LEVEL * F.sqrt(part), F.lit(3)))
        # Shares of labelled pages where both branches have some; else unlabelled pages count as not blocked,
        # as similar shapes alone are no evidence against pages that no rule blocks.
        labelled = (F.col("l") > 0) & (F.col("ml") > 0)
        n, m = F.when(labelled, F.col("l")).otherwise(F.col("n")), F.when(labelled, F.col("ml")).otherwise(F.col("m"))
        share = (F.col("b") + F.col("mb")) / (n + m)
        error = F.sqrt(share * (1 - share) * (1 / n + 1 / m))
        shares_agree = F.abs(F.col("b") / n - F.col("mb") / m) <= SIGNIFICANT * error
        names = [*keys, "own", "leader"]
        found = sums.where(shapes_agree & shares_agree).select(names).unionByName(target.where("own = leader").select(names))
        found.write.mode("overwrite").parquet(f"{folder}/turn={turn}")
        left = materialize(left.join(spark.read.schema(found.schema).parquet(f"{folder}/turn={turn}"), [*keys, "own"], "left_anti"), "left")
        turn += 1
    return spark.read.schema(found.schema).parquet(folder).select(names)


def templates(pages: DataFrame) -> DataFrame:
    """The distinct (host, path) of ``pages`` (host, path, blocked 0/1 or null): host, path, template, n, b, labelled."""
    paths = pages.groupBy("host", "path").agg(F.count("*").alias("n"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b"), F.count("blocked").alias("labelled"))
    plain = F.filter(F.split(F.replace(F.replace("path", F.lit("{"), F.lit("%7B")), F.lit("}"), F.lit("%7D")), "/"), lambda s: s != "")
    # What is left of each path is written after each round, where counting, comparing and naming branches all read it.
    out = materialize(paths.withColumns({"left": F.transform(plain, shape), "template": F.lit("")}), "paths")
    spark, columns, schema = out.sparkSession, ["host", "path", "template", "n", "b", "labelled"], out.schema
    folder, turn, more = scratch_path(spark, "rounds"), 0, True
    stored = T.StructType([*schema, T.StructField("ended", T.BooleanType())])
    while more:
        out = past_common(out)
        own = F.coalesce(F.get("left", F.lit(0)), F.lit(""))
        tail = F.array_join(F.slice("left", 2, F.greatest(F.size("left"), F.lit(1))), "/")
        ending = F.regexp_extract("own", r"(\.[A-Za-z]{1,5})$", 1)  # of a page, which has no shape below
        out = out.withColumn("own", own).withColumn("below", F.when(F.size("left") > 1, tail).otherwise(ending))
        counts = [F.sum("n").alias("c"), F.sum("labelled").alias("l"), F.sum("b").alias("b")]
        shapes = materialize(out.groupBy("host", "template", "own", "below").agg(*counts), "shapes")
        branches = shapes.groupBy("host", "template", "own").agg(F.sum("c").alias("n"), F.sum("l").alias("l"), F.sum("b").alias("b"), F.count("*").alias("k"))
        parents = branches.groupBy("host", "template").agg(F.sum("n").alias("pn"), F.count("*").alias("values"))
        variable = (F.col("values") >= VALUES) & (F.col("pn") < REPEATS * F.col("values")) & ~F.col("own").contains("{")
        known = materialize(branches.join(parents, ["host", "template"]).withColumn("variable", variable), "branches")
        fixed = known.where((F.col("own") != "") & ~F.col("variable") & ~F.col("own").contains("{")).select("host", "template", "own", "n", "l", "b", "k")
        like = alike(shapes.drop("l", "b").join(fixed, ["host", "template", "own"]))
        several = like.groupBy("host", "template", "leader").agg(F.count("*").alias("members")).where("members > 1")
        known = known.join(like.join(several, ["host", "template", "leader"]), ["host", "template", "own"], "left")
        merged = (
            F.when(F.col("own") == "", F.lit(""))
            .when(F.col("variable"), F.lit("{value}"))
            .when(F.col("leader").isNotNull(), F.concat(F.lit("{branch:"), "leader", F.lit("}")))
            .otherwise(F.col("own"))
        )
        names = known.select("host", "template", "own", merged.alias("name"))
        out = with_facts(out, names, ["host", "template", "own"]).withColumn("template", F.concat("template", F.when(F.col("name") != "", F.concat(F.lit("/"), "name")).otherwise(F.lit(""))))
        out = out.withColumns({"left": F.slice("left", 2, F.greatest(F.size("left"), F.lit(1))), "ended": F.col("own") == ""})
        out.select(stored.names).write.mode("overwrite").parquet(f"{folder}/turn={turn}")
        out = spark.read.schema(stored).parquet(f"{folder}/turn={turn}").where("not ended").drop("ended")
        more = out.where(F.size("left") > 0).limit(1).count() > 0
        turn += 1
    rounds = spark.read.schema(T.StructType([*stored, T.StructField("turn", T.IntegerType())])).parquet(folder)
    return rounds.where(F.col("ended") | (F.col("turn") == turn - 1)).select(columns)


def with_facts(paths: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``paths`` with what ``facts`` tell of their group; a group with many paths is joined in ``PARTS`` parts.

    Facts are first joined to the parts that a group has, which are fewer rows than paths, then parts to paths.
    """
    dealt = paths.withColumn("_part", F.pmod(F.xxhash64("path"), F.lit(PARTS)))
    parts = dealt.select(*keys, "_part").distinct().join(facts, keys)
    return dealt.join(parts, [*keys, "_part"], how).drop("_part")


def past_common(paths: DataFrame) -> DataFrame:
    """Paths with the segments that all of one host and template share moved from ``left`` into the template."""
    part = F.pmod(F.xxhash64("path"), F.lit(PARTS)).alias("_part")
    ends = paths.groupBy("host", "template", part).agg(F.min("left").alias("_low"), F.max("left").alias("_high"))
    ends = ends.groupBy("host", "template").agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    same = F.zip_with("_low", "_high", lambda a, b: a.eqNullSafe(b))
    differs = F.array_position(same, False)
    shared = F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")
    steps = ends.withColumn("_shared", shared).where("_shared > 0").select("host", "template", "_shared")
    passed = F.concat(F.lit("/"), F.array_join(F.slice("left", F.lit(1), F.col("_shared")), "/"))
    rest = F.slice("left", F.col("_shared") + 1, F.greatest(F.size("left"), F.lit(1)))
    return with_facts(paths, steps, ["host", "template"], "left").withColumns({
        "template": F.when(F.col("_shared") > 0, F.concat("template", passed)).otherwise(F.col("template")),
        "left": F.when(F.col("_shared") > 0, rest).otherwise(F.col("left")),
    }).drop("_shared")


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES, reject: float = REJECT) -> DataFrame:
    """Per row: page_id, host, path, rule (null without), verdict (allow or block), template, purity.

    ``purity`` is the smoothed blocked share of the labelled pages of the url's template. Urls that are null or lack ``://`` have
    an empty host and path, and are judged as such. Repeated rows are kept and count; without rules, or
    without a blocked page, nothing is rejected. An empty table gives an empty result.
    """
    host, path = split_url(F.col(f"`{url_col}`").cast("string"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("decided", verdict)
    blocked = (F.col("decided") == "block").cast("int")
    found = templates(rows.select("host", "path", blocked.alias("blocked")))
    prior = found.agg(F.try_divide(F.sum("b"), F.sum("labelled")).alias("prior")).first().prior or 0.0
    pure = found.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("b").alias("b"))
    pure = pure.select(
        "host", "template", ((F.col("b") + SMOOTHING * prior) / (F.col("n") + SMOOTHING)).alias("purity"), (F.col("b") > 0).alias("evidence")
    )
    judged = with_facts(found.select("host", "path", "template"), pure, ["host", "template"])
    method = F.when(F.col("evidence") & (F.col("purity") >= reject), F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("decided", method).alias("verdict"), "template", "purity"
    )
