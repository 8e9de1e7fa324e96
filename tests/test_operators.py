from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threatsieve.functions import constants as C
from threatsieve.functions.url import LEXICAL_FEATURES, lexical_features
from threatsieve.operators import filters, fusion, lists, scoring, token_bayes, training
from threatsieve.operators.weights import repeated, unweigh, weigh
from threatsieve.plans import fixtures as fx
from threatsieve.plans.queries import QUERIES, models_for
from threatsieve.sources import lines as src


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def urls(spark, values):
    return spark.createDataFrame([(v,) for v in values], "url string")


def test_suffixes_split_the_input(spark):
    values = ["http://a/x.apk", "http://a/xapk", "http://a/x.APK", "http://a/x.apk?q=1", "a.sis", "a.html", ""]
    df = urls(spark, values)
    kept = [r.url for r in filters.download_suffix(df).collect()]
    assert kept == [v for v in values if v.endswith(C.DOWNLOAD_SUFFIXES)]
    dropped = df.where(~filters.is_download(F.col("url"))).count()
    assert len(kept) + dropped == len(values)
    assert [r.url for r in filters.package_suffix(df).collect()] == ["http://a/x.apk"]


def test_field_extraction(spark):
    values = ["0|1|u|3", "0|1|u", "0|1", "0|1||3", "0|1|u||", "", None, "|||"]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r.url for r in src.extract_field(df, 2).collect()] == ["u", "u", "u"]
    assert [r.value for r in src.bad_records(df, 2).collect()] == ["0|1", "0|1||3", "", None, "|||"]
    assert [r.url for r in src.first_field(df).collect()] == ["0", "0", "0", "0", "0", "", None, ""]
    long = spark.createDataFrame([("|".join(map(str, range(60))),)], "value string")
    for index in (0, 25, 47, 59):
        assert src.extract_field(long, index).first().url == str(index)
    assert src.extract_field(long, 60).count() == 0


def test_suffix_filter_reaches_the_scan(spark, tmp_path):
    urls(spark, ["http://a/x.apk", "http://a/y"]).write.parquet(str(tmp_path / "urls"))
    df = filters.package_suffix(spark.read.parquet(str(tmp_path / "urls")))
    assert "StringEndsWith(url,.apk)" in plan(df)
    df = filters.download_suffix(spark.read.parquet(str(tmp_path / "urls")), stored=True)
    assert "PushedFilters: [Or" in plan(df)


def test_suffix_filter_cuts_the_line_once(spark):
    lines = spark.createDataFrame([("0|1|http://a/x.apk|3",), ("0|1|http://a/y|3",)], "value string")
    df = filters.download_suffix(src.extract_field(lines, 2))
    assert [r.url for r in df.collect()] == ["http://a/x.apk"]
    assert plan(df).count("split(") <= 3  # the filter's two conditions and the column itself


def test_labelled_source(spark, tmp_path):
    urls(spark, ["w1", "w2"]).withColumn("other", F.lit(1)).write.parquet(str(tmp_path / "w"))
    urls(spark, ["b1"]).write.parquet(str(tmp_path / "b"))
    both = src.labelled_union(
        src.read_labelled(spark, str(tmp_path / "w"), 1), src.read_labelled(spark, str(tmp_path / "b"), 0)
    )
    assert sorted(map(tuple, both.collect())) == [("b1", 0), ("w1", 1), ("w2", 1)]


def test_spread_only_touches_small_scans(spark):
    few, many = spark.range(100, numPartitions=1), spark.range(100, numPartitions=64)
    assert src.spread(few).rdd.getNumPartitions() == 8
    assert src.spread(many) is many


def test_weights_there_and_back(spark):
    values = ["a"] * 1000 + ["b"] * 37 + ["c", None]
    weighted = weigh(urls(spark, values), "url")
    assert {r.url: r.copies for r in weighted.collect()} == Counter(values)
    assert Counter(r.url for r in unweigh(weighted).collect()) == Counter(values)
    big = spark.createDataFrame([("x", 1_000_003), ("y", 0)], "url string, copies bigint")
    spread = unweigh(big)
    assert spread.count() == 1_000_003
    assert spread.groupBy(F.spark_partition_id()).count().count() > 4


def test_rows_are_repeated_in_blocks(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2500), ("c", 0), ("d", 1000)], "url string, _times bigint")
    found = {r.url: r.n for r in repeated(rows, "_times").groupBy("url").agg(F.count("*").alias("n")).collect()}
    assert found == {"a": 1, "b": 2500, "d": 1000}


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_lists_with_and_without_broadcast(spark, threshold):
    values = [f"u{i}" for i in range(100)]
    white, black = urls(spark, ["u1", "u2", "u2", None]), urls(spark, ["u2", "u3", "other"])
    listed = lists.list_union(white, black)
    assert listed.count() == 7
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        kept = lists.exclude_listed(urls(spark, values), listed)
        assert ("BroadcastHashJoin" in plan(kept)) == (threshold != "-1") or "SortMergeJoin" in plan(kept)
        assert sorted(r.url for r in kept.collect()) == sorted(set(values) - {"u1", "u2", "u3"})
        flagged = lists.flag_listed(urls(spark, [*values, None]), listed)
        assert {r.url for r in flagged.where("listed").collect()} == {"u1", "u2", "u3"}
        assert flagged.count() == 101
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_large_lists_are_tested_before_they_are_shuffled(spark):
    found = urls(spark, [f"u{k}" for k in range(500)] + [None])
    listed = spark.range(200_000).select(F.concat(F.lit("u"), F.col("id") * 7).alias("url")).unionByName(urls(spark, [None, "u7", "u7"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, tested = (lists.flag_listed(found, listed, prefilter=p) for p in (False, True))
        assert sorted(map(str, plain.collect())) == sorted(map(str, tested.collect()))
        assert {r.url for r in tested.where("listed").collect()} == {f"u{k}" for k in range(0, 500, 7)}
        kept = [sorted(str(r.url) for r in lists.exclude_listed(found, listed, prefilter=p).collect()) for p in (False, True)]
        assert kept[0] == kept[1] and len(kept[0]) == 501 - 72
        whole, hits = max(shuffled_records(plain)), max(shuffled_records(tested))
        assert whole >= 200_000 and hits < 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # A full bitmap lets everything through, and the rows stay right.
    bitmap = lists.url_bitmap(found, bits=64)
    assert bitmap.count() == 1
    assert lists.may_meet(listed, bitmap, bits=64).where("url = 'u7'").count() == 3


def test_fusion_counts_every_pair(spark):
    g = spark.createDataFrame([(1, "x")] * 7 + [(1, "y"), (2, "x")], "batch int, url_GBDT string")
    b = spark.createDataFrame(
        [(1, "x", 0.5)] * 4 + [(1, "x", 0.6)] * 2 + [(1, "z", 0.5), (2, "y", 0.5)],
        "batch int, url_Bayes string, prob_Bayes double",
    )
    found = {(r.batch, r.url, r.prob_Bayes): r.copies for r in fusion.fusion_join(g, b, ["batch"]).collect()}
    brute = Counter(
        (row.batch, row.url_GBDT, other.prob_Bayes)
        for row in g.collect() for other in b.collect()
        if (row.batch, row.url_GBDT) == (other.batch, other.url_Bayes)
    )
    assert found == brute == {(1, "x", 0.5): 28, (1, "x", 0.6): 14}
    pairs = unweigh(fusion.fusion_join(g, b, ["batch"]))
    assert pairs.count() == 42
    row = pairs.first()
    assert str(row.prob_GBDT) == "0.58" and pairs.schema["prob_GBDT"].dataType.simpleString() == "decimal(2,2)"


def test_fusion_leaves_rows_without_keys_out_and_shuffles_less(spark):
    g = spark.createDataFrame([(1, "x"), (None, "x"), (1, None), (1, "a.com"), (1, "http://b.com")], "batch int, url_GBDT string")
    b = spark.createDataFrame(
        [(1, "x", None), (None, "x", 0.5), (1, None, 0.5), (1, "http://a.com", 0.5), (1, "b.com", 0.7), (1, "b.com", 0.9)],
        "batch int, url_Bayes string, prob_Bayes double",
    )
    joined, normalized = fusion.fusion_join(g, b, ["batch"]), fusion.fusion_normalized(g, b, ["batch"])
    assert [plan(f).count("Exchange hashpartitioning") for f in (joined, normalized)] == [2, 1]
    assert [(r.batch, r.url, r.prob_Bayes, r.copies) for r in joined.collect()] == [(1, "x", None, 1)]
    found = sorted((r.url, r.prob_Bayes) for r in normalized.collect())
    assert found == [("http://a.com", 0.5), ("http://b.com", 0.9), ("http://x", None)]


def test_fusion_is_inside_both_sides(spark, sf_dir):
    verdicts = fx.verdicts(fx.hits(spark, sf_dir))
    fused = QUERIES["fusion_join"](spark, sf_dir).select("batch", "url").distinct()
    for side, prediction in (("gbdt_url", "gbdt_pred"), ("bayes_url", "bayes_pred")):
        flagged = fusion.flagged(verdicts, prediction).select("batch", F.col(side).alias("url"))
        assert fused.join(flagged, ["batch", "url"], "left_anti").count() == 0


def test_tree_scores_by_brute_force(spark, sf_dir):
    """Walk every tree by hand over all rows and compare the flagged set."""
    models = models_for(spark, sf_dir)
    trees = models.gbdt.stages[-1]

    def walk(node, row):
        while node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            node = (
                node.leftChild() if row[split.featureIndex()] <= split.threshold() else node.rightChild()
            )
        return node.prediction()

    weighted = weigh(filters.download_suffix(fx.hits(spark, sf_dir)), "url")
    features = lexical_features(weighted, keep=["copies"])
    roots = [(w, t._java_obj.rootNode()) for w, t in zip(trees.treeWeights, trees.trees)]
    expected, cache = {}, {}
    for r in features.collect():
        row = tuple(float(r[f]) for f in LEXICAL_FEATURES)
        if row not in cache:
            cache[row] = sum(weight * walk(root, row) for weight, root in roots)
        if cache[row] <= 0:
            expected[r.Url] = r.copies
    found = {r.url_GBDT: r.copies for r in scoring.gbdt_verdicts(weighted, models.gbdt).collect()}
    assert found == expected and found


def test_models_learn_the_labels(spark, sf_dir):
    models = models_for(spark, sf_dir)
    labelled = weigh(fx.ruled(fx.hits(spark, sf_dir)), "url", "label")
    gbdt = models.gbdt.transform(lexical_features(labelled, keep=["label", "copies"]))
    hit, total = gbdt.selectExpr(
        "sum(IF(predictions = label, copies, 0))", "sum(copies)"
    ).first()
    assert hit == total
    again = training.fit_gbdt(fx.labelled(fx.hits(spark, sf_dir)), rounds=3)
    once = training.fit_gbdt(fx.labelled(fx.hits(spark, sf_dir)), rounds=3)
    assert again.stages[-1].toDebugString.split("\n")[1:] == once.stages[-1].toDebugString.split("\n")[1:]


def test_trees_are_fitted_on_distinct_features(spark, monkeypatch):
    """URLs with equal features and label are one row of their weight, counted before or not."""
    rows = [(f"http://a.com/x{n}.apk", n % 2) for n in range(10, 40)] + [("http://a.com/x11.apk", 1)] * 5
    labelled = spark.createDataFrame(rows, "url string, label int")
    seen, kept = [], training._kept

    def spy(frame):
        seen.append(sorted((r.label, r.copies) for r in frame.collect()))
        return kept(frame)

    monkeypatch.setattr(training, "_kept", spy)
    trees = [training.fit_gbdt(of, rounds=2).stages[-1].toDebugString.split("\n")[1:] for of in (labelled, weigh(labelled, "url", "label"))]
    assert seen == [[(0, 15), (1, 20)]] * 2 and trees[0] == trees[1]


def test_trees_are_fitted_on_all_urls(spark):
    """Beyond a million distinct URLs too: the suspicious ones are those a bound by hash would leave out."""
    many = spark.range(1_010_000).select(F.format_string("http://a.com/x%d.exe", "id").alias("url"), F.lit(1).alias("label"))
    odd = spark.range(2000).select(F.format_string("http://a.com:8080/x%d.apk", "id").alias("url"))
    odd = odd.orderBy(F.shiftrightunsigned(F.xxhash64("url"), 2).desc()).limit(5).withColumn("label", F.lit(0))
    model = training.fit_gbdt(many.union(odd).withColumn("copies", F.lit(1).cast("bigint")), rounds=1)
    found = model.transform(lexical_features(odd.union(many.limit(5)), keep=["label"])).collect()
    assert len(found) == 10 and all(r.predictions == r.label for r in found)


def test_thresholds_of_trees_come_from_all_rows(spark):
    """A value that one of 40,000 feature rows has is told apart, though Spark would look at a quarter of them."""
    path = "concat('http://a.com/', repeat('p', int(id % 200)), '/', repeat('q', int(id div 200)), '.exe')"
    many = spark.range(40_000).select(F.expr(path).alias("url"), F.lit(1).alias("label"))
    odd = urls(spark, ["http://a.com:8080/p/q.exe", "http://10.1.2.3/p/q.exe", "http://a.com/p/下.exe", "http://a.b.c.d.com/p/q.exe"])
    odd = odd.withColumn("label", F.lit(0))
    featured = lexical_features(many.union(odd), keep=["label"])
    assert featured.select(*LEXICAL_FEATURES).distinct().count() == 40_004
    model = training.fit_gbdt(many.union(odd), rounds=1)
    assert model.transform(featured).where("predictions <> label").count() == 0


def test_bins_take_in_all_rows():
    assert [training.whole_bins(n) for n in (0, 1, 10_000, 10_001, 40_000, 40_001)] == [32, 32, 32, 101, 200, 201]
    assert training.whole_bins(46_340**2) ** 2 < 2**31
    with pytest.raises(ValueError):
        training.whole_bins(46_340**2 + 1)


def test_weighted_hits_are_labelled_once(spark, sf_dir):
    hits = fx.hits(spark, sf_dir)
    counted = weigh(fx.labelled(hits), "url", "label")
    whole, once = fx.ruled(hits), fx.ruled(counted)
    assert once.count() == counted.count() < whole.count()
    assert set(map(tuple, weigh(once, "url", "label").collect())) == set(map(tuple, weigh(whole, "url", "label").collect()))


def test_downloads_are_told_by_their_end(spark):
    values = ["apk", "pk", "", "k", "é.apk", "日本sisx", "😀rar", "sisx ", "x.apk\n", "apkx", None, "下" * 300 + "zip"]
    found = [r.d for r in urls(spark, values).select(filters.is_download(F.col("url")).alias("d")).collect()]
    assert found == [None if v is None else v.endswith(C.DOWNLOAD_SUFFIXES) for v in values]


def test_fits_are_bounded_by_whole_urls(spark, sf_dir):
    labelled = fx.labelled(fx.hits(spark, sf_dir))
    counted = weigh(labelled, "url", "label")
    total = counted.select("url").distinct().count()
    assert training.bounded(counted, total, total) is counted
    some = {r.url for r in training.bounded(counted, total, total // 2).collect()}
    assert 0 < len(some) <= total // 2
    assert some == {r.url for r in training.bounded(counted.repartition(3), total, total // 2).collect()}
    exact = training.fit_bayes(labelled)
    again = training.fit_bayes(labelled, max_labelled=total)
    assert again.stages[1].vocabulary == exact.stages[1].vocabulary or set(
        again.stages[1].vocabulary
    ) == set(exact.stages[1].vocabulary)
    assert sorted(again.stages[-1].theta.toArray()[0]) == sorted(exact.stages[-1].theta.toArray()[0])


def test_weighted_bayes_equals_rows(spark, sf_dir):
    """Fitting on counted rows gives the parameters of fitting on all rows."""
    labelled = fx.labelled(fx.hits(spark, sf_dir)).select("url", "label")
    model = training.fit_bayes(labelled).stages[-1]
    words = training.token_training(labelled)
    priors = {r.label: r.n for r in words.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(priors.values())
    for label, prior in priors.items():
        assert math.isclose(model.pi[label], math.log((prior + 1) / (total + 2)), rel_tol=1e-9)


def test_no_python_and_no_cross_join(spark, sf_dir):
    for name, query in QUERIES.items():
        text = plan(query(spark, sf_dir))
        for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in text, (name, operator)


def test_scoring_shuffles_once(spark, sf_dir):
    models = models_for(spark, sf_dir)
    pipeline = training.fit_bayes(fx.labelled(fx.hits(spark, sf_dir)))
    for bayes, joins in ((pipeline, 1), (models.bayes, 2)):  # the pages of the fixture; the weights
        df = scoring.score_lines(fx.hit_lines(fx.hits(spark, sf_dir)), fx.URL_INDEX, scoring.Models(models.gbdt, bayes))
        assert plan(df).count("Exchange hashpartitioning") == 1
        assert "Join" not in plan(df).replace("BroadcastHashJoin", "", joins)


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(QUERIES["dedup_urls"](spark, sf_dir))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in text
    assert "ReadSchema: struct<event_id:bigint>" in text


def shuffled_records(df):
    """Records written by every shuffle of an executed frame."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                found.append(node.metrics().get("shuffleRecordsWritten").get().value())
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
    return found


def test_hot_urls_and_other_lines_shrink_before_the_shuffle(spark):
    rows = spark.range(90_000, numPartitions=6)
    url = F.when(F.col("id") % 3 == 0, F.lit("http://hot.com/x.apk")).when(
        F.col("id") % 3 == 1, F.concat(F.lit("http://page.com/"), F.col("id"))
    ).otherwise(F.concat(F.lit("u"), F.col("id") % 100, F.lit(".com/a.exe")))
    lines = rows.select(F.concat(F.lit("0|1|"), url).alias("value"))
    counted = fusion.meeting_counts(lines.select(src.field(F.col("value"), 2).alias("url")))
    written = shuffled_records(counted)
    assert len(written) == 1 and written[0] <= 6 * 102
    rows = {r.url: (r.copies, r.own_copies) for r in counted.where("download").collect()}
    assert rows["http://hot.com/x.apk"] == (30_000, 30_000)
    assert rows["http://u2.com/a.exe"] == (300, 0)
    assert len(rows) == 101


def test_pair_counts_leave_the_long_range(spark):
    side = spark.createDataFrame([("x", 4_000_000_000)], "url_GBDT string, copies bigint")
    other = spark.createDataFrame(
        [("x", 0.5, 5_000_000_000)], "url_Bayes string, prob_Bayes double, copies bigint"
    )
    assert fusion.fusion_join(side, other).first().copies == 4_000_000_000 * 5_000_000_000


def test_feature_types(spark):
    fields = dict(lexical_features(urls(spark, ["a.com"])).dtypes)
    booleans = {"isIP", "isDing", "is_Prefix_sensitive", "ishaschn"}
    assert fields == {"Url": "string"} | {
        f: "boolean" if f in booleans else "int" for f in LEXICAL_FEATURES
    }
    labelled = urls(spark, ["a.com"]).withColumn("label", F.lit(1))
    assert training.lexical_training(labelled).columns == ["Url", *LEXICAL_FEATURES, "label"]
    assert training.token_training(labelled).dtypes == [
        ("Url", "string"), ("Word", "string"), ("label", "int")
    ]
