"""Sources, sinks, samples, metrics, polygons, models, batches and streams."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators import boosting, metrics, ml, sampling, temporal, vector
from gridloom.plans import terrain as plan
from gridloom.schema import FEATURES
from gridloom.sources import files, geotiff
from gridloom.streaming import tiles


def test_tiff_round_trip(spark, tmp_path):
    a = np.random.default_rng(1).random((3, 7, 5)).astype("f4")
    data = geotiff.encode_tiff(a, (10.0, 0.0, 500000.0, 0.0, -10.0, 4650300.0), 32610, -9999)
    bands, meta = geotiff.decode_tiff(data)
    assert (bands == a).all() and meta["srid"] == 32610 and meta["nodata"] == -9999 and meta["transform"] == (10.0, 0.0, 500000.0, 0.0, -10.0, 4650300.0)
    (tmp_path / "x_filled.tif").write_bytes(data)
    (tmp_path / "x_fixed.tif").write_bytes(data)
    cells = files.read_tiffs(spark, str(tmp_path), "*_filled.tif").toPandas()
    assert len(cells) == a.size and set(cells.raster_id) == {"x_filled"}
    one = cells[(cells.band == 2) & (cells.r == 3) & (cells.c == 4)].value.iloc[0]
    assert one == pytest.approx(float(a[1, 3, 4]))
    names = files.without_fixed(files.listing(spark, str(tmp_path), "*.tif"))
    assert [r.name for r in names.collect()] == ["x_filled.tif"] and files.first_match(names, "_filled.tif") == "x_filled.tif"
    assert files.read_tiff_metadata(spark, str(tmp_path)).first().width == 5
    with pytest.raises(FileNotFoundError):
        files.first_match(names, ".csv")


def lzw(data):
    """Each code as bits: the longest known string; a width grows when the encoder's table has 511, 1,023 or 2,047 strings and is cleared at 4,094."""
    out, table, width, at = "", {}, 9, 0
    table = {bytes([i]): i for i in range(256)}
    out, free = f"{256:09b}", 258
    while at < len(data):
        n = 1
        while at + n < len(data) and data[at : at + n + 1] in table:
            n += 1
        out += f"{table[data[at : at + n]]:0{width}b}"
        table[data[at : at + n + 1]], free, at = free, free + 1, at + n
        if free == 4095:
            out, table, free, width = out + f"{256:0{width}b}", {bytes([i]): i for i in range(256)}, 258, 9
        width = 12 if free > 2047 else 11 if free > 1023 else 10 if free > 511 else 9
    out += f"{257:0{width}b}"
    return int(out.ljust(-(-len(out) // 8) * 8, "0"), 2).to_bytes(-(-len(out) // 8), "big")


def runs(data):
    return b"".join(bytes([257 - 3]) + data[i : i + 1] if data[i : i + 3] == data[i : i + 1] * 3 else bytes([len(data[i : i + 3]) - 1]) + data[i : i + 3] for i in range(0, len(data), 3))


PACK = {1: bytes, 5: lzw, 8: zlib.compress, 32773: runs}


def tiff(a, compression=1, predictor=1, tile=None, strip=3, big=False, order="<", absent=()):
    """A chunky TIFF of (rows, columns, samples), cell by cell."""
    h, w, n = a.shape
    bh, bw = tile or (strip, w)
    blocks = []
    for r in range(0, h, bh):
        for c in range(0, w, bw):
            block = np.zeros((bh if tile else min(bh, h - r), bw, n), a.dtype)
            part = a[r : r + bh, c : c + bw]
            block[: part.shape[0], : part.shape[1]] = part
            raw = b""
            for row in block:
                if predictor == 2:
                    row = np.concatenate([row[:1], row[1:] - row[:-1]])
                line = row.astype(a.dtype.newbyteorder(order)).tobytes()
                if predictor == 3:
                    size, cells = a.dtype.itemsize, row.astype(a.dtype.newbyteorder(">")).tobytes()
                    planes = b"".join(cells[k::size] for k in range(size))
                    line = bytes((planes[i] - (planes[i - n] if i >= n else 0)) % 256 for i in range(len(planes)))
                raw += line
            blocks.append(b"" if len(blocks) in absent else PACK[compression](raw))
    head = 16 if big else 8
    starts = [head + sum(len(x) for x in blocks[:k]) for k in range(len(blocks))]
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    tags = {256: (4, [w]), 257: (4, [h]), 258: (3, [a.dtype.itemsize * 8] * n), 259: (3, [compression]), 277: (3, [n]), 317: (3, [predictor]), 339: (3, [kind] * n)}
    tags |= {322: (4, [bw]), 323: (4, [bh]), 324: (4, starts), 325: (4, [len(x) for x in blocks])} if tile else {273: (4, starts), 278: (4, [bh]), 279: (4, [len(x) for x in blocks])}
    word, inline, at = ("Q", 8, head + sum(map(len, blocks))) if big else ("I", 4, head + sum(map(len, blocks)))
    free = at + (8 + 20 * len(tags) + 8 if big else 2 + 12 * len(tags) + 4)
    directory, extra = struct.pack(order + ("Q" if big else "H"), len(tags)), b""
    for tag, (code, values) in sorted(tags.items()):
        packed = struct.pack(f"{order}{len(values)}{'H' if code == 3 else 'I'}", *values)
        directory += struct.pack(order + "HH" + word, tag, code, len(values))
        directory += packed.ljust(inline, b"\0") if len(packed) <= inline else struct.pack(order + word, free + len(extra))
        extra += packed if len(packed) > inline else b""
    magic = b"II" if order == "<" else b"MM"
    top = magic + (struct.pack(order + "HHHQ", 43, 8, 0, at) if big else struct.pack(order + "HI", 42, at))
    return top + b"".join(blocks) + directory + struct.pack(order + word, 0) + extra


@pytest.mark.parametrize("compression", list(PACK))
@pytest.mark.parametrize("kind,predictor", [("u1", 1), ("i2", 2), ("f4", 3), ("f8", 1)])
@pytest.mark.parametrize("tile,big,order", [(None, False, "<"), ((16, 16), False, ">"), ((16, 32), True, "<")])
def test_tiff_layouts(compression, kind, predictor, tile, big, order):
    a = (np.random.default_rng(3).normal(50, 15, (37, 45, 2)).round(1) if kind != "u1" else np.random.default_rng(3).integers(0, 9, (37, 45, 2))).astype(kind)
    data = tiff(a, compression, predictor, tile, 5, big, order)
    bands, meta = geotiff.decode_tiff(data)
    assert (bands == np.moveaxis(a, 2, 0)).all() and (meta["width"], meta["height"], meta["bands"], meta["dtype"]) == (45, 37, 2, kind)


def test_tiff_lzw_fills_its_table():
    a = np.random.default_rng(4).integers(0, 256, (120, 100, 1)).astype("u1")
    assert (geotiff.decode_tiff(tiff(a, 5, strip=120))[0][0] == a[..., 0]).all()


def test_tiff_sparse_and_unknown():
    a = np.full((20, 20, 1), 7, "f4")
    assert geotiff.decode_tiff(tiff(a, 8, 3, (16, 16), absent=(1,)))[0][0].sum() == 7 * (400 - 16 * 4)
    with pytest.raises(ValueError):
        geotiff.decode_tiff(tiff(a).replace(struct.pack("<HHIHH", 259, 3, 1, 1, 0), struct.pack("<HHIHH", 259, 3, 1, 7, 0)))


def test_tiles_as_cells(spark, tmp_path):
    a = np.arange(20 * 21, dtype="f4").reshape(20, 21, 1)
    (tmp_path / "t.tif").write_bytes(tiff(a, 8, 3, (16, 16)))
    cells = files.read_tiffs(spark, str(tmp_path)).toPandas()
    assert len(cells) == a.size and (cells.value == cells.r * 21 + cells.c).all()
    assert files.read_tiff_metadata(spark, str(tmp_path)).first().height == 20


def test_training_tables(spark, tmp_path):
    rows = [(*[float(i + k) for k in range(28)], i % 2) for i in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in FEATURES) + ", label int")
    for name in ("A_Creek", "B_River"):
        df.toPandas().to_csv(tmp_path / f"{name}_training_data.csv", index=False)
    both = files.read_all_training(spark, str(tmp_path))
    assert {r.watershed: r["count"] for r in both.groupBy("watershed").count().collect()} == {"A_Creek": 6, "B_River": 6}
    files.write_training(df, str(tmp_path / "out"))
    assert files.read_training(spark, str(tmp_path / "out")).count() == 6


def test_bands_and_replacement(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, 0, 1.0, None), ("b", 0, 1, 2.0, 3.0)], "raster_id string, r int, c int, x double, y double")
    files.write_bands(df, str(tmp_path / "t"))
    assert files.read_bands(spark, str(tmp_path / "t"), ["x"], ["b"]).collect()[0].x == 2.0
    assert files.only_raster(df.filter("raster_id = 'a'")) == "a"
    with pytest.raises(ValueError, match="a, b"):
        files.only_raster(df)
    files.write_single_band(df, "y", str(tmp_path / "y"))
    assert sorted(r.y for r in spark.read.parquet(str(tmp_path / "y")).collect()) == [-9999.0, 3.0]
    path = str(tmp_path / "u")
    df.write.parquet(path)
    files.replace_table(spark, spark.read.parquet(path).filter("raster_id = 'a'"), path)
    assert spark.read.parquet(path).count() == 1


def test_parameters(spark, tmp_path):
    assert files.read_parameters(spark, str(tmp_path / "none.json")) == files.DEFAULTS
    (tmp_path / "p.json").write_text('{"max_depth": 4, "best_cv_auc": 0.9}')
    assert files.read_parameters(spark, str(tmp_path / "p.json")) == files.DEFAULTS | {"max_depth": 4}
    df = spark.createDataFrame([({"a": 1.0, "scale_pos_weight": 3.0},), ({},)], "p map<string,double>")
    assert [r.x for r in df.select(files.parameter_document(F.col("p"), F.lit(0.98765)).alias("x")).collect()] == ['{"a":1.0,"best_cv_auc":0.9877}', '{"best_cv_auc":0.9877}']
    over = files.overlaid(F.create_map(F.lit("a"), F.lit(5.0), F.lit("b"), F.lit(6.0)), F.col("p"))
    assert df.select(over.alias("m")).first().m == {"a": 1.0, "b": 6.0, "scale_pos_weight": 3.0}
    files.append_run(spark, str(tmp_path / "runs"), "one", {"a": 1.0}, {"auc": 0.9}, {"kind": "test"})
    assert spark.read.parquet(str(tmp_path / "runs")).first().metrics == {"auc": 0.9}


def test_report(spark):
    lines = files.report_lines("Results", {"pixels": 1234567, "AUC": 0.98765, "name": "Creek"})
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert {r.name: r.shown for r in files.parse_report(df).collect()} == {"pixels": "1,234,567", "AUC": "0.9877", "name": "Creek"}


@pytest.fixture(scope="module")
def labelled(spark):
    r = np.random.default_rng(5)
    rows = [(i, int(y), float(round(y * 0.3 + s, 2)), "ab"[i % 2]) for i, (y, s) in enumerate(zip(r.random(400) < 0.25, r.random(400), strict=True))]
    return spark.createDataFrame(rows, "id long, label int, score double, g string").cache()


def plain_auc(rows):
    p, n = [r.score for r in rows if r.label == 1], [r.score for r in rows if r.label == 0]
    return sum((a > b) + 0.5 * (a == b) for a in p for b in n) / (len(p) * len(n))


def test_auc(labelled):
    rows = labelled.collect()
    assert metrics.auc(labelled, "label", "score").first().auc == pytest.approx(plain_auc(rows))
    assert metrics.auc(labelled.withColumn("score", -F.col("score")), "label", "score").first().auc == pytest.approx(1 - plain_auc(rows))
    for x in metrics.auc(labelled, "label", "score", ["g"]).collect():
        assert x.auc == pytest.approx(plain_auc([r for r in rows if r.g == x.g]))
    assert metrics.auc(labelled.filter("label = 1"), "label", "score").first().auc is None


def test_report_without_positives(labelled):
    r = metrics.report(labelled.filter("label = 0").withColumn("p", F.lit(0)), "label", "p").first()
    assert (r.precision_positive, r.recall_positive, r.f1_positive, r.accuracy, r.support_negative) == (0.0, 0.0, 0.0, 1.0, r.tn)
    assert metrics.by_group(labelled.limit(9), "label", "score", "g").count() == 0


def test_samples_are_exact(labelled):
    n = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    split = {(r.label, r.is_train): r["count"] for r in sampling.stratified_split(labelled, "label", 42, "id").groupBy("label", "is_train").count().collect()}
    assert all(split[k, True] == n[k] * 3 // 4 for k in n)
    folds = sampling.stratified_folds(labelled, "label", 42, "id").groupBy("label", "fold").count().collect()
    assert all(abs(r["count"] - n[r.label] / 5) < 1 for r in folds)
    assert sampling.per_group(labelled, "g", 21, 42, "id").groupBy("g").count().filter("count <> 10").count() == 0
    sample = sampling.balanced(labelled, "label", 42, "id", positives=1000, negatives=5)
    assert sample.filter("label = 1").count() == n[1] and sample.filter("label = 0").count() == min(4 * n[1], n[0])
    again = sampling.first_n(labelled.repartition(7), 30, 42, "id")
    assert {r.id for r in again.collect()} == {r.id for r in sampling.first_n(labelled, 30, 42, "id").collect()}
    ranks = sorted(r.rank for r in sampling.ranked(labelled, [], 42, "id").collect())
    assert ranks == list(range(1, 401))


def test_polygons(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    df = spark.createDataFrame([(1, square), (2, [(20.0, 20.0), (25.0, 20.0), (22.0, 28.0)])], "poly_id int, ring array<struct<x:double,y:double>>")
    assert df.select(vector.area(F.col("ring")).alias("a")).collect()[0].a == 100
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 15.0, 5.0), (3, 22.0, 22.0)], "id int, x double, y double")
    assert {r.id: (r.poly_id, r.polygons) for r in vector.first_polygon(points, df, "id", "poly_id", 4.0).collect()} == {1: (1, 1), 2: (None, 0), 3: (2, 1)}
    assert vector.total_envelope(df).first() == (0.0, 0.0, 25.0, 28.0)
    runs = {(r.r, r.c_start, r.c_end) for r in vector.runs(df.filter("poly_id = 1"), 100, 8).collect()}
    assert runs == {(r, 0, 7) for r in range(10)}
    kept = spark.createDataFrame([("PEM1",), ("PXX",), (None,)], "a string").filter(vector.prefix_filter(F.col("a"), ("PEM", "PSS")))
    assert kept.count() == 1
    assert vector.states_needed(41.0, 41.9) == ["CA"] and vector.states_needed(42.1, 42.3) == ["OR", "CA"] and vector.states_needed(43, 44) == ["OR"]
    assert '"type":"Polygon"' in vector.as_geojson(df, "poly_id").first().value


def test_mosaic_skips_gaps(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (2, 0, None), (1, 1, None)], "img int, c int, value double")
    assert {r.c: r.value for r in temporal.mosaic(df, ["c"], ["img"]).collect()} == {0: 5.0}
    assert {r.c: r.value for r in temporal.latest(df, ["c"], ["img"]).collect()} == {0: None, 1: None}


def test_models(spark):
    r = np.random.default_rng(11)
    rows = [(i, float(a), float(b), int(a + 0.3 * b > 0.8)) for i, (a, b) in enumerate(r.random((600, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    split = sampling.stratified_split(df, "label", 42, "id").cache()
    params = files.DEFAULTS | {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.3}
    model = ml.train(ml.weighted(split.filter("is_train")), ["a", "b"], ml.boosted_trees(params))
    assert ml.evaluate(ml.probability(model, split.filter("not is_train"))).first().auc > 0.95
    ranks = ml.importance(model, ["a", "b"])
    assert [x[0] for x in ranks] == [1, 2] and ranks[0][1] == "a"
    points = ml.draws(ml.GRID, 5)
    assert len({tuple(p.items()) for p in points}) == 5 and points == ml.draws(ml.GRID, 5)
    small = [params | {"max_depth": d, "n_estimators": 2} for d in (1, 3)]
    _, found = ml.search(df, ["a", "b"], small, ["id"], folds=2, parallelism=2)
    assert found[0][1] >= found[1][1] and found[0][0]["max_depth"] == 3


def test_search_weighs_positives_by_the_point(spark):
    assert set(ml.GRID["scale_pos_weight"]) == {1, 3, 5, 9} and 0.2 in ml.GRID["learning_rate"] and 3 in ml.GRID["max_depth"]
    r = np.random.default_rng(13)
    df = spark.createDataFrame([(i, float(a), int(r.random() < a / 2)) for i, a in enumerate(r.random(300))], "id long, a double, label int")
    base = files.DEFAULTS | {"max_depth": 2, "n_estimators": 1}
    shares = []
    for w in (1, 9):
        model, found = ml.search(df, ["a"], [base | {"scale_pos_weight": w}], ["id"], folds=2, parallelism=2)
        assert found[0][0]["scale_pos_weight"] == w
        shares.append(ml.probability(model, df).agg({"probability": "avg"}).first()[0])
    assert shares[0] < shares[1] - 0.1


def test_second_order_trees(spark):
    r = np.random.default_rng(12)
    rows = [(i, float(a), float(b) if i % 50 else None, float(c), int(a + 0.3 * b > 0.8)) for i, (a, b, c) in enumerate(r.random((800, 3)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label int")
    split = sampling.stratified_split(df, "label", 42, "id").cache()
    params = files.DEFAULTS | {"n_estimators": 12, "max_depth": 3, "learning_rate": 0.3, "colsample_bytree": 1.0, "gamma": 0.0}
    model = boosting.train(split.filter("is_train"), ["a", "b", "c"], params)
    scored = boosting.probability(model, split.filter("not is_train"))
    assert scored.columns == [*split.columns, "probability"] and ml.evaluate(scored).first().auc > 0.95
    assert [x[1] for x in model.importance()][0] == "a"
    stumps = boosting.train(split.filter("is_train"), ["a", "b", "c"], params | {"gamma": 1e9, "n_estimators": 1})
    assert (stumps.trees[0].feature == -1).all()
    flat = boosting.train(split.filter("is_train"), ["a", "b", "c"], params | {"reg_alpha": 1e9, "n_estimators": 1})
    assert (flat.trees[0].value == 0).all()


def labelled_squares(spark, n=400):
    r = np.random.default_rng(21)
    rows = [(i, float(a), float(b), int(a + 0.2 * b > 0.7)) for i, (a, b) in enumerate(r.random((n, 2)))]
    return spark.createDataFrame(rows, "id long, a double, b double, label int").cache()


def test_saved_trees_and_trial(spark, tmp_path):
    df = labelled_squares(spark)
    params = plan.short_parameters()
    assert params["n_estimators"] == 10 and params["max_depth"] == 4 and params["reg_lambda"] == 2
    assert plan.short_parameters({"max_depth": 6.0, "n_estimators": 300.0, "scale_pos_weight": 5.0}) == files.DEFAULTS | {"max_depth": 6.0, "n_estimators": 10.0}
    path = str(tmp_path / "model")
    model, report = plan.trained(df, ["a", "b"], params | {"colsample_bytree": 1.0}, ["id"], path)
    assert len(model.trees) == 10 and report.first().auc > 0.9
    again = boosting.load(spark, path)
    both = boosting.probability(again, boosting.probability(model, df, "p"), "q")
    assert both.filter("p <> q or p is null").count() == 0 and again.importance() == model.importance()
    boosting.save(spark, model, path)
    assert boosting.load(spark, path).features == ["a", "b"]


def test_second_order_search(spark):
    df = labelled_squares(spark, 240)
    good = files.DEFAULTS | {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3, "colsample_bytree": 1.0}
    found = boosting.search(df, ["a", "b"], [good | {"gamma": 1e9}, good], ["id"], folds=2)
    assert [x[0]["gamma"] for x in found] == [0.5, 1e9]  # no split is worth the greater gamma
    assert found[0][1] > 0.85 and found[1][1] == 0.5


def test_forest_search(spark):
    total = 1
    for v in ml.FOREST_GRID.values():
        total *= len(v)
    assert total == 720
    df = labelled_squares(spark, 200)
    point = {"n_estimators": 3, "max_depth": None, "min_samples_split": 2, "min_samples_leaf": 1, "bootstrap": True}
    model, found = ml.search(df, ["a", "b"], [point | {"class_weight": w} for w in (None, "balanced", 5)], ["id"], folds=2)
    assert len(found) == 3 and found[0][1] > 0.8
    assert [ml.positive_weight({"class_weight": w}) for w in ml.FOREST_GRID["class_weight"]] == [1.0, None, None, 3.0, 5.0]
    forest = model.bestModel.stages[-1]
    assert forest.getNumTrees == 3 and forest.getOrDefault("maxDepth") == ml.DEEPEST


def test_predicting_goes_on_after_an_error(spark, tmp_path):
    df = labelled_squares(spark, 200)
    model = boosting.train(df, ["a", "b"], files.DEFAULTS | {"n_estimators": 2, "max_depth": 2})
    cells = df.select(F.lit("x").alias("raster_id"), (F.col("id") % 10).cast("int").alias("r"), F.floor(F.col("id") / 10).cast("int").alias("c"), "a", "b")
    found = plan.predict_each(spark, model, [("bad", lambda: cells.select("missing")), ("good", lambda: cells)], ["a", "b"], str(tmp_path))
    assert [x[:2] for x in found] == [("bad", "FAILED"), ("good", "SUCCESS")]
    assert spark.read.parquet(str(tmp_path / "good")).filter("probability between 0 and 1").count() == 200


def test_batch_isolates_failures(spark):
    def fail():
        raise ValueError("no raster")

    done = plan.batch(spark, [("one", lambda: None), ("two", fail), ("three", lambda: None)])
    assert [x[1] for x in done] == ["SUCCESS", "FAILED", "SUCCESS"] and "no raster" in done[1][3]
    assert [x[1] for x in plan.batch(spark, [("two", fail), ("three", lambda: None)], keep_going=False)] == ["FAILED", "SKIPPED"]


def test_stream_of_new_files(spark, tmp_path):
    schema = T.StructType([T.StructField("v", T.LongType())])
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for n in (3, 2):
        spark.range(n).toDF("v").write.mode("append").parquet(source)
        q = tiles.process_new_files(spark, source, schema, lambda df: df.withColumn("w", F.col("v") * 2), target, str(tmp_path / "check"))
        q.awaitTermination(60)
    assert spark.read.parquet(target).count() == 5


def test_stream_of_events(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    q = tiles.windowed_means(stream, "10 days").writeStream.format("memory").queryName("means").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.sql("SELECT sum(n) FROM means").first()[0] == events.count()


def test_replaced_tables_survive_a_failed_move(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in (3, 5):
        files.replace_table(spark, spark.range(n), path)
        assert spark.read.parquet(path).count() == n
    files.replace_table(spark, spark.read.parquet(path).filter("id > 0"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]
    # A run that was cut off between the two moves.
    (tmp_path / "t").rename(tmp_path / "t__old")
    files.replace_table(spark, spark.range(2), path)
    assert spark.read.parquet(path).count() == 2 and not (tmp_path / "t__old").exists()
    # A place that can't be moved to: the parent is a file.
    (tmp_path / "f").write_text("")
    with pytest.raises(Exception, match="f"):
        files.replace_table(spark, spark.range(2), f"{tmp_path}/f/t")
