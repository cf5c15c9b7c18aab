"""Tiled correlations, decisions in Spark, sparse categories, markets decided in tasks, codes joined once."""
import random

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import functions as F

from stayflow.catalog import Catalog
from stayflow.operators import categorical as ca, numeric as nu, prep, sparse, stats as st


@pytest.fixture(scope="module")
def numbers(spark):
    """40 columns, some copies, multiples, gaps, a constant and an empty one."""
    rng = np.random.default_rng(4)
    x = rng.normal(1e6, 1.0, (500, 40))
    x[:, 7] = 2 * x[:, 3] + 1
    x[:, 20] = x[:, 5] + rng.normal(0, 0.2, 500)
    x[:, 33] = -x[:, 12]
    x[rng.random(x.shape) < 0.05] = np.nan
    x[:, 10], x[:, 11] = 3.0, np.nan
    names = [f"x{i}" for i in range(40)]
    rows = [(i, int(i % 3 == 0), f"m{i % 4}", *(None if np.isnan(v) else float(v) for v in r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "chc_id long, status int, market string, " + ", ".join(f"{n} double" for n in names)).repartition(3), x, names


def brute_pairs(x):
    out = {}
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[ok, i], x[ok, j]
            out[i, j] = None if ok.sum() < 2 or a.std() < 1e-6 or b.std() < 1e-6 else float(np.corrcoef(a, b)[0, 1])
    return out


@pytest.mark.parametrize("tile", [7, 16, 256])
def test_tiles_give_all_pairs(numbers, tile):
    df, x, names = numbers
    got = {(names.index(r["col_a"]), names.index(r["col_b"])): r["corr"] for r in st.pair_correlations(df, names, tile=tile).collect()}
    expect = brute_pairs(x)
    assert set(got) == set(expect)
    assert all((got[k] is None) == (v is None) and (v is None or abs(got[k] - v) < 1e-6) for k, v in expect.items())
    strong = {(r["col_a"], r["col_b"]) for r in st.pair_correlations(df, names, least=0.9, tile=tile).collect()}
    assert strong == {(names[i], names[j]) for (i, j), v in expect.items() if v is not None and abs(v) > 0.9}


def test_target_correlation_of_many_columns(numbers):
    df, x, names = numbers
    few = {r["feature"]: r["corr"] for r in st.target_correlation(df, names, "status").collect()}
    many = {r["feature"]: r["corr"] for r in st.wide_target_correlation(df, names, "status").collect()}
    assert set(few) == set(many) and all((few[c] is None) == (many[c] is None) and (few[c] is None or abs(few[c] - many[c]) < 1e-7) for c in few)


def test_a_task_of_a_tile_holds_two_blocks_only(spark, numbers):
    df, x, names = numbers
    made = list(st._tile_products([0, 1], [5, 6, 7])(iter(__import__("pyarrow").RecordBatch.from_pandas(df.select("x0", "x1", "x5", "x6", "x7").toPandas()) for _ in range(1))))
    assert [b.num_rows for b in made] == [6]


def test_collinear_choice_equals_the_plain_rule(numbers):
    df, x, names = numbers
    corr = {r["feature"]: r["corr"] for r in st.target_correlation(df, names, "status").collect()}
    order = prep.correlation_order(corr)
    pairs = {frozenset((names[i], names[j])): v for (i, j), v in brute_pairs(x).items()}
    expect = prep.collinear(order, pairs, 0.9)
    choice = prep.drop_correlated(df, 0.9, "status")
    assert sorted(choice.dropped) == sorted({late for late, _, _ in expect})
    assert {(r["drop_feature"], r["corr_feature"]) for r in choice.report.collect()} == {(a, b) for a, b, _ in expect}


def test_branches_are_thinned_by_themselves_and_then_together(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=300)
    cols = {"a1": base, "a2": base + 0.01 * rng.normal(size=300), "b1": base * 3, "b2": rng.normal(size=300), "c1": -base}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values())], ", ".join(f"{c} double" for c in cols))
    strong = {"a1": 0.5, "a2": 0.6, "b1": 0.7, "b2": 0.1, "c1": 0.4}
    # a2 beats a1 inside its branch; b1, the strongest, then beats a2 and c1
    assert nu.thin_branches(df, strong, [["a1", "a2"], ["b1", "b2"], ["c1"]], 0.9) == ["b1", "b2"]
    # without b1 inside the second round, the loser of the first does not count there any more
    assert nu.thin_branches(df, {k: v for k, v in strong.items() if k != "b1"}, [["a1", "a2"], ["b2"], ["c1"]], 0.9) == ["a2", "b2"]
    assert nu.thin_branches(df, {"b2": 0.1}, [["b2"]], 0.9) == ["b2"] and nu.thin_branches(df, {}, [[]], 0.9) == []


def test_every_market_is_decided_as_if_alone(spark, numbers):
    df, _, names = numbers
    df = df.withColumns({"text": F.when(F.col("market") == "m1", "k").otherwise(F.col("chc_id").cast("string")), "copy": F.when(F.col("chc_id") % 50 == 2, "z").otherwise(F.col("chc_id").cast("string"))})
    df = df.withColumn("copy", F.when(F.col("market") == "m3", F.col("text")).otherwise(F.col("copy"))).withColumn("x1", F.when(F.col("market") == "m0", F.lit(None).cast("double")).otherwise(F.col("x1")))
    df = df.select("chc_id", "status", "market", *names[:14], "text", "copy")
    catalog = Catalog.from_schema(df)
    got = {}
    for r in prep.fit_pipeline_by(df, catalog, ["market"]).collect():
        got.setdefault(r["market"], {})[r["feature"]] = r["fate"]
    assert set(got) == {"m0", "m1", "m2", "m3"} and got["m0"]["x1"] == "missing" and got["m1"]["text"] == "constant" and got["m3"]["text"] == "duplicate"
    for market, fates in got.items():
        alone = prep.fit_pipeline(df.filter(F.col("market") == market).drop("market"), catalog)[()]
        assert fates == dict(alone)


def test_partial_sums_of_many_groups(spark, monkeypatch):
    rows = [(g, float(i), float(i * g % 7)) for g in range(60) for i in range(9)]
    df = spark.createDataFrame(rows, "g int, a double, b double").repartition(2)
    whole = {r["g"]: r["corr"] for r in st.pair_correlations(df, ["a", "b"], ["g"]).collect()}
    monkeypatch.setattr(st, "GROUP_BYTES", 300)  # two groups at a time
    parts = {r["g"]: r["corr"] for r in st.pair_correlations(df, ["a", "b"], ["g"]).collect()}
    assert len(whole) == 60 and all(parts[g] == pytest.approx(v) if v is not None else parts[g] is None for g, v in whole.items())


@pytest.fixture(scope="module")
def levels_frame(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        a = rng.choice(["p", "q", "r", None])
        rows.append((i, int(rng.random() < (0.7 if a == "p" else 0.3)), a, a if i % 40 else "odd", rng.choice(["yes"] * 9 + ["no"]), f"id{i}"))
    rows.append((5, 1, "p", "p", "yes", "id5"))  # a repeated key
    return spark.createDataFrame(rows, "chc_id long, status int, a string, b string, flag string, own string").repartition(3)


def brute_one_hot(df, cols, target, feature):
    rows = df.collect()
    y = np.array([r["status"] for r in rows], float)
    names = sorted({(c, r[c]) for c in cols for r in rows if r[c] is not None})
    x = {n: np.array([r[n[0]] == n[1] for r in rows], float) for n in names}
    corr = {n: np.corrcoef(v, y)[0, 1] for n, v in x.items() if v.std() > 0}
    order = sorted((n for n, v in corr.items() if round(abs(v), 9) >= target), key=lambda n: (-round(abs(corr[n]), 9), n))
    late = {order[j] for j in range(len(order)) for i in range(j) if round(abs(np.corrcoef(x[order[i]], x[order[j]])[0, 1]), 9) > feature}
    return {n for n in order if n not in late}


@pytest.mark.parametrize("cols", [["a", "b", "flag"], ["a", "b", "flag", "own"]])
def test_one_hot_choice_equals_dense_columns(levels_frame, cols):
    got = {(r["feature"], r["level"]) for r in sparse.one_hot_choice(levels_frame, cols, "status", 0.01, 0.8).collect()}
    assert got == brute_one_hot(levels_frame, cols, 0.01, 0.8)
    assert len({v for f, v in got if f == "flag"}) <= 1  # yes and no never meet, and say the same


def test_chosen_levels_become_sparse_vectors(spark, levels_frame):
    chosen = sparse.one_hot_choice(levels_frame, ["a", "own"], "status", 0.01, 0.95)
    vectors, names = sparse.one_hot_rows(levels_frame, chosen, ["a", "own"], ["chc_id"])
    assert isinstance(vectors.schema["features"].dataType, VectorUDT)
    slot = {(r["feature"], r["level"]): r["slot"] for r in names.collect()}
    source = {}
    for r in levels_frame.collect():
        source.setdefault(r["chc_id"], []).append(tuple(sorted(slot[k] for k in (("a", r["a"]), ("own", r["own"])) if k in slot)))
    got = {}
    for r in vectors.collect():
        assert isinstance(r["features"], SparseVector) and r["features"].size == len(slot) and set(r["features"].values) <= {1.0}
        got.setdefault(r["chc_id"], []).append(tuple(int(i) for i in r["features"].indices))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in source.items()}
    fresh = spark.createDataFrame([(1, "never", None)], "chc_id long, a string, own string")
    assert sparse.one_hot_rows(fresh, chosen, ["a", "own"], ["chc_id"], 601)[0].first()["features"].numNonzeros() == 0


def test_sparse_vectors_train_a_model(levels_frame):
    from pyspark.ml.classification import LogisticRegression

    rows, names = sparse.categorical_pipeline(levels_frame, ["a"], ["a", "flag"], ["a", "b", "flag"], min_pct=0.01, max_count=30)
    assert rows.count() == 601 and names.count() == rows.first()["features"].size
    model = LogisticRegression(labelCol="status", maxIter=5).fit(rows)
    assert model.summary.areaUnderROC > 0.6


def test_sparse_process_equals_the_wide_one(spark, levels_frame):
    df = levels_frame.withColumns({"n1": F.when(F.col("chc_id") % 7 > 0, F.col("chc_id") * 1.5), "same": F.lit(4.0), "const": F.lit("c")}).drop("own")
    catalog = Catalog.from_schema(df)
    wide = prep.process_data(df, catalog)
    vectors, names = sparse.process_sparse(df, catalog)
    order = [r["name"] for r in names.orderBy("slot").collect()]
    assert sorted(order) == sorted(wide.columns[2:])
    dense = sorted((r["chc_id"], r["status"], *(float(r["features"][order.index(c)]) for c in wide.columns[2:])) for r in vectors.collect())
    assert dense == sorted((r["chc_id"], r["status"], *(float(r[c]) for c in wide.columns[2:])) for r in wide.collect())


def test_long_and_short_code_lists_give_the_same(spark, levels_frame, monkeypatch):
    fitted = {m: ca.fit_encoder(levels_frame, ["a", "own"], m, "status") for m in ("pct", "y_log_ratio")}
    rare = ca.fit_rare(levels_frame, ["a", "b"], 0.05, 2, "common")
    frame = levels_frame.withColumn("a", F.when(F.col("chc_id") == 3, "never").otherwise(F.col("a")))
    apply = lambda: [sorted(map(str, f.apply(frame).select(levels_frame.columns).collect())) for f in (*fitted.values(), rare)]
    joined = None
    for limit in (0, 10_000):
        monkeypatch.setattr(ca, "LITERAL_LEVELS", limit)
        joined, before = apply(), joined
        assert before is None or before == joined


def test_views_before_selection(levels_frame):
    df = levels_frame.withColumn("n1", F.col("chc_id") * 2.0)
    catalog = Catalog.from_schema(df)
    num, cat, both = (set(prep.selection_view(df, catalog, v, ["n1", "a", "nowhere"]).columns[2:]) for v in ("NUM", "CAT", "ALL"))
    assert num == {"n1"} and cat == {"a_p", "a_q", "a_r", "a_UNKNOWN"} and both == num | cat
    with pytest.raises(ValueError):
        prep.selection_view(df, catalog, "OTHER")


def product_sums(x, left, right):
    """n, sx, sy, sxx, syy and sxy of every pair of columns, over the rows that have both."""
    out = {}
    for i in left:
        for j in right:
            if list(left) != list(right) or i < j:
                ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
                a, b = x[ok, i], x[ok, j]
                out[i, j] = ok.sum(), a.sum(), b.sum(), a @ a, b @ b, a @ b
    return out


@pytest.mark.parametrize("left, right", [([0, 1, 2, 3, 4], [0, 1, 2, 3, 4]), ([0, 1], [2, 3, 4]), ([0], [1, 2, 3, 4])])
@pytest.mark.parametrize("packed", [True, False])
def test_gaps_that_come_late_count_from_there_on(left, right, packed, monkeypatch):
    import pyarrow as pa

    x = np.random.default_rng(2).normal(3, 2, (60, 5))
    x[20:30, 1] = x[25:50, 3] = np.nan  # not in the first slice, and not in the same one
    monkeypatch.setattr(st, "SLICE", 50)
    columns = [pa.array(list(map(list, x)), pa.list_(pa.float64()))] if packed else [pa.array(c) for c in x.T]
    batches = [pa.RecordBatch.from_arrays([c.slice(a, 30) for c in columns], names=[f"c{i}" for i in range(len(columns))]) for a in (0, 30)]
    made = pa.Table.from_batches(st._tile_products(left, right)(iter(batches))).to_pylist()
    expect = product_sums(x, left, right)
    assert {(r["i"], r["j"]) for r in made} == set(expect)
    assert all(np.allclose([r[s] for s in ("n", "sx", "sy", "sxx", "syy", "sxy")], expect[r["i"], r["j"]]) for r in made)


def test_blocks_hold_as_many_tiles_as_have_room(numbers, monkeypatch):
    df, x, names = numbers
    expect = brute_pairs(x)
    calls, real = [], st._summed_products
    monkeypatch.setattr(st, "_summed_products", lambda *a: calls.append(a) or real(*a))
    for room, jobs in ((64 << 20, 1), (48 * 14 * 14, 6)):  # all tiles in one pass; blocks of two tiles of 7 columns
        monkeypatch.setattr(st, "GROUP_BYTES", room)
        got = {(names.index(r["col_a"]), names.index(r["col_b"])): r["corr"] for r in st.pair_correlations(df, names, tile=7).collect()}
        assert set(got) == set(expect) and all((got[k] is None) == (v is None) and (v is None or abs(got[k] - v) < 1e-6) for k, v in expect.items())
        assert len(calls) == jobs
        calls.clear()


def test_a_wide_table_is_stored_in_a_few_arrays(spark):
    from stayflow.session import PACK, materialize_wide

    k = PACK + 2
    rows = [(i, i * 1.5, f"t{i}", *(None if (i + j) % 7 == 0 else float("nan") if j == 5 else float(i * j) for j in range(k))) for i in range(4)]
    df = spark.createDataFrame(rows, "chc_id long, `a.b` double, text string, " + ", ".join(f"f{j} double" for j in range(k)))
    stored = materialize_wide(df, "wide-test")
    assert stored.columns == df.columns and stored.dtypes == df.dtypes
    assert sorted(map(str, stored.collect())) == sorted(map(str, df.collect()))
    assert len(spark.read.parquet(stored.inputFiles()[0].rsplit("/", 1)[0]).columns) == 2 + 2


def test_many_columns_are_read_once_for_all_pairs_and_not_stored_again(spark, monkeypatch):
    from stayflow import session

    rng = np.random.default_rng(6)
    k, rows = 2 * st.TILE + 8, 40
    x = rng.normal(50, 5, (rows, k))
    x[:, 9], x[:, 300] = 2 * x[:, 4] - 1, x[:, 17] + rng.normal(0, 0.5, rows)
    x[::9, 4], x[3, 100], x[:, 11] = np.nan, np.nan, 7.0
    names = [f"x{i:03d}" for i in range(k)]
    df = spark.createDataFrame([(i, i % 2, *(None if np.isnan(v) else float(v) for v in r)) for i, r in enumerate(x)], "chc_id long, status int, " + ", ".join(f"{n} double" for n in names))
    tags, real = [], session.new_folder
    monkeypatch.setattr(session, "new_folder", lambda spark, tag: tags.append(tag) or real(spark, tag))
    choice = prep.drop_correlated(df, 0.9, "status")
    order = prep.correlation_order({r["feature"]: r["corr"] for r in st.target_correlation(df, names, "status").collect()})
    expect = prep.collinear(order, {frozenset((names[i], names[j])): v for (i, j), v in brute_pairs(x).items()}, 0.9)
    assert {(r["drop_feature"], r["corr_feature"]) for r in choice.report.collect()} == {(a, b) for a, b, _ in expect} and len(expect) >= 2
    assert "numbers" not in tags and "collinear" in tags
