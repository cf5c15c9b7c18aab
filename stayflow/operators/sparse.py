"""Categorical features as sparse vectors, chosen from level counts, for any number of levels.

No wide frame is built and no list of levels reaches the driver. A table of levels is the
whole fit: each level of each column has its counts and the slots of a vector that it
fills, with a value for each slot (1 for one-hot, a code for the other encoders). Rows
become (row, column, level) triples, meet that table in one join for all columns, and are
gathered to one sparse vector per row. Levels that many rows share are joined from a
broadcast list that is bounded by their share of the rows; the others are joined by key.

The choice of slots by correlation needs level counts, counts of pairs of levels in a row,
and sums of codes per level, never the columns themselves.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stayflow.functions.columns import ratio
from stayflow.operators.categorical import METHODS, encoder_codes, fit_rare, interactions
from stayflow.operators.levels import ROW as _ROW, join_levels, numbered
from stayflow.operators.ordered import global_rank
from stayflow.operators.prep import late_of_pairs, impute
from stayflow.operators.stats import long_levels, pair_correlations, per_column
from stayflow.session import materialize, new_folder


def as_vectors(df: DataFrame, size: int, name: str = "features", places: str = "_places", values: str = "_values") -> DataFrame:
    """Arrays of places and values as Spark ML's sparse vectors, without a Python worker.

    The vector type is stored as a struct; written as one and read under the vector type.
    """
    spark = df.sparkSession
    cell = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"), F.col(places).cast("array<int>").alias("indices"), F.col(values).cast("array<double>").alias("values"))
    stored = df.withColumn(name, cell).drop(places, values)
    path = new_folder(spark, "vectors")
    stored.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == name else f.dataType) for f in stored.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def gather(rows: DataFrame, cells: DataFrame, keep: Sequence[str], size: int, name: str = "features") -> DataFrame:
    """One vector per numbered row from (_row, slot, value) cells; rows without a cell get zeros."""
    cell = F.struct(F.col("slot").cast("int").alias("slot"), F.col("value").cast("double").alias("value"))
    found = cells.filter("value <> 0").groupBy(_ROW).agg(F.array_sort(F.collect_list(cell)).alias("_cells"))  # at most one cell for each column and branch
    joined = rows.select(_ROW, *keep).join(found, _ROW, "left")
    out = joined.select(*keep, F.coalesce(F.col("_cells.slot"), F.array().cast("array<int>")).alias("_places"), F.coalesce(F.col("_cells.value"), F.array().cast("array<double>")).alias("_values"))
    return as_vectors(out, size, name)


def level_table(train: DataFrame, cols: Sequence[str], label: str | None = None) -> DataFrame:
    """(feature, level, n, y, total, ones, share): counts of all levels, pre-aggregated where the rows lie."""
    y = F.col(label).cast("double") if label else F.lit(0.0)
    counts = long_levels(train, cols, [y.alias("_y")]).filter("level IS NOT NULL").groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("y"))
    whole = train.agg(F.count(F.lit(1)).alias("total"), F.sum(y).alias("ones"))
    counts = counts.crossJoin(F.broadcast(whole))  # one row
    return materialize(counts.withColumn("share", ratio(F.col("n"), F.col("total"))), "levels")


def slots(levels: DataFrame) -> DataFrame:
    """Adds ``slot``: the levels' places 0, 1, 2 ... by column and level."""
    return global_rank(levels, [F.col("feature"), F.col("level")], "_rank").withColumn("slot", (F.col("_rank") - 1).cast("int")).drop("_rank")


# --- the choice among one-hot slots ---


def _pearson(n_both: Column, n_a: Column, n_b: Column, total: Column) -> Column:
    """Correlation of two 0/1 columns from their counts."""
    return ratio(total * n_both - n_a * n_b, F.sqrt(n_a * (total - n_a)) * F.sqrt(n_b * (total - n_b)))


def one_hot_target(levels: DataFrame) -> DataFrame:
    """Adds ``corr``: the correlation of each level's 0/1 column with the label."""
    n, y, total, ones = (F.col(c).cast("double") for c in ("n", "y", "total", "ones"))
    return levels.withColumn("corr", ratio(total * y - n * ones, F.sqrt(n * (total - n)) * F.sqrt(ones * (total - ones))))


def one_hot_pairs(rows: DataFrame, cols: Sequence[str], levels: DataFrame, least: float) -> DataFrame:
    """(slot_a, slot_b, corr) of all pairs of 0/1 columns with \\|corr\\| above ``least``.

    Pairs of levels are counted where they meet in a row. Before that, pairs go whose
    sizes alone keep them below the limit. Levels that never meet are negatively
    correlated; that exceeds a limit only beside a level of a good part of the rows, so
    those few levels are compared with all others, again from counts.
    """
    limit = F.lit(float(least))
    odds = lambda n, total: n / (total - n)

    def possible(n_a: Column, n_b: Column, total: Column) -> Column:
        low, high = odds(F.least(n_a, n_b), total), odds(F.greatest(n_a, n_b), total)
        apart = F.greatest(n_a + n_b - total, F.lit(0))  # rows that must hold both
        return (low / high > limit * limit * 0.999999) | (_pearson(apart, n_a, n_b, total) < -limit * 0.999999)

    usable = levels.filter("n < total")  # a constant column has no correlation
    seen = join_levels(rows, cols, usable, ["slot", "n", "total"])
    met = seen.groupBy(_ROW).agg(F.array_sort(F.collect_list(F.struct("slot", "n", "total"))).alias("s"))  # one entry for each column
    later = lambda a, i: F.transform(F.filter(F.slice("s", i + 2, F.size("s")), lambda b: possible(a["n"], b["n"], a["total"])), lambda b: F.struct(a["slot"].alias("slot_a"), b["slot"].alias("slot_b")))
    pairs = met.select(F.explode(F.flatten(F.transform("s", later))).alias("p")).select("p.*")
    counted = pairs.groupBy("slot_a", "slot_b").agg(F.count(F.lit(1)).alias("both"))

    # a pair that never meets needs odds whose product reaches the limit's square, so one of the two has a good part of the rows
    large = usable.filter(odds(F.col("n"), F.col("total")) > limit * 0.999).select(F.col("slot").alias("large"), F.col("n").alias("n_large"))
    large = [(r["large"], r["n_large"]) for r in large.collect()]  # less than two and a bit for each column
    if large:
        listed = F.array(*(F.struct(F.lit(s).alias("large"), F.lit(n).alias("n_large")) for s, n in large))
        candidate = usable.select("slot", "n", "total", F.explode(listed).alias("l")).select("slot", "n", "total", "l.*").filter("slot <> large")
        candidate = candidate.filter(odds(F.col("n"), F.col("total")) * odds(F.col("n_large"), F.col("total")) > limit * limit * 0.999)
        apart = candidate.select(F.least("slot", "large").alias("slot_a"), F.greatest("slot", "large").alias("slot_b")).distinct()
        counted = counted.unionByName(apart.join(counted, ["slot_a", "slot_b"], "left_anti").withColumn("both", F.lit(0).cast("bigint")))
    side = lambda x: usable.select(F.col("slot").alias(f"slot_{x}"), F.col("n").alias(f"n_{x}"), *(["total"] if x == "a" else []))
    sized = counted.join(side("a"), "slot_a").join(side("b"), "slot_b")
    corr = _pearson(F.col("both"), F.col("n_a"), F.col("n_b"), F.col("total"))
    return sized.select("slot_a", "slot_b", corr.alias("corr")).filter(F.round(F.abs("corr"), 9) > limit)


def survivors(outputs: DataFrame, pairs: DataFrame, branches: bool = True) -> DataFrame:
    """The rows of ``outputs`` (id, name, corr, branch) that the pair rule leaves, decided in Spark.

    Outputs are ordered by \\|corr\\|, then name; the later of each pair goes, first of
    pairs within a branch, then of pairs among what is left. ``pairs`` is (id_a, id_b).
    """
    rank = F.struct((-F.round(F.abs("corr"), 9)).alias("r"), F.col("name"), F.col("id"))
    side = lambda x: outputs.select(F.col("id").alias(f"id_{x}"), rank.alias(f"place_{x}"), F.col("branch").alias(f"branch_{x}"))
    both = pairs.join(side("a"), "id_a").join(side("b"), "id_b")
    first = F.col("place_a") < F.col("place_b")
    ruled = both.select(
        F.when(first, F.col("id_b")).otherwise(F.col("id_a")).alias("late"), F.when(first, F.col("id_a")).otherwise(F.col("id_b")).alias("early"),
        (F.col("branch_a") == F.col("branch_b")).alias("same"),
    )
    ruled = materialize(ruled, "ruled")
    left = outputs
    if branches:
        gone = ruled.filter("same").select(F.col("late").alias("id")).distinct()
        left = outputs.join(gone, "id", "left_anti")
        ruled = ruled.join(gone.withColumnRenamed("id", "early"), "early", "left_anti")
    return left.join(ruled.select(F.col("late").alias("id")).distinct(), "id", "left_anti")


def one_hot_choice(train: DataFrame, cols: Sequence[str], label: str = "status", target_threshold: float = 0.005, feature_threshold: float = 0.90) -> DataFrame:
    """(feature, level, n, corr) of the 0/1 columns that the two rules keep, for any number of levels."""
    rows = numbered(train.select(label, *cols))
    levels = one_hot_target(slots(level_table(rows, cols, label)))
    strong = materialize(levels.filter(F.round(F.abs("corr"), 9) >= target_threshold), "strong-levels")
    pairs = one_hot_pairs(rows, cols, strong, feature_threshold)
    outputs = strong.withColumns({"id": F.col("slot"), "name": F.col("slot"), "branch": F.lit("one_hot")})
    kept = survivors(outputs, pairs.select(F.col("slot_a").alias("id_a"), F.col("slot_b").alias("id_b")), branches=False)
    return kept.select("feature", "level", "n", "corr")


def one_hot_rows(df: DataFrame, chosen: DataFrame, cols: Sequence[str], keep: Sequence[str], train_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(keep..., features) with a slot for each chosen level, and the slots' (slot, name, feature, level)."""
    total = float(train_rows or df.count())
    placed = materialize(slots(chosen.select("feature", "level", (F.col("n") / total).alias("share"))), "slots")
    size = placed.count()
    rows = numbered(df.select(*keep, *cols))
    cells = join_levels(rows, cols, placed, ["slot"]).withColumn("value", F.lit(1.0))
    return gather(rows, cells, keep, size), placed.select("slot", F.concat_ws("_", "feature", "level").alias("name"), "feature", "level")


# --- pre-processing and the whole categorical pipeline, sparse ---


def process_sparse(df: DataFrame, catalog, keep: Sequence[str] = ("chc_id", "status"), exclude: Sequence[str] | None = None, name: str = "features") -> tuple[DataFrame, DataFrame]:
    """Impute, drop incomplete rows, cast, one-hot, drop zero-variance columns: (keep..., vector) and (slot, name).

    The numbers come first, then the levels by column and name. A 0/1 column is constant
    where all rows or none have the level, which the counts tell.
    """
    from stayflow.catalog import NOT_FEATURES

    exclude = NOT_FEATURES if exclude is None else exclude
    cols = catalog.features([c for c in df.columns if c not in exclude])
    ready = impute(df, catalog, exclude).select(*keep, *cols).na.drop("any", subset=cols)
    texts, numbers = catalog.of_kind("CAT", cols), catalog.of_kind("NUM", cols)
    rows = numbered(ready.select(*keep, *(F.col(c).cast("double").alias(c) for c in numbers), *(F.col(c).cast("string").alias(c) for c in texts)))
    flat = per_column(rows, numbers, {"variance": F.var_samp}).filter("variance = 0").collect() if numbers else []
    numbers = [c for c in numbers if c not in {r["feature"] for r in flat}]
    named = [(i, c) for i, c in enumerate(numbers)]
    names = df.sparkSession.createDataFrame(named, "slot int, name string")
    cells = rows.select(_ROW, F.inline(F.array(*(F.struct(F.lit(i).alias("slot"), F.col(c).alias("value")) for i, c in named)))) if named else None
    if texts:
        levels = level_table(rows, texts).filter("n < total")
        placed = materialize(slots(levels).withColumn("slot", F.col("slot") + len(numbers)), "slots")
        ones = join_levels(rows, texts, placed, ["slot"]).select(_ROW, "slot", F.lit(1.0).alias("value"))
        cells = ones if cells is None else cells.unionByName(ones)
        names = names.unionByName(placed.select("slot", F.concat_ws("_", "feature", "level").alias("name")))
    if cells is None:
        raise ValueError("no columns to process")
    return gather(rows, cells, keep, names.count(), name), names


def categorical_pipeline(
    train: DataFrame, first: Sequence[str], second: Sequence[str], cols: Sequence[str], label: str = "status", key: str = "chc_id",
    target_threshold: float = 0.005, feature_threshold: float = 0.90, min_pct: float = 0.01, max_count: int | None = 30, methods: Sequence[str] = METHODS,
) -> tuple[DataFrame, DataFrame]:
    """Interactions, rare levels, encoders and one-hot, thinned: (key, label, features) and (slot, name, branch, corr).

    ``max_count`` of None keeps every level. The encoders are one number column each, so
    their correlations come from level codes joined to the rows; 0/1 columns are compared
    by counts, and with the encoders by the codes' sums per level.
    """
    inter = interactions(first, second).outputs
    wide = [*cols, *inter]
    frame = train.withColumns(inter)
    if max_count is not None:
        frame = fit_rare(frame, wide, min_pct, max_count).apply(frame)
    else:
        frame = frame.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("all_other")) for c in wide})
    quoted = lambda names: [F.col(f"`{n}`") for n in names]
    rows = numbered(frame.select(*quoted([key, label, *wide])))
    simple = {c: f"c{i}" for i, c in enumerate(wide)}  # interaction names may hold any sign
    rows = rows.select(_ROW, *quoted([key, label]), *(F.col(f"`{c}`").cast("string").alias(s) for c, s in simple.items()))
    names = list(simple.values())
    codes = materialize(encoder_codes(rows, names, label, methods), "encoder-codes")
    total = F.col("total").cast("double")
    means = codes.groupBy("name").agg((F.sum(F.col("n") * F.col("code")) / F.max("total")).alias("_m"))
    gap = F.col("code") - F.col("_m")
    sums = codes.join(F.broadcast(means), "name").groupBy("name", "branch", "feature").agg(  # one row per encoder output
        F.sum(F.col("n") * gap * gap).alias("dd"), F.sum(gap * F.col("y")).alias("dy"), F.max(total).alias("n"), F.max("ones").alias("ones"), F.max("_m").alias("_m"),
    )
    corr = ratio(F.col("dy"), F.sqrt(F.col("dd") * (F.col("ones") - F.col("ones") * F.col("ones") / F.col("n"))))
    dense = sums.withColumn("corr", corr).filter(F.round(F.abs("corr"), 9) >= target_threshold)
    dense = {r["name"]: r for r in dense.collect()}  # an encoder output per column and method

    levels = materialize(one_hot_target(slots(level_table(rows, names, label))), "hot-levels")
    strong = levels.filter(F.round(F.abs("corr"), 9) >= target_threshold)
    hot_pairs = one_hot_pairs(rows, names, strong, feature_threshold).select(F.col("slot_a").cast("string").alias("id_a"), F.col("slot_b").cast("string").alias("id_b"))
    outputs = strong.select(F.col("slot").cast("string").alias("id"), F.lit("one_hot").alias("branch"), "corr", "feature", "level", "share")
    pairs = hot_pairs

    if dense:
        wanted = sorted(dense)
        of = codes.filter(F.col("name").isin(wanted))
        listed = of.groupBy("feature", "level").agg(F.collect_list(F.struct("name", "code")).alias("codes"))  # one entry per method
        listed = listed.join(levels.select("feature", "level", "share"), ["feature", "level"])
        cells = materialize(join_levels(rows, names, listed, ["codes"]).select(_ROW, F.inline("codes")), "code-cells")
        table = cells.groupBy(_ROW).agg(*(F.max(F.when(F.col("name") == n, F.col("code"))).alias(f"_{i}") for i, n in enumerate(wanted)))
        table = materialize(rows.select(_ROW).join(table, _ROW, "left").select(_ROW, *(F.coalesce(f"_{i}", F.lit(0.0)).alias(f"_{i}") for i in range(len(wanted)))), "codes")
        back = F.array(*(F.lit(n) for n in wanted))
        at = lambda c: F.element_at(back, F.substring(c, 2, 10).cast("int") + 1)
        close = pair_correlations(table, [f"_{i}" for i in range(len(wanted))], least=feature_threshold)
        pairs = pairs.unionByName(close.select(at("col_a").alias("id_a"), at("col_b").alias("id_b")))
        # an encoder output against a 0/1 column: the sum of the output over the rows of the level
        facts = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(float(dense[n]["_m"])).alias("m"), F.lit(float(dense[n]["dd"])).alias("dd")) for n in wanted))
        hits = join_levels(rows, names, strong, ["slot"]).join(table, _ROW)
        added = hits.groupBy("slot").agg(*(F.sum(F.col(f"_{i}") - float(dense[n]["_m"])).alias(f"_{i}") for i, n in enumerate(wanted)))
        long = added.select("slot", F.posexplode(F.array(*(F.col(f"_{i}") for i in range(len(wanted))))).alias("i", "d")).withColumn("f", F.get(facts, F.col("i")))
        mixed = long.join(strong.select("slot", "n", "total"), "slot")
        size = F.col("n").cast("double")
        r = ratio(F.col("d"), F.sqrt(F.col("f.dd")) * F.sqrt(size - size * size / F.col("total")))
        pairs = pairs.unionByName(mixed.filter(F.round(F.abs(r), 9) > feature_threshold).select(F.col("slot").cast("string").alias("id_a"), F.col("f.name").alias("id_b")))
        fixed = rows.sparkSession.createDataFrame([(n, r["branch"], r["corr"], r["feature"]) for n, r in dense.items()], "id string, branch string, corr double, feature string")
        outputs = outputs.unionByName(fixed.withColumns({"level": F.lit(None).cast("string"), "share": F.lit(None).cast("double")}))

    shown = _shown_names(outputs, simple)
    kept = survivors(shown, pairs)
    kept = materialize(global_rank(kept, [F.col("branch"), F.col("name")], "_rank").withColumn("slot", (F.col("_rank") - 1).cast("int")).drop("_rank"), "kept-outputs")
    ones = kept.filter("level IS NOT NULL").select("feature", "level", "share", "slot")
    cells_out = join_levels(rows, names, ones, ["slot"]).select(_ROW, "slot", F.lit(1.0).alias("value"))
    if dense:
        encoded = cells.join(F.broadcast(kept.filter("level IS NULL").select(F.col("id").alias("name"), "slot")), "name")  # one row per encoder output
        cells_out = cells_out.unionByName(encoded.select(_ROW, "slot", F.col("code").alias("value")))
    out = gather(rows, cells_out, [key, label], kept.count())
    return out, kept.select("slot", "name", "branch", "corr")


def _shown_names(outputs: DataFrame, simple: Mapping[str, str]) -> DataFrame:
    """Adds ``name``: the output's name with its column's own name in place of the short one."""
    own = F.create_map(*(x for c, s in simple.items() for x in (F.lit(s), F.lit(c))))
    real = own[F.col("feature")]
    name = F.when(F.col("level").isNotNull(), F.concat_ws("_", real, F.col("level"))).otherwise(F.concat(F.upper("branch"), F.lit("_"), real))
    return materialize(outputs.withColumn("name", name), "outputs")
