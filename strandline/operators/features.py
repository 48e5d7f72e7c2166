"""Model-ready features, folds, leakage and drift audits, assessment, clustering and rules."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.timesem import md5_unit
from strandline.operators.inference import ks, psi, rank_table
from strandline.operators.sums import column_quantiles, prefix_sums
from strandline.sources.tables import persisted


def build_features(aligned: DataFrame, keys: list[str], item: str, value: str, tiebreak: str, items: list[str], low: float, high: float) -> DataFrame:
    """Per key and item min, max, mean, first, last, count of clipped values and <item>__measured, in one pass."""
    v = F.least(F.greatest(F.col(value), F.lit(low)), F.lit(high))
    at = F.struct("hours_since_anchor", tiebreak)
    aggs = []
    for i in items:
        x = F.when(F.col(item) == i, v)
        t = F.when(F.col(item) == i, at)
        aggs += [F.min(x).alias(f"{i}_min"), F.max(x).alias(f"{i}_max"), F.avg(x).alias(f"{i}_mean"), F.min_by(x, t).alias(f"{i}_first"), F.max_by(x, t).alias(f"{i}_last"), F.count(x).alias(f"{i}_count"), (F.count(x) > 0).alias(f"{i}__measured")]
    return aligned.groupBy(*keys).agg(*aggs)


def one_hot(df: DataFrame, col: str, levels: list[str]) -> DataFrame:
    """Explicit levels as 0/1 columns; unknown and NULL give all zeros."""
    return df.select("*", *[F.coalesce((F.col(col) == v).cast("int"), F.lit(0)).alias(f"{col}={v}") for v in levels])


def leakage(df: DataFrame, contributed: str, cutoff: str, label_time: str) -> DataFrame:
    """One row: rows with a contribution at or after the cutoff, rows whose label lies before it."""
    return df.agg(F.count_if(F.col(contributed) >= F.col(cutoff)).alias("late_features"), F.count_if(F.col(label_time) < F.col(cutoff)).alias("early_labels"))


def normalize(df: DataFrame, train: Column, cols: list[str], how: str = "zscore") -> DataFrame:
    """zscore: distance from the mean in deviations; robust: from the median in interquartile ranges; both of the training rows alone. A column without spread gives 0."""
    if how == "robust":
        q = column_quantiles(df.where(train), cols, [0.25, 0.5, 0.75])
        r = lambda c: F.col(c) * 0.0 if c not in q or q[c][2] == q[c][0] else (F.col(c) - q[c][1]) / (q[c][2] - q[c][0])
        return df.select(*[r(c).alias(c) if c in cols else F.col(c) for c in df.columns])
    if how != "zscore":
        raise ValueError(f"no scaling {how}")
    s = df.where(train).agg(*[f(c).alias(f"_{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    z = lambda c: F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(0.0).alias(c)
    return df.crossJoin(F.broadcast(s)).select(*[z(c) if c in cols else F.col(c) for c in df.columns])  # one row of statistics


def assign_folds(df: DataFrame, subject: str, k: int, seed: str, outcome: Column | None = None) -> DataFrame:
    """subject, fold: whole subjects by the rank of their hash, within each outcome level if one is given, so folds differ by one subject a level."""
    u = df.groupBy(subject).agg(F.max((F.lit(0) if outcome is None else outcome.cast("int"))).alias("_y"))
    # subjects are ranked within 256 hash slices of a level, so a level isn't one window
    h = md5_unit(F.col(subject), seed)
    w = Window.partitionBy("_y", "_c").orderBy("_h", subject)
    return u.withColumn("_h", h).withColumn("_c", F.floor(F.col("_h") * 256)).select(subject, F.pmod(F.row_number().over(w) + F.col("_c"), F.lit(k)).cast("int").alias("fold"))


def subject_overlap(df: DataFrame, subject: str, fold: str) -> DataFrame:
    """One row: subjects in more than one fold."""
    return df.groupBy(subject).agg(F.countDistinct(fold).alias("n")).agg(F.count_if(F.col("n") > 1).alias("overlapping"))


def auroc(df: DataFrame, score: str, label: Column) -> DataFrame:
    """n, positives, auroc by tie-averaged ranks."""
    s = rank_table(df, score, label).agg(F.sum("n").alias("n"), F.sum("n_true").alias("positives"), F.sum(F.col("avg_rank") * F.col("n_true")).alias("_r"))
    p, n = F.col("positives").cast("double"), F.col("n").cast("double")
    return s.select("n", "positives", F.try_divide(F.col("_r") - p * (p + 1) / 2, p * (n - p)).alias("auroc"))


def grouped_auroc(df: DataFrame, keys: list[str], score: str, label: Column) -> DataFrame:
    """keys, n, positives, n_distinct (scores), auroc of every group by tie-averaged ranks, all groups in one pass of keyed running sums; rows without a score are left out."""
    t = df.select(*keys, F.col(score).cast("double").alias("_s"), label.cast("int").alias("_y")).where("_s is not null").groupBy(*keys, "_s").agg(F.count("*").alias("n"), F.sum("_y").alias("_p"))
    r = prefix_sums(t, "_s", ["n"], keys=keys).withColumn("_r", F.col("cum_n") - (F.col("n") - 1) / 2)
    s = r.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("_p").alias("positives"), F.count("*").alias("n_distinct"), F.sum(F.col("_r") * F.col("_p")).alias("_t"))
    p, n = F.col("positives").cast("double"), F.col("n").cast("double")
    return s.select(*keys, "n", "positives", "n_distinct", F.try_divide(F.col("_t") - p * (p + 1) / 2, p * (n - p)).alias("auroc"))


def average_precision(df: DataFrame, score: str, label: Column) -> DataFrame:
    """Area under the precision-recall steps, tied scores taken together."""
    t = df.groupBy(F.col(score).alias("s")).agg(F.count("*").alias("n"), F.count_if(label).alias("p"))
    c = prefix_sums(t, "s", ["n", "p"], descending=True)
    return c.agg(F.try_divide(F.sum(F.col("p") * F.col("cum_p") / F.col("cum_n")), F.sum("p")).alias("auprc"))


def assess_binary(df: DataFrame, score: str, label: Column) -> DataFrame:
    """n, prevalence, brier, log_loss, ece over ten equal bins."""
    p, y = F.col(score), label.cast("double")
    q = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    bins = df.groupBy(F.least(F.floor(p * 10), F.lit(9)).alias("_b")).agg(F.count("*").alias("n"), F.sum(y).alias("y"), F.sum(p).alias("p"), F.sum((p - y) ** 2).alias("b"), F.sum(-(y * F.log(q) + (1 - y) * F.log(1 - q))).alias("l"))
    n = F.sum("n")
    return bins.agg(n.alias("n"), (F.sum("y") / n).alias("prevalence"), (F.sum("b") / n).alias("brier"), (F.sum("l") / n).alias("log_loss"), (F.sum(F.abs(F.col("p") - F.col("y"))) / n).alias("ece"))


def threshold_table(df: DataFrame, score: str, label: Column, cuts: list[float]) -> DataFrame:
    """threshold, alerts, tp, sensitivity, ppv, net_benefit at each cut, from one aggregate."""
    one = df.agg(F.count("*").alias("n"), F.count_if(label).alias("p"), *[f.alias(f"{m}{k}") for k, c in enumerate(cuts) for m, f in (("a", F.count_if(F.col(score) >= c)), ("t", F.count_if((F.col(score) >= c) & label)))])
    rows = [F.struct(F.lit(float(c)).alias("threshold"), F.col(f"a{k}").alias("alerts"), F.col(f"t{k}").alias("tp"), F.try_divide(F.col(f"t{k}"), F.col("p")).alias("sensitivity"), F.try_divide(F.col(f"t{k}"), F.col(f"a{k}")).alias("ppv"), (F.col(f"t{k}") / F.col("n") - (F.col(f"a{k}") - F.col(f"t{k}")) / F.col("n") * (c / (1 - c))).alias("net_benefit")) for k, c in enumerate(cuts)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def assess_regression(df: DataFrame, y: str, p: str) -> DataFrame:
    e = F.col(y) - F.col(p)
    return df.agg(F.count("*").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count("*"))).alias("r2"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: the adjusted Rand index of two labelings, from their contingency table."""
    c2 = lambda n: n * (n - 1) / 2
    t = df.groupBy(a, b).agg(F.count("*").cast("double").alias("n"))
    ra, rb = t.groupBy(a).agg(F.sum("n").alias("n")), t.groupBy(b).agg(F.sum("n").alias("n"))
    s = t.agg(F.sum(c2(F.col("n"))).alias("s"), F.sum("n").alias("n")).crossJoin(ra.agg(F.sum(c2(F.col("n"))).alias("sa"))).crossJoin(rb.agg(F.sum(c2(F.col("n"))).alias("sb")))  # one row each
    e = F.col("sa") * F.col("sb") / c2(F.col("n"))
    return s.select(F.try_divide(F.col("s") - e, (F.col("sa") + F.col("sb")) / 2 - e).alias("ari"))


def pair_rules(df: DataFrame, basket: str, item: str, support: int = 11) -> DataFrame:
    """antecedent, consequent, n, confidence, lift of ordered pairs of items in at least ``support`` baskets.

    Only pairs are counted, never larger sets, whose number would grow with the baskets: a basket's items of enough baskets pair up where they lie, and tasks add pairs up before they are shuffled."""
    b = persisted(df.groupBy(F.col(basket).alias("k")).agg(F.sort_array(F.collect_set(item)).alias("items")), "baskets")
    n = b.count()
    items = persisted(b.select(F.explode("items").alias("i")).groupBy("i").agg(F.count("*").alias("f")), "items")
    one = items.where(F.col("f") >= support)
    if items.where(F.col("f") < support).limit(1).count():
        b = b.select("k", F.explode("items").alias("i")).join(one, "i", "left_semi").groupBy("k").agg(F.sort_array(F.collect_set("i")).alias("items"))
    left = b.select(F.posexplode("items").alias("at", "a"), "items")
    two = left.select("a", F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("c")).groupBy("a", "c").agg(F.count("*").alias("freq")).where(F.col("freq") >= support)
    both = two.select("freq", F.explode(F.array(F.struct("a", "c"), F.struct(F.col("c").alias("a"), F.col("a").alias("c")))).alias("r")).select("freq", "r.a", "r.c")
    j = both.join(one.withColumnRenamed("i", "a").withColumnRenamed("f", "fa"), "a").join(one.withColumnRenamed("i", "c").withColumnRenamed("f", "fc"), "c")
    return j.select(F.col("a").alias("antecedent"), F.col("c").alias("consequent"), F.col("freq").alias("n"), (F.col("freq") / F.col("fa")).alias("confidence"), (F.col("freq") / F.col("fa") / (F.col("fc") / n)).alias("lift"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, t: s + t)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


#: A search by cosine deals about so many queries to a block and so many rows to a tile; a task scores so many queries against so many rows at a time.
BLOCK, TILE, QUERIES, ROWS = 8192, 65_536, 256, 4096


def dense(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as [row, term], and their lengths; a null vector, or one that holds a null, has length -1."""
    n = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0)).astype(np.int64)
    known = np.asarray(vectors.is_valid())
    flat = vectors.flatten()
    rows = np.repeat(np.arange(len(n)), n)
    out = np.zeros((len(n), int(n.max(initial=0))))
    out[np.arange(out.shape[1]) < n[:, None]] = flat.cast("float64").fill_null(0.0).to_numpy(zero_copy_only=False)
    known[rows[~np.asarray(flat.is_valid())]] = False
    return out, np.where(known, n, -1)


def nearest(base: DataFrame, queries: DataFrame, unit: str, vector: str, value: Column, k: int, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """query, _u, _s, _v: of every query the k rows of ``base`` of another ``unit`` (an integer) with the highest cosine, ties to smaller units, with their ``value``.

    Terms are added one by one, as SQL does, so equal vectors score equally. Like ``cosine``, vectors of different length, or with a null or of zero length give NULL, which comes last.
    Hashes deal queries to blocks and rows to tiles; every block meets every tile in a group of its own, of that bounded size, which keeps k rows a query before these meet. Nothing but two counts
    reaches the driver. A unit is one query (its smallest vector).
    """
    asked = queries.select(F.col(unit).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null").groupBy("id").agg(F.min("v").alias("v"))
    rows = base.select(F.col(unit).cast("long").alias("_u"), F.col(vector).alias("v"), value.alias("_v")).where("_u is not null")
    kind = rows.schema["_v"].dataType.simpleString()
    n = rows.count()
    blocks, tiles = max(-(-asked.count() // block), 1), max(-(-n // tile), min(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS)), 1)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("_t", every(tiles))
    right = rows.withColumn("_t", F.pmod(F.xxhash64("_u", F.monotonically_increasing_id()), F.lit(tiles)).cast("int")).withColumn("_b", every(blocks))

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        own, (asks, long) = queries.column("id").to_numpy(), dense(queries.column("v").combine_chunks())
        rows = rows.combine_chunks()
        norms = lengths(asks)
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]  # query number, unit, cosine, row
        for at in range(0, rows.num_rows if len(own) else 0, ROWS):
            part = rows.slice(at, ROWS)
            values, n = dense(pa.concat_arrays(part.column("v").chunks))
            sizes, units = lengths(values), part.column("_u").to_numpy()
            for a in range(0, len(own), QUERIES):
                e = slice(a, a + QUERIES)
                s = np.zeros((len(own[e]), len(n)))
                for term in range(min(asks.shape[1], values.shape[1])):
                    s += asks[e, term][:, None] * values[:, term]
                under = norms[e][:, None] * sizes
                with np.errstate(all="ignore"):
                    s = s / under
                s[(under == 0) | (long[e][:, None] != n) | (n < 0)] = -np.inf  # NULL
                s[np.isnan(s)] = np.inf  # as in SQL, above all numbers
                s, other = np.where(own[e][:, None] != units, s, -np.inf), own[e][:, None] != units
                take = min(k + int((~other).sum(axis=1).max(initial=0)), len(n))
                bound = np.partition(s, len(n) - take, axis=1)[:, len(n) - take]
                q, r = np.nonzero((s >= bound[:, None]) & other)
                kept = [np.concatenate(x) for x in zip(kept, highest(q + a, units[r], s[q, r], r + at, k), strict=True)]
            kept = highest(*kept, k)
        q, u, s, r = kept
        score = np.where(np.isposinf(s), np.nan, s)
        return pa.table({"query": pa.array(own[q] if len(q) else q, pa.int64()), "_u": pa.array(u, pa.int64()), "_s": pa.array(score, pa.float64(), mask=np.isneginf(s)), "_v": pa.concat_arrays(rows.column("_v").chunks or [pa.nulls(0, rows.schema.field("_v").type)]).take(pa.array(r, pa.int64()))})

    found = left.groupBy("_b", "_t").cogroup(right.groupBy("_b", "_t")).applyInArrow(search, f"query long, _u long, _s double, _v {kind}")
    order = Window.partitionBy("query").orderBy(F.desc("_s"), "_u", "_v")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def lengths(vectors: np.ndarray) -> np.ndarray:
    out = np.zeros(len(vectors))
    for term in range(vectors.shape[1]):
        out += vectors[:, term] * vectors[:, term]
    return np.sqrt(out)


def highest(q: np.ndarray, u: np.ndarray, s: np.ndarray, r: np.ndarray, k: int) -> list[np.ndarray]:
    """The k best of each query."""
    order = np.lexsort((u, -s, q))
    q, u, s, r = q[order], u[order], s[order], r[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return [q[keep], u[keep], s[keep], r[keep]]


def neighbour_profile(base: DataFrame, queries: DataFrame, unit: str, vector: str, value: Column, k: int) -> DataFrame:
    """query, n, mean of the values and similarity of its k nearest by cosine, never their ids. Every row of ``queries`` is scored against every row of the base."""
    return nearest(base, queries, unit, vector, value, k).groupBy("query").agg(F.count("*").alias("n"), F.avg("_v").alias("mean"), F.avg("_s").alias("similarity"))


def audit_features(df: DataFrame, features: list[str], label: Column, most: float = 0.95) -> DataFrame:
    """feature, n_distinct, auroc, suspicious (a single feature that separates the label, or a constant one)."""
    each = df.select(label.alias("_y"), F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])).alias("x")).select("_y", "x.*")
    a = grouped_auroc(each, ["feature"], "v", F.col("_y")).select("feature", "auroc", "n_distinct")
    return a.withColumn("suspicious", (F.greatest(F.col("auroc"), 1 - F.col("auroc")) > most) | (F.col("n_distinct") <= 1))


def audit_drift(df: DataFrame, features: dict[str, list[float]], later: Column) -> DataFrame:
    """feature, psi, ks between the earlier and the later rows."""
    d = df.withColumn("_g", later)
    rows = [psi(d, f, F.col("_g"), cuts).crossJoin(ks(d, f, F.col("_g"))).select(F.lit(f).alias("feature"), "psi", F.col("d").alias("ks")) for f, cuts in features.items()]  # one row each
    return reduce(DataFrame.unionByName, rows)


def slice_finder(df: DataFrame, dims: list[str], error: Column, least: int = 11) -> DataFrame:
    """dim, level, n, error_rate, excess over the overall rate, of slices by one or two dimensions."""
    singles = [F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("level")) for d in dims]
    pairs = [F.struct(F.lit(f"{a}*{b}").alias("dim"), F.concat_ws("*", F.col(a).cast("string"), F.col(b).cast("string")).alias("level")) for i, a in enumerate(dims) for b in dims[i + 1 :]]
    s = df.select(error.cast("double").alias("_e"), F.explode(F.array(F.struct(F.lit("all").alias("dim"), F.lit("all").alias("level")), *singles, *pairs)).alias("x")).groupBy("x.dim", "x.level").agg(F.count("*").alias("n"), F.avg("_e").alias("error_rate"))
    overall = F.max(F.when(F.col("dim") == "all", F.col("error_rate"))).over(Window.partitionBy())
    return s.withColumn("excess", F.col("error_rate") - overall).where(F.col("n") >= least)


def binomial_cells(df: DataFrame, keys: list[str], event: Column) -> DataFrame:
    """keys, n, events, rate, shrunken: each cell's rate drawn to the overall one by a beta prior whose moments come from the cells."""
    c = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(event).alias("events")).withColumn("rate", F.col("events") / F.col("n"))
    m = F.sum("events") / F.sum("n")
    moments = c.agg(m.alias("_m"), F.greatest(F.var_samp("rate") - m * (1 - m) * F.avg(1 / F.col("n")), F.lit(1e-9)).alias("_v"))
    d = c.crossJoin(F.broadcast(moments))  # one row
    k = F.greatest(F.col("_m") * (1 - F.col("_m")) / F.col("_v") - 1, F.lit(0.0))
    return d.withColumn("shrunken", (F.col("events") + F.col("_m") * k) / (F.col("n") + k)).drop("_m", "_v")


def build_sequences(filled: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """by, values, mask, since: arrays in order of ``at``: the value carried on (0 before the first), whether it was measured, bins since it was.

    ``filled`` has a row a unit and bin of a fixed grid, so an array is as long as the grid, however many events a unit has."""
    w = Window.partitionBy(by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col(value).isNotNull(), F.col(at)), ignorenulls=True).over(w)
    d = filled.select(by, at, F.coalesce(F.last(value, ignorenulls=True).over(w), F.lit(0.0)).alias("v"), F.col(value).isNotNull().cast("int").alias("m"), F.coalesce(F.col(at) - last, F.lit(-1)).alias("s"))
    g = d.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(at, "v", "m", "s"))).alias("x"))
    return g.select(by, F.col("x.v").alias("values"), F.col("x.m").alias("mask"), F.col("x.s").alias("since"))


def sequence_channels(filled: DataFrame, by: str, at: str, variables: list[str], train: Column) -> DataFrame:
    """by and, for each variable, a struct of arrays in order of ``at``: values, mask, since.

    values: distance from the mean in deviations, both of the measured values of the training rows alone (``train`` over the rows of ``filled``), carried on, 0 before the first; mask: whether it was measured; since: bins since it last was, -1 before the first.
    A variable without spread in the training rows, or not measured there, gives 0 throughout. NaN counts as not measured. One row of statistics goes to every task; a window is a unit's fixed grid."""
    known = {v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")) for v in variables}
    stats = filled.where(train).agg(*[f(x).alias(f"_{n}{k}") for k, x in enumerate(known.values()) for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    w = Window.partitionBy(by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    d = filled.select(by, at, *[x.alias(f"_x{k}") for k, x in enumerate(known.values())]).crossJoin(F.broadcast(stats))  # one row of statistics
    cols = [F.col(at).alias("at")]
    for k in range(len(variables)):
        x, mean, spread = F.col(f"_x{k}"), F.col(f"_m{k}"), F.col(f"_s{k}")
        z = F.when(x.isNotNull(), F.when(spread > 0, (x - mean) / spread).otherwise(0.0))
        last = F.last(F.when(x.isNotNull(), F.col(at)), ignorenulls=True).over(w)
        cols += [F.coalesce(F.last(z, ignorenulls=True).over(w), F.lit(0.0)).alias(f"v{k}"), x.isNotNull().cast("int").alias(f"m{k}"), F.coalesce(F.col(at) - last, F.lit(-1)).alias(f"s{k}")]
    rows = d.select(F.col(by).alias("_u"), F.struct(*cols).alias("r")).groupBy("_u").agg(F.array_sort(F.collect_list("r")).alias("x"))
    channels = [F.struct(F.col(f"x.v{k}").alias("values"), F.col(f"x.m{k}").alias("mask"), F.col(f"x.s{k}").alias("since")).alias(v) for k, v in enumerate(variables)]
    return rows.select(F.col("_u").alias(by), *channels)


def temporal_holdout(df: DataFrame, era: Column, dev: int, holdout: int) -> DataFrame:
    """part, n: rows of the development eras (up to ``dev``), of the holdout era, and sealed ones, which are counted and never read further."""
    part = F.when(era <= dev, "dev").when(era <= holdout, "holdout").otherwise("sealed")
    return df.groupBy(part.alias("part")).agg(F.count("*").alias("n"))


def duplicate_rows(df: DataFrame, xs: list[str], split: str) -> DataFrame:
    """One row: rows, rows that repeat another's features, and rows whose features occur in more than one split. Rows meet by a hash of their features."""
    g = df.groupBy(F.xxhash64(*xs).alias("h"), F.sha2(F.to_json(F.struct(*xs)), 256).alias("h2")).agg(F.count("*").alias("n"), F.countDistinct(split).alias("k"))
    return g.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("repeated"), F.sum(F.when(F.col("k") > 1, F.col("n")).otherwise(0)).alias("across_splits"))


def suspicious_names(df: DataFrame, words: list[str]) -> DataFrame:
    """column, word: column names that hold a word of the outcome or of what comes after it."""
    hits = [(c, w) for c in df.columns for w in words if w.lower() in c.lower()]
    return df.sparkSession.createDataFrame(hits, "column string, word string")


def prevalence_by_era(df: DataFrame, era: Column, label: Column, xs: list[str]) -> DataFrame:
    """era, n, prevalence, mean and missing share of each feature."""
    return df.groupBy(era.alias("era")).agg(F.count("*").alias("n"), F.avg(label.cast("double")).alias("prevalence"), *[f for x in xs for f in (F.avg(x).alias(f"mean_{x}"), F.avg(F.col(x).isNull().cast("double")).alias(f"missing_{x}"))])
